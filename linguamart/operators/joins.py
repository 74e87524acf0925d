"""Joins beyond a plain ``DataFrame.join``."""

from functools import reduce

from pyspark.sql import functions as F

from ..session import stage

def keep_listed(df, ids, key):
    """Rows whose key is in ``ids``."""
    return df.join(ids.select(key), key, "left_semi")


def union_lists(lists, name_col="list_name"):
    """Several lists as one, each row tagged with the name of its list."""
    tagged = [df.withColumn(name_col, F.lit(name)) for name, df in lists.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def attach_details(items, details, key):
    """Left join that keeps every item, where one id may hold a large part of the items.

    ``details`` has one row per key. Items are stored with the number of their partition, and each detail goes to the
    partitions that ask for it: items then meet it by (key, partition), so no task gets more of an id than one
    partition of the items holds, whatever its share, and no size decides about the plan.
    """
    spark = items.sparkSession
    stored = items.withColumn("__part", F.spark_partition_id())
    stored = spark.read.schema(stored.schema).parquet(stage(stored, "items"))
    asked = stored.where(F.col(key).isNotNull()).select(key, "__part").distinct()
    return stored.join(asked.join(details, key), [key, "__part"], "left").drop("__part")
