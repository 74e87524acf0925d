"""Numbers without gaps for the values of a column."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stored


def dense_numbers(df, key, out="number"):
    """(key, number) of the distinct values of ``key`` that are not null, numbered from 0 in their order.

    Values are dealt out by ranges and numbered within each; the numbers before a range are the sums of the sizes of
    those before it, one row per range. Stored, so that every use sees the same numbers.
    """
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    dealt = stored(values.repartitionByRange(key).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select("__part", (F.sum("__size").over(Window.orderBy("__part")) - F.col("__size")).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1
    return dealt.withColumn("__within", within).join(before, "__part").select(key, (F.col("__before") + F.col("__within")).alias(out))
