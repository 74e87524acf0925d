"""Session defaults and the shared scratch folder."""

import re
import uuid

from pyspark.sql import SparkSession


def build_session(name="linguamart", master=None, **conf):
    """A session with the settings the jobs expect; a cluster's own settings win elsewhere."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Files of pandas hold nanoseconds, which are read as longs and turned into timestamps by the sources.
        "spark.sql.legacy.parquet.nanosAsLong": "true",
        # A record that repeats a key keeps the last value, as other readers of JSON do.
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_made = {}


def scratch_dir(spark, label="scratch"):
    """A new folder path in a folder that driver and executors share.

    That is the one ``spark.checkpoint.dir`` names, or else a part of the session's warehouse. On a cluster whose
    warehouse is a folder of one machine there is no such folder, and a ValueError says what to set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not spark.sparkContext.master.startswith("local") and re.match(r"(file:)?/", warehouse):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = warehouse + "/_scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark):
    """Remove every folder that this session has made in the shared folder; for when all results that read them are written."""
    drop_stage(spark, *_made.pop(spark.sparkContext.applicationId, []))


def drop_stage(spark, *paths):
    """Remove staged folders that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df, label="stage", partition_by=()):
    """Write ``df`` to the shared folder and return the path: lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return path


def stored(df, label="stored"):
    """``df`` written to the shared folder and read back: what several branches of a plan need is worked out once."""
    return df.sparkSession.read.schema(df.schema).parquet(stage(df, label))
