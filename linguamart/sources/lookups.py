"""Seed lookups."""

from pyspark.sql import functions as F

from ..constants import GENRE_PRIORITY
from ..functions import strip_ws
from ..schemas import GENRE_SEED


def _normal(df):
    return df.select(
        F.lower(strip_ws(F.col("genre").cast("string"))).alias("genre"), F.col("priority").cast("long").alias("priority")
    )


def genre_seed(spark, priorities=GENRE_PRIORITY):
    return _normal(spark.createDataFrame(list(priorities.items()), GENRE_SEED))


def read_seed(spark, path):
    """Seed CSV with header genre,priority."""
    return _normal(spark.read.schema(GENRE_SEED).option("header", True).csv(path))
