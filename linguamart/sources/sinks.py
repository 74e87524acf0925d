"""Writing tables."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

#: Parts that the rows of one id and day can be split into.
SPREAD = 1024


def layer_path(base, layer, source, day=None):
    """Path of a table in a layer; ``day`` adds the dated folder of one snapshot."""
    path = f"{base.rstrip('/')}/{layer}/{source}"
    return f"{path}/snapshot_date={day}" if day else path


def write_parquet(df, path, mode="overwrite", sort_by=()):
    df = df.sortWithinPartitions(*sort_by) if sort_by else df
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_csv(df, path, mode="overwrite"):
    """CSV with header; quotes inside a value are doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_days(df, path, day_col="snapshot_date", id_col="appid", mode="overwrite"):
    """Partitioned by day, clustered by id: the files of a day hold ranges of ids that meet at their borders at most, each file sorted.

    Rows are dealt out by ranges of (day, id), so a large day is split over tasks and files, and a filter on an id opens
    the one file of a day whose statistics hold it. Ranges are cut by sampled sizes; ranges that turn out small are
    joined with their neighbours. An id that alone fills more than a range is split over files by a hash of its rows. Only the
    days present in ``df`` are replaced.
    """
    plain = [f.name for f in df.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant", "void"))]
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(SPREAD))
    (
        df.repartitionByRange(F.col(day_col), F.col(id_col), spread).sortWithinPartitions(day_col, id_col)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(day_col).parquet(path)
    )


def save_view(df, name):
    """Staging models are views: nothing is stored."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_mart(df, name, path=None):
    """Mart models are tables."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def observed(df, name):
    """``df`` with a row count taken while it is written, and the observation that holds it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
