"""Choosing which dated files make up a table."""

import datetime as dt
import re

from pyspark.sql import functions as F

from ..constants import DATE_IN_NAME
from ..functions import date_in_text

# Name of each source table -> folder and the text its file names contain.
SOURCE_TABLES = {
    "store_raw": ("store", ""),
    "popularity_raw": ("popularity", ""),
    "games_normalized": ("games", ""),
    "genres_normalized": ("genres", ""),
    "languages_normalized": ("languages", ""),
}


DAY = "snapshot_date"


def day_folders(spark, root, day_col=DAY):
    """Sorted days that a table laid out by day holds, from its folder names; [] for any other folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    found = [re.fullmatch(rf"{day_col}=(\d{{4}}-\d{{2}}-\d{{2}})", name) for name in names]
    return sorted(dt.date.fromisoformat(m.group(1)) for m in found if m)


def list_files(spark, root, needle="", suffix=".parquet"):
    """Paths under ``root`` as a DataFrame; only names are read, listed in parallel."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}").load(root).select("path")
    )
    return files.where(F.col("path").contains(needle)) if needle else files


def read_nanoseconds(df, names=("release_date", "ingestion_date", DAY)):
    """Dates that pandas has written as nanoseconds and the session reads as longs, as timestamps again."""
    late = [c for c, kind in df.dtypes if c in names and kind == "bigint"]
    return df.withColumns({c: F.timestamp_micros(F.floor(F.col(c) / 1000).cast("long")) for c in late}) if late else df


def select_source(spark, root, mode="all", date=None, needle="", schema=None, merge_schema=False):
    """A table over all matching files, over the latest day, or over one date.

    A date wins over the mode; no matching file raises FileNotFoundError. In a table laid out by
    day only the folder of the chosen day is listed. Elsewhere the choice is a filter on the file
    path, which Spark applies while it lists files, so the others are never opened; latest is then
    the day in the greatest path, or that one file if its path has no date.
    """
    if mode not in ("all", "latest"):
        raise ValueError("mode must be one of: all, latest")
    reader = spark.read.option("mergeSchema", merge_schema)
    reader = reader.schema(schema) if schema is not None else reader

    days = [] if needle else day_folders(spark, root)
    if days:
        if not date and mode == "all":
            return reader.parquet(root)
        day = str(date or days[-1])
        if day not in map(str, days):
            raise FileNotFoundError(f"no {DAY}={day} under {root}")
        return reader.option("basePath", root).parquet(f"{root}/{DAY}={day}")

    names = list_files(spark, root, needle)
    if date:
        names = names.where(F.col("path").contains(str(date)))
    newest = names.agg(F.max("path")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no files under {root} for needle={needle!r} date={date!r}")
    df = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)
    path = F.col("_metadata.file_path")
    if needle:
        df = df.where(path.contains(needle))
    if date:
        return df.where(path.contains(str(date)))
    if mode == "latest":
        found = re.findall(DATE_IN_NAME, newest)
        return df.where(path.contains(found[-1] if found else newest.rsplit("/", 1)[-1]))
    return df


def with_file_date(df, out=DAY, fallback_for=None, path_col="file_path", late=lambda df: df):
    """Add the file path and the day of each row. Use directly on a file scan.

    A day folder's column stays the day as it is, so that a filter on it still chooses folders. Elsewhere the day is the
    date in the file's own name or else of its day folder, not one further up in the path; ``fallback_for`` names a date column that wins where set.
    ``late`` is applied once the path is known.
    """
    path = F.col("_metadata.file_path")
    if out in df.columns:
        return late(df.withColumn(path_col, path))
    folder = F.regexp_extract(path, rf"/{DAY}=([^/]*)/[^/]*$", 1)
    found = F.coalesce(date_in_text(F.substring_index(path, "/", -1)), date_in_text(folder))
    df = late(df.withColumns({path_col: path, "__day": found}))
    day = F.col("__day") if fallback_for is None else F.coalesce(F.col(fallback_for).try_cast("date"), F.col("__day"))
    return df.withColumn(out, day).drop("__day")


def read_silver(spark, root, table, day):
    """One day of a silver table; FileNotFoundError if there is none."""
    return select_source(spark, f"{root}/{table}", date=day)


def register_sources(spark, root, mode="all", date=None, tables=SOURCE_TABLES):
    """Create or replace one temporary view per source table, each with its file path and date."""
    views = {}
    for name, (folder, needle) in tables.items():
        df = select_source(spark, f"{root}/{folder}", mode, date, needle)
        fallback = "ingestion_date" if "ingestion_date" in df.columns else None
        df = with_file_date(df, fallback_for=fallback, late=read_nanoseconds)
        df.createOrReplaceTempView(name)
        views[name] = spark.table(name)
    return views
