"""Bronze snapshots: dated CSV files and landed JSON payloads."""

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..constants import NA_TOKENS
from ..functions import whole_number
from ..operators import backfill_columns
from ..operators.dedupe import SCAN_ORDER, with_scan_order


def _headers(spark, path):
    """Column names -> the files that have them, from the first line of each file; files without one are left out.

    One pass over the text, however many files there are: a task keeps the first line of the files it reads from the
    start. Only the distinct headers and the names of the files reach the driver.
    """
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in (problem.getCondition() or ""):
            raise FileNotFoundError(f"no snapshot at {path}") from problem
        raise
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("file").agg(F.min_by("value", "row").alias("header"))
    # Of a path with a scheme Spark's metadata writes the same scheme, with characters encoded.
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    # Metadata give a path with special characters encoded; readers take it plain.
    return {_names(r["header"]): [unquote(f) for f in r["files"]] for r in found}


def _names(header):
    """Column names of a header line; of a name that repeats the first stays, the others become names of their own."""
    names = next(csv.reader([header.removeprefix("\ufeff")]))
    return tuple(n if n and n not in names[:i] else f"{n}__{i}" for i, n in enumerate(names))


def read_bronze_csv(spark, path, schema, multi_line=True, safe=()):
    """A CSV snapshot typed by ``schema``, with the place of each row in its files.

    Columns are matched by header name, in every file by its own header; expected ones that are absent come in as null,
    others are left out. Texts that stand for a missing value become null. An empty file gives no row; a missing one
    raises FileNotFoundError. A value that does not fit its type stops the job, except in ``safe`` columns.
    ``multi_line=False`` lets Spark split large files that hold no line breaks inside quotes.
    """
    tables = [_read_alike(spark, files, header, schema, multi_line, safe) for header, files in _headers(spark, path).items()]
    if not tables:
        empty = spark.createDataFrame([], schema)
        return empty.withColumn(SCAN_ORDER, F.lit(None).cast("struct<file:string,block:bigint,row:bigint>"))
    return reduce(lambda a, b: a.unionByName(b), tables)


def _read_alike(spark, files, header, schema, multi_line, safe):
    """Files of one header."""
    text = StructType([StructField(name, StringType(), True) for name in header])
    raw = with_scan_order(
        spark.read.schema(text).option("header", True).option("escape", '"').option("multiLine", multi_line).csv(files)
    )
    types = {f.name: f.dataType for f in schema.fields}

    def typed(name):
        value = F.when(~F.col(name).isin(NA_TOKENS), F.col(name))
        if types[name] == StringType():
            return value.alias(name)
        if types[name] == LongType():
            return whole_number(value, name in safe).alias(name)
        return (value.try_cast(types[name]) if name in safe else value.cast(types[name])).alias(name)

    known = raw.select(*[typed(c) for c in header if c in types], SCAN_ORDER)
    return backfill_columns(known, schema)


def read_json_documents(spark, path):
    """Landed payload files, one whole document per row in column ``payload``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"))
