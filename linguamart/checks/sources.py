"""Files and tables in and out: written to the shared scratch folder from a whole table, then read back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators import best_per_key
from ..session import scratch_dir
from ..sources import (
    layer_path, observed, read_bronze_csv, read_silver, register_sources, save_mart, save_view, select_source, with_file_date, write_csv, write_days,
    write_parquet,
)
from .registry import query, table


def _dated_orders(spark, sf_dir):
    root = scratch_dir(spark, "orders-by-month")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("snapshot_date")
    )
    write_days(orders, root, id_col="o_orderkey")
    return root


_MONTHS = "SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders"


@query("q_source_all", _MONTHS)
def source_all(spark, sf_dir):
    return select_source(spark, _dated_orders(spark, sf_dir))


@query("q_source_latest", f"SELECT * FROM ({_MONTHS}) WHERE snapshot_date = (SELECT max(snapshot_date) FROM ({_MONTHS}))")
def source_latest(spark, sf_dir):
    return select_source(spark, _dated_orders(spark, sf_dir), "latest")


@query("q_source_date", f"SELECT * FROM ({_MONTHS}) WHERE snapshot_date = DATE '1997-05-01'")
def source_date(spark, sf_dir):
    return select_source(spark, _dated_orders(spark, sf_dir), "latest", date="1997-05-01")


@query("q_file_date", f"SELECT o_orderkey, snapshot_date AS file_date, DATE '2024-05-01' AS ingestion_date FROM ({_MONTHS})")
def file_date(spark, sf_dir):
    dated = with_file_date(select_source(spark, _dated_orders(spark, sf_dir)), out="file_date")
    return dated.select("o_orderkey", "file_date", F.lit("2024-05-01").cast("date").alias("ingestion_date"))


@query("q_register_sources", f"""
SELECT 'store' AS side, o_orderkey, snapshot_date FROM ({_MONTHS}) UNION ALL
SELECT 'popularity', o_orderkey, snapshot_date FROM ({_MONTHS}) WHERE snapshot_date > DATE '1996-06-01'""")
def registered(spark, sf_dir):
    """Views over day folders below a dated base path; one of them has a day of its own, and is read from a day on."""
    base = scratch_dir(spark, "lake-2001-01-01")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("snapshot_date"))
    write_days(orders, f"{base}/store", id_col="o_orderkey")
    write_days(orders.withColumn("ingestion_date", F.col("snapshot_date").cast("string")), f"{base}/popularity", id_col="o_orderkey")
    views = register_sources(spark, base, tables={"q_store": ("store", ""), "q_popularity": ("popularity", "")})
    late = views["q_popularity"].where("snapshot_date > DATE'1996-06-01'")
    sides = {"store": views["q_store"], "popularity": late}
    first, second = (df.select(F.lit(name).alias("side"), "o_orderkey", "snapshot_date") for name, df in sides.items())
    return first.union(second)


_ORDER_COLUMNS = StructType([
    StructField("o_orderkey", LongType()), StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("absent", StringType()),
])


@query("q_bronze_csv", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice, CAST(NULL AS VARCHAR) AS absent FROM orders""")
def bronze_csv(spark, sf_dir):
    """CSV files of one folder with two headers, read by column name into one table."""
    folder = scratch_dir(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders")
    even = F.col("o_orderkey") % 2 == 0
    orders.where(even).select("o_orderkey", "o_totalprice", "o_orderstatus").write.option("header", True).csv(folder)
    orders.where(~even).select("o_orderstatus", "o_orderpriority", "o_orderkey").write.mode("append").option("header", True).csv(folder)
    return read_bronze_csv(spark, folder, _ORDER_COLUMNS, multi_line=False).select(*_ORDER_COLUMNS.fieldNames())


@query("q_silver_day", "SELECT o_orderkey, o_custkey, o_totalprice, DATE '2024-05-01' AS snapshot_date FROM orders")
def silver_day(spark, sf_dir):
    """A snapshot of one day, sorted and compressed at its place in the silver layer, found by its name and day."""
    base = scratch_dir(spark, "lake")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    write_parquet(orders, layer_path(base, "silver", "orders", "2024-05-01"), sort_by=("o_custkey", "o_orderkey"))
    write_parquet(orders.where("o_orderkey < 0"), layer_path(base, "silver", "orders", "2024-05-02"))
    return read_silver(spark, f"{base}/silver", "orders", "2024-05-01")


_NOTES = StructType([StructField("appid", LongType()), StructField("name", StringType()), StructField("note", StringType())])


@query("q_csv_sink", """
SELECT c_custkey AS appid, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_name || ' said "' || c_mktsegment || '", twice' || chr(10) || '-- ' || c_custkey END AS note
FROM customer""")
def csv_sink(spark, sf_dir):
    """Texts with quotes, commas and line ends, written with a header and read back by it."""
    path = scratch_dir(spark, "notes")
    name, key = F.col("c_name"), F.col("c_custkey")
    note = F.concat(name, F.lit(' said "'), F.col("c_mktsegment"), F.lit('", twice\n-- '), key.cast("string"))
    write_csv(table(spark, sf_dir, "customer").select(F.when(key % 3 != 0, note).alias("note"), name.alias("name"), key.alias("appid")), path)
    return read_bronze_csv(spark, path, _NOTES).select(*_NOTES.fieldNames())


@query("q_views_and_marts", """
SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def views_and_marts(spark, sf_dir):
    """A staging view and a stored mart, both named in the catalogue and met again there by SQL."""
    mark = uuid.uuid4().hex
    save_view(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), f"staged_{mark}")
    save_mart(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice"), f"mart_{mark}", scratch_dir(spark, "mart"))
    return spark.sql(f"""
SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM mart_{mark} JOIN staged_{mark} ON o_custkey = c_custkey GROUP BY c_mktsegment""")


@query("q_audited_writes", """
SELECT 'events' AS table_name, count(*) AS rows_in, CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS rows_out FROM events
UNION ALL SELECT 'latest', (SELECT count(*) FROM events), (SELECT count(DISTINCT user_id) FROM events)""")
def audited_writes(spark, sf_dir):
    """Rows before and after each transform, counted while it is written."""
    steps = {
        "events": lambda df: df.where("event_type <> 'error'"),
        "latest": lambda df: best_per_key(df, ["user_id"], [F.desc("ts"), F.desc("event_id")]),
    }
    counts = []
    for name, step in steps.items():
        rows, before = observed(table(spark, sf_dir, "events"), f"{name}-in")
        done, after = observed(step(rows), f"{name}-out")
        write_parquet(done, scratch_dir(spark, name))
        counts.append((name, before.get["rows"], after.get["rows"]))
    return spark.createDataFrame(counts, "table_name string, rows_in long, rows_out long")
