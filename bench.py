"""Seconds per headline query; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F

from linguamart.checks import QUERIES
from linguamart.checks.standins import raw_store
from linguamart.operators import first_in_file
from linguamart.plans import silver
from linguamart.schemas import BRONZE_STORE
from linguamart.session import build_session, scratch_dir, stage
from linguamart.sources import read_bronze_csv, write_csv, write_parquet

HEADLINE = [
    "q_fct_games", "q_fct_games_daily", "q_silver_store", "q_silver_popularity", "q_silver_languages",
    "q_dim_genres", "q_dim_languages", "q_primary_genre", "q_latest_per_key_day", "q_token_count", "q_html_clean",
    "q_payload_rows", "q_region_merge", "q_incremental_daily", "q_source_latest", "q_profile", "q_genre_heatmap",
    "q_missing_localization", "q_coverage_vs_perf", "q_trend", "q_dq_marts", "q_opportunity", "q_audio_impact", "q_value_quantiles",
]
# Timed as well, and left out of the total so that it stays comparable.
MORE = ["q_store_payload", "q_bronze_csv", "q_genre_heatmap_bitmaps", "q_trend_incremental", "q_stream_intake", "q_unique_growing", "q_distinct_sketches", "q_quantile_sketches"]


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def snapshot_io(spark, sf_dir):
    """Write, read and transform snapshots as CSV and Parquet: one day, and all days as one table."""
    seconds, sizes = {}, {}
    every = stage(raw_store(spark, sf_dir).drop("file_path"), "snapshots")
    table = spark.read.parquet(every)
    day = table.groupBy("snapshot_date").count().orderBy("snapshot_date").first()[0]
    for label, df in (("day", table.where(F.col("snapshot_date") == F.lit(day))), ("all", table)):
        df = df.drop("snapshot_date").coalesce(1) if label == "day" else df.drop("snapshot_date")
        csv, parquet, silver_path = (scratch_dir(spark, n) for n in ("csv", "parquet", "silver"))
        steps = {
            "csv_write": lambda: write_csv(df, csv),
            "parquet_write": lambda: write_parquet(df, parquet),
            "csv_read": lambda: spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(csv)
            .write.format("noop").mode("overwrite").save(),
            "parquet_read": lambda: spark.read.schema(df.schema).parquet(parquet).write.format("noop").mode("overwrite").save(),
            "store_transform": lambda: write_parquet(
                silver.silver_store(read_bronze_csv(spark, csv, BRONZE_STORE), lambda x: first_in_file(x, ["appid"])), silver_path
            ),
        }
        for name, step in steps.items():
            start = time.perf_counter()
            step()
            seconds[f"io_{label}_{name}"] = round(time.perf_counter() - start, 3)
        sizes[label] = {"rows": df.count(), "csv_bytes": _size(csv), "parquet_bytes": _size(parquet)}
    return seconds, sizes


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first round only warms up the JVM; the second is timed.
    for _ in range(2):
        seconds = {}
        for name in HEADLINE + MORE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    for _ in range(2):
        io_seconds, sizes = snapshot_io(spark, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds[name] for name in HEADLINE), 3), "unit": "sec",
        "queries": {**seconds, **io_seconds}, "snapshot_sizes": sizes, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
