"""The daily run: bronze snapshot of one day to silver, staging, marts and checks."""

from pyspark.sql import functions as F

from ..constants import TOP_N
from ..operators import first_in_file, keep_listed, merge_regions, pages_to_stop, popularity_records, region_counters, run_checks, store_records, top_n_distinct
from ..schemas import BRONZE_POPULARITY, BRONZE_STORE
from ..sources import (
    last_processed, layer_path, mark_processed, observed, read_bronze_csv, read_silver, register_sources,
    save_view, write_csv, write_parquet,
)
from ..streaming import load_days, read_table
from . import marts, silver, staging


def land_payloads(popularity_pages, first_region, second_region, base, day, n=TOP_N):
    """Landed JSON documents to the two bronze snapshots.

    ``popularity_pages`` has columns page and payload; the regions have payload. The list is the
    first ``n`` distinct ids in the order of the pages and of the entries in them; store rows are
    kept for listed ids only. Returns the hit counters of the regions over the listed ids, and the number of these.
    """
    spark = popularity_pages.sparkSession
    fields = {f.name: f.dataType for f in BRONZE_POPULARITY.fields}
    records = popularity_records(pages_to_stop(popularity_pages, "payload", "page"), "payload", fields, position="position")
    popularity = layer_path(base, "bronze", "popularity", day)
    write_csv(top_n_distinct(records, ["appid"], ["page", "position"], n).select(*fields), popularity)
    listed = read_bronze_csv(spark, popularity, BRONZE_POPULARITY)
    first, second = (keep_listed(store_records(r, "payload"), listed, "appid") for r in (first_region, second_region))
    details = merge_regions(first, second)
    write_csv(details.select(*BRONZE_STORE.fieldNames()), layer_path(base, "bronze", "store", day))
    return region_counters(first, second).withColumn("input_ids", listed.agg(F.count(F.lit(1))).scalar())


def build_silver(spark, base, day, store_csv=None, popularity_csv=None, skip_done=False, ignore_footnote=False, multi_line=True):
    """Write the five silver tables of a day and mark each in the ledger.

    ``multi_line=False`` says that no CSV value holds a line break, so large files are split. Returns rows written per
    table, and rows read per bronze snapshot.
    """
    ledger = f"{base}/ledger"
    counts = {}

    def done(table):
        last = last_processed(spark, ledger, table) if skip_done else None
        return last is not None and str(last) >= str(day)

    def bronze(table, path, schema):
        raw = read_bronze_csv(spark, path or layer_path(base, "bronze", table, day), schema, multi_line)
        return observed(raw, f"{table}-bronze-{day}")

    def write(table, df, sort_by=("appid",)):
        if done(table):
            return
        df, seen = observed(df, f"{table}-{day}")
        write_parquet(df, layer_path(base, "silver", table, day), sort_by=sort_by)
        counts[table] = seen.get["rows"]
        mark_processed(spark, ledger, table, day)

    if not done("store"):
        raw, seen = bronze("store", store_csv, BRONZE_STORE)
        write("store", silver.silver_store(raw, lambda df: first_in_file(df, ["appid"])))
        counts["store_bronze"] = seen.get["rows"]
    if not done("popularity"):
        raw, seen = bronze("popularity", popularity_csv, BRONZE_POPULARITY)
        write("popularity", silver.silver_popularity(raw, lambda df: first_in_file(df, ["appid"], best="ccu"), day))
        counts["popularity_bronze"] = seen.get["rows"]

    store = read_silver(spark, layer_path(base, "silver", "").rstrip("/"), "store", day).drop("snapshot_date")
    write("games", silver.silver_games(store))
    write("genres", silver.silver_genres(store))
    write("languages", silver.silver_languages(store, ignore_footnote=ignore_footnote), sort_by=("appid", "language"))
    return counts


def build_gold(spark, base, mode="all", date=None, dates=None, enforce=True):
    """Source views, staging views and marts; returns the tables and the check report.

    A failed check stops the run once all tables are written, as long as ``enforce`` is set; the key of the languages,
    known to repeat, is only reported.
    """
    raw = register_sources(spark, layer_path(base, "silver", "").rstrip("/"), mode, date)
    staged = {
        "staging_store": staging.staging_store(raw["store_raw"]),
        "staging_popularity": staging.staging_popularity(raw["popularity_raw"]),
        "staging_languages": staging.staging_languages(raw["languages_normalized"]),
    }
    # Several marts and checks read the staging views, so each is computed once and stored.
    views = {}
    for name, df in staged.items():
        path = layer_path(base, "staging", name)
        write_parquet(df, path, sort_by=("appid",))
        views[name] = save_view(spark.read.schema(df.schema).parquet(path), name)
    gold = f"{base}/gold"
    outputs = {
        "fct_games": marts.fct_games(views["staging_store"], views["staging_popularity"]),
        "dim_genres": marts.dim_genres(views["staging_store"]),
        "dim_languages": marts.dim_languages(views["staging_languages"]),
    }
    tables = dict(views)
    for name, df in outputs.items():
        write_parquet(df, f"{gold}/{name}", sort_by=("appid",))
        tables[name] = save_view(spark.read.schema(df.schema).parquet(f"{gold}/{name}"), name)
    daily = f"{gold}/fct_games_daily"
    load_days(marts.fct_games_daily(raw["store_raw"], raw["popularity_raw"]), daily, dates)
    tables["fct_games_daily"] = save_view(read_table(spark, daily), "fct_games_daily")
    report = run_checks(tables, marts.CHECKS)
    if enforce:
        # One row per declared check at most.
        failed = [tuple(r) for r in report.where("n_failed > 0").collect() if tuple(r)[:3] not in marts.REPORTED]
        if failed:
            raise ValueError(f"checks failed: {failed}")
    return tables, report


def run_day(spark, base, day, **options):
    """Silver and gold for one day. Gold starts only after silver has been written."""
    gold_options = {k: options.pop(k) for k in ("mode", "date", "dates", "enforce") if k in options}
    counts = build_silver(spark, base, day, **options)
    tables, report = build_gold(spark, base, **(gold_options or {"date": day}))
    return counts, tables, report
