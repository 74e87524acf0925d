"""Incremental loads, replayed in steps on tables in the shared scratch folder."""

import datetime as dt

from pyspark.sql import functions as F

from ..session import scratch_dir, stored
from ..sources import LostRace, last_processed, mark_processed, read_ledger, write_days
from ..streaming import intake, load_days, merge_rows, read_table, replace_days, update_trend
from ..streaming.incremental import table_state, write_load
from ..streaming.uniqueness import unique_report, update_unique
from . import gold
from . import standins as s
from .registry import query, table


def _per_day(events):
    return events.groupBy(
        F.col("user_id").alias("appid"), F.col("ts").cast("date").alias("snapshot_date")
    ).agg(F.count(F.lit(1)).alias("n_events"), F.round(F.max("value"), 2).alias("top_value"))


def _activity(spark, sf_dir):
    """Events per user and day: a small fact at (id, day)."""
    return _per_day(table(spark, sf_dir, "events"))


_ACTIVITY = """activity AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date, count(*) AS n_events, round(max(value), 2) AS top_value
  FROM events GROUP BY ALL)"""

_CUT = dt.date(1998, 6, 1)
_DAY = dt.date(2024, 1, 15)


@query("q_incremental_daily", s.sql(*s.BASE_DAILY, select=f"""
SELECT * REPLACE (CASE WHEN snapshot_date > DATE '{_CUT}' THEN ccu + 1000 ELSE ccu END AS ccu) FROM fct_games_daily"""))
def incremental_daily(spark, sf_dir):
    """First load up to a day; then all days with other numbers, of which only the later ones may enter."""
    target = scratch_dir(spark, "daily")
    fact = stored(gold.fct_games_daily(spark, sf_dir), "fact")
    load_days(fact.where(F.col("snapshot_date") <= F.lit(_CUT)), target)
    load_days(fact.withColumn("ccu", F.col("ccu") + 1000), target)
    return read_table(spark, target)


@query("q_late_day_ignored", f"WITH {_ACTIVITY} SELECT * FROM activity WHERE snapshot_date >= DATE '{_DAY}'")
def late_day_ignored(spark, sf_dir):
    target = scratch_dir(spark, "activity")
    fact = _activity(spark, sf_dir)
    load_days(fact.where(F.col("snapshot_date") >= F.lit(_DAY)), target)
    load_days(fact, target)
    return read_table(spark, target)


@query("q_rerun_day", f"""WITH {_ACTIVITY}
SELECT * REPLACE (CASE WHEN snapshot_date = DATE '{_DAY}' THEN n_events + 100 ELSE n_events END AS n_events) FROM activity""")
def rerun_day(spark, sf_dir):
    target = scratch_dir(spark, "activity")
    fact = _activity(spark, sf_dir)
    load_days(fact, target)
    changed = fact.withColumn("n_events", F.col("n_events") + 100)
    for _ in range(2):
        replace_days(changed, target, [_DAY])
    return read_table(spark, target)


@query("q_schema_sync", f"""WITH {_ACTIVITY}
SELECT appid, snapshot_date, n_events, CASE WHEN snapshot_date > DATE '{_DAY}' THEN n_events * 2 END AS doubled FROM activity""")
def schema_sync(spark, sf_dir):
    """The second load drops one column and brings another."""
    target = scratch_dir(spark, "activity")
    fact = _activity(spark, sf_dir)
    load_days(fact.where(F.col("snapshot_date") <= F.lit(_DAY)), target)
    load_days(fact.withColumn("doubled", F.col("n_events") * 2).drop("top_value"), target)
    return read_table(spark, target)


@query("q_merge_rows", f"""WITH {_ACTIVITY}
SELECT appid, snapshot_date, n_events, top_value FROM activity WHERE NOT (snapshot_date >= DATE '{_DAY}' AND n_events >= 3)
UNION ALL SELECT appid, snapshot_date, n_events + 100, top_value FROM activity WHERE snapshot_date >= DATE '{_DAY}' AND n_events >= 3
UNION ALL SELECT appid + 1000000, snapshot_date, n_events, top_value FROM activity WHERE snapshot_date = DATE '{_DAY}'""")
def merged_rows(spark, sf_dir):
    """Rows of later days with enough events change; new ids come in on one day; all others stay."""
    target = scratch_dir(spark, "activity")
    fact = _activity(spark, sf_dir)
    load_days(fact, target)
    day = F.col("snapshot_date")
    changed = fact.where((day >= F.lit(_DAY)) & (F.col("n_events") >= 3)).withColumn("n_events", F.col("n_events") + 100)
    added = fact.where(day == F.lit(_DAY)).withColumn("appid", F.col("appid") + 1_000_000)
    for _ in range(2):
        merge_rows(changed.unionByName(added), target)
    return read_table(spark, target)


@query("q_trend_incremental", s.TREND)
def trend_incremental(spark, sf_dir):
    """The trend after three loads of the daily fact, each worked out from its own days and the carried row per title."""
    daily, trend = (scratch_dir(spark, n) for n in ("daily", "trend"))
    # Dealing out days by range reads its rows twice, so no load gets the fact as a plan that is yet to be worked out.
    fact = stored(gold.fct_games_daily(spark, sf_dir), "fact")
    for upto in ("1994-06-01", str(_CUT), "9999-01-01"):
        load_days(fact.where(F.col("snapshot_date") <= F.lit(upto).cast("date")), daily)
        update_trend(read_table(spark, daily), trend)
    return read_table(spark, trend)


@query("q_stream_intake", f"WITH {_ACTIVITY} SELECT * FROM activity")
def stream_intake(spark, sf_dir):
    """Two runs over a landing folder of event files: the second takes the files that have come since."""
    events = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "activity", "intake"))
    for part in (F.col("day") <= F.lit(_DAY), F.col("day") > F.lit(_DAY)):
        events.where(part).drop("day").write.mode("append").parquet(landing)
        intake(spark, landing, target, events.drop("day").schema, checkpoint, transform=_per_day)
    return read_table(spark, target)


@query("q_stream_merge", f"""WITH {_ACTIVITY}
SELECT * REPLACE (CASE WHEN snapshot_date = DATE '{_DAY}' THEN n_events + 100 ELSE n_events END AS n_events) FROM activity""")
def stream_merge(spark, sf_dir):
    """CSV files of activity; a later file corrects one day and is merged by key."""
    fact = stored(_activity(spark, sf_dir))
    landing, target, checkpoint = (scratch_dir(spark, n) for n in ("landing", "activity", "intake"))
    late = fact.where(F.col("snapshot_date") == F.lit(_DAY)).withColumn("n_events", F.col("n_events") + 100)
    for rows in (fact, late):
        rows.write.mode("append").option("header", True).csv(landing)
        intake(spark, landing, target, fact.schema, checkpoint, file_format="csv", merge=True, header=True)
    return read_table(spark, target)


@query("q_lost_load", f"WITH {_ACTIVITY} SELECT * FROM activity WHERE snapshot_date <= DATE '{_DAY}'")
def lost_load(spark, sf_dir):
    """A load that is lost between its data and its commit, with other columns too: readers see the table before it, whole."""
    target = scratch_dir(spark, "activity")
    fact = stored(_activity(spark, sf_dir))
    load_days(fact.where(F.col("snapshot_date") <= F.lit(_DAY)), target)

    def stop(load):
        raise InterruptedError(load)

    try:
        write_load(fact.withColumn("more", F.lit(1)).drop("n_events"), target, table_state(spark, target), before_commit=stop)
    except InterruptedError:
        return read_table(spark, target)


@query("q_unique_growing", """
SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, 'unique' AS check_name, count(*) AS n_failed FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'o_custkey', 'unique', count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'pair', 'unique', count(*) FROM (SELECT o_custkey, o_totalprice FROM orders GROUP BY ALL HAVING count(*) > 1)""")
def unique_growing(spark, sf_dir):
    """Uniqueness of a table loaded in five steps, each of which looks at its own days and what a filter of the earlier ones lets through."""
    pair = F.concat_ws("|", F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", pair.alias("pair"), F.trunc(F.col("o_orderdate").cast("date"), "YEAR").alias("snapshot_date"),
    )
    root, found, columns = scratch_dir(spark, "orders"), scratch_dir(spark, "repeated"), ["o_orderkey", "o_custkey", "pair"]
    write_days(orders, root, id_col="o_orderkey")
    for upto in ("1993-01-01", "1994-01-01", "1995-01-01", "1997-01-01", "9999-01-01"):
        update_unique(spark.read.parquet(root).where(F.col("snapshot_date") <= F.lit(upto).cast("date")), found, columns)
    return unique_report(spark, found, columns, "orders")


@query("q_ledger", """
SELECT 'orders' AS table_name, CAST(max(o_orderdate) AS DATE) AS processed_date FROM orders
UNION ALL SELECT 'events', CAST(min(ts) AS DATE) FROM events""")
def ledger(spark, sf_dir):
    """Two runs at a time: the older day comes last and changes nothing, and a run that has read before the other's entry is refused."""
    path = scratch_dir(spark, "ledger")
    first, last = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    seen = last_processed(spark, path, "orders")
    for day in (last, first):
        mark_processed(spark, path, "orders", day)
    earliest, latest = table(spark, sf_dir, "events").agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    mark_processed(spark, path, "events", latest)
    mark_processed(spark, path, "events", earliest, expected=latest, back=True)
    try:
        mark_processed(spark, path, "orders", "2100-01-01", expected=seen)
    except LostRace:
        return read_ledger(spark, path)
