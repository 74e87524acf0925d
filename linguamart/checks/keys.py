"""One row per key, top lists, semi joins."""

from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..operators import best_per_key, keep_listed, latest_per_key, top_n_distinct
from .registry import query, table
from .standins import RAW_STORE, raw_store, sql


@query("q_first_in_order", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def first_in_order(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return best_per_key(events, ["user_id"], ["event_id"])


@query("q_best_per_key", """
SELECT user_id, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS LAST, event_id) = 1""")
def best_value(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return best_per_key(events, ["user_id"], [F.desc_nulls_last("value"), "event_id"])


@query("q_top_n_distinct", """
SELECT user_id, event_id FROM (
  SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
ORDER BY event_id LIMIT 50""")
def top_users(spark, sf_dir):
    return top_n_distinct(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 50)


@query("q_latest_per_key", """
SELECT user_id, event_id, ts FROM events WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")
def latest_event(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts", "event_id")


@query("q_latest_per_key_day", sql(RAW_STORE, select="""
SELECT appid, snapshot_date, file_path, languages FROM raw_store
QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY file_path DESC) = 1"""))
def latest_file(spark, sf_dir):
    raw = raw_store(spark, sf_dir).select("appid", "snapshot_date", "file_path", "languages")
    return latest_per_key(raw, ["appid", "snapshot_date"], "file_path")


@query("q_semi_top_n", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100)""")
def semi_top_n(spark, sf_dir):
    top = table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(100)
    ids = top.select(F.col("c_custkey").alias("o_custkey"))
    return keep_listed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ids, "o_custkey")


@query("q_language_key", """
SELECT DISTINCT md5(CAST(p_size AS VARCHAR) || '|' || lower(p_brand)) AS language_key, p_size, p_brand FROM part""")
def language_key(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select(surrogate_key(F.col("p_size"), F.lower("p_brand")).alias("language_key"), "p_size", "p_brand").distinct()
