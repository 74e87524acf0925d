"""Data checks and column profiles."""

from pyspark.sql import functions as F

from ..operators import (
    check_not_null, check_unique, column_profile, day_sketches, distinct_estimates, distinct_values, flag_counts, null_counts, quantile_estimates, run_checks,
    value_quantiles,
)
from ..operators.sketches import DISTINCT_ERROR, RANK_ERROR
from ..plans import marts
from ..session import scratch_dir, stored
from ..streaming import load_days, read_table
from . import gold
from . import standins as s
from .registry import query, table


@query("q_dq_not_null", """
SELECT 'lineitem' AS table_name, 'l_orderkey' AS column_name, 'not_null' AS check_name, CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS n_failed FROM lineitem
UNION ALL SELECT 'lineitem', 'open_date', 'not_null', CAST(count(*) FILTER (WHERE l_linestatus <> 'O') AS BIGINT) FROM lineitem""")
def dq_not_null(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("open_date", F.when(F.col("l_linestatus") == "O", F.col("l_shipdate")))
    return check_not_null(lines, ["l_orderkey", "open_date"], "lineitem")


@query("q_dq_unique", """
SELECT 'orders' AS table_name, 'o_orderkey' AS column_name, 'unique' AS check_name, count(*) AS n_failed FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'o_custkey', 'unique', count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)""")
def dq_unique(spark, sf_dir):
    return check_unique(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], "orders")


def _sql_not_null(name, col):
    return f"SELECT '{name}' AS table_name, '{col}' AS column_name, 'not_null' AS check_name, CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS n_failed FROM {name}"


def _sql_unique(name, col):
    return f"SELECT '{name}', '{col}', 'unique', count(*) FROM (SELECT {col} FROM {name} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


_MART_SQL = " UNION ALL ".join(
    [_sql_not_null(t, c) for t, spec in marts.CHECKS.items() for c in spec.get("not_null", [])]
    + [_sql_unique(t, c) for t, spec in marts.CHECKS.items() for c in spec.get("unique", [])]
)


@query("q_dq_marts", s.sql(
    *s.BASE_FACT, s.LANGUAGE_TOKENS, s.STAGING_LANGUAGES, s.DIM_LANGUAGES, s.DIM_GENRES,
    s.STORE_DAILY, s.POPULARITY_DAILY, s.FCT_DAILY, select=_MART_SQL,
))
def dq_marts(spark, sf_dir):
    """All declared checks on all staging views and marts. The language key is known not to be unique."""
    # A table that both kinds of check read is worked out once, in the columns that they read.
    tables = dict(zip(marts.CHECKS, gold.built(spark, sf_dir, *marts.CHECKS)))
    for name in ("fct_games", "dim_languages"):
        tables[name] = stored(tables[name].select(*dict.fromkeys(c for columns in marts.CHECKS[name].values() for c in columns)), name)
    return run_checks(tables, marts.CHECKS)


@query("q_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_nulls FROM raw"
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props", "amount")
).join(["WITH raw AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS amount FROM events) ", ""]))
def nulls(spark, sf_dir):
    amount = F.when(F.col("event_type") != "error", F.col("value"))
    return null_counts(table(spark, sf_dir, "events").withColumn("amount", amount))


@query("q_distinct_values", "SELECT DISTINCT p_brand FROM part")
def brands(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "part"), "p_brand")


@query("q_distinct_count", "SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM events")
def distinct_count(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct("event_type").alias("n_types"))


@query("q_flag_counts", """
SELECT CAST(count(*) FILTER (WHERE value > 10) AS BIGINT) AS n_true, CAST(count(*) FILTER (WHERE NOT value > 10) AS BIGINT) AS n_false FROM events""")
def flags(spark, sf_dir):
    return flag_counts(table(spark, sf_dir, "events").withColumn("large", F.col("value") > 10), "large")


@query("q_value_quantiles", """
SELECT l_returnflag, prob, round(CASE prob WHEN 0.0 THEN min(l_extendedprice) WHEN 0.1 THEN quantile_cont(l_extendedprice, 0.1)
       WHEN 0.5 THEN quantile_cont(l_extendedprice, 0.5) WHEN 0.99 THEN quantile_cont(l_extendedprice, 0.99) ELSE max(l_extendedprice) END, 4) AS quantile
FROM lineitem, (SELECT CAST(unnest([0.0, 0.1, 0.5, 0.99, 1.0]) AS DOUBLE) AS prob) GROUP BY l_returnflag, prob""")
def quantiles(spark, sf_dir):
    rows = value_quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice", [0.0, 0.1, 0.5, 0.99, 1.0], ["l_returnflag"])
    return rows.withColumn("quantile", F.round("quantile", 4))


def _sql_profile(col, kind, number):
    moments = ", ".join(
        f"round({f}, 4) AS {n}" if number else f"CAST(NULL AS DOUBLE) AS {n}"
        for f, n in (
            (f"avg({col})", "mean_value"), (f"stddev_samp({col})", "std_value"),
            (f"CAST(min({col}) AS DOUBLE)", "min_value"), (f"CAST(max({col}) AS DOUBLE)", "max_value"),
            (f"quantile_cont(CAST({col} AS DOUBLE), 0.25)", "p25"), (f"quantile_cont(CAST({col} AS DOUBLE), 0.5)", "p50"),
            (f"quantile_cont(CAST({col} AS DOUBLE), 0.75)", "p75"),
        )
    )
    return (
        f"SELECT '{col}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows, "
        f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS n_nulls, count(DISTINCT {col}) AS n_distinct, {moments} FROM events"
    )


@query("q_profile", " UNION ALL ".join([
    _sql_profile("event_id", "bigint", True), _sql_profile("ts", "timestamp_ntz", False), _sql_profile("user_id", "bigint", True),
    _sql_profile("event_type", "string", False), _sql_profile("value", "double", True), _sql_profile("props", "string", False),
]))
def profile(spark, sf_dir):
    rows = column_profile(table(spark, sf_dir, "events"))
    rounded = ["mean_value", "std_value", "min_value", "max_value", "p25", "p50", "p75"]
    return rows.withColumns({c: F.round(c, 4) for c in rounded})


_RANGE = ("2024-01-04", "2024-01-20")


def _sketched(spark, sf_dir, source, columns, day):
    """Sketches of a table's days, loaded in two steps into a daily table of their own, and the rows themselves."""
    rows = table(spark, sf_dir, source).withColumn("snapshot_date", day)
    target = scratch_dir(spark, "sketches")
    cut = rows.agg(F.percentile_approx(F.unix_date("snapshot_date"), 0.5)).first()[0]
    for upto in (cut, 1_000_000):
        load_days(day_sketches(rows.where(F.unix_date("snapshot_date") <= upto), columns), target, id_col="column_name")
    return rows, read_table(spark, target)


@query("q_distinct_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, true AS estimate_fits FROM events "
    f"WHERE CAST(ts AS DATE) BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'" for c in ("user_id", "event_id", "event_type", "value")))
def distinct_sketches(spark, sf_dir):
    """Distinct values of a range of days from the sketches of its days, held against the exact numbers."""
    columns = ["user_id", "event_id", "event_type", "value"]
    rows, sketches = _sketched(spark, sf_dir, "events", columns, F.col("ts").cast("date"))
    chosen = F.col("snapshot_date").between(*[F.lit(d).cast("date") for d in _RANGE])
    exact = rows.where(chosen).agg(*[F.countDistinct(c).alias(c) for c in columns])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns])))
    found = distinct_estimates(sketches.where(chosen)).withColumnRenamed("n_distinct", "estimate").join(exact, "column_name")
    fits = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.ceil(F.col("n_distinct") * DISTINCT_ERROR)
    return found.select("column_name", "n_rows", "n_nulls", "n_distinct", fits.alias("estimate_fits"))


_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("q_quantile_sketches", f"""
SELECT 'l_extendedprice' AS column_name, prob, count(l_extendedprice) AS n_values, true AS rank_fits
FROM lineitem, (SELECT CAST(unnest({_PROBS}) AS DOUBLE) AS prob) GROUP BY prob
UNION ALL SELECT 'l_quantity', prob, count(l_quantity), true FROM lineitem, (SELECT CAST(unnest({_PROBS}) AS DOUBLE) AS prob) GROUP BY prob""")
def quantile_sketches(spark, sf_dir):
    """Quantiles of all months from the sketches of each; their ranks in the rows themselves are what was asked for, but for the stated error."""
    columns = ["l_extendedprice", "l_quantity"]
    rows, sketches = _sketched(spark, sf_dir, "lineitem", columns, F.trunc(F.col("l_shipdate").cast("date"), "MM"))
    found = quantile_estimates(sketches, _PROBS)
    values = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])))
    # Ten answers, so each task counts the values around them before anything moves.
    ranked = values.where("value is not null").join(F.broadcast(found), "column_name").groupBy("column_name", "prob").agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("value") < F.col("quantile")).alias("below"), F.count_if(F.col("value") <= F.col("quantile")).alias("upto"),
    )
    low, high = F.col("below") / F.col("n_values") - RANK_ERROR, F.col("upto") / F.col("n_values") + RANK_ERROR
    return ranked.select("column_name", "prob", "n_values", F.col("prob").between(low, high).alias("rank_fits"))
