"""Checks on table contents. Every check is a row (table_name, column_name, check_name, n_failed)."""

from functools import reduce

from pyspark.sql import functions as F


def _report(table, column, check, failed):
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"), failed.cast("long").alias("n_failed"),
    )


def check_not_null(df, columns, table=""):
    """Null count of every named column, all in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[_report(table, c, "not_null", F.col(c)) for c in columns])
    return counts.select(F.inline(rows))


def check_unique(df, columns, table=""):
    """Number of non-null values that occur more than once, per named column, all in one pass."""
    entry = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    values = df.select(F.inline(F.array(*entry))).where("v is not null").groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    repeated = values.agg(*[F.count_if((F.col("c") == c) & (F.col("n") > 1)).alias(c) for c in columns])
    return repeated.select(F.inline(F.array(*[_report(table, c, "unique", F.col(c)) for c in columns])))


def run_checks(tables, spec):
    """``spec`` maps a table to {"not_null": [...], "unique": [...]}; one report over all tables."""
    parts = []
    for name, checks in spec.items():
        if checks.get("not_null"):
            parts.append(check_not_null(tables[name], checks["not_null"], name))
        if checks.get("unique"):
            parts.append(check_unique(tables[name], checks["unique"], name))
    return reduce(lambda a, b: a.unionByName(b), parts)


def popularity_warnings(df, bands, counters, owners="owners", key="appid"):
    """One row of data warnings: owner texts outside the bands, negative counters, surplus rows per key."""
    from .columns import recode

    known = recode(F.col(owners), bands)
    negatives = reduce(lambda a, b: a + b, [F.count_if(F.col(c) < 0) for c in counters])
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count_if(F.col(owners).isNotNull() & known.isNull()).alias("__unmapped"),
        negatives.alias("__negative"),
    )
    return per_key.agg(
        F.coalesce(F.sum("__unmapped"), F.lit(0)).alias("unmapped_owners"),
        F.coalesce(F.sum("__negative"), F.lit(0)).alias("negative_values"),
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("duplicate_rows"),
    )
