"""Statistics that can be merged: one row of sketches per day and column, and any range of days from those rows alone."""

from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, NumericType, ShortType

#: Distinct counts: 2 ** LOG_SIZE counters. A merged estimate is off by DISTINCT_ERROR at most in 99.7 of 100 cases (three standard errors of 1.04 / sqrt).
LOG_SIZE = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_SIZE / 2)
#: Quantiles: the size of a sketch. The rank of an answer is off by RANK_ERROR of all rows at most in 99 of 100 cases.
RANK_SIZE = 400
RANK_ERROR = 0.01

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _told_apart(field):
    """A column as what the distinct sketch takes: whole numbers as they are, others by their text; -0.0 is 0.0."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _WHOLE):
        return col.cast("long")
    if isinstance(field.dataType, (DoubleType, FloatType)):
        return F.when(col == 0, F.lit("0")).otherwise(col.cast("string"))
    return col.cast("string")


def day_sketches(df, columns=None, day_col="snapshot_date"):
    """(day, column_name, n_rows, n_nulls, distinct_sketch, quantile_sketch) of each column, in one pass over ``df``.

    Sketches are merged on the map side, so a day with a third of all rows sends as little as any other. Columns that are
    no numbers have no quantile sketch; NaN is left out of it.
    """
    columns = [c for c in (columns or df.columns) if c != day_col]
    fields = [df.schema[c] for c in columns]

    def stats(field):
        col = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, NumericType)
        value = col.cast("double") if number else F.lit(None).cast("double")
        return F.struct(
            F.lit(field.name).alias("column_name"), F.count(F.lit(1)).alias("n_rows"), F.count_if(col.isNull()).alias("n_nulls"),
            F.hll_sketch_agg(_told_apart(field), F.lit(LOG_SIZE)).alias("distinct_sketch"),
            (F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(RANK_SIZE)) if number else F.first(F.lit(None).cast("binary"))).alias("quantile_sketch"),
        ).alias(field.name)

    rows = df.groupBy(day_col).agg(*[stats(f) for f in fields])
    return rows.select(day_col, F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def distinct_estimates(sketches, by=()):
    """(by..., column_name, n_rows, n_nulls, n_distinct) over the days that ``sketches`` holds; distinct values as an estimate."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
    )


def quantile_estimates(sketches, probs, by=()):
    """(by..., column_name, prob, quantile) over the days that ``sketches`` holds, for columns of numbers with any value."""
    merged = sketches.where("quantile_sketch is not null").groupBy(*by, "column_name").agg(F.kll_merge_agg_double("quantile_sketch").alias("s"))
    filled = merged.where(F.kll_sketch_get_n_double("s") > 0)
    at = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("s", F.lit(float(p))).alias("quantile")) for p in probs])
    return filled.select(*by, "column_name", F.inline(at))
