"""Column profile of a table, exact and without gathering a column anywhere."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import stage


def null_counts(df):
    """One row per column: how many nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in df.columns
    ])
    return counts.select(F.inline(rows))


def flag_counts(df, flag):
    """Rows where the flag holds, and where it does not."""
    return df.agg(F.count_if(F.col(flag)).alias("n_true"), F.count_if(~F.col(flag)).alias("n_false"))


def distinct_values(df, col):
    """Sorted distinct values as rows, so that a column of any cardinality fits."""
    return df.select(col).distinct().orderBy(col)


def _numeric(df):
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def value_quantiles(df, value, probs, by=()):
    """Exact quantiles with linear interpolation, as rows (by..., prob, quantile).

    Values are counted, and their counts dealt out in the order of group and value. The count before each part follows
    from the sums of the parts alone; ranks are then looked up only in the parts that hold one. No task sees more of a
    group than its part, and Infinity and NaN sort like any value (NaN last).
    """
    by = list(by)
    group = (F.struct(*[F.col(c) for c in by]) if by else F.lit(0)).alias("__g")
    counts = df.where(F.col(value).isNotNull()).groupBy(group, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return count_quantiles(counts, probs).select(*[F.col("__g")[c].alias(c) for c in by], "prob", "quantile")


def count_quantiles(counts, probs):
    """(__g, prob, quantile) of values that are already counted: rows (__g, __v, __n)."""
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartitionByRange(parts, "__g", "__v").withColumn("__part", F.spark_partition_id())
    # Stored, so that both uses see the same parts.
    dealt = spark.read.schema(dealt.schema).parquet(stage(dealt, "counts"))
    whole = Window.partitionBy("__g")
    sums = dealt.groupBy("__g", "__part").agg(F.sum("__n").alias("within")).select(
        "__g", "__part", "within", F.sum("within").over(whole).alias("total"),
        (F.sum("within").over(whole.orderBy("__part")) - F.col("within")).alias("before"),
    )

    def wanted(total, start, end):
        """The ranks (from 0) around each probability that lie in [start, end)."""
        def around(p):
            at = F.lit(float(p)) * (total - 1)
            return [
                F.struct(F.lit(float(p)).alias("prob"), at.alias("at"), edge(at).cast("long").alias("rank"))
                for edge in (F.floor, F.ceil)
            ]

        ranks = F.array_distinct(F.array(*[r for p in probs for r in around(p)]))
        return F.filter(ranks, lambda r: (r["rank"] >= start) & (r["rank"] < end))

    asked = sums.where(F.size(wanted(F.col("total"), F.col("before"), F.col("before") + F.col("within"))) > 0)
    upto = F.sum("__n").over(Window.partitionBy("__g", "__part").orderBy("__v"))
    placed = dealt.join(asked.drop("within"), ["__g", "__part"]).withColumn("__end", F.col("before") + upto)
    hits = placed.select("__g", "__v", F.inline(wanted(F.col("total"), F.col("__end") - F.col("__n"), F.col("__end"))))
    low, high = F.min_by("__v", "rank"), F.max_by("__v", "rank")
    share = F.max("at") - F.min("rank")
    # Where the rank is whole there is nothing between: Infinity - Infinity would be NaN.
    return hits.groupBy("__g", "prob").agg(F.when((share == 0) | (low == high), low).otherwise(low + (high - low) * share).alias("quantile"))


def column_profile(df):
    """One row per column: type, rows, nulls, distinct values, and for numbers the usual moments and quartiles."""
    numbers = set(_numeric(df))
    types = dict(df.dtypes)

    def stats(c):
        col = F.col(c)
        if c in numbers:
            value = col.cast("double")
            moments = (F.avg(value), F.stddev_samp(value), F.min(value), F.max(value))
        else:
            moments = tuple(F.first(F.lit(None).cast("double")) for _ in range(4))
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
            F.count(F.lit(1)).alias("n_rows"), F.count_if(col.isNull()).alias("n_nulls"),
            moments[0].alias("mean_value"), moments[1].alias("std_value"),
            moments[2].alias("min_value"), moments[3].alias("max_value"),
        ).alias(c)

    base = df.agg(*[stats(c) for c in df.columns]).select(F.inline(F.array(*[F.col(c) for c in df.columns])))

    # Every value of every column once, with its number of rows; texts and numbers side by side. Distinct values and
    # quartiles both come from these counts.
    entry = [
        F.struct(
            # Decimals keep their digits for the count of distinct values; as doubles long ones would merge.
            F.lit(c).alias("column_name"), (F.lit(None) if c in numbers and not types[c].startswith("decimal") else F.col(c)).cast("string").alias("text"),
            (F.col(c) if c in numbers else F.lit(None)).cast("double").alias("number"), F.col(c).isNotNull().alias("given"),
            (F.col(c) if types[c] == "bigint" else F.lit(None)).cast("long").alias("whole"),
        ) for c in df.columns
    ]
    values = df.select(F.inline(F.array(*entry))).where("given").groupBy("column_name", "text", "number", "whole").agg(F.count(F.lit(1)).alias("__n"))
    values = df.sparkSession.read.schema(values.schema).parquet(stage(values, "values"))
    distinct = values.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    out = base.join(distinct, "column_name", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    if not numbers:
        return out
    counted = values.where(F.col("number").isNotNull()).groupBy(F.col("column_name").alias("__g"), F.col("number").alias("__v")).agg(F.sum("__n").alias("__n"))
    quartiles = count_quantiles(counted, [0.25, 0.5, 0.75]).groupBy(F.col("__g").alias("column_name")).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ])
    return out.join(quartiles, "column_name", "left")
