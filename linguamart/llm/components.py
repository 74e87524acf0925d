"""Connected components by large-star and small-star rounds, in DataFrame operations."""

from pyspark.sql import functions as F

from ..session import drop_stage, stage


def components(edges):
    """(node, component) for every node of ``edges`` (a, b: longs); component is the least node that can be reached.

    Each round links every node's larger neighbours to its least one (large star) and its smaller ones to the least of
    them (small star), by aggregation and joins on the node; no list of neighbours is gathered. Rounds end when the
    edges no longer change, which takes a number of them that grows with the logarithm of the longest chain. Each round's edges are
    written, and those of the round before dropped. Self-links, repeated links and nulls are left out.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, sign, path = _kept(pairs)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Large star leaves links from greater to smaller nodes; small star moves them to the least neighbour.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        last = path
        now, after, path = _kept(moved.where("a <> b").distinct())
        drop_stage(edges.sparkSession, last)
        if after == sign:
            break
        sign = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())


def _kept(pairs):
    """The stored pairs, what tells whether they changed (their number and the sum of their hashes), and where they are."""
    path = stage(pairs, "edges")
    pairs = pairs.sparkSession.read.schema(pairs.schema).parquet(path)
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return pairs, tuple(row), path
