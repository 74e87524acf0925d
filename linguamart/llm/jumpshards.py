"""Sharding by jump consistent hashing: no ring table, and a new last shard takes rows only into itself."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import saved

DRAWS = 1 << 31


def jump_shard(key, shards):
    """Shard 0 to ``shards`` - 1 of a key column.

    From bucket b a key jumps to floor((b + 1) / r), r in (0, 1], until it leaves the range; the last bucket inside is
    its shard. r is a hash of key and b alone, so the path is the same for any number of shards. A null key has one shard.
    """
    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def jump(state, _):
        drawn = F.shiftrightunsigned(F.xxhash64(key, state["j"]), 33) + 1
        further = F.floor((state["j"] + 1).cast("double") * DRAWS / drawn.cast("double")).cast("long")
        gone = state["j"] >= shards
        return F.struct(
            F.when(gone, state["b"]).otherwise(state["j"]).alias("b"), F.when(gone, state["j"]).otherwise(further).alias("j"),
        )

    # Each jump moves at least one bucket on, so this many steps always end it.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, jump, lambda s: s["b"]).cast("int")


def place_rows(df, key, shards):
    """``df`` with shard and grown_shard (with one shard more)."""
    return df.withColumns({"shard": jump_shard(key, shards), "grown_shard": jump_shard(key, shards + 1)})


def with_slots(placed, order):
    """Adds slot, 0 without gaps in each shard.

    A row's slot is the number of rows of its shard in earlier partitions of the input plus its rank in its own, so no
    task holds more of a shard than one input partition brings, whatever the keys; only counts meet by shard. Rows equal
    in ``order`` are numbered in any order.
    """
    placed = saved(placed.withColumn("part", F.spark_partition_id()), "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
    )
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order))
    return placed.withColumn("rank", rank).join(firsts, ["shard", "part"]).withColumn("slot", F.col("first") + F.col("rank") - 1).drop(
        "first", "rank", "part",
    )


def shard_documents(docs, shards=16, id_col="doc_id", text_col="text"):
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty (crc32 0). Rows without an id share one shard.
    Repeated rows stay, each with its own slot. Other columns are not looked at. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
    )
    placed = with_slots(place_rows(rows, F.col("doc_id"), shards), [F.asc("doc_id"), F.asc("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs, placed, path, id_col="doc_id"):
    """Write whole rows of ``docs`` under ``shard=`` folders of ``path``; ids have to be unique and present."""
    home = placed.select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows = docs.withColumn("_row", F.struct("*")).select("_row")
    joined = rows.join(home, F.col(f"_row.{id_col}") == home["_id"]).select("_row", F.col("_shard").alias("shard"), "_slot")
    joined.repartition("shard", F.floor(F.col("_slot") / 100_000)).sortWithinPartitions("shard", "_slot").select(
        F.col("_row").alias("row"), F.col("_slot").alias("slot"), "shard",
    ).write.partitionBy("shard").parquet(path)
