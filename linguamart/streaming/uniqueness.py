"""Uniqueness of a table that grows by day: a load's keys are held against a Bloom filter, and only suspects against the table."""

import datetime as dt

from pyspark.sql import functions as F

from ..constants import EPOCH_DAY
from ..session import drop_stage, stage
from ..sources.files import DAY
from .incremental import read_table, table_state, write_load

MARK, FILTER, BITS, HELD = "checked_to", "filter", "filter_bits", "filter_keys"
#: Bits of the filter per key that it is made for, hashes per key, and how much larger than needed a filter is made.
BITS_EACH, HASHES, ROOM = 12, 3, 4
_BLOCK = 32_768


def _keys(table, columns, day_col):
    """(column_name, value, day) of every value that is not null."""
    entry = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return table.select(F.col(day_col).alias("day"), F.inline(F.array(*entry))).where("value is not null")


def _places(bits):
    """The bits that a key sets: a block of the filter and a place in it, one for each hash."""
    seen = [F.pmod(F.xxhash64(F.lit(i), "column_name", "value"), F.lit(bits)) for i in range(HASHES)]
    return F.array(*[F.struct(F.floor(x / _BLOCK).cast("long").alias("block"), F.pmod(x, F.lit(_BLOCK)).alias("place")) for x in seen])


def _bitmaps(keys, bits):
    """(block, bitmap) of the bits that ``keys`` set."""
    return keys.select(F.inline(_places(bits))).groupBy("block").agg(F.bitmap_construct_agg("place").alias("bitmap"))


def _is_set(bitmap, place):
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def _suspects(keys, bitmaps, bits):
    """Keys whose bits are all set: all that are in the filter, and few others."""
    asked = keys.select("column_name", "value", F.inline(_places(bits)))
    hit = asked.join(bitmaps, "block").where(_is_set(F.col("bitmap"), F.col("place")))
    # Two hashes may give one place, so the hits are counted against the places a key has.
    hits = hit.groupBy("column_name", "value").agg(F.count_distinct("block", "place").alias("n"))
    return hits.where(F.col("n") == F.size(F.array_distinct(_places(bits)))).select("column_name", "value")


def update_unique(table, target, columns, day_col=DAY):
    """Check the days of ``table`` that are later than the last checked one; what repeats is added to the table at ``target``.

    A value repeats if it comes twice within the new days, or in them and in a day before. The first is seen by grouping
    the new days alone. For the second, the values are held against a Bloom filter of all earlier days (a table of
    bitmaps, joined by block); only those it lets through are joined with the earlier rows, and the join settles it. So a day costs its own keys and
    the filter, and earlier rows are scanned (key columns only) but neither grouped nor moved, as long as suspects are few. Values known to
    repeat are not looked for again. When the keys outgrow the filter, a larger one is built from the earlier days.
    """
    spark = table.sparkSession
    state = table_state(spark, target, day_col)
    notes = state["notes"]
    mark = dt.date.fromisoformat(notes.get(MARK, EPOCH_DAY))
    fresh = _keys(table.where(F.col(day_col) > F.lit(mark)), columns, day_col)
    path = stage(fresh.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.max("day").alias(day_col)), "new-keys")
    new = spark.read.parquet(path)
    n_new, newest = new.agg(F.count(F.lit(1)), F.max(day_col)).first()
    if not n_new:
        return drop_stage(spark, path)
    earlier = _keys(table.where(F.col(day_col) <= F.lit(mark)), columns, day_col)
    held, bits = notes.get(HELD, 0) + n_new, notes.get(BITS, 0)
    bitmaps = spark.read.schema("block long, bitmap binary").parquet(f"{target}/{notes[FILTER]}") if FILTER in notes else None
    if bits < BITS_EACH * held:
        bits = -(-BITS_EACH * ROOM * held // _BLOCK) * _BLOCK
        bitmaps = _bitmaps(earlier, bits) if FILTER in notes else None
    known = read_table(spark, target, day_col, state).select("column_name", "value") if state["fields"] else None
    repeated = new.where("n > 1").select("column_name", "value")
    staged = [path]
    if bitmaps is not None:
        rest = new.where("n = 1").select("column_name", "value")
        rest = rest.join(known, ["column_name", "value"], "left_anti") if known is not None else rest
        staged.append(stage(_suspects(rest, bitmaps, bits), "suspects"))
        suspects = spark.read.schema("column_name string, value string").parquet(staged[-1])
        # Distinct values are taken before they move, so a value that comes often earlier is sent once per task.
        repeated = repeated.union(earlier.select("column_name", "value").join(suspects, ["column_name", "value"]).distinct())
    if known is not None:
        repeated = repeated.join(known, ["column_name", "value"], "left_anti")
    rows = repeated.join(new.select("column_name", "value", day_col), ["column_name", "value"]).select("column_name", "value", day_col)

    def put_filter(load):
        both = _bitmaps(new, bits)
        both = both.union(bitmaps).groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap")) if bitmaps is not None else both
        both.write.parquet(f"{target}/_{FILTER}/{load}")

    kept = lambda load: {MARK: str(newest), FILTER: f"_{FILTER}/{load}", BITS: bits, HELD: held}
    write_load(rows, target, state, day_col, "value", kept, put_filter)
    drop_stage(spark, *staged)


def unique_report(spark, target, columns, table_name="", day_col=DAY):
    """The rows of ``check_unique`` for the days checked so far, from what has been found alone."""
    found = read_table(spark, target, day_col)
    counts = found.agg(*[F.count_if(F.col("column_name") == c).alias(c) for c in columns])
    entry = lambda c: F.struct(
        F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"), F.lit("unique").alias("check_name"), F.col(c).alias("n_failed"),
    )
    return counts.select(F.inline(F.array(*[entry(c) for c in columns])))
