"""Daily loads, step by step."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from linguamart.sources import LostRace, write_days
from linguamart.streaming import drop_unused, high_water, load_days, load_new_days, merge_rows, read_table, replace_days, table_days

from linguamart.streaming.incremental import table_state, write_load


def fact(spark, *records):
    return spark.createDataFrame(list(records), "appid long, d string, ccu long").select(
        "appid", F.col("d").cast("date").alias("snapshot_date"), "ccu"
    )


def state(spark, target):
    return sorted((r.appid, str(r.snapshot_date)[5:], r.ccu) for r in read_table(spark, target).collect())


def test_sequence(spark, tmp_path):
    target = str(tmp_path / "t")
    assert high_water(spark, target) == dt.date(1900, 1, 1) and table_days(spark, target) == []
    load_new_days(fact(spark, (1, "2024-05-01", 1), (1, "2024-05-02", 2)), target)
    first = [(1, "05-01", 1), (1, "05-02", 2)]
    assert state(spark, target) == first
    load_new_days(fact(spark, (1, "2024-04-30", 9)), target)
    assert state(spark, target) == first
    step = fact(spark, (1, "2024-05-02", 22), (1, "2024-05-03", 3))
    for _ in range(2):
        load_new_days(step, target)
        assert state(spark, target) == first + [(1, "05-03", 3)]
    for _ in range(2):
        load_days(fact(spark, (1, "2024-05-01", 11), (2, "2024-05-02", 22)), target, dates=["2024-05-02"])
        assert state(spark, target) == [(1, "05-01", 1), (1, "05-03", 3), (2, "05-02", 22)]
    assert table_days(spark, target) == [dt.date(2024, 5, d) for d in (1, 2, 3)]


def test_columns_follow_the_last_load(spark, tmp_path):
    target = str(tmp_path / "t")
    load_new_days(fact(spark, (1, "2024-05-01", 1)), target)
    wide = fact(spark, (1, "2024-05-02", 2)).withColumn("extra", F.lit("x")).drop("ccu")
    load_new_days(wide, target)
    table = read_table(spark, target)
    assert "ccu" not in table.columns
    assert {str(r.snapshot_date): r.extra for r in table.collect()} == {"2024-05-01": None, "2024-05-02": "x"}
    # Backfilling an old day under newer columns shows them for that day too.
    replace_days(fact(spark, (1, "2024-05-01", 1)).withColumn("extra", F.lit("old")).drop("ccu"), target, ["2024-05-01"])
    assert {r.extra for r in read_table(spark, target).collect()} == {"old", "x"}


def test_folder_of_days_without_commits(spark, tmp_path):
    """A folder that something else has laid out by day is taken over as it is, and loads go on top of it."""
    target = str(tmp_path / "t")
    write_days(fact(spark, (1, "2024-05-01", 1), (2, "2024-05-01", 2), (1, "2024-05-02", 3)), target)
    before = [(1, "05-01", 1), (1, "05-02", 3), (2, "05-01", 2)]
    assert state(spark, target) == before and high_water(spark, target) == dt.date(2024, 5, 2)
    load_new_days(fact(spark, (1, "2024-05-02", 9), (1, "2024-05-03", 4)), target)
    assert state(spark, target) == sorted(before + [(1, "05-03", 4)])
    merge_rows(fact(spark, (2, "2024-05-01", 20)), target)
    assert state(spark, target) == [(1, "05-01", 1), (1, "05-02", 3), (1, "05-03", 4), (2, "05-01", 20)]
    drop_unused(spark, target)
    assert state(spark, target) == [(1, "05-01", 1), (1, "05-02", 3), (1, "05-03", 4), (2, "05-01", 20)]
    assert not os.path.exists(f"{target}/snapshot_date=2024-05-01") and os.path.exists(f"{target}/snapshot_date=2024-05-02")


def test_merge_updates_adds_and_keeps(spark, tmp_path):
    target = str(tmp_path / "t")
    merge_rows(fact(spark, (1, "2024-05-01", 1), (2, "2024-05-01", 2), (1, "2024-05-02", 3)), target)
    change = fact(spark, (2, "2024-05-01", 20), (3, "2024-05-01", 30), (1, "2024-05-03", 4))
    for _ in range(2):
        merge_rows(change, target)
        assert state(spark, target) == [
            (1, "05-01", 1), (1, "05-02", 3), (1, "05-03", 4), (2, "05-01", 20), (3, "05-01", 30)
        ]
    merge_rows(change.where("false"), target)
    assert len(state(spark, target)) == 5


def test_days_one_by_one_equal_all_at_once(spark, tmp_path):
    every = fact(spark, *[(a, f"2024-05-0{d}", a * d) for a in range(4) for d in range(1, 5)])
    for d in range(1, 5):
        load_new_days(every.where(F.col("snapshot_date") <= F.lit(f"2024-05-0{d}")), str(tmp_path / "steps"))
    load_new_days(every, str(tmp_path / "once"))
    assert state(spark, str(tmp_path / "steps")) == state(spark, str(tmp_path / "once"))


def test_column_removed_and_added_again(spark, tmp_path, rows):
    """Old days do not show what they held under the name of a column that went and came back."""
    target = str(tmp_path / "t")
    full = "appid long, price double, snapshot_date date"
    load_days(spark.createDataFrame([(1, 1.5, dt.date(2024, 5, 1))], full), target)
    load_days(spark.createDataFrame([(1, dt.date(2024, 5, 2))], "appid long, snapshot_date date"), target)
    assert read_table(spark, target).columns == ["appid", "snapshot_date"]
    load_days(spark.createDataFrame([(1, 2.5, dt.date(2024, 5, 3))], full), target)
    assert rows(read_table(spark, target), "snapshot_date", "price") == [
        (dt.date(2024, 5, 1), None), (dt.date(2024, 5, 2), None), (dt.date(2024, 5, 3), 2.5),
    ]
    load_days(spark.createDataFrame([(1, 3.5, dt.date(2024, 5, 4))], full), target)
    assert rows(read_table(spark, target).where("price > 2"), "price") == [(2.5,), (3.5,)]


def test_column_of_another_type(spark, tmp_path, rows):
    target = str(tmp_path / "t")
    load_days(spark.createDataFrame([(1, 7, dt.date(2024, 5, 1))], "appid long, rank int, snapshot_date date"), target)
    load_days(spark.createDataFrame([(1, "high", dt.date(2024, 5, 2))], "appid long, rank string, snapshot_date date"), target)
    table = read_table(spark, target)
    assert dict(table.dtypes)["rank"] == "string" and rows(table, "rank") == [("7",), ("high",)]
    load_days(spark.createDataFrame([(1, 9.5, dt.date(2024, 5, 3))], "appid long, rank double, snapshot_date date"), target)
    assert sorted(map(str, (r[0] for r in read_table(spark, target).select("rank").collect()))) == ["7.0", "9.5", "None"]


def test_merge_refuses_repeated_keys(spark, tmp_path):
    twice = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (1, dt.date(2024, 5, 1))], "appid long, snapshot_date date")
    with pytest.raises(ValueError, match="repeat a key"):
        merge_rows(twice, str(tmp_path / "t"))


class Stopped(Exception):
    pass


def stop(load):
    raise Stopped


def test_load_lost_before_its_commit(spark, tmp_path):
    """Between the data and the commit nothing shows: rows, days and columns are those before; the next load goes on from there."""
    target = str(tmp_path / "t")
    load_new_days(fact(spark, (1, "2024-05-01", 1), (1, "2024-05-02", 2)), target)
    before, columns = state(spark, target), read_table(spark, target).columns
    change = fact(spark, (7, "2024-05-02", 70), (7, "2024-05-03", 71)).withColumn("extra", F.lit("x")).withColumn("ccu", F.col("ccu").cast("string"))
    with pytest.raises(Stopped):
        write_load(change, target, table_state(spark, target), before_commit=stop)
    assert state(spark, target) == before and read_table(spark, target).columns == columns
    assert high_water(spark, target) == dt.date(2024, 5, 2)
    load_new_days(fact(spark, (1, "2024-05-03", 3)), target)
    assert state(spark, target) == before + [(1, "05-03", 3)]
    lost = [n for n in os.listdir(target) if n.startswith("load=")]
    drop_unused(spark, target)
    assert len([n for n in os.listdir(target) if n.startswith("load=")]) == len(lost) - 1
    assert state(spark, target) == before + [(1, "05-03", 3)]
    assert len([n for n in os.listdir(f"{target}/_commits") if n.endswith(".json") and not n.startswith(".")]) == 1


def test_first_load_lost(spark, tmp_path):
    target = str(tmp_path / "t")
    with pytest.raises(Stopped):
        write_load(fact(spark, (1, "2024-05-01", 1)), target, table_state(spark, target), before_commit=stop)
    assert table_days(spark, target) == [] and read_table(spark, target).count() == 0
    load_new_days(fact(spark, (1, "2024-05-01", 2)), target)
    assert state(spark, target) == [(1, "05-01", 2)]


def test_two_writers(spark, tmp_path):
    """Different days are both kept; of the same day the second writer is refused and leaves nothing behind."""
    target = str(tmp_path / "t")
    load_new_days(fact(spark, (1, "2024-05-01", 1)), target)
    seen = table_state(spark, target)
    replace_days(fact(spark, (1, "2024-05-02", 2)), target, ["2024-05-02"])
    write_load(fact(spark, (1, "2024-05-03", 3)), target, seen)
    assert state(spark, target) == [(1, "05-01", 1), (1, "05-02", 2), (1, "05-03", 3)]
    folders = len(os.listdir(target))
    for late in (fact(spark, (1, "2024-05-02", 99)), fact(spark, (1, "2024-05-02", 99), (1, "2024-05-09", 1))):
        with pytest.raises(LostRace):
            write_load(late, target, seen)
    assert len(os.listdir(target)) == folders
    other = table_state(spark, target)
    load_new_days(fact(spark, (1, "2024-05-04", 4)).withColumn("more", F.lit(1)), target)
    with pytest.raises(LostRace):
        write_load(fact(spark, (1, "2024-05-05", 5)), target, other)
    assert [r.more for r in read_table(spark, target).where("snapshot_date = '2024-05-04'").collect()] == [1]


def test_readers_keep_the_state_they_began_with(spark, tmp_path):
    target = str(tmp_path / "t")
    load_new_days(fact(spark, (1, "2024-05-01", 1)), target)
    reader = read_table(spark, target)
    replace_days(fact(spark, (1, "2024-05-01", 100)), target, ["2024-05-01"])
    assert [r.ccu for r in reader.collect()] == [1] and state(spark, target) == [(1, "05-01", 100)]


def test_merge_of_null_keys(spark, tmp_path):
    """A row without an id is updated like others, not added again; rows without a day are left out."""
    target = str(tmp_path / "t")
    rows = fact(spark, (None, "2024-05-01", 1), (2, "2024-05-01", 2), (3, None, 3))
    for _ in range(2):
        merge_rows(rows, target)
    merge_rows(fact(spark, (None, "2024-05-01", 10)), target)
    assert sorted((r.appid is None, r.ccu) for r in read_table(spark, target).collect()) == [(False, 2), (True, 10)]


def test_day_filter_reaches_the_folders(spark, tmp_path):
    target = str(tmp_path / "t")
    for d in range(1, 5):
        load_new_days(fact(spark, (1, f"2024-05-0{d}", d)), target)
    one = read_table(spark, target).where("snapshot_date = DATE'2024-05-03'")
    assert [r.ccu for r in one.collect()] == [3]
    text = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in text
