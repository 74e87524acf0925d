"""What is kept up to date as days come in: trend, landed files, uniqueness, sketches, ledger."""

import datetime as dt
import json
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linguamart.operators import check_unique, day_sketches, dense_numbers, distinct_estimates, quantile_estimates
from linguamart.operators.sketches import DISTINCT_ERROR, RANK_ERROR
from linguamart.plans.insights import daily_trend, genre_heatmap, genre_heatmap_by_bitmaps
from linguamart.sources import LostRace, last_processed, mark_processed, read_ledger, write_days
from linguamart.sources.commits import commit, newest
from linguamart.streaming import intake, load_days, read_carried, read_table, table_days, update_trend
from linguamart.streaming import trend as trend_module
from linguamart.streaming.incremental import table_state
from linguamart.streaming.uniqueness import BITS, unique_report, update_unique


def daily(spark, rows):
    schema = "appid long, snapshot_date string, ccu long, total_reviews long, languages long"
    return spark.createDataFrame(rows, schema).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))


def some_days(seed, days, titles=30):
    rng = random.Random(seed)
    return [(a, f"2024-05-{d:02}", rng.choice([None, rng.randint(0, 99)]), rng.randint(0, 9), rng.randint(0, 5)) for d in days for a in range(titles) if rng.random() < 0.6]


def test_trend_day_by_day(spark, tmp_path, rows):
    every = some_days(1, range(1, 9))
    target = str(tmp_path / "trend")
    for upto in (1, 2, 5, 5, 8):
        update_trend(daily(spark, [r for r in every if int(r[1][-2:]) <= upto]), target)
    assert rows(read_table(spark, target)) == rows(daily_trend(daily(spark, every)))
    update_trend(daily(spark, [(1, "2024-05-03", 999, 1, 1)]), target)
    assert rows(read_table(spark, target)) == rows(daily_trend(daily(spark, every)))
    last = {r[0]: r[1] for r in every}
    assert {r.appid: str(r.snapshot_date) for r in read_carried(spark, target).collect()} == last


def test_trend_reads_the_new_day_and_the_carried_rows(spark, tmp_path, rows):
    """With the files of all earlier days gone, the next day still comes out right."""
    every = some_days(2, range(1, 4))
    source, target = str(tmp_path / "daily"), str(tmp_path / "trend")
    write_days(daily(spark, [r for r in every if r[1] < "2024-05-03"]), source)
    update_trend(spark.read.schema(daily(spark, []).schema).parquet(source), target)
    for day in ("01", "02"):
        folder = f"{source}/snapshot_date=2024-05-{day}"
        for name in os.listdir(folder):
            with open(f"{folder}/{name}", "wb") as f:
                f.write(b"no parquet")
            if os.path.exists(f"{folder}/.{name}.crc"):
                os.remove(f"{folder}/.{name}.crc")
    write_days(daily(spark, [r for r in every if r[1] == "2024-05-03"]), source)
    update_trend(spark.read.schema(daily(spark, []).schema).parquet(source), target)
    assert rows(read_table(spark, target)) == rows(daily_trend(daily(spark, every)))


def test_trend_and_carried_rows_switch_together(spark, tmp_path, rows, monkeypatch):
    every = some_days(3, range(1, 4))
    target = str(tmp_path / "trend")
    first = daily(spark, [r for r in every if r[1] < "2024-05-03"])
    update_trend(first, target)
    seen = rows(read_carried(spark, target))

    def lost(df, target, state, day_col, id_col, notes, carry):
        carry("lost")
        raise InterruptedError

    with monkeypatch.context() as m:
        m.setattr(trend_module, "write_load", lost)
        with pytest.raises(InterruptedError):
            update_trend(daily(spark, every), target)
    assert rows(read_table(spark, target)) == rows(daily_trend(first)) and rows(read_carried(spark, target)) == seen
    update_trend(daily(spark, every), target)
    assert rows(read_table(spark, target)) == rows(daily_trend(daily(spark, every)))


def test_intake_takes_each_file_once(spark, tmp_path, rows):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    every = some_days(4, range(1, 7))
    schema = daily(spark, []).schema
    loads = []
    for a, b in ((1, 2), (3, 3), (4, 6)):
        daily(spark, [r for r in every if a <= int(r[1][-2:]) <= b]).repartition(3).write.mode("append").parquet(landing)
        loads.append(intake(spark, landing, target, schema, checkpoint))
        assert intake(spark, landing, target, schema, checkpoint) == 0
    assert loads == [1, 1, 1]
    assert rows(read_table(spark, target)) == rows(daily(spark, every))
    assert table_state(spark, target)["version"] == 3


def test_intake_after_a_crash(spark, tmp_path, rows):
    """The table is switched, but the stream has not noted the batch: it runs again, and adds nothing."""
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    schema = daily(spark, []).schema
    first, second = some_days(5, [1]), some_days(6, [1])
    daily(spark, first).write.parquet(landing)
    intake(spark, landing, target, schema, checkpoint, merge=True, keys=("appid", "snapshot_date", "total_reviews"))
    daily(spark, second).write.mode("append").parquet(landing)
    broken = []

    def transform(batch):
        if not broken:
            broken.append(1)
            raise InterruptedError
        return batch

    with pytest.raises(Exception, match="InterruptedError"):
        intake(spark, landing, target, schema, checkpoint, transform=transform, merge=True)
    assert rows(read_table(spark, target)) == rows(daily(spark, first))
    assert intake(spark, landing, target, schema, checkpoint, merge=True) == 1
    merged = {r[0]: r for r in first} | {r[0]: r for r in second}
    assert rows(read_table(spark, target)) == rows(daily(spark, list(merged.values())))
    os.remove(f"{checkpoint}/commits/1")
    if os.path.exists(f"{checkpoint}/commits/.1.crc"):
        os.remove(f"{checkpoint}/commits/.1.crc")
    assert intake(spark, landing, target, schema, checkpoint, merge=True) == 0
    assert rows(read_table(spark, target)) == rows(daily(spark, list(merged.values())))


def test_intake_of_day_folders_as_csv(spark, tmp_path, rows):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    every = some_days(7, range(1, 5))
    schema = daily(spark, []).schema
    for day in range(1, 5):
        part = daily(spark, [r for r in every if r[1] == f"2024-05-{day:02}"])
        part.write.mode("append").partitionBy("snapshot_date").option("header", True).csv(landing)
        intake(spark, landing, target, schema, checkpoint, file_format="csv", header=True)
    assert rows(read_table(spark, target).select(*schema.names)) == rows(daily(spark, every))


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_by_steps(spark, tmp_path, rows, seed):
    """After each step the report is that of a full regroup; the filter grows on the way."""
    rng = random.Random(seed)
    every = [(rng.choice([None, rng.randint(0, 3_000), 5]), f"k{i}" if rng.random() < 0.99 else "k1", f"2024-05-{rng.randint(1, 9):02}") for i in range(4_000)]
    table = spark.createDataFrame(every, "a long, b string, d string").select("a", "b", F.col("d").cast("date").alias("snapshot_date"))
    target, sizes = str(tmp_path / "found"), []
    for upto in (1, 2, 2, 5, 9):
        part = table.where(F.dayofmonth("snapshot_date") <= upto)
        update_unique(part, target, ["a", "b"])
        sizes.append(table_state(spark, target)["notes"][BITS])
        assert rows(unique_report(spark, target, ["a", "b"], "t")) == rows(check_unique(part, ["a", "b"], "t"))
    assert sizes[-1] > sizes[0]


def test_unique_regroups_no_earlier_row(spark, tmp_path):
    """Days before the last check are scanned for suspects, and neither sorted nor grouped where there are few."""
    table = spark.range(0, 2_000).select("id", F.date_add(F.lit("2024-05-01").cast("date"), (F.col("id") / 500).cast("int")).alias("snapshot_date"))
    target = str(tmp_path / "found")
    for upto in (2, 4):
        update_unique(table.where(F.dayofmonth("snapshot_date") <= upto), target, ["id"])
    assert read_table(spark, target).count() == 0 and unique_report(spark, target, ["id"]).first()["n_failed"] == 0
    late = table.unionByName(spark.createDataFrame([(7,)], "id long").withColumn("snapshot_date", F.lit("2024-06-01").cast("date")))
    update_unique(late, target, ["id"])
    assert [(r.column_name, r.value) for r in read_table(spark, target).collect()] == [("id", "7")]


def test_sketches_of_a_range(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, rng.randint(0, 20_000)]), rng.choice([None, float("nan"), rng.gauss(0, 1), -0.0, 0.0]), f"t{rng.randint(0, 50)}", f"2024-05-{1 + i % 6:02}") for i in range(60_000)]
    df = spark.createDataFrame(rows, "w long, x double, t string, d string").select("w", "x", "t", F.col("d").cast("date").alias("snapshot_date"))
    target = str(tmp_path / "sketches")
    for upto in (2, 6):
        load_days(day_sketches(df.where(F.dayofmonth("snapshot_date") <= upto)), target, id_col="column_name")
    chosen = read_table(spark, target).where(F.dayofmonth("snapshot_date").between(2, 5))
    own = [r for r in rows if "02" <= r[3][-2:] <= "05"]
    found = {r.column_name: r for r in distinct_estimates(chosen).collect()}
    for i, name in enumerate(("w", "x", "t")):
        values = {str(r[i] + 0.0 if i == 1 else r[i]) for r in own if r[i] is not None}
        assert abs(found[name].n_distinct - len(values)) <= DISTINCT_ERROR * len(values) + 1
        assert (found[name].n_rows, found[name].n_nulls) == (len(own), sum(r[i] is None for r in own))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = quantile_estimates(chosen, probs).collect()
    assert {r.column_name for r in got} == {"w", "x"} and len(got) == 10
    for r in got:
        values = [v[0 if r.column_name == "w" else 1] for v in own]
        values = [v for v in values if v is not None and v == v]
        below, upto = sum(v < r.quantile for v in values) / len(values), sum(v <= r.quantile for v in values) / len(values)
        assert below - RANK_ERROR <= r.prob <= upto + RANK_ERROR


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "w long, t string, snapshot_date date")
    assert day_sketches(empty).count() == 0
    none = spark.createDataFrame([(None, None, dt.date(2024, 5, 1))], "w long, t string, snapshot_date date")
    rows = day_sketches(none)
    assert {(r.column_name, r.n_distinct) for r in distinct_estimates(rows).collect()} == {("w", 0), ("t", 0)}
    assert quantile_estimates(rows, [0.5]).count() == 0


def test_heatmap_both_ways(spark, rows):
    rng = random.Random(9)
    genres = {(rng.randrange(10 ** 12) if a % 2 else a, f"g{rng.randint(0, 6)}") for a in range(3_000)}
    ids = sorted({a for a, _ in genres})
    languages = [(rng.choice(ids), f"l{rng.randint(0, 8)}", bool(rng.randint(0, 1))) for _ in range(6_000)] + [(-1, "l1", True)]
    dim_genres = spark.createDataFrame(sorted(genres), "appid long, genre string")
    dim_languages = spark.createDataFrame(languages, "appid long, language string, has_audio_support boolean")
    assert rows(genre_heatmap_by_bitmaps(dim_genres, dim_languages)) == rows(genre_heatmap(dim_genres, dim_languages))


def test_numbers_without_gaps(spark):
    values = random.Random(10).sample(range(10 ** 6), 5_000)
    df = spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "v long").repartition(7)
    assert [(r.v, r.number) for r in dense_numbers(df, "v").orderBy("number").collect()] == list(zip(sorted(values), range(5_000)))


def test_ledger_of_two_runs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    seen = last_processed(spark, ledger, "store")
    assert mark_processed(spark, ledger, "store", "2024-05-03", expected=seen) == dt.date(2024, 5, 3)
    # The other run has read the ledger before, and is refused; without a claim it looks again and leaves the later day.
    with pytest.raises(LostRace):
        mark_processed(spark, ledger, "store", "2024-05-02", expected=seen)
    with pytest.raises(LostRace):
        mark_processed(spark, ledger, "store", "2024-05-09", expected=seen)
    assert mark_processed(spark, ledger, "store", "2024-05-02") == dt.date(2024, 5, 3)
    assert mark_processed(spark, ledger, "store", "2024-05-02", back=True) == dt.date(2024, 5, 2)
    mark_processed(spark, ledger, "a/b = c", "2024-01-01")
    assert sorted((r.table_name, str(r.processed_date)) for r in read_ledger(spark, ledger).collect()) == [("a/b = c", "2024-01-01"), ("store", "2024-05-02")]


def test_ledger_when_another_writer_is_first(spark, tmp_path, monkeypatch):
    """Between the look and the commit another run records a later day: it stays."""
    from linguamart.sources import ledger as module

    path, real, raced = str(tmp_path / "ledger"), module.commit, []

    def slow(spark, folder, version, content):
        if not raced:
            raced.append(1)
            real(spark, folder, version, {"table": "store", "day": "2024-05-05"})
        return real(spark, folder, version, content)

    monkeypatch.setattr(module, "commit", slow)
    assert mark_processed(spark, path, "store", "2024-05-04") == dt.date(2024, 5, 5)
    assert last_processed(spark, path, "store") == dt.date(2024, 5, 5)


def test_commit_is_whole_or_refused(spark, tmp_path):
    folder = str(tmp_path / "c")
    assert newest(spark, folder) == (0, None)
    commit(spark, folder, 1, {"a": "é"})
    with pytest.raises(LostRace):
        commit(spark, folder, 1, {"a": 2})
    commit(spark, folder, 2, {"a": 3})
    assert newest(spark, folder) == (2, {"a": 3})
    assert sorted(n for n in os.listdir(folder) if not n.startswith(".")) == ["000000000001.json", "000000000002.json"]
    assert json.load(open(f"{folder}/000000000001.json")) == {"a": "é"}


def test_days_are_clustered_by_id(spark, tmp_path):
    """The files of a day hold ranges of ids that meet at their borders at most, by their footers; one id with most rows is split."""
    rows = spark.range(0, 40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5_000))).alias("appid"), F.col("id").alias("x"),
        F.when(F.col("id") % 8 == 3, F.lit("2024-05-01")).otherwise("2024-05-02").cast("date").alias("snapshot_date"),
    )
    target = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_days(rows.repartition(5), target)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = 0
    for day in os.listdir(target):
        if not day.startswith("snapshot_date="):
            continue
        ranges = []
        for name in os.listdir(f"{target}/{day}"):
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(f"{target}/{day}/{name}").metadata
                stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
                ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
        ranges.sort()
        hot += sum(low <= 7 <= high for low, high in ranges)
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])), ranges
    assert hot >= 3
    assert sorted(map(tuple, spark.read.parquet(target).select("appid", "x").collect())) == sorted(map(tuple, rows.select("appid", "x").collect()))


def test_table_days(spark, tmp_path):
    load_days(daily(spark, [(1, "2024-05-02", 1, 1, 1), (1, "2024-05-01", 1, 1, 1)]), str(tmp_path / "t"))
    assert table_days(spark, str(tmp_path / "t")) == [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
