"""Files in and out."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixture_rows import STORE, popularity_csv, store_csv, write_csv
from linguamart import schemas
from linguamart.operators import first_in_file
from linguamart.operators.dedupe import SCAN_ORDER
from linguamart.sources import (
    genre_seed, last_processed, layer_path, mark_processed, observed, read_bronze_csv, read_json_documents,
    read_seed, read_silver, register_sources, save_mart, save_view, select_source, with_file_date, write_csv as sink_csv,
    write_days, write_parquet,
)


def test_bronze_csv(spark, tmp_path, rows):
    path = str(tmp_path / "s.csv")
    tricky = (60, 'say "hi"', "NA", "n/a", "a\nb", "x")
    store_csv(path, STORE + [tricky])
    df = read_bronze_csv(spark, path, schemas.BRONZE_STORE)
    got = {r.appid: r for r in first_in_file(df, ["appid"]).collect()}
    assert got[10].price_usd == "$1,299.99" and got[20].languages is None
    assert got[60].price_usd == 'say "hi"' and got[60].price_pln is None and got[60].languages == "a\nb"


def test_bronze_csv_edges(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_bronze_csv(spark, str(tmp_path / "none.csv"), schemas.BRONZE_STORE)
    (tmp_path / "empty.csv").write_text("")
    empty = read_bronze_csv(spark, str(tmp_path / "empty.csv"), schemas.BRONZE_STORE)
    assert empty.count() == 0 and empty.drop(SCAN_ORDER).columns == schemas.BRONZE_STORE.fieldNames()
    store_csv(str(tmp_path / "head.csv"), [])
    assert read_bronze_csv(spark, str(tmp_path / "head.csv"), schemas.BRONZE_STORE).count() == 0
    write_csv(str(tmp_path / "few.csv"), ["extra", "appid"], [("e", 5)])
    few = read_bronze_csv(spark, str(tmp_path / "few.csv"), schemas.BRONZE_STORE).first()
    assert few.appid == 5 and few.genre is None
    write_csv(str(tmp_path / "float.csv"), ["appid"], [("5.0",)])
    assert read_bronze_csv(spark, str(tmp_path / "float.csv"), schemas.BRONZE_STORE).first().appid == 5
    write_csv(str(tmp_path / "bad.csv"), ["appid"], [("x1",)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_bronze_csv(spark, str(tmp_path / "bad.csv"), schemas.BRONZE_STORE).collect()
    assert read_bronze_csv(spark, str(tmp_path / "bad.csv"), schemas.BRONZE_STORE, safe=("appid",)).first().appid is None


def test_first_in_file_follows_file_order_over_splits(spark, tmp_path):
    path = str(tmp_path / "wide.csv")
    write_csv(path, ["appid", "genre"], [(i % 50, f"g{i}") for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_bronze_csv(spark, path, schemas.BRONZE_STORE, multi_line=False)
        assert df.rdd.getNumPartitions() > 4
        got = {r.appid: r.genre for r in first_in_file(df, ["appid"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: f"g{i}" for i in range(50)}


def test_popularity_keeps_row_with_most_players(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    popularity_csv(path)
    got = first_in_file(read_bronze_csv(spark, path, schemas.BRONZE_POPULARITY), ["appid"], best="ccu").collect()
    assert {r.appid: r.ccu for r in got} == {10: 250, 20: -1, 30: None}


def _one_file(spark, tmp_path, name, data, columns):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = tmp_path / name
    os.makedirs(path.parent, exist_ok=True)
    pq.write_table(pa.table({c: [r[i] for r in data] for i, c in enumerate(columns)}), str(path))


def test_choose_dated_files(spark, tmp_path, rows):
    for day, value in (("2024-05-01", 1), ("2024-05-02", 2)):
        _one_file(spark, tmp_path, f"src/{day}/store_silver_{day}.parquet", [(value,)], ["v"])
    (tmp_path / "src/2024-05-02/notes.txt").write_text("no table")
    _one_file(spark, tmp_path, "src/2024-05-03/other_2024-05-03.parquet", [(9,)], ["v"])
    root = str(tmp_path / "src")
    pick = lambda *a, **k: rows(select_source(spark, root, *a, needle="store_silver_", **k), "v")
    assert pick() == [(1,), (2,)]
    assert pick("latest") == [(2,)]
    assert pick(date="2024-05-01") == [(1,)]
    assert pick("latest", date="2024-05-01") == [(1,)]
    with pytest.raises(FileNotFoundError):
        pick(date="2024-05-09")
    with pytest.raises(FileNotFoundError):
        select_source(spark, root, needle="absent_")
    with pytest.raises(ValueError):
        select_source(spark, root, "newest")
    dated = with_file_date(select_source(spark, root, needle="store_silver_"))
    assert rows(dated, "v", "snapshot_date") == [(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 2))]


def test_files_of_other_days_are_never_opened(spark, tmp_path, rows):
    _one_file(spark, tmp_path, "src/a_2024-05-01.parquet", [(1,)], ["v"])
    (tmp_path / "src/a_2024-04-30.parquet").write_text("not parquet at all")
    chosen = select_source(spark, str(tmp_path / "src"), date="2024-05-01", schema="v bigint")
    assert rows(chosen, "v") == [(1,)]


def test_date_from_column_wins_over_file_name(spark, tmp_path):
    _one_file(spark, tmp_path, "src/p_2024-05-01.parquet", [(1, "2024-06-01"), (2, None)], ["v", "ingestion_date"])
    df = with_file_date(spark.read.parquet(str(tmp_path / "src")), fallback_for="ingestion_date")
    assert {r.v: r.snapshot_date for r in df.collect()} == {1: dt.date(2024, 6, 1), 2: dt.date(2024, 5, 1)}


def test_columns_may_differ_between_days(spark, tmp_path):
    _one_file(spark, tmp_path, "src/a_2024-05-01.parquet", [(1,)], ["v"])
    _one_file(spark, tmp_path, "src/a_2024-05-02.parquet", [(2, "x")], ["v", "w"])
    df = select_source(spark, str(tmp_path / "src"), merge_schema=True)
    assert {r.v: r.w for r in df.collect()} == {1: None, 2: "x"}


def test_ledger(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert last_processed(spark, ledger, "store") is None
    mark_processed(spark, ledger, "store", "2024-05-02")
    mark_processed(spark, ledger, "popularity", "2024-05-01")
    mark_processed(spark, ledger, "store", "2024-05-03")
    assert last_processed(spark, ledger, "store") == dt.date(2024, 5, 3)
    assert last_processed(spark, ledger, "popularity") == dt.date(2024, 5, 1)
    assert last_processed(spark, ledger, "games") is None


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "appid int, genre string")
    sink_csv(df, str(tmp_path / "c"))
    back = read_bronze_csv(spark, str(tmp_path / "c"), schemas.SILVER_GENRES)
    assert rows(back, "appid", "genre") == [(1, 'a "b", c'), (2, None)]
    counted, seen = observed(df, "rows-written")
    write_parquet(counted, str(tmp_path / "p"), sort_by=["appid"])
    assert seen.get["rows"] == 2
    assert any(".snappy." in n for n in os.listdir(tmp_path / "p"))
    assert rows(save_view(df, "some_view")) == rows(df)
    assert rows(save_mart(df, "some_mart")) == rows(df)
    spark.sql("drop table some_mart")


def test_days_are_folders_and_rewrite_alone(spark, tmp_path, rows):
    target = str(tmp_path / "days")
    df = spark.createDataFrame([(2, "2024-05-01"), (1, "2024-05-01"), (1, "2024-05-02")], "appid int, d string").select(
        "appid", F.col("d").cast("date").alias("snapshot_date")
    )
    write_days(df, target)
    write_days(df.where("snapshot_date = '2024-05-02'").withColumn("appid", F.lit(5)), target)
    assert rows(spark.read.parquet(target)) == [
        (1, dt.date(2024, 5, 1)), (2, dt.date(2024, 5, 1)), (5, dt.date(2024, 5, 2))
    ]


def test_seed_and_documents(spark, tmp_path, rows):
    (tmp_path / "seed.csv").write_text("genre,priority\n Action ,10\nRPG,20\n")
    assert rows(read_seed(spark, str(tmp_path / "seed.csv"))) == [("action", 10), ("rpg", 20)]
    assert genre_seed(spark).count() == 19
    (tmp_path / "doc.json").write_text('{"1":\n{"a":2}}')
    assert read_json_documents(spark, str(tmp_path / "doc.json")).first().payload == '{"1":\n{"a":2}}'


def test_silver_by_day(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1,)], "appid int")
    write_parquet(df, layer_path(base, "silver", "store", "2024-05-01"))
    assert read_silver(spark, f"{base}/silver", "store", "2024-05-01").count() == 1
    with pytest.raises(FileNotFoundError):
        read_silver(spark, f"{base}/silver", "store", "2024-05-02")
    views = register_sources(spark, f"{base}/silver", tables={"store_raw": ("store", "")})
    assert views["store_raw"].select("snapshot_date").first()[0] == dt.date(2024, 5, 1)


def test_day_of_a_dated_base_path(spark, tmp_path):
    """Neither a date further up in the path nor one of another table counts."""
    base = str(tmp_path / "backup-2023-01-01")
    day = spark.createDataFrame([(1, "a")], "appid long, name string")
    day.write.parquet(f"{base}/store/snapshot_date=2024-05-01")
    day.write.parquet(f"{base}/store/snapshot_date=2024-05-02")
    views = register_sources(spark, base, tables={"store_raw": ("store", "")})
    assert sorted(str(r[0]) for r in views["store_raw"].select("snapshot_date").collect()) == ["2024-05-01", "2024-05-02"]
    one = views["store_raw"].where("snapshot_date = DATE'2024-05-02'")
    assert len(one.inputFiles()) >= 1 and one.count() == 1
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().toString()


def test_day_folder_of_a_table_with_ingestion_date(spark, tmp_path):
    """Popularity rows carry a day of their own; the folder still prunes."""
    for d in range(1, 4):
        spark.createDataFrame([(1, f"2024-05-0{d}")], "appid long, ingestion_date string").write.parquet(f"{tmp_path}/popularity/snapshot_date=2024-05-0{d}")
    view = register_sources(spark, str(tmp_path), tables={"popularity_raw": ("popularity", "")})["popularity_raw"]
    late = view.where("snapshot_date > DATE'2024-05-02'")
    assert late.count() == 1 and "PartitionFilters: [isnotnull(snapshot_date" in late._jdf.queryExecution().toString()


def test_csv_columns_by_each_files_header(spark, tmp_path, rows):
    folder = tmp_path / "day"
    folder.mkdir()
    (folder / "a.csv").write_text("appid,price_usd,price_pln,release_date,languages,genre\n1,$1,,2013-07-01,English,RPG\n")
    (folder / "b.csv").write_text("genre,extra,appid,languages\nIndie,x,2,French\n")
    (folder / "c.csv").write_text("")
    got = read_bronze_csv(spark, str(folder), schemas.BRONZE_STORE)
    assert rows(got, "appid", "price_usd", "languages", "genre") == [(1, "$1", "English", "RPG"), (2, None, "French", "Indie")]


def test_dates_of_pandas_files(spark, tmp_path, rows):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "store" / "snapshot_date=2024-05-01"
    folder.mkdir(parents=True)
    frame = pd.DataFrame({"appid": [1, 2], "release_date": pd.to_datetime(["2013-07-01", None]).astype("datetime64[ns]")})
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), folder / "store.parquet", version="2.6", coerce_timestamps=None)
    view = register_sources(spark, str(tmp_path), tables={"store_raw": ("store", "")})["store_raw"]
    assert [str(r[0]) for r in view.orderBy("appid").select(F.col("release_date").cast("date")).collect()] == ["2013-07-01", "None"]


def test_bronze_csv_query_keeps_parts(spark, monkeypatch):
    from linguamart.checks import sources

    orders = spark.range(0, 80, 1, 4).selectExpr("id AS o_orderkey", "2.5D AS o_totalprice", "'O' AS o_orderstatus", "'1-URGENT' AS o_orderpriority")
    monkeypatch.setattr(sources, "table", lambda *args: orders)
    df = sources.bronze_csv(spark, None)
    assert len(df.inputFiles()) == 8
    want = [(i, "O", 2.5 if i % 2 == 0 else None, None) for i in range(80)]
    assert sorted(map(tuple, df.collect())) == want


def test_headers_take_one_job_however_many_files(spark, tmp_path, rows):
    """Files of several headers, some quoted, with a mark of byte order, blank first lines or no line at all."""
    from linguamart.sources import snapshots

    def jobs(folder):
        spark.sparkContext.setJobGroup(folder, folder)
        try:
            found = snapshots._headers(spark, folder)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(folder))

    seen = []
    for n in (3, 60):
        folder = tmp_path / f"f{n}"
        (folder / "sub dir").mkdir(parents=True)
        for i in range(n):
            head = ('appid,"genre"', "genre,appid", "﻿appid,genre,x", "")[i % 4]
            (folder / ("sub dir" if i % 3 else ".") / f"part {i}.csv").write_text(f"{head}\n" + "1,2,3\n" * (5 if head else 0), encoding="utf-8")
        found, used = jobs(str(folder))
        assert {k: len(v) for k, v in found.items()} == {
            k: v for k, v in {("appid", "genre"): (n + 3) // 4, ("genre", "appid"): (n + 2) // 4, ("appid", "genre", "x"): (n + 1) // 4}.items() if v
        }
        seen.append(used)
    assert seen[0] == seen[1]
    got = read_bronze_csv(spark, str(tmp_path / "f3"), schemas.SILVER_GENRES)
    assert rows(got, "appid", "genre") == [(1, "2")] * 10 + [(2, "1")] * 5


def test_names_of_a_header_line():
    from linguamart.sources.snapshots import _names

    assert _names('a,"b,c",,a,"d ""e"""') == ("a", "b,c", "__2", "a__3", 'd "e"')


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    from linguamart import session

    class Cluster:
        class sparkContext:
            master, applicationId = "yarn", "app"

        class conf:
            values = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}

            @classmethod
            def get(cls, key, default=None):
                return cls.values.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster)
    Cluster.conf.values["spark.checkpoint.dir"] = "hdfs://nn/shared/"
    assert session.scratch_dir(Cluster, "x").startswith("hdfs://nn/shared/x-")


def test_clear_scratch(spark, monkeypatch):
    from linguamart import session

    monkeypatch.setattr(session, "_made", {})
    folder = session.stored(spark.range(5), "five").inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder)
