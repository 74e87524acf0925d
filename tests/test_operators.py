"""Operators on small tables, where needed against a plain Python count."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linguamart import operators as op
from linguamart.constants import OWNER_BANDS
from linguamart.functions import whole_number
from linguamart.sources import genre_seed


def test_latest_drops_null_keys_and_puts_null_order_last(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (1, 7, "c"), (2, None, "d"), (None, 9, "e")], "k int, o int, v string")
    assert rows(op.latest_per_key(df, ["k"], "o", "v")) == [(1, 7, "c"), (2, None, "d")]


def test_best_per_key_ties_by_second_order(spark, rows):
    df = spark.createDataFrame([(1, 5, 2), (1, 5, 1), (2, None, 3)], "k int, m int, pos int")
    assert rows(op.best_per_key(df, ["k"], [F.desc_nulls_last("m"), "pos"])) == [(1, 5, 1), (2, None, 3)]


def test_top_n_distinct(spark):
    df = spark.createDataFrame([(7, 1), (7, 2), (8, 3), (9, 4), (8, 5)], "k int, pos int")
    assert [r.k for r in op.top_n_distinct(df, ["k"], ["pos"], 2).collect()] == [7, 8]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=30))
def test_latest_is_unique_on_key(spark, data):
    got = op.latest_per_key(spark.createDataFrame(data, "k int, o int"), ["k"], "o").collect()
    assert {(r.k, r.o) for r in got} == {(k, max(o for kk, o in data if kk == k)) for k, _ in data}


def test_explode_modes(spark, rows):
    df = spark.createDataFrame([(1, "a, b,,"), (2, None), (3, " ")], "k int, t string")
    assert rows(op.explode_tokens(df, "t")) == [(1, ""), (1, ""), (1, "a"), (1, "b"), (3, "")]
    assert rows(op.explode_tokens(df, "t", keep_null=True))[-2:] == [(2, None), (3, "")]
    assert rows(op.explode_tokens(df, "t", drop_blank=True, keep_row=True)) == [(1, "a"), (1, "b"), (2, None), (3, None)]


def test_primary_by_join_equals_in_row_form(spark, rows):
    from linguamart.functions import pick_by_priority

    texts = ["Action, RPG", "Zeta, Indie", "Zeta, Alpha", None, " , ", "Other, Free To Play", "Racing "]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, genre string")
    joined = op.primary_by_join(df, ["k"], "genre", genre_seed(spark))
    assert rows(joined) == rows(df.select("k", pick_by_priority(F.col("genre"))))


def test_attach_details_with_one_hot_id_and_missing_ids(spark):
    rng = random.Random(3)
    items = [(i, 7 if i % 3 == 0 else None if i % 3 == 1 else rng.randrange(200), "same") for i in range(3000)]
    left = spark.createDataFrame(items, "pos int, id int, v string").repartition(5)
    details = spark.createDataFrame([(i, f"d{i}") for i in range(0, 200, 2)] + [(7, "hot")], "id int, d string")
    got = op.attach_details(left, details, "id")
    assert got.columns == ["id", "pos", "v", "d"]
    lookup = {i: f"d{i}" for i in range(0, 200, 2)} | {7: "hot"}
    want = sorted((str(i), p, v, str(lookup.get(i))) for p, i, v in items)
    assert sorted((str(r[0]), r[1], r[2], str(r[3])) for r in got.collect()) == want


def test_columns(spark, rows):
    from linguamart.schemas import SILVER_GENRES

    df = spark.createDataFrame([("1", "x")], "appid string, extra string")
    filled = op.backfill_columns(df, SILVER_GENRES)
    assert filled.columns == ["appid", "genre", "extra"] and rows(filled) == [("1", None, "x")]
    assert op.drop_columns(df, "extra", "none").columns == ["appid"]
    df = spark.createDataFrame([("1", "2x"), ("3", "4")], "a string, b string")
    assert rows(op.cast_columns(df, {"a": "long", "b": "long"}, safe=("b",))) == [(1, None), (3, 4)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.cast_columns(df, {"b": "long"}).collect()


def test_recode_and_exclude(spark, rows):
    df = spark.createDataFrame([("200,000,000 .. ",), ("200,000,000 ..",), (None,)], "o string")
    assert rows(df.select(op.recode(F.col("o"), OWNER_BANDS))) == [("200M+",), (None,), (None,)]
    df = spark.createDataFrame([("Free To Play",), ("free to play",), ("",), (None,), ("RPG",)], "g string")
    assert rows(op.exclude_value(df, "g", "Free To Play")) == [("",), ("RPG",), ("free to play",), (None,)]
    assert rows(op.exclude_value(df, "g", "Free To Play", ignore_case=True, drop_empty=True)) == [("RPG",)]


def test_popularity_payload(spark, rows):
    doc = '{"10":{"appid":10,"ccu":5},"20":{"ccu":"x"},"30":5,"abc":{"ccu":1},"40":{"appid":null},"50":{"appid":"51"}}'
    df = spark.createDataFrame([(doc,)], "payload string")
    assert rows(op.popularity_records(df, "payload", {"ccu": "long"})) == [(10, 5), (20, None), (51, None)]


US = (
    '{"10":{"success":true,"data":{"price_overview":{"final_formatted":"$9.99"},"release_date":{"date":"1 Jul, 2013"},'
    '"supported_languages":"","languages":"English","genres":[{"description":"Action"},{"description":"RPG"}]}},'
    '"20":{"success":false},"60":{"success":true,"data":{}},"70":{"success":true,"data":[1]}}'
)
PL = (
    '{"10":{"success":true,"data":{"price_overview":{"final_formatted":"39,99zł"},"release_date":{"date":"2 Jul, 2013"}}},'
    '"20":{"success":true,"data":{"release_date":{"date":"Coming soon"}}}}'
)


def test_regions(spark, rows):
    us, pl = [op.store_records(spark.createDataFrame([(d,)], "payload string"), "payload") for d in (US, PL)]
    merged = op.merge_regions(us, pl)
    assert merged.columns == ["appid", "price_usd", "price_pln", "release_date", "languages", "genre"]
    assert rows(merged) == [
        (10, "$9.99", "39,99zł", "1 Jul, 2013", "English", "Action, RPG"),
        (20, None, None, "Coming soon", None, ""),
    ]
    # A repeated id, in one region or both, neither doubles the row nor the count.
    assert rows(op.merge_regions(us.unionByName(us), pl.unionByName(pl))) == rows(merged)
    # An empty record counts as a hit, but gives no row.
    assert rows(op.region_counters(us, pl)) == [(2, 2, 3, 2)]


def test_ranked_items(spark, rows):
    logos = ["https://x/steam/apps/730/c.jpg", "https://x/steam/bundles/55/c.jpg", "https://x/other/1"]
    page = spark.createDataFrame([(1, [(u,) for u in logos])], "page int, items array<struct<logo:string>>")
    items = op.ranked_items(page)
    assert rows(items, "page", "position", "appid") == [(1, 0, 730), (1, 1, 55), (1, 2, None)]
    lists = op.union_lists({"top": items, "new": items})
    assert lists.count() == 6 and {r[0] for r in lists.select("list_name").distinct().collect()} == {"top", "new"}


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (None, "b")], "k int, v string")
    report = op.run_checks({"t": df}, {"t": {"not_null": ["k", "v"], "unique": ["k", "v"]}})
    assert rows(report) == [("t", "k", "not_null", 2), ("t", "k", "unique", 1), ("t", "v", "not_null", 1), ("t", "v", "unique", 1)]
    empty = df.where("false")
    assert rows(op.run_checks({"t": empty}, {"t": {"not_null": ["k"], "unique": ["k"]}})) == [("t", "k", "not_null", 0), ("t", "k", "unique", 0)]


def test_warnings(spark, rows):
    data = [(10, "10,000,000 .. 20,000,000", 5, 1), (10, "odd", -1, -1), (20, None, 3, -2)]
    df = spark.createDataFrame(data, "appid int, owners string, positive long, negative long")
    assert rows(op.popularity_warnings(df, OWNER_BANDS, ["positive", "negative"])) == [(1, 3, 1)]


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], list(range(101)), [0.0] * 50 + [1e12], [-3.5, -3.5, 0.0, 9.25, 1e-9, 2e9],
    [float(x) for x in np.random.default_rng(1).lognormal(0, 4, 500)],
])
def test_quantiles_are_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.prob: r.quantile for r in op.value_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-12)


def test_quantiles_by_group_with_null_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), ("b", None)], "g string, v int")
    assert rows(op.value_quantiles(df, "v", [0.5], ["g"])) == [("a", 0.5, 2.0), (None, 0.5, 5.0)]


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (4, "a")], "n int, s string")
    got = {r.column_name: r.asDict() for r in op.column_profile(df).collect()}
    assert got["n"]["n_distinct"] == 3 and got["n"]["p50"] == 2.0 and got["n"]["max_value"] == 4.0
    assert got["s"]["n_nulls"] == 1 and got["s"]["n_distinct"] == 1 and got["s"]["mean_value"] is None
    assert rows(op.null_counts(df)) == [("n", 0), ("s", 1)]
    assert [r[0] for r in op.distinct_values(df, "n").collect()] == [1, 2, 4]
    assert rows(op.flag_counts(df.withColumn("f", F.col("n") > 1), "f")) == [(2, 1)]
    assert op.preview(df, 2).count() == 2


def test_notebook_language_form(spark, rows):
    df = spark.createDataFrame([(1, "English<strong>*</strong>, Polish *, Polish *")], "appid int, languages string")
    got = rows(op.normalize_languages(df, ["appid"], strict_mark=True, dedupe=False))
    assert got == [(1, "English", True), (1, "Polish *", False), (1, "Polish *", False)]


def test_quantiles_with_infinity_and_nan(spark):
    values = [float(i) for i in range(99)] + [float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.prob: r.quantile for r in op.value_quantiles(df, "v", [0.0, 0.5, 0.98, 1.0]).collect()}
    assert got == {0.0: 0.0, 0.5: 50.0, 0.98: 98.0, 1.0: float("inf")}
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")
    got = {r.prob: r.quantile for r in op.value_quantiles(df, "v", [0.0, 0.5, 1.0]).collect()}
    assert (got[0.0], got[0.5]) == (1.0, 2.0) and got[1.0] != got[1.0]


def test_details_of_ids_of_any_share(spark):
    """An id with 0.9 % of the items and one with half of them."""
    items = [(i, 1 if i % 2 else 2 if i % 100 == 4 else i) for i in range(4000)]
    left = spark.createDataFrame(items, "pos int, id int").repartition(6)
    details = spark.createDataFrame([(1, "a"), (2, "b"), (6, "c")], "id int, d string")
    got = sorted((r.pos, r.id, r.d) for r in op.attach_details(left, details, "id").collect())
    assert got == sorted((p, i, {1: "a", 2: "b", 6: "c"}.get(i)) for p, i in items)


def test_whole_number_beyond_long(spark, rows):
    df = spark.createDataFrame([("1e30",), ("NaN",), ("Infinity",), ("-Infinity",), ("5.0",), ("7",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(whole_number(F.col("t"))).collect()]
    assert got == [None, None, None, None, 5, 7, None, None]


def test_separator_is_plain_text(spark, rows):
    df = spark.createDataFrame([("ab|cd",)], "t string")
    assert rows(op.explode_tokens(df, "t", sep="|")) == [("ab",), ("cd",)]


def test_notebook_form_keeps_titles_without_list(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "A<strong>*</strong>,B")], "appid int, languages string")
    got = op.normalize_languages(df, ["appid"], strict_mark=True, dedupe=False)
    assert rows(got) == [(1, None, None), (2, "A", True), (2, "B", False)]


def test_payload_records_that_are_odd(spark, rows):
    """Malformed documents give nothing; an odd record costs itself alone; values keep what their text says."""
    docs = [
        '{"7": {"ccu": 5, "name": "A"}', "[1]", "null", "", None, '{"8": {"ccu": "9", "name": 4}, "x": 3, "9": {"ccu": null}, "10": {"ccu": 1.0, "name": {"n": 1}}}',
        '{"11": {"ccu": 1, "ccu": 2, "name": "twice"}, "12": {"ccu": 3}}', '{"13": {"appid": 14, "ccu": 2.6}, "15": {"appid": null}, "16": {"appid": "x"}, "17": {"a.b": 1, "ccu": true}}',
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    got = rows(op.popularity_records(df, "d", {"ccu": "long", "name": "string"}, position="at"), "appid", "ccu", "name", "at")
    assert got == [
        (10, 1, '{"n":1}', 3), (11, 2, "twice", 0), (12, 3, None, 1), (14, 3, None, 0), (17, None, None, 3), (8, 9, "4", 0), (9, None, None, 2),
    ]
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        got = rows(op.popularity_records(df.where("i = 6"), "d", {"ccu": "long"}), "appid", "ccu")
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert got == [(12, 3)]


def test_payload_keeps_the_order_of_its_entries(spark):
    text = "{" + ", ".join(f'"{i}": {{"ccu": {i}}}' for i in (30, 4, 100, 2)) + "}"
    got = op.popularity_records(spark.createDataFrame([(text,)], "d string"), "d", {"ccu": "long"}, position="at").orderBy("at").collect()
    assert [r.appid for r in got] == [30, 4, 100, 2]


def test_store_records_that_are_odd(spark, rows):
    docs = [
        '{"1": {"success": true, "data": {"genres": "Plain", "languages": "French"}}}', '{"2": {"success": "true", "data": {}}}', '{"3": {"success": true, "data": "no"}}',
        '{"4": {"success": true}, "5": {"success": false, "data": {"genres": []}}, "y": {"success": true, "data": {"a": 1}}}',
        '{"6": {"success": true, "data": {"price_overview": "free", "release_date": {"date": null}, "genres": [{"description": "A"}, {"id": 1}, {"description": null}]}}}', "{",
    ]
    got = rows(op.store_records(spark.createDataFrame([(d,) for d in docs], "d string"), "d"), "appid", "has_data", "price", "release_date", "languages", "genre")
    assert got == [(1, True, None, None, "French", "Plain"), (2, False, None, None, None, ""), (6, True, None, None, None, "A, , ")]


def test_profile_tells_long_decimals_apart(spark):
    import decimal

    values = [decimal.Decimal("12345678901234567890.01"), decimal.Decimal("12345678901234567890.02"), decimal.Decimal("1"), None, decimal.Decimal("1")]
    row = op.column_profile(spark.createDataFrame([(v,) for v in values], "v decimal(30,2)")).first()
    assert (row.n_distinct, row.n_rows, row.n_nulls, row.p25) == (3, 5, 1, 1.0)
