"""Column functions on single values."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from linguamart import functions as fn


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize("text,want", [
    ("$1,299.99", 1299.99), ("Free", 0.0), ("4-5", 0.0), ("-3", -3.0), (None, 0.0), ("", 0.0), ("-", 0.0), (".5", 0.5), ("1.2.3", 0.0),
])
def test_price_with_dot(spark, text, want):
    assert one(spark, text, lambda c: fn.clean_price(c, ".")) == want


@pytest.mark.parametrize("text,want,brackets", [
    ("4799,99zł", 4799.99, 4799.99), ("1 299,99zł", 1299.99, 1299.99), ("-3,50zł", -3.5, -3.5), ("(5,00)", 5.0, 0.0), (None, 0.0, 0.0),
])
def test_price_with_comma(spark, text, want, brackets):
    assert one(spark, text, lambda c: fn.clean_price(c, ",")) == want
    assert one(spark, text, lambda c: fn.clean_price(c, ",", keep_parentheses=True)) == brackets


@pytest.mark.parametrize("text,want", [
    ("21 Aug, 2012", dt.date(2012, 8, 21)), ("Aug 21, 2012", dt.date(2012, 8, 21)), ("1 Jan, 2000", dt.date(2000, 1, 1)),
    ("Coming soon", None), ("2024", None), ("Q1 2026", None), ("31 Feb, 2020", None), ("", None), (None, None),
])
def test_dates(spark, text, want):
    assert one(spark, text, fn.parse_date) == want


@pytest.mark.parametrize("text,want", [
    ("/a/b_2024-05-01.parquet", dt.date(2024, 5, 1)), ("/a/b.parquet", None), ("x_2024-13-45", None),
])
def test_date_in_name(spark, text, want):
    assert one(spark, text, fn.date_in_text) == want


@pytest.mark.parametrize("text,want", [
    (" English<strong>*</strong>", "English"), ("German<br><strong>*</strong>languages with full audio support", "German"),
    ("<b>Polish</b>\u00a0*", "Polish"), ("   ", ""), ("Simplified\t Chinese", "Simplified Chinese"),
    ("a\x1cb", "a b"), ("LANGUAGES WITH FULL AUDIO SUPPORT", ""), (None, None),
])
def test_language_name(spark, text, want):
    assert one(spark, text, fn.clean_language) == want


@pytest.mark.parametrize("text,want", [
    ("Pol<i>ish", "Polish"), (" French ", "French"), ("Dutch Languages with full audio support", "Dutch"), (None, None),
])
def test_language_second_pass(spark, text, want):
    assert one(spark, text, fn.tidy_language) == want


@pytest.mark.parametrize("text,loose,strict", [
    ("English<strong>*</strong>", True, True), ("Polish *", True, False), ("French", False, False), (None, False, False),
])
def test_audio_mark(spark, text, loose, strict):
    assert one(spark, text, fn.has_audio_mark) is loose
    assert one(spark, text, lambda c: fn.has_audio_mark(c, strict=True)) is strict


def test_codes_and_marks(spark):
    assert one(spark, "English, #lang_slovakian", fn.replace_codes) == "English, Slovakian"
    assert one(spark, " English<strong>*</strong> ", fn.strip_audio_mark) == "English"
    assert one(spark, "A, B<br><strong>*</strong>languages with full audio support", fn.strip_footnote) == "A, B"


@pytest.mark.parametrize("text,want", [("a,b", 2), (" ,a,, ,b,", 2), ("", 0), (None, 0), (",", 0), ("a", 1)])
def test_token_count(spark, text, want):
    assert one(spark, text, fn.count_tokens) == want


@pytest.mark.parametrize("text,want", [
    ("Action, Free To Play", "action"), ("Free to Play, Massively Multiplayer", "free to play"), ("Indie,,RPG", "rpg"),
    ("Utilities", "utilities"), ("Zeta, Alpha", "alpha"), ("Other, Zeta, Alpha", "alpha"), (None, "other"), (" , ", "other"),
])
def test_priority(spark, text, want):
    assert one(spark, text, fn.pick_by_priority) == want


def test_numbers(spark):
    assert one(spark, -4, fn.clip_low, "long") == 0
    assert one(spark, None, fn.clip_low, "long") is None
    assert one(spark, 3, lambda c: fn.guarded_ratio(c, F.lit(0)), "long") is None
    assert one(spark, 310, lambda c: fn.guarded_ratio(c, F.lit(410)), "long") == 0.7561
    assert one(spark, None, lambda c: fn.add_counts(c, F.lit(2)), "long") == 2
    assert one(spark, "7x", fn.to_long) is None and one(spark, "7", fn.to_long) == 7


def test_key(spark):
    want = hashlib.md5(b"10|english").hexdigest()
    assert one(spark, "English", lambda c: fn.surrogate_key(F.lit(10), F.lower(c))) == want


def test_first_nonempty(spark):
    df = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), ("", None), ("", "")], "a string, b string")
    got = [r[0] for r in df.select(fn.first_nonempty(F.col("a"), F.col("b"))).collect()]
    assert got == ["b", "b", "a", None, ""]
