"""What the questions read of the stand-in catalogue: newest rows picked from raw ones, columns that nobody reads left alone."""

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import functions as F

from linguamart.checks import audit, gold, incremental, insights
from linguamart.functions import clean_language
from linguamart.plans import staging

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """A folder with a few hundred lines: titles with several lines on a day, equal release dates, missing days and players."""
    rows = []
    for i in range(400):
        day = None if i % 37 == 5 else dt.datetime(1995 + i % 3, 1 + i % 5, 1 + i % 28)
        rows.append((
            i, i % 23, i * 7 % 19, 1 + i % 6, float(i % 9), None if i % 31 == 4 else 900.0 + i * 37 % 20000, (i % 4) / 20, (i % 3) / 20,
            "NRA"[i * 5 % 3], "OF"[i % 2], day,
        ))
    folder = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_newest_rows_are_those_of_staging(spark, lines, rows):
    assert rows(staging.staging_store(gold.newest_store(spark, lines))) == rows(gold.staging_store(spark, lines))
    assert rows(staging.staging_popularity(gold.newest_popularity(spark, lines))) == rows(gold.staging_popularity(spark, lines))


def test_questions_parse_only_what_they_read(spark, lines, monkeypatch):
    """No price is worked out for the heat map, coverage or popular languages, and no table of all parsed rows is stored."""
    kept = []
    monkeypatch.setattr(gold, "stored", lambda df, label="stored": kept.append((label, plan(df))) or df)
    for ask in (insights.genre_heatmap, insights.genre_heatmap_bitmaps, insights.coverage_vs_perf, insights.popular_languages):
        kept.clear()
        got = ask(spark, lines)
        assert "silver_store" not in [label for label, _ in kept], ask
        assert not any("format_number" in text for _, text in kept) and "format_number" not in plan(got), ask


def test_players_of_newest_day_take_one_shuffle(spark, lines):
    """Coverage needs a window per source: one over raw store rows, one over raw popularity rows."""
    fct, _ = gold.built(spark, lines, "fct_games", "dim_languages")
    text = fct.select("appid", "ccu")._jdf.queryExecution().executedPlan().toString()
    assert "snapshot_date" not in "".join(x for x in text.splitlines() if "hashpartitioning" in x)


def test_checks_store_only_checked_columns(spark, lines, monkeypatch):
    kept = {}
    keep = audit.stored
    monkeypatch.setattr(audit, "stored", lambda df, label: kept.update({label: df.columns}) or keep(df, label))
    audit.dq_marts(spark, lines)
    assert kept == {"fct_games": ["appid", "title"], "dim_languages": ["language_key", "appid", "language"]}


def test_loads_get_a_fact_that_is_worked_out(spark, lines, monkeypatch):
    """Dealing out days reads its rows twice: neither a load nor a writer of days gets windows that are yet to run."""
    seen = []

    def watched(do):
        return lambda df, *a, **k: seen.append(plan(df)) or do(df, *a, **k)

    monkeypatch.setattr(incremental, "load_days", watched(incremental.load_days))
    monkeypatch.setattr(incremental, "write_days", watched(incremental.write_days))
    lined = {f.__name__: f(spark, lines) for f in (incremental.trend_incremental, incremental.incremental_daily)}
    assert seen and not any("Window" in text for text in seen)
    assert lined["trend_incremental"].count() == lined["incremental_daily"].count()


def test_clean_names(spark, rows):
    """Names without other tags take a shorter way to the same result."""
    parts = ["French", " <strong>*</strong>", "*", " ", "\t ", "  Simplified Chinese ", "<i>Thai</i>", "<br >", "é", "languages with FULL audio support", "a<b"]
    texts = ["".join(x) for n in (1, 2, 3) for x in itertools.product(parts, repeat=n)] + ["", " ", None]

    def plain(text):
        if text is None:
            return None
        text = re.sub(r"<br\s*/?>|<strong>\*</strong>", " ", text)
        text = re.sub(r"(?i)languages with full audio support", "", re.sub(r"<[^>]+>|\*", " ", text))
        return re.sub(r"\s+", " ", text).strip()

    got = spark.createDataFrame([(t,) for t in texts], "x string").select("x", clean_language(F.col("x")).alias("y")).collect()
    assert [tuple(r) for r in got if r["y"] != plain(r["x"])] == []
