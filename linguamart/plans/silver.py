"""Bronze to silver: typed, cleaned, one row per title."""

from pyspark.sql import functions as F

from ..constants import (
    FREE_TO_PLAY, LANGUAGE_CODES, OWNER_BANDS, POPULARITY_COUNTERS, POPULARITY_UNUSED, RELEASE_DATE_FORMATS,
)
from ..functions import clean_price, parse_date, replace_codes
from ..operators import clip_columns, exclude_value, explode_tokens, flag_missing, normalize_languages, recode


def clean_store(df, formats=RELEASE_DATE_FORMATS, codes=LANGUAGE_CODES):
    """Type the texts of a store snapshot. Only projections, so extra columns pass through."""
    df = df.withColumns({
        "price_usd": clean_price(F.col("price_usd"), "."),
        "price_pln": clean_price(F.col("price_pln"), ","),
        "release_date": parse_date(F.col("release_date"), formats),
        "languages": replace_codes(F.col("languages"), codes),
        # A title without an id must not pass as a row of its own.
        "appid": F.coalesce(F.col("appid").cast("long"), F.raise_error(F.lit("a store row has no title id")).cast("long")),
    })
    return flag_missing(df, "release_date", "release_date_missing")


def silver_store(bronze, dedupe, **options):
    """``dedupe`` keeps one row per title; it runs on the raw texts, before they are cleaned."""
    cleaned = clean_store(dedupe(bronze), **options)
    head = ["appid", "price_usd", "price_pln", "release_date", "release_date_missing", "languages", "genre"]
    return cleaned.select(*head, *[c for c in cleaned.columns if c not in head])


def clean_popularity(df, day, bands=OWNER_BANDS):
    """Drop unused columns, name the owner band, clip the counters, stamp the day (value or column)."""
    day = day if hasattr(day, "cast") else F.lit(day)
    df = df.drop(*POPULARITY_UNUSED)
    df = df.withColumns({"owners_category": recode(F.col("owners"), bands), "ingestion_date": day.cast("date")}).drop("owners")
    return clip_columns(df, POPULARITY_COUNTERS)


def silver_popularity(bronze, dedupe, day, **options):
    """``dedupe`` keeps the row with most players per title, judged before clipping."""
    return clean_popularity(dedupe(bronze), day, **options)


def silver_games(store):
    return store.drop("genre", "languages")


def silver_genres(store, *keys):
    """One row per token; a missing list stays as one null row, empty tokens stay."""
    rows = explode_tokens(store.select("appid", *keys, "genre"), "genre", keep_null=True)
    return exclude_value(rows, "genre", FREE_TO_PLAY)


def silver_languages(store, *keys, ignore_footnote=False):
    """One row per title and language, with audio if any mention has it."""
    return normalize_languages(store, ["appid", *keys], ignore_footnote=ignore_footnote)
