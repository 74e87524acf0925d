"""Marts: facts and dimensions."""

from pyspark.sql import functions as F

from ..constants import FREE_TO_PLAY
from ..functions import add_counts, count_or_zero, count_tokens, guarded_ratio, pick_by_priority, surrogate_key
from ..operators import exclude_value, explode_tokens, latest_per_key, primary_by_join
from .staging import typed_popularity, typed_store

PLAYTIMES = ["average_forever", "average_2weeks", "median_forever", "median_2weeks"]


def _popularity_measures():
    """Counters where a title without popularity counts as 0, and its share of positive reviews."""
    total = add_counts(F.col("positive_reviews"), F.col("negative_reviews"))
    return [
        "owners_category",
        count_or_zero(F.col("ccu")).alias("ccu"),
        count_or_zero(F.col("positive_reviews")).alias("positive_reviews"),
        count_or_zero(F.col("negative_reviews")).alias("negative_reviews"),
        total.alias("total_reviews"),
        guarded_ratio(count_or_zero(F.col("positive_reviews")), total).alias("positive_ratio"),
        *[count_or_zero(F.col(c)).alias(c) for c in PLAYTIMES],
    ]


def _title():
    return F.coalesce("title", F.col("appid").cast("string")).alias("title")


def fct_games(store, popularity):
    """Every staged title with its latest popularity."""
    return store.join(popularity, "appid", "left").select(
        "appid", _title(), "release_date", "release_date_missing", "price_usd", "price_pln", *_popularity_measures()
    )


def dim_genres(store):
    """Distinct (title, genre) without the free-to-play mark."""
    rows = explode_tokens(store.select("appid", "genre"), "genre")
    return exclude_value(rows, "genre", FREE_TO_PLAY, ignore_case=True, drop_empty=True).select("appid", "genre").distinct()


def dim_languages(languages, one_per_key=False):
    """Staged languages (rows without repeats) with their key. ``one_per_key`` folds spellings and audio flags of a key together."""
    # Staged languages are distinct already.
    keyed = languages.withColumn("language_key", surrogate_key(F.col("appid"), F.lower("language")))
    if one_per_key:
        keyed = keyed.groupBy("language_key", "appid").agg(
            F.min("language").alias("language"), F.bool_or("has_audio_support").alias("has_audio_support")
        )
    return keyed.select("language_key", "appid", "language", "has_audio_support")


def store_daily(source, seed=None):
    """One store row per (title, day): the one from the greatest file path, lists turned into counts.

    ``seed`` names a priority table to join; without it the built-in priorities are looked up
    inside each row.
    """
    keys = ["appid", "snapshot_date"]
    daily = latest_per_key(typed_store(source), keys, "file_path")
    out = daily.select(
        *keys, "price_usd", "price_pln", "release_date", "release_date_missing",
        count_tokens(F.col("languages")).alias("languages"),
        count_tokens(F.col("genre")).alias("genre"),
        (F.col("genre") if seed is not None else pick_by_priority(F.col("genre"))).alias("primary_genre"),
    )
    if seed is None:
        return out
    primary = primary_by_join(out, keys, "primary_genre", seed, out="__primary")
    return out.join(primary, keys, "left").withColumn(
        "primary_genre", F.coalesce("__primary", F.lit("other"))
    ).drop("__primary")


def popularity_daily(source):
    """One popularity row per (title, day)."""
    return latest_per_key(typed_popularity(source), ["appid", "snapshot_date"], "file_path")


def fct_games_daily(store_source, popularity_source, seed=None):
    """Fact at (title, day). Both sides meet on the keys they were deduplicated by, so the join adds no shuffle."""
    keys = ["appid", "snapshot_date"]
    popularity = popularity_daily(popularity_source).select(
        *keys, "title", "positive_reviews", "negative_reviews", "ccu", "owners_category", *PLAYTIMES
    )
    return store_daily(store_source, seed).join(popularity, keys, "left").select(
        *keys, _title(), "release_date", "release_date_missing", "price_usd", "price_pln",
        "languages", "genre", "primary_genre", *_popularity_measures(),
    )


# Checks that only report: two spellings of a language share a key.
REPORTED = {("dim_languages", "language_key", "unique")}

# Checks every build of the tables has to pass.
CHECKS = {
    "staging_store": {"not_null": ["appid"], "unique": ["appid"]},
    "staging_popularity": {"not_null": ["appid", "title"], "unique": ["appid"]},
    "staging_languages": {"not_null": ["appid", "language"]},
    "fct_games_daily": {"not_null": ["appid", "snapshot_date", "primary_genre"]},
    "fct_games": {"not_null": ["appid", "title"], "unique": ["appid"]},
    "dim_genres": {"not_null": ["appid", "genre"]},
    "dim_languages": {"not_null": ["language_key", "appid", "language"], "unique": ["language_key"]},
}
