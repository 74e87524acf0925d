"""Staging views: typed columns, latest row per title."""

from pyspark.sql import functions as F

from ..functions import is_footnote, tidy_language
from ..operators import cast_columns, latest_per_key, require_keys

STORE_TYPES = {
    "appid": "long", "price_usd": "double", "price_pln": "double", "release_date": "date",
    "languages": "string", "genre": "string", "release_date_missing": "boolean",
}

POPULARITY_TYPES = {
    "appid": "long", "title": "string", "positive_reviews": "long", "negative_reviews": "long", "ccu": "long",
    "owners_category": "string", "average_forever": "double", "average_2weeks": "double",
    "median_forever": "double", "median_2weeks": "double", "ingestion_date": "date",
}


def _rounded_counts(df, names):
    """Counts that arrive as fractions are rounded, not cut."""
    fractions = {c: F.round(F.col(c)) for c, kind in df.dtypes if c in names and kind in ("double", "float")}
    return df.withColumns(fractions) if fractions else df


def typed_store(source):
    """Cast columns; an unreadable release date becomes null, any other bad value stops the job."""
    return cast_columns(require_keys(source, "appid"), STORE_TYPES, safe=("release_date",))


def typed_popularity(source):
    renamed = require_keys(source, "appid").withColumnsRenamed(
        {"name": "title", "positive": "positive_reviews", "negative": "negative_reviews"}
    )
    counts = _rounded_counts(renamed, ("positive_reviews", "negative_reviews", "ccu"))
    return cast_columns(counts, POPULARITY_TYPES, safe=("ingestion_date",))


def staging_store(source, ties=("snapshot_date", "file_path")):
    """Row with the newest release date per title; ``ties`` settle equal dates, newest first."""
    typed = typed_store(source)
    order = ["release_date", *[c for c in ties if c in typed.columns]]
    columns = ["appid", "price_usd", "price_pln", "release_date", "release_date_missing", "languages", "genre"]
    return latest_per_key(typed, ["appid"], *order).select(*columns)


def staging_popularity(source, ties=("file_path",)):
    """Row with the newest ingestion date per title."""
    typed = typed_popularity(source)
    order = ["ingestion_date", *[c for c in ties if c in typed.columns]]
    return latest_per_key(typed, ["appid"], *order).select(*POPULARITY_TYPES)


def staging_languages(source):
    """Distinct (title, language, audio) rows with tidy names."""
    rows = source.select(
        F.col("appid").cast("long").alias("appid"),
        tidy_language(F.col("language").cast("string")).alias("language"),
        F.coalesce(F.col("audio").cast("boolean"), F.lit(False)).alias("has_audio_support"),
    )
    kept = (F.col("language") != "") & ~is_footnote(F.col("language"))
    return require_keys(rows, "appid", "language").where(kept).distinct()
