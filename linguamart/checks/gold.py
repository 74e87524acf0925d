"""Staging views and marts over the stand-in catalogue."""

from pyspark.sql import functions as F

from ..constants import RELEASE_DATE_FORMATS
from ..functions import parse_date
from ..operators import best_per_key
from ..plans import marts, silver, staging
from ..session import stored
from ..sources import genre_seed
from . import standins as s
from .registry import query


def silver_store(spark, sf_dir):
    return silver.clean_store(s.raw_store(spark, sf_dir))


def silver_popularity(spark, sf_dir):
    raw = s.raw_popularity(spark, sf_dir)
    best = lambda df: best_per_key(df, ["appid", "snapshot_date"], [F.desc_nulls_last("ccu"), "file_path"])
    return silver.silver_popularity(raw, best, F.col("snapshot_date"))


def staging_store(spark, sf_dir):
    return staging.staging_store(silver_store(spark, sf_dir))


def staging_popularity(spark, sf_dir):
    return staging.staging_popularity(silver_popularity(spark, sf_dir))


def staging_languages(spark, sf_dir):
    return staging.staging_languages(silver.silver_languages(silver_store(spark, sf_dir), "snapshot_date"))


def fct_games(spark, sf_dir):
    return marts.fct_games(staging_store(spark, sf_dir), staging_popularity(spark, sf_dir))


def fct_games_daily(spark, sf_dir, seed=None):
    return marts.fct_games_daily(silver_store(spark, sf_dir), silver_popularity(spark, sf_dir), seed)


def dim_genres(spark, sf_dir):
    return marts.dim_genres(staging_store(spark, sf_dir))


def dim_languages(spark, sf_dir):
    return marts.dim_languages(staging_languages(spark, sf_dir))


def newest_store(spark, sf_dir):
    """Silver store rows that staging picks: a title's row of the newest release date, told from the raw texts, so that only it is cleaned."""
    order = [parse_date(F.col("release_date"), RELEASE_DATE_FORMATS), "snapshot_date", "file_path"]
    newest = lambda df: best_per_key(df, ["appid"], [F.desc_nulls_last(c) for c in order])
    return silver.silver_store(s.raw_store(spark, sf_dir), newest)


def newest_popularity(spark, sf_dir):
    """Silver popularity rows that staging picks: the row with most players of a title's newest day."""
    order = [F.desc_nulls_last("snapshot_date"), F.desc_nulls_last("ccu"), "file_path"]
    return silver.silver_popularity(s.raw_popularity(spark, sf_dir), lambda df: best_per_key(df, ["appid"], order), F.col("snapshot_date"))


def built(spark, sf_dir, *names):
    """Staging tables and marts by name, as a daily run builds them.

    Where only a title's newest row goes on, it is picked from the raw rows, before they are cleaned and in one shuffle. Each
    table parses the raw columns that the question reads and no others. What several tables start from, or a question
    reads more than once, is stored.
    """
    need = set(names)
    done = {}
    if need & {"fct_games", "dim_genres", "staging_store"}:
        titles = staging.staging_store(newest_store(spark, sf_dir))
        shared = "staging_store" in need or {"fct_games", "dim_genres"} <= need
        done["staging_store"] = stored(titles, "staging_store") if shared else titles
    if need & {"dim_languages", "staging_languages"}:
        spoken = staging.staging_languages(silver.silver_languages(silver_store(spark, sf_dir), "snapshot_date"))
        done["staging_languages"] = stored(spoken, "staging_languages")
    if "fct_games_daily" in need:
        popularity = stored(silver_popularity(spark, sf_dir), "silver_popularity")
    if need & {"fct_games", "staging_popularity"}:
        players = staging.staging_popularity(popularity if "fct_games_daily" in need else newest_popularity(spark, sf_dir))
        done["staging_popularity"] = stored(players, "staging_popularity") if "staging_popularity" in need else players
    makers = {
        "fct_games": lambda: marts.fct_games(done["staging_store"], done["staging_popularity"]),
        "dim_genres": lambda: stored(marts.dim_genres(done["staging_store"]), "dim_genres"),
        "dim_languages": lambda: marts.dim_languages(done["staging_languages"]),
        "fct_games_daily": lambda: marts.fct_games_daily(silver_store(spark, sf_dir), popularity),
    }
    return [done[name] if name in done else makers[name]() for name in names]


_FACT_SQL = s.sql(*s.BASE_FACT, select="SELECT * FROM fct_games")
_DAILY_SQL = s.sql(*s.BASE_DAILY, select="SELECT * FROM fct_games_daily")

query("q_fct_games", _FACT_SQL)(fct_games)
query("q_fct_games_daily", _DAILY_SQL)(fct_games_daily)


@query("q_fct_games_daily_seed_join", _DAILY_SQL)
def fct_games_daily_seed_join(spark, sf_dir):
    return fct_games_daily(spark, sf_dir, genre_seed(spark))


query("q_staging_store", s.sql(s.RAW_STORE, s.CLEAN_STORE, s.STAGING_STORE, select=(
    "SELECT appid, price_usd, price_pln, release_date, release_date_missing, languages, genre FROM staging_store"
)))(staging_store)

query("q_staging_popularity", s.sql(
    s.RAW_POPULARITY, s.SILVER_POPULARITY, s.STAGING_POPULARITY, select="SELECT * FROM staging_popularity"
))(staging_popularity)

query("q_staging_languages", s.sql(
    s.RAW_STORE, s.CLEAN_STORE, s.LANGUAGE_TOKENS, s.STAGING_LANGUAGES, select="SELECT * FROM staging_languages"
))(staging_languages)

query("q_dim_genres", s.sql(
    s.RAW_STORE, s.CLEAN_STORE, s.STAGING_STORE, s.DIM_GENRES, select="SELECT appid, genre FROM dim_genres"
))(dim_genres)

query("q_dim_languages", s.sql(*s.BASE_LANGUAGES, select="SELECT * FROM dim_languages"))(dim_languages)


@query("q_dim_languages_one_per_key", s.sql(*s.BASE_LANGUAGES, select="""
SELECT language_key, appid, min(language) AS language, bool_or(has_audio_support) AS has_audio_support
FROM dim_languages GROUP BY language_key, appid"""))
def dim_languages_one_per_key(spark, sf_dir):
    return marts.dim_languages(staging_languages(spark, sf_dir), one_per_key=True)


@query("q_silver_popularity", s.sql(s.RAW_POPULARITY, s.SILVER_POPULARITY, select="""
SELECT appid, ingestion_date, name, owners_category, positive, negative, ccu,
       average_forever, average_2weeks, median_forever, median_2weeks FROM clean_popularity"""))
def silver_popularity_rows(spark, sf_dir):
    return silver_popularity(spark, sf_dir).drop("snapshot_date", "file_path")


@query("q_silver_store", s.sql(s.RAW_STORE, """first_raw AS (
  SELECT * FROM raw_store QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY file_path) = 1)""",
    s.CLEAN_STORE.replace("FROM raw_store)", "FROM first_raw)"), select="""
SELECT appid, snapshot_date, price_usd, price_pln, release_date, release_date_missing, languages, genre FROM clean_store"""))
def silver_store_rows(spark, sf_dir):
    first = lambda df: best_per_key(df, ["appid", "snapshot_date"], ["file_path"])
    return silver.silver_store(s.raw_store(spark, sf_dir), first).drop("file_path")


@query("q_two_key_join", s.sql(*s.BASE_DAILY[:-1], select="""
SELECT s.appid, s.snapshot_date, s.languages, s.genre, s.primary_genre, p.title, p.ccu
FROM store_daily s LEFT JOIN popularity_daily p ON s.appid = p.appid AND s.snapshot_date = p.snapshot_date"""))
def two_key_join(spark, sf_dir):
    left = marts.store_daily(silver_store(spark, sf_dir))
    right = marts.popularity_daily(silver_popularity(spark, sf_dir))
    return left.join(right, ["appid", "snapshot_date"], "left").select(
        "appid", "snapshot_date", "languages", "genre", "primary_genre", "title", "ccu"
    )


_PRIMARY_SQL = s.sql(s.RAW_STORE, s.CLEAN_STORE, s.STORE_DAILY, select="SELECT appid, snapshot_date, primary_genre FROM store_daily")


@query("q_primary_genre", _PRIMARY_SQL)
def primary_genre(spark, sf_dir):
    return marts.store_daily(silver_store(spark, sf_dir)).select("appid", "snapshot_date", "primary_genre")


@query("q_primary_genre_by_join", _PRIMARY_SQL)
def primary_genre_by_join(spark, sf_dir):
    daily = marts.store_daily(silver_store(spark, sf_dir), genre_seed(spark))
    return daily.select("appid", "snapshot_date", "primary_genre")


@query("q_silver_genres", s.sql(s.RAW_STORE, s.CLEAN_STORE, s.STAGING_STORE, select=f"""
SELECT appid, genre FROM (
  SELECT appid, {s.sql_strip('g')} AS genre FROM (SELECT appid, unnest(string_split(genre, ',')) AS g FROM staging_store)
  UNION ALL SELECT appid, NULL FROM staging_store WHERE genre IS NULL)
WHERE genre IS NULL OR genre <> 'Free To Play'"""))
def silver_genres(spark, sf_dir):
    return silver.silver_genres(staging_store(spark, sf_dir))


@query("q_silver_games", s.sql(s.RAW_STORE, s.CLEAN_STORE, s.STAGING_STORE, select="""
SELECT appid, price_usd, price_pln, release_date, release_date_missing FROM staging_store"""))
def silver_games(spark, sf_dir):
    return silver.silver_games(staging_store(spark, sf_dir))


@query("q_silver_languages", s.sql(
    s.RAW_STORE, s.CLEAN_STORE, s.LANGUAGE_TOKENS, select="SELECT * FROM silver_languages"
))
def silver_languages(spark, sf_dir):
    return silver.silver_languages(silver_store(spark, sf_dir), "snapshot_date")


@query("q_silver_languages_no_footnote", s.sql(
    s.RAW_STORE,
    s.CLEAN_STORE.replace("replace(languages,", "replace(regexp_replace(languages, "
                          "'(<br[ ]*/?>)?[ ]*<strong>[*]</strong>[ ]*languages with full audio support', '', 'gi'),"),
    s.LANGUAGE_TOKENS, select="SELECT * FROM silver_languages"
))
def silver_languages_no_footnote(spark, sf_dir):
    return silver.silver_languages(silver_store(spark, sf_dir), "snapshot_date", ignore_footnote=True)
