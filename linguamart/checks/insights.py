"""Analyst questions over the stand-in catalogue."""

from ..plans import insights
from . import gold
from . import standins as s
from .registry import query

_ALL = (*s.BASE_FACT, s.LANGUAGE_TOKENS, s.STAGING_LANGUAGES, s.DIM_LANGUAGES, s.DIM_GENRES, """per_title AS (
  SELECT appid, count(DISTINCT language) AS n_languages FROM dim_languages GROUP BY appid)""", """covered AS (
  SELECT f.*, COALESCE(n_languages, 0) AS n_languages FROM fct_games f LEFT JOIN per_title l ON f.appid = l.appid)""")


def _sql(select):
    return s.sql(*_ALL, select=select)


_AUDIO = """SELECT language, count(*) AS n_titles,
       CAST(count(*) FILTER (WHERE audio AND lower(language) <> 'english') AS BIGINT) AS n_with_audio,
       CAST(count(*) FILTER (WHERE NOT audio) AS BIGINT) AS n_without_audio
FROM (SELECT language, appid, bool_or(has_audio_support) AS audio FROM {source} GROUP BY ALL)
GROUP BY language ORDER BY n_titles DESC, language LIMIT {n}"""


@query("q_most_languages", _sql("""
SELECT f.appid, title, n_languages FROM fct_games f JOIN per_title l ON f.appid = l.appid
ORDER BY n_languages DESC, f.appid LIMIT 20"""))
def most_languages(spark, sf_dir):
    return insights.most_languages(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


@query("q_language_audio", _sql(_AUDIO.format(source="dim_languages", n=20)))
def language_audio(spark, sf_dir):
    return insights.language_audio(gold.dim_languages(spark, sf_dir))


@query("q_audio_impact", _sql("""
SELECT has_audio, count(*) AS n_titles, round(avg(ccu), 4) AS avg_ccu, round(avg(positive_ratio), 4) AS avg_positive_ratio,
       round(avg(total_reviews), 4) AS avg_total_reviews, quantile_cont(CAST(ccu AS DOUBLE), 0.5) AS median_ccu
FROM (SELECT f.*, COALESCE(audio, false) AS has_audio FROM fct_games f LEFT JOIN (
  SELECT appid, bool_or(has_audio_support AND lower(language) <> 'english') AS audio FROM dim_languages GROUP BY appid) a ON f.appid = a.appid)
GROUP BY has_audio"""))
def audio_impact(spark, sf_dir):
    return insights.audio_impact(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


_HEAT = """heat AS (
  SELECT c.genre, language, n_titles, genre_titles, round(CAST(n_titles AS DOUBLE) / genre_titles, 4) AS share FROM (
    SELECT g.genre, language, count(DISTINCT g.appid) AS n_titles FROM dim_genres g JOIN dim_languages l ON g.appid = l.appid GROUP BY ALL) c
  JOIN (SELECT genre, count(DISTINCT appid) AS genre_titles FROM dim_genres GROUP BY genre) t ON c.genre = t.genre)"""


@query("q_genre_heatmap", s.sql(*_ALL, _HEAT, select="SELECT * FROM heat"))
def genre_heatmap(spark, sf_dir):
    return insights.genre_heatmap(*gold.built(spark, sf_dir, "dim_genres", "dim_languages"))


@query("q_genre_heatmap_bitmaps", s.sql(*_ALL, _HEAT, select="SELECT * FROM heat"))
def genre_heatmap_bitmaps(spark, sf_dir):
    return insights.genre_heatmap_by_bitmaps(*gold.built(spark, sf_dir, "dim_genres", "dim_languages"))


@query("q_genre_heatmap_grid", s.sql(*_ALL, _HEAT, select="""
SELECT genre, max(share) FILTER (WHERE language = 'English') AS English, max(share) FILTER (WHERE language = 'Polish') AS Polish,
       max(share) FILTER (WHERE language = 'Slovakian') AS Slovakian FROM heat GROUP BY genre"""))
def heatmap_grid(spark, sf_dir):
    heat = insights.genre_heatmap(*gold.built(spark, sf_dir, "dim_genres", "dim_languages"))
    return insights.heatmap_grid(heat, ["English", "Polish", "Slovakian"])


_POPULAR = "popular AS (SELECT appid, title, ccu FROM fct_games ORDER BY ccu DESC, appid LIMIT 100)"


@query("q_missing_localization", s.sql(*_ALL, _POPULAR, """wanted AS (
  SELECT language FROM dim_languages GROUP BY language ORDER BY count(DISTINCT appid) DESC, language LIMIT 10)""", select="""
SELECT p.appid, title, ccu, w.language FROM popular p, wanted w
WHERE NOT EXISTS (SELECT 1 FROM dim_languages d WHERE d.appid = p.appid AND d.language = w.language)"""))
def missing_localization(spark, sf_dir):
    return insights.missing_localization(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


@query("q_coverage_vs_perf", _sql("""
SELECT 'ccu' AS metric, round(corr(n_languages, ccu), 6) AS correlation FROM covered
UNION ALL SELECT 'positive_ratio', round(corr(n_languages, positive_ratio), 6) FROM covered
UNION ALL SELECT 'total_reviews', round(corr(n_languages, total_reviews), 6) FROM covered"""))
def coverage_vs_perf(spark, sf_dir):
    return insights.coverage_correlation(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


@query("q_coverage_buckets", _sql("""
SELECT n_languages // 2 * 2 AS coverage_from, count(*) AS n_titles, round(avg(ccu), 4) AS avg_ccu,
       round(avg(positive_ratio), 4) AS avg_positive_ratio, round(avg(total_reviews), 4) AS avg_total_reviews
FROM covered GROUP BY 1"""))
def coverage_buckets(spark, sf_dir):
    return insights.coverage_buckets(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


@query("q_genre_activity", _sql("""
SELECT genre, count(*) AS n_titles, round(avg(COALESCE(n_languages, 0)), 4) AS avg_languages
FROM dim_genres g LEFT JOIN per_title l ON g.appid = l.appid GROUP BY genre"""))
def genre_activity(spark, sf_dir):
    return insights.genre_activity(*gold.built(spark, sf_dir, "dim_genres", "dim_languages"))


@query("q_popular_languages", s.sql(*_ALL, _POPULAR, select=_AUDIO.format(
    source="(SELECT * FROM dim_languages WHERE appid IN (SELECT appid FROM popular))", n=20)))
def popular_languages(spark, sf_dir):
    return insights.popular_languages(*gold.built(spark, sf_dir, "fct_games", "dim_languages"))


@query("q_opportunity", _sql("""
SELECT genre, owners_category, n_titles, round(ccu, 4) AS avg_ccu, round(langs, 4) AS avg_languages,
       ccu > (SELECT avg(ccu) FROM covered) AND langs < (SELECT quantile_cont(CAST(n_languages AS DOUBLE), 0.5) FROM covered) AS is_opportunity
FROM (SELECT genre, owners_category, count(*) AS n_titles, avg(ccu) AS ccu, avg(n_languages) AS langs
      FROM dim_genres g JOIN covered c ON g.appid = c.appid GROUP BY ALL)"""))
def opportunity(spark, sf_dir):
    return insights.opportunity_segments(*gold.built(spark, sf_dir, "fct_games", "dim_genres", "dim_languages"))


query("q_trend", s.TREND)(lambda spark, sf_dir: insights.daily_trend(gold.fct_games_daily(spark, sf_dir)))
