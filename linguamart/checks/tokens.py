"""Delimited text to tokens."""

from pyspark.sql import functions as F

from ..functions import count_tokens, pick_by_priority
from ..operators import exclude_value, explode_tokens, normalize_languages
from . import standins as s
from .registry import query, table


@query("q_token_count", f"""
SELECT doc_id, CAST(len(list_filter(string_split(COALESCE(text, ''), ','), lambda x: {s.sql_strip('x')} <> '')) AS BIGINT) AS n_parts,
       CAST(len(list_filter(string_split(COALESCE(text, ''), '.'), lambda x: {s.sql_strip('x')} <> '')) AS BIGINT) AS n_sentences
FROM documents""")
def token_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", count_tokens(F.col("text")).alias("n_parts"), count_tokens(F.col("text"), ".").alias("n_sentences")
    )



@query("q_genre_explode_strict", s.sql(s.RAW_STORE, select=f"""
SELECT appid, file_path, genre FROM (
  SELECT appid, file_path, {s.sql_strip('g')} AS genre FROM (SELECT appid, file_path, unnest(string_split(genre, ',')) AS g FROM raw_store)
  UNION ALL SELECT appid, file_path, NULL FROM raw_store WHERE genre IS NULL)
WHERE genre IS NULL OR genre <> 'Free To Play'"""))
def genre_explode_strict(spark, sf_dir):
    raw = s.raw_store(spark, sf_dir).select("appid", "file_path", "genre")
    return exclude_value(explode_tokens(raw, "genre", keep_null=True), "genre", "Free To Play")


@query("q_genre_explode_ci", s.sql(s.RAW_STORE, select=f"""
SELECT DISTINCT appid, genre FROM (
  SELECT appid, {s.sql_strip('g')} AS genre FROM (SELECT appid, unnest(string_split(COALESCE(genre, ''), ',')) AS g FROM raw_store))
WHERE genre <> '' AND lower(genre) <> 'free to play'"""))
def genre_explode_ci(spark, sf_dir):
    rows = explode_tokens(s.raw_store(spark, sf_dir).select("appid", "genre"), "genre")
    return exclude_value(rows, "genre", "Free To Play", ignore_case=True, drop_empty=True).distinct()


@query("q_left_unnest", s.sql(s.RAW_STORE, select=f"""
SELECT appid, file_path, token FROM raw_store LEFT JOIN LATERAL (
  SELECT {s.sql_strip('g')} AS token FROM (SELECT unnest(string_split(COALESCE(genre, ''), ',')) AS g)
  WHERE {s.sql_strip('g')} <> '') ON true"""))
def left_unnest(spark, sf_dir):
    raw = s.raw_store(spark, sf_dir).select("appid", "file_path", "genre")
    return explode_tokens(raw, "genre", "token", drop_blank=True, keep_row=True)


@query("q_audio_marker_norm", s.sql(s.RAW_STORE, s.CLEAN_STORE, s.LANGUAGE_TOKENS, select="""
SELECT appid, language, bool_or(audio) AS audio FROM silver_languages GROUP BY appid, language"""))
def audio_marker_norm(spark, sf_dir):
    from ..functions import replace_codes

    raw = s.raw_store(spark, sf_dir).withColumn("languages", replace_codes(F.col("languages")))
    return normalize_languages(raw, ["appid"])


@query("q_audio_marker_notebook", s.sql(s.RAW_STORE, select=f"""
SELECT appid, {s.sql_strip("replace(raw, '<strong>*</strong>', '')")} AS language, contains(raw, '<strong>*</strong>') AS audio
FROM (SELECT appid, unnest(CASE WHEN languages IS NULL THEN [CAST(NULL AS VARCHAR)] ELSE string_split(languages, ',') END) AS raw FROM raw_store)"""))
def audio_marker_notebook(spark, sf_dir):
    return normalize_languages(s.raw_store(spark, sf_dir), ["appid"], strict_mark=True, dedupe=False)


@query("q_priority_words", f"""
WITH words AS (SELECT p_partkey, lower(unnest(string_split(p_name || ' ' || p_type, ' '))) AS word FROM part)
SELECT p_partkey, first(word ORDER BY CASE word WHEN 'bolt' THEN 1 WHEN 'ring' THEN 2 WHEN 'small' THEN 3 ELSE 999 END, word) AS chosen
FROM words GROUP BY p_partkey""")
def priority_words(spark, sf_dir):
    words = F.concat_ws(" ", "p_name", "p_type")
    chosen = pick_by_priority(words, {"bolt": 1, "ring": 2, "small": 3}, sep=" ")
    return table(spark, sf_dir, "part").select("p_partkey", chosen.alias("chosen"))
