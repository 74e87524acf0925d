"""Landed JSON payloads, two-region merge and ranked lists."""

from pyspark.sql import functions as F

from ..operators import (
    attach_details, merge_regions, popularity_records, ranked_items, region_counters, store_records, union_lists,
)
from .registry import query, table

_SQL_POPULARITY_DOCS = """docs AS (
  SELECT event_id, '{"' || event_id || '":' || CASE event_type
           WHEN 'error' THEN '5'
           WHEN 'view' THEN '{"ccu":"x","name":"V"}'
           WHEN 'click' THEN '{"appid":' || user_id || ',"ccu":' || json_extract_string(props, '$.k') || '}'
           WHEN 'signup' THEN '{"appid":null,"ccu":1}'
           ELSE '{"appid":"' || user_id || '","ccu":7,"name":"P"}' END || ',"abc":{"ccu":1}}' AS payload
  FROM events)"""


def _popularity_docs(spark, sf_dir):
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    body = (
        F.when(kind == "error", "5").when(kind == "view", '{"ccu":"x","name":"V"}')
        .when(kind == "click", F.concat(
            F.lit('{"appid":'), user, F.lit(',"ccu":'), F.get_json_object("props", "$.k"), F.lit("}")))
        .when(kind == "signup", '{"appid":null,"ccu":1}')
        .otherwise(F.concat(F.lit('{"appid":"'), user, F.lit('","ccu":7,"name":"P"}')))
    )
    payload = F.concat(F.lit('{"'), F.col("event_id").cast("string"), F.lit('":'), body, F.lit(',"abc":{"ccu":1}}'))
    return table(spark, sf_dir, "events").select("event_id", payload.alias("payload"))


@query("q_payload_rows", f"""WITH {_SQL_POPULARITY_DOCS},
entries AS (SELECT event_id, e.key AS k, e.value AS v FROM docs, json_each(docs.payload) AS e WHERE json_type(e.value) = 'OBJECT')
SELECT event_id, appid, TRY_CAST(v->>'$.ccu' AS BIGINT) AS ccu, v->>'$.name' AS name FROM (
  SELECT *, TRY_CAST(CASE WHEN json_exists(v, '$.appid') THEN v->>'$.appid' ELSE k END AS BIGINT) AS appid FROM entries)
WHERE appid IS NOT NULL""")
def payload_rows(spark, sf_dir):
    return popularity_records(_popularity_docs(spark, sf_dir), "payload", {"ccu": "long", "name": "string"})


_SQL_REGION = """{name} AS (
  SELECT p_partkey, '{{"' || p_partkey || '":' || CASE
      WHEN {miss} THEN '{{"success":false}}'
      WHEN p_size = 7 THEN '{{"success":true,"data":[]}}'
      WHEN p_size = 8 THEN '{{"success":true,"data":{{}}}}'
      WHEN p_size < 20 THEN '{{"success":true,"data":{{"price_overview":{{"final_formatted":"{sign}' || p_size || '"}},"release_date":{{"date":"1 Jul, 2013"}},'
        || '"supported_languages":"","languages":"English, #lang_slovakian","genres":[{{"description":"' || p_type || '"}},{{"id":"1"}},{{"description":"RPG"}}]}}}}'
      ELSE '{{"success":true,"data":{{"release_date":{{"date":"{other}"}},"supported_languages":"' || p_name || '","genres":[]}}}}' END || '}}' AS payload
  FROM part)"""
_SQL_FIRST = _SQL_REGION.format(name="first_docs", miss="p_type = 'PROMO'", sign="$", other="Coming soon")
_SQL_SECOND = _SQL_REGION.format(name="second_docs", miss="p_brand = 'Brand#1'", sign="zł", other="2024")


def _region(spark, sf_dir, miss, sign, other):
    size, text = F.col("p_size"), lambda c: F.col(c).cast("string")
    full = F.concat(
        F.lit('{"success":true,"data":{"price_overview":{"final_formatted":"' + sign), text("p_size"),
        F.lit('"},"release_date":{"date":"1 Jul, 2013"},"supported_languages":"","languages":"English, #lang_slovakian",'
              '"genres":[{"description":"'), F.col("p_type"), F.lit('"},{"id":"1"},{"description":"RPG"}]}}'),
    )
    plain = F.concat(
        F.lit('{"success":true,"data":{"release_date":{"date":"' + other + '"},"supported_languages":"'),
        F.col("p_name"), F.lit('","genres":[]}}'),
    )
    body = (
        F.when(miss, '{"success":false}').when(size == 7, '{"success":true,"data":[]}')
        .when(size == 8, '{"success":true,"data":{}}').when(size < 20, full).otherwise(plain)
    )
    payload = F.concat(F.lit('{"'), text("p_partkey"), F.lit('":'), body, F.lit("}"))
    return store_records(table(spark, sf_dir, "part").select(payload.alias("payload")), "payload")


def _regions(spark, sf_dir):
    return (
        _region(spark, sf_dir, F.col("p_type") == "PROMO", "$", "Coming soon"),
        _region(spark, sf_dir, F.col("p_brand") == "Brand#1", "zł", "2024"),
    )


_SQL_RECORDS = """{out} AS (
  SELECT CAST(e.key AS BIGINT) AS appid, len(json_keys(e.value, '$.data')) > 0 AS has_data,
         e.value->>'$.data.price_overview.final_formatted' AS price, e.value->>'$.data.release_date.date' AS release_date,
         replace(COALESCE(nullif(e.value->>'$.data.supported_languages', ''), e.value->>'$.data.languages'), '#lang_slovakian', 'Slovakian') AS languages,
         COALESCE(array_to_string(list_transform(CAST(json_extract(e.value, '$.data.genres') AS JSON[]), lambda g: COALESCE(g->>'$.description', '')), ', '), '') AS genre
  FROM {docs}, json_each({docs}.payload) AS e
  WHERE (e.value->>'$.success') = 'true' AND json_type(e.value, '$.data') = 'OBJECT')"""
_SQL_BOTH = ",\n".join([
    _SQL_FIRST, _SQL_SECOND, _SQL_RECORDS.format(out="a", docs="first_docs"), _SQL_RECORDS.format(out="b", docs="second_docs"),
])


@query("q_store_payload", f"WITH {_SQL_FIRST}, {_SQL_RECORDS.format(out='a', docs='first_docs')} SELECT * FROM a")
def store_payload(spark, sf_dir):
    return _regions(spark, sf_dir)[0]


@query("q_region_merge", f"""WITH {_SQL_BOTH}
SELECT COALESCE(a.appid, b.appid) AS appid, CASE WHEN a.has_data THEN a.price END AS price_usd, CASE WHEN b.has_data THEN b.price END AS price_pln,
       CASE WHEN a.has_data THEN a.release_date ELSE b.release_date END AS release_date,
       CASE WHEN a.has_data THEN a.languages ELSE b.languages END AS languages,
       CASE WHEN a.has_data THEN a.genre ELSE b.genre END AS genre
FROM a FULL JOIN b ON a.appid = b.appid WHERE COALESCE(a.has_data, false) OR COALESCE(b.has_data, false)""")
def region_merge(spark, sf_dir):
    return merge_regions(*_regions(spark, sf_dir))


@query("q_region_counters", f"""WITH {_SQL_BOTH}
SELECT count(a.appid) AS first_hits, count(b.appid) AS second_hits, count(*) AS any_hits,
       CAST(count(*) FILTER (WHERE COALESCE(a.has_data, false) OR COALESCE(b.has_data, false)) AS BIGINT) AS output_rows
FROM a FULL JOIN b ON a.appid = b.appid""")
def counters(spark, sf_dir):
    return region_counters(*_regions(spark, sf_dir))


@query("q_url_id_lists", r"""
WITH items AS (
  SELECT 'by_url' AS list_name, page_id, url AS logo, regexp_extract(url, '/(\d+)(?:[?#]|$)', 1) AS found FROM pages
  UNION ALL
  SELECT 'by_logo', page_id, logo, regexp_extract(logo, 'store/\w+/(\d+)', 1) FROM (
    SELECT page_id, 'https://x/store/' || CASE WHEN page_id % 2 = 0 THEN 'apps' ELSE 'bundles' END || '/' || page_id || '/c.jpg' AS logo FROM pages)
  UNION ALL
  SELECT 'by_logo', page_id, logo, regexp_extract(logo, 'store/\w+/(\d+)', 1) FROM (SELECT page_id, 'https://x/other/1' AS logo FROM pages))
SELECT list_name, page_id, logo, TRY_CAST(found AS BIGINT) AS appid, lang, source
FROM items LEFT JOIN documents ON doc_id = TRY_CAST(found AS BIGINT)""")
def url_id_lists(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    entry = lambda c: F.struct(c.alias("logo"))
    kind = F.when(F.pmod("page_id", F.lit(2)) == 0, "apps").otherwise("bundles")
    logo = F.concat(F.lit("https://x/store/"), kind, F.lit("/"), F.col("page_id").cast("string"), F.lit("/c.jpg"))
    by_url = ranked_items(pages.select("page_id", F.array(entry(F.col("url"))).alias("items")), pattern=r"/(\d+)(?:[?#]|$)")
    by_logo = ranked_items(
        pages.select("page_id", F.array(entry(logo), entry(F.lit("https://x/other/1"))).alias("items")),
        pattern=r"store/\w+/(\d+)",
    )
    lists = union_lists({"by_url": by_url, "by_logo": by_logo}).select(
        "list_name", "page_id", F.col("item")["logo"].alias("logo"), "appid"
    )
    details = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("appid"), "lang", "source")
    return attach_details(lists, details, "appid")
