"""Column functions and projections, each over a whole table."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import (
    add_counts, clean_language, clean_price, first_nonempty, guarded_ratio, parse_date, replace_codes, squeeze_ws,
    strip_ws, to_long,
)
from ..operators import (
    backfill_columns, cast_columns, clip_columns, drop_columns, exclude_value, fill_defaults, flag_missing,
    popularity_warnings, preview, recode, require_keys,
)
from .registry import query, table
from .standins import OWNERS, SQL_BANDS, _pick, _sql_pick, sql_date, sql_price, sql_strip
from ..constants import OWNER_BANDS


@query("q_price_clean_dot", f"""
WITH texts AS (
  SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'Free' WHEN 1 THEN '4-5' WHEN 2 THEN '$' || format('{{:,.2f}}', p_retailprice)
                    WHEN 3 THEN '-' || format('{{:.2f}}', p_retailprice) ELSE NULL END AS price FROM part)
SELECT p_partkey, price, {sql_price('price')} AS price_usd FROM texts""")
def price_clean_dot(spark, sf_dir):
    amount, kind = F.col("p_retailprice"), F.pmod("p_size", F.lit(5))
    price = (
        F.when(kind == 0, "Free").when(kind == 1, "4-5")
        .when(kind == 2, F.concat(F.lit("$"), F.format_number(amount, 2)))
        .when(kind == 3, F.concat(F.lit("-"), F.format_string("%.2f", amount)))
    )
    texts = table(spark, sf_dir, "part").select("p_partkey", price.alias("price"))
    return texts.withColumn("price_usd", clean_price(F.col("price"), "."))


@query("q_price_clean_comma", r"""
WITH texts AS (
  SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '(' || replace(format('{:.2f}', p_retailprice), '.', ',') || ')'
         ELSE translate(format('{:,.2f}', p_retailprice), ',.', ' ,') || 'zł' END AS price FROM part)
SELECT p_partkey, price,
       COALESCE(TRY_CAST(replace(regexp_replace(price, '[^0-9,\-]', '', 'g'), ',', '.') AS DOUBLE), 0.0) AS price_pln,
       COALESCE(TRY_CAST(replace(regexp_replace(price, '[^0-9,()\-]', '', 'g'), ',', '.') AS DOUBLE), 0.0) AS price_brackets
FROM texts""")
def price_clean_comma(spark, sf_dir):
    amount = F.col("p_retailprice")
    bracketed = F.concat(F.lit("("), F.replace(F.format_string("%.2f", amount), F.lit("."), F.lit(",")), F.lit(")"))
    spaced = F.concat(F.translate(F.format_number(amount, 2), ",.", " ,"), F.lit("zł"))
    price = F.when(F.pmod("p_size", F.lit(3)) == 0, bracketed).otherwise(spaced)
    texts = table(spark, sf_dir, "part").select("p_partkey", price.alias("price"))
    return texts.select(
        "p_partkey", "price", clean_price(F.col("price"), ",").alias("price_pln"),
        clean_price(F.col("price"), ",", keep_parentheses=True).alias("price_brackets"),
    )


@query("q_date_parse_flag", f"""
WITH texts AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%-d %b, %Y') WHEN 'F' THEN strftime(o_orderdate, '%b %-d, %Y')
         ELSE 'Q1 ' || CAST(year(o_orderdate) AS VARCHAR) END AS release_text FROM orders)
SELECT o_orderkey, {sql_date('release_text')} AS release_date, {sql_date('release_text')} IS NULL AS release_date_missing FROM texts""")
def date_parse_flag(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "d MMM, yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "MMM d, yyyy"))
        .otherwise(F.concat(F.lit("Q1 "), F.year(day).cast("string")))
    )
    texts = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("release_text"))
    parsed = texts.select("o_orderkey", parse_date(F.col("release_text")).alias("release_date"))
    return flag_missing(parsed, "release_date", "release_date_missing")


_SQL_PLAIN = (
    "regexp_replace(regexp_replace(html, '<br[ ]*/?>|<strong>[*]</strong>', ' ', 'g'), '<[^>]+>|[*]', ' ', 'g')"
)
# White space as a class of plain ranges, for an engine whose own class is ASCII only.
_SQL_SPACES = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query("q_html_clean", f"""
SELECT page_id, {sql_strip(f"regexp_replace(regexp_replace({_SQL_PLAIN}, 'languages with full audio support', '', 'gi'), '{_SQL_SPACES}', ' ', 'g')")} AS plain_text,
       {sql_strip(f"regexp_replace(url, '{_SQL_SPACES}', ' ', 'g')")} AS plain_url FROM pages""")
def html_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", clean_language(F.col("html")).alias("plain_text"), strip_ws(squeeze_ws(F.col("url"))).alias("plain_url")
    )


@query("q_code_replace", """
SELECT n_nationkey, replace(replace('#lang_' || n_name, '#lang_NATION_1', 'First'), '#lang_NATION_2', 'Second') AS language FROM nation""")
def code_replace(spark, sf_dir):
    coded = F.concat(F.lit("#lang_"), F.col("n_name"))
    codes = {"#lang_NATION_1": "First", "#lang_NATION_2": "Second"}
    return table(spark, sf_dir, "nation").select("n_nationkey", replace_codes(coded, codes).alias("language"))


@query("q_band_recode", f"""
WITH texts AS (SELECT o_orderkey, {_sql_pick(OWNERS, 'CAST(floor(o_totalprice) AS BIGINT)')} AS owners FROM orders)
SELECT o_orderkey, owners, {SQL_BANDS} AS owners_category FROM texts""")
def band_recode(spark, sf_dir):
    owners = _pick(OWNERS, F.floor("o_totalprice").cast("long"))
    texts = table(spark, sf_dir, "orders").select("o_orderkey", owners.alias("owners"))
    return texts.withColumn("owners_category", recode(F.col("owners"), OWNER_BANDS))


@query("q_popularity_warnings", f"""
WITH texts AS (SELECT c_nationkey, {_sql_pick(OWNERS, 'c_custkey')} AS owners, c_acctbal FROM customer)
SELECT CAST(count(*) FILTER (WHERE owners IS NOT NULL AND {SQL_BANDS} IS NULL) AS BIGINT) AS unmapped_owners,
       CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) AS negative_values,
       CAST(count(*) - count(DISTINCT c_nationkey) AS BIGINT) AS duplicate_rows FROM texts""")
def warnings(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").select("c_nationkey", _pick(OWNERS, F.col("c_custkey")).alias("owners"), "c_acctbal")
    return popularity_warnings(texts, OWNER_BANDS, ["c_acctbal"], key="c_nationkey")


@query("q_clip_negative", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer""")
def clip_negative(spark, sf_dir):
    return clip_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "absent"])


@query("q_schema_backfill", """
SELECT s_suppkey, s_name, s_acctbal, CAST(NULL AS VARCHAR) AS s_phone, CAST(NULL AS BIGINT) AS s_rank, s_nationkey AS nation_id FROM supplier""")
def schema_backfill(spark, sf_dir):
    expected = StructType([
        StructField("s_suppkey", LongType()), StructField("s_phone", StringType()), StructField("s_rank", LongType()),
        StructField("s_acctbal", DoubleType()),
    ])
    filled = backfill_columns(table(spark, sf_dir, "supplier"), expected)
    renamed = filled.withColumn("nation_id", F.col("s_nationkey"))
    return drop_columns(renamed, "s_nationkey", "s_comment")


@query("q_safe_cast", """
WITH texts AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' WHEN event_type = 'view' THEN NULL ELSE json_extract_string(props, '$.k') END AS k,
                      CAST(value AS VARCHAR) AS value_text FROM events)
SELECT event_id, TRY_CAST(k AS BIGINT) AS k, CAST(value_text AS DOUBLE) AS value_text FROM texts WHERE k IS NOT NULL""")
def safe_cast(spark, sf_dir):
    k = F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") != "view", F.get_json_object("props", "$.k"))
    texts = table(spark, sf_dir, "events").select("event_id", k.alias("k"), F.col("value").cast("string").alias("value_text"))
    return cast_columns(require_keys(texts, "k"), {"k": "long", "value_text": "double"}, safe=("k",))


@query("q_integer_or_skip", """
SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'x1' ELSE json_extract_string(props, '$.k') END AS BIGINT) AS id FROM events
WHERE TRY_CAST(CASE WHEN event_type = 'error' THEN 'x1' ELSE json_extract_string(props, '$.k') END AS BIGINT) IS NOT NULL""")
def integer_or_skip(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "x1").otherwise(F.get_json_object("props", "$.k"))
    return require_keys(table(spark, sf_dir, "events").select("event_id", to_long(text).alias("id")), "id")


@query("q_left_join_defaults", """
SELECT c_custkey, COALESCE(orders_placed, 0) AS orders_placed, COALESCE(label, CAST(c_custkey AS VARCHAR)) AS label,
       COALESCE(open_orders, 0) + COALESCE(done_orders, 0) AS counted
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS orders_placed, 'Customer ' || o_custkey AS label,
         CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS open_orders,
         nullif(CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT), 0) AS done_orders
  FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
def left_join_defaults(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders_placed"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"),
        F.nullif(F.count_if(F.col("o_orderstatus") == "F"), F.lit(0)).alias("done_orders"),
    ).withColumn("label", F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")))
    joined = table(spark, sf_dir, "customer").select("c_custkey").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left")
    filled = fill_defaults(joined, {"orders_placed": 0, "label": F.col("c_custkey").cast("string")})
    return filled.select("c_custkey", "orders_placed", "label", add_counts(F.col("open_orders"), F.col("done_orders")).alias("counted"))


@query("q_guarded_ratio", """
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type IN ('click', 'error')) AS tries,
       round(CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) / nullif(count(*) FILTER (WHERE event_type IN ('click', 'error')), 0), 4) AS ratio
FROM events GROUP BY user_id""")
def ratio(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type").isin("click", "error")).alias("tries"),
    )
    return counts.withColumn("ratio", guarded_ratio(F.col("clicks"), F.col("tries")))


@query("q_exclude_exact", """
SELECT p_partkey, kind FROM (SELECT p_partkey, CASE WHEN p_size = 5 THEN NULL WHEN p_size = 6 THEN '' ELSE p_type END AS kind FROM part)
WHERE kind IS NULL OR kind <> 'PROMO'""")
def exclude_exact(spark, sf_dir):
    kind = F.when(F.col("p_size") == 6, "").when(F.col("p_size") != 5, F.col("p_type"))
    return exclude_value(table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind")), "kind", "PROMO")


@query("q_exclude_any_case", """
SELECT p_partkey, kind FROM (SELECT p_partkey, CASE WHEN p_size = 5 THEN NULL WHEN p_size = 6 THEN '' ELSE p_type END AS kind FROM part)
WHERE kind <> '' AND lower(kind) <> 'promo'""")
def exclude_any_case(spark, sf_dir):
    kind = F.when(F.col("p_size") == 6, "").when(F.col("p_size") != 5, F.col("p_type"))
    parts = table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"))
    return exclude_value(parts, "kind", "Promo", ignore_case=True, drop_empty=True)


@query("q_first_nonempty", """
SELECT p_partkey, COALESCE(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, ''), p_type) AS chosen FROM part""")
def first_field(spark, sf_dir):
    brand = F.when(F.pmod("p_size", F.lit(2)) == 0, "").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", first_nonempty(brand, F.col("p_type")).alias("chosen"))


@query("q_preview", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def first_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").orderBy("n_nationkey"), 5)
