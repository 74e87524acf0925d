"""Catalogue tables derived from the order lines, as Spark plans and as SQL.

Every line becomes one raw store row and one raw popularity row: the part is the title (a seventh of
them has another id on the popularity side, so they match nothing), the month of shipment is the snapshot date, and the other columns are spelled out as
the text a snapshot would hold. Many lines share a title and month, which is what the
deduplication is for. They are projections of one scan, with no join and no shuffle of their own.
"""

from pyspark.sql import functions as F

from ..constants import GENRE_PRIORITY, OWNER_BANDS, WHITESPACE
from .registry import table

LANGUAGES = [
    "English", "French", "German", "Polish", "Japanese",
    "Korean", "Italian", "#lang_slovakian", "english", "Simplified Chinese",
]
GENRES = ["Action", "RPG", "Strategy", "Indie", "Casual", "Utilities", "Massively Multiplayer", "Simulation", "", " Racing"]
# Added to the id of titles that the popularity side does not know.
STRANGER = 1_000_000_000
OWNERS = [*OWNER_BANDS, "1,000,000 .. 2,000,000"]


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def _padded(name, width):
    return F.lpad(F.col(name).cast("string"), width, "0")


def _place():
    return F.concat_ws("-", _padded("l_orderkey", 12), _padded("l_linenumber", 3), _padded("l_suppkey", 9))


def _month():
    return F.trunc(F.col("l_shipdate").cast("date"), "MM")


def raw_store(spark, sf_dir):
    ship = F.col("l_shipdate").cast("date")
    amount = F.format_number("l_extendedprice", 2)
    title = F.col("l_partkey")
    mark = F.when(title % 3 != 0, "<strong>*</strong>").otherwise("")
    # A title has one to five languages of its own, or none at all.
    spoken = lambda c: _pick(LANGUAGES, title + F.pmod(F.col(c), title % 5 + 1))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("appid"),
        _month().alias("snapshot_date"),
        _place().alias("file_path"),
        F.when(F.col("l_discount") == 0, "Free").otherwise(F.concat(F.lit("$"), amount)).alias("price_usd"),
        F.when(F.col("l_tax") != 0, F.concat(F.translate(amount, ",.", " ,"), F.lit("zł"))).alias("price_pln"),
        F.when(F.col("l_returnflag") == "N", F.date_format(ship, "d MMM, yyyy"))
        .when(F.col("l_returnflag") == "R", F.date_format(ship, "MMM d, yyyy"))
        .otherwise("Coming soon").alias("release_date"),
        F.when((F.col("l_quantity") != 1) & (title % 11 != 0), F.concat(
            spoken("l_suppkey"), mark, F.lit(", "), spoken("l_orderkey"), F.lit(", "), spoken("l_linenumber"),
            F.when(F.col("l_quantity") == 4, ", languages<br> with full audio support").when(F.col("l_quantity") == 5, ", <i>Thai</i>*").otherwise(""),
            F.when(F.col("l_returnflag") == "R", F.concat(F.lit("<br>"), mark, F.lit("languages with full audio support"))).otherwise(""),
        )).alias("languages"),
        F.when(F.col("l_quantity") != 2, F.concat(
            _pick(GENRES, F.col("l_linenumber")), F.lit(","),
            _pick(GENRES, F.col("l_suppkey")), F.lit(", "),
            F.when(F.col("l_linestatus") == "F", "Free To Play").otherwise("Free to Play , Indie"),
        )).alias("genre"),
    )


def raw_popularity(spark, sf_dir):
    quantity = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") + F.when(F.col("l_partkey") % 7 == 3, STRANGER).otherwise(0)).alias("appid"),
        _month().alias("snapshot_date"),
        _place().alias("file_path"),
        F.when(F.col("l_returnflag") != "A", F.concat(F.lit("Title "), F.col("l_partkey").cast("string"))).alias("name"),
        F.lit("dev").alias("developer"), F.lit("pub").alias("publisher"), F.lit(None).cast("string").alias("score_rank"),
        (quantity * 3 - 10).alias("positive"),
        (quantity - 25).alias("negative"),
        F.lit(0).cast("long").alias("userscore"),
        _pick(OWNERS, F.col("l_linenumber") + F.col("l_suppkey")).alias("owners"),
        (quantity * 2 - 5).alias("average_forever"), (quantity - 3).alias("average_2weeks"),
        quantity.alias("median_forever"), F.when(F.col("l_tax") != 0, quantity - 1).alias("median_2weeks"),
        F.lit("0").alias("price"), F.lit("0").alias("initialprice"), F.lit("0").alias("discount"),
        F.when(F.col("l_discount") != 0.05, F.round(F.col("l_extendedprice")).cast("long") - 10000).alias("ccu"),
    )


def _sql_list(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _sql_pick(values, index):
    return f"({_sql_list(values)})[({index}) % {len(values)} + 1]"


def _sql_spoken(col):
    return _sql_pick(LANGUAGES, f"l_partkey + {col} % (l_partkey % 5 + 1)")


_SQL_MARK = "CASE WHEN l_partkey % 3 <> 0 THEN '<strong>*</strong>' ELSE '' END"

_SQL_PLACE = (
    "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || "
    "lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"
)

# All white space, spelled with chr() so that the SQL text stays plain.
SQL_WS = "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"

RAW_STORE = f"""raw_store AS (
  SELECT l_partkey AS appid,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
         {_SQL_PLACE} AS file_path,
         CASE WHEN l_discount = 0 THEN 'Free' ELSE '$' || format('{{:,.2f}}', l_extendedprice) END AS price_usd,
         CASE WHEN l_tax <> 0 THEN translate(format('{{:,.2f}}', l_extendedprice), ',.', ' ,') || 'zł' END AS price_pln,
         CASE l_returnflag WHEN 'N' THEN strftime(l_shipdate, '%-d %b, %Y')
                           WHEN 'R' THEN strftime(l_shipdate, '%b %-d, %Y')
                           ELSE 'Coming soon' END AS release_date,
         CASE WHEN l_quantity <> 1 AND l_partkey % 11 <> 0 THEN
           {_sql_spoken('l_suppkey')} || {_SQL_MARK} || ', ' || {_sql_spoken('l_orderkey')} || ', ' || {_sql_spoken('l_linenumber')} ||
           CASE l_quantity WHEN 4 THEN ', languages<br> with full audio support' WHEN 5 THEN ', <i>Thai</i>*' ELSE '' END ||
           CASE WHEN l_returnflag = 'R' THEN '<br>' || {_SQL_MARK} || 'languages with full audio support' ELSE '' END
         END AS languages,
         CASE WHEN l_quantity <> 2 THEN
           {_sql_pick(GENRES, 'l_linenumber')} || ',' ||
           {_sql_pick(GENRES, 'l_suppkey')} || ', ' ||
           CASE WHEN l_linestatus = 'F' THEN 'Free To Play' ELSE 'Free to Play , Indie' END
         END AS genre
  FROM lineitem)"""

RAW_POPULARITY = f"""raw_popularity AS (
  SELECT l_partkey + CASE WHEN l_partkey % 7 = 3 THEN {STRANGER} ELSE 0 END AS appid,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
         {_SQL_PLACE} AS file_path,
         CASE WHEN l_returnflag <> 'A' THEN 'Title ' || l_partkey END AS name,
         CAST(l_quantity AS BIGINT) * 3 - 10 AS positive,
         CAST(l_quantity AS BIGINT) - 25 AS negative,
         {_sql_pick(OWNERS, 'l_linenumber + l_suppkey')} AS owners,
         CAST(l_quantity AS BIGINT) * 2 - 5 AS average_forever,
         CAST(l_quantity AS BIGINT) - 3 AS average_2weeks,
         CAST(l_quantity AS BIGINT) AS median_forever,
         CASE WHEN l_tax <> 0 THEN CAST(l_quantity AS BIGINT) - 1 END AS median_2weeks,
         CASE WHEN l_discount <> 0.05 THEN CAST(round(l_extendedprice) AS BIGINT) - 10000 END AS ccu
  FROM lineitem)"""


def sql_price(col, decimal="."):
    kept = f"regexp_replace({col}, '[^0-9{decimal}\\-]', '', 'g')"
    if decimal != ".":
        kept = f"replace({kept}, '{decimal}', '.')"
    return f"COALESCE(TRY_CAST({kept} AS DOUBLE), 0.0)"


def sql_date(col):
    return f"CAST(COALESCE(try_strptime({col}, '%d %b, %Y'), try_strptime({col}, '%b %d, %Y')) AS DATE)"


def sql_strip(col):
    return f"trim({col}, {SQL_WS})"


CLEAN_STORE = f"""clean_store AS (
  SELECT appid, snapshot_date, file_path, {sql_price('price_usd')} AS price_usd, {sql_price('price_pln', ',')} AS price_pln,
         {sql_date('release_date')} AS release_date, {sql_date('release_date')} IS NULL AS release_date_missing,
         replace(languages, '#lang_slovakian', 'Slovakian') AS languages, genre
  FROM raw_store)"""

SQL_BANDS = "CASE owners " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in OWNER_BANDS.items()) + " END"


def _sql_clip(col):
    return f"CASE WHEN {col} < 0 THEN 0 ELSE {col} END AS {col}"


CLEAN_POPULARITY = f"""clean_popularity AS (
  SELECT appid, snapshot_date, snapshot_date AS ingestion_date, file_path, name, {SQL_BANDS} AS owners_category,
         {', '.join(_sql_clip(c) for c in ('positive', 'negative', 'ccu', 'average_forever', 'average_2weeks', 'median_forever', 'median_2weeks'))}
  FROM raw_popularity)"""

# One popularity row per title and month: most players first, then the place in the file.
SILVER_POPULARITY = """best_popularity AS (
  SELECT * FROM raw_popularity
  QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY ccu DESC NULLS LAST, file_path) = 1),
""" + CLEAN_POPULARITY.replace("FROM raw_popularity)", "FROM best_popularity)")

LANGUAGE_TOKENS = f"""language_tokens AS (
  SELECT appid, snapshot_date, contains(raw, '*') AS audio,
         {sql_strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '<br[ ]*/?>|<strong>[*]</strong>', ' ', 'g'), '<[^>]+>|[*]', ' ', 'g'), 'languages with full audio support', '', 'gi'), '[ ]+', ' ', 'g')")} AS language
  FROM (SELECT appid, snapshot_date, unnest(string_split(languages, ',')) AS raw FROM clean_store)),
silver_languages AS (
  SELECT appid, snapshot_date, language, bool_or(audio) AS audio FROM language_tokens
  WHERE language <> '' AND lower(language) <> 'languages with full audio support'
  GROUP BY ALL)"""

STAGING_LANGUAGES = """staging_languages AS (
  SELECT DISTINCT appid, language, COALESCE(audio, false) AS has_audio_support FROM silver_languages)"""

DIM_LANGUAGES = """dim_languages AS (
  SELECT DISTINCT md5(CAST(appid AS VARCHAR) || '|' || lower(language)) AS language_key, appid, language, has_audio_support
  FROM staging_languages)"""

STAGING_STORE = """staging_store AS (
  SELECT * EXCLUDE (snapshot_date, file_path) FROM clean_store
  QUALIFY row_number() OVER (PARTITION BY appid
    ORDER BY release_date DESC NULLS LAST, snapshot_date DESC NULLS LAST, file_path DESC) = 1)"""

STAGING_POPULARITY = """staging_popularity AS (
  SELECT appid, name AS title, positive AS positive_reviews, negative AS negative_reviews, ccu, owners_category,
         CAST(average_forever AS DOUBLE) AS average_forever, CAST(average_2weeks AS DOUBLE) AS average_2weeks,
         CAST(median_forever AS DOUBLE) AS median_forever, CAST(median_2weeks AS DOUBLE) AS median_2weeks, ingestion_date
  FROM clean_popularity
  QUALIFY row_number() OVER (PARTITION BY appid ORDER BY ingestion_date DESC NULLS LAST, file_path DESC) = 1)"""

DIM_GENRES = f"""dim_genres AS (
  SELECT DISTINCT appid, genre FROM (
    SELECT appid, {sql_strip('g')} AS genre FROM (SELECT appid, unnest(string_split(genre, ',')) AS g FROM staging_store))
  WHERE genre <> '' AND lower(genre) <> 'free to play')"""

SQL_MEASURES = """owners_category, COALESCE(ccu, 0) AS ccu, COALESCE(positive_reviews, 0) AS positive_reviews,
         COALESCE(negative_reviews, 0) AS negative_reviews,
         COALESCE(positive_reviews, 0) + COALESCE(negative_reviews, 0) AS total_reviews,
         CASE WHEN COALESCE(positive_reviews, 0) + COALESCE(negative_reviews, 0) <> 0 THEN
           round(CAST(COALESCE(positive_reviews, 0) AS DOUBLE) / (COALESCE(positive_reviews, 0) + COALESCE(negative_reviews, 0)), 4)
         END AS positive_ratio,
         COALESCE(average_forever, 0) AS average_forever, COALESCE(average_2weeks, 0) AS average_2weeks,
         COALESCE(median_forever, 0) AS median_forever, COALESCE(median_2weeks, 0) AS median_2weeks"""

FCT_GAMES = f"""fct_games AS (
  SELECT s.appid, COALESCE(title, CAST(s.appid AS VARCHAR)) AS title, release_date, release_date_missing,
         price_usd, price_pln, {SQL_MEASURES}
  FROM staging_store s LEFT JOIN staging_popularity p ON s.appid = p.appid)"""

SQL_SEED = "(VALUES " + ", ".join(f"('{g}', {p})" for g, p in GENRE_PRIORITY.items()) + ") AS seed(genre, priority)"


def sql_token_count(col):
    return f"CAST(len(list_filter(string_split(COALESCE({col}, ''), ','), lambda x: {sql_strip('x')} <> '')) AS BIGINT)"


STORE_DAILY = f"""latest_store AS (
  SELECT * FROM clean_store
  QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY file_path DESC) = 1),
genre_tokens AS (
  SELECT appid, snapshot_date, lower({sql_strip('g')}) AS token
  FROM (SELECT appid, snapshot_date, unnest(string_split(genre, ',')) AS g FROM latest_store)
  WHERE {sql_strip('g')} <> ''),
primary_genres AS (
  SELECT appid, snapshot_date, first(token ORDER BY COALESCE(priority, 999), token) AS primary_genre
  FROM genre_tokens LEFT JOIN {SQL_SEED} ON seed.genre = token GROUP BY appid, snapshot_date),
store_daily AS (
  SELECT l.appid, l.snapshot_date, price_usd, price_pln, release_date, release_date_missing,
         {sql_token_count('languages')} AS languages, {sql_token_count('l.genre')} AS genre,
         COALESCE(primary_genre, 'other') AS primary_genre
  FROM latest_store l LEFT JOIN primary_genres g ON l.appid = g.appid AND l.snapshot_date = g.snapshot_date)"""

POPULARITY_DAILY = """popularity_daily AS (
  SELECT appid, snapshot_date, name AS title, positive AS positive_reviews, negative AS negative_reviews, ccu, owners_category,
         CAST(average_forever AS DOUBLE) AS average_forever, CAST(average_2weeks AS DOUBLE) AS average_2weeks,
         CAST(median_forever AS DOUBLE) AS median_forever, CAST(median_2weeks AS DOUBLE) AS median_2weeks
  FROM clean_popularity
  QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY file_path DESC) = 1)"""

FCT_DAILY = f"""fct_games_daily AS (
  SELECT s.appid, s.snapshot_date, COALESCE(title, CAST(s.appid AS VARCHAR)) AS title, release_date, release_date_missing,
         price_usd, price_pln, languages, genre, primary_genre, {SQL_MEASURES}
  FROM store_daily s LEFT JOIN popularity_daily p ON s.appid = p.appid AND s.snapshot_date = p.snapshot_date)"""


def sql(*ctes, select):
    return "WITH " + ",\n".join(ctes) + "\n" + select


BASE_FACT = (RAW_STORE, CLEAN_STORE, RAW_POPULARITY, SILVER_POPULARITY, STAGING_STORE, STAGING_POPULARITY, FCT_GAMES)
BASE_LANGUAGES = (RAW_STORE, CLEAN_STORE, LANGUAGE_TOKENS, STAGING_LANGUAGES, DIM_LANGUAGES)
BASE_DAILY = (RAW_STORE, CLEAN_STORE, RAW_POPULARITY, SILVER_POPULARITY, STORE_DAILY, POPULARITY_DAILY, FCT_DAILY)

TREND = sql(*BASE_DAILY, select="""
SELECT appid, snapshot_date, lag(snapshot_date) OVER w AS previous_date, ccu, ccu - lag(ccu) OVER w AS ccu_change,
       total_reviews, total_reviews - lag(total_reviews) OVER w AS total_reviews_change,
       languages, languages - lag(languages) OVER w AS languages_change
FROM fct_games_daily WINDOW w AS (PARTITION BY appid ORDER BY snapshot_date)""")
