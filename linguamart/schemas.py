"""Column types of every table."""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType,
)


def _struct(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


_S, _L, _D, _B, _DAY = StringType(), LongType(), DoubleType(), BooleanType(), DateType()

BRONZE_STORE = _struct(
    ("appid", _L), ("price_usd", _S), ("price_pln", _S),
    ("release_date", _S), ("languages", _S), ("genre", _S),
)

BRONZE_POPULARITY = _struct(
    ("appid", _L), ("name", _S), ("developer", _S), ("publisher", _S), ("score_rank", _S),
    ("positive", _L), ("negative", _L), ("userscore", _L), ("owners", _S),
    ("average_forever", _L), ("average_2weeks", _L), ("median_forever", _L), ("median_2weeks", _L),
    ("price", _S), ("initialprice", _S), ("discount", _S), ("ccu", _L),
)

SILVER_STORE = _struct(
    ("appid", _L), ("price_usd", _D), ("price_pln", _D), ("release_date", _DAY),
    ("release_date_missing", _B), ("languages", _S), ("genre", _S),
)

SILVER_POPULARITY = _struct(
    ("appid", _L), ("name", _S), ("positive", _L), ("negative", _L),
    ("average_forever", _L), ("average_2weeks", _L), ("median_forever", _L), ("median_2weeks", _L),
    ("ccu", _L), ("owners_category", _S), ("ingestion_date", _DAY),
)

SILVER_GENRES = _struct(("appid", _L), ("genre", _S))
SILVER_LANGUAGES = _struct(("appid", _L), ("language", _S), ("audio", _B))
LEDGER = _struct(("processed_date", _DAY), ("table_name", _S))
GENRE_SEED = _struct(("genre", _S), ("priority", _L))
