"""API payloads that have been landed as JSON text, one document per row."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..constants import ID_IN_LOGO
from ..functions import first_nonempty, replace_codes, whole_number
from .dedupe import best_per_key

_ENTRIES = "map<string,variant>"


def _documents(col):
    """The entries of a JSON object in their order, each value parsed once into a VARIANT; null for any other text.

    A document that cannot be parsed as a whole only because of one value (a record that repeats a key, in sessions
    that refuse that) is parsed value by value, and only that value is null.
    """
    apart = F.transform_values(F.from_json(col, "map<string,string>"), lambda _, v: F.try_parse_json(v))
    return F.coalesce(F.from_json(col, _ENTRIES), apart)


def _is_object(value):
    return F.schema_of_variant(value).startswith("OBJECT<")


def _field(record, path, kind="string"):
    """A field of a VARIANT, null where it is absent or does not fit; ``path`` holds the names on the way, dots between them."""
    return F.try_variant_get(record, "$" + "".join(f'["{name}"]' for name in path.split(".")), kind)


def _entries(df, json_col):
    """One row per entry of the outer object that is a record: its place, its key and the record as VARIANT."""
    rest = [c for c in df.columns if c != json_col]
    pairs = df.select(*rest, F.posexplode(_documents(F.col(json_col))).alias("__position", "__key", "__record"))
    return rest, pairs.where(_is_object(F.col("__record")))


def pages_to_stop(df, json_col, page_col):
    """The pages before the first one that is empty or no object: where the paging has ended."""
    # The keys alone tell; values stay text.
    filled = F.ltrim(F.col(json_col)).startswith("{") & (F.size(F.from_json(json_col, "map<string,string>")) > 0)
    last = df.where(~F.coalesce(filled, F.lit(False))).agg(F.min(page_col))
    return df.where(F.coalesce(F.col(page_col) < last.scalar(), F.lit(True)))


def popularity_records(df, json_col, fields, id_field="appid", position=None):
    """Object keyed by id -> rows. ``fields`` maps field name to type; unreadable values are null.

    The id is the record's own field, or the key where the record has no such field. Entries that
    are not records and ids that are not integers are skipped. ``position`` names a column for the
    place of the entry in its document.
    """
    rest, rows = _entries(df, json_col)
    record = F.col("__record")
    raw_id = F.when(_field(record, id_field, "variant").isNotNull(), _field(record, id_field)).otherwise(F.col("__key"))

    def typed(name, kind):
        text = _field(record, name)
        return whole_number(text) if kind in ("long", "bigint", LongType()) else text.try_cast(kind)

    values = [typed(name, kind).alias(name) for name, kind in fields.items() if name != id_field]
    place = [F.col("__position").alias(position)] if position else []
    return rows.select(*rest, *place, raw_id.try_cast("long").alias(id_field), *values).where(F.col(id_field).isNotNull())


def store_records(df, json_col, key="appid"):
    """Object keyed by id -> rows (id, has_data, price, release_date, languages, genre) of the successes."""
    rest, rows = _entries(df, json_col)
    record = F.col("__record")
    data = _field(record, "data", "variant")
    hits = rows.where(_field(record, "success") == "true").select(*rest, F.col("__key").try_cast("long").alias(key), data.alias("__data"))
    data = F.col("__data")
    hits = hits.where(_is_object(data) & F.col(key).isNotNull())
    listed = _field(data, "genres", "array<variant>")
    joined = F.array_join(F.transform(listed, lambda g: F.coalesce(_field(g, "description"), F.lit(""))), ", ")
    return hits.select(
        *rest,
        key,
        (F.schema_of_variant(data) != "OBJECT<>").alias("has_data"),
        _field(data, "price_overview.final_formatted").alias("price"),
        _field(data, "release_date.date").alias("release_date"),
        replace_codes(first_nonempty(_field(data, "supported_languages"), _field(data, "languages"))).alias("languages"),
        F.coalesce(joined, _field(data, "genres"), F.lit("")).alias("genre"),
    )


def _both_regions(first, second, key, present):
    def pack(df, name):
        # A repeated id counts once, the entry with data before the empty one, so the join stays one to one.
        others = [c for c in df.columns if c not in (key, present)]
        single = best_per_key(df, [key], [F.desc(present), *[F.desc_nulls_last(c) for c in others]])
        return single.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name))

    return pack(first, "__a").join(pack(second, "__b"), key, "full")


def merge_regions(first, second, key="appid", present="has_data", price="price",
                  price_names=("price_usd", "price_pln")):
    """One row per id seen in either region.

    Each price comes from its own region; every other field comes as a whole record from the
    first region, or from the second where the first has none.
    """
    both = _both_regions(first, second, key, present)
    seen_a = F.coalesce(F.col("__a")[present], F.lit(False))
    seen_b = F.coalesce(F.col("__b")[present], F.lit(False))
    record = F.when(seen_a, F.col("__a")).otherwise(F.col("__b"))
    others = [c for c in first.columns if c not in (key, present, price)]
    return both.where(seen_a | seen_b).select(
        key,
        F.when(seen_a, F.col("__a")[price]).alias(price_names[0]),
        F.when(seen_b, F.col("__b")[price]).alias(price_names[1]),
        *[record[c].alias(c) for c in others],
    )


def region_counters(first, second, key="appid", present="has_data"):
    """One row: ids hit in the first region, in the second, in any, and ids that give a merged row."""
    both = _both_regions(first, second, key, present)
    a, b = F.col("__a"), F.col("__b")
    kept = F.coalesce(a[present], F.lit(False)) | F.coalesce(b[present], F.lit(False))
    return both.agg(
        F.count_if(a.isNotNull()).alias("first_hits"),
        F.count_if(b.isNotNull()).alias("second_hits"),
        F.count(F.lit(1)).alias("any_hits"),
        F.count_if(kept).alias("output_rows"),
    )


def ranked_items(df, items_col="items", url_field="logo", pattern=ID_IN_LOGO, key="appid"):
    """Pages with an array of items -> one row per item, with its id taken from an address or null."""
    rest = [c for c in df.columns if c != items_col]
    items = df.select(*rest, F.posexplode(items_col).alias("position", "item"))
    found = F.regexp_extract(F.col("item")[url_field], pattern, 1).try_cast("long")
    return items.select(*rest, "position", "item", found.alias(key))
