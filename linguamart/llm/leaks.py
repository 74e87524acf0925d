"""Benchmark decontamination by spaced seeds: hits of fixed masks, confirmed by the overlap around them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: 1 counts, 0 is ignored. By enumeration, every overlap that holds leaves one of them whole, for items of 7 words and more.
MASKS = ("1111", "11011")
#: The same for items of fewer words, by their number.
SHORT_MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("111", "11011"), 6: ("111", "11011")}
#: Bits of the filter that spares most words of the corpus the join: BITS_EACH for a seed, rounded up to a power of two, between
#: the two bounds (8 KB and 16 MB, which the driver and every task hold). Beyond the greater one more seeds make it let more through.
BITS_EACH, LEAST_BITS, MOST_BITS = 256, 1 << 16, 1 << 27
#: An overlap is judged on this many aligned words, or on the whole item if that is shorter, and holds at this share of equal ones.
OVERLAP, SHARE = 20, 0.8


def words(text):
    """Runs of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(rows, masks=MASKS):
    """Rows that have ``words``, once per seed: all columns but words, ``at`` (its first word, from 0) and seed, a hash of mask and words.

    All masks are hashed where the words are; only the words of one place at a time leave the array. The outer form keeps
    Spark from splitting every text once more to see whether it has words.
    """
    at = rows.select("*", F.posexplode_outer("words").alias("at", "_word"))
    n = F.size("words")
    hashes = []
    for mask in masks:
        chosen = [F.get("words", F.col("at") + k) for k, c in enumerate(mask) if c == "1"]
        hashes.append(F.when(F.col("at") + len(mask) <= n, F.xxhash64(F.lit(mask), *chosen)))
    rest = [c for c in rows.columns if c != "words"]
    return at.select(*rest, "at", F.explode_outer(F.array(*hashes)).alias("seed")).where("seed is not null")


def filter_bits(n):
    """Bits of a filter for ``n`` seeds."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * n - 1).bit_length())) if n else LEAST_BITS


def seed_filter(wanted, bits):
    """One row with an array of longs: two bits set for each seed of ``wanted``. Its size depends on ``bits`` alone."""
    places = wanted.select(F.explode(F.array(*_places(F.col("seed"), bits))).alias("place"))
    longs = places.groupBy(F.shiftright("place", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63L as int))")).alias("bits"),
    )
    every = wanted.sparkSession.range(0, bits >> 6, 1, 1).join(longs, "id", "left").select("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "bits"))), lambda x: x["bits"]).alias("filter"))


def _places(seed, bits):
    mask = F.lit(bits - 1).cast("long")
    return seed.bitwiseAND(mask), F.shiftrightunsigned(seed, 32).bitwiseAND(mask)


def maybe(seed, bits_of, bits):
    """Whether the filter has both bits of a seed."""
    held = []
    for place in _places(seed, bits):
        long = F.get(bits_of, F.shiftright(place, 6).cast("int"))
        held.append(F.call_function("getbit", long, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
    return held[0] & held[1]


def masks_of(lengths, masks=MASKS, short=SHORT_MASKS):
    """The masks that items of these numbers of words need."""
    return tuple(dict.fromkeys(m for n in sorted(lengths, reverse=True) for m in short.get(n, masks if n else ())))


def contaminated(docs, benchmark, masks=MASKS, overlap=OVERLAP, share=SHARE, id_col="doc_id", text_col="text", item_col="item_id", item_text="text"):
    """(text_hash, doc_id, item_id, n_overlap, n_equal) of documents that hold a benchmark item or a part of it.

    Words are runs of letters and digits in lower case. Every place of a document is hashed under each mask, which skips
    some words, so a substitution there does not matter; equal hashes of an item place the two texts side by side. They
    overlap if ``overlap`` aligned words in a row (all of the item's, if it has fewer) have a share of at least ``share``
    equal ones. n_overlap is the number of words side by side, n_equal of equal ones, at the best of the item's places.

    The corpus is hashed in one pass and meets a filter first, sized by the number of seeds up to a bound; what passes is joined on the hash, whichever
    way fits the sizes. Hits of one document, item and place become one before texts are looked at, so a passage of very
    many documents costs each of them a row.

    Items of fewer than 7 words have shorter masks, which only run where there are such items; the driver learns which of
    their lengths occur. Null and empty texts have no words. Rows without
    doc_id or item_id take part with a null id. Repeated rows of a document count once, items with equal ids as one.
    Other columns are not looked at; if either table is empty, so is the result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    whole = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = whole.select("doc_id", "text_hash", words(F.col("text")).alias("words"))
    text = F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit(""))
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.xxhash64(text).alias("item_hash"), words(text).alias("words"))
    items = items.dropDuplicates(["item_id", "item_hash"])
    n = F.least(F.size("words"), F.lit(7))
    lengths = sorted(r["n"] for r in items.select(n.alias("n")).distinct().collect()) or [0]
    # An item is posted under the masks of its own length only: those of a single word would make all items' words seeds.
    posted = reduce(DataFrame.union, [seeds(items.where(n == k), masks_of([k], masks) or masks) for k in lengths])
    masks = masks_of(lengths, masks) or masks
    wanted = saved(posted.select("seed", "item_id", "item_hash", F.col("at").alias("item_at")).distinct(), "seeds")
    bits = filter_bits(wanted.select("seed").distinct().count())
    hits = seeds(rows, masks).where(maybe(F.col("seed"), seed_filter(wanted, bits).scalar(), bits)).join(wanted, "seed")
    hits = saved(hits.select("doc_id", "text_hash", "item_id", "item_hash", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "hits")
    item_words = items.select(F.col("item_id").alias("_item"), F.col("item_hash").alias("_item_hash"), F.col("words").alias("item_words"))
    # Only texts with a hit are split again, after they have met it.
    doc_words = whole.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_doc_hash"), F.col("text").alias("_text"))
    doc_words = doc_words.join(hits.select("text_hash").distinct(), F.col("_doc_hash") == F.col("text_hash"), "left_semi").dropDuplicates(["_doc", "_doc_hash"])
    doc_words = doc_words.select("_doc", "_doc_hash", words(F.col("_text")).alias("doc_words"))
    pairs = hits.join(item_words, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_hash") == F.col("_item_hash")))
    pairs = pairs.join(doc_words, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_doc_hash")))
    first = F.greatest(F.lit(0), -F.col("shift"))
    length = F.least(F.size("item_words") - first, F.size("doc_words") - F.col("shift") - first)
    side = F.zip_with(
        F.slice("item_words", first + 1, length), F.slice("doc_words", first + F.col("shift") + 1, length), lambda a, b: (a == b).cast("int"),
    )
    judged = pairs.select("text_hash", "doc_id", "item_id", side.alias("side"), F.least(F.lit(overlap), F.size("item_words")).alias("need"))
    starts = F.when(F.size("side") >= F.col("need"), F.sequence(F.lit(1), F.size("side") - F.col("need") + 1))
    holds = F.exists(starts, lambda i: _total(F.slice("side", i, F.col("need"))) >= F.ceil(F.lit(share) * F.col("need")))
    best = F.max(F.struct(_total(F.col("side")).alias("n_equal"), F.size("side").alias("n_overlap"))).alias("best")
    return judged.where(holds).groupBy("text_hash", "doc_id", "item_id").agg(best).select(
        "text_hash", "doc_id", "item_id", F.col("best.n_overlap").cast("long").alias("n_overlap"), F.col("best.n_equal").cast("long").alias("n_equal"),
    )


def _total(side):
    return F.aggregate(side, F.lit(0), lambda a, b: a + b)
