"""Lempel-Ziv phrase fingerprints: the set of phrases of an LZ78 parse, as minimum hashes."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import documents, mix

#: Slots of a fingerprint; each holds 16 bits of the least phrase hash that falls into it, 0000 if none does.
SLOTS = 256
#: A word of more bytes is cut into pieces, after about one in CUT_EACH of its characters: text without spaces has no other words.
LONG_WORD, CUT_EACH = 64, 4
#: Bytes of text that one bucket of neighbours should hold, about.
BUCKET_BYTES, MOST_BUCKETS = 16 << 20, 8192


def pieces(word):
    """A long word in pieces. Where it is cut depends on two neighbouring characters only, so an edit moves no cut but its own."""
    points = np.frombuffer(word.decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    pair = mix(points[:-1] << np.uint64(32) | points[1:])
    cuts = np.flatnonzero(pair % np.uint64(CUT_EACH) == 0) + 1
    ends = np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)).tolist()
    bounds = [0, *(ends[c - 1] for c in cuts.tolist()), len(word)]
    return [word[a:b] for a, b in zip(bounds, bounds[1:])]


def symbols(words):
    """The words that phrases are made of: all words, long ones in pieces."""
    if max(map(len, words), default=0) <= LONG_WORD:
        return words
    return [x for w in words for x in (pieces(w) if len(w) > LONG_WORD else (w,))]


def parse(words, known, phrase=b""):
    """Parse words into phrases, each the shortest run of words that is not ``known`` yet; they are added to it.

    ``phrase`` is what an earlier call left open, and what is left open now comes back.
    """
    add = known.add
    for word in symbols(words):
        phrase += word
        if phrase in known:
            phrase += b" "
        else:
            add(phrase)
            phrase = b""
    return phrase


def signature(phrases):
    """16-bit slots of a set of phrases: the least hash of each slot, 0 where there is none."""
    hashes = mix(np.fromiter(map(zlib.crc32, phrases), np.uint64, len(phrases)))
    least = np.full(SLOTS, 1 << 56, np.uint64)
    np.minimum.at(least, (hashes >> np.uint64(56)).astype(np.int64), hashes & np.uint64((1 << 56) - 1))
    # The low bits of a minimum are as random as any hash; 1 to 65535 leaves 0 for an empty slot.
    return np.where(least == 1 << 56, 0, least % np.uint64(65535) + np.uint64(1)).astype(">u2")


def likeness(a, b):
    """Share of the slots that agree, of those that either uses; two empty fingerprints are alike."""
    used = (a > 0) | (b > 0)
    return float((a[used] == b[used]).mean()) if used.any() else 1.0


def fingerprint(text):
    known = set()
    parse(text.encode().split(), known)
    return signature(known)


def edited_text(text, other):
    """``text`` with its last third (rounded down) replaced by as many of the first code points of ``other``, or all."""
    k = len(text) // 3
    return text[:len(text) - k] + other[:k]


def both(text, other):
    """Fingerprints of ``text`` and of ``edited_text``; what they begin with alike is parsed once."""
    k = len(text) // 3
    head = text[:len(text) - k].encode()
    # The last word of what both begin with may go on.
    *words, last = (head + b"|").split()
    known = set()
    phrase = parse(words, known)
    edited = set(known)
    parse((last[:-1] + text[len(text) - k:].encode()).split(), known, phrase)
    parse((last[:-1] + other[:k].encode()).split(), edited, phrase)
    return signature(known), signature(edited)


PRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def neighbours(rows):
    """(doc_id, text, bucket, guest): rows in buckets of descending ids (nulls last), ordered in each.

    The first row of the next bucket (after the last: of the first) comes once more at a bucket's end, as its guest. The
    bounds are approximate quantiles of the ids, at most MOST_BUCKETS; the driver sees two ids per bucket and no text.
    """
    size, low = rows.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    n = min(MOST_BUCKETS, int(size or 0) // BUCKET_BYTES + 1)
    found = rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 and low is not None else []
    bounds = np.asarray(sorted({int(x) for x in found}), np.int64)

    @F.arrow_udf("int")
    def bucket_of(ids: pa.Array) -> pa.Array:
        # Bucket 0 has the ids above the greatest bound; missing ids follow the least.
        places = len(bounds) - np.searchsorted(bounds, ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "left")
        return pa.array(np.where(np.asarray(ids.is_null()), len(bounds), places).astype(np.int32))

    placed = rows.withColumn("bucket", bucket_of("doc_id"))
    heads = {r["bucket"]: r["head"] for r in placed.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    before = dict(zip(order, order[-1:] + order[:-1]))

    @F.arrow_udf("int")
    def guest_in(ids: pa.Array, buckets: pa.Array) -> pa.Array:
        return pa.array([before[b] if heads[b] == i else None for i, b in zip(ids.to_pylist(), buckets.to_pylist())], pa.int32())

    places = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
        F.struct(F.col("guest_in").alias("bucket"), F.lit(True).alias("guest")),
    )
    spread = placed.withColumn("guest_in", guest_in("doc_id", "bucket")).select("doc_id", "text", F.explode(places).alias("place"))
    spread = spread.where("place.bucket is not null").select("doc_id", "text", "place.bucket", "place.guest")
    # By range: a hash would put several buckets into some tasks, and none into others.
    return spread.repartitionByRange(max(1, len(order)), "bucket").sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text")


def fingerprints(docs, id_col="doc_id", text_col="text"):
    """PRINTED of every document: the fingerprint of its whole text, that of its edited text, and how near they are.

    A text's words (split at space and 0x09 to 0x0D; a word of more than LONG_WORD bytes, as in scripts without spaces or in encoded data,
    counts as several, cut where its characters say) are parsed into LZ78 phrases; the hashes of the phrase set fall into SLOTS, and the least of each is
    kept. Likeness is the share of equal slots, an estimate of the overlap of the phrase sets. Equal texts have equal
    fingerprints. The next document is that of the next lower id (after the lowest the highest); documents of one id
    follow each other by text, those without an id come last. A single document is its own next. A null text counts as
    empty; two empty texts have likeness 1. Repeated rows each have a row. An empty table gives no row.

    Texts move once, to buckets of neighbouring ids, of which a task reads one row after the other.
    """

    def run(batches):
        out, text, doc_id, pending, bucket, closed = [], None, None, None, None, False

        def flush():
            columns = list(zip(*out))
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PRINTED.split(", ")])

        for batch in batches:
            ids, places, guests = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i, following in enumerate(batch.column(1)):
                following = following.as_py()
                if places[i] != bucket:
                    bucket, text, pending, closed = places[i], None, None, False
                if closed:
                    continue
                if text is not None:
                    own, edited = both(text, following)
                    if pending:
                        out.append((*pending[0], likeness(pending[1], own)))
                    digest = hashlib.sha256(edited_text(text, following).encode()).hexdigest()
                    pending = (doc_id, len(text), digest, own.tobytes().hex(), edited.tobytes().hex(), likeness(own, edited)), own
                if guests[i]:
                    out.append((*pending[0], likeness(pending[1], fingerprint(following))))
                    closed = True
                doc_id, text = ids[i], following
                if len(out) >= 1000:
                    yield flush()
        if out:
            yield flush()

    return neighbours(documents(docs, id_col, text_col)).mapInArrow(run, PRINTED)
