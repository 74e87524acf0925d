"""Ranked lexical search over index segments: accumulators of short lists, then document at a time over the long ones."""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import Rolling, documents, lower, saved, text_chunks, words_of

#: Text that a segment of the index holds, about, and text that is cut into terms at a time.
SEGMENT_BYTES, SLICE_BYTES = 2 << 20, 1 << 19
#: A list is short if it holds at most one in so many of a segment's documents (or LEAST_SHORT of them).
SHORT_SHARE, LEAST_SHORT = 32, 64
#: Documents that lists are bounded and walked through by.
WINDOW = 512
#: Text of the queries that are searched for in one pass.
BLOCK_BYTES = 1 << 20

# Fixed values of the score.
SCALE, SATURATION, FULL_LENGTH, LENGTH_SHARE = 1000, 12, 100, 25

TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SEGMENT = (
    "docs long, tokens long, ids array<long>, lengths binary, hashes binary, words binary, word_sizes binary, counts binary, places binary, tfs binary"
)


def terms_of(text):
    return TERMS.findall((text or "").encode().lower())


def narrow(x):
    """The bytes of numbers not below 0, each in as many bytes (1, 2, 4 or 8) as the largest needs: what tasks read a split of at once."""
    most = int(x.max()) if len(x) else 0
    return x.astype(next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(k).max)).tobytes()


def wide(raw, n):
    """The ``n`` numbers of narrow(), in their own width; sums and differences need a wider one."""
    return np.frombuffer(raw, f"u{len(raw) // n}") if n else np.zeros(0, np.uint8)


class Segment:
    """Postings of some documents on their way into a row of the index."""

    def __init__(self, rolling):
        self.rolling, self.ids, self.lengths, self.bytes = rolling, [], [], 0
        self.postings, self.words = [], {}

    def add(self, ids, data, offsets):
        """Texts ``data`` (bytes) cut at ``offsets``; a long one is cut into terms slice by slice."""
        first = len(self.ids)
        self.ids += ids
        self.lengths.append(np.zeros(len(ids), np.int64))
        at = 0
        while at < len(data):
            end = min(len(data), at + SLICE_BYTES)
            while end < len(data) and TERM_BYTES[data[end - 1]] and TERM_BYTES[data[end]]:
                gaps = np.flatnonzero(~TERM_BYTES[data[at:end]])
                end = at + int(gaps[-1]) + 1 if len(gaps) else min(len(data), end + SLICE_BYTES)
            self._slice(data[at:end], np.clip(offsets - at, 0, end - at), first)
            at = end
        self.bytes += len(data)

    def _slice(self, data, offsets, first):
        data = lower(data)
        starts, ends, bounds = words_of(data, offsets, TERM_BYTES[data])
        if not len(starts):
            return
        n = np.diff(bounds)
        self.lengths[-1] += n
        hashes = self.rolling.words(data, starts, ends)
        docs = np.repeat(np.arange(first, first + len(n), dtype=np.int32), n)
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], docs[order]
        new_term = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])])
        self.postings.append((hashes[new], docs[new], np.diff(np.r_[new, len(hashes)]).astype(np.int64)))
        raw = data.tobytes()
        for h, k in zip(hashes[new_term].tolist(), order[new_term].tolist()):
            if h not in self.words:
                self.words[h] = raw[starts[k]:ends[k]]

    def row(self):
        """The values of SEGMENT: documents in the order they came, terms by their hash, postings by term and document."""
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, np.int64)
        none = np.zeros(0, np.int64)
        hashes, docs, tfs = (np.concatenate(x) for x in zip(*self.postings)) if self.postings else (none.view(np.uint64), none.astype(np.int32), none)
        order = np.argsort(hashes, kind="stable")
        hashes, docs, tfs = hashes[order], docs[order], tfs[order]
        if len(hashes):  # What slices of one document have of a term stands side by side.
            new = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])])
            hashes, docs, tfs = hashes[new], docs[new], np.add.reduceat(tfs, new)
        terms = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else none
        words = [self.words[h] for h in hashes[terms].tolist()]
        sizes = np.asarray([len(w) for w in words], np.int64)
        counts = np.diff(np.r_[terms, len(hashes)])
        return [
            int((lengths > 0).sum()), int(lengths.sum()), self.ids, narrow(lengths), hashes[terms].tobytes(), b"".join(words),
            *[narrow(x) for x in (sizes, counts, docs, tfs)],
        ]


def build_index(docs, id_col="doc_id", text_col="text"):
    """The index of ``docs``, written to the shared folder: a row for each segment, with the postings of all its terms.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are lower-cased. Terms of a
    segment are told by a hash of 64 bits and kept with their bytes. A null text has no term; rows without an id are
    held like others.
    """
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())] + [pa.binary()] * 7
    names = [x.split()[0] for x in SEGMENT.split(", ")]

    def out(segment):
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(segment.row(), kinds)], names=names)

    def run(batches):
        rolling = Rolling(12)
        segment = Segment(rolling)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, data, offsets in text_chunks(batch.column(1)):
                segment.add(ids[first:first + len(offsets) - 1], data, offsets)
                if segment.bytes >= SEGMENT_BYTES:
                    yield out(segment)
                    segment = Segment(rolling)
        if segment.ids:
            yield out(segment)

    return saved(documents(docs, id_col, text_col).mapInArrow(run, SEGMENT), "index")


def _find(vocabulary, hashes, words, word_sizes):
    """(place in the vocabulary, place in the segment) of the terms that both have. vocabulary: (sorted hashes, bytes)."""
    own, texts = vocabulary
    at = np.searchsorted(hashes, own)
    hit = np.flatnonzero(at < len(hashes))
    hit = hit[hashes[at[hit]] == own[hit]]
    ends = np.cumsum(wide(word_sizes, len(hashes)), dtype=np.int64)
    starts = np.r_[0, ends[:-1]]
    return [(v, k) for v, k in zip(hit.tolist(), at[hit].tolist()) if words[starts[k]:ends[k]] == texts[v]]


class Best:
    """The k best (score, id) of a query so far; equal scores by the lesser id, no id last."""

    def __init__(self, k):
        self.k, self.scores, self.ids, self.none = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self):
        """A score below this cannot enter any more."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores, ids, none):
        scores, ids, none = np.r_[self.scores, scores], np.r_[self.ids, ids], np.r_[self.none, none]
        keep = np.lexsort((ids, none, -scores))[:self.k]
        self.scores, self.ids, self.none = scores[keep], ids[keep], none[keep]


class Postings:
    """A list that is walked through by windows: documents, their parts of the score, and the bound of each window."""

    def __init__(self, docs, scores, n_docs):
        self.docs, self.scores, self.bound = docs, scores, int(scores.max())
        windows = np.arange(0, n_docs + WINDOW, WINDOW)
        self.cuts = np.searchsorted(docs, windows)
        self.bounds = np.zeros(len(windows) - 1, np.int64)
        full = np.flatnonzero(np.diff(self.cuts))
        self.bounds[full] = np.maximum.reduceat(scores, self.cuts[full])

    def window(self, w):
        part = slice(self.cuts[w], self.cuts[w + 1])
        return self.docs[part], self.scores[part]


def search_segment(weighted, n_docs, ids, none, best):
    """Offers the documents of a segment to ``best``. weighted: (documents, parts of the score above 0) of each list of the query.

    Short lists are summed up first, term at a time, into accumulators; these are then one more list with a bound of its
    own, walked through together with the long lists, document at a time. Lists whose bounds together stay below the
    least score that still enters give no candidates; windows, and candidates within a window, whose bound stays below
    it are skipped.
    """
    most = max(LEAST_SHORT, n_docs // SHORT_SHARE)
    short = [x for x in weighted if len(x[0]) <= most]
    lists = [Postings(d, s, n_docs) for d, s in weighted if len(d) > most]
    if short:
        docs, place = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, place, np.concatenate([s for _, s in short]))
        lists.append(Postings(docs, sums, n_docs))
    if not lists:
        return
    lists.sort(key=lambda x: x.bound)
    below = np.cumsum([x.bound for x in lists])
    bounds = np.sum([x.bounds for x in lists], axis=0)
    for w in np.argsort(-bounds, kind="stable").tolist():
        least = best.least
        if bounds[w] < least:
            break
        # Lists before this one cannot bring a document in by themselves.
        first = int(np.searchsorted(below, least))
        if first == len(lists):
            break
        base, size = w * WINDOW, min(WINDOW, n_docs - w * WINDOW)
        sums, seen = np.zeros(size, np.int64), np.zeros(size, bool)
        for x in lists[first:]:
            docs, scores = x.window(w)
            sums[docs - base] += scores
            seen[docs - base] = True
        found = np.flatnonzero(seen)
        rest = int(sum(x.bounds[w] for x in lists[:first]))
        for x in reversed(lists[:first]):
            found = found[sums[found] + rest >= least]
            rest -= int(x.bounds[w])
            docs, scores = x.window(w)
            if not len(found) or not len(docs):
                continue
            at = np.minimum(np.searchsorted(docs, found + base), len(docs) - 1)
            sums[found] += np.where(docs[at] == found + base, scores[at], 0)
        found = found[sums[found] >= least]
        if len(found):
            best.offer(sums[found], ids[found + base], none[found + base])


def _blocks(queries, id_col, text_col):
    """(item id, text) rows of the queries, a bounded share of them at a time."""
    rows = queries.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    rows = saved(rows.withColumn("place", F.monotonically_increasing_id()), "items")
    n = -(-(rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) // BLOCK_BYTES)
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("place"), F.lit(n)) == b) if n > 1 else rows
        yield [(r["item_id"], terms_of(r["text"])) for r in part.orderBy("place").collect()]


def _search_block(index, items, k):
    """(item, item_id, doc_id, score) rows, k of each item from each task at most."""
    spark = index.sparkSession
    texts = sorted({t for _, terms in items for t in terms})
    rolling = Rolling(12)
    joined = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    hashes = rolling.words(joined, np.r_[0, ends[:-1]].astype(np.int64), ends) if texts else np.zeros(0, np.uint64)
    order = np.argsort(hashes)
    vocabulary = spark.sparkContext.broadcast((hashes[order], [texts[i] for i in order]))
    place = {texts[i]: v for v, i in enumerate(order.tolist())}

    def count(batches):
        counts, totals = np.zeros(len(texts), np.int64), [0, 0]
        for batch in batches:
            for i in range(batch.num_rows):
                docs, tokens, own, words, word_sizes, n = (batch.column(j)[i].as_py() for j in range(6))
                totals = [totals[0] + docs, totals[1] + tokens]
                own = np.frombuffer(own, np.uint64)
                n = wide(n, len(own))
                for v, at in _find(vocabulary.value, own, words, word_sizes):
                    counts[v] += int(n[at])
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *full.tolist()], pa.int64()), pa.array([*totals, *counts[full].tolist()], pa.int64())], names=["term", "n"])

    read = index.select("docs", "tokens", "hashes", "words", "word_sizes", "counts")
    known = {r["term"]: r["n"] for r in read.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_tokens = known.get(-2, 0), known.get(-1, 0)
    worth = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * known.get(v, 0) + 1))) for v in range(len(texts))]
    asked = []
    for item, (item_id, terms) in enumerate(items):
        times = {}
        for t in terms:
            times[place[t]] = times.get(place[t], 0) + 1
        asked.append((item, item_id, [(v, q * worth[v]) for v, q in times.items() if worth[v] > 0 and v in known]))
    shared = spark.sparkContext.broadcast([x for x in asked if x[2]])

    def run(batches):
        best = {item: Best(k) for item, _, _ in shared.value}
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, own, words, word_sizes, counts, places, tfs = (batch.column(j)[i].as_py() for j in range(8))
                none = np.asarray([x is None for x in ids], bool)
                ids = np.asarray([x or 0 for x in ids], np.int64)
                n = wide(lengths, len(ids)).astype(np.int64)
                stretch = FULL_LENGTH - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // max(1, n_tokens)
                own = np.frombuffer(own, np.uint64)
                starts = np.r_[0, np.cumsum(wide(counts, len(own)), dtype=np.int64)]
                places, tfs = wide(places, int(starts[-1])), wide(tfs, int(starts[-1]))
                lists = {}
                for v, at in _find(vocabulary.value, own, words, word_sizes):
                    part = slice(starts[at], starts[at + 1])
                    docs, tf = places[part].astype(np.int32), tfs[part].astype(np.int64)
                    lists[v] = docs, 10**9 * tf // (SCALE * tf + SATURATION * stretch[docs])
                for item, _, terms in shared.value:
                    weighted = [(lists[v][0], w * lists[v][1]) for v, w in terms if v in lists]
                    search_segment(weighted, len(ids), ids, none, best[item])
        out = [(item, item_id, None if no else int(d), int(s)) for item, item_id, _ in shared.value for d, s, no in zip(best[item].ids, best[item].scores, best[item].none)]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], pa.int64()) for j in range(4)], names=["item", "item_id", "doc_id", "score"])

    read = index.select("ids", "lengths", "hashes", "words", "word_sizes", "counts", "places", "tfs")
    return read.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(index, queries, k=20, id_col="item_id", text_col="text"):
    """item_id, rank, doc_id, score: the ``k`` documents of the index with the highest scores above 0 for each row of ``queries``.

    Equal scores go by ascending doc_id (rows without an id last). A task answers all queries of a block on its segments,
    and hands on at most ``k`` rows of each; a document that cannot reach the k-th score found so far is not scored.
    Queries are taken in blocks of bounded size; no block's work depends on another's. Repeated queries and documents
    each count as rows of their own. A null or empty query, or one without a known term, has no row; nor has an index of
    nothing.
    """
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    out = None
    for items in _blocks(queries, id_col, text_col):
        ranked = _search_block(index, items, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.union(ranked)
    return out if out is not None else index.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def rank_documents(docs, queries, k=20):
    """Builds the index of ``docs`` and searches it for every row of ``queries``."""
    return search(build_index(docs), queries, k)
