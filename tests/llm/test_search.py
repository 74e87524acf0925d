"""Ranked search against plain Python integers."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_texts import WORDS, prose

from linguamart.llm import lexsearch


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    df = Counter(w for _, c in held for w in c)
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    out = []
    for item, text in items:
        scores = []
        for doc_id, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w, q in Counter(terms(text)).items() if c[w])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(index_rows, items, k, spark, **options):
    queries = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, rank int, term string, place int")
    return sorted((tuple(r) for r in lexsearch.rank_documents(index_rows, queries, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, prose(12, 2)), (2, prose(3, 3) + " " + prose(3, 3)), (3, None), (4, ""), (5, "añb ONE one 12 x"), (6, prose(200, 5)), (None, "one"), (2, "absent-word"), (7, "... \t")]


@pytest.mark.parametrize("parts", [1, 5])
def test_search(spark, frame, odd_rows, parts):
    docs = odd_rows + [(100 + i, prose(1 + 7 * i % 90, i)) for i in range(150)]
    assert found(frame(docs).repartition(parts), ITEMS, 20, spark) == brute(docs, ITEMS, 20)


def test_small_segments_and_blocks(spark, frame, odd_rows, monkeypatch):
    """Segments of a few texts, texts cut into slices, lists of many windows, one pass for every few queries."""
    for name, value in {"SEGMENT_BYTES": 4_000, "SLICE_BYTES": 700, "WINDOW": 8, "LEAST_SHORT": 3, "BLOCK_BYTES": 300}.items():
        monkeypatch.setattr(lexsearch, name, value)
    docs = odd_rows + [(100 + i, prose(1 + 7 * i % 90, i)) for i in range(150)] + [(500, "k" * 5_000), (501, "k" * 5_000 + " one")]
    items = ITEMS + [(8, "k" * 5_000)]
    assert found(frame(docs).repartition(3), items, 4, spark) == brute(docs, items, 4)


def test_ties_and_copies(spark, frame):
    docs = [(i, "same words here") for i in range(60, 0, -1)] + [(7, "same words here"), (None, "same words here"), (900, "other")] * 2
    items = [(1, "same"), (2, "other same"), (3, "other other")]
    assert found(frame(docs), items, 20, spark) == brute(docs, items, 20)


def test_nothing(spark, frame):
    assert found(frame([]), ITEMS, 20, spark) == []
    assert found(frame([(1, None), (2, "..")]), ITEMS, 20, spark) == []
    assert found(frame([(1, "one")]), [], 20, spark) == []


@pytest.mark.parametrize("seed", range(30))
def test_segment(seed, monkeypatch):
    """Skipping loses no document: the k best of random lists are those of summing all of them up."""
    rng = random.Random(seed)
    monkeypatch.setattr(lexsearch, "WINDOW", rng.choice([4, 16, 512]))
    monkeypatch.setattr(lexsearch, "LEAST_SHORT", rng.choice([0, 5, 64]))
    n = rng.choice([1, 40, 700])
    ids = np.asarray(rng.sample(range(10_000), n), np.int64)
    none = np.asarray([rng.random() < 0.05 for _ in range(n)])
    best, sums = lexsearch.Best(rng.choice([1, 5, 20])), np.zeros(n, np.int64)
    lists = []
    for _ in range(rng.randint(0, 9)):
        docs = np.asarray(sorted(rng.sample(range(n), rng.randint(1, n))), np.int32)
        lists.append((docs, np.asarray([rng.choice([1, 2, 3, 50, rng.randint(1, 900)]) for _ in docs], np.int64)))
        sums[docs] += lists[-1][1]
    lexsearch.search_segment(lists, n, ids, none, best)
    want = sorted((-s, no, 0 if no else i, i) for s, no, i in zip(sums.tolist(), none.tolist(), ids.tolist()) if s > 0)[:best.k]
    assert best.scores.tolist() == [-x[0] for x in want]
    assert [i for i, no in zip(best.ids.tolist(), best.none.tolist()) if not no] == [x[3] for x in want if not x[1]]


@pytest.mark.parametrize("values", [[], [0], [0, 255], [256, 1], [65_535], [65_536, 3], [2**32 - 1, 0], [2**32, 7], [2**63 - 1]])
def test_numbers_are_kept(values):
    raw = lexsearch.narrow(np.asarray(values, np.int64))
    assert lexsearch.wide(raw, len(values)).tolist() == values
    assert len(raw) == len(values) * next(w for w in (1, 2, 4, 8) if max(values, default=0) < 1 << 8 * w)


def test_many_of_one_term(spark, frame):
    """Numbers beyond one and two bytes: of a term in a document, of documents that hold it, of a document's terms."""
    docs = [(i, "one " * (i % 3 + 1) + prose(i % 5, i)) for i in range(700)] + [(1000, "one two " * 300), (1001, "two " * 70_000 + "one"), (1002, None)]
    items = [(1, "one"), (2, "two one two"), (3, "absent")]
    assert found(frame(docs).repartition(2), items, 20, spark) == brute(docs, items, 20)


def test_index_is_no_larger_than_its_text(spark, frame):
    """A task reads all segments of a split at once, so an index row must not take more than the text it stands for."""
    docs = [(i, prose(150, i)) for i in range(1_500)]
    rows = lexsearch.build_index(frame(docs).coalesce(1)).collect()
    held = sum(len(x) for r in rows for x in r if isinstance(x, (bytes, bytearray)))
    assert held < 0.6 * sum(len(t) for _, t in docs)
    assert sum(r["docs"] for r in rows) == len(docs)


def test_words_are_distinct():
    assert len(set(WORDS)) == len(WORDS)
