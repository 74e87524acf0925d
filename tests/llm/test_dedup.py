"""Near duplicates and repeated passages against plain Python."""

import hashlib
import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from llm_texts import prose
from pyspark.sql import functions as F

from linguamart.llm import common, neardup, repeats
from linguamart.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(rows, share=85):
    sets = [shingles(t) for _, t in rows]
    home = list(range(len(rows)))

    def top(i):
        while home[i] != i:
            i = home[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= share * len(sets[i] | sets[j]):
                home[top(i)] = top(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            groups[top(i)] = min(doc_id, groups.get(top(i), doc_id))
    return sorted(((d, len(sets[i]), groups.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited(text, places):
    words = text.split()
    for p in places:
        words[p] = f"new{p}"
    return " ".join(words)


def near_rows(odd_rows):
    """Chains (a to b, b to c, not a to c), a group of near copies, and texts that share half."""
    base = prose(300, 9)
    chain = [edited(base, ()), edited(base, (40, 140)), edited(base, (40, 140, 220, 260, 280)), edited(base, (40, 100, 140, 180, 220, 260, 280))]
    group = [edited(prose(200, 11), (7 * k % 190,)) for k in range(30)]
    halves = [prose(60, 12) + " " + prose(60, 13 + k) for k in range(20)]
    return odd_rows + [(100 + i, t) for i, t in enumerate(chain + group + halves)]


def test_near_duplicates(frame, odd_rows):
    rows = near_rows(odd_rows)
    found = neardup.near_duplicates(frame(rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_group_costs_no_pairs(frame):
    rows = [(i, edited(prose(200, 11), (7 * i % 190,))) for i in range(60)]
    assert {r["component_id"] for r in neardup.near_duplicates(frame(rows)).collect()} == {0}


def near_group(n, seed):
    """Copies of one text with 1 to 5 words replaced by words of their own, and copies of copies: many pairs are alike just below the threshold."""
    rng = random.Random(seed)
    base, texts = prose(150, seed).split(), []
    for i in range(n):
        words = list(rng.choice(texts).split() if texts and rng.random() < 0.1 else base)
        for k in range(rng.choice([1, 1, 2, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"own{i}x{k}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("share", [85, 80])
def test_large_group_of_near_copies(frame, monkeypatch, share):
    """All links of a group are found, and the pairs that are looked at grow with its size, not with the square of it."""
    texts = near_group(300, 5)
    rows = list(enumerate(texts + [prose(120, 700 + i) for i in range(30)] + [" ".join(prose(150, 5).split())]))
    random.Random(1).shuffle(rows)
    looked = []
    real = neardup.confirm

    def counted(pairs, texts, share):
        looked.append(pairs.count())
        return real(pairs, texts, share)

    monkeypatch.setattr(neardup, "confirm", counted)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(frame(rows), share=share).collect()), key=str)
    assert got == brute_components(rows, share)
    assert sum(looked) < 10 * len(rows), looked


@pytest.mark.parametrize("share", [85, 80, 50])
def test_rare_meetings(spark, share):
    """Against plain sets, with some components merged: every linked pair of two components meets, and few others do."""
    texts = near_group(80, 8) + ["a b", "a b", "c", prose(9, 1), prose(9, 1) + " more"] + [" ".join(near_group(1, 8)[0].split()[:k]) for k in (100, 125, 140)]
    sets = [shingles(t) for t in texts]
    component = [i // 3 * 3 for i in range(len(texts))]
    nodes = spark.createDataFrame([(i, c, len(s)) for i, (c, s) in enumerate(zip(component, sets))], "node long, component long, n long")
    held = neardup.shingles_of(spark.createDataFrame(list(enumerate(texts)), "node long, text string"))
    assert held.count() == sum(map(len, sets))
    met = {(r["a"], r["b"]) for r in neardup.rare_meetings(nodes, held, share).collect()}
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if component[i] != component[j]]
    linked = {(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j])}
    assert linked <= met <= set(pairs)
    assert share < 85 or len(met) < 0.5 * len(pairs)


def test_near_duplicates_of_nothing(frame):
    assert neardup.near_duplicates(frame([])).count() == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (200, 199), (200, 198)] + [(300, 301 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 198: 198, 199: 198, 200: 198} | {i: 300 for i in range(300, 351)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_edges(spark, seed):
    """Against a search from every node, with a chain that is longer than any number of rounds."""
    rng = random.Random(seed)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1_000 + i, 1_001 + i) for i in range(300)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for first in sorted(near):
        held = [first] if first not in want and near[first] - {first} else []
        while held:
            node = held.pop()
            if node not in want:
                want[node] = first
                held += near[node]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(3)).collect()}
    assert got == want


def brute_removal(rows, size):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k:k + size]) for _, w in docs for k in range(len(w) - size + 1))
    out = []
    for doc_id, w in docs:
        gone = set()
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(df, **more):
    rows = repeats.remove_repeats(df, **more).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in rows), key=str)


def test_remove_repeats(frame, odd_rows):
    shared = prose(50, 20)
    rows = odd_rows + [(50 + i, f"{prose(30 + i, 30 + i)} {shared} {prose(20, 60 + i)}") for i in range(12)] + [(70, f"{prose(40, 80)} {shared[:-3]}")]
    # A tail that overlaps itself, and a passage that comes twice in one text.
    rows += [(80, prose(36, 90) + " " + prose(36, 90)), (81, "z y " * 40)]
    assert removed(frame(rows)) == brute_removal(rows, 35)
    # A sketch that is far too small lets more through, and changes nothing.
    assert removed(frame(rows), cells=64) == brute_removal(rows, 35)
    assert removed(frame(rows), size=7) == brute_removal(rows, 7)


def test_remove_repeats_over_partitions(frame):
    rows = [(i, f"{prose(40, i % 7)} own{i}") for i in range(60)]
    assert removed(frame(rows).repartition(9, "doc_id")) == brute_removal(rows, 35)


def test_many_copies_of_one_text(spark, frame):
    """What copies in many tasks have found of one text counts once: the list that is gathered is that of the text's own windows."""
    text = prose(80, 3)
    rows = [(i, text) for i in range(10_000)] + [(20_000, prose(60, 4)), (20_001, f"{prose(20, 5)} {text[:-4]}")]
    df = frame(rows).repartition(64)
    assert removed(df) == brute_removal(rows, 35)
    runs = repeats.repeated_runs(df.select("text", F.xxhash64("text").alias("text_hash")))
    assert runs.select(F.max(F.size("found"))).first()[0] <= 80


def test_remove_repeats_from_nothing(frame):
    assert removed(frame([])) == []


class Direct:
    """Batches of (text, text_hash) whose function runs here, without Spark."""

    def __init__(self, texts):
        self.batches = [pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], names=["text", "text_hash"])]
        self.sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda x: SimpleNamespace(value=x)))

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run(iter(self.batches))


def peak_mb(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_words_are_hashed_by_blocks():
    """A word's hash is that of its bytes alone, and memory doesn't follow the length of the text."""
    words = prose(500_000, 6).split()
    words[1000], words[-1] = "x" * (3 * common.BLOCK_BYTES), "é" * common.BLOCK_BYTES
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = common.words_of(data, np.array([0, len(data)]))
    assert len(starts) == len(words)
    got, peak = peak_mb(lambda: common.Rolling(5).words(data, starts, ends))
    assert peak < 64, peak
    alone = common.Rolling(5)
    for i in [*range(0, 3000), *range(len(words) - 50, len(words))]:
        word = np.frombuffer(words[i].encode(), np.uint8)
        assert got[i] == alone.words(word, np.array([0]), np.array([len(word)]))[0]
    assert len(common.Rolling(5).words(data[:0], starts[:0], ends[:0])) == 0


def test_tasks_hand_on_small_batches():
    """What a task has gathered leaves by ROWS at a time, and sorting it takes little more than what is held."""
    rng = np.random.default_rng(7)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 1000))) for _ in range(1000)]
    texts += texts[:300]
    cells, n = 1 << 22, 1300 * 966

    def run(batches):
        sizes, total = [], 0
        for batch in batches:
            sizes.append(batch.num_rows)
            total += int(np.sum(batch.column(batch.num_columns - 1).to_numpy()))
        return sizes, total

    (sizes, total), _ = peak_mb(lambda: run(repeats.sketch(Direct(texts), 35, cells)))
    assert max(sizes) <= 1 << 16 and 2 * 1300 * 30 < total < 2 * n
    (sizes, _), peak = peak_mb(lambda: run(repeats.candidates(Direct(texts), np.full(cells * 2 // 8, 255, np.uint8), 35, cells)))
    assert max(sizes) <= 1 << 16 and sum(sizes) >= 700 * 966
    assert peak < 175, peak


def test_remove_repeats_in_small_parts(frame, odd_rows, monkeypatch):
    """Where a task hands on what it holds, and where batches are cut, changes nothing."""
    monkeypatch.setattr(repeats, "HELD", 50)
    monkeypatch.setattr(repeats, "ROWS", 7)
    shared = prose(50, 20)
    rows = odd_rows + [(50 + i, f"{prose(30 + i, 30 + i)} {shared} {prose(20, 60 + i)}") for i in range(12)] + [(81, "z y " * 40)]
    assert removed(frame(rows).coalesce(1)) == brute_removal(rows, 35)


def test_texts_as_they_are(frame):
    """A text that loses nothing is handed on unchanged, a null one too."""
    rows = [(1, None), (2, ""), (3, " a\t b "), (4, prose(40, 1) + " \n end"), (5, prose(40, 1))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in repeats.remove_repeats(frame(rows), as_is=True).collect()}
    assert got == {1: (0, 0, None), 2: (0, 0, ""), 3: (2, 0, " a\t b "), 4: (41, 40, "end"), 5: (40, 40, "")}


@pytest.mark.parametrize("most", [1, 100, 1 << 21])
def test_slices(most):
    texts = [None, "", "abc" * 50, "é" * 20, None, "x"] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(texts)], names=["i", "text"])
    parts = list(common.slices(batch, 1, most))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert len(parts) == 1 if most > 1000 else all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[:-1]) < most for p in parts)
    assert list(common.slices(batch.slice(0, 0), 1, most)) == []
