"""Language model, fingerprints and ranking."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
from llm_texts import prose

from linguamart.llm import lzprint, maxent, ranking


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def brute_base(rows):
    docs = [(i, (t or "").encode().lower().split() + [b"\n"]) for i, t in rows]
    counts = Counter(w for i, ws in docs if fold(i, 10) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return sorted(
        ((i, not fold(i, 10), len(ws), sum(w in counts for w in ws), total,
          round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), 6)) for i, ws in docs), key=str,
    )


def test_language_model(frame, odd_rows):
    rows = odd_rows + [(100 + i, prose(120, i)) for i in range(60)]
    for known in (maxent.KNOWN_WORDS, 20):
        got = maxent.score_documents(frame(rows), known=known).collect()
        plain = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
        assert sorted(plain, key=str) == brute_base(rows)
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_model_learns_order(frame):
    """Words that follow each other in a fixed order are likelier in it than each by itself."""
    cycle = " ".join(f"w{i}" for i in range(30))
    rows = [(i, f"{cycle} " * 8) for i in range(80)]
    held = [r for r in maxent.score_documents(frame(rows)).collect() if r["held_out"]]
    assert held and all(r["score"] > 0.8 * r["base_score"] for r in held)


def test_probabilities_add_up():
    known = [(f"w{i}".encode(), 1000 - i) for i in range(600)]
    rest = [(f"x{i}".encode(), 1) for i in range(50)]
    masses = {}
    for w, n in known[maxent.CLASS_WORDS:] + rest:
        m = masses.setdefault(maxent.open_class(w), [0, 0])
        m[0], m[1] = m[0] + n, m[1] + 1
    rng = np.random.default_rng(1)
    model = maxent.Model(maxent.Vocabulary(known, masses), rng.normal(0, 0.3, sum(maxent.SHAPE)).astype(np.float32))
    v, total = model.v, 0.0
    # Every known word, every rare one, and in each open class one that was never seen, after the same two words.
    seen = [(w, n) for w, n in known + rest]
    for w, n in seen:
        p = model.log10_parts(*model.lay_out([np.array([v[b"w3"], v[b"x1"], v[w]], np.int32)]))[-1]
        total += 10 ** (p + (0 if v[w] < v.n else math.log10(n + maxent.SMOOTH)))
    for k in range(maxent.OPEN):
        code = v.n + k * maxent.SHAPED
        total += 10 ** (model.log10_parts(*model.lay_out([np.array([v[b"w3"], v[b"x1"], code], np.int32)]))[-1] + math.log10(maxent.SMOOTH))
    assert abs(total - 1) < 1e-4


def test_small_probabilities_are_not_cut():
    """A class or word far beyond what a float holds keeps its own log probability."""
    known = [(f"w{i}".encode(), 1000 - i) for i in range(600)]
    weights = np.zeros(sum(maxent.SHAPE), np.float32)
    weights[-maxent.CLASSES] = 400
    weights[maxent.SHAPE[0]:-maxent.CLASSES].reshape(-1, maxent.EACH)[:, 0] = 100
    model = maxent.Model(maxent.Vocabulary(known, {k: (1, 1) for k in range(maxent.OPEN)}), weights)
    places = [0, 1, maxent.EACH, maxent.EACH + 1]
    got = model.log10_parts(*model.lay_out([np.array(places, np.int32)]))
    counts = np.array([n for _, n in known[:maxent.CLASS_WORDS]], float).reshape(-1, maxent.EACH)
    biases = model.v.bias.astype(float) + model.bias
    share = (biases - biases.max() - np.log(np.exp(biases - biases.max()).sum())) / maxent.LN10
    for i, p in zip(places, got):
        z = np.log(counts[i // maxent.EACH] + maxent.SMOOTH)
        z[0] += 200
        word = (z - z.max() - np.log(np.exp(z - z.max()).sum())) / maxent.LN10
        assert abs(p - share[i // maxent.EACH] - word[i % maxent.EACH]) < 1e-3
    assert got[3] < -200


def test_nothing_to_score(frame):
    assert maxent.score_documents(frame([])).count() == 0
    assert lzprint.fingerprints(frame([])).count() == 0


def test_fingerprints(frame, odd_rows, monkeypatch):
    monkeypatch.setattr(lzprint, "BUCKET_BYTES", 20_000)
    rows = odd_rows + [(100 + i, prose(150, i)) for i in range(40)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        changed = lzprint.edited_text(text, other)
        own, new, following = (lzprint.fingerprint(x) for x in (text, changed, other))
        want.append((
            doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), new.tobytes().hex(),
            lzprint.likeness(own, new), lzprint.likeness(own, following),
        ))
    assert sorted(map(tuple, lzprint.fingerprints(frame(rows)).collect()), key=str) == sorted(want, key=str)


def plain_mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor % 2 ** 64
    return x ^ (x >> 31)


def plain_print(text):
    """The fingerprint step by step: words, pieces of long ones, phrases, hashes, least of each slot."""
    words = []
    for word in text.encode().split():
        if len(word) > 64:
            held = ""
            characters = word.decode()
            for a, b in zip(characters, characters[1:] + " "):
                held += a
                if plain_mix((ord(a) << 32) + ord(b)) % 4 == 0 and b != " ":
                    words.append(held.encode())
                    held = ""
            words.append(held.encode())
        else:
            words.append(word)
    phrases, phrase = set(), []
    for word in words:
        phrase.append(word)
        if b" ".join(phrase) not in phrases:
            phrases.add(b" ".join(phrase))
            phrase = []
    slots = [None] * 256
    for h in (plain_mix(zlib.crc32(p)) for p in phrases):
        k, rest = h >> 56, h % 2 ** 56
        slots[k] = rest if slots[k] is None else min(slots[k], rest)
    return [0 if x is None else x % 65535 + 1 for x in slots]


def plain_likeness(a, b):
    used = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def test_fingerprints_against_plain_python(frame, odd_rows):
    long = "".join(chr(0x4E00 + (7 * i * i + i) % 900) for i in range(3_000))
    rows = odd_rows + [(100, long), (101, long[:1500] + "x" + long[1500:]), (102, "acgt" * 400 + " end"), (103, "é" * 200 + " ñ " + "\U0001F600" * 90), (104, "x" * 65), (105, "y" * 64)]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        changed = text[:len(text) - third] + other[:third]
        own, new, following = map(plain_print, (text, changed, other))
        spelled = ["".join(f"{x:04x}" for x in p) for p in (own, new)]
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *spelled, round(plain_likeness(own, new), 9), round(plain_likeness(own, following), 9)))
    got = [(*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in lzprint.fingerprints(frame(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_text_without_spaces():
    """One character more among 5,000 changes little; another text shares next to nothing."""
    rng = np.random.default_rng(4)
    for first, size in ((0x4E00, 800), (0x41, 4)):
        text = "".join(map(chr, rng.integers(first, first + size, 5_000)))
        other = "".join(map(chr, rng.integers(first, first + size, 5_000)))
        for at in (3, 2_500, 4_990):
            assert lzprint.likeness(lzprint.fingerprint(text), lzprint.fingerprint(text[:at] + "z" + text[at:])) > 0.9
        assert lzprint.likeness(lzprint.fingerprint(text), lzprint.fingerprint(other)) < (0.2 if size > 4 else 0.9)


def test_parse_and_likeness():
    known = set()
    lzprint.parse(b"a a b a b a b".split(), known)
    assert known == {b"a", b"a b", b"a b a", b"b"} and not lzprint.parse([], set())
    near = lzprint.likeness(lzprint.fingerprint(prose(300, 1)), lzprint.fingerprint(prose(300, 1) + " more"))
    far = lzprint.likeness(lzprint.fingerprint(prose(300, 1)), lzprint.fingerprint(prose(300, 2)))
    assert near > 0.9 > far and lzprint.likeness(lzprint.fingerprint(""), lzprint.fingerprint(" ")) == 1.0


def test_ranking(spark, frame, odd_rows):
    good = [(1000 + i, ". ".join(prose(12, 7 * i + k).capitalize() for k in range(6)) + ".") for i in range(120)]
    bad = [(2000 + i, " ".join(w + "###" for w in prose(60, i).upper().split())) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, None) for i, _ in good] + [(i, 0, 1) for i, _ in bad] + [(None, 1, 0), (5, None, 0), (6, 7, 0)], "doc_id long, quality int, toxic int")
    got = ranking.score_documents(frame(odd_rows + good + bad), labels).collect()
    assert len(got) == len(odd_rows + good + bad) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (not fold(r["doc_id"], 5)) for r in got)
    held = [(r["doc_id"] < 2000, r["predicted"]) for r in got if r["held_out"] and (r["doc_id"] or 0) >= 1000]
    assert len(held) > 10 and all(a == b for a, b in held)
    assert len({r["score"] for r in got if r["doc_id"] == 8}) == 1
    assert ranking.score_documents(frame([]), labels).count() == 0
    # Labels that contradict each other: 0 holds; an id that comes many times with one text adds one text.
    twice = labels.unionByName(spark.createDataFrame([(1000 + i, 0, 0) for i in range(5)] * 2, "doc_id long, quality int, toxic int"))
    learnt = {r["text"]: r["quality"] for r in ranking.labelled(frame(good + good[:3] * 500 + bad).select("doc_id", "text"), twice, 5).collect()}
    assert len(learnt) == sum(bool(fold(i, 5)) for i, _ in good + bad) and all(learnt[t] == (i >= 1005) for i, t in good if fold(i, 5))
    assert ranking.labelled(frame(good + good[:3] * 500 + bad).select("doc_id", "text"), twice, 5).count() == len(learnt)
    alike = ranking.score_documents(frame(odd_rows), labels.where("quality = 9")).collect()
    assert {round(r["score"], 9) for r in alike} == {0.3}
