"""A hashed maximum-entropy language model: n-gram and skip features, class-factored softmax, distributed gradient updates."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import documents, in_fold, saved

FOLDS = 10
#: The end of a text, a token that no word can be.
END = b"\n"
SMOOTH = 0.1
#: Words whose counts every task knows (the most frequent); the counts of all others are joined.
KNOWN_WORDS = 1 << 17
#: Words with a probability of their own in a class, and words of a class. All others fall into OPEN classes by how they begin.
CLASS_WORDS, EACH, OPEN = 512, 32, 16
CLASSES = CLASS_WORDS // EACH + OPEN
#: Words that are features by themselves, and features of all others, by their first and last two bytes.
NAMED, SHAPED = 4096, 4096
START = NAMED + SHAPED
#: Rows of weights, of classes and of words in a class; features are hashed into them.
SLOTS = 1 << 14
#: Slices of the corpus, each the data of one round; tokens of a step; its length; weights in a block of updates.
ROUNDS, STEP_TOKENS, RATE, BLOCK = 2, 8192, 0.15, 1024
#: Tokens of coded texts that are handed on at a time.
CODED_TOKENS = 1 << 19
SHAPE = SLOTS * CLASSES, SLOTS * EACH, CLASSES
LN10 = float(np.log(10))
#: Probabilities below this one are worked out in logarithms.
LEAST = np.float32(1e-30)


def tokens(text):
    return [*text.encode().lower().split(), END]


def open_class(word):
    return zlib.crc32(word[:2]) % OPEN


class Vocabulary(dict):
    """Word -> code. A code beyond the known words tells class and feature of a word by its shape."""

    def __init__(self, known, masses):
        """known: (word, count), the most frequent first; masses: class -> (count, words) of the open classes."""
        super().__init__((w, i) for i, (w, _) in enumerate(known))
        n = self.n = len(known)
        size = n + OPEN * SHAPED
        self.feature = np.empty(size, np.int32)
        self.kind = np.empty(size, np.int16)
        self.place = np.full(size, -1, np.int16)
        self.log_count = np.zeros(size)
        shapes = np.arange(OPEN * SHAPED)
        self.feature[n:], self.kind[n:] = NAMED + shapes % SHAPED, CLASSES - OPEN + shapes // SHAPED
        counts = np.array([c for _, c in known], float)
        self.log_count[:n] = np.log10(counts + SMOOTH) if n else []
        own = min(n, CLASS_WORDS)
        self.feature[:n] = [i if i < NAMED else NAMED + self.shape(w) for i, (w, _) in enumerate(known)]
        self.kind[:n] = [i // EACH if i < own else CLASSES - OPEN + open_class(w) for i, (w, _) in enumerate(known)]
        self.place[:own] = np.arange(own) % EACH
        mass = np.zeros(CLASSES)
        np.add.at(mass, self.kind[:own], counts[:own])
        self.open_norm = np.zeros(CLASSES)
        for k, (count, words) in masses.items():
            mass[CLASSES - OPEN + k] = count
        for k in range(OPEN):
            count, words = masses.get(k, (0, 0))
            self.open_norm[CLASSES - OPEN + k] = np.log10(count + SMOOTH * (words + 1))
        # Classes without words can't be; an open class always has room for an unknown one.
        self.bias = np.log(np.where(np.arange(CLASSES) < CLASSES - OPEN, np.maximum(mass, 1e-30), mass + 1)).astype(np.float32)
        inner = np.full((CLASSES - OPEN, EACH), -1e9, np.float32)
        inner.ravel()[:own] = np.log(counts[:own] + SMOOTH)
        self.inner = inner

    def plain(self):
        """The words and what goes with them as plain objects, as broadcast values have to be."""
        return list(self)[:self.n], self.__dict__

    @classmethod
    def of_plain(cls, words, rest):
        made = cls.__new__(cls)
        made.update(zip(words, range(len(words))))
        made.__dict__.update(rest)
        return made

    @staticmethod
    def shape(word):
        return zlib.crc32(word[:2] + word[-2:]) % SHAPED

    def __missing__(self, word):
        return self.n + open_class(word) * SHAPED + self.shape(word)


def slots_of(*features):
    """Hash features into the rows of weights (by SLOTS up to 2**16)."""
    x = np.uint64(len(features))
    for f in features:
        x = (x + f.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    return ((x >> np.uint64(20)) & np.uint64(SLOTS - 1)).astype(np.uint16)


class Model:
    """Weights over a vocabulary: P(word | before) = P(class | before) * P(word | class, before)."""

    def __init__(self, vocabulary, weights):
        self.v = vocabulary
        a, b, _ = np.split(weights, np.cumsum(SHAPE)[:-1])
        self.weights = weights
        self.a, self.b, self.bias = a.reshape(SLOTS, CLASSES), b.reshape(SLOTS, EACH), weights[-CLASSES:]

    def lay_out(self, coded):
        """(codes, slots of class features, the two words before) of texts that are arrays of codes."""
        pad = np.full(2, -1, np.int32)
        flat = np.concatenate([x for c in coded for x in (pad, c)])
        at = np.flatnonzero(flat >= 0)
        feature = np.where(flat >= 0, self.v.feature[flat], START)
        before = [np.take(feature, at - k) for k in (1, 2)]
        one = np.ones(1, np.int64)
        slots = [slots_of(one, before[0]), slots_of(one * 2, before[1]), slots_of(before[1], before[0])]
        return np.take(flat, at), slots, before

    @staticmethod
    def softmax(z):
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(1, keepdims=True)
        return z

    @staticmethod
    def log10_softmax(z, at):
        """log10 of the softmax of column ``at`` of each row, also of one too small to be held as a number."""
        rows = np.arange(len(z))
        z -= z.max(1, keepdims=True)
        own = z[rows, at].astype(float)
        np.exp(z, out=z)
        total = z.sum(1)
        share = z[rows, at] / total
        out = np.log10(np.maximum(share, LEAST)).astype(float)
        small = np.flatnonzero(share < LEAST)
        out[small] = (own[small] - np.log(total[small].astype(float))) / LN10
        return out

    def classes(self, slots):
        z = np.take(self.a, slots[0], 0)
        for s in slots[1:]:
            z += np.take(self.a, s, 0)
        z += self.v.bias + self.bias
        return z

    def words(self, kind, before):
        slots = [slots_of(np.full(1, 4), kind, before[0]), slots_of(np.full(1, 5), kind, before[1])]
        return np.take(self.b, slots[0], 0) + np.take(self.b, slots[1], 0) + np.take(self.v.inner, kind, 0), slots

    def log10_parts(self, codes, slots, before):
        """The model's log10 probability of each token, without log10(count + SMOOTH) of words that are not known: ``score_documents`` joins their counts."""
        kind, place = self.v.kind[codes], self.v.place[codes]
        out = self.log10_softmax(self.classes(slots), kind)
        closed = np.flatnonzero(place >= 0)
        inner, _ = self.words(kind[closed], [b[closed] for b in before])
        out[closed] += self.log10_softmax(inner, place[closed])
        rest = place < 0
        out[rest] += self.v.log_count[codes[rest]] - self.v.open_norm[kind[rest]]
        return out

    def learn(self, codes, slots, before, seen):
        """One gradient step on a run of tokens; ``seen`` has the squared gradients so far, as the weights are laid out."""
        kind, place = self.v.kind[codes], self.v.place[codes]
        sa, sb = seen[:SHAPE[0]].reshape(SLOTS, CLASSES), seen[SHAPE[0]:-CLASSES].reshape(SLOTS, EACH)
        g = self.softmax(self.classes(slots))
        g[np.arange(len(codes)), kind] -= 1
        closed = np.flatnonzero(place >= 0)
        h, inner = self.words(kind[closed], [b[closed] for b in before])
        h = self.softmax(h)
        h[np.arange(len(closed)), place[closed]] -= 1
        for s in slots:
            _descend(self.a, sa, s, g)
        for s in inner:
            _descend(self.b, sb, s, h)
        total = g.sum(0)
        seen[-CLASSES:] += total * total
        self.bias -= RATE * total / np.sqrt(1 + seen[-CLASSES:])


def _descend(weights, seen, slots, gradients):
    """Adagrad on the rows that ``slots`` name; gradients of one row are added up first."""
    if not len(slots):
        return
    order = np.argsort(slots, kind="stable")
    s, g = np.take(slots, order), np.take(gradients, order, 0)
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    count = np.diff(np.append(first, len(s)))
    place, size = np.arange(len(s)) - np.repeat(first, count), np.repeat(count, count)
    done = []
    while True:
        # Neighbours of one row are added in pairs, until it is there once.
        single = size == 1
        done.append((s[single], g[single]))
        left = np.flatnonzero(~single & (place % 2 == 0))
        if not len(left):
            break
        place, size = np.take(place, left), np.take(size, left)
        paired = place + 1 < size
        other = np.take(g, left + paired, 0)
        other[~paired] = 0
        g = np.take(g, left, 0)
        g += other
        s, place, size = np.take(s, left), place >> 1, (size + 1) >> 1
    s, g = (np.concatenate(x) for x in zip(*done))
    past = np.take(seen, s, 0)
    past += g * g
    seen[s] = past
    past += 1
    np.sqrt(past, out=past)
    g *= RATE
    g /= past
    weights[s] = np.take(weights, s, 0) - g


CODED = "doc_id long, codes binary, words array<binary>, times array<int>"


def code_texts(docs, vocabulary):
    """Texts as codes, CODED: cut into words and looked up once; training and scoring read this. ``words`` are those that are not known."""
    spoken = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def run(batches):
        v = Vocabulary.of_plain(*spoken.value)
        code = v.__getitem__

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=[x.split()[0] for x in CODED.split(", ")])

        for batch in batches:
            rows, n = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens(text.as_py())
                codes = np.fromiter(map(code, words), np.int32, len(words))
                unknown = Counter([words[k] for k in np.flatnonzero(codes >= v.n)])
                rows.append((doc_id, codes.tobytes(), list(unknown), list(unknown.values())))
                n += len(words)
                if n >= CODED_TOKENS:
                    yield out(rows)
                    rows, n = [], 0
            yield out(rows)

    return docs.mapInArrow(run, CODED)


def _runs(batches, column, most=STEP_TOKENS):
    """Coded texts of an Arrow column in runs of about ``most`` tokens: a list of (index in batch, codes), with its batch."""
    for batch in batches:
        held, n = [], 0
        for i, codes in enumerate(batch.column(column)):
            codes = np.frombuffer(codes.as_py(), np.int32)
            held.append((i, codes))
            n += len(codes)
            if n >= most:
                yield batch, held
                held, n = [], 0
        if held:
            yield batch, held


def count_words(docs):
    """(word, n) of all tokens of (doc_id, text)."""

    def run(batches):
        counts = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(tokens(text.as_py()))
                if len(counts) > 400_000:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(counts, most=KNOWN_WORDS):
    """(Vocabulary, tokens, distinct words, the rest of counts). The driver sees at most ``most`` words and the sums of classes."""
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    total, distinct = sum(r["n"] for r in levels), sum(r["words"] for r in levels)
    reached, least = 0, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        reached += r["words"]
        if reached > most:
            break
        least = r["level"]
    known = [] if least is None else [(bytes(r["word"]), r["n"]) for r in counts.where(level >= least).collect()]
    known.sort(key=lambda x: (-x[1], x[0]))
    masses = counts.groupBy((F.crc32(F.substring("word", 1, 2)) % OPEN).alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    masses = {r["k"]: [r["n"], r["words"]] for r in masses}
    for word, n in known[:CLASS_WORDS]:
        masses[open_class(word)][0] -= n
        masses[open_class(word)][1] -= 1
    rest = counts if least is None else counts.where(level < least)
    return Vocabulary(known, masses), total, distinct, rest


def train(coded, vocabulary, rounds=ROUNDS):
    """The weights after ``rounds`` rounds over (doc_id, codes).

    In a round each task walks over its texts of one slice of the corpus, from the weights of the round before, and
    hands on how far it moved them; moves are averaged by blocks of weights over the tasks that moved them. Every text
    is in one slice. What tasks hold and hand on is bounded by the number of weights, not by the corpus.
    """
    spark = coded.sparkSession
    weights = np.zeros(sum(SHAPE), np.float32)
    spoken = spark.sparkContext.broadcast(vocabulary.plain())
    part = F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / FOLDS) % rounds

    def average(group):
        moves = np.stack([np.frombuffer(x.as_py(), np.float16) for x in group.column("move")]).astype(np.float32)
        mean = moves.sum(0) / np.maximum(1, (moves != 0).sum(0))
        return pa.table({"block": group.column("block")[:1], "move": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})

    for i in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def walk(batches, shared=shared):
            start = shared.value
            model, seen = Model(Vocabulary.of_plain(*spoken.value), start.copy()), np.zeros(len(start), np.float32)
            for _, held in _runs(batches, 0):
                codes, slots, before = model.lay_out([c for _, c in held])
                for use in np.array_split(np.arange(len(codes)), max(1, len(codes) // STEP_TOKENS)):
                    use = slice(use[0], use[-1] + 1)
                    model.learn(codes[use], [s[use] for s in slots], [b[use] for b in before], seen)
            move = np.clip(model.weights - start, -60000, 60000).astype(np.float16)
            move = np.pad(move, (0, -len(move) % BLOCK)).reshape(-1, BLOCK)
            moved = np.flatnonzero(move.any(1))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(moved, pa.int32()), pa.array([x.tobytes() for x in move[moved]], pa.binary())], names=["block", "move"])

        moves = coded.where(part == i).select("codes").mapInArrow(walk, "block int, move binary")
        weights = np.pad(weights, (0, -len(weights) % BLOCK)).reshape(-1, BLOCK)
        for row in moves.groupBy("block").applyInArrow(average, "block int, move binary").collect():
            weights[row["block"]] += np.frombuffer(row["move"], np.float32)
        weights = weights.ravel()[:sum(SHAPE)].copy()
    return weights


PARTS = "row long, word binary, times long, doc_id long, n_tokens long, n_known long, base double, model double"


def score_parts(coded, vocabulary, weights):
    """Rows PARTS of CODED texts: one per text, under a word of its own, and one per word of it that is not known."""
    spark = coded.sparkSession
    spoken, shared = spark.sparkContext.broadcast(vocabulary.plain()), spark.sparkContext.broadcast(weights)

    def run(batches):
        model, row = Model(Vocabulary.of_plain(*spoken.value), shared.value), TaskContext.get().partitionId() << 33
        v = model.v
        for batch, held in _runs(batches, 1, 4 * STEP_TOKENS):
            codes, slots, before = model.lay_out([c for _, c in held])
            # A very long text goes through the model in pieces too.
            parts = np.concatenate([
                model.log10_parts(codes[a:a + STEP_TOKENS], [s[a:a + STEP_TOKENS] for s in slots], [b[a:a + STEP_TOKENS] for b in before])
                for a in range(0, len(codes), STEP_TOKENS)
            ])
            lengths = np.array([len(c) for _, c in held])
            known = codes < v.n
            sums = [np.add.reduceat(x, np.cumsum(lengths) - lengths) for x in (parts, known.astype(np.int64), np.where(known, v.log_count[codes], 0.0))]
            chosen = pa.array([i for i, _ in held])
            words, times = batch.column(2).take(chosen), batch.column(3).take(chosen)
            n = len(held)
            at = np.arange(row, row + n)
            row += n
            more = np.repeat(at, words.value_lengths().to_numpy(zero_copy_only=False))
            none = lambda kind: pa.nulls(len(more), kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([at, more])), pa.concat_arrays([pa.array([b" %d" % x for x in at.tolist()], pa.binary()), words.flatten().cast(pa.binary())]),
                pa.concat_arrays([pa.array(np.zeros(n, np.int64)), times.flatten().cast(pa.int64())]),
                pa.concat_arrays([batch.column(0).take(chosen), none(pa.int64())]), pa.concat_arrays([pa.array(lengths), none(pa.int64())]),
                pa.concat_arrays([pa.array(sums[1]), none(pa.int64())]), pa.concat_arrays([pa.array(sums[2]), none(pa.float64())]),
                pa.concat_arrays([pa.array(sums[0]), none(pa.float64())]),
            ], names=[x.split()[0] for x in PARTS.split(", ")])

    return coded.mapInArrow(run, PARTS)


def score_documents(docs, folds=FOLDS, rounds=ROUNDS, known=KNOWN_WORDS, id_col="doc_id", text_col="text"):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Learns from documents whose crc32(doc_id) mod ``folds`` is not 0 and scores all of them, log10. A text's tokens are its
    words (split at space and 0x09 to 0x0D, A-Z in lower case) and one end. base_score is that of single words, smoothed by
    SMOOTH. score is that of the model: the class of the next word from the word before it, the one before that, and both as a pair,
    then the word in its class. CLASS_WORDS frequent words have softmax classes of EACH; all others share OPEN classes by
    how they begin, and have their smoothed share of it, so that every word, also an unknown one, has a probability.

    Tasks know the counts of the ``known`` most frequent words; the counts of all others are joined by word. A null
    text counts as empty (one token, the end). A missing id counts as empty text in the fold and is held out. Repeated rows
    are learnt from and scored as often as they come. Other columns are not looked at; an empty table gives no row.
    """
    rows = documents(docs, id_col, text_col)
    learnt = rows.where(~in_fold(F.col("doc_id"), folds))
    vocabulary, total, distinct, rest = vocabulary_of(saved(count_words(learnt), "words"), known)
    coded = saved(code_texts(rows, vocabulary), "codes")
    weights = train(coded.where(~in_fold(F.col("doc_id"), folds)), vocabulary, rounds)
    parts = score_parts(coded, vocabulary, weights)
    unknown = F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)
    sums = parts.join(rest, "word", "left").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), (F.sum("n_known") + F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        F.sum("base").alias("base"), F.sum("model").alias("model"), F.sum(unknown).alias("rest"),
    )
    each = float(np.log10(total + SMOOTH * (distinct + 1)))
    return sums.select(
        "doc_id", in_fold(F.col("doc_id"), folds).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rest") - F.col("n_tokens") * each).alias("base_score"), (F.col("model") + F.col("rest")).alias("score"),
    )
