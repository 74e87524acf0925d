"""Removal of repeated passages: a count-min sketch first, then exact groups of the windows it may count twice."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import SMALL_CHUNK, Rolling, documents, mix, schema_of, signed, slices, text_chunks, words_of

WINDOW = 35
#: Words of an anchor, the least of its window by hash.
ANCHOR = 16
#: Counters per row of the sketch, and its rows. More counters cost memory, fewer let more windows into the second pass.
CELLS, DEPTH = 1 << 26, 2
#: Values that a task holds before it hands them on.
HELD = 1 << 21
#: Rows that are handed on at a time: what a batch of them takes, Python and the JVM each have several times.
ROWS = 1 << 16


class Held:
    """Columns of at most ``most`` values that a task gathers; memory is taken as they fill, and once."""

    def __init__(self, most, *kinds):
        self.most, self.n, self.rooms = most, 0, [np.empty(most, kind) for kind in kinds]

    def add(self, *columns):
        """Takes the columns by and by; yields whenever it is full, and is empty from then on."""
        at, end = 0, len(columns[0])
        while at < end:
            n = min(end - at, self.most - self.n)
            for room, column in zip(self.rooms, columns):
                room[self.n:self.n + n] = column[at:at + n]
            self.n, at = self.n + n, at + n
            if self.n == self.most:
                yield self.columns()
                self.n = 0

    def columns(self):
        return [room[:self.n] for room in self.rooms]


class Windows:
    """Windows of whole batches of texts: their hashes, and the anchors that stand for them in the sketch."""

    def __init__(self, size):
        self.size, self.anchor = size, min(ANCHOR, size)
        self.first, self.second = Rolling(35), Rolling(71)

    def of(self, data, offsets):
        """(hashes of words, starts of windows, place of each window's anchor, hashes of anchors, bounds of texts, words)."""
        starts, ends, bounds = words_of(data, offsets)
        hashes = self.first.words(data, starts, ends)
        anchors = self.first.windows(hashes, self.anchor)
        counts = np.diff(bounds)
        text = np.repeat(np.arange(len(counts)), counts)
        n = len(hashes) - self.size + 1
        if n <= 0:
            return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64), anchors, bounds, (starts, ends)
        at = np.flatnonzero(text[:n] == text[self.size - 1:])
        # The first least anchor of each window, by doubling; its offset depends on the window's words alone.
        width, least = 1, np.arange(len(anchors))
        span = self.size - self.anchor + 1
        while width < span:
            step = min(width, span - width)
            a, b = least[:len(least) - step], least[step:]
            least, width = np.where(anchors[b] < anchors[a], b, a), width + step
        return hashes, at, least[at], anchors, bounds, (starts, ends)


def cells_of(anchors, cells):
    """The cell of each anchor in each row of the sketch."""
    half = np.uint64(32)
    return [(anchors * np.uint64(2 * r + 1) + (anchors >> half)) % np.uint64(cells) + np.uint64(r * cells) for r in range(DEPTH)]


def sketch(docs, size, cells):
    """(cell, n): each input partition's sketch, as its cells that are not 0."""

    def run(batches):
        windows, held = Windows(size), Held(2 * HELD, np.uint32)

        def out(found):
            found.sort()
            new = np.ones(len(found), bool)
            new[1:] = found[1:] != found[:-1]
            heads = np.flatnonzero(new)
            for at in range(0, len(heads), ROWS):
                part = heads[at:at + ROWS + 1]
                counts = np.diff(part if len(part) > ROWS else np.append(part, len(found))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(found[part[:ROWS]].astype(np.int64)), pa.array(counts)], names=["cell", "n"])

        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0), SMALL_CHUNK):
                _, _, places, anchors, _, _ = windows.of(data, offsets)
                places = places[np.append(True, places[1:] != places[:-1])] if len(places) else places
                for values in cells_of(anchors[places], cells):
                    for full, in held.add(values):
                        yield from out(full)
        if held.n:
            yield from out(*held.columns())

    return docs.select("text").mapInArrow(run, "cell long, n int")


def repeated_cells(docs, size, cells):
    """The merged sketch, as one bit per cell: set where it counts two or more. Its size is fixed by ``cells``."""
    merged = sketch(docs, size, cells).groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1")
    block = F.shiftright("cell", 16)

    def run(batches):
        for batch in batches:
            found = []
            for cells_in in batch.column(1):
                bits = np.zeros(1 << 16, np.uint8)
                bits[cells_in.values.to_numpy()] = 1
                found.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["block", "bits"])

    blocks = merged.groupBy(block.alias("block")).agg(F.collect_list(F.pmod("cell", F.lit(1 << 16)).cast("int")).alias("cells"))
    bits = np.zeros((-(-cells * DEPTH // (1 << 16)), (1 << 16) // 8), np.uint8)
    for row in blocks.mapInArrow(run, "block long, bits binary").collect():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.ravel()


FOUND = "h1 long, h2 int, text_hash long, place long, n int"


def candidates(docs, bits, size, cells):
    """Windows that the sketch may count twice, as rows FOUND. ``place`` is the text's number of words << 32 plus a start.

    n = 1: a window at a place. Windows that a task itself finds twice need no one else's answer: they leave as runs of
    neighbouring starts (n = 1 + their number, under a hash of their own), and once without a place (n = 2) for others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def rows(h1, *columns):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (signed(h1), *columns)], names=[x.split()[0] for x in FOUND.split(", ")])

    def run(batches):
        bits, windows = shared.value, Windows(size)
        held = Held(HELD, np.int64, np.int64, np.uint64, np.int32)

        def out(texts, places, h1, h2):
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            heads = np.flatnonzero(new)
            times = np.diff(np.append(heads, len(a)))
            single, several = order[heads[times == 1]], heads[times > 1]
            for at in range(0, len(single), ROWS):
                i = single[at:at + ROWS]
                yield rows(h1[i], h2[i], texts[i], places[i], np.ones(len(i), np.int32))
            del single
            for at in range(0, len(several), ROWS):
                i = several[at:at + ROWS]
                yield rows(a[i], b[i], pa.nulls(len(i), pa.int64()), pa.nulls(len(i), pa.int64()), np.full(len(i), 2, np.int32))
            del a, b, several
            # Equal texts have equal places, of which one is enough; neighbours become one run.
            twice = order[np.repeat(times > 1, times)]
            twice = twice[np.lexsort((places[twice], texts[twice]))]
            t, s = texts[twice], places[twice]
            new = np.ones(len(s), bool)
            new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
            t, s = t[new], s[new]
            new = np.ones(len(s), bool)
            new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1] + 1)
            first = np.flatnonzero(new)
            length = np.diff(np.append(first, len(s)))
            for at in range(0, len(first), ROWS):
                i = first[at:at + ROWS]
                own = mix(t[i].view(np.uint64) + s[i].view(np.uint64))
                yield rows(own, np.arange(at, at + len(i), dtype=np.int32), t[i], s[i], (1 + length[at:at + ROWS]).astype(np.int32))

        for batch in batches:
            texts = batch.column(1).to_numpy()
            for row, data, offsets in text_chunks(batch.column(0), SMALL_CHUNK):
                hashes, at, places, anchors, bounds, (starts, ends) = windows.of(data, offsets)
                maybe = np.ones(len(anchors), bool)
                for cell in cells_of(anchors, cells):
                    maybe &= (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)) & 1) > 0
                at = at[maybe[places]]
                if not len(at):
                    continue
                text = np.searchsorted(bounds, at, "right") - 1
                sums = windows.first.sums(hashes)
                h1 = windows.first.runs(sums, at, at + size)
                sums = windows.second.sums(windows.second.words(data, starts, ends))
                h2 = (windows.second.runs(sums, at, at + size) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                for full in held.add(texts[row + text], (np.diff(bounds)[text] << 32) + at - bounds[text], h1, h2):
                    yield from out(*full)
        if held.n:
            yield from out(*held.columns())

    return docs.select("text", "text_hash").mapInArrow(run, FOUND)


def repeated_runs(docs, size=WINDOW, cells=CELLS):
    """(r_hash, found): where repeated windows start in the text of that hash, as array<struct<n_words, start, run>>."""
    found = candidates(docs, repeated_cells(docs, size, cells), size, cells)
    times = F.sum("n").over(Window.partitionBy("h1", "h2"))
    marks = found.withColumn("times", times).where("times > 1 and place is not null").select(
        F.col("text_hash").alias("r_hash"),
        F.struct(
            F.shiftright("place", 32).alias("n_words"), F.pmod("place", F.lit(1 << 32)).alias("start"),
            F.greatest(F.col("n") - 1, F.lit(1)).cast("long").alias("run"),
        ).alias("at"),
    )
    # As a set: what copies of a text in many tasks have found alike counts once, before it moves and after.
    return marks.groupBy("r_hash").agg(F.collect_set("at").alias("found"))


def remove_repeats(docs, size=WINDOW, cells=CELLS, id_col="doc_id", text_col="text", keep=(), as_is=False):
    """doc_id, n_words, n_removed, kept_text and the columns of ``keep`` (as one struct, ``row``) of every document.

    ``as_is``: the kept_text of a document that loses nothing is its text as it is, null if that is; so ``keep`` need not
    have the text, which moves once.

    A window is ``size`` words in a row of one document (split at space and 0x09 to 0x0D, unchanged). Every word under a
    window whose words also start anywhere else, in the same document too, goes; windows are judged on the input.

    First pass: each window is represented by its anchor, the least of its ANCHOR-word runs by hash. Equal windows have
    equal anchors at different places, so a window cannot occur more often than its anchor, nor that more often than
    the merged count-min sketch of all partitions says. The sketch's size is fixed by ``cells``; with much more input
    than cells it lets more windows pass, never fewer. Second pass: windows it may count twice are grouped exactly, on
    96 bits of two independent hashes. A task sends one row per window it holds, so a passage of all documents makes no
    larger group than there are tasks. What goes is the same for equal texts, so it is told by text, not by id.

    A null text has no word (kept_text is then empty, as for texts of spaces). Documents below ``size`` words lose
    nothing. Repeated rows, with the same id and text, are copies of each other: from ``size`` words on they lose all.
    Rows without an id are handled like any other. An empty table gives no row.
    """
    rows = documents(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    runs = repeated_runs(rows, size, cells)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    whole = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.xxhash64(text).alias("text_hash"),
        *([F.struct(*keep).alias("row")] if keep else []),
    )
    joined = whole.join(runs, F.col("text_hash") == F.col("r_hash"), "left")
    out = [f for f in whole.schema.fields if f.name == "row"]
    columns = ["doc_id", "text", "found", *(f.name for f in out)]
    schema = schema_of("doc_id long, n_words long, n_removed long, kept_text string", out)

    def cut(batches):
        for batch in (part for whole in batches for part in slices(whole, 1)):
            words, removed, texts = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2)):
                tokens = (text or "").encode().split()
                covered = np.zeros(len(tokens) + 1, np.int64)
                if found.is_valid:
                    n_words, start, run = (x.to_numpy() for x in found.values.flatten())
                    own = n_words == len(tokens)
                    np.add.at(covered, start[own], 1)
                    np.subtract.at(covered, (start + run)[own] + size - 1, 1)
                gone = np.cumsum(covered)[:-1] > 0
                words.append(len(tokens))
                removed.append(int(gone.sum()))
                if as_is and not removed[-1]:
                    texts.append(text)
                else:
                    texts.append(b" ".join([x for x, g in zip(tokens, gone.tolist()) if not g] if removed[-1] else tokens).decode())
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [batch.column(3 + i) for i in range(len(out))], names=["doc_id", "n_words", "n_removed", "kept_text"] + [f.name for f in out])

    return joined.select(*columns).mapInArrow(cut, schema)


def digest(kept_text):
    return F.sha2(kept_text, 256)
