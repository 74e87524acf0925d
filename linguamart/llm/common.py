"""Helpers of this folder: shared tables, rows of documents, words and hashes of whole Arrow batches."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of text that are hashed at a time; a longer text is hashed alone.
CHUNK_BYTES = 1 << 21
#: The same where many values are made of each word.
SMALL_CHUNK = 1 << 19
#: Bytes whose words are hashed at a time; they take 30 times as much memory meanwhile.
BLOCK_BYTES = 1 << 18


def saved(df, label="llm"):
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back: its lineage ends there."""
    return df.sparkSession.read.schema(df.schema).parquet(stage(df, label))


def documents(docs, id_col="doc_id", text_col="text"):
    """The id as a long and the text (null: empty), and nothing else, whatever other columns there are."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def in_fold(doc_id, folds):
    """True for rows whose crc32 of the id's text leaves no remainder; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def schema_of(plain, extra=()):
    """Columns given as "name type, ..." and then fields of another schema."""
    fields = [x.split() for x in plain.split(", ")]
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in fields] + list(extra))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_chunks(column, most=CHUNK_BYTES):
    """(first row, bytes, offsets) of runs of texts of an Arrow string column, without copying them."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, n)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def slices(batch, text=0, most=SMALL_CHUNK):
    """``batch`` in slices of about ``most`` bytes of its column ``text``, without copying: what is made of one is handed on before the next."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(sizes) - sizes
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(before, before[first] + most)))
        yield batch.slice(first, last - first)
        first = last


def lower(data):
    """A-Z in lower case; no other byte changes."""
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + np.uint8(32), data)


def words_of(data, offsets, inside=None):
    """Start and end byte of every word, and for each text the place of its first word (one more at the end).

    ``inside`` marks the bytes that words are made of: all but white space, if not given.
    """
    inside = ~SPACES[data] if inside is None else inside
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x):
    """Spread the bits of 64-bit values (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of runs of a sequence by prefix sums modulo 2**64, times powers of an odd base."""

    def __init__(self, seed):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(rng.integers(0, 1 << 62)) * 4 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n):
        while len(self.powers) < n:
            have = len(self.powers)
            self.powers = np.concatenate([self.powers, self.powers * np.uint64(pow(self.base, have, 1 << 64))])
            self.inverses = np.concatenate([self.inverses, self.inverses * np.uint64(pow(self.inverse, have, 1 << 64))])

    def sums(self, x):
        self._reach(len(x) + 1)
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(x * self.powers[:len(x)], out=total[1:])
        return total

    def runs(self, sums, starts, ends):
        return (sums[ends] - sums[starts]) * self.inverses[starts]

    def words(self, data, starts, ends):
        """A hash of each word's bytes, whatever their place: words, in order, are taken by blocks of BLOCK_BYTES."""
        out, first = np.empty(len(starts), np.uint64), 0
        while first < len(starts):
            at = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, at + BLOCK_BYTES, "right")))
            a, b = starts[first:last], ends[first:last]
            out[first:last] = mix(self.runs(self.sums(self.values[data[at:b[-1]]]), a - at, b - at) + (b - a).astype(np.uint64))
            first = last
        return out

    def windows(self, hashes, size):
        """A hash of each ``size`` hashes in a row; windows over the border of two texts are the caller's to leave out."""
        if len(hashes) < size:
            return np.zeros(0, np.uint64)
        at = np.arange(len(hashes) - size + 1)
        return mix(self.runs(self.sums(hashes), at, at + size))


def signed(x):
    return x.view(np.int64)
