"""Best-fit packing planned on a histogram of lengths: documents take planned slots by their rank within a length."""

import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import documents, saved

#: Texts with characters beyond these, whose classes no Unicode version changes, are left to the tokenizer as a whole.
PLAIN = "[^\\x00-\\u024f]"
#: So are texts with a run of white space of this length: the faster encoder keeps a place for each of its characters, and fails near a million.
LONG = 100_000
BLANKS = rf"(?<![\s\x85\xa0])[\s\x85\xa0]{{{LONG}}}"
#: How byte-level BPE of this vocabulary family splits text before merging (a fixed value, as published).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local_rank long"


def byte_characters():
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path, special=False):
    """text -> ids as little-endian 32-bit bytes, those of the tokenizer file. Special tokens' strings are ordinary text, unless ``special``.

    A second library merges by the file's own vocabulary, in half the time; texts of rarer scripts, whose classes of
    characters the two might see differently, of very long white space or with a special token go through the file's library.
    """
    import json

    import regex
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    added = {x["content"] for x in vocabulary["added_tokens"]}
    byte_of = byte_characters()
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary["model"]["vocab"].items() if t not in added}
    fast = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    rare, blanks, strings = regex.compile(PLAIN).search, regex.compile(BLANKS).search, sorted(added) if special else []

    def odd(text):
        return rare(text) or len(text) >= LONG and blanks(text) or any(x in text for x in strings)

    def encode(text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids if odd(text) else fast.encode_ordinary(text)
        return np.asarray(ids, "<u4").tobytes()

    return encode


def tokenize(docs, tokenizer, size, end_id=0, special=False):
    """One row per piece: its ids' count and crc32, its input partition and its rank there among pieces of its length."""
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches):
        encode, part, ranks = encoder(tokenizer, special), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    # The first piece takes the rest, so that all others fill a sequence.
                    length = (n % size or size) if not at else size
                    ranks[length] += 1
                    out.append((doc_id, piece, at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), part, ranks[length] - 1))
                    at, piece = at + length, piece + 1
            if out:
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.mapInArrow(cut, PIECES)


def best_fit(counts, size):
    """Plan sequences for ``counts`` (length -> number): rows (length, first rank, number, first sequence, offset).

    Lengths go from the longest to the shortest, each into the fullest sequences that still have room. Sequences of the
    same room form a class, so the work depends on the number of lengths, not of documents.
    """
    rooms, classes, plan, sequences = [], {}, [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                # As many new sequences as are needed, each filled with this length as often as it goes in.
                each = size // length
                full, rest = divmod(left, each)
                for number, times in ((full, each), (1 if rest else 0, rest)):
                    if number:
                        for k in range(times):
                            plan.append((length, rank, number, sequences, k * length))
                            rank += number
                        _add(rooms, classes, size - times * length, sequences, number)
                        sequences += number
                left = 0
            else:
                room = rooms[i]
                first, number = classes[room].pop()
                if not classes[room]:
                    del classes[room], rooms[i]
                take = min(number, left)
                if take < number:
                    _add(rooms, classes, room, first + take, number - take)
                # One sequence of the class may take several of this length.
                times = min(room // length, -(-left // take)) if take == number else 1
                used = 0
                for _ in range(times):
                    now = min(take, left)
                    if now < take:
                        break
                    plan.append((length, rank, take, first, size - room + used))
                    rank, left, used = rank + take, left - take, used + length
                _add(rooms, classes, room - used, first, take)
    return plan


def _add(rooms, classes, room, first, number):
    if room:
        if room not in classes:
            classes[room] = []
            insort(rooms, room)
        classes[room].append((first, number))


def pack_documents(docs, tokenizer, size=2048, id_col="doc_id", text_col="text", special=False):
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    With ``special`` the string of a special token is its id; without, it is text like any other.
    Only documents of more than ``size`` ids are cut. A null or empty text has one piece, its end id alone. Repeated rows
    and rows without an id are packed like any other. Other columns are not looked at; an empty table gives no row.
    The driver sees one count per length and the plan, both bounded by ``size``; a document's rank within its length is
    the count in earlier input partitions plus its rank in its own, so no length, however frequent, meets in one task.
    """
    spark = docs.sparkSession
    pieces = saved(tokenize(documents(docs, id_col, text_col), tokenizer, size, special=special), "pieces")
    counts = saved(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = np.asarray(sorted(best_fit(total, size)), np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["part", "length"]).withColumn("rank", F.col("first") + F.col("local_rank"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    shared = spark.sparkContext.broadcast(plan)

    def take(batches):
        plan = shared.value
        # Length and rank in one number, in the plan's order: ranks of a length are far below 2**48.
        keys = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = plan[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            columns = [batch.column(i) for i in range(5)] + [pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(take, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
