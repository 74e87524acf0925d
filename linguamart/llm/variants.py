"""Spelling variants: words one edit apart, found by scans of sorted lists that carry banded edit-matrix rows along."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import drop_stage, stage
from .common import saved

#: The characters that words are made of, and the share of words that loses one: those whose crc32 this number divides.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
ABC, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EVERY = 31
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
#: Words of a list that are looked for in one scan of it; a longer list is scanned by several tasks, for a part each.
BLOCK = 20_000
FAR = 2


def count_words(docs, every=EVERY, least_length=LEAST_LENGTH, least_count=LEAST_COUNT, id_col="doc_id", text_col="text"):
    """(word, n) of all words of ``docs`` with at least ``least_length`` characters and ``least_count`` occurrences.

    A run of letters is lower-cased (A-Z only). With h the crc32 of "<id>:<run>", one run in ``every``, by h, loses its
    character h mod length. Without an id nothing stands before the colon. Counts are summed up before they move.
    """
    text = F.translate(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), ABC, LOWER)
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(own.alias("own"), F.explode(runs).alias("run")).withColumn("h", F.crc32(F.concat("own", F.lit(":"), "run")))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    counts = rows.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def halves(words):
    """``words`` (word, n) under every key that a word one edit away may share: key, depth, shorter, side, form, n.

    Of two words one edit apart, the shorter of ``shorter`` characters, either the first shorter / 2 are the same, or
    the last shorter - shorter / 2. So each word stands in four lists: as one of the shorter and as the longer one, by its
    beginning and by its end. ``form`` is the word, spelled backwards in lists by the end, so that the words of every
    list share their first ``depth`` characters.
    """
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("shorter"))
    half = F.floor(F.col("shorter") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("form"), half.alias("depth")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("form"), (F.col("shorter") - half).alias("depth")),
    )
    rows = rows.select("n", "shorter", F.inline(sides))
    key = F.concat_ws(":", "side", "shorter", F.substring("form", F.lit(1), F.col("depth")))
    return rows.select(key.alias("key"), "depth", "shorter", "side", "form", "n")


def scan(words, lists, depths, asked):
    """(place of the list word, place of the asked word) of all pairs of one list that are one edit apart.

    ``words`` are Latin-1 bytes, list by list (``lists``: the number of each word's list, rising), in sorted order within a list, whose
    words share their first ``depths`` characters. All lists are read together, a character further at each step. A
    run of neighbours that share that many characters (their longest common prefixes tell) has one row of the edit matrix against
    each asked word of its list: the three cells around the diagonal, worked out once for all words of the run. Where all three are
    over one edit, the run is passed over for that asked word, with all words in it.
    """
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    width = int(lengths.max(initial=0)) + 3
    table = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
    # Characters that a word shares with the one before it; -1 at the first word of a list.
    shared = np.full(n, -1, np.int64)
    shared[1:] = np.where(lists[1:] == lists[:-1], np.argmin(np.c_[table[1:] == table[:-1], np.zeros(max(0, n - 1), bool)], axis=1), -1)
    firsts = np.flatnonzero(shared < 0)
    ends = np.r_[firsts[1:], n]
    found = []
    # Runs at hand (first word, end) and, for each run and asked word near to it, the cells of prefixes one shorter, as long, one longer.
    starts, stops, run = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    who, left, mid, right = np.zeros(0, np.int64), *(np.zeros(0, np.int8),) * 3
    of_list = np.repeat(np.arange(len(firsts)), ends - firsts)
    for depth in range(int(depths[firsts].min(initial=width)), width - 1):
        # Lists whose common beginning ends here come in: every asked word is as far as it.
        new = np.flatnonzero(depths[firsts] == depth)
        if len(new):
            place = np.full(len(firsts), -1, np.int64)
            place[new] = len(starts) + np.arange(len(new))
            own = np.flatnonzero(asked & (place[of_list] >= 0))
            starts, stops = np.r_[starts, firsts[new]], np.r_[stops, ends[new]]
            run, who = np.r_[run, place[of_list[own]]], np.r_[who, own]
            one = np.ones(len(own), np.int8)
            left, mid, right = np.r_[left, one], np.r_[mid, one - one], np.r_[right, one]
        if not len(who):
            if not (depths[firsts] > depth).any():
                break
            continue
        # A run begins with the word that ends here, if there is one.
        whole = lengths[starts] == depth
        apart = lengths[who] - depth
        cell = np.where(apart == 0, mid, np.where(apart == 1, right, np.where(apart == -1, left, FAR)))
        hit = np.flatnonzero(whole[run] & (cell == 1))
        found.append((starts[run[hit]], who[hit]))
        starts = starts + whole
        # The runs that share one character more.
        cuts = np.flatnonzero(shared == depth)
        low, high = np.searchsorted(cuts, starts, "right"), np.searchsorted(cuts, stops)
        some = starts < stops
        parts = np.where(some, np.maximum(high - low, 0) + 1, 0)
        first = np.r_[0, np.cumsum(parts)]
        rank = np.arange(first[-1]) - np.repeat(first[:-1], parts)
        parent = np.repeat(np.arange(len(starts)), parts)
        begin = np.where(rank == 0, starts[parent], cuts[np.clip(low[parent] + rank - 1, 0, max(0, len(cuts) - 1))] if len(cuts) else starts[parent])
        last = np.r_[begin[1:], 0] if len(begin) else begin
        finish = np.where(rank == parts[parent] - 1, stops[parent], last)
        # Every asked word with every run that its run falls into.
        times = parts[run]
        at = np.repeat(np.arange(len(run)), times)
        step = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        child = first[run[at]] + step
        who, left, mid, right = who[at], left[at], mid[at], right[at]
        c = table[begin[child], depth]
        new_left = np.minimum(left + (table[who, depth - 1] != c), mid + 1) if depth else mid + np.int8(1)
        new_mid = np.minimum(np.minimum(mid + (table[who, depth] != c), right + 1), new_left + 1)
        new_right = np.minimum(right + (table[who, depth + 1] != c), new_mid + 1)
        near = np.flatnonzero(np.minimum(np.minimum(new_left, new_mid), new_right) < FAR)
        child, who = child[near], who[near]
        left, mid, right = (x[near].astype(np.int8) for x in (new_left, new_mid, new_right))
        used = np.zeros(len(begin), bool)
        used[child] = True
        number = np.cumsum(used) - 1
        starts, stops, run = begin[used], finish[used], number[child]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _best(forms, counts, lists, depths, shorter, side, asked):
    """(word, near words, least negative count, near word of it) of each asked word that has a near word in its list."""
    other, who = scan(forms, lists, depths, asked)
    sizes = np.fromiter(map(len, forms), np.int64, len(forms))
    # Each pair of lengths has its own list; of a list for (n, n + 1) that are pairs of equal length are those of n.
    keep = np.minimum(sizes[other], sizes[who]) == shorter[who]
    other, who = other[keep], who[keep]
    # Words that share their beginning as well have met there.
    half = shorter // 2
    behind = np.flatnonzero(side[who] == 1)
    twice = np.asarray([forms[a][:-half[b] - 1:-1] == forms[b][:-half[b] - 1:-1] for a, b in zip(other[behind].tolist(), who[behind].tolist())], bool)
    keep = np.ones(len(who), bool)
    keep[behind[twice] if len(behind) else behind] = False
    other, who = other[keep], who[keep]
    if not len(who):
        return []

    def word(k):
        return (forms[k][::-1] if side[k] else forms[k]).decode("latin-1")

    # The words of a list by their characters, so that the first of the most frequent is the least.
    order = np.lexsort((-counts[other], who))
    other, who = other[order], who[order]
    first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
    ends = np.r_[first[1:], len(who)]
    out = []
    for a, b in zip(first.tolist(), ends.tolist()):
        most = counts[other[a]]
        top = a + int(np.searchsorted(-counts[other[a:b]], -most, "right")) if b - a > 1 else b
        out.append((word(who[a]), b - a, int(-most), min(map(word, other[a:top]))))
    return out


def near_words(words, block=BLOCK):
    """(word, n_near, minus_n, near) of every word that has a word one edit away: how many, and the most frequent (ties: the least).

    Lists of one key are sorted within a task and scanned there, many short ones at a time. A list of more than ``block``
    words is dealt to several tasks, each of which looks for its part of them in the whole list.
    """
    spark = words.sparkSession
    listed = saved(halves(words), "lists")
    shorter = F.bool_or(F.length("form") == F.col("shorter")).alias("some")
    sizes = listed.groupBy("key").agg(F.count("*").alias("size"), shorter).where("size > 1 and some")
    parts = F.ceil(F.col("size") / block).cast("int")
    lists = listed.join(sizes.select("key", parts.alias("parts")), "key")
    lists = lists.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    own = F.pmod(F.xxhash64("form"), F.col("parts")) == F.col("part")
    lists = lists.select("key", "part", "form", "n", "depth", "shorter", "side", own.alias("own"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Sorted by their UTF-8 bytes, as Spark does, words stand in the order of their characters.
    lists = lists.repartition(n, "key", "part").sortWithinPartitions("key", "part", "form")

    def run(batches):
        held, size, last = [], 0, None

        def done(rows):
            if not rows:
                return []
            names, forms, counts, depths, shorter, side, asked = (sum((x[j] for x in rows), []) for j in range(7))
            number = np.cumsum(np.r_[False, [a != b for a, b in zip(names[1:], names)]])
            arrays = [np.asarray(x, np.int64) for x in (counts, depths, shorter, side)]
            return _best([f.encode("latin-1") for f in forms], arrays[0], number, *arrays[1:], np.asarray(asked, bool))

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(8)]
            columns = [list(zip(columns[0], columns[1])), *columns[2:]]
            names, at = columns[0], 0
            # A chunk ends with a list.
            while at < len(names):
                if size >= block and names[at] != last:
                    yield _frame(done(held))
                    held, size = [], 0
                end = min(len(names), at + max(1, block - size))
                while end < len(names) and size + end - at >= block and names[end] == names[end - 1]:
                    end += 1
                held.append([c[at:end] for c in columns])
                size, last, at = size + end - at, names[end - 1], end
        yield _frame(done(held))

    found = lists.mapInArrow(run, "word string, n_near long, minus_n long, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "near")).alias("best")).select("word", "n_near", "best.minus_n", "best.near")


def _frame(rows):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], k) for j, k in enumerate(kinds)], names=["word", "n_near", "minus_n", "near"])


def roots(links):
    """(word, root) of (word, form) links that never lead back: where the forms end. Each round doubles the steps."""
    spark = links.sparkSession
    path = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        now = spark.read.schema("word string, root string").parquet(path)
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(further, "root", "left_semi").limit(1).count():
            return now
        last, path = path, stage(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        drop_stage(spark, last)


def spelling_groups(docs, times=TIMES, block=BLOCK, **options):
    """word, form, root, n, n_near, form_n of every counted word of ``docs``.

    The form is the most frequent word one edit away (ties: the least by characters), if it occurs at least ``times`` as
    often; the root is where forms lead to. Since a form is more frequent than its word, forms never lead in a circle.
    A null text has no word; repeated rows count again; columns besides id and text are not looked at; an empty table
    gives no row.
    """
    words = saved(count_words(docs, **options), "words")
    near = saved(near_words(words, block), "near")
    joined = words.join(near, "word", "left")
    is_form = -F.col("minus_n") >= times * F.col("n")
    rows = saved(joined.select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, -F.col("minus_n")).alias("form_n"),
    ), "forms")
    found = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
