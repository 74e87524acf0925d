"""Near duplicates by an inverted join on the coordinates of min-hash signatures, confirmed on full shingle sets."""

import hashlib
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import SMALL_CHUNK, Rolling, documents, lower, mix, saved, text_chunks, words_of
from .components import components

WORDS = 5
#: Minimum hashes of a signature, coordinates that texts are posted under, and minimum hashes joined in each.
MINIMA, COORDINATES, WIDTH = 128, 64, 8
#: The share of pairs right at the linking similarity that may have too few minimum hashes in common (binomial).
MISSED = 3e-6
#: Classes that a class is compared with before all pairs between components that are still apart; it changes no result.
FIRST_TRIES = 4
SIGNED = "node long, doc_id long, text_hash long, n_shingles long, digest binary, minima array<int>"


def least_common(share):
    """Minimum hashes that a candidate must have in common, of MINIMA, for links at ``share`` percent: 89 at 85, 80 at 80."""
    p, below = share / 100, 0.0
    for k in range(MINIMA + 1):
        below += comb(MINIMA, k) * p ** k * (1 - p) ** (MINIMA - k)
        if below > MISSED:
            return k
    return MINIMA


def width(share):
    """Minimum hashes in a coordinate: WIDTH from 85 on, and fewer below, so that pairs at ``share`` meet as often as at 85."""
    if share >= 85:
        return WIDTH
    return max(1, int(WIDTH * log(0.85) / log(share / 100)))


class Signer:
    """Signatures of texts: the least of their shingles under each of MINIMA permutations."""

    def __init__(self):
        rng = np.random.default_rng(85)
        self.rolling = Rolling(5)
        self.factors = rng.integers(0, 1 << 31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = rng.integers(0, 1 << 32, MINIMA, np.uint32)

    def minima(self, shingles):
        least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(shingles), 256):
            x = shingles[at:at + 256].astype(np.uint32)
            np.minimum(least, (x[:, None] * self.factors + self.shifts).min(0), out=least)
        return least

    def shingles(self, column):
        """For each text: the hashes of its distinct shingles, and its bytes with A-Z in lower case."""
        for _, data, offsets in text_chunks(column, SMALL_CHUNK):
            data = lower(data)
            starts, ends, bounds = words_of(data, offsets)
            hashes = self.rolling.words(data, starts, ends)
            runs = self.rolling.windows(hashes, WORDS)
            raw = data.tobytes()
            for i in range(len(offsets) - 1):
                a, b = bounds[i], bounds[i + 1]
                if b - a >= WORDS:
                    found = np.unique(runs[a:b - WORDS + 1])
                else:
                    found = mix(self.rolling.sums(hashes[a:b])[-1:] + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64)
                yield found, raw[offsets[i]:offsets[i + 1]]

    def batch(self, column):
        """For each text: its number of distinct shingles, the digest of its words, its minimum hashes."""
        counts, digests, minima = [], [], []
        for shingles, raw in self.shingles(column):
            counts.append(len(shingles))
            digests.append(hashlib.blake2b(b" ".join(raw.split()), digest_size=16).digest())
            minima.append(self.minima(shingles))
        return counts, digests, np.concatenate(minima) if minima else np.zeros(0, np.uint32)


def sign(docs):
    """SIGNED rows of (doc_id, text, text_hash): node numbers the row, by input partition and place."""

    def run(batches):
        signer, node = Signer(), TaskContext.get().partitionId() << 33
        for batch in batches:
            counts, digests, values = signer.batch(batch.column(1))
            n = len(counts)
            offsets = pa.array(np.arange(n + 1) * MINIMA, pa.int32())
            columns = [
                pa.array(np.arange(node, node + n)), batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(values.view(np.int32))),
            ]
            node += n
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SIGNED.split(", ")])

    return docs.mapInArrow(run, SIGNED)


def shingle_set(text):
    words = text.encode().lower().split()
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(WORDS))))


def confirm(pairs, texts, share):
    """The (a, b) pairs whose full shingle sets have 100 * intersection >= share * union. texts: (node, text)."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches):
        last, first = None, set()
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(len(a)):
                if a[i] != last:
                    last, first = a[i], shingle_set(batch.column(2)[i].as_py())
                other = shingle_set(batch.column(3)[i].as_py())
                common = len(first & other)
                if common and 100 * common >= share * (len(first) + len(other) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(j).take(pa.array(keep, pa.int64())) for j in (0, 1)], names=["a", "b"])

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.sortWithinPartitions("a").mapInArrow(check, "a long, b long")


def coordinates(minima, size=WIDTH):
    """The values a signature is posted under: each a hash of its number and of ``size`` minimum hashes, fixed by a seed."""
    rng = np.random.default_rng(64)
    chosen = [rng.permutation(MINIMA)[:size].tolist() for _ in range(COORDINATES)]
    return F.array(*[F.xxhash64(F.lit(i), *[F.get(minima, k) for k in places]) for i, places in enumerate(chosen)])


def in_common(a, b):
    """How many minimum hashes two signatures share."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def overlap(share, n_a, n_b):
    """Shingles that two sets of these sizes must have in common, at least, to be linked."""
    return F.ceil(share * (n_a + n_b) / F.lit(100 + share)).cast("long")


def shingles_of(texts):
    """(node, shingle) rows of (node, text): the hashes of each text's distinct shingles."""

    def run(batches):
        signer = Signer()
        for batch in batches:
            sets = [x for x, _ in signer.shingles(batch.column(1))]
            nodes = np.repeat(np.asarray(batch.column(0).to_pylist(), np.int64), [len(x) for x in sets])
            values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(values.view(np.int64))], names=["node", "shingle"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingle long")


def colliding(pairs, signatures, least, share):
    """Pairs (a, b) of sizes that may be linked with at least ``least`` minimum hashes in common. signatures: (node, minima, n)."""
    left, right = (signatures.select(F.col("node").alias(x), F.col("minima").alias(f"m{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    sizes = F.least("na", "nb") >= overlap(share, F.col("na"), F.col("nb"))
    return pairs.join(right, "b").join(left, "a").where(sizes & (in_common(F.col("ma"), F.col("mb")) >= least)).select("a", "b")


def rare_meetings(nodes, held, share):
    """Pairs (a, b) of ``nodes`` (node, component, n) of different components that share a rare shingle: all that may be linked.

    ``held`` has the shingles of every node. A node's shingles are put in order, the rarest among all nodes first. Sets
    with ``overlap`` shingles in common share one among the first n - overlap + 1 of both, so only these are posted; a
    pair meets at a shingle only if it stands that far in front on both sides, by the two sizes. Shingles of one component alone
    are skipped, and each list is joined from the side of the nodes outside its largest component.
    """
    times = held.groupBy("shingle").agg(F.count("*").alias("times"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "shingle"))
    prefix = F.col("n") - overlap(share, F.col("n"), F.ceil(F.col("n") * share / 100)) + 1
    front = held.join(times, "shingle").withColumn("place", place).join(nodes, "node").where((F.col("place") <= prefix) & (F.col("times") > 1))
    front = saved(front.select("shingle", "node", "component", "n", "place"), "front")
    sizes = front.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    mixed = sizes.groupBy("shingle").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.count("*").alias("parts")).where("parts > 1")
    front = front.join(mixed.select("shingle", "largest"), "shingle")
    x, y = (front.select("shingle", "largest", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "place")]) for side in "xy")
    need = overlap(share, F.col("n_x"), F.col("n_y"))
    meet = (x["shingle"] == y["shingle"]) & (F.col("component_x") != F.col("component_y")) & (F.least("n_x", "n_y") >= need)
    meet = meet & (F.col("place_x") <= F.col("n_x") - need + 1) & (F.col("place_y") <= F.col("n_y") - need + 1)
    pairs = x.where("component_x <> largest").join(y.drop("largest"), meet)
    return pairs.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_duplicates(docs, share=85, least=None, id_col="doc_id", text_col="text"):
    """doc_id, n_shingles, component_id, kept and text_hash (xxhash64) of every document.

    Documents are linked if 100 * intersection >= share * union of their sets of five-word shingles (of all words, where
    there are fewer; case of A-Z ignored). component_id is the least id that links lead to.

    Texts of the same words are one class from the start. Classes are posted under each coordinate of their signature with
    its value; lists of one class are skipped. A class is first compared with the most central ones of its lists (those in the
    most and longest lists, such as the text that all others of a group were made from), and links merge components. Classes
    that still stand in a list with another component are then compared with those of other components that they share a
    shingle with among their rarest (rare_meetings: exact, so that nothing of what the lists have brought together is lost); pairs within a
    component are skipped, since they would add nothing. A pair goes on if its sizes allow a link and enough minimum hashes
    agree: at least the match threshold ``least`` (least_common of share). It is then confirmed on the full sets.

    A null or empty text, or one of spaces, has no shingle and stands alone. Rows without an id take part; their
    component_id is the least id of others in it, or null (kept: false, or true if the whole component has no id).
    Repeated rows (an id more than once) each have a row. Other columns are not looked at; an empty table gives no row.
    """
    least = least_common(share) if least is None else least
    rows = documents(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    signed = saved(sign(rows), "signatures")
    classes = saved(
        signed.where("n_shingles > 0").groupBy("digest").agg(
            F.min_by(F.struct("node", "doc_id", "text_hash", "minima", "n_shingles"), "node").alias("row"), F.min("doc_id").alias("doc_id"),
        ).select("digest", "doc_id", "row.node", F.struct("row.doc_id", "row.text_hash").alias("at"), "row.minima", F.col("row.n_shingles").alias("n")), "classes",
    )
    posted = classes.select("node", F.explode(coordinates(F.col("minima"), width(share))).alias("value"))
    lists = posted.groupBy("value").agg(F.min("node").alias("first"), F.max("node").alias("last"), F.count("*").alias("size")).where("first < last")
    listed = saved(posted.join(lists.select("value", "size"), "value"), "postings")
    # Only texts that meet another in a list are needed from here on.
    met = saved(listed.groupBy("node").agg(F.sum("size").alias("met")), "met")
    own = saved(met.join(classes.select("node", "at", "minima", "n"), "node"), "met_classes")
    at = own.select("node", F.col("at.doc_id").alias("own_id"), F.col("at.text_hash").alias("own_hash"))
    found = rows.join(at, (F.col("text_hash") == F.col("own_hash")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    texts = saved(found.select("node", "text").dropDuplicates(["node"]), "met_texts")

    # One link is enough to join a group, so each class meets a few of its lists' centers (it has COORDINATES lists at most).
    listed = saved(listed.join(met, "node").select("value", "node", F.struct("met", (-F.col("node")).alias("minus")).alias("rank")), "ranked")
    centers = listed.groupBy("value").agg(F.max("rank").alias("center"))
    toward = listed.join(centers, "value").where("center > rank").select("node", "center").distinct()
    few = F.slice(F.sort_array(F.collect_set("center"), asc=False), 1, FIRST_TRIES)
    pivots = toward.groupBy("node").agg(F.transform(few, lambda x: -x["minus"]).alias("centers")).select("node", F.explode("centers").alias("center"))
    pivots = saved(pivots.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct(), "tried")
    signatures = own.select("node", "minima", "n")
    links = saved(confirm(colliding(pivots, signatures, least, share), texts, share), "links")

    # What still stands in one list with another component meets by rare shingles.
    apart = saved(_mixed(listed, components(links)).join(own.select("node", "n"), "node"), "apart")
    held = saved(shingles_of(texts.join(apart.select("node"), "node", "left_semi")), "shingles")
    rest = rare_meetings(apart, held, share).join(pivots, ["a", "b"], "left_anti")
    rest = colliding(rest, signatures, least, share)
    links = links.union(saved(confirm(rest, texts, share), "links"))
    parts = saved(components(links), "components")

    linked = classes.select("digest", "node", "doc_id").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    linked = saved(linked.select("digest", "component", "doc_id"), "linked")
    names = linked.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    home = linked.select("digest", "component").join(names, "component").select("digest", "component_id", F.lit(True).alias("known"))
    # The digest of no words would be one key for all rows without any; their own id stands for it.
    own_key = F.when(F.col("n_shingles") > 0, F.col("digest"))
    out = signed.select("doc_id", "n_shingles", "text_hash", own_key.alias("digest")).join(home, "digest", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash",
    )


def _mixed(listed, parts):
    """(node, component) of the classes that stand in a list with a class of another component."""
    named = listed.join(parts, "node", "left").select("value", "node", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return named.join(mixed.select("value"), "value", "left_semi").select("node", "component").distinct()
