"""N-gram Jaccard join by MinHash banding.

Documents are compared by their sets of ``N`` consecutive words (hashed; a
shorter text is one n-gram).  Texts with equal sets form a class, found by a
partial aggregate, and only classes are joined:

1. Every class gets BANDS band hashes of ROWS minima each; the number of bands
   follows from the target recall at the threshold.
2. Classes that meet in a band bucket belong together with the bucket's
   smallest class.  A class is linked to the least of its buckets' smallest
   classes, and so are the others of them (one link each, not all pairs);
   connected links form a candidate cluster, which holds every pair that
   shares a band.
3. Candidates are verified on the full n-gram sets, in groups: a cluster of up
   to ``BLOCK`` classes is one; a larger one is either one group as well or,
   if that is less pair work, as many groups as it has band buckets (texts
   chained by common passages), where a pair counts in the first band that it
   shares.  A group is cut into blocks, and each pair of blocks is a unit of
   its own, so no task holds a whole large group; per unit the intersections
   of its pairs are counted by matrix products over shared n-grams, and only
   each class's number of links and its unit's connected part come out.  Work
   is quadratic only where classes do share bands with each other.
4. Parts are connected over units to groups.

No pair is capped or sampled.  Nothing but counts reaches the driver.

Null, empty and wordless texts have no n-grams: each is a class and a group of
its own without links.  Repeated rows are copies like any other.  Documents
with a null id are joined as well; a group's id is its smallest non-null
document id.  Of rows that agree in id and text but not in other columns,
``keep_one`` keeps the one with the smallest hash.  Extra columns may have any
name.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import WordHash, mix, slices, small, word_spans

N = 5
THRESHOLD = 0.8
ROWS = 5
RECALL = 0.99999
BLOCK = 256
UNIT_ROWS = 512


def bands(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands needed so that a pair at the threshold shares one of them with
    probability ``recall``: 1 - (1 - t**rows)**bands >= recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def ngrams(raw: np.ndarray, off: np.ndarray, hasher: WordHash, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each document of a slice, and where
    each document's begin."""
    low, starts, ends, first = word_spans(raw, off)
    h, sizes = hasher(low, starts, ends), np.diff(first)
    factor = np.uint64(0x9E3779B97F4A7C15)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    # Positions that begin an n-gram: all but a document's last n - 1, or the
    # first word of a short document.
    place = np.arange(len(h)) - first[doc]
    begin = np.flatnonzero((place + n <= sizes[doc]) | ((place == 0) & (sizes[doc] < n)))
    width = np.minimum(sizes[doc[begin]], n)
    grams = np.zeros(len(begin), np.uint64)
    for j in range(n):
        has = j < width
        at = np.where(has, begin + j, 0)
        grams = np.where(has, mix(grams * factor + (h[at] if len(h) else h)), grams)
    owner = doc[begin]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[keep], owner[keep]
    return grams, np.searchsorted(owner, np.arange(len(sizes) + 1))


def sketch(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, k, h, cls, bands) per row: keys of the row, digest of the
    n-gram set (null without n-grams) and band hashes."""
    count = bands(threshold)
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        hasher = WordHash()
        seeds = mix(np.arange(1, 2 * count * ROWS + 1, dtype=np.uint64)).reshape(2, -1)
        odd = seeds[0] | np.uint64(1)
        for batch in batches:
            for rows, raw, off in slices(batch):
                grams, at = ngrams(raw, off, hasher, n)
                has = np.flatnonzero(np.diff(at))
                out = np.zeros((len(has), count), np.uint64)
                for b in range(count):
                    for r in range(b * ROWS, (b + 1) * ROWS):
                        low = np.minimum.reduceat(grams * odd[r] + seeds[1, r], at[has]) if len(has) else grams
                        out[:, b] = mix(out[:, b] * np.uint64(0x9E3779B97F4A7C15) + low)
                    out[:, b] = mix(out[:, b] + np.uint64(b))
                cls: list = [None] * len(rows)
                for d in has:
                    cls[d] = hashlib.blake2b(grams[at[d]:at[d + 1]].tobytes(), digest_size=16).digest()
                edge = np.zeros(len(rows) + 1, np.int32)
                edge[1:][has] = count
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(edge), pa.int32()), pa.array(out.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(cls, pa.binary()), lists], names=["doc_id", "k", "h", "cls", "bands"])

    return keys(docs).mapInArrow(run, f"doc_id {doc_id}, k bigint, h bigint, cls binary, bands array<bigint>")


def keys(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, k, h, text): rows that agree in k and h have the same text."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k"), F.xxhash64("text").alias("h"), "text", *more)


def connect(edges: DataFrame, limit: int = 100) -> DataFrame:
    """(node, root): the smallest node of every connected part of undirected
    ``edges`` (a, b).  Smallest-neighbour steps with pointer jumping, each
    round written out; the rounds needed grow with the log of the diameter."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    for _ in range(limit):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("near")))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("before"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = materialize(step.join(jump, "root").select("node", "before", F.least("root", "next").alias("root")))
        labels = new.select("node", "root")
        if new.filter("root < before").isEmpty():
            return labels
    raise RuntimeError("parts are not connected after the limit of rounds")


def part_links(grams: list[np.ndarray], left: int, sizes: np.ndarray, threshold: float, earlier: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of one unit: among the first ``left`` sets and the others, or
    among all of them if there are no others.  Returns per set the size of the
    linked sets, and the smallest set of its connected part.  Pairs that agree
    in a column of ``earlier`` are counted elsewhere."""
    n, lens = len(grams), np.array([len(g) for g in grams], np.int64)
    flat, owner = np.concatenate(grams), np.repeat(np.arange(n), lens)
    value, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    owner, column = owner[keep], number[at[keep]]
    rows, cols = (left, n - left) if left < n else (n, n)
    lo = left if left < n else 0
    both = np.zeros((rows, cols), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total, step = int(shared.sum()), 8192
    for a in range(0, total, step):
        i, j = np.searchsorted(column, [a, min(a + step, total)])
        dense = np.zeros((n, min(a + step, total) - a), np.float32)
        dense[owner[i:j], column[i:j] - a] = 1
        both += dense[:rows] @ dense[lo:].T
    either = lens[:rows, None] + lens[None, lo:] - both
    linked = both >= threshold * either - 1e-6
    if lo == 0:
        np.fill_diagonal(linked, False)
    if earlier is not None and earlier.shape[1]:
        i, j = np.nonzero(linked)
        for a in range(0, len(i), 1 << 16):
            x, y = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
            linked[x, y] = (earlier[x] != earlier[lo + y]).all(1)
    amount = np.zeros(n, np.int64)
    amount[:rows] += linked @ sizes[lo:]
    if lo:
        amount[lo:] += linked.T @ sizes[:rows]
    root = np.arange(n)
    while True:
        new = root.copy()
        x = np.where(linked, root[None, lo:], n).min(1, initial=n)
        new[:rows] = np.minimum(new[:rows], x)
        y = np.where(linked, new[:rows, None], n).min(0, initial=n)
        new[lo:] = np.minimum(new[lo:], y)
        if (new == root).all():
            return amount, root
        root = new


def verify(members: DataFrame, units: int, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """(c, amount, root) per class and unit of ``members`` (bin, b, cluster, p,
    q, side, c, size, earlier, text)."""

    def run(table: pa.Table) -> pa.Table:
        hasher, out = WordHash(), [[], [], []]
        table = table.combine_chunks().sort_by([(x, "ascending") for x in ("b", "cluster", "p", "q", "side", "c")])
        unit = np.stack([np.asarray(table[x]).astype(np.int64) for x in ("b", "cluster", "p", "q")])
        c, side, size = (np.asarray(table[x]) for x in ("c", "side", "size"))
        new = np.ones(len(c) + 1, bool)
        new[1:-1] = (unit[:, 1:] != unit[:, :-1]).any(0)
        cuts = np.flatnonzero(new)
        for a, b in zip(cuts, cuts[1:], strict=False):
            take = a + np.flatnonzero(np.concatenate([[True], c[a + 1:b] != c[a:b - 1]]))
            grams = []
            for batch in table.select(["text"]).take(take).combine_chunks().to_batches():
                for _, raw, off in slices(batch):
                    flat, at = ngrams(raw, off, hasher, n)
                    grams += [flat[i:j] for i, j in zip(at, at[1:], strict=False)]
            left = int((side[take] == 0).sum())
            earlier = np.array(table["earlier"].take(take).to_pylist(), np.int64).reshape(len(take), -1)
            amount, root = part_links(grams, left, size[take], threshold, earlier)
            out[0].append(c[take])
            out[1].append(amount)
            out[2].append(c[take][root])
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in out], names=["c", "amount", "root"])

    return members.groupBy("bin").applyInArrow(run, "c bigint, amount bigint, root bigint")


def groups(docs: DataFrame, n: int = N, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, k, h (see ``keys``), set_id (smallest id
    with the same n-grams), n_links (other documents at or above the
    threshold), group (a number) and the group's smallest (k, h) ``head``."""
    sketches = materialize(sketch(docs, n, threshold))
    key = F.struct("k", "h")
    classes = materialize(sketches.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min(key).alias("head"), F.min("doc_id").alias("set_id"), F.count(F.lit(1)).alias("size"), F.first("bands").alias("bands"),
    ).withColumn("c", F.monotonically_increasing_id()))
    in_bands = classes.select("c", F.posexplode("bands").alias("b", "band"))
    buckets = in_bands.groupBy("b", "band").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("s")).filter("low < high")
    buckets = materialize(buckets.drop("high"))
    # Per class its buckets' smallest classes (at most one per band).
    lows = in_bands.join(buckets, ["b", "band"]).groupBy("c").agg(F.collect_set("low").alias("lows"))
    lows = lows.select("c", F.least("c", F.array_min("lows")).alias("b"), "lows")
    links = materialize(lows.select("b", F.explode(F.array_union(F.array("c"), "lows")).alias("a")).filter("a != b").select("a", "b").distinct())
    clusters = connect(links).select(F.col("node").alias("c"), F.col("root").alias("cluster"))
    counts = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"))
    # Large clusters whose buckets have fewer pairs than the whole.
    pairs = buckets.join(clusters, buckets["low"] == clusters["c"]).groupBy("cluster").agg(F.sum(F.col("s") * F.col("s")).alias("pairs"))
    counts = counts.join(pairs, "cluster").withColumn("by_bucket", (F.col("m") > BLOCK) & (F.col("pairs") < F.col("m") * F.col("m"))).drop("pairs")
    clusters = materialize(clusters.join(counts, "cluster"))
    whole = clusters.filter("NOT by_bucket").select("c", F.lit(-1).alias("b"), "cluster", "m")
    split = in_bands.join(buckets.drop("low"), ["b", "band"]).join(clusters.filter("by_bucket").select("c"), "c").select("c", "b", F.col("band").alias("cluster"), F.col("s").alias("m"))
    clusters = whole.union(split)
    # Units: block pairs p <= q of a group; a class of block x is in all of
    # its pairs, on side 0 as p and on side 1 as q.
    n_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("c"), n_blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda o: F.struct(
        F.least(o, block).alias("p"), F.greatest(o, block).alias("q"), (block > o).cast("int").alias("side")))
    placed = materialize(clusters.select("c", "b", "cluster", F.explode(pairs).alias("u")).select("c", "b", "cluster", "u.*"))
    units = max(1, math.ceil(placed.count() / UNIT_ROWS))
    chosen = classes.join(placed.select("c").distinct(), "c").select("c", "size", "bands", F.col("head.k").alias("k"), F.col("head.h").alias("h"))
    texts = keys(docs).select("k", "h", "text").join(small(materialize(chosen)), ["k", "h"]).select("c", "size", "bands", "text")
    members = placed.join(texts, "c").withColumn("bin", F.pmod(F.xxhash64("b", "cluster", "p", "q"), F.lit(units)).cast("int"))
    members = members.withColumn("earlier", F.slice("bands", 1, F.greatest("b", F.lit(0)))).drop("bands")
    checked = materialize(verify(members, units, n, threshold))
    amounts = checked.groupBy("c").agg(F.sum("amount").alias("amount"))
    parts = connect(checked.filter("c != root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    named = (classes.drop("bands", "cls").join(amounts, "c", "left")
             .join(parts.select(F.col("node").alias("c"), F.col("root").alias("part")), "c", "left")
             .withColumn("group", F.coalesce("part", "c")))
    heads = named.groupBy("group").agg(F.min("head").alias("group_head"), F.min("set_id").alias("class_id"))
    named = named.join(heads, "group").join(classes.select("c", "cls"), "c")
    rows = sketches.drop("bands").join(named, "cls", "left")
    return rows.select(
        "doc_id", "k", "h", F.coalesce("set_id", "doc_id").alias("set_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("size") - 1 + F.coalesce("amount", F.lit(0)), F.lit(0)).alias("n_links"),
        F.col("cls").isNotNull().alias("has_words"), F.col("group_head").alias("head"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: its class (the smallest id of all documents
    connected by links), the smallest id with the same n-grams, and the number
    of documents linked to it."""
    return groups(docs.select("doc_id", "text")).select("doc_id", "class_id", "set_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that come first (smallest id, then
    text hash) in their group; rows without words all stay."""
    found = groups(docs.select("doc_id", "text"))
    first = found.filter(~F.col("has_words") | (F.struct("k", "h") == F.col("head")))
    first = first.groupBy("k", "h").agg(F.max("has_words").alias("has_words"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("k"), F.xxhash64("text").alias("h"))
    rows = rows.join(first, ["k", "h"])
    # Partial aggregates: equal rows never meet in one task.
    one = rows.filter("has_words").groupBy("k", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*").union(rows.filter("NOT has_words").select("row.*"))
