"""Mixing sources to target weights by pivotal dependent rounding.

1. Targets: sources share the words of all documents by weight; a source whose
   share is above ``MOST`` times its own words gets that much, and the rest is
   shared again (a few rounds of one aggregate over the sources).
2. A document's copies are its source's rate, target / words: the whole part
   is certain, the fraction is a probability.
3. Pivotal rounding turns probabilities into 0 or 1.  Two fractions of one
   source meet, and *words* move from one to the other, in a random direction
   chosen so that both keep their expectation, until one is 0 or 1; the other
   goes on.  Each step leaves the source's expected words as they were, so
   only the last fraction of a source is off: by less than its document's
   words.
4. Documents are numbered within their source by a hash (``placed``: one range
   sort) and cut into blocks of ``BLOCK``.  A task streams over sorted blocks,
   holding one fraction, and leaves one residual per block; residuals are
   blocked again, up a tree of log_BLOCK(documents) levels, until each source
   has one left, which is drawn.  A hot source is many blocks.

Draws come from hashes of a document's place among its source's documents, and
that place from hashes of id and text, so runs agree whatever the partitions
(equal rows are interchangeable).

Null texts and texts without words have size 0 and are taken 0 times; sources
are ordered by code point with null, a source of its own, last.  Repeated rows
are documents of their own, null ids as well.  An empty table gives no rows;
if no document has words, all targets are 0.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import count_words, placed, small

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 4096
SEED = 13
MASK = (1 << 64) - 1


def draw(a: int, b: int, level: int, seed: int) -> float:
    """Uniform number in [0, 1) of two items meeting at a level."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + level * 0x165667B19E3779F9 + seed) & MASK
    for _ in range(2):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
        x ^= x >> 31
    return (x >> 11) / (1 << 53)


def meet(one: tuple[int, float, float], two: tuple[int, float, float], u: float) -> tuple[list[tuple[int, int]], tuple[int, float, float] | None]:
    """Move words between two fractions (item, size, x) until one is 0 or 1;
    ``u`` chooses the direction.  Returns the settled (item, 0 or 1) and the
    fraction that is left."""
    (i, s, x), (j, t, y) = one, two
    up, down = min((1 - x) * s, y * t), min(x * s, (1 - y) * t)  # most words that can move to `one`, to `two`
    if u * (up + down) < down:
        first, second = (1 - x) * s <= y * t, y * t <= (1 - x) * s
        x, y = (1.0 if first else x + up / s), (0.0 if second else y - up / t)
    else:
        first, second = x * s <= (1 - y) * t, (1 - y) * t <= x * s
        x, y = (0.0 if first else x - down / s), (1.0 if second else y + down / t)
    settled = [(k, int(v)) for k, v, done in ((i, x, first), (j, y, second)) if done]
    return settled, None if first and second else (j, t, y) if first else (i, s, x)


def pivot(items: DataFrame, level: int, last: bool, seed: int) -> DataFrame:
    """One level of the tree over ``items`` (start, block, nth, g, size, x):
    (start, nth, g, size, x, up), with ``up`` null for the residual of a block;
    the ``last`` level draws it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carry = None, None

        def rest() -> list[tuple]:
            if carry is None:
                return []
            g, size, x = carry
            up = int(draw(g - key[0], 0, level + 1, seed) < x) if last else None
            return [(*key, g, size, x, up)]

        for batch in batches:
            out = []
            for start, block, g, size, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (start, block):
                    out += rest()
                    key, carry = (start, block), None
                item = (g, size, x)
                if carry is None:
                    carry = item
                    continue
                settled, left = meet(carry, item, draw(carry[0] - start, g - start, level, seed))
                out += [(start, block, k, 0.0, 0.0, v) for k, v in settled]
                carry = left
            yield pack(out)
        yield pack(rest())

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32())
        columns = zip(*rows, strict=True) if rows else [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["start", "block", "g", "size", "x", "up"])

    rows = items.repartition("start", "block").sortWithinPartitions("start", "block", "g").select("start", "block", "g", "size", "x")
    return rows.mapInArrow(run, "start bigint, block bigint, g bigint, size double, x double, up int")


def round_copies(items: DataFrame, longest: int, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(g, up): 0 or 1 for every item (start, nth, g, size, x), where a source
    (``start``) has at most ``longest`` items."""
    levels = 1
    while block**levels < longest:
        levels += 1
    items = items.withColumn("block", F.floor(F.col("nth") / block)).select("start", "block", "g", F.col("size").cast("double").alias("size"), "x")
    settled = None
    for level in range(levels):
        out = materialize(pivot(items, level, level == levels - 1, seed))
        done = out.filter("up IS NOT NULL").select("g", "up")
        settled = done if settled is None else settled.union(done)
        items = out.filter("up IS NULL").drop("up").withColumn("block", F.floor(F.col("block") / block))
    return settled


def targets(sources: DataFrame, most: float = MOST) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``."""
    total, level = sources.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= most * F.col("source_size")
        held, free = sources.agg(F.sum(F.when(full, most * F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        higher = (total - held) / free if free else level
        if higher <= level:
            break
        level = higher
    cap = (most * F.col("source_size")).cast("double")
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(float(level))))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): size, source_size, target
    (both of its source), copies and taken (copies * size)."""
    sized = docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("at"))
    rows = placed(sized, "g", F.col("source").asc_nulls_last(), F.col("at"), F.col("doc_id"))
    sources = rows.groupBy("source").agg(F.min("g").alias("start"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    sources = placed(sources, "nth_source", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth_source") % len(weights) + 1).cast("int"))
    sources = targets(materialize(sources.withColumn("weight", weight)), most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = materialize(sources.withColumn("whole", F.floor(rate)).withColumn("x", rate - F.floor(rate)))
    known = small(sources.select(F.col("source").alias("of"), "start", "source_size", "target", "whole", "x"))
    rows = materialize(rows.drop("at").join(known, rows["source"].eqNullSafe(F.col("of"))).drop("of"))
    open_ = rows.filter("size > 0 AND x > 0").select("start", (F.col("g") - F.col("start")).alias("nth"), "g", "size", "x")
    ups = round_copies(open_, sources.agg(F.max("n")).first()[0] or 0, block, seed)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("up", F.lit(0))).otherwise(0)
    rows = rows.join(ups, "g", "left").withColumn("copies", copies.cast("long"))
    return rows.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
