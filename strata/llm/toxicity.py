"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, neighbouring word
pairs and pairs with one word between them.  Training runs the per-coordinate
FTRL-proximal update on several shards at a time, each shard a Spark task;
after every round the shards' accumulators are averaged range by range, also
in Spark tasks, and only the averaged table of fixed size (2**BITS
coordinates) reaches the driver.  L1 makes most weights zero; the rest is a
small broadcast used to score whole texts in one pass without a shuffle.

Bound of the training sample: ``MAX_TRAIN_ROWS`` labelled rows, taken by a
hash of the document id when there are more.

Null and empty texts have no features and get the score of the intercept.
Null ids are scored but never learned from or held out; repeated label rows
count once per document (the larger label); with no labelled row every score
is the prior 0.5 shifted by nothing, that is 0.5 times ``EMPTY_PRIOR``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHash, mix, slices, word_spans

BITS = 20
MAX_TRAIN_ROWS = 20_000
SHARDS = 4
ROUNDS = 4
RANGES = 16
TRAIN_BYTES = 1 << 19  # bytes of text whose features are held at a time
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.5, 0.0
EMPTY_PRIOR = 0.2
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """Non-zero weights by coordinate, and the intercept."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text is 2
    modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def coordinates(raw: np.ndarray, off: np.ndarray, hasher: WordHash, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of every word, pair and skip pair of a slice."""
    low, starts, ends, first = word_spans(raw, off)
    h = hasher(low, starts, ends)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    docs, hashes = [doc], [h]
    for gap, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        same = doc[:-gap] == doc[gap:] if len(doc) > gap else np.zeros(0, bool)
        pair = h[:-gap] * np.uint64(factor) + h[gap:] if len(doc) > gap else h[:0]
        docs.append(doc[gap:][same])
        hashes.append(mix(pair[same]))
    return np.concatenate(docs), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed-form FTRL-proximal weights of accumulators."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def learn(texts: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of per-coordinate updates, in the order given; the last
    coordinate is the intercept, which has no L1."""
    bias = len(z) - 1
    for x, y in texts:
        zi, ni = z[x], n[x]
        w = weights(zi, ni)
        b = -z[bias] / ((BETA + np.sqrt(n[bias])) / ALPHA)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
        n[x] = ni + g * g
        z[x] = zi + g - (np.sqrt(n[x]) - np.sqrt(ni)) / ALPHA * w
        grown = n[bias] + g * g
        z[bias] += g - (np.sqrt(grown) - np.sqrt(n[bias])) / ALPHA * b
        n[bias] = grown


STATE = "part int, z binary, n binary"


def state_table(z: list[bytes], n: list[bytes], parts) -> pa.Table:
    """Accumulators of ranges of coordinates."""
    return pa.table([pa.array(parts, pa.int32()), pa.array(z, pa.binary()), pa.array(n, pa.binary())], names=["part", "z", "n"])


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(shard, place, text, y) of the bounded training sample."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")))
    total = known.count()
    share = min(1.0, limit / max(1, total))
    order = F.xxhash64(F.col("doc_id"), F.lit("train"))
    kept = known.filter(F.pmod(order, F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0))
    rows = docs.select("doc_id", "text").join(kept, "doc_id")
    return rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int").alias("shard"),
                       order.alias("place"), "text", "y")


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN_ROWS, bits: int = BITS, rounds: int = ROUNDS) -> Model:
    """Fit the model; ``rounds`` passes of sharded FTRL with averaging."""
    spark = docs.sparkSession
    from ..session import materialize

    rows = materialize(training_rows(docs, labels, limit))
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    cuts = [round(i * size / RANGES) for i in range(RANGES + 1)]

    for _ in range(rounds):
        given = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def shard(table: pa.Table) -> pa.Table:  # noqa: B023  the round's job ends before the next begins
            z, n = (a.astype(np.float64) for a in given.value)  # noqa: B023
            hasher = WordHash()
            ordered = table.sort_by([(c, "ascending") for c in ("place", "y", "text")]).select(["text", "y"]).combine_chunks()
            for batch in ordered.to_batches():
                for part, raw, off in slices(batch, limit=TRAIN_BYTES):
                    doc, at = coordinates(raw, off, hasher, bits)
                    both = np.unique((doc << bits) | at)
                    ends = np.searchsorted(both, np.arange(len(off)) << bits)
                    both &= (1 << bits) - 1
                    learn([(both[ends[d]:ends[d + 1]], y) for d, y in enumerate(part.column(1).to_pylist())], z, n)
            z, n = z.astype(np.float32), n.astype(np.float32)
            return state_table([z[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)],
                               [n[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], range(RANGES))

        def mean(table: pa.Table) -> pa.Table:
            avg = lambda c: np.mean([np.frombuffer(x, np.float32) for x in table[c].to_pylist()], axis=0, dtype=np.float64)
            return state_table([avg("z").astype(np.float32).tobytes()], [avg("n").astype(np.float32).tobytes()], [table["part"][0].as_py()])

        merged = rows.groupBy("shard").applyInArrow(shard, STATE).groupBy("part").applyInArrow(mean, STATE)
        parts = {r.part: r for r in merged.collect()}  # 2**bits coordinates, whatever the input
        given.unpersist()
        if not parts:
            break
        z = np.concatenate([np.frombuffer(parts[i].z, np.float32) for i in range(RANGES)]).astype(np.float64)
        n = np.concatenate([np.frombuffer(parts[i].n, np.float32) for i in range(RANGES)]).astype(np.float64)
    w = weights(z, n)[:-1]
    index = np.flatnonzero(w)
    bias = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA) if n[-1] else float(np.log(EMPTY_PRIOR / (1 - EMPTY_PRIOR)))
    return Model(index, w[index].astype(np.float32), float(bias), bits)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in a further ``column``
    (replacing one of that name)."""
    spark = docs.sparkSession
    docs = docs.drop(column)
    # Plain arrays: executors need not know this package.
    shared, bits = spark.sparkContext.broadcast((model.index, model.weight, model.bias)), model.bits
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (index, weight, bias), hasher = shared.value, WordHash()
        used = np.zeros(1 << bits, bool)
        used[index] = True
        table = np.zeros(1 << bits, np.float32)
        table[index] = weight
        for batch in batches:
            for rows, raw, off in slices(batch):
                doc, at = coordinates(raw, off, hasher, bits)
                hit = used[at]
                both = np.unique((doc[hit] << bits) | at[hit])
                total = np.bincount(both >> bits, table[both & ((1 << bits) - 1)].astype(np.float64), len(off) - 1)
                p = 1.0 / (1.0 + np.exp(-np.clip(total + bias, -35, 35)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(p, pa.float64())], names=[*names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score and decision, and whether its label was
    held out."""
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
