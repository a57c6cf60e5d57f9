"""Importance resampling towards a target distribution, with a head-tail
vocabulary.

A document's features are its runs of 1 to ``n`` (1 or 2) consecutive words,
hashed into ``buckets`` by CRC-32.  A bucket's gain is the log ratio of its
smoothed share in the target texts and in the documents; a document weighs the
sum of its features' gains, and Gumbel noise on top makes the highest scores a
weighted draw without replacement.

1. Head: words (and pairs) that may be more than a 1 / ``SHARE`` part of all.
   Each task keeps a summary of 4 * SHARE counters (all are lowered by the
   same amount when there are more), so a feature's count falls short by at
   most a quarter of the bound.  Spark adds the summaries up; at most
   4 / 3 * SHARE words and as many pairs of at most ``LONGEST`` bytes can pass,
   whatever the input, and are broadcast: words with their exact CRC state,
   pairs with their bucket.
2. Totals: head features are looked up; a tail pair goes on from its first
   word's CRC state, any other tail feature takes its CRC directly.  The head
   only saves work: every feature of every document and target text is
   counted in its exact bucket.
3. Scores: the same buckets once more, with the gains (one number a bucket).

Texts are never shuffled.  Long texts are read in pieces cut between words.

Null, empty and wordless texts have no features and weight 0.  Null ids take
the noise of an empty id and come last among equal scores; ties go to the
smaller id, then to the smaller hash of the text; equal rows take neighbouring
ranks.  Empty tables give no rows; an empty target gives gains by smoothing
alone.  Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, SQL_CRC_TABLE, UPPER, WORD, placed, small, sql_crc

SHARE = 20_000
LONGEST = 64
BUCKETS = 10_000
PIECE = 1 << 20
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"

# (head words -> CRC state, head pairs -> bucket)
Head = tuple[dict[bytes, int], dict[bytes, int]]


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The words of one text in order, as lists of about PIECE bytes."""
    low = (text or "").encode().translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))
    find, gap, at = re.compile(rb"[0-9a-z\x80-\xff]+").findall, re.compile(rb"[^0-9a-z\x80-\xff]"), 0
    while at < len(low):
        end = at + PIECE
        cut = gap.search(low, end) if end < len(low) else None
        end = cut.start() if cut else len(low)
        yield find(low[at:end])
        at = end


def feature_counts(text: str | None, n: int, words: Counter, pairs: Counter) -> int:
    """Add one text's words and pairs to the counters; its number of words."""
    total, last = 0, []
    for found in word_lists(text):
        total += len(found)
        words.update(found)
        if n > 1 and found:
            run = last + found
            pairs.update(zip(run, run[1:], strict=False))
            last = found[-1:]
    return total


def bucket_of(counts: Counter, pairs: Counter, head: Head, size: int) -> tuple[list[int], list[int]]:
    """Buckets and counts of counted words and pairs."""
    states, known = head
    buckets, amounts = [], []
    for word, c in counts.items():
        state = states.get(word)
        buckets.append((zlib.crc32(word) if state is None else state) % size)
        amounts.append(c)
    for (a, b), c in pairs.items():
        at = known.get(a + b" " + b)
        if at is None:
            state = states.get(a)
            at = zlib.crc32(b" " + b, zlib.crc32(a) if state is None else state) % size
        buckets.append(at)
        amounts.append(c)
    return buckets, amounts


def lowered(counts: Counter, keep: int) -> Counter:
    """At most ``keep`` counters: all are lowered by the next largest count."""
    if len(counts) <= keep:
        return counts
    cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), len(counts) - keep - 1)[len(counts) - keep - 1])
    return Counter({w: c - cut for w, c in counts.items() if c > cut})


def head_of(docs: DataFrame, n: int = 1, buckets: int = BUCKETS, share: int = SHARE) -> Head:
    """Frequent words with their CRC state and frequent pairs with their
    bucket; see the module's text for the bound."""
    keep = 4 * share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, total = Counter(), Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                total += feature_counts(text.as_py(), n, words, pairs)
                if len(words) + len(pairs) > 4 * keep:
                    words, pairs = lowered(words, keep), lowered(pairs, keep)
        words, pairs = lowered(words, keep), lowered(pairs, keep)
        found = [(1, w, c) for w, c in words.items() if len(w) <= LONGEST]
        found += [(2, a + b" " + b, c) for (a, b), c in pairs.items() if len(a) + len(b) < LONGEST]
        found.append((0, b"", total))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.int32(), pa.binary(), pa.int64()), strict=True)], names=["n", "feature", "c"])

    counts = materialize(docs.select("text").mapInArrow(run, "n int, feature binary, c bigint").groupBy("n", "feature").agg(F.sum("c").alias("c")))
    total = counts.filter("n = 0").agg(F.sum("c")).first()[0] or 0
    # A sum above this passes; the sums of all features are at most ``total``.
    common = counts.filter((F.col("n") > 0) & (F.col("c") * (4 * share) > F.lit(3 * total))).select("n", "feature").collect()
    return ({bytes(r.feature): zlib.crc32(r.feature) for r in common if r.n == 1},
            {bytes(r.feature): zlib.crc32(r.feature) % buckets for r in common if r.n == 2})


def bucket_totals(texts: DataFrame, head: Head, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, c): exact number of features of all ``texts`` per bucket."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, words, pairs, seen = np.zeros(buckets, np.int64), Counter(), Counter(), 0

        def flush() -> None:
            np.add.at(totals, *(np.array(x, np.int64) for x in bucket_of(words, pairs, shared.value, buckets)))
            words.clear()
            pairs.clear()

        for batch in batches:
            for text in batch.column(0):
                seen += feature_counts(text.as_py(), n, words, pairs)
                if len(words) + len(pairs) > 200_000:
                    flush()
        flush()
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(totals[at], pa.int64())], names=["bucket", "c"])

    return texts.select("text").mapInArrow(run, "bucket bigint, c bigint").groupBy("bucket").agg(F.sum("c").alias("c"))


def gains(docs: DataFrame, target: DataFrame, head: Head, n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths (``buckets`` numbers reach the
    driver)."""
    spark = docs.sparkSession
    own = bucket_totals(docs, head, n, buckets).select("bucket", F.col("c").alias("s"), F.lit(0).cast("long").alias("t"))
    aim = bucket_totals(target, head, n, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("c").alias("t"))
    every = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    both = materialize(every.union(own).union(aim).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    all_s, all_t = both.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1).cast("double") * F.lit(float(all_s + buckets))) / ((F.col("s") + 1).cast("double") * F.lit(float(all_t + buckets)))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.gain
    return out


def weigh(docs: DataFrame, gain: np.ndarray, head: Head, n: int = 1) -> DataFrame:
    """(doc_id, h, n_words, n_features, weight) of every document; ``h`` is a
    hash of its text."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain_of = shared.value
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch.column(2):
                words, pairs = Counter(), Counter()
                total = feature_counts(text.as_py(), n, words, pairs)
                at, amount = (np.array(x, np.int64) for x in bucket_of(words, pairs, known, len(gain_of)))
                n_words.append(total)
                n_features.append(int(amount.sum()))
                weight.append(int(gain_of[at] @ amount))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (n_words, n_features, weight))],
                                             names=["doc_id", "h", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    return rows.mapInArrow(run, f"doc_id {doc_id}, h bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise of a document in thousandths, from a hash of its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): h, n_words, n_features, weight,
    score, and the rank of the ``percent`` drawn among documents of at least
    ``min_words`` words (others: null)."""
    if n not in (1, 2):
        raise ValueError("features are words (1) or words and pairs (2)")
    docs, target = docs.select("doc_id", "text"), target.select("text")
    head = head_of(docs, n, buckets)
    scored = weigh(docs, gains(docs, target, head, n, buckets), head, n)
    scored = materialize(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    fit = F.col("n_words") >= min_words
    drawn = percent * scored.filter(fit).count() // 100
    ranked = placed(scored.filter(fit), "rank", F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("h").asc())
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all columns."""
    found = resample(docs, target, **options).filter(F.col("rank").isNotNull())
    # Rows that agree in id and text are told apart by how many of them are drawn.
    many = found.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("many"))
    k, h, nth = (f"{x}_draw" for x in ("k", "h", "nth"))
    rows = placed(docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias(k), F.xxhash64("text").alias(h)), nth, F.col(k), F.col(h))
    first = rows.groupBy(k, h).agg(F.min(nth).alias("first"))
    many = small(first.join(many, first[k].eqNullSafe(many["doc_id"]) & (first[h] == many["h"])).select(
        F.col(k).alias("id"), F.col(h).alias("text_hash"), "first", "many"))
    kept = rows.join(many, rows[k].eqNullSafe(F.col("id")) & (rows[h] == F.col("text_hash")))
    return kept.filter(F.col(nth) - F.col("first") < F.col("many")).select("row.*")


SQL = f"""
WITH {SQL_CRC_TABLE}, docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents
), items AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')) AS w FROM benchmark
), each AS (SELECT doc_id, unnest(ws) AS w FROM docs
), words AS (SELECT DISTINCT w FROM (SELECT w FROM each UNION ALL SELECT w FROM items)
), bucketed AS (SELECT w, ({sql_crc('w')}) % {BUCKETS} AS b FROM words, crc_table
), s AS (SELECT b, count(*) AS s FROM each JOIN bucketed USING (w) GROUP BY b
), t AS (SELECT b, count(*) AS t FROM items JOIN bucketed USING (w) GROUP BY b
), gains AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (SELECT count(*) + {BUCKETS} FROM each)
    / ((coalesce(s, 0) + 1)::DOUBLE * (SELECT count(*) + {BUCKETS} FROM items))))::BIGINT AS gain
  FROM s FULL JOIN t USING (b)
), weights AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight FROM each JOIN bucketed USING (w) JOIN gains USING (b) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS n FROM scored WHERE n_features >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= {PERCENT} * n // 100 THEN nth END::BIGINT AS rank FROM ranked
UNION ALL SELECT doc_id, n_features, weight, score, NULL::BIGINT FROM scored WHERE n_features < {MIN_WORDS}
"""
