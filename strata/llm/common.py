"""Shared helpers of the training-data operators: inputs, word spans, hashes.

The byte-level helpers work on the Arrow buffers of one batch inside a task.
Batches are cut into slices of a bounded number of bytes, so memory in a
Python worker does not depend on how long the texts are.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# Task functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules["strata.llm"])

# ASCII characters that separate words; every other character is part of one.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Named columns of an input table (extra columns are never read)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def words(text: Column) -> Column:
    """Array of the words of a text: A-Z lower-cased, split at ASCII
    separators; null and wordless texts give an empty array."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def python_words(text: str | None) -> list[str]:
    """The words of one text, for tests and small driver-side tables."""
    import re

    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch at document borders into slices of about ``limit`` bytes
    (a longer document is a slice of its own): (rows, bytes, offsets).  Null
    texts are empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1 + col.offset)[col.offset:]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo), raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    return lower, inside


LOWERED, IN_WORD = _tables()


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice: lower-cased bytes, start and end byte of each word,
    and the index of each document's first word (one more entry at the end).
    Words never cross documents."""
    low = LOWERED[raw]
    mask = IN_WORD[low]
    before = np.empty(len(mask), bool)
    before[:1] = False
    before[1:] = mask[:-1]
    edge = off[:-1][off[:-1] < len(mask)]
    before[edge] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    after[-1:] = False
    after[:-1] = mask[1:]
    last = off[1:-1]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return low, starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash:
    """64-bit hashes of byte spans by prefix sums of a polynomial over random
    byte values; equal bytes give equal hashes wherever they stand."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(raw) + 1
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            with np.errstate(over="ignore"):
                inverse = np.uint64(pow(self.BASE, -1, 1 << 64))
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(self.BASE))]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
        prefix = np.zeros(n, np.uint64)
        np.cumsum(self.values[raw] * self.up[:n - 1], out=prefix[1:])
        return mix((prefix[ends] - prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def table_bytes(df: DataFrame) -> int:
    """Rough size of a small table, measured by Spark (one aggregate)."""
    size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns), F.lit(16))
    return df.agg(F.sum(size)).first()[0] or 0


def small(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """Hint a broadcast of ``df`` only if its measured size is within
    ``limit``; beyond it Spark shuffles both sides."""
    return F.broadcast(df) if table_bytes(df) <= limit else df


def count_words(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D;
    null has none.  No array is built: every run becomes one character, and
    the white space is subtracted."""
    s, space = F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r"
    blanks = F.length(s) - F.length(F.translate(s, space, ""))
    return (F.length(F.regexp_replace(s, r"[^\x20\x09-\x0D]+", "x")) - blanks).cast("long")


def placed(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df``, written out, with the place (0, 1, 2...) of every row in
    ``order`` as column ``name``.  Rows are dealt by range, so neither a common
    key nor equal rows gather in one task (equal rows are told apart by their
    place in the input); each part numbers its rows, and only the parts'
    counts - one row per partition - are added up and broadcast."""
    tie, part, start = (f"{x}_{name}_placed" for x in ("tie", "part", "start"))
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, F.col(tie)).sortWithinPartitions(*order, F.col(tie)).drop(tie)
    rows = materialize(rows.withColumn(name, F.monotonically_increasing_id()))
    rows = rows.withColumn(part, F.shiftright(name, 33))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(part).agg(F.count(F.lit(1)).alias(start))
    starts = starts.select(part, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start))
    own = F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(starts), part).withColumn(name, own + F.col(start)).drop(part, start)


# DuckDB: CRC-32 table by its rule, and the checksum of a string's UTF-8 bytes.
SQL_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS crc_list FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) r(i)))"""


def sql_crc(text: str) -> str:
    """DuckDB expression: unsigned CRC-32 of ``text`` (joined to
    ``crc_table``)."""
    digits = f"hex(encode({text}))"
    byte = f"(instr('123456789ABCDEF', substr({digits}, 2 * j - 1, 1)) * 16 + instr('123456789ABCDEF', substr({digits}, 2 * j, 1)))"
    codes = f"list_transform(range(1, length({digits}) // 2 + 1), lambda j: ({byte})::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crc_list[(xor(c, b) & 255) + 1])), 4294967295)"
