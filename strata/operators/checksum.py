"""Order-free checksums of whole outputs (SNK-7, SNK-9).

A row's text (every column with its length, nulls marked) gives one MD5; two
60-bit parts of it are summed over the rows as exact decimals, beside the row
count.  Sums do not depend on order, files or partitions, count repeated rows
as often as they stand, and are partial aggregates: a table is compared by
three numbers, in the pass that writes or reads it.  Two outputs that differ
agree by chance with a probability of about 2**-120.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, FIRST, SECOND = "checksum_rows", "checksum_1", "checksum_2"
SUM_TYPE = "decimal(38,0)"  # 10**19 rows of 60 bits


def row_text(columns: Sequence[str]) -> Column:
    """A row as text that no other row of the same columns has: the length
    keeps neighbours apart, a null has none."""
    parts = []
    for c in columns:
        text = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(F.lit(""), *parts)


def measures(columns: Sequence[str]) -> list[Column]:
    """The three aggregates, for ``agg`` or for an ``Observation``."""
    digest = F.md5(row_text(columns).cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast(SUM_TYPE)
    total = lambda c: F.coalesce(F.sum(c).cast(SUM_TYPE), F.lit(0).cast(SUM_TYPE))
    return [F.count(F.lit(1)).alias(ROWS), total(part(1)).alias(FIRST), total(part(16)).alias(SECOND)]


def checksum(df: DataFrame) -> DataFrame:
    """One row: the checksum of ``df`` (its columns in their order)."""
    return df.agg(*measures(df.columns))


def aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like``, in its order and types."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in like.schema.fields])


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Do both hold the same rows, equally often?  One pass over each."""
    return checksum(a).first() == checksum(aligned(b, a)).first()
