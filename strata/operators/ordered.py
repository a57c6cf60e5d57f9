"""Per-key ordered scans that stay balanced when one key is hot.

``lag``/``lead``/running-max over ``Window.partitionBy(key)`` put every row of
a key into one task; if one key holds a third of the data that task holds a
third of the data.  Here the window is partitioned by ``(key, segment)``,
where ``segment`` is a monotone bucket of the ordering column (for instance
the hour of a timestamp).  A hot key is then spread over as many tasks as it
has segments.  The value that crosses a segment boundary comes from a small
per-segment summary (one row per key and segment, built with a partial
aggregate) scanned with a window over ``key`` - that window sees at most
"number of segments" rows per key, a bound set by the segment width, not by
the data.  The summary is joined back on ``(key, segment)``, the same keys the
big side is already partitioned by, so the big side is shuffled exactly once.

``segment`` is either a Column (computed inside the call) or the name of a
segment column already on the frame (see :func:`with_segment`), which is
then kept in the output for the next scan.

The width is the caller's parameter; nothing switches on the size of the data.
Without a segment the plain window is used (for keys known to be small).  Both
give identical results; ``tests/test_ordered_and_history.py`` checks it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = "_seg"


def time_segment(ts: str | Column, width_seconds: int) -> Column:
    """Monotone bucket of a timestamp: ``floor(epoch_seconds / width)``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(width_seconds * 1_000_000)).cast("long")


def with_segment(df: DataFrame, ts: str, width_seconds: int) -> DataFrame:
    """Add the segment column once, so chained scans (lag, then lead over
    the kept rows) share the ``(key, _seg)`` partitioning and the big side is
    shuffled once instead of once per scan."""
    return df.withColumn(SEG, time_segment(ts, width_seconds))


def _segmented(df: DataFrame, segment: Column | str) -> tuple[DataFrame, bool]:
    """``(frame with _seg, keep _seg in the output)``."""
    if isinstance(segment, str):
        return df, True
    return df.withColumn(SEG, segment), False


def _order_struct(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])


def shift(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
          direction: str = "prev", prefix: str | None = None, segment: Column | str | None = None) -> DataFrame:
    """Add ``{prefix}{v}`` = the value of the previous (``direction='prev'``)
    or next (``'next'``) row of the same key in ``order_cols`` order.
    ``order_cols`` must order the rows of a key totally."""
    assert direction in ("prev", "next")
    prefix = prefix if prefix is not None else f"{direction}_"
    packed = F.struct(*[F.col(v).alias(v) for v in value_cols])
    ordering = [F.col(c).asc() for c in order_cols]
    fn = F.lag if direction == "prev" else F.lead

    if segment is None:
        w = Window.partitionBy(*keys).orderBy(*ordering)
        out = df.withColumn("_shift", fn(packed, 1).over(w))
        return out.select("*", *[F.col("_shift")[v].alias(prefix + v) for v in value_cols]).drop("_shift")

    seg, keep = _segmented(df, segment)
    base_cols = [c for c in df.columns if keep or c != SEG]
    w_in = Window.partitionBy(*keys, SEG).orderBy(*ordering)
    inner = seg.withColumn("_in", fn(packed, 1).over(w_in))

    # One row per (key, segment): the segment's boundary row in order.
    pick = F.max_by if direction == "prev" else F.min_by
    summary = (seg.groupBy(*keys, SEG)
               .agg(pick(packed, _order_struct(order_cols)).alias("_edge")))
    w_seg = Window.partitionBy(*keys).orderBy(F.col(SEG).asc())
    carry = summary.select(*keys, SEG, fn("_edge", 1).over(w_seg).alias("_carry"))

    joined = inner.join(carry, [*keys, SEG], "left")
    val = F.when(F.col("_in").isNull(), F.col("_carry")).otherwise(F.col("_in"))
    return (joined.withColumn("_shift", val)
            .select(*base_cols, *[F.col("_shift")[v].alias(prefix + v) for v in value_cols]))


def prefix_max(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value: str,
               out: str = "prev_max", segment: Column | str | None = None) -> DataFrame:
    """``out`` = max of ``value`` over the rows of the same key strictly
    before this one in ``order_cols`` order (NULL for the first row)."""
    ordering = [F.col(c).asc() for c in order_cols]
    if segment is None:
        w = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.max(value).over(w))

    seg, keep = _segmented(df, segment)
    base_cols = [c for c in df.columns if keep or c != SEG]
    w_in = Window.partitionBy(*keys, SEG).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    inner = seg.withColumn("_in", F.max(value).over(w_in))
    summary = seg.groupBy(*keys, SEG).agg(F.max(value).alias("_segmax"))
    w_seg = Window.partitionBy(*keys).orderBy(F.col(SEG).asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SEG, F.max("_segmax").over(w_seg).alias("_carry"))
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.withColumn(out, F.greatest("_in", "_carry")).select(*base_cols, out)


def ffill(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
          prefix: str = "ff_", segment: Column | str | None = None) -> DataFrame:
    """``{prefix}{v}`` = the last non-NULL ``v`` of the same key up to and
    including this row in ``order_cols`` order (forward fill)."""
    ordering = [F.col(c).asc() for c in order_cols]
    frame = (Window.unboundedPreceding, Window.currentRow)
    if segment is None:
        w = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(*frame)
        return df.select("*", *[F.last(v, ignorenulls=True).over(w).alias(prefix + v) for v in value_cols])

    seg, keep = _segmented(df, segment)
    base_cols = [c for c in df.columns if keep or c != SEG]
    w_in = Window.partitionBy(*keys, SEG).orderBy(*ordering).rowsBetween(*frame)
    inner = seg.select("*", *[F.last(v, ignorenulls=True).over(w_in).alias(f"_in_{v}") for v in value_cols])
    # Per segment: the last non-NULL value of each column, in order.
    summary = seg.groupBy(*keys, SEG).agg(*[
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), _order_struct(order_cols))).alias(f"_last_{v}")
        for v in value_cols])
    w_seg = Window.partitionBy(*keys).orderBy(F.col(SEG).asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SEG, *[F.last(f"_last_{v}", ignorenulls=True).over(w_seg).alias(f"_c_{v}")
                                         for v in value_cols])
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.select(*base_cols, *[F.coalesce(f"_in_{v}", f"_c_{v}").alias(prefix + v) for v in value_cols])


def row_number(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], out: str = "row_no",
               segment: Column | str | None = None) -> DataFrame:
    """``out`` = 1-based position of the row within its key in ``order_cols``
    order: the in-segment row number plus the key's row count in all earlier
    segments (a running sum over the per-segment counts)."""
    ordering = [F.col(c).asc() for c in order_cols]
    if segment is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
    seg, keep = _segmented(df, segment)
    base_cols = [c for c in df.columns if keep or c != SEG]
    inner = seg.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, SEG).orderBy(*ordering)))
    summary = seg.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_n"))
    w_seg = Window.partitionBy(*keys).orderBy(F.col(SEG).asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SEG, F.coalesce(F.sum("_n").over(w_seg), F.lit(0)).alias("_before"))
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.select(*base_cols, (F.col("_in") + F.col("_before")).cast("int").alias(out))
