"""Queries over SCD2 histories (QRY-1..8, JON-5, JON-6, FLT-11).

Periods are half-open ``[valid_from, valid_to)`` with NULL = open (SEM-9):
at a boundary instant exactly one version matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import ordered
from strata.operators.scd2 import SCD_ID, VFROM, VTO


def current(history: DataFrame) -> DataFrame:
    """QRY-1: open versions."""
    return history.filter(F.col(VTO).isNull())


def as_of(history: DataFrame, t: Column) -> DataFrame:
    """QRY-2 / JON-5: the version valid at ``t``."""
    return history.filter((F.col(VFROM) <= t) & (F.col(VTO).isNull() | (t < F.col(VTO))))


def versions(history: DataFrame, keys: Sequence[str], only: dict | None = None,
             segment_seconds: int | None = None) -> DataFrame:
    """QRY-3 / SRT-1: every version numbered in ``valid_from`` order per key,
    with an ``is_current`` flag.  ``only`` picks one key's history (a
    filter, pushed to the scan).  With ``segment_seconds`` the numbering is
    split by time segment and stitched, so a key holding most versions does
    not serialize into one task."""
    h = history
    for k, v in (only or {}).items():
        h = h.filter(F.col(k) == F.lit(v))
    h = h.select(*keys, SCD_ID, VFROM, VTO)
    seg = ordered.time_segment(VFROM, segment_seconds) if segment_seconds else None
    numbered = ordered.row_number(h, keys, [VFROM, SCD_ID], "version_no", seg)
    return numbered.select(*keys, SCD_ID, VFROM, VTO, "version_no", F.col(VTO).isNull().alias("is_current"))


def multi_version(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QRY-4 / AGG-6: keys with more than one version
    (``GROUP BY .. HAVING count(*) > 1``)."""
    return (history.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions_count"))
            .filter(F.col("versions_count") > 1))


def storage_metrics(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """QRY-5 / AGG-7: versions, keys, average versions per key, open and
    closed counts - one global aggregate (the distinct key count is the only
    part that needs a second shuffle level)."""
    return history.agg(
        F.count(F.lit(1)).alias("total_versions"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
        F.count_if(F.col(VTO).isNull()).alias("open_versions"),
        F.count_if(F.col(VTO).isNotNull()).alias("closed_versions"),
    ).withColumn("avg_versions_per_key",
                 F.round(F.col("total_versions") / F.nullif(F.col("distinct_keys"), F.lit(0)), 2)
                 .cast("decimal(18,2)"))


def recent_changes(history: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """QRY-6 / SRT-5 / PRJ-21: versions that started within ``hours`` of
    ``now``, newest first."""
    since = now - F.make_interval(hours=F.lit(hours))
    return history.filter(F.col(VFROM) > since).orderBy(F.col(VFROM).desc())


def growth(history: DataFrame, before: Column, keys: Sequence[str]) -> DataFrame:
    """QRY-8: versions and keys at the earlier endpoint (rows satisfying
    ``before``) and now, growth rate and versions per key - one aggregate
    over the history, no join."""
    k = F.struct(*[F.col(c) for c in keys]) if len(keys) > 1 else F.col(keys[0])
    return history.agg(
        F.count_if(before).alias("versions_before"), F.count(F.lit(1)).alias("versions_after"),
        F.count_distinct(F.when(before, k)).alias("keys_before"), F.count_distinct(k).alias("keys_after"),
    ).select(
        "versions_before", "versions_after", "keys_before", "keys_after",
        F.round(F.col("versions_after") / F.nullif(F.col("versions_before"), F.lit(0)), 4)
        .cast("decimal(18,4)").alias("growth_rate"),
        F.round(F.col("versions_after") / F.nullif(F.col("keys_after"), F.lit(0)), 4)
        .cast("decimal(18,4)").alias("versions_per_key"))


def pit_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_attrs: Sequence[str],
             right_attrs: Sequence[str], segment_seconds: int | None = None) -> DataFrame:
    """JON-6: point-in-time join of two histories of the same key.

    Output: one row per pair of versions whose periods intersect, with the
    intersection as ``[valid_from, valid_to)``.  Computed as a sweep, not as
    a per-key self-join: both sides' start and end instants are merged into
    one timeline per key, each side's state is forward-filled along it, and
    consecutive instants delimit the output periods.  Work and output are
    linear in the number of versions even when one key holds most of them
    (the equi-join form would enumerate all pairs of a hot key before the
    overlap filter).  Assumes each input is a valid history (no overlaps
    within one side; checked by ``dq_scd2_overlap``)."""
    la, ra = [f"l_{a}" for a in left_attrs], [f"r_{a}" for a in right_attrs]

    def points(h: DataFrame, attrs: Sequence[str], names: Sequence[str], side: int) -> DataFrame:
        # kind 0 = a period ends, kind 1 = a period starts; ends sort first so
        # an end and a start at one instant leave the new version active.
        starts = h.select(*keys, F.col(VFROM).alias("t"), F.lit(1).alias("kind"), F.lit(side).alias("side"),
                          F.lit(True).alias(f"act{side}"),
                          *[F.col(a).alias(n) for a, n in zip(attrs, names)])
        ends = h.filter(F.col(VTO).isNotNull()).select(
            *keys, F.col(VTO).alias("t"), F.lit(0).alias("kind"), F.lit(side).alias("side"),
            F.lit(False).alias(f"act{side}"), *[F.lit(None).cast(h.schema[a].dataType).alias(n)
                                                  for a, n in zip(attrs, names)])
        return starts.unionByName(ends)

    pl = points(left, left_attrs, la, 1)
    pr = points(right, right_attrs, ra, 2)
    tl = pl.unionByName(pr, allowMissingColumns=True)
    # A state struct per side, present only on that side's rows.
    tl = tl.select(*keys, "t", "kind", "side",
                   F.when(F.col("side") == 1, F.struct(F.col("act1").alias("act"), *[F.col(c) for c in la])).alias("s1"),
                   F.when(F.col("side") == 2, F.struct(F.col("act2").alias("act"), *[F.col(c) for c in ra])).alias("s2"))
    order = ["t", "kind", "side"]
    seg = None
    if segment_seconds:
        tl, seg = ordered.with_segment(tl, "t", segment_seconds), ordered.SEG
    filled = ordered.ffill(tl, keys, order, ["s1", "s2"], "f_", seg)
    nxt = ordered.shift(filled, keys, order, ["t"], "next", "n_", seg)
    live = nxt.filter(F.coalesce(F.col("f_s1.act"), F.lit(False)) & F.coalesce(F.col("f_s2.act"), F.lit(False))
                      & (F.col("n_t").isNull() | (F.col("n_t") > F.col("t"))))
    return live.select(*keys, *[F.col(f"f_s1.{c}").alias(a) for c, a in zip(la, left_attrs)],
                       *[F.col(f"f_s2.{c}").alias(a) for c, a in zip(ra, right_attrs)],
                       F.col("t").alias(VFROM), F.col("n_t").alias(VTO))
