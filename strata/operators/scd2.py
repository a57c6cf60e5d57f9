"""SCD Type-2 history (SCD-1..10).

History rows: the tracked columns plus ``dbt_scd_id``, ``dbt_updated_at``,
``dbt_valid_from`` and ``dbt_valid_to`` (NULL = open), periods half-open
``[valid_from, valid_to)``.

* :func:`snapshot` merges a new full extract into the history: one full
  outer join of the *open* versions with the extract on the key; every joined
  row emits one or two history rows through a single ``inline`` (no union of
  re-computed branches).  Closed versions are never touched, so at scale only
  the open part is rewritten and closed history is append-only.
* :func:`history_from_log` builds the whole history from an ordered change
  log in one pass (the batch form of many snapshot runs) with per-key
  ``lag``/``lead``, optionally split into time segments so a hot key does not
  land in one task (see :mod:`strata.operators.ordered`).
* :func:`history_from_extracts` builds it from many full extracts in one pass,
  absence of a key included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import version_id
from strata.operators import ordered

SCD_ID, UPDATED, VFROM, VTO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
META = (SCD_ID, UPDATED, VFROM, VTO)


# Columns that change with every run and so never make a version.
TECHNICAL = ("loaded_at",)


class DuplicateKeyError(ValueError):
    """The extract holds a key more than once (SEM-16)."""


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> None:
    """Raise when ``keys`` repeat.  Partial aggregate + ``limit(1)``: only a
    boolean reaches the driver."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1)
    if not dup.isEmpty():
        raise DuplicateKeyError(f"duplicate keys {list(keys)} in {what}")


def _changed(strategy: str, old: str, new: str, check_cols: Sequence[str], updated_at: str | None) -> Column:
    if strategy == "check":
        diffs = [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in check_cols]
        out = diffs[0]
        for d in diffs[1:]:
            out = out | d
        return out
    if strategy == "timestamp":
        return F.col(f"{new}.{updated_at}") > F.col(f"{old}.{UPDATED}")
    raise ValueError(f"unknown strategy {strategy!r}")


def first_load(current: DataFrame, keys: Sequence[str], strategy: str, run_ts: Column,
               updated_at: str | None = None) -> DataFrame:
    """SCD-7: every row becomes an open version."""
    vfrom = F.col(updated_at) if strategy == "timestamp" else run_ts
    return (current
            .withColumn(UPDATED, vfrom.cast("timestamp"))
            .withColumn(VFROM, vfrom.cast("timestamp"))
            .withColumn(VTO, F.lit(None).cast("timestamp"))
            .withColumn(SCD_ID, version_id(keys, VFROM))
            .select(*current.columns, SCD_ID, UPDATED, VFROM, VTO))


def snapshot(history: DataFrame | None, current: DataFrame, keys: Sequence[str], strategy: str,
             run_ts: Column, check_cols: Sequence[str] | None = None, updated_at: str | None = None,
             invalidate_hard_deletes: bool = True, check_unique: bool = False) -> DataFrame:
    """SCD-1..5, 9: merge ``current`` (one row per key) into ``history``.

    * new key -> open version;
    * changed (``check``: any of ``check_cols`` differs, null-safe;
      ``timestamp``: ``updated_at`` later than the open version's) -> old
      version closed at the new version's start, new open version;
    * unchanged -> kept;
    * key missing from ``current`` -> closed at ``run_ts`` when
      ``invalidate_hard_deletes``; a later re-insert opens a new version.
    ``check`` versions start at ``run_ts``; ``timestamp`` versions at
    ``updated_at``.
    """
    if check_unique:
        require_unique(current, keys, "snapshot extract")
    if history is None:
        return first_load(current, keys, strategy, run_ts, updated_at)
    data_cols = [c for c in current.columns]
    if strategy == "check":
        check_cols = list(check_cols) if check_cols else [c for c in data_cols if c not in keys and c not in TECHNICAL]

    closed = history.filter(F.col(VTO).isNotNull())
    open_ = history.filter(F.col(VTO).isNull())
    o = open_.select(F.struct(*[F.col(c) for c in open_.columns]).alias("o"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    n = current.select(F.struct(*[F.col(c) for c in current.columns]).alias("n"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    j = o.join(n, [f"_k{i}" for i in range(len(keys))], "full_outer")

    has_o, has_n = F.col("o").isNotNull(), F.col("n").isNotNull()
    changed = has_o & has_n & F.coalesce(_changed(strategy, "o", "n", check_cols or [], updated_at), F.lit(False))
    new_from = (F.col(f"n.{updated_at}") if strategy == "timestamp" else run_ts).cast("timestamp")
    close_at = (F.when(changed, new_from)
                .when(~has_n & F.lit(invalidate_hard_deletes), run_ts.cast("timestamp")))

    def row(src: str, vfrom: Column, vto: Column, upd: Column) -> Column:
        fields = [F.col(f"{src}.{c}").alias(c) for c in data_cols]
        return F.struct(*fields, version_id([F.col(f"{src}.{k}") for k in keys], vfrom).alias(SCD_ID),
                        upd.alias(UPDATED), vfrom.alias(VFROM), vto.alias(VTO))

    old_row = F.when(has_o, row("o", F.col(f"o.{VFROM}"), close_at, F.col(f"o.{UPDATED}")))
    new_row = F.when(has_n & (~has_o | changed), row("n", new_from, F.lit(None).cast("timestamp"), new_from))
    merged = j.select(F.inline(F.filter(F.array(old_row, new_row), lambda x: x.isNotNull())))
    return closed.select(*data_cols, *META).unionByName(merged)


def history_from_log(log: DataFrame, keys: Sequence[str], ts: str, attrs: Sequence[str],
                     tiebreak: str | None = None, segment_seconds: int | None = None) -> DataFrame:
    """SCD-8: versions from a change log.  A row opens a version when any of
    ``attrs`` differs (null-safe) from the previous row of its key; the
    version ends where the next version starts; the last one stays open.
    Several changes at one instant keep their order by ``tiebreak``, which is
    part of the version id; all but the last have zero length.
    ``segment_seconds``: the width of time segments that split hot keys."""
    order = [ts] + ([tiebreak] if tiebreak else [])
    base_cols = list(dict.fromkeys([*keys, *order, *attrs]))
    base = log.select(*base_cols)
    seg = None
    if segment_seconds:
        base, seg = ordered.with_segment(base, ts, segment_seconds), ordered.SEG
    # ``ts`` travels with the attributes: a NULL previous ``ts`` marks the
    # first row of a key (ts itself is never NULL in a change log).
    prev = ordered.shift(base, keys, order, [ts, *attrs], "prev", "_p_", seg)
    opens = F.col(f"_p_{ts}").isNull()
    for a in attrs:
        opens = opens | ~F.col(a).eqNullSafe(F.col(f"_p_{a}"))
    kept = prev.filter(opens).select(*base.columns)
    nxt = ordered.shift(kept, keys, order, [ts], "next", "_n_", seg)
    return nxt.select(
        *keys, *attrs,
        version_id(keys, F.col(ts), tiebreak).alias(SCD_ID),
        F.col(ts).alias(UPDATED),
        F.col(ts).alias(VFROM),
        F.col(f"_n_{ts}").alias(VTO))


def history_from_extracts(extracts: DataFrame, run_times: Sequence, keys: Sequence[str], strategy: str = "check",
                          check_cols: Sequence[str] | None = None, updated_at: str | None = None,
                          invalidate_hard_deletes: bool = True, number: str = "extract_no") -> DataFrame:
    """SCD-4/8 from many full extracts, equal to as many successive
    :func:`snapshot` merges, in one pass.

    ``extracts`` holds the rows of all extracts with their ``number`` (0, 1,
    ... in ``run_times``, the times of the runs; an extract may be empty).
    Gaps and islands over (key, number): a row opens a version when the
    extract before lacks its key or (``check``) a tracked column differs, or
    (``timestamp``) ``updated_at`` is later than all before in its run of
    extracts.  A version ends with the next one, or at the run that first
    lacks the key.  A key has one row per extract (checked), so no key gathers
    more rows than there are extracts."""
    require_unique(extracts, [*keys, number], "extracts")
    columns = [c for c in extracts.columns if c != number]
    cols = list(check_cols) if check_cols else [c for c in columns if c not in keys and c not in TECHNICAL]
    times = F.array(*[F.lit(t).cast("timestamp") for t in run_times])
    at = lambda n: F.element_at(times, (n + 1).cast("int"))
    per_key = Window.partitionBy(*keys).orderBy(number)
    last = F.lag(number).over(per_key)
    # A stretch is a run of extracts that hold the key without a gap.
    starts = last.isNull() | (F.col(number) != last + 1) if invalidate_hard_deletes else last.isNull()
    rows = extracts.withColumn("_starts", starts).withColumn("_stretch", F.sum(F.col("_starts").cast("int")).over(per_key))
    stretch = Window.partitionBy(*keys, "_stretch").orderBy(number)
    if strategy == "check":
        opens = F.col("_starts")
        for c in cols:
            opens = opens | ~F.col(c).eqNullSafe(F.lag(c).over(per_key))
    elif strategy == "timestamp":
        before = stretch.rowsBetween(Window.unboundedPreceding, -1)
        opens = F.col("_starts") | F.coalesce(F.col(updated_at) > F.max(updated_at).over(before), F.lit(False))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    rows = rows.withColumn("_opens", opens).withColumn("_island", F.sum(F.col("_opens").cast("int")).over(per_key))
    versions = rows.groupBy(*keys, "_stretch", "_island").agg(
        F.min_by(F.struct(*columns), number).alias("_row"), F.min(number).alias("_first"), F.max(number).alias("_end"))
    start = (F.col(f"_row.{updated_at}") if strategy == "timestamp" else at(F.col("_first"))).cast("timestamp")
    versions = versions.withColumn(VFROM, start)
    # Within a stretch the next version ends this one; the last version of a
    # stretch ends at the run after its last extract, if there was one.
    nxt = F.lead(VFROM).over(Window.partitionBy(*keys, "_stretch").orderBy("_island"))
    gone = F.when(F.col("_end") + 1 < len(run_times), at(F.least(F.col("_end") + 1, F.lit(len(run_times) - 1)))) if invalidate_hard_deletes else F.lit(None).cast("timestamp")
    versions = versions.withColumn(VTO, F.coalesce(nxt, gone))
    return versions.select(*[F.col(f"_row.{c}").alias(c) for c in columns], version_id([F.col(f"_row.{k}") for k in keys], F.col(VFROM)).alias(SCD_ID),
                           F.col(VFROM).alias(UPDATED), VFROM, VTO)


def archive_split(history: DataFrame, older_than: Column) -> tuple[DataFrame, DataFrame]:
    """SCD-10: ``(archive, remaining)`` - closed versions that ended before
    ``older_than`` move to the archive; everything else stays."""
    old = F.col(VTO).isNotNull() & (F.col(VTO) < older_than)
    return history.filter(old), history.filter(~old | F.col(VTO).isNull())
