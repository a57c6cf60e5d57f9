"""Incremental maintenance (INC-1..8, AGG-5, SEM-5/7).

* The high-water mark is one global ``max`` (a partial aggregate: each task
  sends one value) brought to the driver as a scalar and applied as a
  literal, so the filter reaches the Parquet scan and prunes row groups.
* Upsert is ``target minus source keys`` plus ``source`` - an anti-join and
  a union; written to the run's own partition (see :mod:`strata.plans.runs`)
  or to the touched buckets of a keyed table (:mod:`strata.operators.buckets`).
* Changed-key propagation recomputes the affected keys of a downstream
  aggregate from *all* their detail rows and deletes keys that no longer
  qualify, so the incremental result equals a full refresh.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the fallback watermark when the target is empty.
DEFAULT_MARK = dt.datetime(1900, 1, 1)


class SchemaChangeError(ValueError):
    """The new batch's schema differs from the incremental target's (INC-5)."""


def watermark(target: DataFrame | None, ts: str, default: dt.datetime = DEFAULT_MARK) -> dt.datetime:
    """AGG-5 / INC-6: ``coalesce(max(target.ts), default)`` as a Python
    scalar.  ``None`` target (first run) -> ``default``."""
    if target is None:
        return default
    v = target.agg(F.max(ts).alias("m")).first()["m"]
    return default if v is None else v


def since(source: DataFrame, ts: str, mark: dt.datetime | Column, lookback_days: int = 0) -> DataFrame:
    """INC-1 / INC-2: rows strictly after ``mark - lookback``.  A Python
    ``mark`` becomes a literal, which Catalyst pushes into the scan."""
    m = F.lit(mark) if isinstance(mark, dt.datetime) else mark
    if lookback_days:
        m = m - F.make_interval(days=F.lit(lookback_days))
    return source.filter(F.col(ts) > m)


def check_schema(target_schema: T.StructType, batch_schema: T.StructType) -> None:
    """INC-5 (``on_schema_change='fail'``): names and types must match."""
    a = [(f.name, f.dataType.simpleString()) for f in target_schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in batch_schema.fields]
    if sorted(a) != sorted(b):
        missing = sorted(set(a) - set(b))
        extra = sorted(set(b) - set(a))
        raise SchemaChangeError(f"schema change: missing {missing}, new {extra}")


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           deleted_keys: DataFrame | None = None) -> DataFrame:
    """INC-3 (merge by unique key) / INC-4 (no target: the batch is the
    table).  Matched keys take the batch row, new keys are inserted, keys in
    ``deleted_keys`` are removed."""
    if target is None:
        return batch
    check_schema(target.schema, batch.schema)
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    if deleted_keys is not None:
        kept = kept.join(deleted_keys.select(*keys), list(keys), "left_anti")
    return kept.unionByName(batch)


def backfill(target: DataFrame, recomputed: DataFrame, in_slice: Column) -> DataFrame:
    """INC-8: replace exactly the rows of one slice (``in_slice`` evaluated on
    the rows) with their recomputation."""
    return target.filter(~F.coalesce(in_slice, F.lit(False))).unionByName(
        recomputed.filter(F.coalesce(in_slice, F.lit(False))))


def affected_keys(changed_old: DataFrame, changed_new: DataFrame, key: str) -> DataFrame:
    """SEM-5: downstream keys touched by a batch - the key values before and
    after the change (an account moved between customers touches both)."""
    return changed_old.select(key).unionByName(changed_new.select(key)).filter(F.col(key).isNotNull()).distinct()


def replace_keys(target: DataFrame, fresh: DataFrame, keys_df: DataFrame, key: str) -> DataFrame:
    """Every key in ``keys_df`` is removed from ``target``; ``fresh`` (the
    recomputed rows of exactly those keys) is added.  Upserts changed keys
    and deletes keys with no fresh row, in one anti-join and a union."""
    check_schema(target.schema, fresh.schema)
    return target.join(keys_df, key, "left_anti").unionByName(fresh)


def refresh_keys(target: DataFrame, detail: DataFrame, keys_df: DataFrame, key: str,
                 aggregate) -> DataFrame:
    """SEM-5/7: recompute ``aggregate(detail)`` for the affected keys from
    *all* their detail rows (semi-join first, so only those keys are
    aggregated) and replace them in ``target``.  Every affected key is
    removed from the target and the fresh rows are added, which upserts
    changed keys and deletes keys that no longer qualify in one pass.  The
    key set is small next to the tables; AQE broadcasts it when its measured
    size allows, so neither big side is shuffled for the semi/anti joins."""
    return replace_keys(target, aggregate(detail.join(keys_df, key, "left_semi")), keys_df, key)
