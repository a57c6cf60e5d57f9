"""Aggregates kept up to date from row changes alone (AGG-1, INC-3).

Counting-based view maintenance: a change is the row as it was (sign -1), as
it is now (sign +1), or both.  A group's row count and sums move by the signed
sums of its changes, and a group whose count falls to zero goes.  Neither the
groups without changes nor the detail rows of any group are read.  Only a
``max`` can need them: when a removed row held it and no added row reaches it,
the groups concerned - and no others - are looked up in the details.

Summed columns hold no nulls (a not-null contract of the marts); a null raises
rather than leave the total wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.scd2 import VFROM, VTO
from strata.session import materialize

SIGN = "_sign"


def row_changes(target: DataFrame, batch: DataFrame, keys: Sequence[str], deleted_keys: DataFrame | None = None) -> DataFrame:
    """Pre- and post-images of merging ``batch`` into ``target`` by ``keys``
    (see :func:`strata.operators.incremental.upsert`)."""
    gone = batch.select(*keys)
    if deleted_keys is not None:
        gone = gone.unionByName(deleted_keys.select(*keys)).distinct()
    before = target.join(gone, list(keys), "left_semi").select(*batch.columns)
    return before.withColumn(SIGN, F.lit(-1)).unionByName(batch.withColumn(SIGN, F.lit(1)))


def version_changes(opened: DataFrame, closed: DataFrame, run_ts: Column) -> DataFrame:
    """Pre- and post-images of a snapshot merge: versions the run closed and
    versions it opened."""
    pre = closed.filter(F.col(VTO) == run_ts).withColumn(SIGN, F.lit(-1))
    return pre.unionByName(opened.filter(F.col(VFROM) == run_ts).withColumn(SIGN, F.lit(1)))


@dataclass
class Totals:
    """A grouped aggregate: count of rows, sums and maxima per ``key``."""
    key: str
    count: str
    sums: Mapping[str, str] = field(default_factory=dict)  # total -> detail column
    maxima: Mapping[str, str] = field(default_factory=dict)
    sum_type: str = "decimal(38,2)"

    def build(self, detail: DataFrame) -> DataFrame:
        return detail.groupBy(self.key).agg(
            F.count(F.lit(1)).alias(self.count),
            *(F.sum(c).cast(self.sum_type).alias(t) for t, c in self.sums.items()),
            *(F.max(c).alias(t) for t, c in self.maxima.items()))

    def changes(self, rows: DataFrame) -> DataFrame:
        """Per group: signed count and sums, and per maximum the largest added
        and the largest removed value.  Partial aggregates, so a group with a
        third of all changes is one row per task."""
        sign = F.col(SIGN)
        known = lambda c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"null in summed column {c}")).cast("int")).otherwise(sign) * F.col(c)
        return rows.groupBy(self.key).agg(
            F.sum(sign).alias("_n"),
            *(F.sum(known(c)).cast(self.sum_type).alias(f"_d_{t}") for t, c in self.sums.items()),
            *(F.max(F.when(sign > 0, F.col(c))).alias(f"_up_{t}") for t, c in self.maxima.items()),
            *(F.max(F.when(sign < 0, F.col(c))).alias(f"_down_{t}") for t, c in self.maxima.items()))

    def apply(self, totals: DataFrame, rows: DataFrame, details: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
        """``(changed, keys)``: the new rows of the groups that ``rows``
        (signed changes) touch - groups that are empty now have none - and the
        keys of all touched groups.  ``details(keys)`` gives the current
        detail rows of some groups; it is called only if a maximum needs it."""
        moved = materialize(self.changes(rows))
        old = totals.join(moved.select(self.key), self.key, "left_semi")
        both = moved.join(old, self.key, "left")
        zero = F.lit(0)
        columns = {self.count: (F.coalesce(self.count, zero) + F.col("_n")).cast("long")}
        for t in self.sums:
            columns[t] = (F.coalesce(t, zero) + F.col(f"_d_{t}")).cast(self.sum_type)
        open_ = F.lit(False)
        for t in self.maxima:
            up, down, held = F.col(f"_up_{t}"), F.col(f"_down_{t}"), F.col(t)
            # The maximum may fall: a row that held it went, none as high came.
            falls = F.coalesce((down >= held) & ~F.coalesce(up >= held, F.lit(False)), F.lit(False))
            open_ = open_ | falls
            columns[t] = F.greatest(held, up)
        out = materialize(both.select(self.key, open_.alias("_open"), *(c.alias(n) for n, c in columns.items())).filter(F.col(self.count) > 0))
        bad = out.filter(F.col("_open")).select(self.key)
        if self.maxima and details is not None and not bad.isEmpty():
            found = details(bad).join(bad, self.key, "left_semi").groupBy(self.key).agg(*(F.max(c).alias(f"_now_{t}") for t, c in self.maxima.items()))
            out = out.join(found, self.key, "left").select(
                self.key, self.count, *self.sums, *(F.when(F.col("_open"), F.col(f"_now_{t}")).otherwise(F.col(t)).alias(t) for t in self.maxima))
        elif self.maxima and details is None and not bad.isEmpty():
            raise ValueError("a removed row held a maximum: the details are needed")
        return out.select(*totals.columns), moved.select(self.key)


def refresh(totals: DataFrame, changed: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``totals`` with the touched groups replaced."""
    return totals.join(keys, key, "left_anti").unionByName(changed.select(*totals.columns))
