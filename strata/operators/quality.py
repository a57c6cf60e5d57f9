"""Data-quality checks (DQ-1..24) and the suite runner.

Every check is ``DataFrame(s) -> violations DataFrame``: an empty result
passes.  A suite turns checks into result rows
``(run_id, table_name, layer, test_name, column_name, severity, violations,
status, message)`` without collecting data: row-level checks on one table
are fused into a single ``agg(count_if(...))`` pass (one scan, one tiny
shuffle per table), and checks that need a shuffle of their own (unique,
relationships, overlap) are separate aggregates.  The results frame is a
union of one-row aggregates - its size is the number of checks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import ordered
from strata.operators.scd2 import SCD_ID, VFROM, VTO

# Fixed value: far-future stand-in for an open period in comparisons only.
OPEN_END = "9999-12-31 00:00:00"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- row-level conditions (fusable) -------------------------------------------

def cond_not_null(col: str) -> Column:
    """DQ-1 violation condition."""
    return F.col(col).isNull()


def cond_not_accepted(col: str | Column, values: Sequence) -> Column:
    """DQ-3: value outside the accepted list; NULL is not a violation."""
    return F.coalesce(~_c(col).isin(*values), F.lit(False))


def cond_not_positive(col: str) -> Column:
    """DQ-5: ``<= 0`` or NULL."""
    return F.col(col).isNull() | (F.col(col) <= 0)


def cond_out_of_dates(col: str, lo: str | None = None, hi: str | None = None) -> Column:
    """DQ-6: NULL, before ``lo`` or after ``hi``."""
    c = F.col(col).isNull()
    if lo:
        c = c | (F.col(col) < F.lit(lo).cast("timestamp"))
    if hi:
        c = c | (F.col(col) > F.lit(hi).cast("timestamp"))
    return c


def cond_not_true(expr: str | Column) -> Column:
    """DQ-7 (SQL form): the expression is false; NULL passes."""
    e = F.expr(expr) if isinstance(expr, str) else expr
    return F.coalesce(~e, F.lit(False))


def cond_out_of_range(col: str, lo, hi) -> Column:
    """DQ-22 accepted_range: outside ``[lo, hi]``; NULL passes."""
    c = F.col(col)
    return F.coalesce((c < F.lit(lo)) | (c > F.lit(hi)), F.lit(False))


# --- violation frames ---------------------------------------------------------

def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(cond_not_null(col))


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """DQ-2: key values occurring more than once (NULL keys ignored).
    Partial aggregate per partition first, so a hot key costs one row per
    map task in the shuffle."""
    nn = None
    for c in cols:
        nn = F.col(c).isNotNull() if nn is None else nn & F.col(c).isNotNull()
    return (df.filter(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, col: str | Column, values: Sequence, name: str = "value") -> DataFrame:
    """DQ-3: violating values with their counts."""
    v = _c(col).alias(name)
    return df.select(v).filter(cond_not_accepted(name, values)).groupBy(name).agg(
        F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """DQ-4 / JON-7: child rows whose non-NULL key has no parent.  A
    left-anti join; AQE broadcasts the parent keys only when measured small."""
    keys = parent.select(F.col(field_).alias(col)).distinct()
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def positive_value(df: DataFrame, col: str) -> DataFrame:
    """DQ-5: non-positive or NULL values grouped with their counts."""
    return (df.filter(cond_not_positive(col)).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("violation_count")))


def valid_date_range(df: DataFrame, col: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """DQ-6: out-of-range or NULL dates grouped with their counts."""
    return (df.filter(cond_out_of_dates(col, lo, hi)).groupBy(F.col(col).alias("date_value"))
            .agg(F.count(F.lit(1)).alias("violation_count")))


def expression_is_true(df: DataFrame, expr: str | Column) -> DataFrame:
    """DQ-7: rows where the expression is false."""
    return df.filter(cond_not_true(expr))


def accepted_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """DQ-22."""
    return df.filter(cond_out_of_range(col, lo, hi))


def scd2_overlap(history: DataFrame, keys: Sequence[str], segment_seconds: int | None = None) -> DataFrame:
    """DQ-8: versions whose period starts before the latest end among the
    earlier versions of the same key (ordered by start, then end).  Each
    overlapping version is reported once, with the end it runs into - no
    pair enumeration, so a hot key with many versions stays linear.  With
    ``segment_seconds`` the running max is computed per time segment and
    stitched (see :mod:`strata.operators.ordered`)."""
    h = history.withColumn("_end", F.coalesce(F.col(VTO), F.lit(OPEN_END).cast("timestamp")))
    seg = ordered.time_segment(VFROM, segment_seconds) if segment_seconds else None
    pm = ordered.prefix_max(h, keys, [VFROM, "_end", SCD_ID], "_end", "prev_max_end", seg)
    return pm.filter(F.col(VFROM) < F.col("prev_max_end")).select(
        *keys, SCD_ID, VFROM, VTO, "prev_max_end")


def open_versions(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-9: keys with more than one open version."""
    return (history.filter(F.col(VTO).isNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("open_versions")).filter(F.col("open_versions") > 1))


def interval_order(history: DataFrame, now: Column) -> DataFrame:
    """DQ-11 / DQ-12: open versions starting after ``now`` and closed
    versions that do not end after they start."""
    future = F.col(VTO).isNull() & (F.col(VFROM) > now)
    inverted = F.col(VTO).isNotNull() & (F.col(VTO) <= F.col(VFROM))
    return history.filter(future | inverted).withColumn(
        "problem", F.when(future, F.lit("open version starts in the future"))
        .otherwise(F.lit("closed version does not end after it starts")))


def recency(df: DataFrame, col: str, now: Column, max_age_hours: int) -> DataFrame:
    """DQ-10 / DQ-24: one row: the latest value, its age in hours and whether
    it is older than the limit (an empty table is stale)."""
    return df.agg(F.max(col).cast("timestamp").alias("max_value")).select(
        "max_value",
        ((F.unix_micros(now.cast("timestamp")) - F.unix_micros("max_value")) / F.lit(3_600_000_000)
         ).cast("decimal(18,2)").alias("age_hours"),
        F.lit(max_age_hours).alias("max_age_hours"),
        F.coalesce(F.col("max_value") < now - F.make_interval(hours=F.lit(max_age_hours)), F.lit(True)).alias("is_stale"))


def _misses(key: str, values: dict[str, tuple[Column, Column]], tol: str) -> Column:
    """``inline`` of the values that miss their expectation by more than
    ``tol`` (or are NULL on one side): key, measure, actual, expected."""
    wide = "decimal(38,4)"
    rows = F.array(*[F.struct(F.col(key).alias(key), F.lit(m).alias("measure"), a.cast(wide).alias("actual"), e.cast(wide).alias("expected"))
                     for m, (a, e) in values.items()])
    off = lambda r: F.coalesce(F.abs(r["actual"] - r["expected"]) > F.lit(Decimal(tol)),
                               r["actual"].isNull() != r["expected"].isNull())
    return F.inline(F.filter(rows, off))


def stale(col: str, now: Column, max_age_hours: int) -> Column:
    """DQ-10 as a fusable aggregate: 1 if the latest value is too old or
    there is none."""
    late = F.max(col).cast("timestamp") < now - F.make_interval(hours=F.lit(max_age_hours))
    return F.when(F.coalesce(late, F.lit(True)), F.lit(1)).otherwise(F.lit(0))


def rate_range(summary: DataFrame, lo: str = "0.01", hi: str = "0.025") -> DataFrame:
    """DQ-13."""
    r = F.col("interest_rate_pct")
    return summary.filter((r < F.lit(Decimal(lo))) | (r > F.lit(Decimal(hi)))).select("account_id", "interest_rate_pct")


def recompute(summary: DataFrame, tol: str = "0.01") -> DataFrame:
    """DQ-14/15/16: interest and new balance computed again from their inputs;
    one row per account and amount that is off by more than ``tol``."""
    balance, interest = F.col("original_balance_amount"), F.col("annual_interest_amount")
    return summary.select(_misses("account_id", {
        "annual_interest_amount": (interest, F.round(balance * F.col("interest_rate_pct"), 2)),
        "new_balance_amount": (F.col("new_balance_amount"), balance + interest)}, tol))


def reconcile(profile: DataFrame, summary: DataFrame, key: str = "customer_id", tol: str = "0.01") -> DataFrame:
    """DQ-17: profile totals against the detail rows; one row per customer and
    total that is off by more than ``tol``."""
    again = summary.groupBy(key).agg(F.count_distinct("account_id").alias("_n"), F.sum("original_balance_amount").alias("_b"),
                                     F.sum("annual_interest_amount").alias("_i"))
    return profile.join(again, key, "left").select(_misses(key, {
        "total_accounts_count": (F.col("total_accounts_count"), F.col("_n")),
        "total_balance_amount": (F.col("total_balance_amount"), F.col("_b")),
        "total_annual_interest_amount": (F.col("total_annual_interest_amount"), F.col("_i"))}, tol))


def non_positive_balance(joined: DataFrame) -> DataFrame:
    """DQ-18."""
    return joined.filter(F.col("balance_amount") <= 0).select("account_id", "customer_id", "balance_amount")


def savings_missing(joined: DataFrame, savings: DataFrame, type_value: str = "savings") -> DataFrame:
    """DQ-19: rows of a type that are missing downstream."""
    return (joined.filter(F.col("account_type") == F.lit(type_value))
            .join(savings.select("account_id"), "account_id", "left_anti")
            .select("account_id", "customer_id", "balance_amount"))


def row_count_positive(df: DataFrame) -> DataFrame:
    """DQ-23: one violation row when the table is empty."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") == 0)


# --- severity and thresholds ----------------------------------------------------

def status(violations: Column, severity: Column, warn_if: Column, error_if: Column) -> Column:
    """DQ-20/21: ``error`` severity fails above ``error_if`` and warns above
    ``warn_if``; ``warn`` severity only warns."""
    return (F.when((severity == F.lit("error")) & (violations > error_if), F.lit("fail"))
            .when(violations > warn_if, F.lit("warn"))
            .otherwise(F.lit("pass")))


@dataclass
class Check:
    table: str
    test: str
    violations: Callable[[], DataFrame] | None = None  # frame of violating rows
    condition: Column | None = None                     # fusable row condition
    measure: Column | None = None                       # fusable aggregate: the number of violations
    column: str | None = None
    severity: str = "error"
    warn_if: int = 0
    error_if: int = 0


@dataclass
class Suite:
    """Checks grouped by table; ``frames`` maps table name -> DataFrame."""
    frames: dict[str, DataFrame]
    checks: list[Check] = field(default_factory=list)

    def add(self, *checks: Check) -> "Suite":
        self.checks.extend(checks)
        return self

    def results(self, run_id: str) -> DataFrame:
        """One row per check.  Row-level checks of one table share a single
        ``agg(count_if ...)`` whose row is unpivoted with ``stack`` (metadata
        as literals); every other check is one small aggregate.  No joins."""
        from strata.operators.report import layer_of
        parts: list[DataFrame] = []
        fused: dict[str, list[Check]] = {}
        for ch in self.checks:
            if ch.condition is not None or ch.measure is not None:
                fused.setdefault(ch.table, []).append(ch)
            else:
                parts.append(ch.violations().agg(F.count(F.lit(1)).alias("violations"))
                             .select(*_meta_cols(ch), "violations"))
        for table, chs in fused.items():
            counts = self.frames[table].agg(*[(ch.measure if ch.measure is not None else F.count_if(ch.condition)).cast("long").alias(f"c{i}")
                                                   for i, ch in enumerate(chs)])
            rows = ", ".join(f"{_sql_lit(ch.test)}, {_sql_lit(ch.table)}, {_sql_lit(ch.column)}, "
                             f"{_sql_lit(ch.severity)}, {int(ch.warn_if)}, {int(ch.error_if)}, c{i}"
                             for i, ch in enumerate(chs))
            parts.append(counts.selectExpr(
                f"stack({len(chs)}, {rows}) AS (test_name, table_name, column_name, severity, warn_if, "
                f"error_if, violations)"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        st = status(F.col("violations"), F.col("severity"), F.col("warn_if"), F.col("error_if"))
        return out.select(
            F.lit(run_id).alias("run_id"), "table_name", layer_of(F.col("table_name")).alias("layer"),
            "test_name", F.col("column_name").cast("string").alias("column_name"), "severity",
            F.col("violations").cast("long").alias("violations"),
            st.alias("status"),
            F.when(st == F.lit("fail"), F.format_string("%d violating rows; at most %d allowed", "violations", "error_if"))
            .when(st == F.lit("warn"), F.format_string("%d violating rows; warning above %d", "violations", "warn_if"))
            .alias("message"))

    def samples(self, results: DataFrame, run_id: str, n: int = 10) -> DataFrame | None:
        """SRT-4: up to ``n`` failing rows, as JSON, of every check that did not
        pass in ``results``; None if there are none.  Only the checks' names
        reach the driver.  A check that is one aggregate (an age) has no rows."""
        seen = {(r.table_name, r.test_name) for r in results.filter("status <> 'pass'").select("table_name", "test_name").collect()}
        out = None
        for ch in self.checks:
            if (ch.table, ch.test) not in seen or ch.measure is not None:
                continue
            bad = self.frames[ch.table].filter(ch.condition) if ch.condition is not None else ch.violations()
            rows = sample_violations(bad, n)
            rows = rows.select(F.lit(run_id).alias("run_id"), F.lit(ch.table).alias("table_name"), F.lit(ch.test).alias("test_name"),
                               F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("row"))
            out = rows if out is None else out.unionByName(rows)
        return out


def _sql_lit(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("'", "''") + "'"


def _meta_cols(ch: Check) -> list[Column]:
    return [F.lit(ch.test).alias("test_name"), F.lit(ch.table).alias("table_name"),
            F.lit(ch.column).cast("string").alias("column_name"), F.lit(ch.severity).alias("severity"),
            F.lit(int(ch.warn_if)).alias("warn_if"), F.lit(int(ch.error_if)).alias("error_if")]



def sample_violations(violations: DataFrame, n: int = 10) -> DataFrame:
    """SRT-4: a bounded sample of failing rows for a report (the limit is
    the feature: the full violation count comes from the suite)."""
    return violations.limit(n)
