"""Column functions (``Column -> Column``), all JVM-side built-ins.

These are the reusable cleaning/parsing/business expressions of the pipeline.
None of them is a Python UDF, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the pipeline's documented token sets, tier
# bounds and rates for results to agree.
# ---------------------------------------------------------------------------
NULL_TOKENS = ("null", "n/a", "", "none")
BALANCE_NULL_TOKENS = ("null", "n/a", "none")
TRUE_TOKENS = ("yes", "y", "true", "1")
FALSE_TOKENS = ("no", "n", "false", "0", "none")
# has_loan values accepted by customer validation: the true and false tokens
# plus the empty string.
LOAN_ACCEPTED = ("yes", "y", "true", "1", "no", "n", "false", "0", "none", "")
ACCOUNT_TYPES = ("savings", "checking")
# Tiered base rate: balance < 10000 -> 0.01; < 20000 -> 0.015; else 0.02.
RATE_TIERS = ((Decimal("10000"), Decimal("0.01")),
              (Decimal("20000"), Decimal("0.015")),
              (None, Decimal("0.02")))
LOAN_BONUS_RATE = Decimal("0.005")
NO_BONUS_RATE = Decimal("0.0")
# ---------------------------------------------------------------------------

MONEY = "decimal(18,2)"
# Sums of money: one hot customer may own a third of all accounts, so totals
# get the widest precision instead of the row type.
MONEY_SUM = "decimal(38,2)"
RATE = "decimal(5,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: str | Column) -> Column:
    """``lower(trim(c))`` (PRJ-3)."""
    return F.lower(F.trim(col(c)))


def is_blank(c: str | Column) -> Column:
    """NULL or empty after trim; never NULL itself."""
    c = col(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def to_int(c: str | Column, type_: str = "int") -> Column:
    """Safe integer parse (PRJ-4): integer text only, else NULL."""
    return col(c).try_cast(type_)


def to_money(c: str | Column) -> Column:
    """Safe decimal(18,2) parse (PRJ-5), HALF_UP to two places."""
    return col(c).try_cast(MONEY)


def to_double(c: str | Column) -> Column:
    """Lenient numeric coercion, bad text -> NULL (PRJ-25)."""
    return col(c).try_cast("double")


def null_tokens(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null-token text to NULL, other values unchanged (PRJ-6)."""
    c = col(c)
    return F.when(norm(c).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def loan_flag(c: str | Column, true_values: Sequence[str] = TRUE_TOKENS) -> Column:
    """Staging boolean: recognised true tokens -> true, everything else
    (including NULL and unrecognised text) -> false (PRJ-7)."""
    return F.coalesce(norm(c).isin(*true_values), F.lit(False))


def standardize_boolean(c: str | Column,
                        true_values: Sequence[str] = TRUE_TOKENS,
                        false_values: Sequence[str] = FALSE_TOKENS) -> Column:
    """Three-valued boolean normalisation (PRJ-8): unrecognised -> NULL."""
    n = norm(c)
    return (F.when(col(c).isNull(), F.lit(None).cast("boolean"))
            .when(n.isin(*true_values), F.lit(True))
            .when(n.isin(*false_values), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def clean_string(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null tokens -> NULL, else trimmed lowercase (PRJ-9)."""
    c = col(c)
    return F.when(c.isNull() | norm(c).isin(*tokens), F.lit(None).cast("string")).otherwise(norm(c))


def tier_rate(balance: str | Column, tiers=RATE_TIERS) -> Column:
    """Tiered base rate (PRJ-11) from a ``(upper_bound, rate)`` table whose
    last row has bound ``None``.  NULL balance -> NULL rate."""
    b = col(balance)
    expr = None
    for bound, rate in tiers:
        cond = b.isNotNull() if bound is None else (b < F.lit(bound))
        expr = F.when(cond, F.lit(rate)) if expr is None else expr.when(cond, F.lit(rate))
    return expr.cast(RATE)


def bonus_rate(flag: str | Column, bonus: Decimal = LOAN_BONUS_RATE) -> Column:
    """Bonus rate iff the flag is true; NULL or false -> 0.0 (PRJ-12)."""
    return F.when(col(flag) == F.lit(True), F.lit(bonus)).otherwise(F.lit(NO_BONUS_RATE)).cast(RATE)


def interest(balance: str | Column, rate: str | Column) -> Column:
    """``round(balance * rate, 2)`` as money (PRJ-13, HALF_UP)."""
    return F.round(col(balance) * col(rate), 2).cast(MONEY)


def new_balance(balance: str | Column, interest_: str | Column) -> Column:
    """``round(balance + interest, 2)`` as money (PRJ-13)."""
    return F.round(col(balance) + col(interest_), 2).cast(MONEY)


def reason(prefix: str, value: str | Column | None = None, suffix: str = "") -> Column:
    """Failure reason text with the offending value (PRJ-15).

    Like SQL ``||``, a NULL value makes the whole text NULL; rules that
    embed a value only fire when it is present.
    """
    if value is None:
        return F.lit(prefix)
    parts = [F.lit(prefix), col(value)] + ([F.lit(suffix)] if suffix else [])
    return F.concat(*parts)


def first_match(rules: Iterable[tuple[Column, Column]], default: Column | None = None) -> Column:
    """Searched CASE with priority: the first rule whose condition holds
    gives the value (PRJ-16).  ``rules`` is ``[(condition, value), ...]``."""
    expr = None
    for cond, value in rules:
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def days_before(ts: str | Column, n: int) -> Column:
    """``dateadd(day, -n, ts)`` (PRJ-17)."""
    return col(ts) - F.make_interval(days=F.lit(n))


def hours_before(ts: str | Column, n: int) -> Column:
    """``ts - INTERVAL n HOURS`` (PRJ-21)."""
    return col(ts) - F.make_interval(hours=F.lit(n))


def ts_literal(value: str) -> Column:
    """Timestamp literal such as the 1900-01-01 watermark default (PRJ-18)."""
    return F.lit(value).cast("timestamp")


def within(a: str | Column, b: str | Column, tol: str = "0.01") -> Column:
    """``abs(a - b) < tol`` (PRJ-19)."""
    return F.abs(col(a) - col(b)) < F.lit(Decimal(tol))


def is_current(valid_to: str | Column = "dbt_valid_to") -> Column:
    """``valid_to IS NULL`` (PRJ-20)."""
    return col(valid_to).isNull()


def padded_key(prefix: str, n: str | Column, width: int) -> Column:
    """``prefix || lpad(cast(n as string), width, '0')`` (PRJ-22)."""
    return F.concat(F.lit(prefix), F.lpad(col(n).cast("string"), width, "0"))


def version_id(key_cols: Sequence[str | Column], valid_from: str | Column, tiebreak: str | Column | None = None) -> Column:
    """Deterministic version surrogate id (SCD-6, PRJ-23): md5 of the key
    parts, the start in epoch microseconds and, for change logs, the tiebreak.
    Every part is written as its length, a colon and its text (NULL as ``-``),
    so different keys never give one string."""
    parts = [col(k).cast("string") for k in key_cols]
    parts.append(F.unix_micros(col(valid_from).cast("timestamp")).cast("string"))
    if tiebreak is not None:
        parts.append(col(tiebreak).cast("string"))
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))


def proper_name(c: str | Column) -> Column:
    """Older documented staging form of names: trimmed, each word
    capitalised (PRJ-24)."""
    return F.initcap(F.trim(col(c)))
