"""Rule-based validation with a quarantine output (FLT-1..4, JON-3).

One pass computes ``failure_reason`` (the first failing rule, NULL = valid);
valid and rejected rows are the two sides of a filter on that column.  No
join is needed: every rule treats NULL and '' alike, so the single pass is
equal to the "source minus quarantine on null-as-blank tuples" anti-join
(:func:`quarantine_antijoin` keeps that form as a cross-check).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import columns as C

Rule = tuple[Column, Column]  # (condition that marks a failure, reason text)

# Failure reason texts of the customer and account rules.
R_CUST_ID_BLANK = "Invalid customer_id: null or empty"
R_CUST_ID_TEXT = "Invalid customer_id: non-numeric value ("
R_NAME_BLANK = "Invalid name: null or empty"
R_LOAN = "Invalid has_loan value: "
R_ACCT_ID_BLANK = "Invalid account_id: null or empty"
R_BAL_BLANK = "Invalid balance: null or empty"
R_BAL_TOKEN = "Invalid balance: null representation ("
R_BAL_TEXT = "Invalid balance: non-numeric value ("
R_BAL_NEG = "Invalid balance: negative value ("
R_TYPE_BLANK = "Invalid account_type: null or empty"
R_TYPE = "Invalid account_type: must be Savings or Checking ("


# Column of raw records that do not have the header's number of fields.
MALFORMED = "malformed_record"


def malformed_rule(src: DataFrame) -> list[Rule]:
    """The first rule of sources read from files: the record has as many
    fields as the header."""
    if MALFORMED not in src.columns:
        return []
    return [(F.col(MALFORMED).isNotNull(), C.reason("Invalid record: wrong number of fields (", MALFORMED, ")"))]


def customer_rules(id_col="customer_id", name_col="name", loan_col="has_loan",
                   id_type: str = "int") -> list[Rule]:
    """FLT-1, in priority order.  NULL has_loan is accepted (``NULL NOT IN``
    is NULL in the original rule, which does not fire)."""
    return [
        (C.is_blank(id_col), C.reason(R_CUST_ID_BLANK)),
        (C.to_int(id_col, id_type).isNull(), C.reason(R_CUST_ID_TEXT, id_col, ")")),
        (C.is_blank(name_col), C.reason(R_NAME_BLANK)),
        (~C.norm(loan_col).isin(*C.LOAN_ACCEPTED), C.reason(R_LOAN, loan_col)),
    ]


def account_rules(id_col="account_id", cust_col="customer_id", bal_col="balance",
                  type_col="account_type", id_type: str = "int") -> list[Rule]:
    """FLT-2, in priority order."""
    money = C.to_money(bal_col)
    return [
        (C.is_blank(id_col), C.reason(R_ACCT_ID_BLANK)),
        (C.is_blank(cust_col), C.reason(R_CUST_ID_BLANK)),
        (C.to_int(cust_col, id_type).isNull(), C.reason(R_CUST_ID_TEXT, cust_col, ")")),
        (C.is_blank(bal_col), C.reason(R_BAL_BLANK)),
        (C.norm(bal_col).isin(*C.BALANCE_NULL_TOKENS), C.reason(R_BAL_TOKEN, bal_col, ")")),
        (money.isNull(), C.reason(R_BAL_TEXT, bal_col, ")")),
        (money < F.lit(0), C.reason(R_BAL_NEG, bal_col, ")")),
        (C.is_blank(type_col), C.reason(R_TYPE_BLANK)),
        (~C.norm(type_col).isin(*C.ACCOUNT_TYPES), C.reason(R_TYPE, type_col, ")")),
    ]


def failure_reason(rules: Sequence[Rule]) -> Column:
    """First failing rule's reason; NULL when every rule passes."""
    return C.first_match(rules)


def with_failure_reason(df: DataFrame, rules: Sequence[Rule], name: str = "failure_reason") -> DataFrame:
    return df.withColumn(name, failure_reason(rules))


def any_failure(rules: Sequence[Rule]) -> Column:
    """True when some rule fails (never NULL)."""
    out = None
    for cond, _ in rules:
        c = F.coalesce(cond, F.lit(False))
        out = c if out is None else out | c
    return out if out is not None else F.lit(False)


def split(df: DataFrame, rules: Sequence[Rule], quarantined_at: Column | None = None
          ) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rejected carries the input columns plus
    ``failure_reason`` and ``quarantined_at`` (FLT-3).

    The valid side filters on the plain OR of the rule conditions; the
    reason text (a CASE with string concatenation) is only built for rejected
    rows.  Both sides are row-local filters of one input; writing both with
    :func:`strata.sinks.writers.write_split` scans the input once."""
    bad = any_failure(rules)
    valid = df.filter(~bad)
    rejected = df.filter(bad).withColumn("failure_reason", failure_reason(rules))
    if quarantined_at is not None:
        rejected = rejected.withColumn("quarantined_at", quarantined_at)
    return valid, rejected


def quarantine_failed_records(df: DataFrame, predicate: str | Column, reason_text: str | None = None,
                              quarantined_at: Column | None = None) -> DataFrame:
    """Generic macro form (FLT-3): rows matching ``predicate`` with the rule
    text as ``failure_reason``."""
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    text = reason_text if reason_text is not None else (predicate if isinstance(predicate, str) else "rule")
    out = df.filter(F.coalesce(cond, F.lit(False))).withColumn("failure_reason", F.lit(text))
    if quarantined_at is not None:
        out = out.withColumn("quarantined_at", quarantined_at)
    return out


def quarantine_antijoin(source: DataFrame, rejected: DataFrame, cols: Sequence[str]) -> DataFrame:
    """JON-3: source rows with no quarantined row equal on every listed
    column, NULL compared as ''.  Kept as the cross-check of :func:`split`;
    rejected is small relative to source, and AQE broadcasts it only when its
    measured size is under the threshold."""
    s = source.select("*", *[F.coalesce(F.col(c), F.lit("")).alias(f"_k_{c}") for c in cols])
    q = rejected.select(*[F.coalesce(F.col(c), F.lit("")).alias(f"_k_{c}") for c in cols]).distinct()
    keys = [f"_k_{c}" for c in cols]
    return s.join(q, keys, "left_anti").drop(*keys)
