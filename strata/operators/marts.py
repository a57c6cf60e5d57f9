"""Intermediate and mart layers (JON-1/2, FLT-5/6, PRJ-11..13, AGG-1..10, SRT-2).

Join strategy: every join here is an equi-join on a declared key and is left
to Catalyst + AQE.  The statically planned strategy is sort-merge; AQE
switches to a broadcast hash join only after it has *measured* the smaller
side below ``spark.sql.autoBroadcastJoinThreshold`` - that is the size check,
so no unconditional ``broadcast()`` hint appears on data-sized inputs.  Hot
keys (one customer owning a third of all accounts) are split by AQE's skew
join on the sort-merge path; aggregations are partial (map-side) first, so a
hot group is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.deltas import Totals


def current(history: DataFrame, valid_to: str = "dbt_valid_to") -> DataFrame:
    """FLT-5 / QRY-1: open versions only."""
    return history.filter(F.col(valid_to).isNull())


def account_with_customer(accounts: DataFrame, customers: DataFrame,
                          key: str = "customer_id",
                          valid_from: str = "dbt_valid_from", valid_to: str = "dbt_valid_to") -> DataFrame:
    """JON-1: current accounts joined to current customers on ``key``;
    orphan accounts drop out.  Inputs are history tables (or staging tables
    with the two validity columns)."""
    a = accounts.filter(F.col(valid_to).isNull()).select(
        "account_id", key, "balance_amount", "account_type",
        F.col(valid_from).alias("valid_from_at"), F.col(valid_to).alias("valid_to_at"))
    c = customers.filter(F.col(valid_to).isNull()).select(key, "customer_name", "has_loan_flag")
    return a.join(c, key, "inner").select(
        "account_id", key, "balance_amount", "account_type", "customer_name", "has_loan_flag",
        "valid_from_at", "valid_to_at")


def savings_only(joined: DataFrame, account_type: str = "savings") -> DataFrame:
    """FLT-6: one account type, the type column dropped."""
    return joined.filter(F.col("account_type") == F.lit(account_type)).select(
        "account_id", "customer_id", "customer_name", "balance_amount", "has_loan_flag",
        "valid_from_at", "valid_to_at")


def account_summary(savings: DataFrame, calculated_at: Column) -> DataFrame:
    """PRJ-11..13: tiered + bonus rate, interest and new balance, in exact
    decimals.  Row-local: no shuffle."""
    rate = (C.tier_rate("balance_amount") + C.bonus_rate("has_loan_flag")).cast(C.RATE)
    return (savings
            .select("account_id", "customer_id",
                    F.col("balance_amount").cast(C.MONEY).alias("original_balance_amount"),
                    rate.alias("interest_rate_pct"))
            .withColumn("annual_interest_amount", C.interest("original_balance_amount", "interest_rate_pct"))
            .withColumn("new_balance_amount",
                        C.new_balance("original_balance_amount", "annual_interest_amount"))
            .withColumn("calculated_at", calculated_at))


def customer_totals(summary: DataFrame, key: str = "customer_id") -> DataFrame:
    """AGG-1 core: accounts, balance and interest per customer.

    Accounts are counted once each, whatever the input repeats (SEM-16)."""
    return summary.groupBy(key).agg(
        F.count_distinct("account_id").alias("total_accounts_count"),
        F.sum("original_balance_amount").cast(C.MONEY_SUM).alias("total_balance_amount"),
        F.sum("annual_interest_amount").cast(C.MONEY_SUM).alias("total_annual_interest_amount"),
        F.max("calculated_at").alias("calculated_at"))


def customer_profile(summary: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """AGG-1/AGG-2/JON-2: per-customer totals left-joined to the customer's
    attributes.  Attributes come from the customer table (one row per key),
    never from ``DISTINCT`` over account rows, so each customer yields exactly
    one row (SEM-7)."""
    return with_attributes(customer_totals(summary, key), customers, key)


def with_attributes(totals: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers' totals with their attributes, one row per customer."""
    attrs = customers.select(key, "customer_name", "has_loan_flag")
    return totals.join(attrs, key, "left").select(
        key, "customer_name", "has_loan_flag", "total_accounts_count",
        "total_balance_amount", "total_annual_interest_amount", "calculated_at")


# The totals of ``customer_totals`` as a view kept by changes (accounts are
# unique by then: the contract of the summary).
PROFILE_TOTALS = Totals("customer_id", "total_accounts_count",
                        {"total_balance_amount": "original_balance_amount", "total_annual_interest_amount": "annual_interest_amount"},
                        {"calculated_at": "calculated_at"}, C.MONEY_SUM)


def distinct_attributes(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-2: ``SELECT DISTINCT`` (partial distinct per partition first)."""
    return df.select(*cols).distinct()


def tier_summary(summary: DataFrame) -> DataFrame:
    """AGG-8: count, total and mean interest per rate tier."""
    return summary.groupBy("interest_rate_pct").agg(
        F.count(F.lit(1)).alias("accounts_count"),
        F.sum("original_balance_amount").cast(C.MONEY_SUM).alias("total_balance_amount"),
        F.sum("annual_interest_amount").cast(C.MONEY_SUM).alias("total_interest_amount"),
        F.avg("annual_interest_amount").cast("decimal(18,4)").alias("avg_interest_amount"))


def top_k(df: DataFrame, k: int, by: str, tiebreak: str) -> DataFrame:
    """SRT-2: top ``k`` rows by ``by`` descending, ties broken by ``tiebreak``
    so the result is deterministic.  ``orderBy().limit()`` plans as
    TakeOrderedAndProject: each partition keeps k rows, the final merge sees
    k x partitions rows - bounded, independent of data size."""
    return df.orderBy(F.col(by).desc(), F.col(tiebreak).asc()).limit(k)


def group_average_compare(df: DataFrame, group: str, measure: str) -> DataFrame:
    """AGG-9: per-group average against the overall average.

    One scan: a rollup gives every group's sum and count and, as its top
    level, the overall ones, which meet in a window over the (few) groups."""
    per = (df.rollup(group).agg(F.avg(measure).alias("group_avg"), F.count(F.lit(1)).alias("rows_count"), F.grouping_id().alias("_top"))
           .withColumn("_overall", F.max(F.when(F.col("_top") == 1, F.col("group_avg"))).over(Window.partitionBy(F.lit(1))))
           .filter(F.col("_top") == 0))
    ov = F.col("_overall")
    return per.select(group, "rows_count",
                      F.col("group_avg").cast("decimal(18,2)").alias("group_avg"),
                      ov.cast("decimal(18,2)").alias("overall_avg"),
                      F.when(F.col("group_avg") > ov, F.lit("above"))
                      .when(F.col("group_avg") < ov, F.lit("below"))
                      .otherwise(F.lit("equal")).alias("position"))


def latest_per_key(df: DataFrame, key: str, order: str, value: str, alias: str = "latest") -> DataFrame:
    """AGG-10: latest value per key by an ordering column (``max_by``),
    a partial aggregate - not ``max`` of a hash."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(alias))


def in_subquery(df: DataFrame, col_: str, other: DataFrame, other_col: str) -> DataFrame:
    """FLT-9: ``col IN (SELECT other_col FROM other)`` as a left-semi join."""
    return df.join(other.select(F.col(other_col).alias("_in_k")), F.col(col_) == F.col("_in_k"), "left_semi")


def not_in_subquery(df: DataFrame, col_: str, other: DataFrame, other_col: str) -> DataFrame:
    """FLT-8: SQL ``col NOT IN (SELECT other_col FROM other)`` with its NULL
    semantics: a NULL in the subquery makes the predicate unknown for every
    row (no rows pass) and a NULL ``col`` never passes, unless the subquery is
    empty.  One count of the subquery decides which case it is; the rest is an
    ordinary anti join that shuffles, so no side is broadcast unmeasured."""
    keys = other.select(F.col(other_col).alias("_k"))
    some = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_k").isNull()).alias("nulls")).first()
    if some["n"] == 0:
        return df
    if some["nulls"]:
        return df.filter(F.lit(False))
    return df.filter(F.col(col_).isNotNull()).join(keys, F.col(col_) == F.col("_k"), "left_anti")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT-3: the first ``n`` rows (a limit; the feature itself)."""
    return df.limit(n)
