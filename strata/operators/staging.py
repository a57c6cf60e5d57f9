"""Source and staging layers (PRJ-1..7, FLT-4).

Raw text -> ``src_*`` (rename, cast to string, stamp load time) -> validated
and typed ``stg_*``.  All expressions are built-ins; the only shuffle in this
layer is none at all: validation is row-local.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import quarantine as Q

# Raw header -> source column names.
CUSTOMER_RAW_NAMES = {"CustomerID": "customer_id", "Name": "name", "HasLoan": "has_loan"}
ACCOUNT_RAW_NAMES = {"AccountID": "account_id", "CustomerID": "customer_id",
                     "Balance": "balance", "AccountType": "account_type"}


def rename_cast(df: DataFrame, mapping: Mapping[str, str], loaded_at: Column | None = None) -> DataFrame:
    """PRJ-1/PRJ-2: ``select(cast(old as string) as new, ..., run_ts as loaded_at)``."""
    cols = [F.col(f"`{old}`").cast("string").alias(new) for old, new in mapping.items()]
    if loaded_at is not None:
        cols.append(loaded_at.alias("loaded_at"))
    if Q.MALFORMED in df.columns:
        cols.append(F.col(Q.MALFORMED))
    return df.select(*cols)


def clean_customers(valid_src: DataFrame, id_type: str = "int") -> DataFrame:
    """stg_customer from rows that passed :func:`customer_rules`."""
    return valid_src.select(
        C.to_int("customer_id", id_type).alias("customer_id"),
        C.norm("name").alias("customer_name"),
        C.loan_flag("has_loan").alias("has_loan_flag"),
        F.col("loaded_at"),
    )


def clean_accounts(valid_src: DataFrame, id_type: str = "int") -> DataFrame:
    """stg_account from rows that passed :func:`account_rules`.  The
    null-token filter (FLT-4) is implied by the rules and kept as a guard."""
    return (valid_src
            .filter(~C.is_blank("balance") & ~C.norm("balance").isin(*C.BALANCE_NULL_TOKENS))
            .select(
                F.trim("account_id").alias("account_id"),
                C.to_int("customer_id", id_type).alias("customer_id"),
                C.to_money(C.null_tokens("balance")).alias("balance_amount"),
                C.norm("account_type").alias("account_type"),
                F.col("loaded_at"),
            ))


def stage_customers(src: DataFrame, quarantined_at: Column, id_type: str = "int"
                    ) -> tuple[DataFrame, DataFrame]:
    """``(stg_customer, quarantine_stg_customer)`` from ``src_customer``."""
    valid, rejected = Q.split(src, Q.malformed_rule(src) + Q.customer_rules(id_type=id_type), quarantined_at)
    return clean_customers(valid, id_type), rejected


def stage_accounts(src: DataFrame, quarantined_at: Column, id_type: str = "int"
                   ) -> tuple[DataFrame, DataFrame]:
    """``(stg_account, quarantine_stg_account)`` from ``src_account``."""
    valid, rejected = Q.split(src, Q.malformed_rule(src) + Q.account_rules(id_type=id_type), quarantined_at)
    return clean_accounts(valid, id_type), rejected
