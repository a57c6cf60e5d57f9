"""Adapters from the driver's TPC-H-style tables to the pipeline's inputs.

The pipeline's operators are generic (column names are parameters); these
views map the given tables onto the bank-pipeline shapes:

* ``raw_accounts``  <- ``orders``   (one account per order; text columns, some
  spoiled by a key-based CASE so that every validation rule fires);
* ``raw_customers`` <- ``customer`` (same idea);
* ``change_log``    <- ``events``   (key ``user_id``, tracked ``event_type``).

Each derived column is one SQL expression valid in Spark and in DuckDB, so
the Spark side (``selectExpr``) and the oracle side share one definition.
Every view reads the whole table - nothing is filtered away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.session import prepare_session

# Fixed run parameters of the driver queries (no clocks anywhere).
LOAD_TS = "2024-02-01 00:00:00"
RUN_TS = "2024-02-02 00:00:00"
ID_TYPE = "bigint"

_BAL = "cast(cast(o_totalprice as decimal(18,2)) as string)"

RAW_ACCOUNT_EXPRS = {
    "account_id": "CASE o_orderkey % 101 WHEN 1 THEN NULL WHEN 2 THEN '  ' "
                  "ELSE cast(o_orderkey as string) END",
    "customer_id": "CASE o_orderkey % 101 WHEN 3 THEN '' WHEN 4 THEN 'ABC123' "
                   "WHEN 5 THEN ' ' || cast(o_custkey as string) || ' ' "
                   "WHEN 6 THEN cast(o_custkey as string) || '.5' "
                   "ELSE cast(o_custkey as string) END",
    "balance": f"CASE o_orderkey % 101 WHEN 7 THEN NULL WHEN 8 THEN 'N/A' WHEN 9 THEN 'null' "
               f"WHEN 10 THEN 'ABC123' WHEN 11 THEN '-5.00' WHEN 12 THEN '0.00' "
               f"WHEN 13 THEN ' ' || {_BAL} || ' ' ELSE {_BAL} END",
    "account_type": "CASE WHEN o_orderkey % 101 = 14 THEN '' "
                    "WHEN o_orderkey % 101 = 15 THEN 'Investment' "
                    "WHEN o_orderstatus = 'F' THEN 'Savings' "
                    "WHEN o_orderstatus = 'O' THEN 'Checking' ELSE ' SAVINGS ' END",
}

RAW_CUSTOMER_EXPRS = {
    "customer_id": "CASE c_custkey % 53 WHEN 1 THEN NULL WHEN 2 THEN 'ABC' "
                   "WHEN 3 THEN ' ' || cast(c_custkey as string) || ' ' "
                   "WHEN 4 THEN cast(c_custkey as string) || '.0' "
                   "ELSE cast(c_custkey as string) END",
    "name": "CASE c_custkey % 53 WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN '  ' ELSE c_name END",
    "has_loan": "CASE c_custkey % 53 WHEN 8 THEN 'MAYBE' WHEN 9 THEN NULL WHEN 10 THEN '123' "
                "ELSE CASE c_mktsegment WHEN 'BUILDING' THEN 'Yes' WHEN 'AUTOMOBILE' THEN 'no' "
                "WHEN 'MACHINERY' THEN ' Y ' WHEN 'HOUSEHOLD' THEN 'None' ELSE 'TRUE' END END",
}

# Orders carry the account's change time: the order date is the business
# "updated_at" used for batching (INC-*).
ACCOUNT_EVENT_EXPRS = {
    "account_id": "o_orderkey",
    "customer_id": "o_custkey",
    "balance_amount": "cast(o_totalprice as decimal(18,2))",
    "account_type": "CASE o_orderstatus WHEN 'F' THEN 'savings' WHEN 'O' THEN 'checking' ELSE 'savings' END",
    "updated_at": "o_orderdate",
}

CHANGE_LOG_EXPRS = {
    "user_id": "user_id",
    "event_type": "event_type",
    "ts": "ts",
    "event_id": "event_id",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (SRC-9).  Column pruning and filter
    pushdown reach the scan through Catalyst."""
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs.items()])


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), RAW_ACCOUNT_EXPRS)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), RAW_CUSTOMER_EXPRS)


def account_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "orders"), ACCOUNT_EVENT_EXPRS)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "events"), CHANGE_LOG_EXPRS)


def sql_select(exprs: dict[str, str], source: str) -> str:
    """The same projection as SQL text (oracle side)."""
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + f" FROM {source}"
