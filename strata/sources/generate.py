"""Synthetic bank inputs for scale tests (SRC-13), generated by Spark.

``spark.range`` produces the rows on the executors, so the generator scales
with the cluster; nothing is built on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import padded_key


def customers(spark: SparkSession, n: int) -> DataFrame:
    """Raw customer rows: ids 1..n, even ids hold a loan."""
    return spark.range(1, n + 1).select(
        F.col("id").cast("string").alias("CustomerID"),
        F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("Name"),
        F.when(F.col("id") % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("HasLoan"))


def accounts(spark: SparkSession, n: int, n_customers: int, version: int = 0,
             changed_pct: int = 0) -> DataFrame:
    """Raw savings accounts 1..n, balance 100 x i, spread over the customers.
    In ``version`` v > 0, ``changed_pct`` % of the accounts (chosen by a hash
    of id and version) carry ``+ v`` on the balance."""
    hit = (F.pmod(F.xxhash64(F.col("id"), F.lit(version)), F.lit(100)) < changed_pct) if version else F.lit(False)
    bal = (F.col("id") * 100).cast("decimal(18,2)")
    return spark.range(1, n + 1).select(
        padded_key("A", F.col("id"), 5).alias("AccountID"),
        ((F.col("id") - 1) % n_customers + 1).cast("string").alias("CustomerID"),
        F.when(hit, bal + F.lit(version)).otherwise(bal).cast("decimal(18,2)").cast("string").alias("Balance"),
        F.lit("Savings").alias("AccountType"))
