"""Validation rules, single-pass split vs the anti-join form (SEM-8)."""

from pyspark.sql import functions as F

from strata.operators import quarantine as Q
from strata.operators import staging as S
from strata.plans import layers as L
from strata.sources import files
from tests import fixtures as FX


def test_account_reasons(spark, tmp):
    raw = files.read_accounts(spark, FX.write(tmp, "a.csv", FX.DIRTY_ACCOUNTS))
    src = S.rename_cast(raw, S.ACCOUNT_RAW_NAMES, F.current_timestamp())
    valid, rejected = Q.split(src, Q.account_rules())
    got = {r.account_id: r.failure_reason for r in rejected.collect()}
    assert valid.count() == 6 and rejected.count() == 10
    assert got["C-06"] == "Invalid balance: null or empty"
    assert got["C-13"] == "Invalid customer_id: non-numeric value (XX9)"
    assert got["C-09"] == "Invalid balance: non-numeric value (12x)"
    assert got["C-14"] == "Invalid account_type: null or empty"
    assert got["C-12"] == "Invalid customer_id: null or empty"
    assert got["C-08"] == "Invalid balance: null representation (null)"
    assert got[None] == "Invalid account_id: null or empty"


def test_customer_reasons(spark, tmp):
    raw = files.read_customers(spark, FX.write(tmp, "c.csv", FX.DIRTY_CUSTOMERS))
    src = S.rename_cast(raw, S.CUSTOMER_RAW_NAMES, F.current_timestamp())
    valid, rejected = Q.split(src, Q.customer_rules())
    got = {r.customer_id: r.failure_reason for r in rejected.collect()}
    assert valid.count() == 5 and len(got) == 5
    assert got["XX9"] == "Invalid customer_id: non-numeric value (XX9)"
    assert got["304"] == "Invalid has_loan value: MAYBE"
    assert got["303"] == "Invalid name: null or empty"


def test_zero_balance_passes_quarantine(spark):
    df = spark.createDataFrame([("A1", "1", "0.00", "Savings")], "account_id string, customer_id string, "
                               "balance string, account_type string")
    valid, rejected = Q.split(df, Q.account_rules())
    assert valid.count() == 1 and rejected.count() == 0


def test_single_pass_equals_antijoin_and_partitions_input(spark, sf):
    src = L.src_account(spark, sf)
    valid, rejected = Q.split(src, Q.account_rules(id_type="bigint"))
    anti = Q.quarantine_antijoin(src, rejected, ["account_id", "customer_id", "balance", "account_type"])
    assert valid.exceptAll(anti).isEmpty() and anti.exceptAll(valid).isEmpty()
    # valid + quarantined = input, as multisets
    both = valid.unionByName(rejected.drop("failure_reason"))
    assert both.exceptAll(src).isEmpty() and src.exceptAll(both).isEmpty()


def test_generic_quarantine_macro(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    out = Q.quarantine_failed_records(df, "x < 0")
    rows = out.collect()
    assert len(rows) == 1 and rows[0].failure_reason == "x < 0"
