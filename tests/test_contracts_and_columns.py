"""Column functions, naming rules and layer contracts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions import names as N
from strata.operators import contracts as K
from strata.plans import pipeline as P
from strata.plans.runs import Warehouse
from tests import fixtures as FX


def _one(spark, expr, value, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    (" Yes ", True), ("y", True), ("TRUE", True), ("1", True), ("no", False), ("None", False),
    ("0", False), ("maybe", None), ("", None), (None, None)])
def test_standardize_boolean(spark, text, expected):
    assert _one(spark, C.standardize_boolean, text) == expected


@pytest.mark.parametrize("text,expected", [("maybe", False), (None, False), ("YES", True), (" n ", False)])
def test_loan_flag_defaults_false(spark, text, expected):
    assert _one(spark, C.loan_flag, text) is expected


@pytest.mark.parametrize("text,expected", [(" N/A ", None), ("null", None), ("", None), ("None", None),
                                           ("  Mixed Case ", "mixed case"), (None, None)])
def test_clean_string(spark, text, expected):
    assert _one(spark, C.clean_string, text) == expected


@pytest.mark.parametrize("text,expected", [(" 4 ", 4), ("+7", 7), ("1.5", None), ("1.0", None), ("1e2", None),
                                           ("", None), ("1,000", None), ("99999999999", None)])
def test_to_int_integer_text_only(spark, text, expected):
    assert _one(spark, lambda c: C.to_int(c), text) == expected


@pytest.mark.parametrize("text,expected", [("6000.005", Decimal("6000.01")), (" 12.5 ", Decimal("12.50")),
                                           ("ABC123", None), ("-5.00", Decimal("-5.00"))])
def test_to_money(spark, text, expected):
    assert _one(spark, C.to_money, text) == expected


@pytest.mark.parametrize("bal,flag,rate", [
    ("9999.99", False, "0.0100"), ("10000.00", False, "0.0150"), ("19999.99", True, "0.0200"),
    ("20000.00", False, "0.0200"), ("20000.00", True, "0.0250"), (None, True, None)])
def test_rates(spark, bal, flag, rate):
    df = spark.createDataFrame([(bal, flag)], "b string, f boolean").select(
        F.col("b").cast("decimal(18,2)").alias("b"), "f")
    r = df.select(((C.tier_rate("b") + C.bonus_rate("f")).cast(C.RATE)).alias("r")).first()["r"]
    assert r == (Decimal(rate) if rate else None)


def test_interest_half_up(spark):
    df = spark.createDataFrame([(Decimal("8000.50"), Decimal("0.0150"))], "b decimal(18,2), r decimal(5,4)")
    row = df.select(C.interest("b", "r").alias("i")).select("i", C.new_balance(F.lit(Decimal("8000.50")), "i").alias("n")).first()
    assert row.i == Decimal("120.01") and row.n == Decimal("8120.51")


def test_version_id_is_deterministic(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k long, t timestamp")
    a = df.select(C.version_id(["k"], "t").alias("v")).first()["v"]
    b = df.select(C.version_id(["k"], "t").alias("v")).first()["v"]
    assert a == b and len(a) == 32


def test_standardize_column_names():
    assert N.standardize_column_name("Customer Name") == "customer_name"
    assert N.standardize_column_name("Account-ID") == "account_id"
    assert N.standardize_column_name("Has Loan?") == "has_loan"


def test_standardize_names_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a-b` int")
    with pytest.raises(ValueError):
        N.standardize_names(df)


def test_contract_naming_rules_hold():
    for c in K.CONTRACTS.values():
        assert c.naming() == [], c.name


def test_contracts_on_pipeline_output(spark, tmp):
    cust = FX.write(f"{tmp}/in", "c.csv", FX.EDGE_CUSTOMERS)
    acct = FX.write(f"{tmp}/in", "a.csv", FX.EDGE_ACCOUNTS)
    P.run(spark, P.RunConfig(cust, acct, f"{tmp}/wh", "r1", dt.datetime(2024, 1, 1)))
    store = Warehouse(spark, f"{tmp}/wh")
    for name in ("stg_customer", "stg_account", "int_account_with_customer", "int_savings_account_only",
                 "account_summary", "customer_profile"):
        df = store.read(name)
        K.CONTRACTS[name].check_schema(df)
        K.CONTRACTS[name].check_constraints(df)
    bad = store.read("account_summary").withColumn("interest_rate_pct", F.col("interest_rate_pct").cast("double"))
    with pytest.raises(K.ContractError):
        K.CONTRACTS["account_summary"].check_schema(bad)
    dup = store.read("account_summary").unionByName(store.read("account_summary"))
    with pytest.raises(K.ContractError):
        K.CONTRACTS["account_summary"].check_constraints(dup)
