"""End-to-end runs of the layered pipeline on literal fixtures."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline as P
from strata.plans.runs import History, Warehouse
from strata.sources import files
from tests import fixtures as FX


def _cfg(tmp, cust, acct, run_id, day, **kw):
    return P.RunConfig(customers_path=cust, accounts_path=acct, warehouse=f"{tmp}/wh", run_id=run_id,
                       run_ts=dt.datetime(2024, 1, day), **kw)


def test_dirty_sample_full_run(spark, tmp):
    cust = FX.write(f"{tmp}/in", "Customer.csv", FX.DIRTY_CUSTOMERS)
    acct = FX.write(f"{tmp}/in", "accounts.csv", FX.DIRTY_ACCOUNTS)
    res = P.run(spark, _cfg(tmp, cust, acct, "r1", 1, export_dir=f"{tmp}/out", report_dir=f"{tmp}/rep"))
    c = res.layer_counts
    assert c["quarantine_stg_customer"] == 5 and c["stg_customer"] == 5
    assert c["quarantine_stg_account"] == 10 and c["stg_account"] == 6
    assert c["int_account_with_customer"] == 5
    assert c["int_savings_account_only"] == 4 and c["account_summary"] == 4
    assert c["customer_profile"] == 4
    store = Warehouse(spark, f"{tmp}/wh")
    tot = store.read("account_summary").agg(
        F.sum("original_balance_amount").alias("b"), F.sum("annual_interest_amount").alias("i"),
        F.sum("new_balance_amount").alias("n")).first()
    assert (tot.b, tot.i, tot.n) == (Decimal("70000.00"), Decimal("1425.00"), Decimal("71425.00"))
    rates = {r.account_id: r.interest_rate_pct for r in store.read("account_summary").collect()}
    assert rates == {"C-01": Decimal("0.0150"), "C-02": Decimal("0.0150"), "C-03": Decimal("0.0200"), "C-04": Decimal("0.0250")}
    assert res.gate["passed"] is True
    assert all(r.ok for r in res.exports) and len(res.exports) == 4
    reasons = {r.account_id: r.failure_reason for r in store.read("quarantine_stg_account").collect()}
    assert reasons["C-10"] == "Invalid balance: negative value (-3.50)"
    assert reasons["C-07"] == "Invalid balance: null representation (N/A)"
    assert reasons["C-15"] == "Invalid account_type: must be Savings or Checking (Bonds)"
    assert os.path.isdir(f"{tmp}/rep/run_id=r1")


def test_edge_sample(spark, tmp):
    cust = FX.write(f"{tmp}/in", "c.csv", FX.EDGE_CUSTOMERS)
    acct = FX.write(f"{tmp}/in", "a.csv", FX.EDGE_ACCOUNTS)
    res = P.run(spark, _cfg(tmp, cust, acct, "r1", 1))
    assert res.layer_counts["quarantine_stg_customer"] == 0
    assert res.layer_counts["quarantine_stg_account"] == 0
    store = Warehouse(spark, f"{tmp}/wh")
    s = {r.account_id: r for r in store.read("account_summary").collect()}
    assert len(s) == 11
    assert s["B-02"].annual_interest_amount == Decimal("116.67")      # 7777.70 x 0.015, HALF_UP
    assert s["B-03"].interest_rate_pct == Decimal("0.0100")           # 9999.99, no loan
    assert s["B-04"].interest_rate_pct == Decimal("0.0150")           # 10000.00 boundary
    assert s["B-07"].interest_rate_pct == Decimal("0.0200")           # 20000.00 boundary
    assert s["B-13"].annual_interest_amount == Decimal("399.96")
    assert sum(r.original_balance_amount for r in s.values()) == Decimal("169975.69")
    assert sum(r.annual_interest_amount for r in s.values()) == Decimal("3172.13")
    p = {r.customer_id: r for r in store.read("customer_profile").collect()}
    assert len(p) == 10
    assert p[201].total_accounts_count == 2 and p[201].total_balance_amount == Decimal("14200.01")
    assert p[201].total_annual_interest_amount == Decimal("263.00")
    assert p[204].customer_name == "dara quill"


def _edit(text, replace=None, drop=(), add=()):
    lines = text.strip().split("\n")
    out = [lines[0]]
    for ln in lines[1:]:
        key = ln.split(",")[0]
        if key in drop:
            continue
        out.append((replace or {}).get(key, ln))
    out.extend(add)
    return "\n".join(out) + "\n"


def _state(store):
    cols = {"account_summary": ["account_id", "customer_id", "original_balance_amount", "interest_rate_pct",
                                "annual_interest_amount", "new_balance_amount"],
            "customer_profile": ["customer_id", "customer_name", "has_loan_flag", "total_accounts_count",
                                 "total_balance_amount", "total_annual_interest_amount"],
            "int_account_with_customer": ["account_id", "customer_id", "balance_amount", "account_type",
                                          "customer_name", "has_loan_flag"]}
    return {t: sorted(tuple(r) for r in store.read(t).select(*c).collect()) for t, c in cols.items()}


def test_incremental_equals_full_refresh(spark, tmp):
    c1 = FX.write(f"{tmp}/in1", "c.csv", FX.EDGE_CUSTOMERS)
    a1 = FX.write(f"{tmp}/in1", "a.csv", FX.EDGE_ACCOUNTS)
    P.run(spark, _cfg(tmp, c1, a1, "r1", 1))
    # rename, flag flip with accounts unchanged, delete a customer, add one
    c2_text = _edit(FX.EDGE_CUSTOMERS, replace={"201": "201,Ann Renamed,Yes", "202": "202,Ben Okoro,yes"},
                    drop={"209"}, add=["212,New Person,Yes"])
    # balance change, savings -> checking, delete, move to another customer, new account
    a2_text = _edit(FX.EDGE_ACCOUNTS, replace={"B-01": "B-01,201,7000.00,Savings", "B-05": "B-05,203,14500.00,Checking",
                                            "B-08": "B-08,211,31000.00,Savings"},
                    drop={"B-04"}, add=["B-14,212,10000.00,Savings"])
    c2 = FX.write(f"{tmp}/in2", "c.csv", c2_text)
    a2 = FX.write(f"{tmp}/in2", "a.csv", a2_text)
    P.run(spark, _cfg(tmp, c2, a2, "r2", 2))
    inc = _state(Warehouse(spark, f"{tmp}/wh"))

    P.run(spark, _cfg(f"{tmp}/full", c2, a2, "r1", 2))
    full = _state(Warehouse(spark, f"{tmp}/full/wh"))
    assert inc == full
    s = {r[0]: r for r in inc["account_summary"]}
    assert s["B-01"][2] == Decimal("7000.00") and s["B-01"][4] == Decimal("105.00")  # 7000 x (0.01 + 0.005)
    assert "B-05" not in s and "B-04" not in s and "B-14" in s
    assert all(r[0] != 209 for r in inc["customer_profile"])

    # history: customer 201 has two versions, one open; customer 209 closed
    snap = History(Warehouse(spark, f"{tmp}/wh"), "snap_customer").read()
    v1 = snap.filter("customer_id = 201").orderBy("dbt_valid_from").collect()
    assert [r.customer_name for r in v1] == ["ana forte", "ann renamed"]
    assert v1[0].dbt_valid_to == v1[1].dbt_valid_from and v1[1].dbt_valid_to is None
    assert snap.filter("customer_id = 209 AND dbt_valid_to IS NULL").count() == 0
    assert snap.filter("customer_id = 203").count() == 1            # unchanged: no new version


def test_rerun_same_run_is_noop_and_unchanged_run_adds_nothing(spark, tmp):
    c1 = FX.write(f"{tmp}/in1", "c.csv", FX.EDGE_CUSTOMERS)
    a1 = FX.write(f"{tmp}/in1", "a.csv", FX.EDGE_ACCOUNTS)
    P.run(spark, _cfg(tmp, c1, a1, "r1", 1))
    store = Warehouse(spark, f"{tmp}/wh")
    files_before = sorted(store.read("account_summary").inputFiles())
    P.run(spark, _cfg(tmp, c1, a1, "r1", 1))
    store = Warehouse(spark, f"{tmp}/wh")
    assert store.last("account_summary") == "r1" and sorted(store.read("account_summary").inputFiles()) == files_before
    P.run(spark, _cfg(tmp, c1, a1, "r2", 2))
    snap = History(Warehouse(spark, f"{tmp}/wh"), "snap_account").read()
    assert snap.count() == 13 and snap.filter("dbt_valid_to IS NULL").count() == 13


def test_schema_drift_and_empty_input(spark, tmp):
    bad = FX.write(f"{tmp}/in", "c.csv", "CustomerID,Name,Extra\n1,a,x\n")
    with pytest.raises(files.SchemaDriftError) as e:
        files.read_customers(spark, bad)
    assert "HasLoan" in str(e.value) and "Extra" in str(e.value)
    empty = FX.write(f"{tmp}/in", "e.csv", "CustomerID,Name,HasLoan\n")
    with pytest.raises(files.EmptyInputError):
        files.read_customers(spark, empty)
    with pytest.raises(FileNotFoundError):
        files.read_customers(spark, f"{tmp}/nope.csv")
    padded = FX.write(f"{tmp}/in", "p.csv", " CustomerID , Name,HasLoan \n1,a,Yes\n")
    assert files.read_customers(spark, padded).columns == ["CustomerID", "Name", "HasLoan", files.MALFORMED]


@pytest.mark.parametrize("crash_at", ["int_savings_account_only", "customer_profile"])
def test_failed_run_then_rerun_equals_clean_run(spark, tmp, monkeypatch, crash_at):
    """INC-7: a run that dies after some layers were staged changes nothing
    that readers see; re-run with the same run id, it ends exactly like an
    uninterrupted run."""
    c1 = FX.write(f"{tmp}/in1", "c.csv", FX.EDGE_CUSTOMERS)
    a1 = FX.write(f"{tmp}/in1", "a.csv", FX.EDGE_ACCOUNTS)
    a2 = FX.write(f"{tmp}/in2", "a.csv", _edit(FX.EDGE_ACCOUNTS, replace={"B-01": "B-01,201,7000.00,Savings",
                                                                         "B-08": "B-08,211,31000.00,Savings"},
                                               drop={"B-02"}))
    for root in (f"{tmp}/crash", f"{tmp}/clean"):
        P.run(spark, _cfg(root, c1, a1, "r1", 1))
    real, seen = Warehouse.stage, _state(Warehouse(spark, f"{tmp}/crash/wh"))

    def failing(self, name, *a, **kw):
        if name == crash_at and self.run_id == "r2":
            raise RuntimeError("executor lost, job aborted")
        return real(self, name, *a, **kw)

    monkeypatch.setattr(Warehouse, "stage", failing)
    with pytest.raises(RuntimeError, match="executor lost"):
        P.run(spark, _cfg(f"{tmp}/crash", c1, a2, "r2", 2))
    monkeypatch.setattr(Warehouse, "stage", real)
    assert _state(Warehouse(spark, f"{tmp}/crash/wh")) == seen
    P.run(spark, _cfg(f"{tmp}/crash", c1, a2, "r2", 2))
    P.run(spark, _cfg(f"{tmp}/clean", c1, a2, "r2", 2))
    assert _state(Warehouse(spark, f"{tmp}/crash/wh")) == _state(Warehouse(spark, f"{tmp}/clean/wh"))
    hc = History(Warehouse(spark, f"{tmp}/crash/wh"), "snap_account").read()
    hk = History(Warehouse(spark, f"{tmp}/clean/wh"), "snap_account").read()
    assert hc.exceptAll(hk).isEmpty() and hk.exceptAll(hc).isEmpty()
