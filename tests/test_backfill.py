"""Backfill of a slice, and samples of rows of checks that did not pass."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline as P
from strata.plans.runs import StaleRunError, Warehouse
from tests import fixtures as FX
from tests.test_pipeline import _cfg, _edit, _state


def test_backfill_repairs_a_slice_only(spark, tmp, monkeypatch):
    c = FX.write(f"{tmp}/in", "c.csv", FX.EDGE_CUSTOMERS)
    a1 = FX.write(f"{tmp}/in1", "a.csv", FX.EDGE_ACCOUNTS)
    a2 = FX.write(f"{tmp}/in2", "a.csv", _edit(FX.EDGE_ACCOUNTS, replace={"B-01": "B-01,201,7000.00,Savings", "B-03": "B-03,202,8000.00,Savings"},
                                              add=["B-14,204,10000.00,Savings"]))
    with pytest.raises(FileNotFoundError):
        P.backfill(spark, _cfg(tmp, c, a1, "b0", 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1))
    P.run(spark, _cfg(tmp, c, a1, "r1", 1))
    with monkeypatch.context() as m:  # a faulty release: interest of run 2 is one too high
        right = P.M.account_summary
        m.setattr(P.M, "account_summary", lambda sav, ts: right(sav, ts).withColumn(
            "annual_interest_amount", (F.col("annual_interest_amount") + 1).cast("decimal(18,2)")))
        bad = P.run(spark, _cfg(tmp, c, a2, "r2", 2, stop_on_error=False, sample_dir=f"{tmp}/samples", sample_rows=2))
    assert not bad.gate["passed"]
    # SRT-4: a bounded sample of the rows behind each check that did not pass.
    kept = spark.read.json(f"{tmp}/samples").collect()
    assert {r.run_id for r in kept} == {"r2"}
    wrong = [json.loads(r.row) for r in kept if r.test_name == "interest_calculation"]
    assert len(wrong) == 2 and {w["account_id"] for w in wrong} <= {"B-01", "B-03", "B-14"}

    store = Warehouse(spark, f"{tmp}/wh")
    stamps = lambda: {r.account_id: r.calculated_at for r in store.read("account_summary").collect()}
    history = lambda: store.runs().filter(F.map_contains_key("counts", "snap_account")).count()
    before, runs = stamps(), history()
    day = lambda n: dt.datetime(2024, 1, n)
    # A slice without versions publishes the same rows.
    P.backfill(spark, _cfg(tmp, c, a2, "b1", 3, stop_on_error=False), day(10), day(11))
    store = Warehouse(spark, f"{tmp}/wh")
    assert stamps() == before
    res = P.backfill(spark, _cfg(tmp, c, a2, "b2", 4), day(2), day(3))
    store = Warehouse(spark, f"{tmp}/wh")
    after = stamps()
    assert res.gate["passed"] and {k for k in after if after[k] != before[k]} == {"B-01", "B-03", "B-14"}
    assert history() == runs and res.layer_counts["stg_account"] == bad.layer_counts["stg_account"]
    P.run(spark, _cfg(f"{tmp}/full", c, a2, "r1", 2))
    assert _state(store) == _state(Warehouse(spark, f"{tmp}/full/wh"))
    # The same run again is a no-op; one in the past is refused; runs go on.
    assert P.backfill(spark, _cfg(tmp, c, a2, "b2", 4), day(2), day(3)).gate is None
    with pytest.raises(StaleRunError):
        P.backfill(spark, _cfg(tmp, c, a2, "b3", 3), day(2), day(3))
    assert P.run(spark, _cfg(tmp, c, a1, "r3", 5)).gate["passed"]
    P.run(spark, _cfg(f"{tmp}/first", c, a1, "r1", 5))
    assert _state(Warehouse(spark, f"{tmp}/wh")) == _state(Warehouse(spark, f"{tmp}/first/wh"))
