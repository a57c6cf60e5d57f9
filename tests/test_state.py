"""Runs, histories, file folders and the gate under failures."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import contracts as K
from strata.operators import quarantine as Q
from strata.operators import scd2
from strata.operators import staging as S
from strata.plans import pipeline as P
from strata.plans.runs import History, StaleRunError, Warehouse
from strata.sinks import writers as W
from strata.sources import files
from tests import fixtures as FX

DAY = lambda d: dt.datetime(2024, 1, d)


def publish(wh, name, df, run_id, day, contract=None):
    if wh.begin(run_id, DAY(day)):
        wh.stage(name, df, contract)
        wh.commit()


def test_runs_in_order_and_visible_at_once(spark, tmp):
    wh = Warehouse(spark, f"{tmp}/wh")
    publish(wh, "t", spark.range(3), "r1", 1)
    publish(wh, "t", spark.range(4), "r2", 2)
    with pytest.raises(StaleRunError):
        publish(wh, "t", spark.range(9), "r0", 2)
    publish(wh, "t", spark.range(9), "r1", 1)  # an older run: no-op
    wh.begin("r3", DAY(3))
    wh.stage("t", spark.range(5))
    assert wh.read("t").count() == 5 and wh.read_before("t").count() == 4
    other = Warehouse(spark, f"{tmp}/wh")
    assert other.read("t").count() == 4
    # A crash here: the run is repeated from the start, with other rows.
    assert other.begin("r3", DAY(3))
    other.stage("t", spark.range(6))
    other.commit()
    assert Warehouse(spark, f"{tmp}/wh").read("t").count() == 6
    with pytest.raises(RuntimeError, match="another run"):  # the first attempt comes back to life
        wh.commit()
    other.vacuum("t", keep=1)
    assert other.read("t").count() == 6 and spark.table(other.table("t")).select("run_attempt").distinct().count() == 1


def test_a_new_session_finds_the_tables(spark, tmp):
    wh = Warehouse(spark, f"{tmp}/wh")
    publish(wh, "t", spark.range(3).withColumn("d", F.lit("2024-01-01")), "2024-01-01", 1)
    wh.begin("2024-01-02", DAY(2))
    wh.stage("never_published", spark.range(2))
    fresh = spark.newSession()  # same files, a catalog that knows nothing of them
    again = Warehouse(fresh, f"{tmp}/wh")
    again.db = wh.db + "_other"
    fresh.sql(f"CREATE DATABASE {again.db} LOCATION '{tmp}/wh'")
    again._attach("runs")
    assert again.read("t").count() == 3 and again.last("t") == "2024-01-01"
    assert again.begin("2024-01-02", DAY(2))
    again.stage("never_published", spark.range(4))
    again.commit()
    assert again.read("never_published").count() == 4


def test_audit_leaves_the_old_table_visible(spark, tmp):
    contract = K.Contract("t", T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())]), ("k", "v"), ("k",))
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    wh = Warehouse(spark, f"{tmp}/wh")
    publish(wh, "t", rows((1, "a"), (2, "b")), "r1", 1, contract)
    for i, bad in enumerate((rows((1, "a"), (1, "b")), rows((1, None), (2, "b")))):
        with pytest.raises(K.ContractError, match="duplicate" if not i else "NULLs"):
            publish(wh, "t", bad, f"bad{i}", 2 + i, contract)
        assert sorted(Warehouse(spark, f"{tmp}/wh").read("t").collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(K.ContractError, match="unexpected"):
        publish(wh, "t", rows((1, "a")).withColumn("more", F.lit(1)), "bad2", 4, contract)
    publish(wh, "t", rows((3, "c")), "r2", 5, contract)
    assert Warehouse(spark, f"{tmp}/wh").read("t").collect() == [(3, "c")]


def test_history_commit_is_all_or_nothing(spark, tmp):
    """A crash before the commit, then the same run with another extract:
    no version is stored twice."""
    wh = Warehouse(spark, f"{tmp}/wh")
    hs = History(wh, "snap")

    def run(rows, d, rid, commit=True):
        assert wh.begin(rid, DAY(d))
        hs.stage(scd2.snapshot(hs.open_versions(), spark.createDataFrame(rows, "k long, v string"), ["k"], "check", F.lit(DAY(d)).cast("timestamp")))
        if commit:
            wh.commit()

    run([(1, "a"), (2, "b")], 1, "r1")
    run([(1, "changed"), (2, "b")], 2, "r2", commit=False)  # dies
    wh = Warehouse(spark, f"{tmp}/wh")
    hs = History(wh, "snap")
    assert hs.read().filter("dbt_valid_to IS NULL").count() == 2
    run([(1, "a"), (2, "b")], 2, "r2")  # this extract closes nothing
    got = sorted(((r.k, r.v, r.dbt_valid_to) for r in hs.read().collect()), key=repr)
    assert got == [(1, "a", None), (2, "b", None)]
    run([(2, "b")], 3, "r3")            # delete
    run([(1, "a"), (2, "b")], 4, "r4")  # and insert again
    assert hs.read().filter("k = 1").count() == 2 and hs.open_versions().count() == 2
    wh.begin("r5", DAY(5))
    hs.archive(F.lit(DAY(5)).cast("timestamp"), "old")
    wh.commit()
    assert wh.read("old").count() == 1 and hs.read().count() == 2 and hs.closed_versions().count() == 0
    wh.vacuum("snap", keep=1, only=", is_open=true")
    assert hs.read().count() == 2


def test_folder_with_several_files(spark, tmp):
    FX.write(f"{tmp}/in", "a.csv", "CustomerID,Name,HasLoan\n1,a,Yes\n2,b,No,surplus\n3,c\n")
    FX.write(f"{tmp}/in", "b.csv", "CustomerID,Name,HasLoan\n4,d,Yes\n")
    raw = files.read_customers(spark, f"{tmp}/in")
    src = S.rename_cast(raw, S.CUSTOMER_RAW_NAMES, F.lit(DAY(1)).cast("timestamp"))
    valid, rejected = S.stage_customers(src, F.lit(DAY(1)).cast("timestamp"))
    assert {r.customer_id for r in valid.collect()} == {1, 4}
    reasons = {r[Q.MALFORMED]: r.failure_reason for r in rejected.collect()}
    assert reasons == {t: f"Invalid record: wrong number of fields ({t})" for t in ("2,b,No,surplus", "3,c")}
    FX.write(f"{tmp}/in", "c.csv", "CustomerID,HasLoan,Name\n5,Yes,e\n")  # columns swapped
    with pytest.raises(Exception, match="(?i)header"):
        files.read_customers(spark, f"{tmp}/in").collect()


def test_csv_keeps_blanks(spark, tmp):
    df = spark.createDataFrame([(1, "  x ")], "k int, v string")
    W.write_csv(df, f"{tmp}/out")
    assert spark.read.schema(df.schema).options(**W.CSV_OPTIONS).csv(f"{tmp}/out").first().v == "  x "


def test_gate_stops_exports(spark, tmp, monkeypatch):
    monkeypatch.setattr(P, "quality_results", lambda store, run_id, ts, id_type: spark.createDataFrame(
        [(run_id, "account_summary", "marts", "t", None, "error", 2, "fail", "2 violating rows")],
        "run_id string, table_name string, layer string, test_name string, column_name string, severity string, "
        "violations long, status string, message string"))
    cfg = P.RunConfig(FX.write(f"{tmp}/in", "c.csv", FX.EDGE_CUSTOMERS), FX.write(f"{tmp}/in", "a.csv", FX.EDGE_ACCOUNTS),
                      f"{tmp}/wh", "r1", DAY(1), export_dir=f"{tmp}/out", report_dir=f"{tmp}/rep")
    with pytest.raises(P.QualityGateError):
        P.run(spark, cfg)
    assert os.path.isdir(f"{tmp}/rep/run_id=r1") and not os.path.exists(f"{tmp}/out")


def test_gate_and_constraints_leave_the_last_run_visible(spark, tmp, monkeypatch):
    run = lambda rid, d, a: P.run(spark, P.RunConfig(FX.write(f"{tmp}/in", "c.csv", FX.EDGE_CUSTOMERS), FX.write(f"{tmp}/in{rid}", "a.csv", a),
                                                     f"{tmp}/wh", rid, DAY(d), stop_on_error=False))
    run("r1", 1, FX.EDGE_ACCOUNTS)
    before = sorted(Warehouse(spark, f"{tmp}/wh").read("account_summary").collect())
    real = P.M.account_summary
    monkeypatch.setattr(P.M, "account_summary", lambda *a: real(*a).unionByName(real(*a)))  # a mart that repeats its keys
    with pytest.raises(P.K.ContractError):
        run("r2", 2, FX.EDGE_ACCOUNTS.replace("B-01,", "B-99,"))
    monkeypatch.setattr(P.M, "account_summary", real)
    assert sorted(Warehouse(spark, f"{tmp}/wh").read("account_summary").collect()) == before
