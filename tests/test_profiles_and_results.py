"""Results of other runners, checksums of outputs, profiles merged over runs."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import checksum as CK
from strata.operators import report as REP
from strata.operators import sketches as SK
from strata.plans import pipeline as P
from strata.sinks import writers as W
from tests import fixtures as FX
from tests.test_pipeline import _cfg


def _results(*entries, run="r1"):
    return json.dumps({"metadata": {"run_id": run, "elapsed": 1.5}, "results": list(entries)})


ENTRIES = (
    {"unique_id": "test.bank.not_null_x", "status": "success", "message": "fine"},
    {"unique_id": "test.bank.unique_x", "status": "fail", "message": "Got 2 \"rows\"\nof them", "failures": 2,
     "config": {"severity": "warn"}, "table_name": "stg_account", "column_name": "x"},
    {"unique_id": "test.bank.late", "status": "skipped", "message": "upstream", "config": {}},
    {"unique_id": "test.bank.none", "config": None}, {"unique_id": "model.bank.x", "status": "success"}, {"status": "fail"})


def test_results_of_another_runner(spark, tmp):
    FX.write(f"{tmp}/in", "a.json", "\n".join((_results(*ENTRIES), "{\"metadata\": {", _results(None, 7, {"unique_id": "test.a", "config": "x"}, run="r2"),
                                               json.dumps({"metadata": {"run_id": "r3"}}), "")))
    results, odd = REP.ingest(spark, f"{tmp}/in")
    assert results.schema.simpleString() == spark.createDataFrame([], REP.RESULT_SCHEMA).schema.simpleString()
    assert {r.test_name: (r.table_name, r.layer, r.column_name, r.severity, r.violations, r.status, r.message) for r in results.collect()} == {
        "not_null_x": ("unknown", "marts", None, "error", None, "pass", None),
        "unique_x": ("stg_account", "staging", "x", "warn", 2, "fail", "Got 2 \"rows\"\nof them"),
        "late": ("unknown", "marts", None, "error", None, "skip", None),
        "none": ("unknown", "marts", None, "error", None, "unknown", None)}
    assert sorted(r.malformed for r in odd.collect()) == ["7", "null", "{\"metadata\": {", "{\"unique_id\": \"test.a\", \"config\": \"x\"}"]
    assert REP.gate(results).first().failing == 1


def test_one_result_document_per_file(spark, tmp):
    FX.write(f"{tmp}/in", "a.json", json.dumps(json.loads(_results(*ENTRIES)), indent=2))
    FX.write(f"{tmp}/in", "b.json", "{\n\"results\": oops")
    FX.write(f"{tmp}/in", "c.json", "")
    results, odd = REP.ingest(spark, f"{tmp}/in", one_per_file=True)
    assert results.count() == 4 and [r.malformed for r in odd.collect()] == ["{\n\"results\": oops"]
    with pytest.raises(FileNotFoundError):
        REP.ingest(spark, f"{tmp}/none")


def test_checksum_counts_rows_and_keeps_columns_apart(spark):
    schema = "k int, a string, b string, v decimal(18,2)"
    rows = [(1, "x", None, Decimal("1.50")), (2, "x", "y", None), (2, "x", "y", None), (3, "", "z", Decimal(0))]
    df = spark.createDataFrame(rows, schema)
    assert CK.same_rows(df, spark.createDataFrame(rows[::-1], schema).repartition(3))
    others = ([rows[0], rows[0], rows[1], rows[3]],            # another row repeated
              [(1, None, "x", Decimal("1.50"))] + rows[1:],    # a null in the next column
              rows[:3] + [(3, "z", "", Decimal(0))],           # texts swapped
              rows[:3] + [(3, None, "z", Decimal(0))],         # empty is not null
              rows[:3], rows + rows)
    for other in others:
        assert not CK.same_rows(df, spark.createDataFrame(other, schema))
    assert CK.checksum(df.limit(0)).first() == (0, Decimal(0), Decimal(0))
    assert CK.same_rows(df.limit(0), df.limit(0).select("v", "b", "a", "k"))


def test_swapped_duplicate_in_an_export_is_noticed(spark, tmp, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    whole = W.write_csv(df, f"{tmp}/csv")
    assert whole.ok and W.same_output(whole, W.write_parquet(df, f"{tmp}/pq"))
    swapped = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], df.schema)
    assert not W.same_output(whole, W.write_parquet(swapped, f"{tmp}/pq2"))  # three rows in each
    seen = CK.checksum
    monkeypatch.setattr(W.CK, "checksum", lambda back: seen(swapped))
    with pytest.raises(W.WriteValidationError):
        W.write_csv(df, f"{tmp}/csv2")


def test_run_profiles_its_input_and_fills_catalog_tables(spark, tmp):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts_out LOCATION '{tmp}/marts'")
    cust = FX.write(f"{tmp}/in", "Customer.csv", FX.DIRTY_CUSTOMERS)
    acct = FX.write(f"{tmp}/in", "accounts.csv", FX.DIRTY_ACCOUNTS)
    res = P.run(spark, _cfg(tmp, cust, acct, "r1", 1, export_database="marts_out"))
    assert res.ingest["customers"]["row_count"] == 10 and res.ingest["accounts"]["row_count"] == 16
    assert res.ingest["accounts"]["negative_Balance"] == 1 and "null_AccountType" in res.ingest["accounts"]
    assert spark.table("marts_out.account_summary").count() == res.layer_counts["account_summary"] == 4
    spark.sql("DROP DATABASE marts_out CASCADE")


def test_profiles_of_runs_merge_into_one(spark):
    df = spark.range(60000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id % 7) END AS run",
                                       "CASE WHEN id % 10 > 0 THEN id % 20000 END AS v", "CAST(NULL AS double) AS none")
    runs = SK.run_profile(df, "run", ["v", "none"])
    got = {r.column_name: r for r in SK.estimates(SK.merge(runs)).collect()}
    v = got["v"]
    assert (v.runs, v.rows, v.nulls, v.least, v.greatest) == (8, 60000, 6000, 1, 19999)
    assert abs(v.distinct_estimate - 18000) <= 18000 * SK.DISTINCT_ERROR
    assert all(abs(q - 20000 * r) <= 20000 * SK.RANK_ERROR for q, r in zip(v.quantile_estimates, (0.25, 0.5, 0.75)))
    assert got["none"].nulls == 60000 and got["none"].distinct_estimate == 0 and got["none"].quantile_estimates is None
    part = SK.estimates(SK.merge(runs.filter("run <> 'hot'"))).filter("column_name = 'v'").first()
    assert part.rows == 40000 and part.runs == 7
    assert SK.merge(SK.run_profile(df.limit(0), "run", ["v"])).count() == 0
