"""Catalog sources and table sinks (SRC-8, SRC-10..12, SNK-3..5, SNK-8), AGG-10."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.sinks import writers as W
from strata.sources import catalog as CAT
from strata.sources import files
from tests import fixtures as FX


def test_layer_table_names():
    assert CAT.layer_table_name("raw", "customers_raw", "dev") == "raw.customers_raw"
    assert CAT.layer_table_name("marts", "account_summary", "dev") == "dev_marts.account_summary"
    assert CAT.layer_table_name("staging", "stg_account") == "staging.stg_account"
    with pytest.raises(ValueError):
        CAT.layer_table_name("gold", "x")


def test_table_load_and_modes(spark, tmp):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert not CAT.table_exists(spark, "strata_t1")
    rep = W.write_table(df, "strata_t1", mode="overwrite")
    assert rep.ok and rep.rows_written == 2 and CAT.table_exists(spark, "strata_t1")
    W.write_table(df.limit(1), "strata_t1", mode="append")
    assert CAT.load_table(spark, "strata_t1").count() == 3
    with pytest.raises(ValueError):
        W.write_table(df, "strata_t1", mode="merge")
    out = CAT.execute_query(spark, "SELECT v, count(*) AS n FROM strata_t1 GROUP BY v ORDER BY v")
    assert [tuple(r) for r in out.collect()] == [("a", 2), ("b", 1)]


def test_csv_straight_into_table(spark, tmp):
    path = FX.write(tmp, "a.csv", "AccountID,Balance\nA1,10.5\nA2,3\n")
    t = files.load_csv_to_table(spark, path, "strata_csv_t")
    assert dict(t.dtypes)["Balance"] == "double" and t.count() == 2


def test_latest_per_key_uses_order_not_hash(spark):
    df = spark.createDataFrame([(1, "zzz", dt.datetime(2024, 1, 1)), (1, "aaa", dt.datetime(2024, 1, 2))],
                               "k int, scd_id string, valid_from timestamp")
    row = M.latest_per_key(df, "k", "valid_from", "scd_id").first()
    assert row.latest == "aaa"


def test_parquet_scan_missing_path(spark, tmp):
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, f"{tmp}/missing.parquet")


def test_ingest_profile_counts(spark, tmp):
    raw = files.read_accounts(spark, FX.write(tmp, "a.csv", FX.DIRTY_ACCOUNTS))
    p = files.ingest_profile(raw, "Balance").first()
    assert p.row_count == 16 and p.null_Balance == 1 and p.negative_Balance == 1
    obs_df, obs = files.observed(raw, "ingest", "Balance")
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["row_count"] == 16 and obs.get["negative_Balance"] == 1
