"""Incremental operators, quality checks/report/gate, sinks and publishing."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.operators import incremental as INC
from strata.operators import quality as DQ
from strata.operators import report as REP
from strata.plans.runs import History, Warehouse
from strata.sinks import writers as W

D = lambda d, h=0: dt.datetime(2024, 1, d, h)


def test_watermark_default_and_lookback(spark):
    assert INC.watermark(None, "ts") == INC.DEFAULT_MARK
    empty = spark.createDataFrame([], "ts timestamp")
    assert INC.watermark(empty, "ts") == INC.DEFAULT_MARK
    target = spark.createDataFrame([(D(1, 10),)], "ts timestamp")
    mark = INC.watermark(target, "ts")
    src = spark.createDataFrame([(dt.datetime(2023, 12, 30, 10),), (D(1, 11),)], "ts timestamp")
    assert INC.since(src, "ts", mark).count() == 1                      # strict '>' drops the late row
    assert INC.since(src, "ts", mark, lookback_days=3).count() == 2     # the 3-day lookback admits it


def test_upsert_and_schema_guard(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(tuple(r) for r in INC.upsert(t, b, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert INC.upsert(None, b, ["k"]).count() == 2
    with pytest.raises(INC.SchemaChangeError):
        INC.upsert(t, b.withColumn("extra", F.lit(1)), ["k"])


def test_ten_changed_of_thousand_touch_ten_rows(spark):
    """1000 accounts, 10 changed -> only 10 rows recomputed."""
    from strata.functions.columns import padded_key
    base = spark.range(1, 1001).select(padded_key("A", F.col("id"), 5).alias("account_id"),
                                       (F.col("id") * 100).cast("decimal(18,2)").alias("balance"))
    changed = base.withColumn("balance", F.when(F.col("account_id") <= "A00010", (F.col("balance") + 1).cast("decimal(18,2)"))
                              .otherwise(F.col("balance")))
    keys = changed.exceptAll(base).select("account_id")
    assert keys.count() == 10
    out = INC.refresh_keys(base, changed, keys, "account_id", lambda d: d)
    assert out.exceptAll(changed).isEmpty() and changed.exceptAll(out).isEmpty()


def test_backfill_replaces_only_the_slice(spark):
    t = spark.createDataFrame([(1, D(1), 10), (2, D(5), 20)], "k int, ts timestamp, v int")
    r = spark.createDataFrame([(1, D(1), 11), (2, D(5), 99)], "k int, ts timestamp, v int")
    out = INC.backfill(t, r, F.col("ts") < F.lit(D(3)))
    assert sorted(tuple(x) for x in out.select("k", "v").collect()) == [(1, 11), (2, 20)]


def test_checks_and_report(spark):
    df = spark.createDataFrame([(1, Decimal("5.00"), "savings"), (2, Decimal("0.00"), "savings"),
                                (2, None, "other"), (None, Decimal("-1.00"), None)],
                               "id int, amt decimal(18,2), typ string")
    assert DQ.not_null(df, "id").count() == 1
    assert [tuple(r) for r in DQ.unique(df, ["id"]).collect()] == [(2, 2)]
    assert [tuple(r) for r in DQ.accepted_values(df, "typ", ["savings"]).collect()] == [("other", 1)]
    assert DQ.positive_value(df, "amt").count() == 3       # 0.00, NULL, -1.00 grouped by value
    assert DQ.accepted_range(df, "amt", 0, 10).count() == 1
    assert DQ.expression_is_true(df, "amt >= 0").count() == 1
    assert DQ.row_count_positive(df.limit(0)).count() == 1
    s = DQ.Suite({"stg_x": df, "fact": df})
    s.add(DQ.Check("stg_x", "nn_id", condition=DQ.cond_not_null("id"), column="id"),
          DQ.Check("stg_x", "pos_amt", condition=DQ.cond_not_positive("amt"), severity="warn"),
          DQ.Check("fact", "uniq_id", violations=lambda: DQ.unique(df, ["id"]), error_if=5),
          DQ.Check("fact", "rows", violations=lambda: DQ.row_count_positive(df)))
    res = {r.test_name: r for r in s.results("r1").collect()}
    assert res["nn_id"].status == "fail" and res["nn_id"].layer == "staging"
    assert res["pos_amt"].status == "warn" and res["uniq_id"].status == "warn"   # 1 <= error_if
    assert res["rows"].status == "pass" and res["rows"].layer == "marts" and res["rows"].message is None
    results = s.results("r1")
    summ = {(r.grouping_level, r.group_value): r for r in REP.summary(results).collect()}
    assert summ[("overall", "all")].total == 4 and summ[("overall", "all")].passed == 1
    assert summ[("overall", "all")].pass_rate == Decimal("25.00")
    assert summ[("layer", "staging")].failed == 1
    assert summ[("severity", "warn")].warned == 1
    g = REP.gate(results).first()
    assert g.passed is False and g.level == "error"
    g2 = REP.gate(results.filter("status != 'fail'")).first()
    assert g2.passed is True and g2.level == "warn"
    empty = REP.overall(results.limit(0)).first()
    assert empty.total == 0 and empty.pass_rate == Decimal("0.00")
    assert REP.gate(results.limit(0)).first().level == "ok"


def test_recency(spark):
    df = spark.createDataFrame([(D(1),)], "ts timestamp")
    r = DQ.recency(df, "ts", F.lit(D(3)).cast("timestamp"), 24).first()
    assert r.is_stale is True and r.age_hours == Decimal("48.00")
    assert DQ.recency(df.limit(0), "ts", F.lit(D(3)).cast("timestamp"), 24).first().is_stale is True


def test_writers_validate_and_compare(spark, tmp):
    df = spark.createDataFrame([(1, Decimal("1.50"), D(1))], "k int, v decimal(18,2), t timestamp")
    r1 = W.write_csv(df, f"{tmp}/csv")
    r2 = W.write_parquet(df, f"{tmp}/pq")
    assert r1.ok and r2.ok and r1.rows_written == 1 and r1.columns == 3
    back = spark.read.schema(df.schema).option("header", True).csv(f"{tmp}/csv")
    assert W.compare_outputs(back, spark.read.parquet(f"{tmp}/pq")).isEmpty()
    with pytest.raises(ValueError):
        W.write_csv(df, f"{tmp}/x", mode="ignore")
    tagged = df.withColumn("failure_reason", F.lit(None).cast("string"))
    W.write_split(tagged, f"{tmp}/split")
    assert os.path.isdir(f"{tmp}/split/_route=valid")


def test_report_sink_latest(spark, tmp):
    a = spark.createDataFrame([("x", 1)], "test_name string, violations long")
    W.save_report(a, f"{tmp}/rep", "run-9", D(1))
    W.save_report(a.withColumn("violations", F.lit(2).cast("long")), f"{tmp}/rep", "run-10", D(2))
    latest = W.latest_report(spark, f"{tmp}/rep").collect()
    assert len(latest) == 1 and latest[0].violations == 2


def test_runs_are_published_once_and_in_order(spark, tmp):
    wh = Warehouse(spark, f"{tmp}/wh")
    assert not wh.exists("t") and wh.begin("run-1", D(1))
    wh.stage("t", spark.range(3))
    assert not Warehouse(spark, f"{tmp}/wh").exists("t")  # staged, not visible
    wh.commit()
    assert not wh.begin("run-1", D(1)) and wh.read("t").count() == 3
    assert wh.begin("run-2", D(2))
    wh.stage("t", wh.read("t").union(spark.range(3, 4)))  # reads run-1, writes run-2
    wh.commit()
    assert wh.last("t") == "run-2" and wh.read("t").count() == 4


def test_history_appends_closed_and_replaces_open(spark, tmp):
    from strata.operators import scd2
    wh = Warehouse(spark, f"{tmp}/wh")
    hs = History(wh, "snap")
    for i, rows in enumerate(([(1, "a"), (2, "b")], [(1, "a2")])):
        assert wh.begin(f"r{i}", D(i + 1))
        t = F.lit(D(i + 1)).cast("timestamp")
        hs.stage(scd2.snapshot(hs.open_versions(), spark.createDataFrame(rows, "k long, v string"), ["k"], "check", t))
        if i:
            assert {r.k for r in hs.touched_keys(["k"], t).collect()} == {1, 2}
        wh.commit()
    assert hs.read().count() == 3 and hs.open_versions().count() == 1


def test_subquery_predicates_and_gate_without_results(spark, tmp):
    from strata.operators import marts as M
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ok = spark.createDataFrame([(1,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in M.in_subquery(df, "k", ok, "k").collect()] == [1]
    assert [r.k for r in M.not_in_subquery(df, "k", ok, "k").collect()] == [2]
    assert M.not_in_subquery(df, "k", with_null, "k").count() == 0
    assert REP.gate_from_path(spark, f"{tmp}/missing") == {"tests": 0, "failing": 0, "warning": 0,
                                                          "passed": False, "level": "warn"}
    assert M.preview(df, 2).count() == 2


def test_history_growth_under_repeated_ten_percent_changes(spark):
    """QRY-8 on generated inputs: five runs changing 10 % of 500 accounts each
    keep the history under 5x the first load and under 10 versions per key."""
    from strata.operators import history as H
    from strata.operators import scd2
    from strata.operators import staging as S
    from strata.session import materialize
    from strata.sources import generate as G
    h = None
    for v in range(6):
        raw = G.accounts(spark, 500, 100, version=v, changed_pct=10 if v else 0)
        src = S.rename_cast(raw, S.ACCOUNT_RAW_NAMES, F.lit(D(1 + v)).cast("timestamp"))
        stg, rejected = S.stage_accounts(src, F.lit(D(1 + v)).cast("timestamp"))
        assert rejected.isEmpty()
        h = materialize(scd2.snapshot(h, stg, ["account_id"], "check", F.lit(D(1 + v)).cast("timestamp"),
                                      check_cols=["customer_id", "balance_amount", "account_type"]))
    g = H.growth(h, F.col("dbt_valid_from") == F.lit(D(1)).cast("timestamp"), ["account_id"]).first()
    assert g.versions_before == 500 and 500 < g.versions_after < 5 * 500
    assert H.multi_version(h, ["account_id"]).filter("versions_count >= 10").isEmpty()
    assert DQ.scd2_overlap(h, ["account_id"]).isEmpty()
    assert h.filter("dbt_valid_to IS NULL").count() == 500


def test_checkpoint_folder_is_the_configured_one_and_stable(spark):
    from strata.session import checkpoint_dir, materialize
    first = checkpoint_dir(spark)
    assert all(checkpoint_dir(spark) == first for _ in range(3))
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert first == conf.rstrip("/")
    df = materialize(spark.range(5))
    assert df.count() == 5 and all(first in f for f in df.inputFiles())


def test_compare_outputs_with_tolerance(spark):
    a = spark.createDataFrame([("A1", Decimal("10.00"), "x"), ("A2", Decimal("5.00"), "y")],
                              "k string, v decimal(18,2), s string")
    b = spark.createDataFrame([("A1", 10.004, "x"), ("A2", 5.02, "y"), ("A3", 1.0, "z")],
                              "k string, v double, s string")
    assert sorted(r.k for r in W.compare_outputs_by_key(a, b, ["k"]).collect()) == ["A2", "A3"]
