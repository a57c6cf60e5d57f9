"""Skew-safe keyed scans, SCD2 operators and history queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import history as H
from strata.operators import ordered
from strata.operators import quality as DQ
from strata.operators import scd2
from strata.plans import layers as L
from strata.sources import tpch


def _hot_events(spark, sf):
    """The events table with a third of the rows moved onto one user."""
    ev = tpch.table(spark, sf, "events")
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("direction", ["prev", "next"])
def test_segmented_shift_equals_plain(spark, sf, direction):
    ev = _hot_events(spark, sf).select("user_id", "ts", "event_id", "event_type")
    plain = ordered.shift(ev, ["user_id"], ["ts", "event_id"], ["event_type", "ts"], direction, "p_")
    seg = ordered.shift(ev, ["user_id"], ["ts", "event_id"], ["event_type", "ts"], direction, "p_",
                        ordered.time_segment("ts", 3600))
    _same(plain, seg)


def test_segmented_prefix_max_and_ffill_equal_plain(spark, sf):
    ev = _hot_events(spark, sf).select("user_id", "ts", "event_id", "value",
                                       F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("sparse"))
    seg = ordered.time_segment("ts", 7200)
    _same(ordered.prefix_max(ev, ["user_id"], ["ts", "event_id"], "value"),
          ordered.prefix_max(ev, ["user_id"], ["ts", "event_id"], "value", segment=seg))
    _same(ordered.ffill(ev, ["user_id"], ["ts", "event_id"], ["sparse"]),
          ordered.ffill(ev, ["user_id"], ["ts", "event_id"], ["sparse"], segment=seg))


def test_segmented_row_number_equals_plain(spark, sf):
    ev = _hot_events(spark, sf).select("user_id", "ts", "event_id")
    _same(ordered.row_number(ev, ["user_id"], ["ts", "event_id"]),
          ordered.row_number(ev, ["user_id"], ["ts", "event_id"], segment=ordered.time_segment("ts", 3600)))


def test_history_from_log_segmented_equals_plain_and_is_valid(spark, sf):
    log = _hot_events(spark, sf)
    a = scd2.history_from_log(log, ["user_id"], "ts", ["event_type"], "event_id")
    b = scd2.history_from_log(log, ["user_id"], "ts", ["event_type"], "event_id", segment_seconds=3600)
    _same(a, b)
    assert DQ.scd2_overlap(b, ["user_id"]).isEmpty()
    assert DQ.open_versions(b, ["user_id"]).isEmpty()
    assert b.filter("dbt_valid_to IS NULL").count() == b.select("user_id").distinct().count()


def _lit_history(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, dbt_scd_id string, dbt_updated_at timestamp, "
                                       "dbt_valid_from timestamp, dbt_valid_to timestamp")


D = lambda d, h=0: dt.datetime(2024, 1, d, h)


def test_as_of_boundary_returns_one_version(spark):
    h = _lit_history(spark, [(1, "x", "i1", D(1), D(1), D(5)), (1, "y", "i2", D(5), D(5), None)])
    rows = H.as_of(h, F.lit(D(5)).cast("timestamp")).collect()
    assert [r.a for r in rows] == ["y"]
    assert [r.a for r in H.as_of(h, F.lit(D(4)).cast("timestamp")).collect()] == ["x"]


def test_overlap_check_matches_brute_force(spark):
    rows = [(1, "a", "v1", D(1), D(1), D(3)), (1, "b", "v2", D(2), D(2), D(4)),   # overlap
            (1, "c", "v3", D(4), D(4), D(6)),                                     # adjacent: fine
            (2, "a", "w1", D(1), D(1), D(9)), (2, "b", "w2", D(3), D(3), D(4)),   # nested
            (3, "a", "z1", D(1), D(1), D(1)), (3, "b", "z2", D(1), D(1), D(2)),   # zero length, tie
            (4, "a", "u1", D(1), D(1), None), (4, "b", "u2", D(2), D(2), None)]   # two open
    h = _lit_history(spark, rows)
    flagged = {r.dbt_scd_id for r in DQ.scd2_overlap(h, ["k"]).collect()}
    flagged_seg = {r.dbt_scd_id for r in DQ.scd2_overlap(h, ["k"], segment_seconds=3600).collect()}
    inf = dt.datetime(9999, 12, 31)
    pairs = {(a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[2] != b[2]
             and a[4] < (b[5] or inf) and b[4] < (a[5] or inf)}
    bad_keys = {a for a, _ in pairs} | {b for _, b in pairs}
    # every flagged version takes part in an overlapping pair, and every key
    # with an overlapping pair is flagged
    assert flagged == flagged_seg
    assert flagged <= bad_keys
    assert {r[0] for r in rows if r[2] in flagged} == {r[0] for r in rows if r[2] in bad_keys}


def test_snapshot_scenarios(spark):
    t1, t2, t3 = (F.lit(D(d)).cast("timestamp") for d in (1, 2, 3))
    cur1 = spark.createDataFrame([(1, "ann"), (2, "bob"), (3, "cy")], "k long, name string")
    h1 = scd2.snapshot(None, cur1, ["k"], "check", t1)
    cur2 = spark.createDataFrame([(1, "ann2"), (2, "bob"), (4, "dee")], "k long, name string")
    h2 = scd2.snapshot(h1, cur2, ["k"], "check", t2)
    rows = {(r.k, r.name): r for r in h2.collect()}
    assert rows[(1, "ann")].dbt_valid_to == D(2) and rows[(1, "ann2")].dbt_valid_to is None
    assert rows[(2, "bob")].dbt_valid_from == D(1) and rows[(2, "bob")].dbt_valid_to is None
    assert rows[(3, "cy")].dbt_valid_to == D(2)            # hard delete
    assert rows[(4, "dee")].dbt_valid_from == D(2)
    cur3 = spark.createDataFrame([(1, "ann2"), (2, "bob"), (3, "cy"), (4, "dee")], "k long, name string")
    h3 = scd2.snapshot(h2, cur3, ["k"], "check", t3)       # re-insert of 3
    k3 = sorted((r.dbt_valid_from, r.dbt_valid_to) for r in h3.filter("k = 3").collect())
    assert k3 == [(D(1), D(2)), (D(3), None)]
    assert h3.filter("dbt_valid_to IS NULL").count() == 4
    assert DQ.scd2_overlap(h3, ["k"]).isEmpty()
    # second run without change is a no-op
    h4 = scd2.snapshot(h3, cur3, ["k"], "check", F.lit(D(4)).cast("timestamp"))
    assert h4.count() == h3.count()


def test_timestamp_strategy_ignores_older_rows(spark):
    cur1 = spark.createDataFrame([(1, "a", D(5))], "k long, v string, upd timestamp")
    h1 = scd2.snapshot(None, cur1, ["k"], "timestamp", F.lit(D(6)).cast("timestamp"), updated_at="upd")
    late = spark.createDataFrame([(1, "b", D(4))], "k long, v string, upd timestamp")
    assert scd2.snapshot(h1, late, ["k"], "timestamp", F.lit(D(7)).cast("timestamp"), updated_at="upd").count() == 1
    newer = spark.createDataFrame([(1, "c", D(8))], "k long, v string, upd timestamp")
    h2 = scd2.snapshot(h1, newer, ["k"], "timestamp", F.lit(D(9)).cast("timestamp"), updated_at="upd")
    got = sorted((r.v, r.dbt_valid_from, r.dbt_valid_to) for r in h2.collect())
    assert got == [("a", D(5), D(8)), ("c", D(8), None)]


def test_duplicate_extract_keys_raise(spark):
    cur = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(scd2.DuplicateKeyError):
        scd2.snapshot(None, cur, ["k"], "check", F.current_timestamp(), check_unique=True)


def test_history_from_log_equals_repeated_snapshots(spark):
    """Property: the one-pass history equals running the timestamp snapshot
    once per change-log instant."""
    log_rows = [(1, "a", D(1)), (1, "a", D(2)), (1, "b", D(3)), (2, "x", D(2)), (2, "y", D(4)), (1, "a", D(5))]
    log = spark.createDataFrame(log_rows, "k long, v string, ts timestamp")
    one_pass = scd2.history_from_log(log, ["k"], "ts", ["v"]).select("k", "v", "dbt_valid_from", "dbt_valid_to")
    h = None
    state = {}
    for d in sorted({r[2] for r in log_rows}):
        for k, v, ts in log_rows:
            if ts == d:
                state[k] = (v, ts)
        cur = spark.createDataFrame([(k, v, ts) for k, (v, ts) in state.items()], "k long, v string, ts timestamp")
        h = scd2.snapshot(h, cur, ["k"], "check", F.lit(d).cast("timestamp"), check_cols=["v"])
    repeated = h.select("k", "v", "dbt_valid_from", "dbt_valid_to")
    _same(one_pass, repeated)


def test_pit_join_matches_interval_join(spark, sf):
    a = L.event_history(spark, sf)
    b = L.band_history(spark, sf)
    sweep = H.pit_join(a, b, ["user_id"], ["event_type"], ["value_band"], segment_seconds=86400)
    inf = F.lit(dt.datetime(9999, 12, 31)).cast("timestamp")
    x, y = a.alias("x"), b.alias("y")
    brute = x.join(y, (F.col("x.user_id") == F.col("y.user_id"))
                   & (F.col("x.dbt_valid_from") < F.coalesce(F.col("y.dbt_valid_to"), inf))
                   & (F.col("y.dbt_valid_from") < F.coalesce(F.col("x.dbt_valid_to"), inf))).select(
        F.col("x.user_id").alias("user_id"), F.col("x.event_type").alias("event_type"),
        F.col("y.value_band").alias("value_band"),
        F.greatest("x.dbt_valid_from", "y.dbt_valid_from").alias("dbt_valid_from"),
        F.least(F.coalesce("x.dbt_valid_to", inf), F.coalesce("y.dbt_valid_to", inf)).alias("_to"))
    brute = brute.select("user_id", "event_type", "value_band", "dbt_valid_from",
                         F.when(F.col("_to") == inf, None).otherwise(F.col("_to")).alias("dbt_valid_to"))
    _same(sweep, brute)


def test_metrics_and_retention(spark, sf):
    h = L.event_history(spark, sf)
    m = H.storage_metrics(h, ["user_id"]).first()
    assert m.total_versions == m.open_versions + m.closed_versions == h.count()
    archive, keep = scd2.archive_split(h, F.lit(D(10)).cast("timestamp"))
    assert archive.count() + keep.count() == h.count()
    assert archive.filter("dbt_valid_to IS NULL").isEmpty()
    assert H.multi_version(h, ["user_id"]).filter("versions_count <= 1").isEmpty()


def test_bursty_hot_key_is_split(spark):
    """A key whose rows all fall into one minute is cut by a narrow segment;
    the result does not change."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(milliseconds=500 * i), "ab"[i // 7 % 2], i) for i in range(100)] + [(2, t0, "a", 200), (2, t0, "b", 201)]
    log = spark.createDataFrame(rows, "k long, ts timestamp, v string, id long")
    plain = scd2.history_from_log(log, ["k"], "ts", ["v"], "id")
    cut = scd2.history_from_log(log, ["k"], "ts", ["v"], "id", segment_seconds=5)
    assert plain.exceptAll(cut).isEmpty() and cut.exceptAll(plain).isEmpty()
    assert plain.select("dbt_scd_id").distinct().count() == plain.count()
    assert ordered.with_segment(log, "ts", 5).groupBy("k", ordered.SEG).count().agg({"count": "max"}).first()[0] == 10
