"""Maintenance that costs what changed: totals by deltas, keyed tables that
rewrite touched buckets, histories from many extracts."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import buckets as B
from strata.operators import deltas as D
from strata.operators import incremental as INC
from strata.operators import scd2

VIEW = D.Totals("c", "n", {"total": "b"}, {"latest": "t"})
SCHEMA = "a int, c int, b int, t int"


def test_totals_by_deltas_equal_full_recompute(spark):
    rnd = random.Random(1)
    old = [(a, rnd.randrange(20), rnd.randrange(100), rnd.randrange(5)) for a in range(150)]
    new = [(a, rnd.randrange(25), rnd.randrange(100), rnd.randrange(5)) for a in range(140, 165)] + [(a, 3, 7, 9) for a in range(10)]
    gone = [(a,) for a in range(50, 70)]
    target, batch = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    deleted = spark.createDataFrame(gone, "a int")
    after = INC.upsert(target, batch, ["a"], deleted)
    totals = VIEW.build(target)
    changed, keys = VIEW.apply(totals, D.row_changes(target, batch, ["a"], deleted), lambda ks: after)
    got = D.refresh(totals, changed, keys, "c")
    assert sorted(got.collect()) == sorted(VIEW.build(after).collect())


def test_details_are_read_for_falling_maxima_only(spark, tmp):
    target = spark.createDataFrame([(1, 1, 5, 1), (2, 1, 5, 9), (3, 2, 5, 4), (4, 2, 6, 3), (5, 3, 1, 1)], SCHEMA)
    rising = spark.createDataFrame([(1, 1, 7, 10), (6, 4, 2, 2)], SCHEMA)
    no = lambda ks: pytest.fail("details were read")
    changed, keys = VIEW.apply(VIEW.build(target), D.row_changes(target, rising, ["a"]), no)
    assert sorted((r.c, r.n, int(r.total), r.latest) for r in changed.collect()) == [(1, 2, 12, 10), (4, 1, 2, 2)]
    # Customer 1 loses its latest row: its details are looked up, in its
    # buckets; those of the untouched customers are not even opened.
    batch = spark.createDataFrame([(2, 3, 5, 9)], SCHEMA)
    held = B.KeyedTable(spark, f"t_{uuid.uuid4().hex}", ["c"], buckets=16)
    held.create(INC.upsert(target, batch, ["a"]), f"{tmp}/held")
    opened = []

    def details(ks):
        rows = held.read_keys(ks)
        opened.extend(held.touched(ks))
        files = [f for f in rows.inputFiles() if "/held/" in f]
        assert files and all(f"{B.BUCKET}={held.touched(ks)[0]}/" in f for f in files)
        return rows

    changed, _ = VIEW.apply(VIEW.build(target), D.row_changes(target, batch, ["a"]), details)
    assert sorted((r.c, r.n, int(r.total), r.latest) for r in changed.collect()) == [(1, 1, 5, 1), (3, 2, 6, 9)]
    assert opened == held.touched(spark.createDataFrame([(1,)], "c int"))
    with pytest.raises(ValueError):
        VIEW.apply(VIEW.build(target), D.row_changes(target, batch, ["a"]))
    with pytest.raises(Exception, match="null in summed column"):
        VIEW.apply(VIEW.build(target), D.row_changes(target, spark.createDataFrame([(9, 1, None, 1)], SCHEMA), ["a"]), no)


def test_merge_leaves_untouched_buckets_alone(spark, tmp):
    held = B.KeyedTable(spark, f"t_{uuid.uuid4().hex}", ["a"], buckets=16)
    target = spark.createDataFrame([(a, a, a, a) for a in range(200)], SCHEMA)
    held.create(target, f"{tmp}/t")
    files = lambda: {f.rsplit(f"{B.BUCKET}=", 1)[1].split("/")[0]: f for f in spark.table(held.name).inputFiles()}
    before = files()
    batch = spark.createDataFrame([(5, 0, 0, 0), (500, 1, 1, 1)], SCHEMA)
    touched = held.merge(batch, spark.createDataFrame([(7,)], "a int"))
    after = files()
    assert 0 < len(touched) <= 3 and {int(b) for b in before if before[b] != after[b]} == set(touched)
    want = INC.upsert(target, batch, ["a"], spark.createDataFrame([(7,)], "a int"))
    assert sorted(held.read().collect()) == sorted(want.collect())
    held.merge(batch, spark.createDataFrame([(7,)], "a int"))  # again: the same table
    assert sorted(held.read().collect()) == sorted(want.collect())
    # A bucket may lose all its rows.
    gone = held.read([touched[0]]).select("a")
    left = sorted(held.read().join(gone, "a", "left_anti").collect())
    assert held.merge(spark.createDataFrame([], SCHEMA), gone) == [touched[0]]
    assert sorted(held.read().collect()) == left and held.read([touched[0]]).count() == 0
    held.merge(spark.createDataFrame([(5, 1, 1, 1)], SCHEMA))
    assert held.read().filter("a = 5").count() == 1 and held.merge(spark.createDataFrame([], SCHEMA)) == []
    with pytest.raises(scd2.DuplicateKeyError):
        held.merge(batch.union(batch))
    with pytest.raises(INC.SchemaChangeError):
        held.merge(batch.drop("t"))


@pytest.mark.parametrize("strategy", ["check", "timestamp"])
@pytest.mark.parametrize("deletes", [True, False])
def test_history_from_extracts_equals_successive_merges(spark, strategy, deletes):
    rnd = random.Random(4)
    times = [dt.datetime(2024, 1, d) for d in (1, 3, 4, 8, 9, 20)]
    extracts, stamps = [], {}
    for n, t in enumerate(times):
        rows = []
        for k in range(40):
            if n != 3 and rnd.random() < 0.8:  # extract 3 is empty
                if k not in stamps or rnd.random() < 0.5:
                    stamps[k] = (rnd.choice(["x", "y", None]), t - dt.timedelta(hours=rnd.randrange(1, 20)))
                rows.append((k, *stamps[k], n))
        extracts.append(rows)
    schema = "k int, v string, seen timestamp, extract_no int"
    kw = dict(check_cols=["v"]) if strategy == "check" else dict(updated_at="seen")
    history = None
    for t, rows in zip(times, extracts, strict=True):
        current = spark.createDataFrame(rows, schema).drop("extract_no")
        history = scd2.snapshot(history, current, ["k"], strategy, F.lit(t).cast("timestamp"), invalidate_hard_deletes=deletes, **kw)
        history = spark.createDataFrame(history.collect(), history.schema)
    every = spark.createDataFrame([r for rows in extracts for r in rows], schema)
    got = scd2.history_from_extracts(every, times, ["k"], strategy, invalidate_hard_deletes=deletes, **kw)
    cols = ["k", "v", "seen", scd2.SCD_ID, scd2.UPDATED, scd2.VFROM, scd2.VTO]
    order = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    if strategy == "timestamp" and deletes:  # a key may come back with its old stamp: the merge opens a version of zero or negative length, too
        assert len(order(got)) == len(order(history))
    assert order(got) == order(history)


def test_history_from_extracts_refuses_repeated_keys(spark):
    rows = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], "k int, v string, extract_no int")
    with pytest.raises(scd2.DuplicateKeyError):
        scd2.history_from_extracts(rows, [dt.datetime(2024, 1, 1)], ["k"])
