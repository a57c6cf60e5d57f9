"""Structured Streaming forms: file ingest, idempotent keyed sink, lateness."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.streaming import ingest as STR

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType()),
                       T.StructField("ts", T.StringType())])


def _drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("k,v,ts\n" + "\n".join(lines) + "\n")


def test_stream_writes_changed_keys_only(spark, tmp):
    land, sink = f"{tmp}/landing", STR.ChangeSink(spark, f"{tmp}/changes", ["k"], ["ts"], stream=f"s-{uuid.uuid4().hex}")
    run = lambda: STR.run_available(STR.latest_state(STR.stream_ingest(spark, land, SCHEMA), ["k"], ["ts"], ["v"]), sink, mode="update")
    _drop(land, "a.csv", ["1,a,2024-01-01 00:00:00", "2,b,2024-01-01 00:00:00"] + [f"{i},x,2024-01-01 00:00:00" for i in range(10, 400)])
    run()
    _drop(land, "b.csv", ["1,a2,2024-01-02 00:00:00", "2,old,2023-12-31 00:00:00", "3,c,2024-01-02 00:00:00"])
    run()  # a second call goes on; the state is Spark's
    assert {r.k: r.v for r in sink.current().filter("k IN ('1', '2', '3')").collect()} == {"1": "a2", "2": "b", "3": "c"}
    wrote = {r.batch_id: r["count"] for r in sink.changes().groupBy("batch_id").count().collect()}
    assert list(wrote.values()) == [392, 3]
    size = lambda b: sum(os.path.getsize(f"{tmp}/changes/batch_id={b}/{f}") for f in os.listdir(f"{tmp}/changes/batch_id={b}") if f.endswith(".parquet"))
    assert size(1) < size(0)
    # a replayed micro-batch overwrites its own output
    last = sink.changes().filter("batch_id = 1").drop("batch_id").collect()
    sink(spark.createDataFrame(last, sink.changes().drop("batch_id").schema), 1)
    assert sink.changes().count() == 395
    with pytest.raises(ValueError):
        STR.run_available(STR.stream_ingest(spark, land, SCHEMA), lambda d, i: None)


def test_late_rows_are_kept_aside(spark, tmp):
    land, sink = f"{tmp}/landing", STR.LateSplitSink(spark, f"{tmp}/out", "ts", days=3, stream=f"s-{uuid.uuid4().hex}")
    batches = (["1,a,2024-01-10 00:00:00", "2,b,2024-01-01 00:00:00"], ["3,c,2024-01-07 00:00:00", "4,d,2024-01-06 23:59:59", "5,e,"], ["6,f,2024-01-09 00:00:00"])
    for i, lines in enumerate(batches):
        _drop(land, f"{i}.csv", lines)
        STR.run_available(STR.stream_ingest(spark, land, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")), sink)
    assert {r.k for r in sink.late().collect()} == {"4"} and {r.k for r in sink.on_time().collect()} == {"1", "2", "3", "5", "6"}
    sink(sink.late().drop("batch_id").select("k", "v", "ts"), 1)  # a replay is split the same way
    assert sink.late().count() == 1


def test_malformed_lines_and_drifted_files(spark, tmp):
    land, sink = f"{tmp}/landing", STR.QuarantineSink(spark, f"{tmp}/out", stream=f"s-{uuid.uuid4().hex}")
    run = lambda: STR.run_available(STR.stream_csv(spark, land, "k int, v string, ts string"), sink)
    _drop(land, "a.csv", ["1,a,x", "two,b,y", "3,c,z,surplus", "4,d"])
    run()
    with open(f"{land}/b.csv", "w") as f:
        f.write("v,k,ts\na,5,x\n")  # columns swapped
    with pytest.raises(Exception, match="(?i)header"):
        run()
    os.unlink(f"{land}/b.csv")
    _drop(land, "c.csv", ["6,e,x"])
    run()
    run()
    assert {r.k for r in sink.valid().collect()} == {1, 6}
    assert {r[STR.CORRUPT] for r in sink.malformed().collect()} == {"two,b,y", "3,c,z,surplus", "4,d"}


def test_with_lateness_drops_repeats_within_watermark(spark, tmp):
    land = f"{tmp}/ev"
    _drop(land, "a.csv", ["1,a,2024-01-05 00:00:00", "1,a,2024-01-05 00:00:00", "2,b,2024-01-05 01:00:00"])
    src = STR.stream_ingest(spark, land, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    dedup = STR.with_lateness(src, "ts", "3 days", ["k", "v"])
    out = []
    STR.run_available(dedup, lambda df, i: out.extend(df.collect()), checkpoint=f"{tmp}/ck2")
    assert sorted((r.k, r.v) for r in out) == [("1", "a"), ("2", "b")]
