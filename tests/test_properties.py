"""Property tests over random change logs (seeded by Hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import quality as DQ
from strata.operators import scd2

BASE = dt.datetime(2024, 1, 1)

logs = st.lists(
    st.tuples(st.integers(1, 4), st.sampled_from(["a", "b", "c", None]), st.integers(0, 8)),
    min_size=1, max_size=12,
).map(lambda rows: list({(k, h): (k, v, h) for k, v, h in rows}.values()))   # (key, hour) unique


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=logs)
def test_log_history_equals_repeated_snapshots(spark, rows):
    data = [(k, v, BASE + dt.timedelta(hours=h)) for k, v, h in rows]
    log = spark.createDataFrame(data, "k long, v string, ts timestamp")
    one_pass = scd2.history_from_log(log, ["k"], "ts", ["v"], segment_seconds=6 * 3600)
    assert DQ.scd2_overlap(one_pass, ["k"]).isEmpty()
    assert DQ.open_versions(one_pass, ["k"]).isEmpty()
    # replay: one snapshot run per instant, each extract = latest value per key so far
    h, state = None, {}
    for t in sorted({d[2] for d in data}):
        for k, v, ts in data:
            if ts == t:
                state[k] = v
        cur = spark.createDataFrame(sorted(state.items()), "k long, v string")
        h = scd2.snapshot(h, cur, ["k"], "check", F.lit(t).cast("timestamp"), check_cols=["v"])
    a = one_pass.select("k", "v", "dbt_valid_from", "dbt_valid_to")
    b = h.select("k", "v", "dbt_valid_from", "dbt_valid_to")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
