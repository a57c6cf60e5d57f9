"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the ``noop`` sink (every row computed,
nothing collected), first cold (``queries_cold``: includes compiling its
plans) and then warm (``queries``, the median of ``$BENCH_REPEAT`` runs).  The
layered pipeline (with CSV and Parquet exports and their post-write checks) is
timed as a full build and as an incremental run after a 10 % change of the
account file, on CSV inputs derived from the driver tables (setup not timed).

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from strata.plans import queries as Q  # noqa: E402
from strata.session import checkpoint_dir, get_spark  # noqa: E402
from strata.sinks.writers import CSV_OPTIONS  # noqa: E402
from strata.sources import tpch  # noqa: E402

HEADLINE = ["account_summary", "customer_profile", "quarantine_antijoin", "scd2_from_log", "scd2_merge_check",
            "pit_join", "upsert", "changed_key_profile", "dq_scd2_overlap", "dq_unique", "quality_report"]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def pipeline_inputs(spark, sf: str, root: str) -> dict[str, str]:
    """Raw bank-style CSVs from the driver tables; the second account file
    changes 10 % of the accounts (balance + 1.00)."""
    cust = tpch.raw_customers(spark, sf).select(
        F.col("customer_id").alias("CustomerID"), F.col("name").alias("Name"), F.col("has_loan").alias("HasLoan"))
    # The integer-typed bank contract: ids as plain integers.
    acct = tpch.raw_accounts(spark, sf).select(
        F.col("account_id").alias("AccountID"), F.col("customer_id").alias("CustomerID"),
        F.col("balance").alias("Balance"), F.col("account_type").alias("AccountType"))
    changed = acct.withColumn(
        "Balance", F.when((F.xxhash64("AccountID") % 10 == 0) & F.col("Balance").try_cast("decimal(18,2)").isNotNull(),
                          (F.col("Balance").try_cast("decimal(18,2)") + 1).cast("string"))
        .otherwise(F.col("Balance")))
    paths = {"c": f"{root}/in/customers", "a1": f"{root}/in/accounts1", "a2": f"{root}/in/accounts2"}
    for df, key in ((cust, "c"), (acct, "a1"), (changed, "a2")):
        df.write.mode("overwrite").options(**CSV_OPTIONS).csv(paths[key])
    return paths


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(f"local[{cpus}]", app="strata-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    checkpoint_dir(spark)
    results: dict[str, float] = {}
    cold: dict[str, float] = {}

    # warm-up: JIT and file listing caches
    run_noop(Q.REGISTRY["account_clean"](spark, sf))

    for name in HEADLINE:
        cold[name] = round(timed(lambda n=name: run_noop(Q.REGISTRY[n](spark, sf)), 1), 3)
        results[name] = round(timed(lambda n=name: run_noop(Q.REGISTRY[n](spark, sf)), repeat), 3)

    from strata.plans import pipeline as P
    root = f"{checkpoint_dir(spark)}/bench-{uuid.uuid4().hex[:8]}"
    paths = pipeline_inputs(spark, sf, root)
    # Two independent warehouses: the first pair of runs is cold (first
    # compilation of every plan), the second pair is the steady state.
    for label, wh in (("cold", f"{root}/wh_cold"), ("warm", f"{root}/wh_warm")):
        out = cold if label == "cold" else results
        cfg = P.RunConfig(customers_path=paths["c"], accounts_path=paths["a1"], warehouse=wh,
                          run_id="r1", run_ts=dt.datetime(2024, 2, 1), id_type="bigint",
                          export_dir=f"{wh}/exports", stop_on_error=False)
        t0 = time.perf_counter()
        P.run(spark, cfg)
        out["pipeline_full_build"] = round(time.perf_counter() - t0, 3)
        cfg2 = P.RunConfig(customers_path=paths["c"], accounts_path=paths["a2"], warehouse=wh,
                           run_id="r2", run_ts=dt.datetime(2024, 2, 2), id_type="bigint",
                           export_dir=f"{wh}/exports", stop_on_error=False)
        t0 = time.perf_counter()
        P.run(spark, cfg2)
        out["pipeline_incremental_10pct"] = round(time.perf_counter() - t0, 3)

    lineitem_rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    orders_rows = spark.read.parquet(f"{sf}/orders.parquet").count()
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": results,
                      "queries_cold": cold, "total_cold": round(sum(cold.values()), 3),
                      "sf": os.path.basename(sf.rstrip("/")), "cpus": cpus, "repeat": repeat,
                      "rows": {"lineitem": lineitem_rows, "orders": orders_rows},
                      "orders_rows_per_sec_full_build": round(orders_rows / results["pipeline_full_build"], 1)}))


if __name__ == "__main__":
    main()
