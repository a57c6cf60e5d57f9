"""The pipeline's layers over the driver tables, as lazily composed DataFrames.

Each function returns one layer; nothing is materialized until a caller
writes or counts.  The same chain runs on the bank CSVs through
:mod:`strata.plans.pipeline`; here the inputs are the adapter views of
:mod:`strata.sources.tpch`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import marts as M
from strata.operators import scd2
from strata.operators import staging as S
from strata.session import materialize
from strata.sources import tpch


def LOAD():
    return F.lit(tpch.LOAD_TS).cast("timestamp")


def RUN():
    return F.lit(tpch.RUN_TS).cast("timestamp")


def src_customer(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.raw_customers(spark, sf).withColumn("loaded_at", LOAD())


def src_account(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.raw_accounts(spark, sf).withColumn("loaded_at", LOAD())


def staged_customers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return S.stage_customers(src_customer(spark, sf), RUN(), tpch.ID_TYPE)


def staged_accounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return S.stage_accounts(src_account(spark, sf), RUN(), tpch.ID_TYPE)


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    """First snapshot of customers (timestamp strategy on loaded_at)."""
    stg, _ = staged_customers(spark, sf)
    return scd2.first_load(stg, ["customer_id"], "timestamp", LOAD(), updated_at="loaded_at")


def account_history(spark: SparkSession, sf: str) -> DataFrame:
    """First snapshot of accounts (check strategy, versions start at load)."""
    stg, _ = staged_accounts(spark, sf)
    return scd2.first_load(stg, ["account_id"], "check", LOAD())


def account_with_customer(spark: SparkSession, sf: str) -> DataFrame:
    return M.account_with_customer(account_history(spark, sf), customer_history(spark, sf))


def savings(spark: SparkSession, sf: str) -> DataFrame:
    return M.savings_only(account_with_customer(spark, sf))


def account_summary(spark: SparkSession, sf: str) -> DataFrame:
    return M.account_summary(savings(spark, sf), RUN())


def customer_profile(spark: SparkSession, sf: str) -> DataFrame:
    stg, _ = staged_customers(spark, sf)
    return M.customer_profile(account_summary(spark, sf), stg)


def chain(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All layers for queries that look at several of them: each is computed
    once, and those that feed others are written out."""
    t = {"src_customer": src_customer(spark, sf), "src_account": src_account(spark, sf)}
    stg_c, t["quarantine_stg_customer"] = staged_customers(spark, sf)
    stg_a, t["quarantine_stg_account"] = staged_accounts(spark, sf)
    t["stg_customer"], t["stg_account"] = materialize(stg_c), materialize(stg_a)
    hist_c = scd2.first_load(t["stg_customer"], ["customer_id"], "timestamp", LOAD(), updated_at="loaded_at")
    hist_a = scd2.first_load(t["stg_account"], ["account_id"], "check", LOAD())
    t["int_account_with_customer"] = materialize(M.account_with_customer(hist_a, hist_c))
    t["int_savings_account_only"] = M.savings_only(t["int_account_with_customer"])
    t["account_summary"] = materialize(M.account_summary(t["int_savings_account_only"], RUN()))
    t["customer_profile"] = M.customer_profile(t["account_summary"], t["stg_customer"])
    return t


# --- marts with seeded defects -------------------------------------------------
# Fixed defects by key, valid in both engines: inputs on which every check of
# the marts finds rows.
BAD_RATE = "CASE WHEN CAST(account_id AS BIGINT) % 13 = 0 THEN interest_rate_pct + 0.02 ELSE interest_rate_pct END"
BAD_INTEREST = "CASE WHEN CAST(account_id AS BIGINT) % 17 = 0 THEN annual_interest_amount + 1 ELSE annual_interest_amount END"
BAD_BALANCE = ("CASE WHEN CAST(account_id AS BIGINT) % 19 = 0 THEN NULL "
               "WHEN CAST(account_id AS BIGINT) % 23 = 0 THEN new_balance_amount - 0.5 ELSE new_balance_amount END")
BAD_ACCOUNTS = "CASE WHEN customer_id % 7 = 0 THEN total_accounts_count + 1 ELSE total_accounts_count END"
BAD_TOTAL = "CASE WHEN customer_id % 11 = 0 THEN total_balance_amount - 10 ELSE total_balance_amount END"
LOST_SAVINGS = "CAST(account_id AS BIGINT) % 29 <> 0"
EARLY = "2024-01-20 00:00:00"  # a check time before the events end: some open versions start after it


def defective_summary(spark: SparkSession, sf: str) -> DataFrame:
    return account_summary(spark, sf).selectExpr(
        "account_id", "customer_id", "original_balance_amount", f"CAST({BAD_RATE} AS DECIMAL(5,4)) AS interest_rate_pct",
        f"CAST({BAD_INTEREST} AS DECIMAL(18,2)) AS annual_interest_amount", f"CAST({BAD_BALANCE} AS DECIMAL(18,2)) AS new_balance_amount")


def defective_profile(spark: SparkSession, sf: str) -> DataFrame:
    return customer_profile(spark, sf).selectExpr(
        "customer_id", f"{BAD_ACCOUNTS} AS total_accounts_count", f"{BAD_TOTAL} AS total_balance_amount", "total_annual_interest_amount")


# --- histories over the events log -------------------------------------------
# Fixed run parameters of the history queries.
# Segment width of per-user ordered scans (one path at every size: a user's
# rows are always split by time and stitched).
SEGMENT_SECONDS = 6 * 3600
T1 = "2024-01-15 00:00:00"       # first snapshot run
T2 = "2024-01-31 00:00:00"       # second snapshot run
AS_OF = "2024-01-15 12:00:00"
ARCHIVE_BEFORE = "2024-01-10 00:00:00"
VALUE_BAND = "CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END"


def ts(v: str):
    return F.lit(v).cast("timestamp")


def event_history(spark: SparkSession, sf: str) -> DataFrame:
    """SCD-8: user -> event_type history from the whole events log."""
    log = tpch.change_log(spark, sf)
    return scd2.history_from_log(log, ["user_id"], "ts", ["event_type"], tiebreak="event_id",
                                 segment_seconds=SEGMENT_SECONDS)


def band_history(spark: SparkSession, sf: str) -> DataFrame:
    """A second history of the same key: the band of the event value."""
    log = tpch.table(spark, sf, "events").selectExpr("user_id", "ts", "event_id", f"{VALUE_BAND} AS value_band")
    return scd2.history_from_log(log, ["user_id"], "ts", ["value_band"], tiebreak="event_id",
                                 segment_seconds=SEGMENT_SECONDS)


def user_extract(spark: SparkSession, sf: str, cutoff: str) -> DataFrame:
    """Full extract of user state at ``cutoff``: each user's latest event
    before it (``max_by`` - a partial aggregate, so a hot user is reduced
    map-side).  Users whose latest event is an error are absent (deleted)."""
    log = tpch.change_log(spark, sf).filter(F.col("ts") < ts(cutoff))
    last = log.groupBy("user_id").agg(
        F.max_by(F.struct("event_type", "ts"), F.struct("ts", "event_id")).alias("s"))
    return (last.select("user_id", F.col("s.event_type").alias("event_type"), F.col("s.ts").alias("last_event_ts"))
            .filter(F.col("event_type") != F.lit("error")))


# Times of the full extracts that become a history in one pass; the last two
# are close, so that keys come and go between them.
EXTRACT_TIMES = ("2024-01-10 00:00:00", "2024-01-15 00:00:00", "2024-01-20 00:00:00", "2024-01-31 00:00:00")


def user_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """The extracts of :func:`user_extract` at all EXTRACT_TIMES, numbered, in
    one aggregate over the log."""
    log = tpch.change_log(spark, sf)
    picks = [F.max_by(F.when(F.col("ts") < ts(t), F.struct("event_type", "ts")), F.when(F.col("ts") < ts(t), F.struct("ts", "event_id"))).alias(f"s{i}")
             for i, t in enumerate(EXTRACT_TIMES)]
    last = log.groupBy("user_id").agg(*picks)
    rows = F.array(*[F.struct(F.lit(i).alias("extract_no"), F.col(f"s{i}.event_type").alias("event_type"), F.col(f"s{i}.ts").alias("last_event_ts"))
                     for i in range(len(EXTRACT_TIMES))])
    return last.select("user_id", F.inline(rows)).filter("event_type <> 'error'")


def merged_history(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    """Two snapshot runs (T1 then T2) over the user extracts."""
    kw = dict(check_cols=["event_type"]) if strategy == "check" else dict(updated_at="last_event_ts")
    h1 = scd2.snapshot(None, user_extract(spark, sf, T1), ["user_id"], strategy, ts(T1), **kw)
    return scd2.snapshot(h1, user_extract(spark, sf, T2), ["user_id"], strategy, ts(T2), **kw)


# --- incremental runs over orders as account change events --------------------
# Fixed run parameters of the incremental queries.
PREV_CUTOFF = "2000-01-01 00:00:00"     # the previous run saw changes before this
SLICE_FROM, SLICE_TO = "1996-01-01 00:00:00", "1996-02-01 00:00:00"
CHANGE_TS = "2001-09-01 00:00:00"       # time stamp of the modified accounts
LOOKBACK_DAYS = 3


def account_changes_v1(spark: SparkSession, sf: str) -> DataFrame:
    return tpch.account_events(spark, sf)


def account_changes_v2(spark: SparkSession, sf: str) -> DataFrame:
    """The source after a batch of updates: accounts with id % 17 = 0 got
    +100.00 and moved to customer + 1 when id % 34 = 0, stamped CHANGE_TS."""
    ev = tpch.account_events(spark, sf)
    hit = (F.col("account_id") % 17) == 0
    return ev.select(
        "account_id",
        F.when((F.col("account_id") % 34) == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(hit, (F.col("balance_amount") + F.lit(100)).cast("decimal(18,2)")).otherwise(F.col("balance_amount")).alias("balance_amount"),
        "account_type",
        F.when(hit, ts(CHANGE_TS)).otherwise(F.col("updated_at").cast("timestamp")).alias("updated_at"))


def rate_accounts(ev: DataFrame) -> DataFrame:
    """Keyed mart maintained incrementally: tier rate, interest, new balance."""
    from strata.functions import columns as C
    return ev.select(
        "account_id", "customer_id", F.col("balance_amount").alias("original_balance_amount"),
        C.tier_rate("balance_amount").alias("interest_rate_pct"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    ).withColumn("annual_interest_amount", C.interest("original_balance_amount", "interest_rate_pct")
                 ).withColumn("new_balance_amount", C.new_balance("original_balance_amount", "annual_interest_amount"))


def rate_profile(rated: DataFrame) -> DataFrame:
    from strata.functions import columns as C
    return rated.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_accounts_count"),
        F.sum("original_balance_amount").cast(C.MONEY_SUM).alias("total_balance_amount"),
        F.sum("annual_interest_amount").cast(C.MONEY_SUM).alias("total_annual_interest_amount"))


# --- inputs of the quality checks ---------------------------------------------
CHECK_NOW = "2024-02-05 00:00:00"
INTERVAL_END = ("CASE WHEN event_id % 11 = 0 THEN NULL "
                "ELSE ts + make_interval(0, 0, 0, 0, CAST(event_id % 7 AS INT), 0, 0) END")


def event_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """A history-shaped table with real defects: each event opens a period of
    0..6 hours (every 11th stays open), so periods of one user overlap,
    some are empty and some users hold several open versions."""
    from strata.functions.columns import version_id
    ev = tpch.table(spark, sf, "events")
    return ev.select(
        "user_id", "event_type",
        version_id(["user_id"], F.col("ts"), "event_id").alias("dbt_scd_id"),
        F.col("ts").cast("timestamp").alias("dbt_valid_from"),
        F.expr(INTERVAL_END).cast("timestamp").alias("dbt_valid_to"))


# --- inputs of the streaming queries --------------------------------------------
# Fixed rule: events arrive in six batches by day; every seventh a batch late,
# every eleventh as late as the last batch.
ARRIVAL = ("CAST(CASE WHEN event_id % 11 = 0 THEN 5 ELSE least(5, floor((day(ts) - 1) / 5) + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) END AS INT)")
# Fixed defects by key: a field too many, an id that is no number.
ORDER_LINE = ("concat(CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE '' END, CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING), ',', "
              "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING), CASE WHEN o_orderkey % 17 = 0 THEN ',surplus' ELSE '' END)")


# A result document per line item, valid in Spark and in DuckDB; texts are
# keys and declared words, so no escapes are needed.
RESULT_DOCUMENT = """CASE WHEN l_orderkey % 97 = 5 THEN concat('{"metadata": {"run_id": "', l_orderkey, '"}, "results": [{')
  ELSE concat('{"metadata":{"run_id":"', l_orderkey, '"},"results":[{"unique_id":"test.bank.check_', l_linenumber, '","status":"',
    CASE l_linenumber WHEN 1 THEN 'success' WHEN 2 THEN 'fail' WHEN 3 THEN 'warn' WHEN 4 THEN 'skipped' WHEN 5 THEN 'error' ELSE 'pass' END,
    '","message":"part ', l_partkey, '"', CASE WHEN l_suppkey % 2 = 0 THEN ',"config":{"severity":"warn"}' ELSE '' END,
    CASE WHEN l_suppkey % 3 = 0 THEN ',"table_name":"stg_account"' ELSE '' END, ',"failures":', l_linenumber, '},',
    '{"unique_id":"model.bank.part_', l_partkey, '","status":"success"},',
    CASE l_linenumber % 3 WHEN 0 THEN concat('{"unique_id":"test.bank.odd","config":"', l_suppkey, '"}') WHEN 1 THEN 'null' ELSE '{}' END, ']}') END"""
