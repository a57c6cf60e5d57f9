"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family of the inventory.  Each reads the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.functions import names as N
from strata.operators import marts as M
from strata.operators import quarantine as Q
from strata.plans import layers as L
from strata.sources import tpch

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# --- staging and quarantine -------------------------------------------------

@register("customer_clean")
def customer_clean(spark, sf):
    return L.staged_customers(spark, sf)[0]


@register("account_clean")
def account_clean(spark, sf):
    return L.staged_accounts(spark, sf)[0]


@register("customer_quarantine")
def customer_quarantine(spark, sf):
    return L.staged_customers(spark, sf)[1]


@register("account_quarantine")
def account_quarantine(spark, sf):
    return L.staged_accounts(spark, sf)[1]


@register("quarantine_antijoin")
def quarantine_antijoin(spark, sf):
    src = L.src_account(spark, sf)
    _, rejected = Q.split(src, Q.account_rules(id_type=tpch.ID_TYPE))
    return Q.quarantine_antijoin(src, rejected, ["account_id", "customer_id", "balance", "account_type"])


@register("clean_string")
def clean_string(spark, sf):
    raw = tpch.raw_customers(spark, sf)
    return raw.select(F.col("customer_id").alias("raw_customer_id"),
                      C.clean_string("name").alias("name_clean"),
                      C.clean_string("has_loan").alias("has_loan_clean"))


@register("standardize_boolean")
def standardize_boolean(spark, sf):
    raw = tpch.raw_customers(spark, sf)
    return raw.select(F.col("customer_id").alias("raw_customer_id"), "has_loan",
                      C.standardize_boolean("has_loan").alias("has_loan_bool"))


@register("standardize_names")
def standardize_names(spark, sf):
    raw = tpch.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias("Name-Full"),
        F.col("c_acctbal").alias("Acct Bal (USD)"), F.col("c_mktsegment").alias("Mkt Segment"))
    return N.standardize_names(raw)


# --- intermediate and marts ---------------------------------------------------

@register("account_with_customer")
def account_with_customer(spark, sf):
    return L.account_with_customer(spark, sf)


@register("savings_only")
def savings_only(spark, sf):
    return L.savings(spark, sf)


@register("account_summary")
def account_summary(spark, sf):
    return L.account_summary(spark, sf)


@register("customer_profile")
def customer_profile(spark, sf):
    return L.customer_profile(spark, sf)


@register("tier_summary")
def tier_summary(spark, sf):
    return M.tier_summary(L.account_summary(spark, sf))


@register("top_accounts")
def top_accounts(spark, sf):
    return M.top_k(L.account_summary(spark, sf), 10, "annual_interest_amount", "account_id")


@register("group_average_compare")
def group_average_compare(spark, sf):
    o = tpch.table(spark, sf, "orders").select(
        "o_orderpriority", F.col("o_totalprice").cast(C.MONEY).alias("amount"))
    return M.group_average_compare(o, "o_orderpriority", "amount")


# --- SCD2 history --------------------------------------------------------------

from strata.operators import history as H  # noqa: E402
from strata.session import materialize  # noqa: E402
from strata.operators import scd2 as SCD  # noqa: E402


@register("scd2_from_log")
def scd2_from_log(spark, sf):
    return L.event_history(spark, sf)


@register("scd2_merge_check")
def scd2_merge_check(spark, sf):
    return L.merged_history(spark, sf, "check")


@register("scd2_merge_timestamp")
def scd2_merge_timestamp(spark, sf):
    return L.merged_history(spark, sf, "timestamp")


@register("scd2_current")
def scd2_current(spark, sf):
    return H.current(L.event_history(spark, sf))


@register("scd2_as_of")
def scd2_as_of(spark, sf):
    return H.as_of(L.event_history(spark, sf), L.ts(L.AS_OF))


@register("scd2_key_history")
def scd2_key_history(spark, sf):
    return H.versions(L.event_history(spark, sf), ["user_id"], segment_seconds=L.SEGMENT_SECONDS)


@register("pit_join")
def pit_join(spark, sf):
    # Both histories are derived frames the sweep reads twice: checkpoint them.
    left = materialize(L.event_history(spark, sf))
    right = materialize(L.band_history(spark, sf))
    return H.pit_join(left, right, ["user_id"], ["event_type"], ["value_band"],
                      segment_seconds=L.SEGMENT_SECONDS)


@register("scd2_multi_version")
def scd2_multi_version(spark, sf):
    return H.multi_version(L.merged_history(spark, sf, "check"), ["user_id"])


@register("scd2_storage_metrics")
def scd2_storage_metrics(spark, sf):
    return H.storage_metrics(L.event_history(spark, sf), ["user_id"])


@register("scd2_recent_changes")
def scd2_recent_changes(spark, sf):
    return H.recent_changes(L.event_history(spark, sf), L.ts(L.T2), 24)


@register("scd2_growth")
def scd2_growth(spark, sf):
    return H.growth(L.event_history(spark, sf), F.col("dbt_valid_from") < L.ts(L.T1), ["user_id"])


@register("scd2_retention")
def scd2_retention(spark, sf):
    archive, keep = SCD.archive_split(L.event_history(spark, sf), L.ts(L.ARCHIVE_BEFORE))
    return (archive.withColumn("archived", F.lit(True))
            .unionByName(keep.withColumn("archived", F.lit(False))))


# --- incremental ---------------------------------------------------------------

from strata.operators import incremental as INC  # noqa: E402


def _previous_target(spark, sf):
    return L.rate_accounts(L.account_changes_v1(spark, sf).filter(F.col("updated_at") < L.ts(L.PREV_CUTOFF)))


@register("incremental_watermark")
def incremental_watermark(spark, sf):
    mark = INC.watermark(_previous_target(spark, sf), "updated_at")
    return INC.since(L.account_changes_v1(spark, sf), "updated_at", mark)


@register("incremental_lookback")
def incremental_lookback(spark, sf):
    mark = INC.watermark(_previous_target(spark, sf), "updated_at")
    return INC.since(L.account_changes_v1(spark, sf), "updated_at", mark, L.LOOKBACK_DAYS)


@register("backfill_slice")
def backfill_slice(spark, sf):
    ev = L.account_changes_v1(spark, sf)
    in_slice = (F.col("updated_at") >= L.ts(L.SLICE_FROM)) & (F.col("updated_at") < L.ts(L.SLICE_TO))
    # The target holds stale values for the slice (balances off by 1.00).
    stale = ev.withColumn("balance_amount", F.when(in_slice, (F.col("balance_amount") + 1).cast("decimal(18,2)"))
                          .otherwise(F.col("balance_amount")))
    target = L.rate_accounts(stale)
    recomputed = L.rate_accounts(ev.filter(in_slice))
    return INC.backfill(target, recomputed, in_slice)


def _incremental_batch(spark, sf):
    target = materialize(_previous_target(spark, sf))
    mark = INC.watermark(target, "updated_at")
    batch = materialize(L.rate_accounts(INC.since(L.account_changes_v2(spark, sf), "updated_at", mark,
                                                  L.LOOKBACK_DAYS)))
    return target, batch


@register("upsert")
def upsert(spark, sf):
    target, batch = _incremental_batch(spark, sf)
    return INC.upsert(target, batch, ["account_id"])


@register("changed_key_profile")
def changed_key_profile(spark, sf):
    target, batch = _incremental_batch(spark, sf)
    new_accounts = INC.upsert(target, batch, ["account_id"])
    old_profile = L.rate_profile(target)
    changed_old = target.join(batch.select("account_id"), "account_id", "left_semi")
    keys = INC.affected_keys(changed_old, batch, "customer_id")
    return INC.refresh_keys(old_profile, new_accounts, keys, "customer_id", L.rate_profile)


# --- data quality --------------------------------------------------------------

from strata.operators import quality as DQ  # noqa: E402
from strata.operators import report as REP  # noqa: E402


@register("dq_not_null")
def dq_not_null(spark, sf):
    return DQ.not_null(tpch.raw_accounts(spark, sf), "account_id")


@register("dq_unique")
def dq_unique(spark, sf):
    return DQ.unique(tpch.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_accepted_values")
def dq_accepted_values(spark, sf):
    return DQ.accepted_values(tpch.raw_accounts(spark, sf), C.norm("account_type"), C.ACCOUNT_TYPES)


@register("dq_relationships")
def dq_relationships(spark, sf):
    orders = tpch.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    return DQ.relationships(orders, "customer_id", L.staged_customers(spark, sf)[0], "customer_id")


@register("dq_positive_value")
def dq_positive_value(spark, sf):
    return DQ.positive_value(tpch.table(spark, sf, "customer"), "c_acctbal")


@register("dq_date_range")
def dq_date_range(spark, sf):
    return DQ.valid_date_range(tpch.table(spark, sf, "orders"), "o_orderdate",
                               "1995-06-01 00:00:00", "2001-01-01 00:00:00")


@register("dq_expression")
def dq_expression(spark, sf):
    return DQ.expression_is_true(tpch.table(spark, sf, "customer").select("c_custkey", "c_acctbal"),
                                 "c_acctbal >= 0")


@register("dq_scd2_overlap")
def dq_scd2_overlap(spark, sf):
    return DQ.scd2_overlap(L.event_intervals(spark, sf), ["user_id"], segment_seconds=L.SEGMENT_SECONDS)


@register("dq_one_current")
def dq_one_current(spark, sf):
    return DQ.open_versions(L.event_intervals(spark, sf), ["user_id"])


@register("dq_recency")
def dq_recency(spark, sf):
    return DQ.recency(tpch.table(spark, sf, "events"), "ts", L.ts(L.CHECK_NOW), 72)


@register("dq_interval_order")
def dq_interval_order(spark, sf):
    return DQ.interval_order(L.event_intervals(spark, sf), L.ts(L.EARLY))


@register("dq_rate_range")
def dq_rate_range(spark, sf):
    return DQ.rate_range(L.defective_summary(spark, sf))


@register("dq_recompute")
def dq_recompute(spark, sf):
    return DQ.recompute(L.defective_summary(spark, sf))


@register("dq_reconcile")
def dq_reconcile(spark, sf):
    return DQ.reconcile(L.defective_profile(spark, sf), L.account_summary(spark, sf))


@register("dq_non_positive_balance")
def dq_non_positive_balance(spark, sf):
    return DQ.non_positive_balance(L.account_with_customer(spark, sf))


@register("dq_savings_type")
def dq_savings_type(spark, sf):
    """DQ-19 as declared: rows typed 'Savings' missing from the savings
    layer.  Types are stored lower-cased, so the declared test cannot fire;
    the query runs over the whole intermediate layer and returns no rows."""
    return DQ.savings_missing(L.account_with_customer(spark, sf), L.savings(spark, sf).filter(L.LOST_SAVINGS))


@register("dq_row_count")
def dq_row_count(spark, sf):
    """DQ-23 on a slice that holds no rows, and on one that does."""
    events = tpch.table(spark, sf, "events").select("ts")
    late = DQ.row_count_positive(events.filter(F.col("ts") > L.ts("2030-01-01 00:00:00")))
    return late.withColumn("slice", F.lit("after 2030")).unionByName(
        DQ.row_count_positive(events).withColumn("slice", F.lit("all")))


@register("dq_accepted_range")
def dq_accepted_range(spark, sf):
    return DQ.accepted_range(tpch.table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 1, 45)


def quality_suite(spark, sf) -> DQ.Suite:
    """The suite over the pipeline's layers (names carry the layer)."""
    frames = L.chain(spark, sf) | {"snap_user": L.event_intervals(spark, sf), "lineitem": tpch.table(spark, sf, "lineitem"),
                                   "customer": tpch.table(spark, sf, "customer")}
    stg_c, stg_a, awc = frames["stg_customer"], frames["stg_account"], frames["int_account_with_customer"]
    summ, prof = frames["account_summary"], frames["customer_profile"]
    s = DQ.Suite(frames)
    for c in ("customer_id", "customer_name", "has_loan_flag", "loaded_at"):
        s.add(DQ.Check("stg_customer", f"not_null_stg_customer_{c}", condition=DQ.cond_not_null(c), column=c))
    for c in ("account_id", "customer_id", "balance_amount", "account_type", "loaded_at"):
        s.add(DQ.Check("stg_account", f"not_null_stg_account_{c}", condition=DQ.cond_not_null(c), column=c))
    s.add(
        DQ.Check("stg_account", "accepted_values_stg_account_account_type", column="account_type",
                 condition=DQ.cond_not_accepted("account_type", C.ACCOUNT_TYPES)),
        DQ.Check("stg_customer", "unique_stg_customer_customer_id", column="customer_id",
                 violations=lambda: DQ.unique(stg_c, ["customer_id"])),
        DQ.Check("stg_account", "unique_stg_account_account_id", column="account_id",
                 violations=lambda: DQ.unique(stg_a, ["account_id"])),
        DQ.Check("quarantine_stg_account", "not_null_quarantine_failure_reason", column="failure_reason",
                 condition=DQ.cond_not_null("failure_reason")),
        DQ.Check("int_account_with_customer", "relationships_int_account_customer_id", column="customer_id",
                 violations=lambda: DQ.relationships(awc, "customer_id", stg_c, "customer_id")),
        DQ.Check("int_account_with_customer", "int_account_balance_positive", column="balance_amount",
                 condition=F.coalesce(F.col("balance_amount") <= 0, F.lit(False))),
        DQ.Check("account_summary", "positive_value_account_summary_original_balance_amount",
                 column="original_balance_amount", condition=DQ.cond_not_positive("original_balance_amount")),
        DQ.Check("account_summary", "expression_is_true_account_summary_interest", column="annual_interest_amount",
                 condition=DQ.cond_not_true("annual_interest_amount >= 0")),
        DQ.Check("account_summary", "interest_rate_range", column="interest_rate_pct",
                 condition=DQ.cond_out_of_range("interest_rate_pct", Decimal("0.01"), Decimal("0.025"))),
        DQ.Check("account_summary", "interest_calculation", violations=lambda: DQ.recompute(summ)),
        DQ.Check("customer_profile", "unique_customer_profile_customer_id", column="customer_id",
                 violations=lambda: DQ.unique(prof, ["customer_id"])),
        DQ.Check("customer_profile", "customer_profile_aggregation", violations=lambda: DQ.reconcile(prof, summ)),
        DQ.Check("src_customer", "row_count_src_customer", violations=lambda: DQ.row_count_positive(frames["src_customer"])),
        DQ.Check("snap_user", "scd2_no_overlap_snap_user", column="user_id", severity="warn",
                 violations=lambda: DQ.scd2_overlap(frames["snap_user"], ["user_id"], L.SEGMENT_SECONDS)),
        DQ.Check("snap_user", "one_open_version_snap_user", column="user_id", severity="warn",
                 violations=lambda: DQ.open_versions(frames["snap_user"], ["user_id"])),
        DQ.Check("lineitem", "unique_lineitem_order_line", severity="error", warn_if=0, error_if=100000000,
                 violations=lambda: DQ.unique(frames["lineitem"], ["l_orderkey", "l_linenumber"])),
        DQ.Check("customer", "positive_value_customer_c_acctbal", column="c_acctbal", severity="warn",
                 condition=DQ.cond_not_positive("c_acctbal")),
    )
    return s


def quality_results(spark, sf):
    return quality_suite(spark, sf).results("run-1")


@register("dq_threshold")
def dq_threshold(spark, sf):
    """DQ-20/21: a check with ``warn_if`` / ``error_if`` thresholds: the
    duplicate (order, line) keys of lineitem warn but stay under the error
    threshold."""
    return dq_threshold_results(spark, sf).select("test_name", "severity", "violations", "status")


def dq_threshold_results(spark, sf):
    li = tpch.table(spark, sf, "lineitem")
    s = DQ.Suite({"lineitem": li}).add(
        DQ.Check("lineitem", "unique_lineitem_order_line", severity="error", warn_if=0, error_if=100000000,
                 violations=lambda: DQ.unique(li, ["l_orderkey", "l_linenumber"])))
    return s.results("run-10")


@register("dq_freshness")
def dq_freshness(spark, sf):
    now = L.ts(L.CHECK_NOW)
    t = L.chain(spark, sf)
    layers = [("src_account", t["src_account"], "loaded_at", 24), ("stg_account", t["stg_account"], "loaded_at", 24),
              ("int_account_with_customer", t["int_account_with_customer"], "valid_from_at", 25),
              ("account_summary", t["account_summary"], "calculated_at", 26)]
    out = None
    for name, df, col, hours in layers:
        r = DQ.recency(df, col, now, hours).select(F.lit(name).alias("table_name"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@register("quality_report")
def quality_report(spark, sf):
    return REP.summary(quality_results(spark, sf))


@register("quality_gate")
def quality_gate(spark, sf):
    return REP.gate(quality_results(spark, sf))


# --- ingestion profile, exports, layer counts, streaming ------------------------

import uuid  # noqa: E402

from strata.session import checkpoint_dir  # noqa: E402
from strata.sinks import writers as W  # noqa: E402
from strata.sources import files as FILES  # noqa: E402


@register("ingest_profile")
def ingest_profile(spark, sf):
    return FILES.ingest_profile(tpch.raw_accounts(spark, sf), "balance")


def _scratch(spark, what: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex[:12]}"


@register("export_roundtrip")
def export_roundtrip(spark, sf):
    """SNK-1/2/7/9: write the mart as CSV and as Parquet, validate both
    writes, check the two outputs hold the same rows, return the CSV read
    back with the mart's schema."""
    summ = L.account_summary(spark, sf)
    base = _scratch(spark, "export")
    if not W.same_output(W.write_csv(summ, f"{base}/csv"), W.write_parquet(summ, f"{base}/parquet")):
        raise W.WriteValidationError("CSV and Parquet exports differ")
    return spark.read.schema(summ.schema).options(**W.CSV_OPTIONS).csv(f"{base}/csv")


@register("layer_counts")
def layer_counts(spark, sf):
    """QRY-7: row count per layer, one aggregate per layer in one union."""
    t = L.chain(spark, sf)
    layers = [(layer, name, t[name]) for layer, name in (
        ("source", "src_customer"), ("source", "src_account"), ("staging", "stg_customer"), ("staging", "quarantine_stg_customer"),
        ("staging", "stg_account"), ("staging", "quarantine_stg_account"), ("intermediate", "int_account_with_customer"),
        ("intermediate", "int_savings_account_only"), ("marts", "account_summary"), ("marts", "customer_profile"))]
    out = None
    for layer, name, df in layers:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def _batches(spark, root: str, frame, number: str, run) -> None:
    """Write the rows of ``frame`` as one file set per value 0, 1, ... of the
    expression ``number``, each followed by a call of ``run`` (one
    micro-batch, the checkpoint going on)."""
    n = frame.selectExpr(f"max({number}) AS n").first()["n"]
    for i in range((n or 0) + 1):
        frame.filter(F.expr(number) == i).write.mode("append").parquet(f"{root}/landing")
        run()


@register("stream_latest_state")
def stream_latest_state(spark, sf):
    """STR-1/2: the events streamed into each user's latest event: the state is
    Spark's, every batch appends the keys it changed."""
    from strata.streaming import ingest as STR
    root = _scratch(spark, "stream")
    events = tpch.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    sink = STR.ChangeSink(spark, f"{root}/changes", ["user_id"], ["ts", "event_id"], stream=root.rsplit("/", 1)[-1])
    _batches(spark, root, events, "CAST(event_id % 2 AS INT)", lambda: STR.run_available(
        STR.latest_state(STR.stream_ingest(spark, f"{root}/landing", events.schema, fmt="parquet"), ["user_id"], ["ts", "event_id"], ["event_type"]),
        sink, mode="update"))
    return sink.current()


@register("stream_changed_keys")
def stream_changed_keys(spark, sf):
    """STR-2: what each of four batches wrote: the latest event of the users
    in the batch, and of nobody else."""
    from strata.streaming import ingest as STR
    root = _scratch(spark, "changes")
    events = tpch.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id").withColumn("part", (F.col("user_id") + F.col("event_id")) % 4)
    sink = STR.ChangeSink(spark, f"{root}/changes", ["user_id"], ["ts", "event_id"], stream=root.rsplit("/", 1)[-1])
    _batches(spark, root, events, "CAST(part AS INT)", lambda: STR.run_available(
        STR.latest_state(STR.stream_ingest(spark, f"{root}/landing", events.schema, fmt="parquet"), ["user_id"], ["ts", "event_id"], ["event_type"]),
        sink, mode="update"))
    return sink.changes()


@register("pipeline_incremental_profile")
def pipeline_incremental_profile(spark, sf):
    """The whole layered run, end to end: bank-style CSV files derived from
    the driver tables, a full build, then an incremental run in which every
    tenth order's balance grew by 1.00.  Returns the customer profile after
    the incremental run; it must equal a full computation over the second
    input (customers touched in run 2 carry run 2's time stamp)."""
    import datetime as dt

    from strata.plans import pipeline as P
    from strata.plans.runs import Warehouse
    root = _scratch(spark, "pipeline")
    orders = tpch.table(spark, sf, "orders")
    accts = orders.selectExpr(*[f"{e} AS {n}" for n, e in tpch.RAW_ACCOUNT_EXPRS.items()],
                              "o_orderkey % 10 = 3 AS _chg")
    money = F.col("balance").try_cast("decimal(18,2)")
    changed = accts.withColumn("balance", F.when(F.col("_chg") & money.isNotNull(), (money + 1).cast("string"))
                               .otherwise(F.col("balance")))
    names = {"account_id": "AccountID", "customer_id": "CustomerID", "balance": "Balance",
             "account_type": "AccountType"}
    csv = dict(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for frame, folder in ((accts, "a1"), (changed, "a2")):
        frame.select(*[F.col(k).alias(v) for k, v in names.items()]).write.mode("overwrite").options(**csv).csv(
            f"{root}/in/{folder}")
    tpch.raw_customers(spark, sf).select(
        F.col("customer_id").alias("CustomerID"), F.col("name").alias("Name"), F.col("has_loan").alias("HasLoan")
    ).write.mode("overwrite").options(**csv).csv(f"{root}/in/c")
    for run_id, folder, ts in (("r1", "a1", tpch.LOAD_TS), ("r2", "a2", tpch.RUN_TS)):
        P.run(spark, P.RunConfig(customers_path=f"{root}/in/c", accounts_path=f"{root}/in/{folder}",
                                 warehouse=f"{root}/wh", run_id=run_id, run_ts=dt.datetime.fromisoformat(ts),
                                 id_type=tpch.ID_TYPE, stop_on_error=False))  # the inputs hold zero balances
    return Warehouse(spark, f"{root}/wh").read("customer_profile")


# --- further operators, each on whole tables ------------------------------------

@register("in_subquery")
def in_subquery(spark, sf):
    """FLT-9: orders of customers in debt."""
    debt = tpch.table(spark, sf, "customer").filter("c_acctbal < 0")
    return M.in_subquery(tpch.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", debt, "c_custkey")


@register("not_in_subquery")
def not_in_subquery(spark, sf):
    """FLT-8: orders of customers not in debt."""
    debt = tpch.table(spark, sf, "customer").filter("c_acctbal < 0")
    return M.not_in_subquery(tpch.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", debt, "c_custkey")


@register("distinct_attributes")
def distinct_attributes(spark, sf):
    """AGG-2."""
    return M.distinct_attributes(tpch.table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@register("latest_per_key")
def latest_per_key(spark, sf):
    """AGG-10: each user's latest event by an ordering column."""
    return M.latest_per_key(tpch.table(spark, sf, "events"), "user_id", "event_id", "event_type")


@register("preview_rows")
def preview_rows(spark, sf):
    """SRT-3: the first rows in a total order."""
    return M.preview(tpch.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey"), 7)


@register("sample_violations")
def sample_violations(spark, sf):
    """SRT-4: the first failing rows of a check in a total order."""
    bad = DQ.accepted_range(tpch.table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 1, 45)
    return DQ.sample_violations(bad.orderBy("p_partkey"), 10)


@register("quality_issues")
def quality_issues(spark, sf):
    """REP-6: results that did not pass."""
    return REP.issues(quality_results(spark, sf)).select("table_name", "test_name", "severity", "violations", "status", "message")


@register("quality_overall")
def quality_overall(spark, sf):
    """REP-3/7: the overall line."""
    return REP.overall(quality_results(spark, sf))


@register("report_roundtrip")
def report_roundtrip(spark, sf):
    """SNK-6, REP-1: two reports are stored as JSON, the later run (whose id
    sorts first as text) is found and read back."""
    import datetime as dt
    root = _scratch(spark, "reports")
    results = dq_threshold_results(spark, sf)
    W.save_report(results.withColumn("violations", F.lit(0).cast("long")), root, "run-9", dt.datetime(2024, 2, 1))
    W.save_report(results, root, "run-10", dt.datetime(2024, 2, 2))
    return W.latest_report(spark, root).select("test_name", "severity", F.col("violations").cast("long").alias("violations"), "run_id")


@register("incremental_first_run")
def incremental_first_run(spark, sf):
    """INC-6: without a target, and with an empty one, the watermark falls
    back and every row is new."""
    source = L.account_changes_v1(spark, sf)
    empty = source.filter(F.lit(False))
    marks = {INC.watermark(None, "updated_at"), INC.watermark(empty, "updated_at")}
    return INC.since(source, "updated_at", max(marks)).select("account_id", "updated_at")


@register("scd2_reinsert")
def scd2_reinsert(spark, sf):
    """SCD-5/9: customers deleted in the second run and back in the third, on
    the history store."""
    from strata.operators import scd2
    import datetime as dt

    from strata.operators import scd2
    from strata.plans.runs import History, Warehouse
    wh = Warehouse(spark, _scratch(spark, "reinsert"))
    hs = History(wh, "snap")
    cust = tpch.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    for run, (t, frame) in enumerate(((L.T1, cust), (L.T2, cust.filter("c_custkey % 5 <> 0")), (L.CHECK_NOW, cust))):
        wh.begin(f"r{run}", dt.datetime.fromisoformat(t))
        hs.stage(scd2.snapshot(hs.open_versions(), frame, ["c_custkey"], "check", L.ts(t), check_cols=["c_mktsegment"]))
        wh.commit()
    return hs.read().select("c_custkey", "c_mktsegment", "dbt_valid_from", "dbt_valid_to")


@register("padded_and_proper_names")
def padded_and_proper_names(spark, sf):
    """PRJ-22, PRJ-24."""
    return tpch.table(spark, sf, "supplier").select(
        C.padded_key("S-", "s_suppkey", 9).alias("supplier_key"), C.proper_name("s_name").alias("supplier_name"))


@register("stream_without_repeats")
def stream_without_repeats(spark, sf):
    """STR-3: events delivered twice, in different batches; repeats within the
    watermark go."""
    from strata.streaming import ingest as STR
    root = _scratch(spark, "lateness")
    events = tpch.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = events.withColumn("part", F.lit(0)).union(events.withColumn("part", F.lit(1)))
    sink = STR.ChangeSink(spark, f"{root}/kept", ["event_id"], ["ts"], stream=root.rsplit("/", 1)[-1])
    _batches(spark, root, twice, "part", lambda: STR.run_available(
        STR.with_lateness(STR.stream_ingest(spark, f"{root}/landing", twice.schema, fmt="parquet"), "ts", "3650 days", ["event_id"]), sink))
    return sink.changes().select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@register("stream_late_rows")
def stream_late_rows(spark, sf):
    """STR-3/INC-8: six batches with rows up to 24 days older than what came
    before; those over three days late are kept aside, not dropped."""
    from strata.streaming import ingest as STR
    root = _scratch(spark, "late")
    events = tpch.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    events = events.withColumn("part", F.expr(L.ARRIVAL))
    sink = STR.LateSplitSink(spark, root, "ts", days=3, stream=root.rsplit("/", 1)[-1])
    _batches(spark, root, events, "part", lambda: STR.run_available(STR.stream_ingest(spark, f"{root}/landing", events.schema, fmt="parquet"), sink))
    both = sink.on_time().withColumn("late", F.lit(False)).unionByName(sink.late().withColumn("late", F.lit(True)))
    return both.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("part").alias("batch"), "late")


@register("stream_quarantine")
def stream_quarantine(spark, sf):
    """STR-1/SRC-1: CSV files streamed in batches, some lines with a field too
    many or an id that is no number; each batch is split into valid rows and
    malformed lines."""
    from strata.streaming import ingest as STR
    root = _scratch(spark, "malformed")
    lines = tpch.table(spark, sf, "orders").selectExpr("o_orderkey % 2 AS part", f"{L.ORDER_LINE} AS line")
    sink = STR.QuarantineSink(spark, root, stream=root.rsplit("/", 1)[-1])
    schema = "account_id bigint, customer_id bigint, balance decimal(18,2)"
    for part in (0, 1):
        lines.filter(F.col("part") == part).select(F.col("line").alias("account_id,customer_id,balance")).write.mode("append").option(
            "header", True).option("quote", "").option("escapeQuotes", False).csv(f"{root}/landing", sep="|")
        STR.run_available(STR.stream_csv(spark, f"{root}/landing", schema), sink)
    ok = sink.valid().select("account_id", "customer_id", "balance", F.lit(None).cast("string").alias("malformed"))
    return ok.unionByName(sink.malformed().select(F.lit(None).cast("bigint").alias("account_id"), F.lit(None).cast("bigint").alias("customer_id"),
                                                  F.lit(None).cast("decimal(18,2)").alias("balance"), F.col(STR.CORRUPT).alias("malformed")))


@register("audited_write")
def audited_write(spark, sf):
    """CON-2: write, audit, publish: a first run is published; a second one
    that repeats keys, and a third one with nulls, are refused; readers see
    the first run throughout, and then a clean fourth one."""
    import datetime as dt

    from strata.operators import contracts as K
    from strata.plans.runs import Warehouse
    wh = Warehouse(spark, _scratch(spark, "audit"))
    good = materialize(L.account_summary(spark, sf))
    contract = K.contracts(tpch.ID_TYPE)["account_summary"]
    again = good.withColumn("account_id", F.concat(F.lit("n"), "account_id"))
    runs = (good, good.unionByName(good.filter(F.col("customer_id") % 7 == 0)),
            good.withColumn("interest_rate_pct", F.when(F.col("customer_id") % 7 > 0, F.col("interest_rate_pct"))), good.unionByName(again))
    seen = []
    for i, frame in enumerate(runs):
        wh.begin(f"r{i}", dt.datetime(2024, 2, 1 + i))
        try:
            wh.stage("account_summary", frame, contract)
            wh.commit()
        except K.ContractError:
            pass
        now = Warehouse(spark, wh.root).read("account_summary")
        seen.append(now.agg(F.count(F.lit(1)).alias("rows_visible"), F.count_distinct("account_id").alias("accounts_visible"),
                            F.sum("original_balance_amount").cast("decimal(38,2)").alias("balance_visible"),
                            F.count_if(F.col("interest_rate_pct").isNull()).alias("nulls_visible")).select(F.lit(i).alias("attempt"), "*"))
    return materialize(seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3]))


# --- maintenance that costs what changed ------------------------------------------

RATE_TOTALS = dict(key="customer_id", count="total_accounts_count", maxima={"last_updated_at": "updated_at"},
                   sums={"total_balance_amount": "original_balance_amount", "total_annual_interest_amount": "annual_interest_amount"})


@register("profile_by_deltas")
def profile_by_deltas(spark, sf):
    """AGG-1/INC-3: customer totals kept by the signed changes of the accounts;
    the accounts live in a keyed table, of which only buckets of customers who
    lost their latest change are looked up again."""
    from strata.operators import buckets as B
    from strata.operators import deltas as D
    target, batch = _incremental_batch(spark, sf)
    view = D.Totals(**RATE_TOTALS)
    totals = materialize(view.build(target))
    changes = materialize(D.row_changes(target, batch, ["account_id"]))
    accounts = B.KeyedTable(spark, f"accounts_{uuid.uuid4().hex}", ["customer_id"], buckets=32)
    accounts.create(INC.upsert(target, batch, ["account_id"]), _scratch(spark, "accounts"))
    changed, keys = view.apply(totals, changes, accounts.read_keys)
    return D.refresh(totals, changed, keys, "customer_id")


@register("upsert_touched_partitions")
def upsert_touched_partitions(spark, sf):
    """INC-3/INC-7: the same batch as ``upsert``, merged into a keyed catalog
    table; closed accounts leave it."""
    from strata.operators import buckets as B
    target, batch = _incremental_batch(spark, sf)
    accounts = B.KeyedTable(spark, f"rated_{uuid.uuid4().hex}", ["account_id"], buckets=32)
    accounts.create(target, _scratch(spark, "rated"))
    closed = target.filter("account_id % 19 = 0").join(batch, "account_id", "left_anti").select("account_id")
    accounts.merge(batch, closed)
    return accounts.read()


@register("scd2_from_extracts")
def scd2_from_extracts(spark, sf):
    """SCD-4/8: users' histories from four full extracts in one pass."""
    from strata.operators import scd2
    return scd2.history_from_extracts(L.user_extracts(spark, sf), L.EXTRACT_TIMES, ["user_id"], check_cols=["event_type"])


# --- results of other runners, checksums, merged profiles ------------------------

from strata.operators import checksum as CK  # noqa: E402
from strata.operators import sketches as SK  # noqa: E402


@register("report_ingest")
def report_ingest(spark, sf):
    """REP-1: every line item as a result document of another runner: a test
    node, a model node and an odd entry each, and some documents cut short;
    written as JSON lines and read back as results and what is kept aside."""
    path = _scratch(spark, "results")
    tpch.table(spark, sf, "lineitem").selectExpr(f"{L.RESULT_DOCUMENT} AS value").write.text(path)
    results, odd = REP.ingest(spark, path)
    return results.unionByName(odd, allowMissingColumns=True)


@register("export_checksum")
def export_checksum(spark, sf):
    """SNK-7/9: the mart as CSV and as Parquet, each compared with what its
    write saw; the checksums of the files."""
    summ = L.account_summary(spark, sf)
    base = _scratch(spark, "checksum")
    W.write_csv(summ, f"{base}/csv")
    W.write_parquet(summ, f"{base}/parquet")
    reader = spark.read.schema(summ.schema)
    outputs = [("csv", reader.options(**W.CSV_OPTIONS).csv(f"{base}/csv")), ("parquet", reader.parquet(f"{base}/parquet"))]
    parts = [CK.checksum(df).select(F.lit(n).alias("output"), CK.ROWS, *[F.col(c).cast("string").alias(c) for c in (CK.FIRST, CK.SECOND)])
             for n, df in outputs]
    return parts[0].unionByName(parts[1])


@register("profile_sketch_merge")
def profile_sketch_merge(spark, sf):
    """SRC-7/AGG-7/QRY-8: a profile per month of shipping, stored with its
    sketches and merged into years without another scan; the last columns say
    whether the estimates keep their bounds beside exact values."""
    cols = ["l_partkey", "l_quantity", "l_extendedprice"]
    li = tpch.table(spark, sf, "lineitem").select(F.trunc("l_shipdate", "month").alias("month"), *cols)
    stored = materialize(SK.run_profile(li, "month", cols)).withColumn("year", F.year("run"))
    merged = materialize(SK.estimates(SK.merge(stored, ["year", "column_name"]), [0.5]))
    # Exact values, for the comparison only: distinct values with their counts.
    values = li.select(F.year("month").alias("year"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])))
    counted = values.groupBy("year", "column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    beside = counted.join(merged.select("year", "column_name", F.get("quantile_estimates", F.lit(0)).alias("mid")), ["year", "column_name"])
    exact = beside.groupBy("year", "column_name").agg(
        F.count("v").alias("d"), F.sum(F.when(F.col("v") < F.col("mid"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("mid"), F.col("n")).otherwise(0)).alias("upto"))
    n = F.col("rows") - F.col("nulls")
    return merged.join(exact, ["year", "column_name"]).select(
        "year", "column_name", "runs", "rows", "nulls", "least", "greatest",
        (F.abs(F.col("distinct_estimate") - F.col("d")) <= F.col("d") * SK.DISTINCT_ERROR + 1).alias("distinct_within"),
        ((F.col("below") <= n * (0.5 + SK.RANK_ERROR)) & (F.col("upto") >= n * (0.5 - SK.RANK_ERROR))).alias("median_within"))
