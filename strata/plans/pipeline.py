"""The whole layered run for the bank files: ``run(spark, RunConfig)``.

Layers (each staged in the run's partition of a catalog table, see
:mod:`strata.plans.runs`, and visible only when the whole run is complete):

raw CSV -> src_customer / src_account -> stg_* + quarantine_stg_* ->
snap_customer / snap_account (SCD2, open + closed stores) ->
int_account_with_customer -> int_savings_account_only -> account_summary ->
customer_profile, then the quality suite over the staged rows, the JSON report
and the gate; a run that passes is published in one step and exported.

Incremental runs use changed-key propagation instead of timestamp filters
(SEM-5/6/7): the keys touched by this run's snapshot merge (versions opened or
closed at ``run_ts``), plus the accounts of customers whose version changed,
are recomputed from current versions and upserted; keys that no longer
qualify are deleted.  An incremental run therefore equals a full refresh
apart from the ``calculated_at`` stamps of untouched rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import contracts as K
from strata.operators import deltas as D
from strata.operators import incremental as INC
from strata.operators import marts as M
from strata.operators import quality as DQ
from strata.operators import report as REP
from strata.operators import scd2
from strata.operators import staging as S
from strata.plans.runs import History, Warehouse
from strata.session import materialize
from strata.sinks import writers as W
from strata.sources import files

CUSTOMER_CHECK = ["customer_name", "has_loan_flag"]
# Width of the time segments in which a key's versions are scanned.
SEGMENT_SECONDS = 30 * 86400
ACCOUNT_CHECK = ["customer_id", "balance_amount", "account_type"]


@dataclass
class RunConfig:
    customers_path: str
    accounts_path: str
    warehouse: str
    run_id: str
    run_ts: dt.datetime
    export_dir: str | None = None
    report_dir: str | None = None
    full_refresh: bool = False
    customer_strategy: str = "check"
    account_strategy: str = "check"
    id_type: str = "int"
    keep_versions: int = 3
    stop_on_error: bool = True
    export_database: str | None = None  # marts as catalog tables (SNK-3)
    sample_dir: str | None = None       # rows of checks that did not pass (SRT-4)
    sample_rows: int = 10


@dataclass
class RunResult:
    layer_counts: dict[str, int] = field(default_factory=dict)
    gate: dict | None = None
    exports: list = field(default_factory=list)
    ingest: dict[str, dict] = field(default_factory=dict)


class QualityGateError(RuntimeError):
    """Checks of severity error failed (DQ-20); results are written, tables
    and exports are not published."""


def _step(spark: SparkSession, what: str) -> None:
    """Label the following jobs (event log / job list)."""
    spark.sparkContext.setJobDescription(what)


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    store = Warehouse(spark, cfg.warehouse)
    declared = K.contracts(cfg.id_type)

    def put(name: str, df: DataFrame) -> DataFrame:
        """Stage a table with its declared columns, types and no nulls; its
        unique keys are checked with the suite, before publishing."""
        return store.stage(name, declared[name].enforce(df, constraints=False), declared[name], unique=False)

    ts = F.lit(cfg.run_ts).cast("timestamp")
    res = RunResult()
    if not store.begin(cfg.run_id, cfg.run_ts):
        res.layer_counts = layer_counts(store)
        return res
    incremental = not cfg.full_refresh and store.exists("customer_profile")

    # ingest + source layer
    _step(spark, f"{cfg.run_id}: ingest")
    raw_c, seen_c = files.observed(files.read_customers(spark, cfg.customers_path), f"{cfg.run_id}: customers")
    raw_a, seen_a = files.observed(files.read_accounts(spark, cfg.accounts_path), f"{cfg.run_id}: accounts", "Balance")
    src_c = put("src_customer", S.rename_cast(raw_c, S.CUSTOMER_RAW_NAMES, ts))
    src_a = put("src_account", S.rename_cast(raw_a, S.ACCOUNT_RAW_NAMES, ts))
    res.ingest = {"customers": seen_c.get, "accounts": seen_a.get}  # came with the writes

    # staging + quarantine: one validation pass per table
    _step(spark, f"{cfg.run_id}: staging")
    stg_c, q_c = S.stage_customers(src_c, ts, cfg.id_type)
    stg_a, q_a = S.stage_accounts(src_a, ts, cfg.id_type)
    for name, df in (("stg_customer", stg_c), ("quarantine_stg_customer", q_c),
                     ("stg_account", stg_a), ("quarantine_stg_account", q_a)):
        put(name, df)
    stg_c, stg_a = store.read("stg_customer"), store.read("stg_account")
    _step(spark, f"{cfg.run_id}: unique keys")
    scd2.require_unique(stg_c, ["customer_id"], "stg_customer")
    scd2.require_unique(stg_a, ["account_id"], "stg_account")

    # snapshots: merge the open versions only (a full refresh rebuilds the
    # incremental models, never the history)
    snap_c, snap_a = History(store, "snap_customer"), History(store, "snap_account")
    _step(spark, f"{cfg.run_id}: snapshots")
    kw_c = dict(check_cols=CUSTOMER_CHECK) if cfg.customer_strategy == "check" else dict(updated_at="loaded_at")
    kw_a = dict(check_cols=ACCOUNT_CHECK) if cfg.account_strategy == "check" else dict(updated_at="loaded_at")
    merged_c = scd2.snapshot(snap_c.open_versions(), stg_c, ["customer_id"],
                             cfg.customer_strategy, ts, **kw_c)
    merged_a = scd2.snapshot(snap_a.open_versions(), stg_a, ["account_id"],
                             cfg.account_strategy, ts, **kw_a)
    snap_c.stage(merged_c, declared["snap_customer"])
    snap_a.stage(merged_a, declared["snap_account"])
    open_c, open_a = snap_c.open_versions(), snap_a.open_versions()

    _step(spark, f"{cfg.run_id}: intermediate+marts")
    if not incremental:
        awc = put("int_account_with_customer", M.account_with_customer(open_a, open_c))
        sav = put("int_savings_account_only", M.savings_only(awc))
        summ = put("account_summary", M.account_summary(sav, ts))
        put("customer_profile", M.customer_profile(summ, open_c))
    else:
        # keys touched this run (the run's closed partition + versions opened
        # at run_ts), materialized once: small next to the tables
        ch_c = materialize(snap_c.touched_keys(["customer_id"], ts))
        ch_a = snap_a.touched_keys(["account_id"], ts)
        prev_awc = store.read_before("int_account_with_customer")
        via_customer = (open_a.select("account_id", "customer_id").unionByName(prev_awc.select("account_id", "customer_id"))
                        .join(ch_c, "customer_id", "left_semi").select("account_id"))
        affected = materialize(ch_a.unionByName(via_customer).distinct())

        _refresh_marts(store, put, affected, ch_c, open_a, open_c, ts)

    frames = _audit_and_publish(store, cfg, res)

    _step(spark, f"{cfg.run_id}: exports")
    if cfg.export_dir:
        for name, df in frames.items():
            csv = W.write_csv(df, f"{cfg.export_dir}/{name}_csv")
            parquet = W.write_parquet(df, f"{cfg.export_dir}/{name}_parquet")
            if not W.same_output(csv, parquet):
                raise W.WriteValidationError(f"{name}: CSV and Parquet exports differ")
            res.exports += [csv, parquet]
    if cfg.export_database:
        for name, df in frames.items():
            res.exports.append(W.write_table(df, f"{cfg.export_database}.{name}"))

    for name in LAYER_TABLES:
        store.vacuum(name, cfg.keep_versions)
    for name in ("snap_customer", "snap_account"):
        store.vacuum(name, cfg.keep_versions, only=", is_open=true")
    spark.sparkContext.setJobDescription(None)
    return res


def _refresh_marts(store: Warehouse, put, affected: DataFrame, ch_c: DataFrame, open_a: DataFrame, open_c: DataFrame, ts) -> None:
    """Stage the intermediate tables and marts anew for the accounts
    ``affected`` and the customers ``ch_c`` (keys); other rows stay."""
    prev_awc = store.read_before("int_account_with_customer")
    # Fresh rows of the affected accounts, derived once (small) and passed
    # down the chain: each layer's new rows are the previous ones minus
    # the affected keys plus its fresh rows - no layer re-scans the table
    # the previous step just wrote.
    fresh_awc = materialize(M.account_with_customer(open_a.join(affected, "account_id", "left_semi"), open_c))
    fresh_sav = M.savings_only(fresh_awc)
    fresh_summ = materialize(M.account_summary(fresh_sav, ts))
    prev_summ = store.read_before("account_summary")
    put("int_account_with_customer", INC.replace_keys(prev_awc, fresh_awc, affected, "account_id"))
    put("int_savings_account_only", INC.replace_keys(store.read_before("int_savings_account_only"), fresh_sav, affected, "account_id"))
    summ = put("account_summary", INC.replace_keys(prev_summ, fresh_summ, affected, "account_id"))

    # Totals move by the signed changes of the accounts; other accounts of
    # the customers are not read, unless the latest stamp went with one.
    prev_prof = store.read_before("customer_profile")
    totals = prev_prof.drop("customer_name", "has_loan_flag")
    gone = prev_summ.join(affected, "account_id", "left_semi")
    moved = gone.withColumn(D.SIGN, F.lit(-1)).unionByName(fresh_summ.withColumn(D.SIGN, F.lit(1)))
    changed, cust = M.PROFILE_TOTALS.apply(totals, moved, lambda keys: summ)
    cust = materialize(cust.filter(F.col("customer_id").isNotNull()))
    renamed = totals.join(ch_c.join(cust, "customer_id", "left_anti"), "customer_id", "left_semi")
    every = materialize(cust.unionByName(ch_c).distinct())
    # Attributes only for the affected customers: the semi-join against
    # the small key set is broadcast, so the customer table is filtered in
    # place rather than shuffled for the left join.
    fresh = M.with_attributes(changed.unionByName(renamed), open_c.join(every, "customer_id", "left_semi"))
    put("customer_profile", INC.replace_keys(prev_prof, fresh, every, "customer_id"))


def _audit_and_publish(store: Warehouse, cfg: RunConfig, res: RunResult) -> dict[str, DataFrame]:
    """Quality suite over the staged rows, report, samples of failing rows and
    gate; a run that passes becomes visible.  Returns the marts."""
    spark = store.spark
    _step(spark, f"{cfg.run_id}: quality")
    results = materialize(quality_results(store, cfg.run_id, cfg.run_ts, cfg.id_type))
    if cfg.report_dir:
        W.save_report(results, cfg.report_dir, cfg.run_id, cfg.run_ts)
    if cfg.sample_dir:
        samples = quality_suite(store, cfg.run_ts, cfg.id_type).samples(results, cfg.run_id, cfg.sample_rows)
        if samples is not None:
            W.save_report(samples, cfg.sample_dir, cfg.run_id, cfg.run_ts)
    res.gate = REP.gate(results).first().asDict()
    broken = results.filter("status = 'fail' AND (test_name LIKE 'unique!_%' ESCAPE '!' OR test_name LIKE 'not!_null!_%' ESCAPE '!')").limit(5).collect()
    if broken:  # declared constraints hold in every published run
        raise K.ContractError(f"run {cfg.run_id}: {[r.test_name for r in broken]} broken, nothing is published")
    if not res.gate["passed"] and cfg.stop_on_error:
        raise QualityGateError(f"run {cfg.run_id}: {res.gate['failing']} failing checks, nothing is published")
    _step(spark, f"{cfg.run_id}: layer counts")
    res.layer_counts = layer_counts(store)
    frames = {name: store.read(name) for name in ("account_summary", "customer_profile")}
    store.commit()
    return frames


def backfill(spark: SparkSession, cfg: RunConfig, start: dt.datetime, end: dt.datetime) -> RunResult:
    """INC-8: compute the intermediate tables and marts anew for one slice -
    the accounts whose open version began in ``[start, end)`` - from the
    histories; the profiles of their customers move by the change.  No extract
    is read, and every other row stays as it is.  It is a run of its own (``run_id`` and
    ``run_ts`` of ``cfg``): audited, gated and published in one step, and
    exported by the next run.  A complete run id is a no-op; an empty slice
    publishes the same rows again."""
    store = Warehouse(spark, cfg.warehouse)
    declared = K.contracts(cfg.id_type)
    res = RunResult()
    if not store.exists("customer_profile"):
        raise FileNotFoundError(f"nothing to backfill: no complete run under {cfg.warehouse}")
    if not store.begin(cfg.run_id, cfg.run_ts):
        res.layer_counts = layer_counts(store)
        return res

    def put(name: str, df: DataFrame) -> DataFrame:
        return store.stage(name, declared[name].enforce(df, constraints=False), declared[name], unique=False)

    _step(spark, f"{cfg.run_id}: backfill")
    open_c, open_a = (History(store, name).open_versions() for name in ("snap_customer", "snap_account"))
    in_slice = (F.col(scd2.VFROM) >= F.lit(start)) & (F.col(scd2.VFROM) < F.lit(end))
    affected = materialize(open_a.filter(in_slice).select("account_id"))
    _refresh_marts(store, put, affected, open_c.select("customer_id").limit(0), open_a, open_c, F.lit(cfg.run_ts).cast("timestamp"))
    _audit_and_publish(store, cfg, res)
    for name in MART_TABLES:
        store.vacuum(name, cfg.keep_versions)
    spark.sparkContext.setJobDescription(None)
    return res


LAYER_TABLES = ("src_customer", "src_account", "stg_customer", "stg_account", "quarantine_stg_customer",
                "quarantine_stg_account", "int_account_with_customer", "int_savings_account_only",
                "account_summary", "customer_profile")
MART_TABLES = LAYER_TABLES[-4:]


def layer_counts(store: Warehouse) -> dict[str, int]:
    """QRY-7: row counts of every layer, as the staging writes observed them;
    histories are counted from Parquet footers."""
    each = store.runs().select("run_ts", F.explode("counts").alias("t", "n")).filter(F.col("t").isin(*LAYER_TABLES))
    known = {r.t: r.n for r in each.groupBy("t").agg(F.max_by("n", "run_ts").alias("n")).collect()} | store.counts
    out = {t: known[t] for t in LAYER_TABLES}
    for name in ("snap_customer", "snap_account"):
        out[name] = History(store, name).read().count()
    return out


# The latest time a layer must carry, and its age limit in hours.
RECENCY = (("src_customer", "loaded_at", 24), ("src_account", "loaded_at", 24), ("stg_customer", "loaded_at", 24),
           ("stg_account", "loaded_at", 24), ("snap_customer", "loaded_at", 25), ("snap_account", "loaded_at", 25),
           ("account_summary", "calculated_at", 26), ("customer_profile", "calculated_at", 26))


def quality_results(store: Warehouse, run_id: str, run_ts: dt.datetime, id_type: str = "int") -> DataFrame:
    """One row per declared check."""
    return quality_suite(store, run_ts, id_type).results(run_id)


def quality_suite(store: Warehouse, run_ts: dt.datetime, id_type: str = "int") -> DQ.Suite:
    """The pipeline's declared tests over the published layers: what the
    contracts say, and the rules of the marts.  Row conditions and recency of
    a table share one scan."""
    t = {n: store.read(n) for n in LAYER_TABLES} | {n: History(store, n).read() for n in ("snap_customer", "snap_account")}
    now = F.lit(run_ts).cast("timestamp")
    s = DQ.Suite(t)
    for name, contract in K.contracts(id_type).items():
        for c in contract.not_null:
            s.add(DQ.Check(name, f"not_null_{name}_{c}", condition=DQ.cond_not_null(c), column=c))
        if contract.unique:
            keys = list(contract.unique)
            s.add(DQ.Check(name, f"unique_{name}_{'_'.join(keys)}", column=keys[0], violations=lambda n=name, k=keys: DQ.unique(t[n], k)))
    for name, col, hours in RECENCY:
        s.add(DQ.Check(name, f"recency_{name}_{col}", column=col, severity="warn", measure=DQ.stale(col, now, hours)))
    for name, test, rule in (
            ("account_summary", "interest_not_negative", "annual_interest_amount >= 0"),
            ("account_summary", "new_balance_not_less", "new_balance_amount >= original_balance_amount"),
            ("customer_profile", "has_accounts", "total_accounts_count > 0"),
            ("customer_profile", "interest_not_negative", "total_annual_interest_amount >= 0"),
            ("snap_customer", "ends_after_start", "dbt_valid_to IS NULL OR dbt_valid_to > dbt_valid_from"),
            ("snap_account", "ends_after_start", "dbt_valid_to IS NULL OR dbt_valid_to > dbt_valid_from")):
        s.add(DQ.Check(name, f"expression_{name}_{test}", condition=DQ.cond_not_true(rule)))
    for name, col, severity in (("account_summary", "original_balance_amount", "error"),
                                ("int_savings_account_only", "balance_amount", "warn"), ("customer_profile", "total_balance_amount", "warn")):
        s.add(DQ.Check(name, f"positive_value_{name}_{col}", column=col, severity=severity, condition=DQ.cond_not_positive(col)))
    rates = [Decimal(r) for r in ("0.0100", "0.0150", "0.0200", "0.0250")]
    s.add(
        DQ.Check("stg_account", "accepted_values_stg_account_account_type", column="account_type",
                 condition=DQ.cond_not_accepted("account_type", C.ACCOUNT_TYPES)),
        DQ.Check("account_summary", "accepted_values_account_summary_interest_rate_pct", column="interest_rate_pct",
                 condition=DQ.cond_not_accepted("interest_rate_pct", rates)),
        DQ.Check("account_summary", "interest_rate_range", column="interest_rate_pct",
                 condition=DQ.cond_out_of_range("interest_rate_pct", Decimal("0.01"), Decimal("0.025"))),
        DQ.Check("int_account_with_customer", "int_account_balance_positive", column="balance_amount", severity="warn",
                 condition=F.coalesce(F.col("balance_amount") <= 0, F.lit(False))),
        DQ.Check("int_account_with_customer", "relationships_int_account_customer_id", column="customer_id",
                 violations=lambda: DQ.relationships(t["int_account_with_customer"], "customer_id", t["stg_customer"], "customer_id")),
        DQ.Check("account_summary", "relationships_account_summary_customer_id", column="customer_id",
                 violations=lambda: DQ.relationships(t["account_summary"], "customer_id", t["customer_profile"], "customer_id")),
        DQ.Check("int_savings_account_only", "int_savings_type",
                 violations=lambda: DQ.savings_missing(t["int_account_with_customer"], t["int_savings_account_only"])),
        DQ.Check("account_summary", "interest_calculation", violations=lambda: DQ.recompute(t["account_summary"])),
        DQ.Check("customer_profile", "customer_profile_aggregation",
                 violations=lambda: DQ.reconcile(t["customer_profile"], t["account_summary"])),
    )
    for name, key in (("snap_customer", "customer_id"), ("snap_account", "account_id")):
        s.add(DQ.Check(name, f"scd2_no_overlap_{name}", violations=lambda n=name, k=key: DQ.scd2_overlap(t[n], [k], SEGMENT_SECONDS)),
              DQ.Check(name, f"one_open_version_{name}", violations=lambda n=name, k=key: DQ.open_versions(t[n], [k])),
              DQ.Check(name, f"starts_in_the_past_{name}", condition=F.col("dbt_valid_from") > now))
    return s
