"""Oracle SQL (DuckDB dialect) for every registered query.

Written independently of the Spark code from the stated rules; the shared
pieces are the adapter projections of :mod:`strata.sources.tpch` (plain SQL
expressions valid in both engines) and the fixed run timestamps.  Integer
parsing is guarded with a regex because DuckDB's ``TRY_CAST('1.5' AS INT)``
rounds where Spark returns NULL (SEM-1).
"""

from __future__ import annotations

from strata.plans import layers
from strata.sources import tpch

LOAD = f"TIMESTAMP '{tpch.LOAD_TS}'"
RUN = f"TIMESTAMP '{tpch.RUN_TS}'"


def int_guard(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '^\\s*[+-]?[0-9]+\\s*$') THEN TRY_CAST({c} AS BIGINT) END)"


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


BASE = {
    "raw_customers": tpch.sql_select(tpch.RAW_CUSTOMER_EXPRS, "customer"),
    "raw_accounts": tpch.sql_select(tpch.RAW_ACCOUNT_EXPRS, "orders"),
    "src_customer": f"SELECT customer_id, name, has_loan, {LOAD} AS loaded_at FROM raw_customers",
    "src_account": f"SELECT account_id, customer_id, balance, account_type, {LOAD} AS loaded_at FROM raw_accounts",
    "cust_checked": f"""SELECT *, CASE
        WHEN {blank('customer_id')} THEN 'Invalid customer_id: null or empty'
        WHEN {int_guard('customer_id')} IS NULL THEN 'Invalid customer_id: non-numeric value (' || customer_id || ')'
        WHEN {blank('name')} THEN 'Invalid name: null or empty'
        WHEN lower(trim(has_loan)) NOT IN ('yes','y','true','1','no','n','false','0','none','')
             THEN 'Invalid has_loan value: ' || has_loan
        END AS failure_reason FROM src_customer""",
    "acc_checked": f"""SELECT *, CASE
        WHEN {blank('account_id')} THEN 'Invalid account_id: null or empty'
        WHEN {blank('customer_id')} THEN 'Invalid customer_id: null or empty'
        WHEN {int_guard('customer_id')} IS NULL THEN 'Invalid customer_id: non-numeric value (' || customer_id || ')'
        WHEN {blank('balance')} THEN 'Invalid balance: null or empty'
        WHEN lower(trim(balance)) IN ('null','n/a','none') THEN 'Invalid balance: null representation (' || balance || ')'
        WHEN TRY_CAST(balance AS DECIMAL(18,2)) IS NULL THEN 'Invalid balance: non-numeric value (' || balance || ')'
        WHEN TRY_CAST(balance AS DECIMAL(18,2)) < 0 THEN 'Invalid balance: negative value (' || balance || ')'
        WHEN {blank('account_type')} THEN 'Invalid account_type: null or empty'
        WHEN lower(trim(account_type)) NOT IN ('savings','checking')
             THEN 'Invalid account_type: must be Savings or Checking (' || account_type || ')'
        END AS failure_reason FROM src_account""",
    "stg_customer": f"""SELECT {int_guard('customer_id')} AS customer_id, lower(trim(name)) AS customer_name,
        coalesce(lower(trim(has_loan)) IN ('yes','y','true','1'), false) AS has_loan_flag, loaded_at
        FROM cust_checked WHERE failure_reason IS NULL""",
    "stg_account": f"""SELECT trim(account_id) AS account_id, {int_guard('customer_id')} AS customer_id,
        TRY_CAST(CASE WHEN lower(trim(balance)) IN ('null','n/a','','none') THEN NULL ELSE balance END
                 AS DECIMAL(18,2)) AS balance_amount,
        lower(trim(account_type)) AS account_type, loaded_at
        FROM acc_checked WHERE failure_reason IS NULL""",
    "awc": f"""SELECT a.account_id, a.customer_id, a.balance_amount, a.account_type,
        c.customer_name, c.has_loan_flag, {LOAD} AS valid_from_at, CAST(NULL AS TIMESTAMP) AS valid_to_at
        FROM stg_account a JOIN stg_customer c ON a.customer_id = c.customer_id""",
    "sav": """SELECT account_id, customer_id, customer_name, balance_amount, has_loan_flag, valid_from_at, valid_to_at
        FROM awc WHERE account_type = 'savings'""",
    "summ": f"""SELECT account_id, customer_id, original_balance_amount, interest_rate_pct,
        CAST(round(original_balance_amount * interest_rate_pct, 2) AS DECIMAL(18,2)) AS annual_interest_amount,
        CAST(round(original_balance_amount + CAST(round(original_balance_amount * interest_rate_pct, 2) AS DECIMAL(18,2)), 2)
             AS DECIMAL(18,2)) AS new_balance_amount,
        {RUN} AS calculated_at
        FROM (SELECT account_id, customer_id, CAST(balance_amount AS DECIMAL(18,2)) AS original_balance_amount,
                CAST(CASE WHEN balance_amount < 10000 THEN 0.01 WHEN balance_amount < 20000 THEN 0.015
                          WHEN balance_amount IS NOT NULL THEN 0.02 END
                     + CASE WHEN has_loan_flag = true THEN 0.005 ELSE 0.0 END AS DECIMAL(5,4)) AS interest_rate_pct
              FROM sav)""",
    "profile": """SELECT t.customer_id, c.customer_name, c.has_loan_flag, t.total_accounts_count,
        t.total_balance_amount, t.total_annual_interest_amount, t.calculated_at
        FROM (SELECT customer_id, count(account_id) AS total_accounts_count,
                     CAST(sum(original_balance_amount) AS DECIMAL(38,2)) AS total_balance_amount,
                     CAST(sum(annual_interest_amount) AS DECIMAL(38,2)) AS total_annual_interest_amount,
                     max(calculated_at) AS calculated_at
              FROM summ GROUP BY customer_id) t
        LEFT JOIN stg_customer c ON t.customer_id = c.customer_id""",
}


def with_base(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(BASE)
    ctes.update(extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + "\n" + body


SQL: dict[str, str] = {}

SQL["customer_clean"] = with_base("SELECT * FROM stg_customer")
SQL["account_clean"] = with_base("SELECT * FROM stg_account")
SQL["customer_quarantine"] = with_base(
    f"SELECT customer_id, name, has_loan, loaded_at, failure_reason, {RUN} AS quarantined_at "
    "FROM cust_checked WHERE failure_reason IS NOT NULL")
SQL["account_quarantine"] = with_base(
    f"SELECT account_id, customer_id, balance, account_type, loaded_at, failure_reason, {RUN} AS quarantined_at "
    "FROM acc_checked WHERE failure_reason IS NOT NULL")
SQL["quarantine_antijoin"] = with_base("""
SELECT s.account_id, s.customer_id, s.balance, s.account_type, s.loaded_at FROM src_account s
WHERE NOT EXISTS (SELECT 1 FROM acc_checked q WHERE q.failure_reason IS NOT NULL
  AND coalesce(s.account_id, '') = coalesce(q.account_id, '')
  AND coalesce(s.customer_id, '') = coalesce(q.customer_id, '')
  AND coalesce(s.balance, '') = coalesce(q.balance, '')
  AND coalesce(s.account_type, '') = coalesce(q.account_type, ''))""")
SQL["clean_string"] = with_base("""
SELECT customer_id AS raw_customer_id,
  CASE WHEN name IS NULL OR lower(trim(name)) IN ('null','n/a','','none') THEN NULL ELSE lower(trim(name)) END AS name_clean,
  CASE WHEN has_loan IS NULL OR lower(trim(has_loan)) IN ('null','n/a','','none') THEN NULL ELSE lower(trim(has_loan)) END AS has_loan_clean
FROM raw_customers""")
SQL["standardize_boolean"] = with_base("""
SELECT customer_id AS raw_customer_id, has_loan,
  CASE WHEN has_loan IS NULL THEN NULL
       WHEN lower(trim(has_loan)) IN ('yes','y','true','1') THEN true
       WHEN lower(trim(has_loan)) IN ('no','n','false','0','none') THEN false END AS has_loan_bool
FROM raw_customers""")
SQL["standardize_names"] = ("SELECT c_custkey AS customer_id, c_name AS name_full, c_acctbal AS acct_bal_usd, "
                            "c_mktsegment AS mkt_segment FROM customer")
SQL["account_with_customer"] = with_base("SELECT * FROM awc")
SQL["savings_only"] = with_base("SELECT * FROM sav")
SQL["account_summary"] = with_base("SELECT * FROM summ")
SQL["customer_profile"] = with_base("SELECT * FROM profile")
SQL["tier_summary"] = with_base("""
SELECT interest_rate_pct, count(*) AS accounts_count,
  CAST(sum(original_balance_amount) AS DECIMAL(38,2)) AS total_balance_amount,
  CAST(sum(annual_interest_amount) AS DECIMAL(38,2)) AS total_interest_amount,
  CAST(avg(annual_interest_amount) AS DECIMAL(18,4)) AS avg_interest_amount
FROM summ GROUP BY interest_rate_pct""")
SQL["top_accounts"] = with_base(
    "SELECT * FROM summ ORDER BY annual_interest_amount DESC, account_id ASC LIMIT 10")
SQL["group_average_compare"] = """
WITH o AS (SELECT o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
per AS (SELECT o_orderpriority, avg(amount) AS group_avg, count(*) AS rows_count FROM o GROUP BY o_orderpriority),
allavg AS (SELECT avg(amount) AS overall_avg FROM o)
SELECT o_orderpriority, rows_count, CAST(group_avg AS DECIMAL(18,2)) AS group_avg,
  CAST(overall_avg AS DECIMAL(18,2)) AS overall_avg,
  CASE WHEN group_avg > overall_avg THEN 'above' WHEN group_avg < overall_avg THEN 'below' ELSE 'equal' END AS position
FROM per, allavg"""


# --- SCD2 history --------------------------------------------------------------
T1, T2 = "TIMESTAMP '2024-01-15 00:00:00'", "TIMESTAMP '2024-01-31 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"
ARCHIVE_BEFORE = "TIMESTAMP '2024-01-10 00:00:00'"
VALUE_BAND = "CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END"


def scd_id(key: str, ts: str, tie: str | None = None) -> str:
    parts = [f"CAST({key} AS VARCHAR)", f"CAST(epoch_us({ts}) AS VARCHAR)"] + ([f"CAST({tie} AS VARCHAR)"] if tie else [])
    return "md5(" + " || ".join(f"length({p}) || ':' || {p}" for p in parts) + ")"


def log_history(attr_expr: str, attr: str) -> str:
    return f"""SELECT user_id, {attr}, {scd_id('user_id', 'ts', 'event_id')} AS dbt_scd_id, ts AS dbt_updated_at,
        ts AS dbt_valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dbt_valid_to
      FROM (SELECT user_id, ts, event_id, {attr_expr} AS {attr},
                   lag(ts) OVER w AS p_ts, lag({attr_expr}) OVER w AS p_attr
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) x
      WHERE p_ts IS NULL OR p_attr IS DISTINCT FROM {attr}"""


HIST = {"hist": log_history("event_type", "event_type")}


def extract(cutoff: str) -> str:
    return f"""SELECT user_id, event_type, ts AS last_event_ts FROM (
        SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE ts < {cutoff}) x WHERE rn = 1 AND event_type <> 'error'"""


def merged(strategy: str) -> str:
    if strategy == "check":
        h1_from = T1
        changed = "h.event_type IS DISTINCT FROM n.event_type"
        new_from = T2
    else:
        h1_from = "last_event_ts"
        changed = "n.last_event_ts > h.dbt_updated_at"
        new_from = "n.last_event_ts"
    return f"""WITH e1 AS ({extract(T1)}), e2 AS ({extract(T2)}),
h1 AS (SELECT user_id, event_type, last_event_ts, {scd_id('user_id', h1_from)} AS dbt_scd_id,
              {h1_from} AS dbt_updated_at, {h1_from} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to FROM e1),
j AS (SELECT h.user_id AS h_user, h.event_type AS h_type, h.last_event_ts AS h_ts, h.dbt_scd_id AS h_id,
             h.dbt_updated_at AS h_upd, h.dbt_valid_from AS h_from,
             n.user_id AS n_user, n.event_type AS n_type, n.last_event_ts AS n_ts,
             (h.user_id IS NOT NULL AND n.user_id IS NOT NULL AND coalesce({changed}, false)) AS changed,
             {new_from} AS new_from
      FROM h1 h FULL OUTER JOIN e2 n ON h.user_id = n.user_id)
SELECT h_user AS user_id, h_type AS event_type, h_ts AS last_event_ts, h_id AS dbt_scd_id, h_upd AS dbt_updated_at,
       h_from AS dbt_valid_from,
       CASE WHEN changed THEN new_from WHEN n_user IS NULL THEN {T2} END AS dbt_valid_to
FROM j WHERE h_user IS NOT NULL
UNION ALL
SELECT n_user, n_type, n_ts, {scd_id('n_user', 'new_from')}, new_from, new_from, CAST(NULL AS TIMESTAMP)
FROM j WHERE n_user IS NOT NULL AND (h_user IS NULL OR changed)"""


def with_hist(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(HIST)
    ctes.update(extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + "\n" + body


SQL["scd2_from_log"] = with_hist("SELECT * FROM hist")
SQL["scd2_merge_check"] = merged("check")
SQL["scd2_merge_timestamp"] = merged("timestamp")
SQL["scd2_current"] = with_hist("SELECT * FROM hist WHERE dbt_valid_to IS NULL")
SQL["scd2_as_of"] = with_hist(
    f"SELECT * FROM hist WHERE dbt_valid_from <= {AS_OF} AND (dbt_valid_to IS NULL OR {AS_OF} < dbt_valid_to)")
SQL["scd2_key_history"] = with_hist("""SELECT user_id, dbt_scd_id, dbt_valid_from, dbt_valid_to,
    row_number() OVER (PARTITION BY user_id ORDER BY dbt_valid_from, dbt_scd_id) AS version_no,
    dbt_valid_to IS NULL AS is_current FROM hist""")
SQL["pit_join"] = with_hist("""SELECT a.user_id, a.event_type, b.value_band,
    greatest(a.dbt_valid_from, b.dbt_valid_from) AS dbt_valid_from,
    CASE WHEN a.dbt_valid_to IS NULL THEN b.dbt_valid_to WHEN b.dbt_valid_to IS NULL THEN a.dbt_valid_to
         ELSE least(a.dbt_valid_to, b.dbt_valid_to) END AS dbt_valid_to
  FROM hist a JOIN band b ON a.user_id = b.user_id
   AND a.dbt_valid_from < coalesce(b.dbt_valid_to, TIMESTAMP '9999-12-31')
   AND b.dbt_valid_from < coalesce(a.dbt_valid_to, TIMESTAMP '9999-12-31')""",
                            {"band": log_history(VALUE_BAND, "value_band")})
SQL["scd2_multi_version"] = ("WITH m AS (" + merged("check") + ") SELECT user_id, count(*) AS versions_count "
                             "FROM m GROUP BY user_id HAVING count(*) > 1")
SQL["scd2_storage_metrics"] = with_hist("""SELECT count(*) AS total_versions, count(DISTINCT user_id) AS distinct_keys,
    count(*) FILTER (WHERE dbt_valid_to IS NULL) AS open_versions,
    count(*) FILTER (WHERE dbt_valid_to IS NOT NULL) AS closed_versions,
    CAST(round(count(*) / nullif(count(DISTINCT user_id), 0), 2) AS DECIMAL(18,2)) AS avg_versions_per_key
  FROM hist""")
SQL["scd2_recent_changes"] = with_hist(
    f"SELECT * FROM hist WHERE dbt_valid_from > {T2} - INTERVAL 24 HOUR ORDER BY dbt_valid_from DESC")
SQL["scd2_growth"] = with_hist(f"""SELECT b.versions_before, a.versions_after, b.keys_before, a.keys_after,
    CAST(round(a.versions_after / nullif(b.versions_before, 0), 4) AS DECIMAL(18,4)) AS growth_rate,
    CAST(round(a.versions_after / nullif(a.keys_after, 0), 4) AS DECIMAL(18,4)) AS versions_per_key
  FROM (SELECT count(*) AS versions_before, count(DISTINCT user_id) AS keys_before FROM hist
        WHERE dbt_valid_from < {T1}) b,
       (SELECT count(*) AS versions_after, count(DISTINCT user_id) AS keys_after FROM hist) a""")
SQL["scd2_retention"] = with_hist(f"""SELECT *, (dbt_valid_to IS NOT NULL AND dbt_valid_to < {ARCHIVE_BEFORE}) AS archived
  FROM hist""")


# --- incremental ---------------------------------------------------------------
PREV_CUTOFF = "TIMESTAMP '2000-01-01 00:00:00'"
SLICE = "updated_at >= TIMESTAMP '1996-01-01 00:00:00' AND updated_at < TIMESTAMP '1996-02-01 00:00:00'"
CHANGE_TS = "TIMESTAMP '2001-09-01 00:00:00'"

EV1 = tpch.sql_select(tpch.ACCOUNT_EVENT_EXPRS, "orders")
EV2 = f"""SELECT account_id,
    CASE WHEN account_id % 34 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id,
    CASE WHEN account_id % 17 = 0 THEN CAST(balance_amount + 100 AS DECIMAL(18,2)) ELSE balance_amount END AS balance_amount,
    account_type,
    CASE WHEN account_id % 17 = 0 THEN {CHANGE_TS} ELSE updated_at END AS updated_at
  FROM ({EV1}) e"""


def rated(src: str) -> str:
    return f"""SELECT account_id, customer_id, original_balance_amount, interest_rate_pct, updated_at,
        CAST(round(original_balance_amount * interest_rate_pct, 2) AS DECIMAL(18,2)) AS annual_interest_amount,
        CAST(round(original_balance_amount + CAST(round(original_balance_amount * interest_rate_pct, 2) AS DECIMAL(18,2)), 2)
             AS DECIMAL(18,2)) AS new_balance_amount
      FROM (SELECT account_id, customer_id, balance_amount AS original_balance_amount,
                   CAST(CASE WHEN balance_amount < 10000 THEN 0.01 WHEN balance_amount < 20000 THEN 0.015
                             WHEN balance_amount IS NOT NULL THEN 0.02 END AS DECIMAL(5,4)) AS interest_rate_pct,
                   updated_at FROM ({src}) s) r"""


MARK = f"(SELECT coalesce(max(updated_at), TIMESTAMP '1900-01-01') FROM ({EV1}) p WHERE updated_at < {PREV_CUTOFF})"
SQL["incremental_watermark"] = f"SELECT * FROM ({EV1}) e WHERE updated_at > {MARK}"
SQL["incremental_lookback"] = f"SELECT * FROM ({EV1}) e WHERE updated_at > {MARK} - INTERVAL 3 DAY"
SQL["backfill_slice"] = rated(EV1)
SQL["upsert"] = f"""WITH target AS ({rated(f"SELECT * FROM ({EV1}) e WHERE updated_at < {PREV_CUTOFF}")}),
batch AS ({rated(f"SELECT * FROM ({EV2}) e WHERE updated_at > {MARK} - INTERVAL 3 DAY")})
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.account_id = t.account_id)
UNION ALL SELECT * FROM batch"""
# Incremental maintenance must equal the full recompute over the new source.
SQL["changed_key_profile"] = f"""SELECT customer_id, count(*) AS total_accounts_count,
    CAST(sum(original_balance_amount) AS DECIMAL(38,2)) AS total_balance_amount,
    CAST(sum(annual_interest_amount) AS DECIMAL(38,2)) AS total_annual_interest_amount
  FROM ({rated(EV2)}) r GROUP BY customer_id"""


# --- data quality --------------------------------------------------------------
CHECK_NOW = "TIMESTAMP '2024-02-05 00:00:00'"
EARLY = f"TIMESTAMP '{layers.EARLY}'"
IV = f"""SELECT user_id, event_type, {scd_id('user_id', 'ts', 'event_id')} AS dbt_scd_id, ts AS dbt_valid_from,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts + to_hours(CAST(event_id % 7 AS BIGINT)) END AS dbt_valid_to
  FROM events"""
OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"

SQL["dq_not_null"] = with_base("SELECT * FROM raw_accounts WHERE account_id IS NULL")
SQL["dq_unique"] = """SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
SQL["dq_accepted_values"] = with_base("""SELECT lower(trim(account_type)) AS value, count(*) AS n_records
  FROM raw_accounts WHERE lower(trim(account_type)) NOT IN ('savings', 'checking') GROUP BY 1""")
SQL["dq_relationships"] = with_base("""SELECT o_orderkey, o_custkey AS customer_id FROM orders o
  WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_customer c WHERE c.customer_id = o.o_custkey)""")
SQL["dq_positive_value"] = """SELECT c_acctbal AS value, count(*) AS violation_count FROM customer
  WHERE c_acctbal <= 0 OR c_acctbal IS NULL GROUP BY c_acctbal"""
SQL["dq_date_range"] = """SELECT o_orderdate AS date_value, count(*) AS violation_count FROM orders
  WHERE o_orderdate IS NULL OR o_orderdate < TIMESTAMP '1995-06-01' OR o_orderdate > TIMESTAMP '2001-01-01'
  GROUP BY o_orderdate"""
SQL["dq_expression"] = "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)"
SQL["dq_scd2_overlap"] = f"""WITH iv AS ({IV}),
pm AS (SELECT *, max(coalesce(dbt_valid_to, {OPEN_END})) OVER (PARTITION BY user_id
         ORDER BY dbt_valid_from, coalesce(dbt_valid_to, {OPEN_END}), dbt_scd_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max_end FROM iv)
SELECT user_id, dbt_scd_id, dbt_valid_from, dbt_valid_to, prev_max_end FROM pm WHERE dbt_valid_from < prev_max_end"""
SQL["dq_one_current"] = f"""WITH iv AS ({IV}) SELECT user_id, count(*) AS open_versions FROM iv
  WHERE dbt_valid_to IS NULL GROUP BY user_id HAVING count(*) > 1"""


def recency_sql(col: str, src: str, hours: int) -> str:
    return f"""SELECT max({col}) AS max_value,
    CAST((epoch_us({CHECK_NOW}) - epoch_us(max({col}))) / 3600000000 AS DECIMAL(18,2)) AS age_hours,
    {hours} AS max_age_hours,
    coalesce(max({col}) < {CHECK_NOW} - INTERVAL {hours} HOUR, true) AS is_stale FROM {src}"""


SQL["dq_recency"] = recency_sql("ts", "events", 72)
SQL["dq_interval_order"] = f"""WITH iv AS ({IV})
SELECT *, CASE WHEN dbt_valid_to IS NULL AND dbt_valid_from > {EARLY} THEN 'open version starts in the future'
               ELSE 'closed version does not end after it starts' END AS problem
FROM iv WHERE (dbt_valid_to IS NULL AND dbt_valid_from > {EARLY})
   OR (dbt_valid_to IS NOT NULL AND dbt_valid_to <= dbt_valid_from)"""
BAD_SUMM = {"bad_summ": f"""SELECT account_id, customer_id, original_balance_amount, {layers.BAD_RATE} AS interest_rate_pct,
    {layers.BAD_INTEREST} AS annual_interest_amount, {layers.BAD_BALANCE} AS new_balance_amount FROM summ""",
            "bad_profile": f"""SELECT customer_id, {layers.BAD_ACCOUNTS} AS total_accounts_count,
    {layers.BAD_TOTAL} AS total_balance_amount, total_annual_interest_amount FROM profile"""}
SQL["dq_rate_range"] = with_base(
    "SELECT account_id, interest_rate_pct FROM bad_summ WHERE interest_rate_pct < 0.01 OR interest_rate_pct > 0.025", BAD_SUMM)
def off(actual: str, expected: str) -> str:
    return f"coalesce(abs({actual} - {expected}) > 0.01, ({actual} IS NULL) <> ({expected} IS NULL))"


def recompute_sql(summ: str) -> str:
    pairs = {"annual_interest_amount": ("annual_interest_amount", "round(original_balance_amount * interest_rate_pct, 2)"),
             "new_balance_amount": ("new_balance_amount", "(original_balance_amount + annual_interest_amount)")}
    return " UNION ALL ".join(
        f"SELECT account_id, '{m}' AS measure, CAST({a} AS DECIMAL(38,4)) AS actual, CAST({e} AS DECIMAL(38,4)) AS expected "
        f"FROM {summ} WHERE {off(a, e)}" for m, (a, e) in pairs.items())


def reconcile_sql(profile: str) -> str:
    detail = ("(SELECT customer_id, count(DISTINCT account_id) AS n, sum(original_balance_amount) AS b, "
              "sum(annual_interest_amount) AS i FROM summ GROUP BY customer_id)")
    pairs = {"total_accounts_count": "d.n", "total_balance_amount": "d.b", "total_annual_interest_amount": "d.i"}
    return " UNION ALL ".join(
        f"SELECT p.customer_id, '{m}' AS measure, CAST(p.{m} AS DECIMAL(38,4)) AS actual, CAST({e} AS DECIMAL(38,4)) AS expected "
        f"FROM {profile} p LEFT JOIN {detail} d ON p.customer_id = d.customer_id WHERE {off('p.' + m, e)}" for m, e in pairs.items())


SQL["dq_recompute"] = with_base(recompute_sql("bad_summ"), BAD_SUMM)
SQL["dq_reconcile"] = with_base(reconcile_sql("bad_profile"), BAD_SUMM)
SQL["dq_non_positive_balance"] = with_base(
    "SELECT account_id, customer_id, balance_amount FROM awc WHERE balance_amount <= 0")
SQL["dq_savings_type"] = with_base("""SELECT account_id, customer_id, balance_amount FROM awc
  WHERE account_type = 'savings' AND account_id NOT IN (SELECT account_id FROM sav WHERE """ + layers.LOST_SAVINGS + ")")
SQL["dq_row_count"] = """SELECT * FROM (
  SELECT (SELECT count(*) FROM events WHERE ts > TIMESTAMP '2030-01-01') AS row_count, 'after 2030' AS slice
  UNION ALL SELECT (SELECT count(*) FROM events), 'all') x WHERE row_count = 0"""
SQL["dq_accepted_range"] = "SELECT p_partkey, p_size FROM part WHERE p_size < 1 OR p_size > 45"

# The suite: (table, test, column, severity, warn_if, error_if, violating-rows SQL).
SUITE = [
    *[("stg_customer", f"not_null_stg_customer_{c}", c, "error", 0, 0, f"SELECT * FROM stg_customer WHERE {c} IS NULL")
      for c in ("customer_id", "customer_name", "has_loan_flag", "loaded_at")],
    *[("stg_account", f"not_null_stg_account_{c}", c, "error", 0, 0, f"SELECT * FROM stg_account WHERE {c} IS NULL")
      for c in ("account_id", "customer_id", "balance_amount", "account_type", "loaded_at")],
    ("stg_account", "accepted_values_stg_account_account_type", "account_type", "error", 0, 0,
     "SELECT * FROM stg_account WHERE account_type NOT IN ('savings', 'checking')"),
    ("stg_customer", "unique_stg_customer_customer_id", "customer_id", "error", 0, 0,
     "SELECT customer_id FROM stg_customer WHERE customer_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("stg_account", "unique_stg_account_account_id", "account_id", "error", 0, 0,
     "SELECT account_id FROM stg_account WHERE account_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("quarantine_stg_account", "not_null_quarantine_failure_reason", "failure_reason", "error", 0, 0,
     "SELECT * FROM acc_checked WHERE failure_reason IS NOT NULL AND failure_reason IS NULL"),
    ("int_account_with_customer", "relationships_int_account_customer_id", "customer_id", "error", 0, 0,
     "SELECT * FROM awc a WHERE customer_id IS NOT NULL AND NOT EXISTS "
     "(SELECT 1 FROM stg_customer c WHERE c.customer_id = a.customer_id)"),
    ("int_account_with_customer", "int_account_balance_positive", "balance_amount", "error", 0, 0,
     "SELECT * FROM awc WHERE balance_amount <= 0"),
    ("account_summary", "positive_value_account_summary_original_balance_amount", "original_balance_amount",
     "error", 0, 0, "SELECT * FROM summ WHERE original_balance_amount <= 0 OR original_balance_amount IS NULL"),
    ("account_summary", "expression_is_true_account_summary_interest", "annual_interest_amount", "error", 0, 0,
     "SELECT * FROM summ WHERE NOT (annual_interest_amount >= 0)"),
    ("account_summary", "interest_rate_range", "interest_rate_pct", "error", 0, 0,
     "SELECT * FROM summ WHERE interest_rate_pct < 0.01 OR interest_rate_pct > 0.025"),
    ("account_summary", "interest_calculation", None, "error", 0, 0, recompute_sql("summ")),
    ("customer_profile", "unique_customer_profile_customer_id", "customer_id", "error", 0, 0,
     "SELECT customer_id FROM profile WHERE customer_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    ("customer_profile", "customer_profile_aggregation", None, "error", 0, 0, reconcile_sql("profile")),
    ("src_customer", "row_count_src_customer", None, "error", 0, 0,
     "SELECT * FROM (SELECT count(*) AS n FROM src_customer) x WHERE n = 0"),
    ("snap_user", "scd2_no_overlap_snap_user", "user_id", "warn", 0, 0,
     f"""SELECT * FROM (SELECT *, max(coalesce(dbt_valid_to, {OPEN_END})) OVER (PARTITION BY user_id
         ORDER BY dbt_valid_from, coalesce(dbt_valid_to, {OPEN_END}), dbt_scd_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM iv) x WHERE dbt_valid_from < pm"""),
    ("snap_user", "one_open_version_snap_user", "user_id", "warn", 0, 0,
     "SELECT user_id FROM iv WHERE dbt_valid_to IS NULL GROUP BY user_id HAVING count(*) > 1"),
    ("lineitem", "unique_lineitem_order_line", None, "error", 0, 100000000,
     "SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL "
     "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    ("customer", "positive_value_customer_c_acctbal", "c_acctbal", "warn", 0, 0,
     "SELECT * FROM customer WHERE c_acctbal <= 0 OR c_acctbal IS NULL"),
]


def _sq(v) -> str:
    return "NULL" if v is None else f"'{v}'"


RESULTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{n}' AS test_name, CAST({_sq(c)} AS VARCHAR) AS column_name, '{s}' AS severity, "
    f"{w} AS warn_if, {e} AS error_if, (SELECT count(*) FROM ({q}) v) AS violations"
    for t, n, c, s, w, e, q in SUITE)
RESULTS_CTES = {
    "iv": IV,
    "results0": RESULTS,
    "results": """SELECT 'run-1' AS run_id, table_name,
        CASE WHEN starts_with(table_name, 'src_') THEN 'source' WHEN starts_with(table_name, 'stg_') THEN 'staging'
             WHEN starts_with(table_name, 'snap_') THEN 'snapshot'
             WHEN starts_with(table_name, 'int_') THEN 'intermediate' ELSE 'marts' END AS layer,
        test_name, column_name, severity, violations,
        CASE WHEN severity = 'error' AND violations > error_if THEN 'fail' WHEN violations > warn_if THEN 'warn'
             ELSE 'pass' END AS status FROM results0""",
}
SQL["dq_threshold"] = with_base(
    "SELECT test_name, severity, violations, status FROM results WHERE table_name = 'lineitem'", RESULTS_CTES)
SQL["quality_report"] = with_base("""SELECT
    CASE WHEN GROUPING(layer) = 1 AND GROUPING(severity) = 1 THEN 'overall'
         WHEN GROUPING(layer) = 0 THEN 'layer' ELSE 'severity' END AS grouping_level,
    coalesce(layer, severity, 'all') AS group_value,
    count(*) AS total, count(*) FILTER (WHERE status = 'pass') AS passed,
    count(*) FILTER (WHERE status = 'fail') AS failed, count(*) FILTER (WHERE status = 'warn') AS warned,
    count(*) FILTER (WHERE status = 'skip') AS skipped, count(*) FILTER (WHERE status = 'error') AS errored,
    CAST(coalesce(round(count(*) FILTER (WHERE status = 'pass') * 100.0 / nullif(count(*), 0), 2), 0.0)
         AS DECIMAL(5,2)) AS pass_rate
  FROM results GROUP BY GROUPING SETS ((), (layer), (severity))""", RESULTS_CTES)
SQL["quality_gate"] = with_base("""SELECT count(*) AS tests,
    count(*) FILTER (WHERE status IN ('fail', 'error')) AS failing,
    count(*) FILTER (WHERE status = 'warn') AS warning,
    count(*) FILTER (WHERE status IN ('fail', 'error')) = 0 AS passed,
    CASE WHEN count(*) FILTER (WHERE status IN ('fail', 'error')) > 0 THEN 'error'
         WHEN count(*) FILTER (WHERE status = 'warn') > 0 THEN 'warn' ELSE 'ok' END AS level
  FROM results""", RESULTS_CTES)
SQL["dq_freshness"] = with_base(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, * FROM ({recency_sql(c, s, h)}) r" for n, c, s, h in
    (("src_account", "loaded_at", "src_account", 24), ("stg_account", "loaded_at", "stg_account", 24),
     ("int_account_with_customer", "valid_from_at", "awc", 25), ("account_summary", "calculated_at", "summ", 26))))


# --- ingestion profile, exports, layer counts, streaming ------------------------
SQL["ingest_profile"] = with_base("""SELECT count(*) AS row_count,
    count(*) FILTER (WHERE account_id IS NULL) AS null_account_id,
    count(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id,
    count(*) FILTER (WHERE balance IS NULL) AS null_balance,
    count(*) FILTER (WHERE account_type IS NULL) AS null_account_type,
    count(*) FILTER (WHERE TRY_CAST(balance AS DOUBLE) < 0) AS negative_balance,
    count(*) FILTER (WHERE TRY_CAST(balance AS DOUBLE) IS NULL AND balance IS NOT NULL) AS unparseable_balance
  FROM raw_accounts""")
SQL["export_roundtrip"] = with_base("SELECT * FROM summ")
SQL["layer_counts"] = with_base(" UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS row_count FROM {src}"
    for layer, name, src in (
        ("source", "src_customer", "src_customer"), ("source", "src_account", "src_account"),
        ("staging", "stg_customer", "stg_customer"),
        ("staging", "quarantine_stg_customer", "(SELECT * FROM cust_checked WHERE failure_reason IS NOT NULL)"),
        ("staging", "stg_account", "stg_account"),
        ("staging", "quarantine_stg_account", "(SELECT * FROM acc_checked WHERE failure_reason IS NOT NULL)"),
        ("intermediate", "int_account_with_customer", "awc"), ("intermediate", "int_savings_account_only", "sav"),
        ("marts", "account_summary", "summ"), ("marts", "customer_profile", "profile"))))
SQL["stream_latest_state"] = """SELECT user_id, event_type, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
  WHERE rn = 1"""

# The whole pipeline, full build then incremental run: equal to a full
# computation over the second input.
_RAW_ACCOUNTS_V2 = f"""SELECT account_id, customer_id,
    CASE WHEN o_orderkey % 10 = 3 AND TRY_CAST(balance AS DECIMAL(18,2)) IS NOT NULL
         THEN CAST(TRY_CAST(balance AS DECIMAL(18,2)) + 1 AS VARCHAR) ELSE balance END AS balance,
    account_type
  FROM ({tpch.sql_select(dict(tpch.RAW_ACCOUNT_EXPRS, o_orderkey="o_orderkey"), "orders")}) r"""
SQL["pipeline_incremental_profile"] = with_base(f"""SELECT t.customer_id, c.customer_name, c.has_loan_flag,
    t.total_accounts_count, t.total_balance_amount, t.total_annual_interest_amount, t.calculated_at
  FROM (SELECT customer_id, count(*) AS total_accounts_count,
               CAST(sum(original_balance_amount) AS DECIMAL(38,2)) AS total_balance_amount,
               CAST(sum(annual_interest_amount) AS DECIMAL(38,2)) AS total_annual_interest_amount,
               max(CASE WHEN CAST(account_id AS BIGINT) % 10 = 3 THEN {RUN} ELSE {LOAD} END) AS calculated_at
        FROM summ GROUP BY customer_id) t
  LEFT JOIN stg_customer c ON t.customer_id = c.customer_id""", {"raw_accounts": _RAW_ACCOUNTS_V2})

# --- further operators -----------------------------------------------------------
SQL["in_subquery"] = "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
SQL["not_in_subquery"] = "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"
SQL["distinct_attributes"] = "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer"
SQL["latest_per_key"] = "SELECT user_id, arg_max(event_type, event_id) AS latest FROM events GROUP BY user_id"
SQL["preview_rows"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 7"
SQL["sample_violations"] = "SELECT p_partkey, p_size FROM part WHERE p_size < 1 OR p_size > 45 ORDER BY p_partkey LIMIT 10"
SQL["quality_issues"] = with_base("""SELECT table_name, test_name, severity, violations, status,
    CASE WHEN status = 'fail' THEN violations || ' violating rows; at most ' || error_if || ' allowed'
         ELSE violations || ' violating rows; warning above ' || warn_if END AS message
  FROM results JOIN (SELECT test_name, any_value(warn_if) AS warn_if, any_value(error_if) AS error_if FROM results0 GROUP BY 1)
    USING (test_name) WHERE status <> 'pass'""", RESULTS_CTES)
SQL["quality_overall"] = with_base("""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'pass') AS passed,
    count(*) FILTER (WHERE status = 'fail') AS failed, count(*) FILTER (WHERE status = 'warn') AS warned,
    count(*) FILTER (WHERE status = 'skip') AS skipped, count(*) FILTER (WHERE status = 'error') AS errored,
    CAST(coalesce(round(count(*) FILTER (WHERE status = 'pass') * 100.0 / nullif(count(*), 0), 2), 0.0) AS DECIMAL(5,2)) AS pass_rate
  FROM results""", RESULTS_CTES)
SQL["report_roundtrip"] = with_base(
    "SELECT test_name, severity, violations, 'run-10' AS run_id FROM results WHERE table_name = 'lineitem'", RESULTS_CTES)
SQL["incremental_first_run"] = f"SELECT account_id, CAST(updated_at AS TIMESTAMP) AS updated_at FROM ({tpch.sql_select(tpch.ACCOUNT_EVENT_EXPRS, 'orders')})"
SQL["scd2_reinsert"] = f"""SELECT c_custkey, c_mktsegment, {T1} AS dbt_valid_from,
    CASE WHEN c_custkey % 5 = 0 THEN {T2} END AS dbt_valid_to FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment, {CHECK_NOW}, CAST(NULL AS TIMESTAMP) FROM customer WHERE c_custkey % 5 = 0"""
SQL["padded_and_proper_names"] = """SELECT 'S-' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS supplier_key,
    array_to_string(list_transform(string_split(trim(s_name), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS supplier_name FROM supplier"""
SQL["stream_without_repeats"] = "SELECT event_id, user_id, ts FROM events"

SQL["stream_changed_keys"] = """WITH e AS (SELECT *, (user_id + event_id) % 4 AS part FROM events)
SELECT b.part AS batch_id, b.user_id, l.event_type, l.ts, l.event_id FROM (SELECT DISTINCT part, user_id FROM e) b,
  LATERAL (SELECT event_type, ts, event_id FROM e WHERE e.user_id = b.user_id AND e.part <= b.part ORDER BY ts DESC, event_id DESC LIMIT 1) l"""
SQL["stream_late_rows"] = f"""WITH e AS (SELECT event_id, user_id, ts, {layers.ARRIVAL} AS batch FROM events),
marks AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM e GROUP BY batch)
SELECT e.*, coalesce(ts < mark - INTERVAL 3 DAY, false) AS late FROM e JOIN marks USING (batch)"""
SQL["stream_quarantine"] = f"""SELECT CASE WHEN o_orderkey % 13 > 0 AND o_orderkey % 17 > 0 THEN o_orderkey END AS account_id,
    CASE WHEN o_orderkey % 13 > 0 AND o_orderkey % 17 > 0 THEN o_custkey END AS customer_id,
    CASE WHEN o_orderkey % 13 > 0 AND o_orderkey % 17 > 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS balance,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN {layers.ORDER_LINE} END AS malformed FROM orders"""
SQL["audited_write"] = with_base("""SELECT attempt, CASE WHEN attempt = 3 THEN 2 ELSE 1 END * n AS rows_visible,
    CASE WHEN attempt = 3 THEN 2 ELSE 1 END * n AS accounts_visible,
    CAST(CASE WHEN attempt = 3 THEN 2 ELSE 1 END * b AS DECIMAL(38,2)) AS balance_visible, 0 AS nulls_visible
  FROM (SELECT count(*) AS n, sum(original_balance_amount) AS b FROM summ), (VALUES (0), (1), (2), (3)) t(attempt)""")

# --- maintenance that costs what changed -------------------------------------------
SQL["profile_by_deltas"] = f"""SELECT customer_id, count(*) AS total_accounts_count,
    CAST(sum(original_balance_amount) AS DECIMAL(38,2)) AS total_balance_amount,
    CAST(sum(annual_interest_amount) AS DECIMAL(38,2)) AS total_annual_interest_amount, max(updated_at) AS last_updated_at
  FROM ({rated(EV2)}) r GROUP BY customer_id"""
SQL["upsert_touched_partitions"] = SQL["upsert"].replace(
    "SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.account_id = t.account_id)",
    "SELECT * FROM target t WHERE t.account_id % 19 <> 0 AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.account_id = t.account_id)")
# Four snapshots side by side; a version is a stretch of equal neighbours.
_EXTRACTS = " UNION ALL ".join(
    f"SELECT {i} AS n, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn "
    f"FROM events WHERE ts < TIMESTAMP '{t}') e WHERE rn = 1 AND event_type <> 'error'" for i, t in enumerate(layers.EXTRACT_TIMES))
_TIMES = "[" + ", ".join(f"TIMESTAMP '{t}'" for t in layers.EXTRACT_TIMES) + "]"
SQL["scd2_from_extracts"] = f"""WITH x AS ({_EXTRACTS}),
marked AS (SELECT x.*, p.user_id IS NULL AS opens FROM x LEFT JOIN x p ON p.user_id = x.user_id AND p.n = x.n - 1 AND p.event_type = x.event_type),
opened AS (SELECT o.user_id, o.event_type, o.ts, o.n,
    (SELECT min(g.n) FROM range({len(layers.EXTRACT_TIMES)}) g(n) WHERE g.n > o.n
       AND NOT EXISTS (SELECT 1 FROM marked s WHERE s.user_id = o.user_id AND s.n = g.n AND NOT s.opens)) AS until
  FROM marked o WHERE o.opens)
SELECT user_id, event_type, ts AS last_event_ts, {scd_id('user_id', f'{_TIMES}[n + 1]')} AS dbt_scd_id, {_TIMES}[n + 1] AS dbt_updated_at,
  {_TIMES}[n + 1] AS dbt_valid_from, CASE WHEN until IS NOT NULL THEN {_TIMES}[until + 1] END AS dbt_valid_to FROM opened"""


# --- results of other runners, checksums, merged profiles ------------------------
SQL["report_ingest"] = """SELECT CAST(l_orderkey AS VARCHAR) AS run_id,
    CASE WHEN l_suppkey % 3 = 0 THEN 'stg_account' ELSE 'unknown' END AS table_name,
    CASE WHEN l_suppkey % 3 = 0 THEN 'staging' ELSE 'marts' END AS layer, 'check_' || l_linenumber AS test_name,
    CAST(NULL AS VARCHAR) AS column_name, CASE WHEN l_suppkey % 2 = 0 THEN 'warn' ELSE 'error' END AS severity,
    CAST(l_linenumber AS BIGINT) AS violations,
    CASE l_linenumber WHEN 2 THEN 'fail' WHEN 3 THEN 'warn' WHEN 4 THEN 'skip' WHEN 5 THEN 'error' ELSE 'pass' END AS status,
    CASE WHEN l_linenumber IN (2, 3, 5) THEN 'part ' || l_partkey END AS message, CAST(NULL AS VARCHAR) AS malformed
  FROM lineitem WHERE l_orderkey % 97 <> 5
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    CASE l_linenumber % 3 WHEN 0 THEN '{"unique_id":"test.bank.odd","config":"' || l_suppkey || '"}' ELSE 'null' END
  FROM lineitem WHERE l_orderkey % 97 <> 5 AND l_linenumber % 3 < 2
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    '{"metadata": {"run_id": "' || l_orderkey || '"}, "results": [{'
  FROM lineitem WHERE l_orderkey % 97 = 5"""
SUMMARY_COLUMNS = ("account_id", "customer_id", "original_balance_amount", "interest_rate_pct", "annual_interest_amount",
                   "new_balance_amount", "calculated_at")
_ROW_TEXT = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in SUMMARY_COLUMNS)
SQL["export_checksum"] = with_base(f"""SELECT o.output, t.* FROM (SELECT count(*) AS checksum_rows,
    CAST(sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS VARCHAR) AS checksum_1,
    CAST(sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS VARCHAR) AS checksum_2
  FROM (SELECT md5({_ROW_TEXT}) AS h FROM summ) x) t, (VALUES ('csv'), ('parquet')) o(output)""")
SQL["profile_sketch_merge"] = " UNION ALL ".join(
    f"""SELECT year(l_shipdate) AS year, '{c}' AS column_name, count(DISTINCT date_trunc('month', l_shipdate)) AS runs,
    count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, CAST(min({c}) AS DOUBLE) AS least,
    CAST(max({c}) AS DOUBLE) AS greatest, true AS distinct_within, true AS median_within FROM lineitem GROUP BY 1"""
    for c in ("l_partkey", "l_quantity", "l_extendedprice"))
