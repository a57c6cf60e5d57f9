"""Tables in runs: write, audit, publish (INC-7, CON-2, SCD-9).

Every table of a warehouse is a Parquet catalog table partitioned by the
attempt of a run that wrote the rows.  A run stages its rows into partitions
of its own; nobody sees them, because readers take the partitions of complete
runs only: those named in the small table ``runs``, to which a run appends one
row when all its tables are staged and audited.  So a run becomes visible in
all tables at once, and a failed run leaves everything as it was; its
repetition is another attempt, so nothing the first one left behind counts.
A complete run is a no-op; a run time that does not grow is refused, as is a
run beside which another one completed.

A history (SCD2) has one more partition column: its open versions are those of
the last complete run, its closed ones those that each complete run closed.

Audits cost no pass of their own: null counts come from an ``Observation`` on
the staging write; unique keys take one aggregate over the staged rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as DQ
from strata.operators.contracts import Contract, ContractError
from strata.operators.incremental import check_schema
from strata.operators.scd2 import SCD_ID, VFROM, VTO, archive_split
from strata.session import overwrite_partitions

RUN = "run_attempt"
OPEN = "is_open"
RUNS_SCHEMA = f"run_id string, {RUN} string, run_ts timestamp, counts map<string,bigint>"


class StaleRunError(ValueError):
    """A new run must be later than the last complete one."""


@dataclass
class Warehouse:
    """The tables under ``root`` as complete runs left them, and those the
    current run has staged."""
    spark: SparkSession
    root: str
    run_id: str | None = None
    run_ts: dt.datetime | None = None
    counts: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.db = "runs_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{self.root}'")
        self.seen: str | None = None
        self.attempt: str | None = None
        self._lasts: dict[str, tuple[str, str]] | None = None
        if not self._known("runs"):
            self._attach("runs")

    # --- runs

    def table(self, name: str) -> str:
        return f"{self.db}.{name}"

    def _known(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def _attach(self, name: str) -> None:
        """Register a table's files in a catalog that forgot them (a session
        without a metastore); nothing happens if there are none."""
        conf, key = self.spark.conf, "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = conf.get(key)
        conf.set(key, "false")
        try:
            self.spark.read.parquet(f"{self.root}/{name}")
            self.spark.catalog.createTable(self.table(name), path=f"{self.root}/{name}", source="parquet")
            if name != "runs":
                self.spark.catalog.recoverPartitions(self.table(name))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        finally:
            conf.set(key, before)

    def runs(self) -> DataFrame:
        """Complete runs: one row per run."""
        return self.spark.table(self.table("runs")) if self._known("runs") else self.spark.createDataFrame([], RUNS_SCHEMA)

    def last(self, name: str | None = None) -> str | None:
        """The last complete run (that wrote table ``name``)."""
        return self._last(name)[0]

    def _last(self, name: str | None) -> tuple[str | None, str | None]:
        """That run and its attempt.  One aggregate over the runs finds them
        for all tables (two names per table)."""
        if self._lasts is None:
            runs = self.runs()
            each = runs.select("run_id", RUN, "run_ts", F.explode(F.array_union(F.map_keys("counts"), F.array(F.lit("")))).alias("t"))
            self._lasts = {r.t: (r.run["run_id"], r.run[RUN]) for r in each.groupBy("t").agg(F.max_by(F.struct("run_id", RUN), "run_ts").alias("run")).collect()}
        return self._lasts.get(name or "", (None, None))

    def completed(self, run_id: str) -> bool:
        return not self.runs().filter(F.col("run_id") == run_id).isEmpty()

    def begin(self, run_id: str, run_ts: dt.datetime) -> bool:
        """Start a run; False if it is complete already."""
        if self.completed(run_id):
            return False
        self._lasts = None
        latest = self.runs().agg(F.max("run_ts")).first()[0]
        if latest is not None and run_ts <= latest:
            raise StaleRunError(f"run {run_id} at {run_ts} is not later than the last one at {latest}")
        self.run_id, self.run_ts, self.counts, self.seen = run_id, run_ts, {}, self.last()
        self.attempt = f"{run_id}.{uuid.uuid4().hex[:12]}"
        return True

    def commit(self) -> None:
        """Make the run's tables visible, all at once: one appended row."""
        self._lasts = None
        if self.last() != self.seen:
            raise RuntimeError(f"another run completed while {self.run_id} was writing")
        row = self.spark.createDataFrame([(self.run_id, self.attempt, self.run_ts, self.counts)], RUNS_SCHEMA).coalesce(1)
        if self._known("runs"):
            row.write.insertInto(self.table("runs"))
        else:
            row.write.format("parquet").saveAsTable(self.table("runs"))
        self.run_id = self.run_ts = self.attempt = self._lasts = None

    # --- tables

    def exists(self, name: str) -> bool:
        """SRC-12: is there a complete run of the table?"""
        return self.last(name) is not None

    def staged(self, name: str) -> bool:
        return self.run_id is not None and name in self.counts

    def _part(self, name: str, attempt: str) -> DataFrame:
        return self._all(name).filter(F.col(RUN) == attempt).drop(RUN)

    def _all(self, name: str) -> DataFrame:
        if not self._known(name):
            self._attach(name)
        return self.spark.table(self.table(name))

    def read(self, name: str) -> DataFrame:
        """The rows the current run staged, or those of the last complete run
        of the table."""
        return self._part(name, self.attempt) if self.staged(name) else self.read_before(name)

    def read_before(self, name: str) -> DataFrame:
        """The rows of the last complete run of the table."""
        last = self._last(name)[1]
        if last is None:
            raise FileNotFoundError(f"table {name} has no complete run under {self.root}")
        return self._part(name, last)

    def stage(self, name: str, df: DataFrame, contract: Contract | None = None, measures: dict[str, Column] | None = None,
              more_partitions: Sequence[str] = (), unique: bool = True) -> DataFrame:
        """Write the run's rows of a table, checked against ``contract``:
        columns and types before the write, nulls by counts taken during it,
        unique keys over the written rows (unless the caller checks them).
        A violation raises before anything is visible."""
        if self.run_id is None:
            raise RuntimeError("no run was begun")
        if contract:
            contract.check_schema(df)
        measures = {"rows": F.count(F.lit(1))} | {f"null {c}": F.count_if(F.col(c).isNull()) for c in (contract.not_null if contract else ())} | (measures or {})
        seen = Observation()
        partitions = [RUN, *more_partitions]
        plain = [c for c in df.columns if c not in more_partitions]
        out = df.observe(seen, *[m.alias(k) for k, m in measures.items()]).select(*plain, F.lit(self.attempt).alias(RUN), *more_partitions)
        if not self._known(name):
            try:
                out.write.format("parquet").partitionBy(*partitions).saveAsTable(self.table(name))
            except PySparkException as e:
                if "LOCATION_ALREADY_EXISTS" not in str(e):
                    raise
                self._attach(name)
                return self.stage(name, df, contract, {k: v for k, v in measures.items() if k != "rows" and not k.startswith("null ")}, more_partitions, unique)
        else:
            held = self.spark.table(self.table(name))
            check_schema(held.schema, out.schema)
            overwrite_partitions(out.select(*held.columns), self.table(name))
        found = {k: int(v) for k, v in seen.get.items()}
        nulls = sorted(k[5:] for k, v in found.items() if k.startswith("null ") and v)
        if nulls:
            raise ContractError(f"{name}: NULLs in not-null columns {nulls}")
        self.counts |= {name: found["rows"]} | {f"{name}.{k}": v for k, v in found.items() if k in (measures or {}) and k != "rows" and not k.startswith("null ")}
        rows = self._part(name, self.attempt)
        if unique and contract and contract.unique and not DQ.unique(rows, list(contract.unique)).isEmpty():
            del self.counts[name]
            raise ContractError(f"{name}: duplicate values of {list(contract.unique)}")
        return rows

    def vacuum(self, name: str, keep: int = 2, only: str = "") -> None:
        """Drop the partitions (``only``: a further condition on them) of all
        but the table's last ``keep`` complete runs, and what attempts that
        never completed left behind."""
        complete = self.runs().filter(F.map_contains_key("counts", name)).orderBy(F.col("run_ts").desc()).select(RUN).collect()
        done = [r[0] for r in complete]
        there = {r[0].split("/")[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect()}
        for attempt in there - {*done, self.attempt}:
            self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS PARTITION ({RUN}='{attempt}')")
        for attempt in done[keep:]:
            self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS PARTITION ({RUN}='{attempt}'{only})")


@dataclass
class History:
    """SCD2 history in runs: open versions and, per run, the versions it
    closed."""
    tables: Warehouse
    name: str

    def _rows(self) -> DataFrame:
        return self.tables._all(self.name)

    def _run(self) -> str | None:
        return self.tables.attempt if self.tables.staged(self.name) else self.tables._last(self.name)[1]

    def open_versions(self) -> DataFrame | None:
        run = self._run()
        return None if run is None else self._rows().filter((F.col(RUN) == run) & F.col(OPEN)).drop(RUN, OPEN)

    def closed_versions(self) -> DataFrame | None:
        """All closed versions: of complete runs since the last one that wrote
        the whole history, and of the current run."""
        run = self._run()
        if run is None:
            return None
        own = self.tables.staged(self.name)
        runs = self.tables.runs().filter(F.map_contains_key("counts", self.name)).select(
            RUN, "run_ts", (F.element_at("counts", f"{self.name}.whole") > 0).alias("whole"))
        if own:
            whole = self.tables.counts[f"{self.name}.whole"] > 0
            runs = runs.unionByName(self.tables.spark.createDataFrame([(run, self.tables.run_ts, whole)], f"{RUN} string, run_ts timestamp, whole boolean"))
        since = runs.filter("whole").agg(F.max("run_ts")).first()[0]
        if since is not None:
            runs = runs.filter(F.col("run_ts") >= F.lit(since))
        return self._rows().filter(~F.col(OPEN)).join(runs.select(RUN), RUN, "left_semi").drop(RUN, OPEN)

    def read(self) -> DataFrame | None:
        o = self.open_versions()
        return None if o is None else self.closed_versions().unionByName(o)

    def stage(self, merged_open: DataFrame, contract: Contract | None = None, whole: bool = False) -> None:
        """Stage the result of merging the *open* versions with an extract.
        Closed versions of earlier runs are neither read nor written; with
        ``whole`` the rows are the entire history and earlier closed parts no
        longer count."""
        rows = merged_open.withColumn(OPEN, F.col(VTO).isNull())
        if contract:
            contract.check_schema(merged_open)
            contract = Contract(contract.name, rows.schema, contract.not_null, contract.unique)
        self.tables.stage(self.name, rows, contract, {"closed": F.count_if(~F.col(OPEN))}, [OPEN])
        self.tables.counts[f"{self.name}.whole"] = int(whole)

    def touched_keys(self, keys: list[str], run_ts: Column) -> DataFrame:
        """Keys whose versions the current run opened or closed; of the closed
        ones only the run's own part is read."""
        opened = self.open_versions().filter(F.col(VFROM) == run_ts).select(*keys)
        return opened.unionByName(self.closed_by_run().select(*keys)).distinct()

    def closed_by_run(self) -> DataFrame:
        """Versions the current (or else the last) run closed."""
        return self._rows().filter((F.col(RUN) == self._run()) & ~F.col(OPEN)).drop(RUN, OPEN)

    def archive(self, older_than: Column, archive_name: str) -> None:
        """SCD-10 in a run: closed versions that ended before ``older_than``
        are added to the table ``archive_name``, the history keeps the rest;
        both become visible together."""
        old, rest = archive_split(self.read(), older_than)
        if self.tables.exists(archive_name):
            held = self.tables.read_before(archive_name)
            old = held.unionByName(old.join(held.select(SCD_ID), SCD_ID, "left_anti").select(held.columns))
        self.tables.stage(archive_name, old)
        self.stage(rest, whole=True)
