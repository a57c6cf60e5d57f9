"""Sinks: CSV / Parquet / table / JSON writers and post-write checks
(SNK-1..7, SNK-9).

All writes are distributed (one file per task); nothing is converted to
pandas.  Row counts and checksums for the post-write check come from an
``Observation`` attached to the write itself, so validation does not scan the
source twice, and outputs are compared by checksum, not row by row.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import checksum as CK

ALLOWED_MODES = ("overwrite", "append")
# Text is written and read as it is, blanks at its ends included; times keep
# their microseconds.
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
               "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}


class WriteValidationError(RuntimeError):
    """A written output failed its post-write check (SNK-7)."""


@dataclass
class WriteReport:
    path: str
    format: str
    rows_written: int
    rows_read_back: int | None
    columns: int
    checksum: tuple | None = None
    checksum_read_back: tuple | None = None

    @property
    def ok(self) -> bool:
        return ((self.rows_read_back is None or self.rows_read_back == self.rows_written)
                and (self.checksum_read_back is None or self.checksum_read_back == self.checksum))


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _summed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *CK.measures(df.columns)), obs


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", verify: bool = True) -> WriteReport:
    """SNK-1: header, UTF-8, one directory of part files."""
    _check_mode(mode)
    out, obs = _summed(df, f"csv:{path}")
    out.write.mode(mode).options(**CSV_OPTIONS).option("encoding", "UTF-8").csv(path)
    return _validate(df.sparkSession, path, "csv", obs, df.schema, verify and mode == "overwrite")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", verify: bool = True,
                  partition_by: list[str] | None = None) -> WriteReport:
    """SNK-2: Snappy Parquet."""
    _check_mode(mode)
    out, obs = _summed(df, f"parquet:{path}")
    w = out.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return _validate(df.sparkSession, path, "parquet", obs, df.schema, verify and mode == "overwrite")


def write_table(df: DataFrame, table: str, mode: str = "overwrite") -> WriteReport:
    """SNK-3/4/5: full-refresh or append load into a catalog table, then a
    count comparison (a mismatch raises)."""
    _check_mode(mode)
    out, obs = _counted(df, f"table:{table}")
    out.write.mode(mode).saveAsTable(table)
    written = obs.get["rows"]
    back = df.sparkSession.table(table).count() if mode == "overwrite" else None
    rep = WriteReport(table, "table", written, back, len(df.columns))
    if not rep.ok:
        raise WriteValidationError(f"{table}: wrote {written} rows, table holds {back}")
    return rep


def write_split(tagged: DataFrame, path: str, flag: str = "failure_reason", mode: str = "overwrite") -> None:
    """Write valid and quarantined rows in ONE pass: a ``_route``
    partition column (``valid`` / ``quarantine``) instead of two jobs over
    the same input."""
    _check_mode(mode)
    routed = tagged.withColumn("_route", F.when(F.col(flag).isNull(), F.lit("valid")).otherwise(F.lit("quarantine")))
    routed.write.mode(mode).partitionBy("_route").parquet(path)


def save_report(df: DataFrame, root: str, run_id: str, run_ts: dt.datetime) -> str:
    """SNK-6: JSON report rows under ``run_id=<id>``, stamped with the run's
    time (see :func:`latest_report`)."""
    out = f"{root}/run_id={run_id}"
    df.withColumn("run_ts", F.lit(run_ts.isoformat())).coalesce(1).write.mode("overwrite").json(out)
    return out


def latest_report(spark: SparkSession, root: str, schema: T.StructType | str | None = None) -> DataFrame:
    """SNK-6: the report of the run with the latest time."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.json(root)
    top = df.agg(F.max_by("run_id", F.struct("run_ts", "run_id")).alias("m")).first()["m"]
    return df.filter(F.col("run_id") == F.lit(top))


def _check_mode(mode: str) -> None:
    if mode not in ALLOWED_MODES:
        raise ValueError(f"write mode {mode!r} not supported; use one of {ALLOWED_MODES}")


def _validate(spark: SparkSession, path: str, fmt: str, obs: Observation, schema: T.StructType,
              verify: bool) -> WriteReport:
    """SNK-7: the files, read once (optional on very large exports), hold the
    rows that the write saw: as many, and with the same checksum.  An append
    joins rows that this write did not see and is not compared."""
    def parts(r) -> tuple:
        return r[CK.ROWS], r[CK.FIRST], r[CK.SECOND]

    seen, back = parts(obs.get), None
    if verify:
        reader = spark.read.schema(schema)
        back_df = reader.options(**CSV_OPTIONS).csv(path) if fmt == "csv" else reader.parquet(path)
        back = parts(CK.checksum(back_df.select(*[F.col(f"`{c}`") for c in schema.names])).first())
    rep = WriteReport(path, fmt, seen[0], back and back[0], len(schema.fields), seen, back)
    if not rep.ok:
        raise WriteValidationError(f"{path}: wrote {seen[0]} rows with checksum {seen[1:]}, read back {back[0]} with {back[1:]}")
    return rep


def same_output(a: WriteReport, b: WriteReport) -> bool:
    """SNK-9: do two validated outputs hold the same rows (same columns, same
    order of columns), equally often?  Nothing is read."""
    return a.checksum == b.checksum


def compare_outputs(a: DataFrame, b: DataFrame) -> DataFrame:
    """SNK-9: rows present in one output and not the other (both ways, with
    multiplicity), after casting ``b`` to ``a``'s schema.  Empty = same."""
    b = b.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in a.schema.fields])
    return (a.exceptAll(b).withColumn("side", F.lit("only_first"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("only_second"))))


def compare_outputs_by_key(a: DataFrame, b: DataFrame, keys: list[str], tol: str = "0.01") -> DataFrame:
    """SNK-9 with the tolerance: rows missing on either side, or whose
    numeric columns differ by ``tol`` or more, or whose other columns differ
    (NULL-safe).  One full outer join on the key."""
    from decimal import Decimal
    numeric = (T.NumericType,)
    cols = [f for f in a.schema.fields if f.name not in keys]
    j = a.alias("a").join(b.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    bad = F.col(f"a.{keys[0]}").isNull() | F.col(f"b.{keys[0]}").isNull()
    for f in cols:
        x, y = F.col(f"a.{f.name}"), F.col(f"b.{f.name}").cast(f.dataType)
        if isinstance(f.dataType, numeric):
            diff = F.coalesce(F.abs(x - y) >= F.lit(Decimal(tol)), ~(x.isNull() & y.isNull()))
        else:
            diff = ~x.eqNullSafe(y)
        bad = bad | diff
    return j.filter(bad).select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys])
