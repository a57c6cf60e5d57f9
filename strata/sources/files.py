"""File sources: schema-checked CSV ingestion and Parquet scans (SRC-1..7, 9, 10).

Raw CSV is read as text (no type inference, SEM-12): bad values must reach
validation and quarantine instead of failing the read.  Empty fields become
NULL, null tokens such as 'N/A' are kept as text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw file column sets.
CUSTOMER_COLUMNS = ("CustomerID", "Name", "HasLoan")
ACCOUNT_COLUMNS = ("AccountID", "CustomerID", "Balance", "AccountType")


class SchemaDriftError(ValueError):
    """Raw columns differ from the expected set (SRC-4)."""


class EmptyInputError(ValueError):
    """The raw file has no data rows (SRC-5)."""


class MissingColumnsError(ValueError):
    """Required columns are absent (SRC-5)."""


def detect_schema_changes(actual: Iterable[str], expected: Iterable[str], path: str = "") -> None:
    """SRC-4: one error naming both the missing and the extra columns, sorted."""
    a, e = set(actual), set(expected)
    missing, extra = sorted(e - a), sorted(a - e)
    if missing or extra:
        parts = []
        if missing:
            parts.append(f"missing columns: {', '.join(missing)}")
        if extra:
            parts.append(f"unexpected columns: {', '.join(extra)}")
        raise SchemaDriftError(f"schema drift in {path or 'input'}: " + "; ".join(parts))


def validate_csv_data(df: DataFrame, path: str, required: Sequence[str]) -> None:
    """SRC-5: reject a file without rows or without the required columns.
    ``isEmpty`` reads at most one row."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{path}: missing required columns {missing}")
    if df.isEmpty():
        raise EmptyInputError(f"{path}: no data rows")


# Raw text of a record that does not have the header's number of fields.
MALFORMED = "malformed_record"


def read_raw_csv(spark: SparkSession, path: str, expected: Sequence[str], strict: bool = True) -> DataFrame:
    """SRC-1/2/3/6: header CSV files as all-string columns, header names
    stripped, column set checked.  A missing path raises ``FileNotFoundError``.

    Every file of a folder must have the first file's header (Spark compares
    each one and fails the read if not).  A record with more or fewer fields
    keeps its text in ``malformed_record`` and goes to quarantine."""
    try:
        seen = spark.read.option("header", True).csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    names = [c.strip() for c in seen]
    if strict:
        detect_schema_changes(names, expected, path)
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in seen), T.StructField(MALFORMED, T.StringType())])
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED).csv(path))
    df = df.toDF(*names, MALFORMED)
    validate_csv_data(df, path, expected)
    return df.select(*[F.col(f"`{c}`") for c in expected], MALFORMED)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1."""
    return read_raw_csv(spark, path, CUSTOMER_COLUMNS)


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2."""
    return read_raw_csv(spark, path, ACCOUNT_COLUMNS)


def ingest_profile(df: DataFrame, numeric: str | None = None) -> DataFrame:
    """SRC-7: row count, NULL count per column and, for ``numeric``, the
    count of negative values after lenient coercion (bad text -> NULL).
    One aggregate; nothing but the one-row result leaves the executors."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    if numeric:
        v = F.col(numeric).try_cast("double")
        aggs.append(F.count_if(v < 0).alias(f"negative_{numeric}"))
        aggs.append(F.count_if(v.isNull() & F.col(numeric).isNotNull()).alias(f"unparseable_{numeric}"))
    return df.agg(*aggs)


def observed(df: DataFrame, name: str, numeric: str | None = None) -> tuple[DataFrame, Observation]:
    """SRC-7 without a second scan: the profile metrics ride along with the
    next action on ``df`` (usually its write) via ``Observation``."""
    obs = Observation(name)
    metrics: list[Column] = [F.count(F.lit(1)).alias("row_count")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    if numeric:
        metrics.append(F.count_if(F.col(numeric).try_cast("double") < 0).alias(f"negative_{numeric}"))
    return df.observe(obs, *metrics), obs


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-9: Parquet scan; a missing path raises ``FileNotFoundError``."""
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise


def load_csv_to_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """SRC-10: CSV straight into a catalog table with sniffed types."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    df.write.mode("overwrite").saveAsTable(table)
    return spark.table(table)
