"""Quality report over suite results (REP-1..8).

The report is an aggregate of the results frame: one ``GROUPING SETS``
aggregate gives the overall summary, the per-layer and the per-severity
breakdown in a single pass.  The gate is one more aggregate reduced to a
single verdict row.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import materialize

# Layer by table-name prefix.
LAYER_PREFIXES = (("src_", "source"), ("stg_", "staging"), ("snap_", "snapshot"), ("int_", "intermediate"))
DEFAULT_LAYER = "marts"

RESULT_SCHEMA = ("run_id string, table_name string, layer string, test_name string, column_name string, "
                 "severity string, violations long, status string, message string")


def layer_of(table: Column) -> Column:
    """REP-2: layer from the table-name prefix; anything else is marts.  The
    table is the real model name of the check (SEM-15)."""
    expr = None
    for prefix, layer in LAYER_PREFIXES:
        cond = table.startswith(prefix)
        expr = F.when(cond, F.lit(layer)) if expr is None else expr.when(cond, F.lit(layer))
    return expr.otherwise(F.lit(DEFAULT_LAYER))


def from_json(spark: SparkSession, path: str) -> DataFrame:
    """REP-1: results written as JSON lines by a previous run."""
    return spark.read.schema(RESULT_SCHEMA).json(path)


# A run's result document: one JSON object per line, or per file.  Results are
# read as text first, so that one odd entry does not spoil its neighbours.
DOCUMENT_SCHEMA = "metadata struct<run_id string>, results array<string>, malformed string"
ENTRY_SCHEMA = ("unique_id string, status string, message string, failures long, column_name string, table_name string, "
                "config struct<severity string>, malformed string")
# Statuses under another name, the prefix of test nodes, defaults.
STATUS_NAMES = {"success": "pass", "skipped": "skip"}
TEST_PREFIX = "test."
DEFAULT_SEVERITY, UNKNOWN = "error", "unknown"
EXPLAINED = ("fail", "error", "warn")


def ingest(spark: SparkSession, path: str, one_per_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """REP-1: nested result documents of another runner, as results in
    ``RESULT_SCHEMA`` and what could not be read (``run_id``, ``malformed``).

    Only test nodes count.  The test's name is the last part of its id; the
    table is the one the entry names (``unknown`` without one), the severity
    is ``error`` unless configured, and a message is kept only when the test
    did not pass.  A document that is not JSON, an entry that is not an object
    of the declared shape, and a null entry are kept aside as they stand (of a
    document without its run, which is unknown); an entry without id is no test.  A missing path raises ``FileNotFoundError``; an
    empty file has no results.  Row-local: documents are read in parallel and
    nothing is shuffled."""
    try:
        docs = (spark.read.schema(DOCUMENT_SCHEMA).option("mode", "PERMISSIVE").option("multiLine", one_per_file)
                .option("columnNameOfCorruptRecord", "malformed").json(path))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        raise FileNotFoundError(path) from e
    docs = docs.select(F.col("metadata.run_id").alias("run_id"), "results", "malformed")
    entries = docs.filter(F.col("malformed").isNull()).select("run_id", F.explode("results").alias("text"))
    # JSON is parsed once, for the results and for what is kept aside.
    parsed = materialize(entries.select("run_id", "text", F.from_json(
        "text", ENTRY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}).alias("e"))
        .unionByName(docs.filter(F.col("malformed").isNotNull()).select("run_id", F.col("malformed").alias("text")),
                     allowMissingColumns=True))
    odd = F.col("e").isNull() | F.col("e.malformed").isNotNull()
    tests = parsed.filter(~odd & F.coalesce(F.col("e.unique_id").startswith(TEST_PREFIX), F.lit(False)))
    status = F.coalesce(F.col("e.status"), F.lit(UNKNOWN))
    for theirs, ours in STATUS_NAMES.items():
        status = F.when(F.col("e.status") == theirs, F.lit(ours)).otherwise(status)
    results = tests.select(
        "run_id", F.coalesce("e.table_name", F.lit(UNKNOWN)).alias("table_name"), layer_of(F.coalesce("e.table_name", F.lit(UNKNOWN))).alias("layer"),
        F.element_at(F.split("e.unique_id", r"\."), -1).alias("test_name"), F.col("e.column_name").alias("column_name"),
        F.coalesce("e.config.severity", F.lit(DEFAULT_SEVERITY)).alias("severity"), F.col("e.failures").alias("violations"),
        status.alias("status"), F.when(status.isin(*EXPLAINED), F.col("e.message")).alias("message"))
    return results, parsed.filter(odd).select("run_id", F.coalesce("text", F.lit("null")).alias("malformed"))


def _measures() -> list[Column]:
    s = F.col("status")
    total = F.count(F.lit(1))
    passed = F.count_if(s == "pass")
    return [total.alias("total"), passed.alias("passed"),
            F.count_if(s == "fail").alias("failed"), F.count_if(s == "warn").alias("warned"),
            F.count_if(s == "skip").alias("skipped"), F.count_if(s == "error").alias("errored"),
            F.coalesce(F.round(passed * 100.0 / F.nullif(total, F.lit(0)), 2), F.lit(0.0))
            .cast("decimal(5,2)").alias("pass_rate")]


def summary(results: DataFrame) -> DataFrame:
    """REP-3..5 in one pass: rows with ``grouping_level`` = overall | layer |
    severity and the group value in ``group_value``."""
    g = results.groupingSets([[], ["layer"], ["severity"]], "layer", "severity").agg(
        *_measures(), F.grouping_id().alias("_gid"))
    return g.select(
        F.when(F.col("_gid") == 3, F.lit("overall")).when(F.col("_gid") == 1, F.lit("layer"))
        .otherwise(F.lit("severity")).alias("grouping_level"),
        F.coalesce(F.col("layer"), F.col("severity"), F.lit("all")).alias("group_value"),
        "total", "passed", "failed", "warned", "skipped", "errored", "pass_rate")


def overall(results: DataFrame) -> DataFrame:
    """REP-3 / REP-7: the overall summary; an empty results frame gives the
    all-zero placeholder row."""
    return results.agg(*_measures())


def issues(results: DataFrame) -> DataFrame:
    """REP-6: failures, warnings and errors."""
    return results.filter(F.col("status").isin("fail", "warn", "error"))


def gate(results: DataFrame) -> DataFrame:
    """REP-8: one verdict row.  Any fail/error -> not passed (error); only
    warnings -> passed (warn); no tests -> passed."""
    s = F.col("status")
    a = results.agg(F.count(F.lit(1)).alias("tests"),
                    F.count_if(s.isin("fail", "error")).alias("failing"),
                    F.count_if(s == "warn").alias("warning"))
    return a.select(
        "tests", "failing", "warning",
        (F.col("failing") == 0).alias("passed"),
        F.when(F.col("failing") > 0, F.lit("error")).when(F.col("warning") > 0, F.lit("warn"))
        .otherwise(F.lit("ok")).alias("level"))


def gate_from_path(spark: SparkSession, path: str) -> dict:
    """REP-8 including its last branch: results that cannot be found give
    ``passed = False`` at level ``warn``."""
    try:
        results = from_json(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return {"tests": 0, "failing": 0, "warning": 0, "passed": False, "level": "warn"}
    return gate(results).first().asDict()
