"""Session construction and the runtime settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results or plans.  UTC keeps timestamps identical to
# the parquet values; AQE re-plans joins from runtime sizes (broadcast only
# when the measured side is under the threshold), splits skewed shuffle
# partitions, and coalesces small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Generated methods above HotSpot's 8000-bytecode JIT limit are never
    # compiled and run in the bytecode interpreter; fall back to per-operator
    # code before reaching that size.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def get_spark(master: str | None = None, app: str = "strata",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  On a cluster pass ``master=None`` and let
    spark-submit decide; ``shuffle_partitions`` defaults to Spark's own value
    and AQE coalesces it at runtime."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


_LOCAL_CKPT: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, read
    from the session (runtime conf, then the launch conf).

    Only a local master may leave it unset (tests, ad-hoc runs): there driver
    and executors are one process, and one scratch folder per process is
    used.  On a cluster an unset folder is an error, since executors would
    each write to their own disk.  ``SparkContext.getCheckpointDir()`` is
    *not* this folder - Spark appends a per-application subfolder to it - so
    it is never fed back.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL_CKPT:
            _LOCAL_CKPT.append(tempfile.mkdtemp(prefix="strata-ckpt-"))
        current = _LOCAL_CKPT[0]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def materialize(df):
    """Cut lineage by writing ``df`` as Parquet into the shared checkpoint
    folder and reading it back (never ``localCheckpoint``).  One job computes
    the frame once; the files survive executor loss, and every consumer of the
    result scans them instead of re-running the plan.  (An eager
    ``Dataset.checkpoint()`` would compute the plan twice: once to count,
    once to write.)"""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/materialized/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    # The schema is known: no job that reads footers to infer it.
    return spark.read.schema(df.schema).parquet(path)


def overwrite_partitions(df, table: str) -> None:
    """Replace those partitions of a catalog table that ``df`` has rows for.
    (``insertInto`` takes the overwrite mode from the session only.)"""
    conf, key = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)
