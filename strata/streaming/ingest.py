"""Structured Streaming forms of ingestion and keyed maintenance (STR-1..3).

* :func:`stream_ingest`, :func:`stream_csv` - new files in a landing folder
  instead of a daily full read (file source, explicit schema); malformed lines
  and header drift are noticed.
* :func:`latest_state` - the latest row per key in Spark's own state store; in
  update mode a batch emits the keys it changed and nothing else.
* Sinks are ``foreachBatch`` handlers that write one partition per micro-batch,
  overwriting it if the batch is replayed (exactly-once output): what a batch
  writes follows the batch, not the table.
* :func:`with_lateness` - the late-data tolerance as an event-time watermark
  with bounded state; :class:`LateSplitSink` keeps what comes later still for a
  backfill.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_dir

CORRUPT = "malformed_record"
BATCH = "batch_id"


def stream_ingest(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv",
                  max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """STR-1: streaming read of a landing folder."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def with_lateness(df: DataFrame, ts: str, delay: str = "3 days", keys: Sequence[str] | None = None) -> DataFrame:
    """STR-3: accept rows up to ``delay`` behind the latest event time seen;
    with ``keys``, drop repeats of a key within that window (state is
    evicted once the watermark passes)."""
    out = df.withWatermark(ts, delay)
    if keys:
        out = out.dropDuplicatesWithinWatermark(list(keys))
    return out


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order`` (``max_by``: partial aggregate)."""
    packed = F.struct(*[F.col(c) for c in values])
    picked = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*[F.col(c) for c in order])).alias("_s"))
    return picked.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in values])


def latest_state(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Streaming form of :func:`latest_by_key`: a stateful aggregate."""
    return latest_by_key(df, keys, order, list(dict.fromkeys([*values, *order])))


def stream_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """STR-1 with quarantine: lines that do not fit the schema keep their text
    in ``malformed_record``; a file whose header differs from the schema fails
    the batch, which goes on when the file is removed."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return stream_ingest(spark, path, schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False,
                         ignoreMissingFiles=True, **options)


@dataclass
class BatchTable:
    """A Parquet folder with one partition per micro-batch."""
    spark: SparkSession
    path: str
    schema: T.StructType | None = None

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch; a replay overwrites it."""
        self.schema = rows.schema
        rows.write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def read(self) -> DataFrame:
        if self.schema is None:
            return self.spark.read.parquet(self.path)
        return self.spark.read.schema(self.schema.add(BATCH, "long") if BATCH not in self.schema.names else self.schema).parquet(self.path)


@dataclass
class ChangeSink:
    """STR-2: the changed keys of every batch."""
    spark: SparkSession
    path: str
    keys: Sequence[str]
    order: Sequence[str]
    stream: str
    table: BatchTable = field(init=False)

    def __post_init__(self) -> None:
        self.table = BatchTable(self.spark, self.path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.put(batch, batch_id)

    def changes(self) -> DataFrame:
        return self.table.read()

    def current(self) -> DataFrame:
        """The latest row per key over all batches."""
        rows = self.changes().drop(BATCH)
        return latest_by_key(rows, self.keys, self.order, [c for c in rows.columns if c not in self.keys])


@dataclass
class QuarantineSink:
    """STR-1: a batch split into valid rows and malformed lines in one pass
    over its files."""
    spark: SparkSession
    root: str
    stream: str

    def __post_init__(self) -> None:
        self.good, self.bad = BatchTable(self.spark, f"{self.root}/valid"), BatchTable(self.spark, f"{self.root}/malformed")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self.good.put(batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), batch_id)
            self.bad.put(batch.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT), batch_id)
        finally:
            batch.unpersist()

    def valid(self) -> DataFrame:
        return self.good.read()

    def malformed(self) -> DataFrame:
        return self.bad.read()


@dataclass
class LateSplitSink:
    """STR-3: rows more than ``days`` behind the latest event time of earlier
    batches go to a table of their own, where a backfill
    (:func:`strata.operators.incremental.backfill`) finds them; none is
    dropped.  Each batch records its latest time, so a replayed batch is split
    the same way."""
    spark: SparkSession
    root: str
    ts: str
    days: int
    stream: str

    def __post_init__(self) -> None:
        self.good, self.old, self.marks = (BatchTable(self.spark, f"{self.root}/{x}") for x in ("on_time", "late_rows", "marks"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        mark = None
        if batch_id:
            mark = self.marks.read().filter(F.col(BATCH) < batch_id).agg(F.max("latest")).first()[0]
        late = F.lit(False) if mark is None else F.coalesce(F.col(self.ts) < F.lit(mark) - F.make_interval(days=F.lit(self.days)), F.lit(False))
        batch = batch.persist()
        try:
            self.good.put(batch.filter(~late), batch_id)
            self.old.put(batch.filter(late), batch_id)
            self.marks.put(batch.agg(F.max(self.ts).alias("latest")), batch_id)
        finally:
            batch.unpersist()

    def on_time(self) -> DataFrame:
        return self.good.read()

    def late(self) -> DataFrame:
        return self.old.read()


def run_available(df: DataFrame, handler: Callable[[DataFrame, int], None], name: str | None = None,
                  checkpoint: str | None = None, mode: str = "append") -> None:
    """Process everything available now, then stop (``availableNow``).  The
    next call with the same ``name`` (by default the sink's stream) goes on
    where this one stopped: the checkpoint is a fixed folder under the
    cluster's shared checkpoint folder."""
    name = name or getattr(handler, "stream", None)
    if not (name or checkpoint):
        raise ValueError("a stream needs a name or a checkpoint folder of its own")
    ckpt = checkpoint or f"{checkpoint_dir(df.sparkSession)}/streams/{name}"
    q = (df.writeStream.foreachBatch(handler).outputMode(mode).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
