"""Keyed tables in buckets, of which a merge rewrites only those it touches
(INC-3, INC-7).

A keyed table is a Parquet catalog table partitioned by a hash of its key.
A merge reads the partitions that its batch falls into (a partition filter of
bucket numbers, at most as many as there are buckets), writes the merged rows
to the shared checkpoint folder, and overwrites those partitions; the files of
all others stay.  Repeating a merge after a failure gives the same table, as
rows are replaced by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.incremental import check_schema, upsert
from strata.operators.scd2 import require_unique
from strata.session import materialize, overwrite_partitions

BUCKET = "key_bucket"


@dataclass
class KeyedTable:
    spark: SparkSession
    name: str
    keys: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def create(self, df: DataFrame, path: str | None = None) -> None:
        """First load.  Rows are dealt by bucket, so each bucket is one file
        per task at most; with ``path`` the table's files live there."""
        w = df.withColumn(BUCKET, self.bucket()).repartition(BUCKET).write.partitionBy(BUCKET).format("parquet").mode("errorifexists")
        (w.option("path", path) if path else w).saveAsTable(self.name)

    def touched(self, keys_df: DataFrame) -> list[int]:
        """Bucket numbers of some keys (at most ``buckets`` numbers)."""
        return sorted(r[0] for r in keys_df.select(self.bucket()).distinct().collect())

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table, or some buckets of it."""
        df = self.spark.table(self.name)
        return (df if buckets is None else df.filter(F.col(BUCKET).isin(list(buckets)))).drop(BUCKET)

    def read_keys(self, keys_df: DataFrame) -> DataFrame:
        """Rows of some keys; only their buckets are scanned."""
        return self.read(self.touched(keys_df)).join(keys_df.select(*self.keys).distinct(), list(self.keys), "left_semi")

    def merge(self, batch: DataFrame, deleted_keys: DataFrame | None = None) -> list[int]:
        """Upsert ``batch`` (one row per key) and remove ``deleted_keys``;
        returns the buckets that were rewritten."""
        check_schema(self.read().schema, batch.schema)
        require_unique(batch, self.keys, f"batch for {self.name}")
        keys_df = batch.select(*self.keys)
        if deleted_keys is not None:
            keys_df = keys_df.unionByName(deleted_keys.select(*self.keys))
        touched = self.touched(keys_df)
        if not touched:
            return []
        columns = self.spark.table(self.name).columns
        merged = upsert(self.read(touched), batch, self.keys, deleted_keys)
        merged = materialize(merged.withColumn(BUCKET, self.bucket()).select(*columns).repartition(BUCKET))
        overwrite_partitions(merged, self.name)
        # A bucket that lost all its rows has nothing to be overwritten with.
        left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
        for b in sorted(set(touched) - left):
            empty = self.spark.createDataFrame([], self.read().schema)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({BUCKET}={b})")
            path = self.location()
            empty.write.mode("overwrite").parquet(f"{path}/{BUCKET}={b}")
        return touched

    def location(self) -> str:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").filter("col_name = 'Location'").collect()
        return rows[0]["data_type"]
