"""Catalog-side sources (SRC-8, SRC-11, SRC-12) and layer naming (SNK-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Layer -> schema suffix.
LAYER_SCHEMAS = {"raw": "raw", "source": "source", "staging": "staging", "snapshots": "snapshots",
                 "intermediate": "intermediate", "marts": "marts"}


def layer_table_name(layer: str, name: str, prefix: str | None = None) -> str:
    """SNK-8: ``raw.<name>`` for raw tables, ``<prefix>_<layer>.<name>`` for
    modelled layers (plain ``<layer>.<name>`` without a prefix)."""
    if layer not in LAYER_SCHEMAS:
        raise ValueError(f"unknown layer {layer!r}")
    if layer == "raw" or not prefix:
        return f"{LAYER_SCHEMAS[layer]}.{name}"
    return f"{prefix}_{LAYER_SCHEMAS[layer]}.{name}"


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-8: ``SELECT *`` from a catalog table (lazy; pruning applies)."""
    return spark.table(name)


def execute_query(spark: SparkSession, sql: str) -> DataFrame:
    """SRC-11: ad-hoc SQL over registered tables/views, as a DataFrame."""
    return spark.sql(sql)


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC-12: decides first run vs incremental run."""
    return spark.catalog.tableExists(name)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose layer frames to SQL (for SRC-11 style access)."""
    for n, df in frames.items():
        df.createOrReplaceTempView(n)
