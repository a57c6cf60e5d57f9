"""Profiles that are kept per run and merged over runs (SRC-7, AGG-7, QRY-8).

Row and null counts, least and greatest values add up exactly.  Distinct
counts and quantiles do not, so a run keeps sketches of them: HyperLogLog
(relative standard error 1.04 / sqrt(2**LG_K), 0.8 % at 14) and KLL (rank
error 1.3 % at 200).  A profile over many runs, or over a slice of them, is a
merge of a few kilobytes a run and column; no history is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
KLL_K = 200
# Bounds that merged results keep: four standard errors; rank error at 99 %.
DISTINCT_ERROR = 4 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.02


def run_profile(df: DataFrame, run: str, columns: Sequence[str]) -> DataFrame:
    """One row per run and numeric column, in one pass: ``run``,
    ``column_name``, ``rows``, ``nulls``, ``least``, ``greatest``,
    ``distinct_sketch``, ``quantile_sketch``.  The rows of a run are reduced
    in their tasks first, so a run with most of the rows costs no more."""
    def of(c: str) -> Column:
        v = F.col(f"`{c}`").cast("double")
        return F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), F.count_if(v.isNull()).alias("nulls"),
            F.min(v).alias("least"), F.max(v).alias("greatest"),
            F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LG_K).alias("distinct_sketch"),
            F.kll_sketch_agg_double(v, KLL_K).alias("quantile_sketch"))
    each = df.groupBy(F.col(run).alias("run")).agg(F.array(*[of(c) for c in columns]).alias("p"))
    return each.select("run", F.inline("p"))


def merge(profiles: DataFrame, by: Sequence[str] = ("column_name",)) -> DataFrame:
    """Profiles of several runs as one per group, in the same columns."""
    return profiles.groupBy(*by).agg(
        F.count_distinct("run").alias("runs"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def estimates(merged: DataFrame, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``distinct_estimate`` and ``quantile_estimates`` (null without values)
    in place of the sketches."""
    some = F.col("rows") > F.col("nulls")
    got = F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*[F.lit(float(r)) for r in ranks])))
    return (merged.withColumn("distinct_estimate", F.hll_sketch_estimate("distinct_sketch"))
            .withColumn("quantile_estimates", got).drop("distinct_sketch", "quantile_sketch"))
