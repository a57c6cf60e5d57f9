"""The corpus pipeline: a few training-data operators in a row.

Each stage reads what its predecessor kept (Parquet in the folder named by
``spark.checkpoint.dir``) and its decisions take effect; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe_chunks, decontamination, jaccard_join, pseudonyms, toxicity
from strata.llm.common import table
from strata.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    name = "toxicity_" + uuid.uuid4().hex
    return toxicity.score(docs, model, name).filter(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by ``benchmark``."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms for personal numbers, dates, addresses and secrets."""
    name = "found_" + uuid.uuid4().hex
    rows = pseudonyms.pseudonymize(docs, found=name).drop(name)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the texts that are left."""
    return bpe_chunks.report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("bpe", token_ids),
]

# A trained model and a tokenizer are not SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and
    read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}_{name}")
            docs = spark.read.parquet(f"{folder}/{i}_{name}")
    return docs
