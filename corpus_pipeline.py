"""Corpus preparation in stages, each written as Parquet and read again by the next.

Low-quality documents go, one document of each group of near duplicates stays,
secrets are replaced, domains are mixed to their target weights, and what is left
is packed into token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import minhash, mixing, packing, rulefit, secrets
from ledgerlake.llm.queries import table
from ledgerlake.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rulefit.accepted(spark, docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.without_duplicates(spark, docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.learn(spark, docs))
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs, table(spark, sf_dir, "labels"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("mixing", mix),
    ("packing", pack),
]

#: The stages learn models, so SQL cannot express them; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.table(docs)
    return docs
