"""A training-data pipeline over `documents`: five stages, each one an operator of usagelake.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelake.llm import decontam, near, queries, recipes, toxicity
from usagelake.llm.common import Scratch
from usagelake.session import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; lexicon and weights are learned from `labels`."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return recipes.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the least doc_id stays."""
    return near.drop_near(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of `benchmark` go."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a round trip through them."""
    return queries.tokens(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Near duplicates, the toxicity score, substitution-tolerant overlaps and BPE have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, through tables in the shared folder."""
    tune(spark)
    scratch, docs = Scratch(spark, "pipeline"), _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), name)
        if i:
            scratch.drop(STAGES[i - 1][0])
    return docs
