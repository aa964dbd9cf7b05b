"""Bounded samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, digest, whole_text

#: Most labelled rows that a classifier is fitted on.
SAMPLE_ROWS = 20_000


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, scratch: Scratch, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, label (0 or 1), spread (a hash), of at most `rows` labels that are not held out; equal texts count once.

    The sample is the labels of least hash, so it doesn't depend on partitions. It is bounded, and so it may be sent
    to all tasks: the texts are found in one pass over `docs` without moving them.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(
        F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("label"))
    chosen = known.groupBy("l_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("l_id"), "l_id").limit(rows)
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    found = texts.groupBy(digest(F.col("text")).alias("sha")).agg(
        F.first("text").alias("text"), F.max("label").alias("label"))
    return scratch.store(found.select("text", "label", F.xxhash64("sha").alias("spread")), "sample")
