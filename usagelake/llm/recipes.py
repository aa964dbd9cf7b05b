"""Exact dedup by chunk recipes: texts are cut by content, chunks get verified identifiers, ordered lists are compared.

Only DataFrame functions. A document's text is read once and never shuffled: what moves is one hash and one digest per
chunk, and the recipe.

Defined results: a null text is an empty one; all empty texts are one group with an empty recipe. Rows that repeat both
doc_id and text are rows of their own in `exact_groups` and one document in `drop_copies`. A null doc_id is less than
any other. An empty table gives an empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, digest, keep_rows, whole_text

#: A chunk ends after a space or line end that follows letters of these classes, 512 characters after the last cut at
#: the earliest; so an edit moves only the cuts near it. Without such a place it ends after 8192 characters.
CHUNK = r"(?s).{512,8192}?(?:(?<=[aeiou][a-m][nrst]\s)|(?<=[aeiou][nrst][.,]\s)|\z)|.{1,8192}"


def _parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, text_bytes, parts (hash and digest of each chunk, in order)."""
    text = whole_text()
    return docs.select(
        "doc_id", text.alias("text"),
    ).select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("text_bytes"),
        F.transform(
            F.regexp_extract_all("text", F.lit(CHUNK), F.lit(0)),
            lambda chunk: F.struct(F.xxhash64(chunk).alias("hash"), digest(chunk).alias("sha")),
        ).alias("parts"),
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id (largest doc_id of its group), group_size, kept, text_sha256, n_chunks.

    Identifiers are 64-bit hashes, verified by digest: where chunks of one hash differ, each gets a number beside it,
    so two lists are equal only if all chunks are. Groups are summed before the shuffle; the join back to the
    documents has one row per group on one side, and adaptive execution splits a group that holds much of the other.
    """
    scratch = Scratch(docs.sparkSession, "recipes")
    parts = scratch.store(_parts(docs), "parts")
    chunks = parts.select("doc_id", "text_sha256", F.posexplode("parts").alias("pos", "part"))
    known = chunks.select("part.hash", "part.sha").distinct()
    clashing = known.join(known.groupBy("hash").count().where("count > 1").select("hash"), "hash")
    numbered = clashing.withColumn("n", F.row_number().over(Window.partitionBy("hash").orderBy("sha")) - 1)
    numbered = scratch.store(numbered, "clashes")
    extra = (
        chunks.join(numbered, (F.col("part.hash") == numbered.hash) & (F.col("part.sha") == numbered.sha))
        .groupBy("doc_id", "text_sha256").agg(F.sort_array(F.collect_set(F.struct("pos", "n"))).alias("numbers"))
        .select(F.col("doc_id").alias("x_id"), F.col("text_sha256").alias("x_sha"), "numbers")
    )
    lists = parts.join(
        extra, F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("text_sha256") == F.col("x_sha")), "left",
    ).select("doc_id", "text_sha256", "text_bytes", F.col("parts.hash").alias("ids"), "numbers")
    lists = lists.withColumn("recipe", F.xxhash64("ids", "numbers", "text_bytes"))
    same = ("recipe", "text_bytes", "ids", "numbers")
    groups = lists.groupBy(*same).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).select(
        F.col("recipe").alias("g_recipe"), F.col("text_bytes").alias("g_bytes"), F.col("ids").alias("g_ids"),
        F.col("numbers").alias("g_numbers"), "keep_id", "group_size")
    # Stored, so that the join back can split a large group.
    groups = scratch.store(groups, "groups")
    joined = lists.join(
        groups, (F.col("recipe") == F.col("g_recipe")) & (F.col("text_bytes") == F.col("g_bytes"))
        & (F.col("ids") == F.col("g_ids")) & F.col("numbers").eqNullSafe(F.col("g_numbers")))
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.size("ids").alias("n_chunks"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts, that of the largest doc_id."""
    stay = exact_groups(docs).where("kept").select("doc_id", F.unhex("text_sha256").alias("text_digest"))
    return keep_rows(docs, stay, once=True)
