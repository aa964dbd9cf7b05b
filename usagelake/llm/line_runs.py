"""Line dedup: repeated runs of lines from a suffix array over line ids, built by prefix doubling.

Level k ranks the suffixes of all line sequences by their first 2**k lines. The next level ranks pairs of ranks, that
of a suffix and that of the suffix 2**k lines on. Suffixes whose lines stand nowhere else leave at each level, so a
level is a join of the repeated suffixes with themselves, a sort of the distinct pairs (in ranges, over all tasks), and
a join back. Suffixes of one rank are an interval whose longest common prefix is at least 2**k lines; the first of an
interval of the least length stays, and the lines of the later copies are deleted. Runs are joined where they touch, so
they come out at full length, with the greatest level that they reach.

Lines that are blank are no part of the sequences and always stay. Equal texts enter once: their later copies lose
all lines at once if they have as many as the least run.

Defined results: a null text is empty and has one blank line. "Later" goes by doc_id, then place in the text; copies
inside one text count. A row without doc_id neither loses lines nor takes them from others. Rows that share a doc_id
are ordered by a hash of their text; repeated rows are judged alike. An empty table gives an empty result. Columns
other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches, whole_text
from usagelake.llm.words import slices

#: The least run has 2**LEVEL lines.
LEVEL = 1
ROUNDS = 40


def _ranked(rows: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """`rows` (doc_id, tag, pos and `keys`) whose keys stand more than once, with their rank in order of the keys."""
    groups = rows.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"g_{k}") for k in keys])
    ordered = groups.repartitionByRange(*[f"g_{k}" for k in keys]).sortWithinPartitions(*[f"g_{k}" for k in keys])
    ranks = scratch.store(ordered.withColumn("g_place", F.monotonically_increasing_id()), f"{name}-ranks")
    same = [F.col(k) == F.col(f"g_{k}") for k in keys]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    out = scratch.store(rows.join(ranks.hint("merge"), condition).select("doc_id", "tag", "pos", F.col("g_place").alias("rank")), name)
    scratch.drop(f"{name}-ranks")
    return out


def repeated_suffixes(docs: DataFrame, scratch: Scratch, level: int = LEVEL) -> tuple[DataFrame, DataFrame]:
    """Later copies (doc_id, tag, pos, depth: 2**k lines that repeat) and equal texts' later copies (doc_id, tag)."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", whole_text().alias("text"))
    full = F.filter(F.split("text", "\n", -1), lambda line: F.trim(line) != "")
    hashed = scratch.store(texts.select(
        "doc_id", F.xxhash64("text").alias("tag"), F.xxhash64(F.lit(1), "text").alias("tag_two"),
        F.transform(full, lambda line: F.struct(F.xxhash64(line).alias("one"), F.xxhash64(F.lit(1), line).alias("two"))).alias("lines"),
    ), "hashed")
    # Stored, as are other groups below, so that the join back can split a large one.
    first = scratch.store(
        hashed.groupBy("tag", "tag_two").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "first")
    copies = hashed.join(first.where("first < last").hint("merge"), ["tag", "tag_two"]).where("doc_id > first").where(
        F.size("lines") >= 2**level).select("doc_id", "tag").distinct()
    copies = scratch.store(copies, "copies")
    single = hashed.join(first.select("tag", "tag_two", F.col("first").alias("doc_id")), ["tag", "tag_two", "doc_id"], "left_semi")
    lines = single.dropDuplicates(["doc_id", "tag"]).select("doc_id", "tag", F.posexplode("lines").alias("pos", "line"))
    now = _ranked(lines.select("doc_id", "tag", "pos", "line.one", "line.two"), ["one", "two"], scratch, "level-0")
    scratch.drop("hashed")
    later, k = None, 0
    while True:
        if k >= level:
            order = F.struct("doc_id", "tag", "pos")
            heads = scratch.store(now.groupBy(F.col("rank").alias("h_rank")).agg(F.min(order).alias("head")), f"heads-{k}")
            found = now.join(heads.hint("merge"), F.col("rank") == F.col("h_rank")).where(order > F.col("head")).select(
                "doc_id", "tag", "pos", F.lit(2**k).cast("long").alias("depth"))
            later = found if later is None else later.union(found)
        if k > level and now.isEmpty() or k == ROUNDS:
            break
        ahead = now.select(F.col("doc_id").alias("n_id"), F.col("tag").alias("n_tag"), (F.col("pos") - 2**k).alias("n_pos"),
                           F.col("rank").alias("next"))
        pairs = now.join(ahead.hint("merge"), (F.col("doc_id") == F.col("n_id")) & (F.col("tag") == F.col("n_tag")) & (F.col("pos") == F.col("n_pos")))
        now, k = _ranked(pairs.select("doc_id", "tag", "pos", "rank", "next"), ["rank", "next"], scratch, f"level-{k + 1}"), k + 1
    return later.groupBy("doc_id", "tag", "pos").agg(F.max("depth").alias("depth")), copies


def repeated_runs(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """Maximal runs that are deleted: doc_id, tag, first_line, n_lines (places among lines that aren't blank), depth.

    Later copies of a whole text are not in it.
    """
    later, _ = repeated_suffixes(docs, Scratch(docs.sparkSession, "lines"), level)
    inside = Window.partitionBy("doc_id", "tag").orderBy("pos")
    gap = (F.col("pos") > F.lag("pos").over(inside) + 2**level).cast("int")
    return later.withColumn("gap", gap).withColumn("run", F.sum(F.coalesce("gap", F.lit(1))).over(inside)).groupBy(
        "doc_id", "tag", "run").agg(
        F.min("pos").alias("first_line"), (F.max("pos") - F.min("pos") + 2**level).alias("n_lines"), F.max("depth").alias("depth")
    ).drop("run")


def _cut(least: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            totals, removed, kept = [], [], []
            for text, starts, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "copy"))):
                lines = text.split("\n")
                full = [i for i, line in enumerate(lines) if line.strip(" ")]
                gone = set(full) if copy else {full[j] for i in starts or () for j in range(i, i + least)}
                totals.append(len(lines))
                removed.append(len(gone))
                kept.append("\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_lines", "n_removed", "kept_text"])

    return cut


def cut_runs(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """One row per row of `docs`: doc_id, n_lines, n_removed, kept_text."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "lines")
    later, copies = repeated_suffixes(docs, scratch, level)
    starts = later.groupBy(F.col("doc_id").alias("s_id"), F.col("tag").alias("s_tag")).agg(F.collect_set("pos").alias("starts"))
    marks = starts.withColumn("copy", F.lit(False)).union(
        copies.select("doc_id", "tag", F.lit(None).cast("array<int>"), F.lit(True)))
    marks = scratch.store(marks, "marks")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("tag", F.xxhash64("text"))
    # Marks grow with the texts, so they are never broadcast: the plan is the same at every size.
    joined = texts.join(marks.hint("merge"), (F.col("doc_id") == F.col("s_id")) & (F.col("tag") == F.col("s_tag")), "left")
    return joined.select("doc_id", "text", "starts", F.coalesce("copy", F.lit(False)).alias("copy")).mapInArrow(
        _cut(2**level), "doc_id long, n_lines long, n_removed long, kept_text string")
