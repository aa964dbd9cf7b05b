"""Shards of near-equal bytes by Karmarkar-Karp differencing over indivisible groups of equal texts.

Differencing keeps partial partitions: for each shard the bytes that it has so far. The two of largest spread are
combined again and again, the largest part of one with the smallest of the other, until one is left.

Groups are summed by text. While there are more than `BLOCK` of them, the groups that are heavier than a shard's
`HEAVY`th part wait (there are at most shards * `HEAVY` of those), the others are hashed into blocks of about `BLOCK`,
and each block is differenced in a task of its own into as many parts as leave about half a block of them in all, and
into as many as there are shards at least; the parts are the next level's elements. So every task and the last one hold a bounded number of elements, and the last one is free to put
light parts against heavy groups.

Defined results: the size of a text is its UTF-8 bytes plus 1, a null text has size 1 and forms a group with the empty
ones. Repeated rows are rows of their own. A group that is larger than a shard's share keeps a shard to itself as far
as that can be. Rows with a null doc_id are placed like others; slots run in the order of doc_id, text hash. An empty
table gives an empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, digest, whole_text

SHARDS = 16
#: Elements that one task differences at once.
BLOCK = 4096
#: An element heavier than a shard's share divided by this waits for the last level.
HEAVY = 64
#: Rows that are numbered in one task.
SLOT_ROWS = 1_000_000


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each element."""
    heap = []
    for i, size in enumerate(sizes):
        # Parts in order of size; empty ones are left out, so memory grows with the elements and not with the shards.
        heap.append((-size, i, [(size, [i])]))
    heapify(heap)
    while len(heap) > 1:
        (_, _, one), (_, tie, two) = heappop(heap), heappop(heap)
        # The largest part of one meets the smallest place of the other, which is empty unless both together overflow.
        meet = max(shards - len(two), 0)
        parts = one[:meet]
        for (a, own), (b, other) in zip(one[meet:], reversed(two)):
            if len(own) < len(other):
                own, other = other, own
            own.extend(other)
            parts.append((a + b, own))
        parts += two[::-1][max(len(one) - meet, 0) :]
        parts.sort(key=lambda part: -part[0])
        heappush(heap, ((parts[-1][0] if len(parts) == shards else 0) - parts[0][0], tie, parts))
    shard = [0] * len(sizes)
    for _, _, parts in heap:
        for k, (_, own) in enumerate(parts):
            for i in own:
                shard[i] = k
    return shard


def _placed(parts: int):
    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("element", "ascending")])
        shard = difference(table.column("size").to_pylist(), parts)
        return table.select(["element", "size", "block"]).append_column("part", pa.array(shard, pa.int32()))

    return place


def assign(groups: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """groups (element binary, size long) -> (element, shard)."""
    schema = "element binary, size long, block long, part int"
    levels: list[DataFrame] = []
    now = groups.select("element", "size")
    total = now.agg(F.sum("size")).first()[0] or 0
    limit = max(total // (shards * HEAVY), 1)
    # A block has at least four times as many elements as it leaves parts, so each level has fewer.
    least = max(BLOCK, 8 * shards)
    while (light := now.where(F.col("size") <= limit).count()) > least:
        blocks = -(-2 * light // least)
        parts_each = max(shards, least // (2 * blocks))
        block = F.pmod(F.xxhash64("element"), F.lit(blocks))
        placed = now.where(F.col("size") <= limit).withColumn("block", block).groupBy("block").applyInArrow(_placed(parts_each), schema)
        placed = scratch.store(placed, f"level-{len(levels)}")
        levels.append(placed)
        # A part is named by level, block and number; its bytes are what its elements have.
        name = F.unhex(F.sha2(F.concat_ws("/", F.lit(len(levels)), "block", "part"), 256))
        parts = placed.groupBy("block", "part").agg(F.sum("size").alias("size")).select(name.alias("element"), "size")
        now = scratch.store(parts.union(now.where(F.col("size") > limit)), f"elements-{len(levels)}")
    last = now.withColumn("block", F.lit(0).cast("long")).groupBy("block").applyInArrow(_placed(shards), schema)
    shard = scratch.store(last.select("element", F.col("part").alias("shard")), "last")
    for k, placed in reversed(list(enumerate(levels, 1))):
        name = F.unhex(F.sha2(F.concat_ws("/", F.lit(k), "block", "part"), 256))
        above = shard.select(F.col("element").alias("part_name"), "shard")
        below = placed.withColumn("part_name", name).join(above, "part_name").select("element", "shard")
        # What waited stays as it is; names of parts are used up here.
        kept = shard.join(placed.select(name.alias("element")).distinct(), "element", "left_anti")
        shard = scratch.store(below.union(kept.select("element", "shard")), f"shards-{k}")
    return shard


def numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """`rows` with slot: 0, 1, ... within each shard, in the order of a hash bucket, then doc_id and text hash.

    Buckets hold about `SLOT_ROWS` rows, so no task sorts a whole shard; only bucket counts are summed up in order.
    """
    buckets = max(1, -(-rows.count() // SLOT_ROWS))
    cut = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("shard", "bucket").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
    return cut.withColumn("nth", F.row_number().over(inside)).join(counts.drop("count"), ["shard", "bucket"]).withColumn(
        "slot", F.col("offset") + F.col("nth") - 1)


def shards_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, shard, slot; equal texts share a shard."""
    scratch = Scratch(docs.sparkSession, "sharding")
    text = whole_text()
    rows = scratch.store(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        digest(text).alias("element")), "rows")
    groups = rows.groupBy("element").agg(F.sum("size").alias("size"))
    shard = assign(scratch.store(groups, "groups"), scratch, shards)
    placed = scratch.store(rows.join(shard, "element"), "placed")
    return numbered(placed, scratch).select("doc_id", "size", "text_crc32", "shard", "slot")
