"""SimHash near duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming distances, components.

A fingerprint has a bit set where over half of the hashes of a text's word shingles have it (repeats count). Two
fingerprints that differ in at most 4 bits agree in at least 4 of 8 blocks, so they share one of the 70 keys that hold
4 whole blocks. Fingerprints that share a key meet in a join whose condition is the distance, so only links come out,
each at the first key that a pair shares.

A key with more than `LARGE` different fingerprints is not joined: its members agree in 32 bits, the other 32 are cut
into 8 blocks again, and so on. After the third cut 8 bits are free, so a key has 256 members at most and the work is
linear in the rows, however many fingerprints lie close together. Nothing is left out.

Equal fingerprints are one node; a large group of copies never meets itself.

Defined results: a null text is an empty one. A text without words has the fingerprint zero, which is linked like any
other; one of fewer words than a shingle is one shingle. Words are cut at ASCII white space and only A-Z is lowered.
Very long texts are read in parts, whole. Rows that repeat a doc_id or a text each get a row. A null doc_id is never a
component's id: its row has the least id of its component, or null if there is none. An empty table gives an empty
result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches, whole_text
from usagelake.llm.components import components
from usagelake.llm.words import segments

WORDS = 4
DISTANCE = 4
BITS, BLOCKS = 64, 8
#: Cuts of the free bits: 64, 32 and 16 bits into 8 blocks each.
CUTS = 3
#: A key of more fingerprints is cut finer; the last cut leaves 2**8 under one key at most.
LARGE = 256
SEED = 42
_WHITE = b" \t\n\x0b\x0c\r"


def fingerprint(data: bytes, words: int = WORDS) -> int:
    """The fingerprint of a text in UTF-8, as an unsigned number."""
    counts, total, tail = np.zeros(BITS, np.int64), 0, []

    def add(hashes: list[int]) -> None:
        nonlocal total
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts[:] += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)

    for part in segments(data.lower(), _WHITE):
        found = tail + part.split()
        joined = b" ".join(found)
        ends = list(accumulate(map(len, found), lambda end, size: end + 1 + size))
        starts = [end - len(word) for end, word in zip(ends, found)]
        if len(found) >= words:
            add([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])])
        tail = found[max(0, len(found) - words + 1) :]
    if not total and tail:
        add([xxhash.xxh64_intdigest(b" ".join(tail), SEED)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def keys(fixed: int) -> list[tuple[int, int]]:
    """Masks that hold `fixed` and all but DISTANCE of the blocks of the other bits, each with its last held block."""
    free = [b for b in range(BITS) if not fixed >> b & 1]
    size = len(free) // BLOCKS
    blocks = [sum(1 << b for b in free[i * size : (i + 1) * size]) for i in range(BLOCKS)]
    return [(fixed | sum(blocks[i] for i in held), held[-1]) for held in combinations(range(BLOCKS), BLOCKS - DISTANCE)]


def _sign(words: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            marks = np.array([fingerprint(text.as_py(), words) for text in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "mark"])

    return sign


def _finer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each (mark, fixed) its rows under the finer keys."""
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        masks = []
        for fixed in batch.column("fixed").to_pylist():
            if fixed not in known:
                known[fixed] = np.array([mask for mask, _ in keys(fixed % (1 << 64))], np.uint64).view(np.int64)
            masks.append(known[fixed])
        if masks:
            marks = batch.column("mark").to_numpy().repeat([len(m) for m in masks])
            yield pa.RecordBatch.from_arrays([pa.array(marks), pa.array(np.concatenate(masks))], ["mark", "fixed"])


def links(marks: DataFrame, scratch: Scratch, large: int = LARGE) -> DataFrame:
    """Pairs (a < b) of the different fingerprints `marks` (mark) that differ in DISTANCE bits at most."""
    block = [_signed(0xFF << 8 * i) for i in range(BLOCKS)]
    first = F.explode(F.array(*[F.struct(F.lit(_signed(mask)).alias("fixed"), F.lit(last).alias("last")) for mask, last in keys(0)]))
    rows = marks.select("mark", first.alias("key")).select("mark", "key.fixed", "key.last")
    found = None
    for cut in range(CUTS):
        rows = rows.withColumn("held", F.col("mark").bitwiseAND(F.col("fixed")))
        sized = rows.groupBy(F.col("fixed").alias("s_fixed"), F.col("held").alias("s_held")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = scratch.store(sized, f"sized-{cut}")
        shared = scratch.store(rows.join(
            sized.hint("merge"), (F.col("fixed") == F.col("s_fixed")) & (F.col("held") == F.col("s_held"))).drop("s_fixed", "s_held"), f"shared-{cut}")
        one = shared if cut == CUTS - 1 else shared.where(F.col("n") <= large)
        two = one.select(F.col("mark").alias("o_mark"), F.col("fixed").alias("o_fixed"), F.col("held").alias("o_held"))
        apart = F.col("mark").bitwiseXOR(F.col("o_mark"))
        near = ((F.col("fixed") == F.col("o_fixed")) & (F.col("held") == F.col("o_held")) & (F.col("mark") < F.col("o_mark"))
                & (F.bit_count(apart) <= DISTANCE))
        if cut == 0:  # the first key that the pair shares: no further block up to its last one agrees
            equal = [((F.lit(i) <= F.col("last")) & (apart.bitwiseAND(F.lit(mask)) == 0)).cast("int") for i, mask in enumerate(block)]
            near = near & (sum(equal[1:], equal[0]) == BLOCKS - DISTANCE)
        pairs = one.join(two.hint("merge"), near).select(F.col("mark").alias("a"), F.col("o_mark").alias("b")).distinct()
        pairs = scratch.store(pairs, f"links-{cut}")
        found = pairs if found is None else found.union(pairs)
        scratch.drop(f"sized-{cut}")
        rest = shared.where(F.col("n") > large).select("mark", "fixed").distinct()
        if cut == CUTS - 1 or rest.isEmpty():
            break
        rows = rest.mapInArrow(_finer, "mark long, fixed long")
    return found.distinct()


def near_components(docs: DataFrame, *, words: int = WORDS, large: int = LARGE) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hexadecimal digits), component_id (least doc_id reachable)."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = scratch.store(docs.select("doc_id", whole_text().alias("text")).mapInArrow(_sign(words), f"doc_id {kind}, mark long"), "signed")
    # Stored, as are the results by fingerprint below, so that the join back can split a large group of copies.
    nodes = scratch.store(signed.groupBy("mark").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes.select("mark"), scratch, large), scratch)
    classed = nodes.join(found, F.col("mark") == F.col("id"), "left").select(
        "mark", "first", F.coalesce("component", "mark").alias("class"))
    classed = scratch.store(classed, "classed")
    least = scratch.store(classed.groupBy(F.col("class").alias("l_class")).agg(F.min("first").alias("component_id")), "least")
    labels = scratch.store(classed.join(least, F.col("class") == F.col("l_class")).select(F.col("mark").alias("l_mark"), "component_id"), "labels")
    return signed.join(labels, F.col("mark") == F.col("l_mark")).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
