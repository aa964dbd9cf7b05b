"""Benchmark decontamination by spaced seeds: fixed masks over word positions, some of which they ignore.

Test items are hashed under every mask; each text is hashed the same way inside its task and looked up, so no text is
shuffled. Around a hit, text and item are compared word by word along its diagonal, and a window counts as an overlap
if enough of its words are equal. Words are maximal runs of ASCII letters, digits and bytes of other scripts in the
lower-cased text.

The item side is sent to the tasks in blocks of at most `BLOCK_WORDS` words (a longer item is a block of its own), and
the texts are read once for each block; so what is broadcast is bounded whatever the size of the benchmark.

Defined results: null, empty and wordless texts overlap nothing; items without words match nothing. An item shorter
than a window is searched as a whole, under masks for its length. Masks miss no overlap that the share admits. Items that repeat a text are all named. Repeated rows are judged alike; a null doc_id is kept in the output of
`overlaps`. Empty tables give empty results. Columns other than doc_id and text (item_id and text) are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import small_batches
from usagelake.llm.words import NOT_WORD, U64, Hasher, flat, mix, slices, spans

#: Word positions that count, by the words of a window and how many of them may differ: wherever those are, one of the
#: masks fits beside them.
MASKS = {
    (4, 1): ("111", "1101", "1011"),
    (5, 1): ("1111", "11101", "11011", "10111"),
    (6, 1): ("1111", "11011"),
    (7, 1): ("11111", "111011", "110111"),
    (8, 2): ("11011", "1111", "1100011"),
    (9, 2): ("11101", "100111"),
    (10, 2): ("111011", "11010011", "11111"),
    (11, 2): ("1101011", "1110011"),
    (12, 3): ("111011", "110100011", "11001011", "110111"),
    (13, 3): ("111111", "11010111", "110011011", "11101000011", "1100111001", "110010111"),
}
#: An overlap is a window of so many words (or the whole item, if that is shorter) with this share of them equal.
WINDOW, SHARE = 13, 0.75
BLOCK_WORDS = 400_000

_HASH = Hasher(23)
_ODD = mix(np.arange(1, 65, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each."""
    data, at = flat(pc.utf8_lower(texts))
    starts, ends, first = spans(data, at, NOT_WORD)
    return _HASH.words(data, starts, ends), first


def _seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash under `mask` at each position at which it fits into `words`."""
    n = max(len(words) - len(mask) + 1, 0)
    total = np.full(n, int(mask, 2) + (len(mask) << 32), np.uint64)
    for i in (i for i, c in enumerate(mask) if c == "1"):
        total += words[i : i + n] * _ODD[i % 64] * U64(2 * (i // 64) + 1)
    return mix(total)


def masks_for(size: int, share: float) -> tuple[str, ...]:
    """Masks of which one at least meets any `size` words with this share of them equal.

    Where `MASKS` has none: of so many parts and one more as words may differ, one part is whole.
    """
    differ = int(size - share * size + 1e-9)
    return MASKS.get((size, differ)) or ("1" * max(size // (differ + 1), 1),)


class Index:
    """Seeds of a block of items, in order, and the items' words."""

    def __init__(self, ids: list, texts: pa.Array, window: int = WINDOW, share: float = SHARE) -> None:
        self.ids = ids
        self.words, self.first = words_of(texts)
        by_mask: dict[str, list[tuple[np.ndarray, int]]] = {}
        for i, n in enumerate(np.diff(self.first)):
            own = self.words[self.first[i] : self.first[i + 1]]
            for mask in masks_for(min(int(n), window), share) if n else ():
                by_mask.setdefault(mask, []).append((_seeds(own, mask), i))
        self.masks = {}
        for mask, found in by_mask.items():
            seed = np.concatenate([s for s, _ in found])
            item = np.concatenate([np.full(len(s), i) for s, i in found])
            at = np.concatenate([np.arange(len(s)) for s, _ in found])
            order = np.argsort(seed, kind="stable")
            sieve = np.zeros(1 << 22, bool)
            sieve[seed & U64((1 << 22) - 1)] = True
            self.masks[mask] = (seed[order], item[order], at[order], np.packbits(sieve))

    def overlaps(self, texts: pa.Array, window: int, share: float) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, first word in the text, first word in the item, words, equal words) of each overlap."""
        words, first = words_of(texts)
        hits = []
        for mask, (seeds, items, at, packed) in self.masks.items():
            found = _seeds(words, mask)
            low = found & U64((1 << 22) - 1)
            place = np.flatnonzero((packed[low >> U64(3)] >> (U64(7) - (low & U64(7))).astype(np.uint8)) & 1)
            left = np.searchsorted(seeds, found[place], "left")
            n = np.searchsorted(seeds, found[place], "right") - left
            place, left, n = place[n > 0], left[n > 0], n[n > 0]
            text = np.searchsorted(first, place, "right") - 1
            inside = place + len(mask) <= first[text + 1]
            place, left, n, text = place[inside], left[inside], n[inside], text[inside]
            which = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            hits.append(np.stack([np.repeat(text, n), items[which], np.repeat(place, n) - at[which]], axis=1))
        out = []
        for text, item, shift in np.unique(np.concatenate(hits), axis=0) if hits else ():
            a, b = self.first[item], self.first[item + 1]
            low, high = max(first[text] - shift, 0), min(first[text + 1] - shift, b - a)
            equal = words[low + shift : high + shift] == self.words[a + low : a + high]
            size = min(window, b - a)
            if len(equal) < size:
                continue
            sums = np.concatenate([[0], np.cumsum(equal)])
            good = np.flatnonzero(sums[size:] - sums[:-size] >= share * size - 1e-9)
            if len(good):
                begin, end = good[0], good[-1] + size
                out.append((int(text), int(item), int(shift + low + begin - first[text]), int(low + begin), int(end - begin),
                            int(sums[end] - sums[begin])))
        return out


def _indexes(benchmark: DataFrame, window: int, share: float) -> Iterator[Index]:
    """One block of items after the other; only counts and the items of one block are at the driver."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = benchmark.select("item_id", text.alias("text"), (F.octet_length(text) / 2 + 1).cast("long").alias("most"))
    total, number = sized.agg(F.coalesce(F.sum(F.least("most", F.lit(BLOCK_WORDS))), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-2 * total // BLOCK_WORDS))
    if parts == 1:
        rows = sized.collect()
        if number:
            yield Index([r.item_id for r in rows], pa.array([r.text for r in rows], pa.string()), window, share)
        return
    # Hash buckets of half a block on average, each cut further by a running sum of its own words.
    running = Window.partitionBy("part").orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, 0)
    cut = sized.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))).withColumn(
        "step", F.floor(F.sum("most").over(running) / BLOCK_WORDS))
    for part, step in [(r.part, r.step) for r in cut.select("part", "step").distinct().orderBy("part", "step").collect()]:
        rows = cut.where((F.col("part") == part) & (F.col("step") == step)).collect()
        yield Index([r.item_id for r in rows], pa.array([r.text for r in rows], pa.string()), window, share)


def overlaps(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """One row per overlap of a text with an item: doc_id, item_id, doc_word, item_word, n_words, n_equal."""
    spark = docs.sparkSession
    small_batches(spark)
    names = ["doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"]
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind}, doc_word long, item_word long, n_words long, n_equal long"
    out = None
    for index in _indexes(benchmark, window, share):
        sent = spark.sparkContext.broadcast(index)

        def find(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                found = sent.value.overlaps(batch.column("text"), window, share)
                if found:
                    text, item, *rest = map(list, zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(text)), pa.array([sent.value.ids[i] for i in item])]
                        + [pa.array(x, pa.int64()) for x in rest], names)

        part = docs.select("doc_id", "text").mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per contaminated document: doc_id, item_ids (in order), n_overlaps, n_words, n_equal (of the largest)."""
    return overlaps(docs, benchmark, **how).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count(F.lit(1)).alias("n_overlaps"),
        F.max(F.struct("n_words", "n_equal")).alias("most"),
    ).select("doc_id", F.lit(True).alias("contaminated"), "item_ids", "n_overlaps", "most.n_words", "most.n_equal")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """`docs` without the rows whose text overlaps an item; nothing is shuffled."""
    small_batches(docs.sparkSession)
    for index in _indexes(benchmark, window, share):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, *_ in sent.value.overlaps(batch.column("text"), window, share)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
