"""Phrase collocations: neighbouring ids counted in tiles, frequent pairs ranked again, up to phrases of four words.

Texts become blocks of about a million tokens of one language, as codes into the block's own list of words. The lists
meet in one shuffle, in which each word has a row per block at most; frequent words go back to the blocks that have them.
A block ranks its words by their frequency in all blocks and counts its pairs of neighbouring ranks: pairs fall into
square tiles of the plane of ranks, full tiles (frequent words stand first) are counted by `bincount` over all their
cells, the others as sorted coordinates. Frequent pairs are ranked in the same way and take the places where they begin,
and the same step counts pairs of pairs: two neighbouring ones share a word, so they are phrases of three words, and so
on. A phrase is only counted where both its parts are frequent, which loses none, as a part stands wherever it does.

Between blocks a word or phrase goes by a name that its rows get in their shuffle, so no step numbers all of them.

A block that ends inside a text keeps the next words as context that it doesn't count, so long texts lose nothing.

Defined results: null and empty texts have no words; a null language is `und`. Repeated rows count as often as they
stand, whatever their doc_id. Very long texts are read in parts and may span blocks. Ties in the score go to the larger
count, then to the phrase that is less in byte order. An empty table gives an empty result. Columns other than lang and
text are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches, whole_text
from usagelake.llm.words import segments

LEAST = 30
LONGEST = 4
#: A candidate goes if a longer one has this share of its occurrences (in hundredths).
COVERED = 80
SCALE = 2_000_000
TOP = 2000
#: Tokens of a block (one part of a text may come on top), and of all blocks that a task has open.
TOKENS, OPEN_TOKENS = 1 << 20, 1 << 22
#: Bits of a number inside a block, and of a block inside a task.
NUMBER, BLOCK = 21, 20
#: Side of a tile in bits, and the least occurrences with which all its cells are counted.
SIDE = 10
FULL = 1 << 2 * SIDE - 4

_LOWER_AND_BREAKS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
_TOKEN = re.compile(rb"[^ \t\n]+|\n")
_BREAK = b"\n"


class _Block:
    """Codes of one language's tokens; code 0 is a break between pieces."""

    def __init__(self) -> None:
        self.code: defaultdict[bytes, int] = defaultdict()
        self.code.default_factory = self.code.__len__
        self.code[_BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, tokens: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.code.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def last(self, n: int) -> list[bytes]:
        words = list(self.code)
        return [words[c] for c in np.concatenate(self.parts)[-n:]]


def _blocks(tokens: int, open_tokens: int, context: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done, open_blocks = TaskContext.get().partitionId(), 0, {}

        def written(lang: str, ahead: int = 0) -> pa.RecordBatch:
            nonlocal done
            block = open_blocks.pop(lang)
            codes = np.concatenate(block.parts)
            own = len(codes) - ahead
            counts = np.bincount(codes[:own], minlength=len(block.code))
            counts[0] = 0
            done += 1
            if done >> BLOCK or len(codes) >> NUMBER:
                raise ValueError("too many blocks in a task, or too many tokens in a block")
            return pa.RecordBatch.from_arrays([
                pa.array([task << BLOCK | done]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([own]),
                pa.array([codes.tobytes()], pa.binary()), pa.array([list(block.code)], pa.list_(pa.binary())),
                pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
            ], ["block", "lang", "total", "own", "codes", "words", "counts"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
                for part in segments(text.as_py().translate(_LOWER_AND_BREAKS), b" \t\n"):
                    block = open_blocks.setdefault(lang, _Block())
                    if block.size >= tokens:  # inside a text: the words that follow are context of this block too
                        tail = block.last(context)
                        yield written(lang, len(tail))
                        block = open_blocks[lang] = _Block()
                        block.add(tail)
                    block.add(_TOKEN.findall(part))
                if lang in open_blocks:
                    open_blocks[lang].add([_BREAK])
                    if open_blocks[lang].size >= tokens:
                        yield written(lang)
            if sum(block.size for block in open_blocks.values()) >= open_tokens:
                for lang in list(open_blocks):
                    yield written(lang)
        for lang in list(open_blocks):
            yield written(lang)

    return cut


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different pairs and how often they stand: full tiles by all their cells, the others as sorted coordinates."""
    low, width = (1 << SIDE) - 1, (int(right.max(initial=0)) >> SIDE) + 1
    tile, cell = (left >> SIDE) * width + (right >> SIDE), (left & low) << SIDE | (right & low)
    sizes = np.bincount(tile, minlength=1)
    keys, counts = [], []
    for t in np.flatnonzero(sizes >= FULL):
        cells = np.bincount(cell[tile == t], minlength=1 << 2 * SIDE)
        at = np.flatnonzero(cells)
        keys.append(t << 2 * SIDE | at)
        counts.append(cells[at])
    rest = sizes[tile] < FULL
    key = np.sort(tile[rest] << 2 * SIDE | cell[rest])
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    key, count = np.concatenate([*keys, key[new]]), np.concatenate([*counts, np.diff(np.append(new, len(key)))])
    tile, cell = key >> 2 * SIDE, key & (1 << 2 * SIDE) - 1
    return (tile // width << SIDE) + (cell >> SIDE), (tile % width << SIDE) + (cell & low), count


def _row(block: int, own: int, ranks: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([block]), pa.array([own]), pa.array([ranks.astype(np.int32).tobytes()], pa.binary()), pa.array([names.tobytes()], pa.binary()),
    ], ["block", "own", "ranks", "names"])


#: `ranks`: what begins at each place, -1 for a break or what isn't frequent; `names`: the name of each rank.
_ROW = "block long, own long, ranks binary, names binary"


def _by_frequency(known: pa.StructArray) -> np.ndarray:
    """Places of the different entries (a pair may also stand in the context), the most frequent first."""
    names, once = np.unique(known.field("name").to_numpy(), return_index=True)
    return once[np.lexsort((names, -known.field("a").to_numpy()[once]))]


def _word_ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with ranks in place of their words."""
    for batch in batches:
        for block, own, codes, known in zip(*(batch.column(c) for c in ("block", "own", "codes", "known"))):
            codes, known = np.frombuffer(codes.as_py(), np.int32), known.values
            order = _by_frequency(known)
            ranks = np.full(int(codes.max(initial=0)) + 1, -1, np.int32)
            ranks[known.field("code").to_numpy()[order]] = np.arange(len(order), dtype=np.int32)
            yield _row(block.as_py(), own.as_py(), ranks[codes], known.field("name").to_numpy()[order])


def _pair_ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in which each rank is replaced by that of the frequent pair that begins there."""
    for batch in batches:
        for block, own, ranks, names, known in zip(*(batch.column(c) for c in ("block", "own", "ranks", "names", "known"))):
            ranks, names, known = np.frombuffer(ranks.as_py(), np.int32).astype(np.int64), np.frombuffer(names.as_py(), np.int64), known.values
            order, by_name = _by_frequency(known), np.argsort(names)
            left, right = (by_name[np.searchsorted(names[by_name], known.field(c).to_numpy()[order])] for c in ("left", "right"))
            keys = left * len(names) + right
            sort = np.argsort(keys)
            wanted = np.where((ranks[:-1] >= 0) & (ranks[1:] >= 0), ranks[:-1] * len(names) + ranks[1:], -1)
            at = np.minimum(np.searchsorted(keys[sort], wanted), len(keys) - 1)
            yield _row(block.as_py(), own.as_py(), np.where(keys[sort][at] == wanted, sort[at], -1), known.field("name").to_numpy()[order])


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(left, right, share: block and count) of each block's neighbouring pairs, by name; those in its context alone count 0."""
    for batch in batches:
        for block, own, ranks, names in zip(*(batch.column(c).to_pylist() for c in ("block", "own", "ranks", "names"))):
            ranks, names = np.frombuffer(ranks, np.int32).astype(np.int64), np.frombuffer(names, np.int64)
            left, right = ranks[:-1], ranks[1:]
            both = (left >= 0) & (right >= 0)
            inside = both & (np.arange(len(left)) < own)
            a, b, n = count_pairs(left[inside], right[inside])
            more = np.flatnonzero(both & ~inside)
            a, b, n = np.concatenate([a, left[more]]), np.concatenate([b, right[more]]), np.concatenate([n, np.zeros(len(more), np.int64)])
            yield pa.RecordBatch.from_arrays([
                pa.array(names[a]), pa.array(names[b]), pa.array(n | block << NUMBER)], ["left", "right", "share"])


def _inside(column: str) -> Column:
    return F.col(column).bitwiseAND(F.lit((1 << NUMBER) - 1))


def _frequent(rows: DataFrame, keys: list[str], count: Column, least: int) -> DataFrame:
    """Rows of what stands `least` times in all blocks together: that count `a`, its name, and whether it is its first row.

    A word or pair has a row per block (and one in its context), so no group grows with the tokens. Names are numbers
    of rows, taken after the one shuffle; they hold once the rows are stored.
    """
    same = Window.partitionBy(*keys)
    found = rows.withColumn("a", F.sum(count).over(same)).where(F.col("a") >= least).withColumn("nth", F.monotonically_increasing_id())
    return found.withColumn("name", F.min("nth").over(same)).withColumn("first", F.col("nth") == F.col("name")).drop("nth")


def _known(rows: DataFrame, block: Column, *columns: Column | str) -> DataFrame:
    """What each block needs to know: bounded by the block's own tokens."""
    return rows.groupBy(F.shiftright(block, NUMBER).alias("k_block")).agg(F.collect_list(F.struct(*columns, "a", "name")).alias("known"))


def _scores(level: int) -> Column:
    """(score, first part's words, l, r) of the lowest-scoring cut; ties to the shortest first part."""
    cuts = []
    for k in range(1, level):
        first, rest = f"heads[{k - 1}]", f"tails[{level - k - 1}]"
        score = F.expr(f"cast(a AS decimal(20, 0)) * {SCALE}BD div (cast({first} AS decimal(20, 0)) + cast({rest} AS decimal(20, 0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.expr(first).alias("l"), F.expr(rest).alias("r")))
    return F.array_min(F.array(*cuts))


def _stored(scratch: Scratch, df: DataFrame, name: str) -> DataFrame:
    """A table of codes or ranks, well compressed: these are most of what lies on disk at a time."""
    return scratch.store(df, name, codec="zstd")


def phrases(docs: DataFrame, scratch: Scratch, *, least: int = LEAST, longest: int = LONGEST, tokens: int = TOKENS,
            open_tokens: int = OPEN_TOKENS) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 1, 2 ... `longest` words, a table each, and (lang, n) of all words.

    Columns: name, lang, phrase, a (occurrences), last (word), heads and tails (occurrences of the first and of the last
    1, 2 ... words); from two words on also left and right (names of the phrases without the last and the first word).
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    blocks = _stored(scratch, texts.mapInArrow(
        _blocks(tokens, open_tokens, longest - 1),
        "block long, lang string, total long, own long, codes binary, words array<binary>, counts array<long>"), "blocks")
    totals = scratch.store(blocks.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    entries = blocks.select("block", "lang", F.posexplode(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").alias("n"))).alias("code", "word"))
    entries = entries.where("code > 0").select(
        F.shiftleft("block", NUMBER).bitwiseOR(F.col("code").cast("long")).alias("place"), "lang", "word.phrase", "word.n")
    found = _stored(scratch, _frequent(entries, ["lang", "phrase"], F.col("n"), least).drop("n"), "found-1")
    levels = [scratch.store(found.where("first").select(
        "name", "lang", "phrase", "a", F.col("phrase").alias("last"), F.array("a").alias("heads"), F.array("a").alias("tails")), "phrases-1")]
    known = _known(found, F.col("place"), _inside("place").alias("code"))
    rows = blocks.select("block", "own", "codes").join(known.hint("merge"), F.col("block") == F.col("k_block"))
    rows = _stored(scratch, rows.mapInArrow(_word_ranks, _ROW), "rows-1")
    scratch.drop("blocks", "found-1")
    for level in range(2, longest + 1):
        pairs = rows.mapInArrow(_count, "left long, right long, share long")
        found = _stored(scratch, _frequent(pairs, ["left", "right"], _inside("share"), least), f"found-{level}")
        one = levels[-1].select(F.col("name").alias("left"), "lang", F.col("phrase").alias("first"), "heads")
        two = levels[-1].select(F.col("name").alias("right"), "last", "tails")
        pairs = found.where("first").select("name", "left", "right", "a").join(one.hint("merge"), "left").join(two.hint("merge"), "right")
        levels.append(scratch.store(pairs.select(
            "name", "lang", F.concat("first", F.lit(b" "), "last").alias("phrase"), "a", "last", "left", "right",
            F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails")), f"phrases-{level}"))
        if level < longest:
            known = _known(found, F.col("share"), "left", "right")
            rows = _stored(scratch, rows.join(known.hint("merge"), F.col("block") == F.col("k_block")).mapInArrow(_pair_ranks, _ROW), f"rows-{level}")
        scratch.drop(f"rows-{level - 1}", f"found-{level}")
    return levels, totals


def collocations(docs: DataFrame, *, least: int = LEAST, longest: int = LONGEST, top: int = TOP, tokens: int = TOKENS,
                 open_tokens: int = OPEN_TOKENS) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r (occurrences of its parts), n (all words), score."""
    levels, totals = phrases(docs, Scratch(docs.sparkSession, "collocations"), least=least, longest=longest, tokens=tokens, open_tokens=open_tokens)
    scored = None
    for level, grams in enumerate(levels[1:], 2):
        rows = grams.select("name", "lang", "phrase", "a", _scores(level).alias("best"))
        if level < longest:
            # The longer phrases of one word more suffice: those are as frequent as any that hold them.
            longer = levels[level].select(F.explode(F.array("left", "right")).alias("c_name"), "a").groupBy("c_name").agg(F.max("a").alias("most"))
            rows = rows.join(longer, F.col("name") == F.col("c_name"), "left").where(
                F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * COVERED))
        rows = rows.select("lang", F.col("phrase").cast("string").alias("phrase"), "a", "best.l", "best.r", "best.score")
        scored = rows if scored is None else scored.union(rows)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
