"""Substring dedup by level-wise doubling: runs of words that repeat at half the length are tried at the full length.

Half level: of the half-length runs inside a window, the one of least hash is its anchor; equal windows have equal
anchors, so a few anchors stand for all windows. The windows of one anchor lie side by side; together they are its
span. Anchors that stand in one document alone end here. Where a whole span also stands in an earlier document, all
its windows go at once and only its first copy goes on.

Full level: first copies whose anchor has other spans are opened into windows, which are compared one by one.

Spans are told apart by two independent 64-bit hashes and their length, windows by two. Counts are minima per key,
summed before the shuffle; the joins back have one row per key on one side, and adaptive execution splits a passage
that stands in much of the input.

Defined results: a null text has no words. Windows are judged on the input. A row without doc_id neither loses words
nor takes them from others. Rows that share a doc_id don't take words from each other; each text is judged for itself,
and repeated rows alike. A text of fewer words than a window stays whole. An empty table gives an empty result. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches, whole_text
from usagelake.llm.words import ASCII_SPACE, Hasher, flat, slices, spans, windows

WINDOW = 50

_ONE, _TWO = Hasher(51), Hasher(52)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each place, where the least of `width` values from there on stands first."""
    best, size = np.arange(len(values)), 1

    def merged(best: np.ndarray, step: int) -> np.ndarray:
        left, right = best[: len(best) - step], best[step:]
        return np.where(values[left] <= values[right], left, right)

    while size * 2 <= width:
        best, size = merged(best, size), size * 2
    return merged(best, width - size) if width > size else best


def _anchors(window: int):
    half = window // 2

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = flat(batch.column("text"))
            starts, ends, first = spans(data, at, ASCII_SPACE)
            begin, _, of = windows(first, window)
            if not len(begin):
                continue
            one = _ONE.words(data, starts, ends)
            two = _TWO.words(data, starts, ends)
            runs = np.arange(len(one) - half + 1)
            short = _ONE.runs(one, runs, runs + half)
            anchor = _leftmost_least(short, window - half + 1)[begin]
            new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            n = np.diff(np.append(new, len(anchor)))
            text = np.searchsorted(of, new, "right") - 1
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(text)), batch.column("tag").take(pa.array(text)),
                _signed(short[anchor[new]]), _signed(_TWO.runs(two, begin[new], begin[new] + n - 1 + window)),
                pa.array((begin[new] - first[text]).astype(np.int32)), pa.array(n.astype(np.int32)),
            ], ["doc_id", "tag", "anchor", "span", "start", "n"])

    return find


def _opened(window: int):
    """Both hashes of each window of the given stretches (start, n) of each text."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = flat(batch.column("text"))
            starts, ends, first = spans(data, at, ASCII_SPACE)
            one, two = _ONE.words(data, starts, ends), _TWO.words(data, starts, ends)
            lists = batch.column("stretches")
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat_lists = lists.flatten()
            text = np.repeat(np.arange(batch.num_rows), size)
            low, n = (flat_lists.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            begin = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            text = np.repeat(text, n)
            place = begin + first[text]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(text)), batch.column("tag").take(pa.array(text)),
                _signed(_ONE.runs(one, place, place + window)), _signed(_TWO.runs(two, place, place + window)),
                pa.array(begin.astype(np.int32)),
            ], ["doc_id", "tag", "one", "two", "start"])

    return find


def _cut(window: int):
    """Texts without the words of the windows that start in the given stretches."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, at = flat(batch.column("text"))
            starts, ends, first = spans(data, at, ASCII_SPACE)
            lists = batch.column("stretches")
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat_lists = lists.flatten()
            low, n = (flat_lists.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            low = low + np.repeat(first[:-1], size)
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, low, 1)
            np.add.at(change, low + n - 1 + window, -1)
            gone = np.cumsum(change)[:-1] > 0
            out, raw = [], data.tobytes()
            for i in range(batch.num_rows):
                kept = np.flatnonzero(~gone[first[i] : first[i + 1]]) + first[i]
                out.append(b" ".join([raw[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())]).decode())
            words = np.diff(first)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(removed), pa.array(out, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"])

    return cut


def repeated_windows(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """doc_id, tag, stretches: starts (start, n) of windows that also start in a document with a smaller doc_id."""
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", whole_text().alias("text"))
    tagged = texts.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    anchors = scratch.store(
        tagged.mapInArrow(_anchors(window), "doc_id long, tag long, anchor long, span long, start int, n int"), "anchors")
    same = anchors.groupBy("anchor", "span", "n").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
    same = scratch.store(same, "spans")
    open_anchors = same.groupBy("anchor").agg(F.min("head").alias("low"), F.max("head").alias("high")).where("low < high")
    judged = same.join(open_anchors.select("anchor", F.lit(True).alias("opens")), "anchor", "left").where(
        "last > head OR opens").select(
        F.col("anchor").alias("j_anchor"), F.col("span").alias("j_span"), F.col("n").alias("j_n"), "head", "opens")
    found = anchors.join(judged, (F.col("anchor") == F.col("j_anchor")) & (F.col("span") == F.col("j_span")) & (
        F.col("n") == F.col("j_n"))).where("doc_id > head OR opens").select(
        "doc_id", "tag", "start", "n", (F.col("doc_id") > F.col("head")).alias("copy"))
    found = scratch.store(found, "found")
    scratch.drop("anchors", "spans")
    heads = found.where("NOT copy").groupBy(F.col("doc_id").alias("h_id"), F.col("tag").alias("h_tag")).agg(
        F.collect_set(F.struct("start", "n")).alias("stretches"))
    opened = tagged.join(heads, (F.col("doc_id") == F.col("h_id")) & (F.col("tag") == F.col("h_tag"))).select(
        "doc_id", "tag", "text", "stretches").mapInArrow(
        _opened(window), "doc_id long, tag long, one long, two long, start int")
    opened = scratch.store(opened, "opened")
    first = opened.groupBy(F.col("one").alias("f_one"), F.col("two").alias("f_two")).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = scratch.store(first, "first")
    again = opened.join(first, (F.col("one") == F.col("f_one")) & (F.col("two") == F.col("f_two"))).where("doc_id > first")
    gone = found.where("copy").select("doc_id", "tag", "start", "n").union(
        again.select("doc_id", "tag", "start", F.lit(1)))
    stretches = gone.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "n")).alias("stretches"))
    stretches = scratch.store(stretches, "stretches")
    scratch.drop("found", "opened", "first")
    return stretches


def cut_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substrings")
    stretches = repeated_windows(docs, scratch, window).select(
        F.col("doc_id").alias("s_id"), F.col("tag").alias("s_tag"), "stretches")
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("tag", F.xxhash64("text"))
    joined = texts.join(stretches, (F.col("doc_id") == F.col("s_id")) & (F.col("tag") == F.col("s_tag")), "left")
    return joined.select("doc_id", "text", "stretches").mapInArrow(
        _cut(window), "doc_id long, n_words long, n_removed long, kept_text string")
