"""Words of many texts at once: spans and hashes from Arrow's text buffers, with numpy and no loop over words.

Used inside tasks (`mapInArrow`); memory is bounded by the slices of `slices`, which hold one text at least.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are worked on at once.
SLICE_BYTES = 1 << 19

U64 = np.uint64
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Everything in ASCII but letters and digits; bytes of other scripts belong to words.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        part = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def segments(data: bytes, gaps: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """`data` in parts of about `limit` bytes, each cut before one of the bytes `gaps`, so that no word is split."""
    gap, at = re.compile(b"[" + re.escape(gaps) + b"]"), 0
    while at < len(data):
        found = gap.search(data, at + limit)
        end = found.start() if found else len(data)
        yield data[at:end]
        at = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last ends; null is empty."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    at = at[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def spans(data: np.ndarray, at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (maximal runs of bytes that are no `gap`) and the first word of each text."""
    inside = ~gap[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    full = at[:-1] < at[1:]
    before[at[:-1][full]] = False
    after[at[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits (a bijection)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Hasher:
    """Polynomial hashes of byte runs and of runs of words, from running sums modulo 2**64."""

    def __init__(self, seed: int) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.base = rng.integers(1 << 40, 1 << 62, 2, dtype=np.uint64) * U64(8) + U64(3)
        self._powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _power(self, which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of a base and of its inverse, n at least."""
        known = self._powers.get(which)
        if known is None or len(known[0]) < n:
            base = int(self.base[which])
            size = max(n, 1 << 16)
            powers = []
            for b in (base, pow(base, -1, 1 << 64)):
                x = np.full(size, b & ((1 << 64) - 1), np.uint64)
                x[0] = 1
                powers.append(np.multiply.accumulate(x))
            known = self._powers[which] = (powers[0], powers[1])
        return known

    def _sums(self, which: int, values: np.ndarray) -> np.ndarray:
        power = self._power(which, len(values) + 1)[0]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=sums[1:])
        return sums

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self._sums(0, self.table[data])
        return mix((sums[ends] - sums[starts]) * self._power(0, len(data) + 1)[1][starts])

    def runs(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of words[start:end] for each pair."""
        sums = self._sums(1, words)
        return mix((sums[ends] - sums[starts]) * self._power(1, len(words) + 1)[1][starts] + (ends - starts).astype(np.uint64))


def windows(first: np.ndarray, length: int, *, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows of `length` words inside texts, and where each text's windows begin.

    `short`: a text of fewer words (but one at least) is one window of all its words.
    """
    n = np.diff(first)
    counts = np.maximum(n - length + 1, (n > 0).astype(n.dtype) if short else 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    starts = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], counts)
    limit = np.repeat(first[1:], counts)
    return starts, np.minimum(starts + length, limit), begin


def lists(values: np.ndarray, begin: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values, kind))
