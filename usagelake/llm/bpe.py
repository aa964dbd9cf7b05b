"""Byte-level BPE: each distinct word is folded once by ranked merges, ids are decoded by joining their pieces.

A text is cut by the tokenizer's pattern; a word's bytes are merged pair by pair, the pair of lowest rank first and the
leftmost of equal ones, until no pair has a rank. A task does this once for each distinct word that it meets and
remembers the result. The rank table is a bounded literal (one entry per token) that is sent to all tasks; nothing is
shuffled.

Defined results: null is an empty text, which has no ids and decodes to no bytes. Words of any length are merged in
time n log n. Repeated rows and null doc_ids come out as they went in. Columns other than doc_id and text (doc_id and
ids) are not looked at. An id without a piece raises an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import small_batches
from usagelake.llm.words import slices

#: Distinct words whose ids a task remembers.
MEMORY = 150_000
#: Words of more bytes are merged with a heap.
LONG = 48
_NONE = 1 << 62


def load_ranks(path: str) -> list[bytes]:
    """Pieces in the order of their ranks, from lines of a base64 piece and its rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    pieces = [b""] * len(pairs)
    for piece, rank in pairs:
        pieces[int(rank)] = base64.b64decode(piece)
    return pieces


class Coder(dict):
    """Ids of the distinct words met so far; a word that is missing is merged when it is asked for."""

    def __init__(self, pieces: list[bytes], pattern: str) -> None:
        super().__init__()
        self.pieces, self.ranks = pieces, {p: i for i, p in enumerate(pieces)}
        self.find = regex.compile(pattern).findall

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMORY:
            self.clear()
        raw = word.encode()
        whole = self.ranks.get(raw)
        self[word] = ids = (whole,) if whole is not None else self._fold(raw) if len(raw) <= LONG else self._heap(raw)
        return ids

    def _fold(self, raw: bytes) -> tuple[int, ...]:
        """Join the leftmost pair of lowest rank, step by step; only the pairs beside it get new ranks."""
        get, parts = self.ranks.get, [raw[i : i + 1] for i in range(len(raw))]
        ranks = [get(raw[i : i + 2], _NONE) for i in range(len(raw) - 1)]
        while ranks and (low := min(ranks)) < _NONE:
            at = ranks.index(low)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], _NONE)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], _NONE)
        return tuple(self.ranks[p] for p in parts)

    def _heap(self, raw: bytes) -> tuple[int, ...]:
        """The same merges for a long word: pairs wait in a heap by rank and place, parts are chained."""
        n, get = len(raw), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapify(pairs)
        alive = [True] * n
        while pairs:
            _, i, stop = heappop(pairs)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            end[i], alive[j] = stop, False
            if stop < n:
                before[stop] = i
                if (r := get(raw[i : end[stop]])) is not None:
                    heappush(pairs, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := get(raw[k:stop])) is not None:
                heappush(pairs, (r, k, stop))
        return tuple(self.ranks[raw[i : end[i]]] for i in range(n) if alive[i])

    def encode(self, text: str) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.__getitem__, self.find(text))), np.int32)


_CODERS: dict[int, Coder] = {}


def _coder(sent, pattern: str) -> Coder:
    """One coder per worker process and table, so that later tasks find its words."""
    if sent.id not in _CODERS:
        _CODERS.clear()
        _CODERS[sent.id] = Coder(sent.value, pattern)
    return _CODERS[sent.id]


class _Sent:
    """Broadcast pieces under a name of their own."""

    def __init__(self, spark, pieces: list[bytes]) -> None:
        self.data, self.id = spark.sparkContext.broadcast(pieces), hash((len(pieces), pieces[0], pieces[-1], id(pieces)))

    @property
    def value(self) -> list[bytes]:
        return self.data.value


def encode(docs: DataFrame, pieces: list[bytes], pattern: str) -> DataFrame:
    """One row per row of `docs`: doc_id, ids (array of int)."""
    small_batches(docs.sparkSession)
    sent, kind = _Sent(docs.sparkSession, pieces), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent, pattern)
        for batch in slices(batches, "text"):
            found = [coder.encode(t or "") for t in batch.column("text").to_pylist()]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(begin), pa.array(np.concatenate(found), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, pieces: list[bytes]) -> DataFrame:
    """One row per row of `encoded`: doc_id, ids, bytes: the pieces of the ids, joined, from a literal array of pieces."""
    known = F.split(F.lit(",".join(piece.hex() for piece in pieces)), ",")

    def piece(i: Column) -> Column:
        return F.coalesce(F.get(known, i), F.raise_error(F.concat(F.lit("no piece for id "), i.cast("string"))))

    return encoded.select("doc_id", "ids", F.unhex(F.array_join(F.transform("ids", piece), "")).alias("bytes"))


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
