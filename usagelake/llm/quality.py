"""Quality by hashed word n-grams: logistic regression fitted by follow-the-regularised-leader steps.

Tokens are runs of word characters or of other signs. Features are single tokens and pairs of neighbours, each also by
its outline (case, digits, length of the run), hashed into `SIZE` places; in a pair the second token is written as
"the same" where it repeats the first. A text is the sparse vector of 1 + log(count), scaled to length 1, and its score
is a dot product with the weights. Steps are taken in `SHARDS` tasks, each over its own rows of a bounded sample, and
the weights are averaged; at most `SIZE` of them reach the driver and are sent to all tasks.

Defined results: null, empty and blank texts have no features and get the score of the constant. Without a labelled
text of both kinds every score is the share of label 1 (0.5 without any). Repeated rows are scored alike; a null
doc_id is scored and not held out. An empty table gives an empty result. doc_id, lang, source and other columns are no
inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches
from usagelake.llm.labelled import held_out, labelled_sample
from usagelake.llm.words import ASCII_SPACE, NOT_WORD, U64, Hasher, flat, mix, slices, windows

SIZE = 1 << 20
SHARDS, EPOCHS = 4, 8
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.005
CUTOFF = 0.3

_HASH = Hasher(37)
_KIND = np.where(ASCII_SPACE, 0, np.where(NOT_WORD, 2, 1)).astype(np.uint8)
_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[0x30:0x3A] = 1


def _tokens(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of one kind, and the first token of each text."""
    kind = _KIND[data]
    cut = np.ones(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut[at[:-1][at[:-1] < at[1:]]] = True
    bounds = np.append(np.flatnonzero(cut), len(data))
    full = kind[bounds[:-1]] > 0 if len(data) else np.zeros(0, bool)
    starts = bounds[:-1][full]
    return starts, bounds[1:][full], np.searchsorted(starts, at)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, values, and where each text's begin (sorted by place)."""
    data, at = flat(texts)
    starts, ends, first = _tokens(data, at)
    word = _HASH.words(data, starts, ends)
    upper, digit = (np.concatenate([[0], np.cumsum(t[data])]) for t in (_UPPER, _DIGIT))
    n, caps = ends - starts, upper[ends] - upper[starts]
    outline = np.minimum(n, 12) + 16 * np.where(caps == 0, 0, np.where(caps == 1, 1, 2)) + 64 * (digit[ends] > digit[starts]) + 128 * (
        _KIND[data[starts]] == 2)
    outline = mix(outline.astype(np.uint64) + U64(1))
    a, _, begin = windows(first, 2)
    same = word[a] == word[a + 1] if len(a) else np.zeros(0, bool)
    second = np.where(same, U64(7), word[a + 1] if len(a) else word[:0])
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    pair_doc = np.repeat(np.arange(len(at) - 1), np.diff(begin))
    found = [(doc, word), (doc, outline + U64(3))]
    if len(a):
        found += [(pair_doc, mix(np.where(same, U64(5), word[a]) * U64(3) + second)),
                  (pair_doc, mix(outline[a] * U64(5) + np.where(same, U64(7), outline[a + 1])))]
    key = np.sort(np.concatenate([(d.astype(np.uint64) << U64(20)) | (mix(h) & U64(SIZE - 1)) for d, h in found]))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(new, len(key)))
    owner, place = (key[new] >> U64(20)).astype(np.int64), (key[new] & U64(SIZE - 1)).astype(np.int64)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(owner, value**2, len(at) - 1))
    return place, value / norm[owner], np.searchsorted(owner, np.arange(len(at)))


def _train(rows: list[tuple[np.ndarray, np.ndarray, int]], order: np.ndarray) -> np.ndarray:
    """Weights after `EPOCHS` passes of FTRL-proximal; place SIZE is the constant."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for k in order:
            place, value, label = rows[k]
            zi, ni = z[place], n[place]
            w = weights(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            z[place] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[place] = ni + g * g
    return weights(z, n)


def _with_constant(place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.append(place, np.int32(SIZE)), np.append(value, 1.0)


def _shard(table: pa.Table) -> pa.Table:
    """Weights of one shard; its texts become features slice by slice."""
    rows: list[tuple[np.ndarray, np.ndarray, int]] = []
    for batch in slices(table.select(["text", "label"]).to_batches(), "text"):
        place, value, begin = features(batch.column("text"))
        place = place.astype(np.int32)
        rows += [(*_with_constant(place[i:j], value[i:j]), label)
                 for i, j, label in zip(begin, begin[1:], batch.column("label").to_pylist())]
    weights = _train(rows, np.argsort(table.column("spread").to_numpy()))
    used = np.flatnonzero(weights)
    return pa.table({"place": pa.array(used, pa.int64()), "weight": pa.array(weights[used])})


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights learned from at most `labelled.SAMPLE_ROWS` rows; the last is the constant."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "quality")
    sample = labelled_sample(docs, labels, "quality", scratch)
    good, total = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    weights = np.zeros(SIZE + 1)
    if 0 < good < total:
        learned = sample.withColumn("shard", F.pmod("spread", F.lit(SHARDS))).groupBy("shard").applyInArrow(
            _shard, "place long, weight double")
        for row in learned.groupBy("place").agg((F.sum("weight") / min(SHARDS, total)).alias("weight")).collect():
            weights[row.place] = row.weight
    elif total:
        weights[SIZE] = 35 if good else -35
    scratch.drop("sample")
    return weights


def score(docs: DataFrame, weights: np.ndarray, cutoff: float = CUTOFF) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            place, value, begin = features(batch.column("text"))
            # Summed text by text, so that a score does not depend on the other texts of a batch.
            owner = np.repeat(np.arange(batch.num_rows), np.diff(begin))
            dot = np.bincount(owner, sent.value[place] * value, batch.num_rows)
            dot = np.clip(dot + sent.value[SIZE], -35, 35)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-dot)))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted"))
