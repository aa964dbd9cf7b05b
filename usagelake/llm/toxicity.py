"""Toxicity: misspelled terms by a Levenshtein automaton on a lexicon trie, weighed by the window they stand in.

The lexicon is learned from labelled texts: words and stems that stand in many toxic texts and in almost no other. A
text is cut into words; each distinct word is run once through the product of the trie and the automaton of one edit,
whose states are made when first needed. A word that begins with a stem is a hit, also with one edit before the stem's
last letter (which must stand, else each word that begins like a shortened stem would be one). A hit counts as quoted if it stands inside quotation marks, else as open.
Counts of both, their misspelled forms and the densest window of open hits are the inputs of a logistic regression.

Defined results: null and empty texts have no hits and get the score that the fit gives to none. Without a labelled
text of both kinds, or without a term, every score is 0 and nothing is dropped. A very long text is scored whole. Repeated rows are scored alike; a null doc_id is scored and not held out. An
empty table gives an empty result. doc_id, lang, source and other columns are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.llm.common import Scratch, small_batches
from usagelake.llm.labelled import held_out, labelled_sample
from usagelake.llm.words import slices

#: A term follows so many different words in toxic texts (a share of the toxic texts of the sample, and 4 at least;
#: near copies add none), and makes up 19 of 20 of these and the other texts that it stands in.
SUPPORT, PRECISION, LEAST = 0.006, 0.95, 4
#: A lexicon of more characters is an error. It can't have more terms than the labelled rows give enough support to.
MAX_LEXICON = 16 << 20
STEMS = (4, 5, 6, 7, 8)
#: A word may differ from a term of so many letters by one edit, and so may its beginning from a stem.
FUZZY_FROM = 5
WINDOW = 20
#: Distinct words whose result a task remembers.
MEMORY = 100_000
CUTOFF = 0.5
FEATURES = 6

TOKEN = re.compile(r"[\w@$]+|[\"“”„«»]")
OPENING, CLOSING = "„«", "»"
#: Characters that stand for letters.
LOOKALIKE = str.maketrans("013457@$", "oieastas")


class Automaton:
    """Deterministic automaton of (trie node, edits) sets: which term is a word, a stem of it, or one edit away."""

    def __init__(self, words: Iterable[str], stems: Iterable[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]  # 1: a word, 2: a stem
        self.depth: list[int] = [0]
        for kind, terms in ((1, words), (2, stems)):
            for term in terms:
                node = 0
                for c in term:
                    if c not in self.children[node]:
                        self.children[node][c] = len(self.children)
                        self.children.append({})
                        self.ends.append(0)
                        self.depth.append(self.depth[node] + 1)
                    node = self.children[node][c]
                self.ends[node] |= kind
        self.moves: list[dict[str, int]] = []
        self.verdict: list[int] = []
        self.sets: list[dict[int, int]] = []
        self.known: dict[tuple[frozenset, bool], int] = {}
        self.start = self._state({0: 0}, False)

    def _state(self, nodes: dict[int, int], near_stem: bool) -> int:
        """Number of the state; a letter of a term may be left out at the price of one edit.

        `near_stem`: the last letter ended a stem that has one edit.
        """
        for node, edits in list(nodes.items()):
            if edits == 0:
                for child in self.children[node].values():
                    nodes[child] = min(nodes.get(child, 1), 1)
        key = frozenset(nodes.items()), near_stem
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
            exact = any(e == 0 and self.ends[n] & 1 for n, e in nodes.items())
            close = any(e == 1 and self.ends[n] & 1 and self.depth[n] >= FUZZY_FROM for n, e in nodes.items())
            stem = any(e == 0 and self.ends[n] & 2 for n, e in nodes.items())
            self.verdict.append(2 if stem else 1 if exact else -2 if near_stem else -1 if close else 0)
        return self.known[key]

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        near_stem = False
        for node, edits in self.sets[state].items():
            child = self.children[node].get(c)
            if child is not None:
                after[child] = min(after.get(child, edits), edits)
                near_stem = near_stem or edits == 1 and bool(self.ends[child] & 2) and self.depth[child] >= FUZZY_FROM
            if edits == 0:
                after[node] = min(after.get(node, 1), 1)
                for other in self.children[node].values():
                    after[other] = min(after.get(other, 1), 1)
        return self._state(after, near_stem) if after else -1

    def match(self, word: str) -> int:
        """1: a term or begins with a stem, -1: one edit from that, 0: neither."""
        state, near_stem = self.start, False
        for c in word:
            after = self.moves[state].get(c)
            if after is None:
                after = self.moves[state][c] = self._step(state, c)
            if after < 0:
                return -1 if near_stem else 0
            state = after
            if self.verdict[state] == 2:
                return 1
            near_stem = near_stem or self.verdict[state] == -2
        return -1 if near_stem and self.verdict[state] != 1 else max(self.verdict[state], -1)


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: list[float] | None

    def __post_init__(self) -> None:
        self._reset()

    def _reset(self) -> None:
        self.automaton = Automaton(self.words, self.stems)
        self.memory: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return {"words": self.words, "stems": self.stems, "weights": self.weights}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._reset()

    def hit(self, word: str) -> int:
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) >= MEMORY:
                self.memory.clear()
            found = self.automaton.match(word)
            if not found and not word.isalpha():
                found = -abs(self.automaton.match(word.translate(LOOKALIKE)))
            self.memory[word] = found
        return found

    def features(self, text: str) -> list[float]:
        tokens = TOKEN.findall(text.lower())
        hit = self.hit
        places = [(i, h) for i, h in enumerate(map(hit, tokens)) if h]
        if not places:
            return [0.0] * FEATURES
        quoted = self._quoted(tokens, [i for i, _ in places])
        open_exact = [i for (i, h), q in zip(places, quoted) if h > 0 and not q]
        open_close = sum(h < 0 and not q for (_, h), q in zip(places, quoted))
        quoted_exact = sum(h > 0 and q for (_, h), q in zip(places, quoted))
        quoted_close = sum(h < 0 and q for (_, h), q in zip(places, quoted))
        dense = self._densest(open_exact) if open_exact else 0
        return [float(np.log1p(x)) for x in (len(open_exact), open_close, quoted_exact, quoted_close, dense)] + [
            float(bool(open_exact))]

    @staticmethod
    def _densest(places: list[int]) -> int:
        at = np.array(places)
        return int((np.searchsorted(at, at + WINDOW) - np.arange(len(at))).max())

    @staticmethod
    def _quoted(tokens: list[str], places: list[int]) -> list[bool]:
        """Whether each place lies between a mark and the next one; a mark without a closing one quotes nothing."""
        marks = [i for i, t in enumerate(tokens) if not (t[0].isalnum() or t[0] in "_@$")]
        if not marks:
            return [False] * len(places)
        inside, opened = [], None
        for i in marks:
            if opened is None or tokens[i] in OPENING:
                opened = None if tokens[i] in CLOSING else i
            else:
                inside.append((opened, i))
                opened = None
        out, k = [], 0
        for place in places:
            while k < len(inside) and inside[k][1] < place:
                k += 1
            out.append(k < len(inside) and inside[k][0] < place)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        x = np.array([self.features(t or "") for t in texts]).reshape(len(texts), FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[1:]) + self.weights[0], -50, 50)))


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and stems with the words before them in toxic texts, or the number of other texts, summed over the task."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
            pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64()),
        ], ["term", "stem", "before", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            words = TOKEN.findall(text.lower())
            pairs = {(w, b if label else None) for w, b in zip(words, ["", *words]) if w[0].isalpha()}
            counts.update([(w, False, b) for w, b in pairs])
            counts.update({(w[:n], True, b) for w, b in pairs for n in STEMS if len(w) > n})
            if len(counts) > 1_000_000:
                yield flush()
    yield flush()


def _lexicon(rows: list) -> tuple[list[str], list[str]]:
    """A stem is taken where it stands for more texts than one word or shorter stem does."""
    words = {r.term: r.toxic for r in rows if not r.stem}
    stems: dict[str, int] = {}
    for row in sorted((r for r in rows if r.stem), key=lambda r: (len(r.term), r.term)):
        shorter = any(row.term.startswith(s) for s in stems)
        word = max((n for w, n in words.items() if w.startswith(row.term)), default=0)
        if not shorter and word < 0.8 * row.toxic:
            stems[row.term] = row.toxic
    return sorted(w for w in words if not any(w.startswith(s) for s in stems)), sorted(stems)


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps, with a penalty on all but the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn lexicon and weights from at most `labelled.SAMPLE_ROWS` rows; six numbers a row reach the driver."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = labelled_sample(docs, labels, "toxic", scratch)
    toxic, all_rows = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < toxic < all_rows:
        return Model([], [], None)
    counted = sample.select("text", "label").mapInArrow(_terms, "term string, stem boolean, before string, n long")
    counted = counted.groupBy("term", "stem", "before").agg(F.sum("n").alias("n")).groupBy("term", "stem").agg(
        F.count("before").alias("toxic"), F.coalesce(F.sum(F.when(F.col("before").isNull(), F.col("n"))), F.lit(0)).alias("other")).where(
        (F.col("toxic") >= max(LEAST, SUPPORT * toxic)) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("other"))))
    counted = scratch.store(counted, "counted")
    size = counted.agg(F.coalesce(F.sum(F.length("term")), F.lit(0))).first()[0]
    if size > MAX_LEXICON:
        raise ValueError(f"a lexicon of {size} characters: raise SUPPORT")
    words, stems = _lexicon(counted.collect())
    scratch.drop("counted")
    if not words and not stems:
        scratch.drop("sample")
        return Model([], [], None)
    model = Model(words, stems, [])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])

    rows = sample.select("text", "label").mapInArrow(measure, "x array<double>, label int").collect()
    model.weights = _regression(np.array([r.x for r in rows]), np.array([r.label for r in rows], float))
    scratch.drop("sample")
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.scores(batch.column("text").to_pylist()))], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` without the rows predicted toxic; nothing is shuffled."""

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(model.scores(batch.column("text").to_pylist()) < CUTOFF))

    return docs.mapInArrow(clean, docs.schema)
