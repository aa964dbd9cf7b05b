"""Collocations against a plain count of all phrases, with blocks that end inside texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import rows_of
from usagelake.llm import collocations

DOCS = "doc_id long, lang string, text string"


def plain(rows, least, longest=4, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        wanted = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in wanted.items():
            inside = [q for q in wanted if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * wanted[q] >= 80 * a for q in inside):
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "x-y"]
    out = []
    for i in range(n):
        line = rng.choices(words, weights=range(14, 0, -1), k=rng.randint(0, 60))
        if rng.random() < 0.6:
            line[len(line) // 2 : len(line) // 2] = ["New", "york", "city", "Hall"][: rng.choice([2, 3, 4, 4])]
        text = " ".join(w + rng.choice(["", "", "", "", ",", ".", "\t", "\n", " ."]) for w in line)
        out.append((i, rng.choice(["en", "fr", None]), text))
    return out + [(n, "en", None), (n + 1, "de", ""), (n + 1, "en", "a b " * 300), (n + 2, "en", ". ,")]


@pytest.mark.parametrize("tokens", [collocations.TOKENS, 40])
def test_equal_to_a_plain_count(frame, tokens):
    rows = texts(3, 90)
    docs = frame(DOCS, *rows, *rows[:5]).repartition(3)
    got = collocations.collocations(docs, least=6, tokens=tokens, open_tokens=4 * tokens)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(rows + rows[:5], 6)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100
    assert any(len(r[2].split()) == 4 for r in want)


def test_top_and_ties(frame):
    rows = texts(4, 60)
    got = collocations.collocations(frame(DOCS, *rows), least=5, top=7)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 5, top=7)


def test_a_text_over_many_blocks(frame):
    rng = random.Random(6)
    text = " ".join(rng.choice(["a", "b", "c", "d", "e" * 3000]) for _ in range(4000))
    rows = [(1, "en", text)]
    got = collocations.collocations(frame(DOCS, *rows), least=9, tokens=50)
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 9)


@pytest.mark.parametrize("full", [1, 1 << 16, 10**9])
def test_pairs_in_full_and_in_sparse_tiles(monkeypatch, full):
    monkeypatch.setattr(collocations, "FULL", full)
    rng = np.random.default_rng(1)
    left, right = (rng.zipf(1.3, 5000) % 7000 for _ in range(2))
    a, b, n = collocations.count_pairs(left, right)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    assert [len(x) for x in collocations.count_pairs(left[:0], right[:0])] == [0, 0, 0]


def test_large_products_stay_exact(spark):
    from pyspark.sql import functions as F

    a, l, r = 9_000_000_000_000_000_000, 9_100_000_000_000_000_001, 9_200_000_000_000_000_000
    row = spark.sql(f"SELECT {a}L AS a, array({l}L) AS heads, array({r}L) AS tails").select(collocations._scores(2).alias("s")).first()
    assert row.s.score == 2000000 * a // (l + r)


def test_empty_table_and_other_columns(frame):
    assert collocations.collocations(frame(DOCS)).count() == 0
    docs = frame("lang string, text string, block int, n int, rank int, `a.b` int", *[("en", "New York", 1, 1, 1, 1)] * 3)
    assert rows_of(collocations.collocations(docs, least=3)) == [("en", 1, "new york", 3, 3, 3, 6, 1000000)]
