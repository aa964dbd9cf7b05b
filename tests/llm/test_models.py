"""Near duplicates against brute force, classifiers on held-out rows, and the pipeline stage by stage."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.conftest import rows_of
from usagelake.llm import near, quality, toxicity
from usagelake.llm.labelled import held_out
from usagelake.llm.words import ASCII_SPACE, Hasher, flat, slices, spans

DOCS = "doc_id long, text string"


def shingles(text, n=5):
    words = (text or "").split()
    return Counter(tuple(words[k : k + n]) for k in range(max(len(words) - n + 1, min(len(words), 1))))


def plain_jaccard(x, y):
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def plain_classes(rows, least=0.8):
    rows = [(i, t) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, t) in enumerate(rows):
        for j, u in rows[:n]:
            if (t or "") == (u or "") or plain_jaccard(shingles(t), shingles(u)) >= least - 1e-12:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def near_rows(seed, groups=8, copies=6):
    rng, rows = random.Random(seed), []
    vocabulary = [f"v{i}" for i in range(300)]
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(8, 150))
        for c in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((g * copies + c, " ".join(words)))
    rng.shuffle(rows)
    return rows


def test_probability_jaccard():
    rng = random.Random(9)
    for _ in range(60):
        x, y = (rng.choices(range(12), k=rng.randint(1, 20)) for _ in range(2))
        got = near.probability_jaccard(np.array(x, np.uint64), np.array(y, np.uint64))
        assert got == pytest.approx(plain_jaccard(Counter(x), Counter(y)))


def test_registers_agree_as_often_as_the_similarity():
    rng = random.Random(10)
    x = rng.choices(range(400), k=500)
    y = x[:400] + rng.choices(range(400, 500), k=60)
    hashes = np.array([hash(("s", v)) & (1 << 64) - 1 for v in x + y], np.uint64)
    registers = near.signatures(hashes, np.array([0, len(x), len(x) + len(y)]), 4000)
    assert (registers[0] == registers[1]).mean() == pytest.approx(plain_jaccard(Counter(x), Counter(y)), abs=0.04)
    assert (near.signatures(hashes[:0], np.array([0, 0]), 10) == 0).all()


def test_near_classes_equal_brute_force(frame):
    rows = near_rows(11) + [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "one two"), (205, "one  two"), (206, "x " * 30),
                            (207, "x " * 60), (None, "one two")]
    docs = frame("doc_id long, text string, id int, sha string", *[(*r, 1, "s") for r in rows])
    got = {r.doc_id: r.class_id for r in near.near_classes(docs).collect()}
    assert got == plain_classes(rows)
    kept = near.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i)) == sorted(set(got.values())) + [None]


def test_a_large_group_of_near_copies_is_one_class(frame):
    rng = random.Random(12)
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(120)] = f"n{i}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in near.near_classes(frame(DOCS, *rows)).collect()}
    assert got == plain_classes(rows)


def test_pairs_in_a_large_family_below_the_threshold(frame, monkeypatch):
    """All texts share a template (similarity about 0.72); only the two of a pair reach 0.8, and few are near a centre."""
    monkeypatch.setattr(near, "CENTRES", 1)
    rng = random.Random(14)
    template, rows = [f"t{i}" for i in range(257)], []
    for p in range(75):
        shared = [f"p{p}n{j}" for j in range(20)]
        rows += [(2 * p + c, " ".join(template + shared + [f"o{p}n{c}n{j}" for j in range(26)])) for c in (0, 1)]
    rng.shuffle(rows)
    # Every shingle stands once in its text, so the similarity is that of the sets.
    sets = {i: set(shingles(t)) for i, t in rows}
    linked = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    assert linked == {(i, i + 1) for i in range(0, 150, 2)}
    want = {i: i - i % 2 for i in sets}
    assert {r.doc_id: r.class_id for r in near.near_classes(frame(DOCS, *rows)).collect()} == want


def test_near_classes_of_int_ids(frame):
    rows = near_rows(18, groups=2, copies=3)
    docs = frame("doc_id int, text string", *rows)
    want = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in near.near_classes(docs).collect()} == want
    kept = near.drop_near(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == set(want.values())


def test_near_of_an_empty_table(frame):
    assert near.near_classes(frame(DOCS)).count() == 0
    assert near.drop_near(frame(DOCS)).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j] + 1, after[-1] + 1, row[j - 1] + (x != y)))
        row = after
    return row[-1]


def test_the_automaton_knows_one_edit():
    rng, words = random.Random(13), ["idiot", "moron", "scum", "abcde", "abcdefgh"]
    automaton = toxicity.Automaton(words, ["stem"])
    for _ in range(4000):
        word = list(rng.choice(words))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choices("abcdefioq", k=rng.randint(0, 1))
        word = "".join(word)
        want = 1 if word in words else -1 if any(edits(word, w) == 1 and len(w) >= toxicity.FUZZY_FROM for w in words) else 0
        assert automaton.match(word) == want, word
    assert automaton.match("stemming") == automaton.match("stem") == 1 and automaton.match("ste") == 0


def test_stems_are_met_with_one_edit():
    """A word's beginning equals a stem, or is one edit away and ends in the stem's last letter."""
    stems, rng = ["stupid", "abcba"], random.Random(19)
    automaton = toxicity.Automaton(["fool"], stems)
    for word in ("stuupidity", "stpidity", "stupiid", "stupd", "xstupid", "sstupids", "ztupidly"):
        assert automaton.match(word) == -1, word
    assert automaton.match("stupidity") == automaton.match("fool") == 1
    assert [automaton.match(w) for w in ("stupi", "stupor", "stup", "", "tpid", "foool")] == [0] * 6
    for _ in range(4000):
        word = "".join(rng.choices("abc", k=rng.randint(0, 9)))
        begins = [word[:k] for k in range(1, len(word) + 1)]
        near_one = any(edits(b[:-1], s[:-1]) == 1 and b[-1] == s[-1] for b in begins for s in stems)
        want = 1 if any(word.startswith(s) for s in stems) else -1 if near_one else 0
        assert automaton.match(word) == want, word


def test_without_a_term_nothing_is_toxic(frame):
    """Mostly toxic labels and no word that tells: no text is dropped, null and empty ones neither."""
    docs = frame(DOCS, *[(i, f"w{i} v{i}") for i in range(12)], (20, None), (21, ""))
    labels = frame("doc_id long, quality int, toxic int", *[(i, 1, int(i > 1)) for i in range(12)])
    model = toxicity.fit(docs, labels)
    assert model.words == model.stems == [] and model.weights is None
    assert toxicity.drop_toxic(docs, model).count() == 14
    assert all(r.score == 0 and r.predicted == 0 for r in toxicity.score(docs, model).collect())


def test_scores_of_quality_do_not_depend_on_the_batch(frame):
    rng, weights = random.Random(20), np.random.default_rng(20).normal(size=quality.SIZE + 1)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 900])))) for i in range(60)] + [(60, None), (61, "x y " * 50_000)]
    alone = {r.doc_id: r.score for row in rows[::9] for r in quality.score(frame(DOCS, row), weights).collect()}
    together = {r.doc_id: r.score for r in quality.score(frame(DOCS, *rows).coalesce(1), weights).collect()}
    assert len(together) == 62 and all(together[i] == s for i, s in alone.items())


def plain_score(text, weights):
    """Features and score of one text, without the shared arrays of a batch."""
    place, value, _ = quality.features(pa.array([text]))
    return 1 / (1 + np.exp(-(sum(weights[p] * v for p, v in zip(place, value)) + weights[quality.SIZE])))


def test_quality_scores_equal_a_plain_sum(frame):
    weights = np.random.default_rng(21).normal(size=quality.SIZE + 1)
    rows = [(1, "Some words, some Words 12"), (2, ""), (3, "a b a b a b"), (4, "élan vital")]
    got = {r.doc_id: r.score for r in quality.score(frame(DOCS, *rows), weights).collect()}
    assert all(got[i] == pytest.approx(plain_score(t, weights)) for i, t in rows)


def test_quotation_is_told_from_abuse():
    model = toxicity.Model(["idiot"], [], None)
    assert model.features("you idiot, 1diot and idoit or idito idiott")[:4] == pytest.approx(np.log1p([1, 2, 0, 0]))
    assert model.features('they said "you idiot" there')[:4] == pytest.approx(np.log1p([0, 0, 1, 0]))
    assert model.features('an open " idiot')[:4] == pytest.approx(np.log1p([1, 0, 0, 0]))
    assert model.features("„idiot“ and «idiot» idiot")[:4] == pytest.approx(np.log1p([1, 0, 2, 0]))


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"wo{c}{d}r" for c in "abcdefghij" for d in "klmnopqrst"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 80))
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(["nasty", "vile", "rotten"]))
        if not good:
            words = [w + " |" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, good, toxic))
    return rows, labels


def test_classifiers_on_held_out_rows(frame):
    rows, labels = corpus(14, 500)
    extra = [(1000, None), (1001, ""), (None, "vile rotten nasty vile"), (5, rows[5][1])]
    docs = frame("doc_id long, text string, label int, score int", *[(*r, 1, 1) for r in rows + extra])
    known = frame("doc_id long, quality int, toxic int, text string", *[(*r, "t") for r in labels], (None, 1, 1, "t"), (3, None, None, "t"))
    truth = {i: (good, toxic) for i, good, toxic in labels}
    model = toxicity.fit(docs, known)
    assert {"nasty", "vile", "rotten"} <= set(model.words)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert len(held) > 60 and all(r.predicted == truth[r.doc_id][1] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got)
    got = quality.score(docs, quality.fit(docs, known)).collect()
    right = [r.predicted == truth[r.doc_id][0] for r in got if r.held_out and r.doc_id < 1000]
    assert len(got) == len(rows) + len(extra) and sum(right) >= 0.97 * len(right)


def test_held_out_labels_are_not_learned(frame):
    rows, labels = corpus(15, 300)
    docs = frame(DOCS, *rows)
    out = {r.doc_id for r in docs.where(held_out()).collect()}
    turned = [(i, 1 - g, 1 - t) if i in out else (i, g, t) for i, g, t in labels]
    one, two = (frame("doc_id long, quality int, toxic int", *x) for x in (labels, turned))
    assert rows_of(toxicity.score(docs, toxicity.fit(docs, one))) == rows_of(toxicity.score(docs, toxicity.fit(docs, two)))
    assert (quality.fit(docs, one) == quality.fit(docs, two)).all()


def test_classifiers_without_rows(frame):
    none, some = frame(DOCS), frame(DOCS, (1, "a b"), (2, "c"))
    no_labels = frame("doc_id long, quality int, toxic int")
    one_kind = frame("doc_id long, quality int, toxic int", (1, 1, 0), (2, 1, 0))
    for docs, labels in ((none, no_labels), (some, no_labels), (some, one_kind), (none, one_kind)):
        assert all(r.score == 0 for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect())
        assert quality.score(docs, quality.fit(docs, labels)).count() == docs.count()


def test_words_of_slices():
    texts = ["a b  c", None, "", "\n", "b", "a b c d e " * 300]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    hasher, seen = Hasher(1), []
    for part in slices([batch], "text", 10):
        data, at = flat(part.column("text"))
        starts, ends, first = spans(data, at, ASCII_SPACE)
        h = hasher.words(data, starts, ends)
        seen += [h[a:b].tolist() for a, b in zip(first, first[1:])]
    assert [len(s) for s in seen] == [len((t or "").split()) for t in texts]
    assert seen[0][1] == seen[4][0] and len({x for s in seen for x in s}) == 5


def test_pipeline_stage_by_stage(spark, frame, tmp_path):
    rows, labels = corpus(16, 300)
    rng = random.Random(17)
    rows += [(400 + k, rows[k][1]) for k in range(20)]
    for k in range(20, 40):
        words = rows[k][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((400 + k, " ".join(words)))
    item = " ".join(f"bench{i}" for i in range(20))
    rows += [(500, f"some words {item} more"), (501, None), (502, "")]
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", *[(*r, "en", "s", len(r[1] or "")) for r in rows])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame("doc_id long, quality int, toxic int", *labels).write.parquet(f"{tmp_path}/labels.parquet")
    frame("item_id long, text string", (1, item)).write.parquet(f"{tmp_path}/benchmark.parquet")

    now = {i: t or "" for i, t in rows}
    toxic = {i for i, t in now.items() if {"nasty", "vile", "rotten"} & set(t.split())}
    now = {i: t for i, t in now.items() if i not in toxic}
    now = {i: t for i, t in now.items() if i == max(j for j, u in now.items() if u == t)}
    classes = plain_classes(sorted(now.items()))
    now = {i: t for i, t in now.items() if classes[i] == i and i != 500}
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(r.doc_id for r in done.collect()) == sorted(now)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
