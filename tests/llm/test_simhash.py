"""Fingerprints bit by bit, and components against all pairs."""

import random
import re

import pytest
import xxhash

from tests.conftest import rows_of
from usagelake.llm import simhash
from usagelake.llm.common import Scratch
from usagelake.llm.words import segments

DOCS = "doc_id long, text string"


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    """marks: node -> fingerprint; node -> least node reachable."""
    nodes = sorted(marks)
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {n: top(n) for n in nodes}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice("abcdefgh")
    return " ".join(words)


def documents(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(6):
        base = [f"{rng.choice('QWERTY')}w{rng.randint(0, 400)}" for _ in range(rng.choice([30, 120, 400]))]
        out += [edited(rng, base, n) for n in (0, 0, 1, 1, 2, 3)]
    return list(enumerate(out)) + [(90, None), (91, ""), (92, " \n"), (93, "One two"), (94, "one\ttwo"), (95, "É a b c d e"),
                                   (96, "é a b c d e"), (97, "a " * 40_000)]


def test_fingerprint_bit_by_bit():
    for _, text in documents(1):
        assert simhash.fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(3000))
    monkeypatch.setattr(simhash, "segments", lambda data, gaps: segments(data, gaps, 50))
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)
    assert b"".join(segments(text.encode(), b" ", 50)) == text.encode()


@pytest.mark.parametrize("large", [256, 2])
def test_components_equal_all_pairs(frame, large):
    rows = documents(2)
    got = {i: (f, c) for i, f, c in rows_of(simhash.near_components(frame(DOCS, *rows), large=large))}
    marks = {i: plain_fingerprint(t) for i, t in rows}
    want = plain_components(marks)
    assert got == {i: (f"{marks[i]:016x}", want[i]) for i in marks}
    assert len(set(want.values())) < len(set(marks.values()))


@pytest.mark.parametrize("large", [256, 4])
def test_links_of_a_dense_cloud(spark, frame, large):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    marks = {base}
    while len(marks) < 120:
        mark = base
        for b in rng.sample(range(64), rng.randint(1, 7)):
            mark ^= 1 << b
        marks.add(mark)
    low = sorted(simhash._signed(m) for m in marks)
    found = rows_of(simhash.links(frame("mark long", *[(m,) for m in low]), Scratch(spark, "test"), large))
    want = [(a, b) for a in low for b in low if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4]
    assert sorted(found) == sorted(want) and len(want) > 200


def test_ids_repeats_nulls_and_other_columns(frame):
    docs = frame("doc_id int, text string, mark string, fixed int, component_id int, `a.b` int",
                 (3, "a b c d e", "x", 1, 1, 1), (3, "a b c d e", "x", 1, 1, 1), (None, "A b c d e", None, None, None, None),
                 (None, "zz yy", None, None, None, None), (7, "a b c d e", "y", 2, 2, 2), (-2, "", "z", 0, 0, 0))
    out = simhash.near_components(docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    mark = f"{plain_fingerprint('a b c d e'):016x}"
    assert rows_of(out) == sorted([(3, mark, 3), (3, mark, 3), (None, mark, 3), (7, mark, 3), (-2, "0" * 16, -2),
                                   (None, f"{plain_fingerprint('zz yy'):016x}", None)], key=lambda r: tuple((v is None, str(v)) for v in r))


def test_empty_table(frame):
    assert simhash.near_components(frame(DOCS)).count() == 0
