"""BPE, windows, shards and overlaps against plain Python and the public tokenizer."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.conftest import rows_of
from usagelake.llm import bpe, decontam, sharding, substrings
from usagelake.llm.queries import tokens

DOCS = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_tokenizer(reference):
    coder, rng = bpe.Coder(bpe.load_ranks(PATH), public_tokenizers.PATTERN), random.Random(5)
    signs = [chr(i) for i in (*range(0x180), *range(0x2000, 0x2070), 0x3000, 0x4E2D, 0x1F600, 0x660, 0x301)]
    cases = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(500)]
    cases += ["=" * 3000, " " * 999 + "x", "the" * 700, "".join(rng.choices("abcdefgh", k=5000)), "don't <|endoftext|> it's"]
    for text in cases:
        assert coder.encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_digests(frame, reference):
    rows = [(1, "Hello  world\n"), (2, None), (3, ""), (1, "Hello  world\n"), (None, "ñandú"), (9, "a b " * 9000)]
    docs = frame("doc_id long, text string, ids int, bytes int", *[(*r, 1, 2) for r in rows])
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert rows_of(tokens(docs)) == sorted(want, key=key)
    assert tokens(frame(DOCS)).count() == 0


def test_an_unknown_id_is_an_error(frame):
    with pytest.raises(Exception, match="no piece"):
        bpe.decode(frame("doc_id long, ids array<int>", (1, [1 << 30])), bpe.load_ranks(PATH)).collect()


def plain_windows(rows, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in sorted(((i, w) for i, w in words if i is not None), key=lambda x: x[0]):
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize(("size", "letters"), [(4, "ab"), (5, "abc"), (10, "abcdefgh"), (2, "abcd")])
def test_windows_equal_brute_force(frame, size, letters):
    rng = random.Random(size)
    passage = rng.choices(letters, k=3 * size)
    rows = []
    for i in range(40):
        words = rng.choices(letters, k=rng.randint(0, 5 * size))
        at = rng.randint(0, len(words))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words[:at] + passage[rng.randint(0, size) :] + words[at:])))
    rows += [(40, rows[3][1]), (41, None), (42, ""), (43, " \n"), (7, rows[9][1]), (None, rows[5][1]), (3, rows[3][1])]
    docs = frame("doc_id long, text string, tag string, span int", *[(*r, "t", 1) for r in rows])
    assert rows_of(substrings.cut_repeats(docs, size)) == plain_windows(rows, size)


def test_windows_of_an_empty_table(frame):
    assert substrings.cut_repeats(frame(DOCS)).count() == 0


def test_differencing_balances():
    rng = random.Random(6)
    sizes = sorted((int(rng.paretovariate(1.2) * 1000) for _ in range(3000)), reverse=True)
    shard = sharding.difference(sizes, 16)
    sums = [sum(s for s, k in zip(sizes, shard) if k == j) for j in range(16)]
    assert max(sums) - min(sums) <= max(sizes[0] - sum(sizes) // 16, 0) * 2 + 0.001 * sum(sizes)
    assert sorted(sharding.difference([8, 7, 6, 5, 4], 2)) in ([0, 0, 0, 1, 1], [0, 0, 1, 1, 1])
    assert sharding.difference([], 4) == [] and sharding.difference([5], 4) == [0]


def plain_difference(sizes, shards):
    """Largest differencing with all parts written out."""
    sets = [[-s, i, [(s, {i})] + [(0, set())] * (shards - 1)] for i, s in enumerate(sizes)]
    while len(sets) > 1:
        sets.sort(key=lambda x: x[:2])
        (_, _, one), (_, tie, two) = sets[:2]
        parts = sorted(((a + b, x | y) for (a, x), (b, y) in zip(one, two[::-1])), key=lambda p: -p[0])
        sets = [[parts[-1][0] - parts[0][0], tie, parts], *sets[2:]]
    return [next(k for k, (_, own) in enumerate(sets[0][2]) if i in own) for i in range(len(sizes))]


@pytest.mark.parametrize("shards", [1, 2, 3, 8, 50])
def test_differencing_equals_brute_force(shards):
    rng = random.Random(shards)
    for n in (1, 2, 7, 40):
        sizes = [rng.randint(1, 30) for _ in range(n)]
        assert sharding.difference(sizes, shards) == plain_difference(sizes, shards)


def test_more_shards_than_a_block_has_places(frame, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 16)
    rows = [(i, f"text {i}") for i in range(400)] + [(None, "a"), (None, "a"), (900, "long " * 40_000)]
    got = sharding.shards_by_bytes(frame(DOCS, *rows), 12).collect()
    assert len(got) == 403 and {r.shard for r in got} <= set(range(12)) and len({r.shard for r in got if r.doc_id is None}) == 1


def test_shards_of_several_levels(frame, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 64)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 100)
    rng = random.Random(7)
    rows = [(i, "x" * rng.randint(0, 400) + str(i % 700)) for i in range(1500)] + [(1500, None), (1501, ""), (1, "rep"), (1, "rep")]
    got = sharding.shards_by_bytes(frame("doc_id long, text string, shard int, size int", *[(*r, 0, 0) for r in rows]), 8).collect()
    assert len(got) == len(rows)
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    sums = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert max(sums) - min(sums) < 0.03 * sum(sums) / 8
    texts, home = {(i, zlib.crc32((t or "").encode())): t or "" for i, t in rows}, {}
    for r in got:
        text = texts[r.doc_id, r.text_crc32]
        assert r.size == len(text) + 1 and home.setdefault(text, r.shard) == r.shard
    assert sharding.shards_by_bytes(frame(DOCS), 8).count() == 0


def plain_overlap(text, item, window=13, share=0.75):
    split = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
    a, b = split(text), split(item)
    size = min(window, len(b))
    return size > 0 and any(
        sum(x == y for x, y in zip(a[i : i + size], b[j : j + size])) >= share * size
        for i in range(len(a) - size + 1) for j in range(len(b) - size + 1))


def test_overlaps_equal_brute_force(frame):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 6, 8, 12, 20, 40])))) for k in range(30)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            passage = rng.choice(items)[1].split()
            for k in rng.sample(range(len(passage)), len(passage) // 10):
                passage[k] = "OTHER"
            at = rng.randint(0, len(words))
            words = words[:at] + [w.upper() + "," for w in passage] + words[at:]
        rows.append((i, " ".join(words)))
    docs = frame("doc_id long, text string, item_id int", *[(*r, 1) for r in rows], (500, None, 1), (501, "", 1))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, frame("item_id long, text string", *items, (90, None), (91, " "))).collect()}
    want = {(i, k) for i, t in rows for k, item in items if plain_overlap(t, item)}
    assert got == want
    kept = decontam.drop_contaminated(docs, frame("item_id long, text string", *items))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want} | {500, 501}


@pytest.mark.parametrize(("window", "share"), [(13, 0.75), (10, 0.6)])
def test_every_admitted_substitution_is_found(window, share):
    for n in range(1, 15):
        item = [f"i{j}" for j in range(n)]
        most = int(min(n, window) * (1 - share) + 1e-9)
        texts = [" ".join("x" if j in gone else w for j, w in enumerate(item))
                 for k in range(most + 1) for gone in itertools.combinations(range(n), k)]
        found = decontam.Index([n], pa.array([" ".join(item)]), window, share).overlaps(pa.array(texts), window, share)
        assert {t for t, *_ in found} == set(range(len(texts)))


def test_items_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    items = [(k, " ".join(f"t{k}n{j}" for j in range(20))) for k in range(12)]
    docs = frame(DOCS, *[(k, f"so {text} on") for k, text in items], (99, "none of them"))
    got = rows_of(decontam.contaminated(docs, frame("item_id long, text string", *items)).select("doc_id", "item_ids", "n_words"))
    assert got == sorted(((k, [k], 20) for k, _ in items), key=lambda r: str(r[0]))


def test_no_items(frame):
    docs, none = frame(DOCS, (1, "a b c")), frame("item_id long, text string")
    assert decontam.contaminated(docs, none).count() == 0
    assert decontam.drop_contaminated(docs, none).count() == 1
    assert decontam.contaminated(frame(DOCS), frame("item_id long, text string", (1, "a b c"))).count() == 0


def test_hits_outside_a_text_don_t_count():
    index = decontam.Index([1], pa.array(["one two three four five six seven"]))
    assert index.overlaps(pa.array(["x one two three four", "five six seven y"]), 13, 0.75) == []
