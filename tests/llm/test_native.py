"""Chunk recipes, URL classes, line runs and components against plain Python."""

import hashlib
import random

import pytest

from tests.conftest import rows_of
from usagelake.llm import line_runs, recipes, urls
from usagelake.llm.common import Scratch
from usagelake.llm.components import components

DOCS = "doc_id long, text string"


def texts(seed, n, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(1, words))) for _ in range(n // 2)]
    return [(i, rng.choice(base)) for i in range(n)]


def test_recipes_equal_a_plain_grouping(frame):
    rows = texts(1, 60, 900) + [(100, None), (101, ""), (102, "é" * 9000), (103, "é" * 9000 + "x"), (104, "é" * 9000)]
    got = rows_of(recipes.exact_groups(frame(DOCS, *rows)).drop("n_chunks"))
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t or "", []).append(i)
    want = sorted((i, max(g), len(g), i == max(g), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t in rows for g in [by_text[t or ""]])
    assert sorted(got) == want


def test_chunks_join_to_the_text(frame):
    rows = texts(2, 10, 3000) + [(50, "x" * 20000), (51, "a\n" * 5000), (52, "\U0001f600" * 700)]
    from pyspark.sql import functions as F

    back = frame(DOCS, *rows).select(
        "doc_id", F.array_join(F.regexp_extract_all("text", F.lit(recipes.CHUNK), F.lit(0)), "").alias("t"))
    assert dict(rows_of(back)) == dict(rows)


def test_copies_are_dropped_and_columns_stay(frame):
    docs = frame("doc_id long, text string, sha string, row int, `a.b` int", (1, "x", "p", 1, 1), (2, "x", "q", 2, 2),
                 (2, "x", "q", 2, 2), (3, None, None, None, 3), (4, "", "z", 1, 4), (None, "y", None, None, None), (5, "y", "k", 0, 0))
    kept = recipes.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]


@pytest.mark.parametrize("call", [recipes.exact_groups, recipes.drop_copies, line_runs.cut_runs])
def test_empty_tables(frame, call):
    assert call(frame(DOCS)).count() == 0


def test_components(spark, frame):
    rng = random.Random(3)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)] + [(7, None), (8, 8)]
    got = dict(rows_of(components(frame("a long, b long", *edges), Scratch(spark, "test"))))
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in parent}


RULES = (("allow", "org", "/"), ("block", "bad.org", "/x"), ("block", "spam.com", "/"), ("allow", "good.net", "/ok/"))


def judged(frame, *rows, redirects=None):
    pages = frame("page_id long, url string, html string, host string, rule int", *[(*r, "h", 1) for r in rows])
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, RULES, redirects).collect()}


def test_rules_and_edges_of_urls(frame):
    got = judged(
        frame, (1, "https://A.Bad.ORG/x1?q", None), (2, "http://bad.org", ""), (3, None, "x"), (4, "no url", "x"),
        (5, "ftp://sub.spam.com/a#b", ""), (6, "http://notspam.com/a", ""), (7, "http://h?x://y/z", ""))
    assert got[1] == ("a.bad.org", "/x1", "bad.org/x", "block")
    assert got[2] == ("bad.org", "", None, "allow")
    assert got[3] == got[4] == ("", "", None, "allow")
    assert got[5] == ("sub.spam.com", "/a", "spam.com/", "block")
    assert got[6] == ("notspam.com", "/a", None, "allow")
    assert got[7] == ("h", "", None, "allow")


def test_blocks_reach_aliases_and_allows_come_first(frame):
    got = judged(
        frame,
        (1, "http://alias.net/1", '<LINK href="http://spam.com/p" rel="canonical">'),
        (2, "http://far.net/2", '<meta http-equiv="refresh" content="0; url=http://alias.net/1#top">'),
        (3, "http://safe.net/3", '<link rel=canonical href=http://spam.com/q>'),
        (4, "http://good.net/ok/4", '<link rel="canonical" href="http://spam.com/q">'),
        (5, "http://alone.net/5", '<a href="http://spam.com/p">x</a>'),
        (6, "https://ALIAS.net/1/?utm_source=a&ref=b", ""),
        (7, "http://rel.net/a/b", '<link rel="canonical" href="/other">'),
        (8, "http://rel.net/other", ""),
        redirects=frame("url string, target string", ("http://rel.net/other", "http://spam.com/z"), (None, "x"), ("http://q.net/", None)),
    )
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "block"}


def plain_lines(rows, least=2):
    first, out = {}, []
    split = [(i, (t or "").split("\n")) for i, t in rows]
    full = {i: [k for k, line in enumerate(lines) if line.strip(" ")] for i, lines in split}
    for i, lines in sorted(split):
        for n in range(len(full[i]) - least + 1):
            first.setdefault(tuple(lines[k] for k in full[i][n : n + least]), (i, n))
    for i, lines in split:
        gone = set()
        for n in range(len(full[i]) - least + 1):
            if first[tuple(lines[k] for k in full[i][n : n + least])] != (i, n):
                gone.update(full[i][n : n + least])
        out.append((i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return sorted(out)


@pytest.mark.parametrize("level", [0, 1, 2])
def test_line_runs_equal_brute_force(frame, level):
    rng = random.Random(level)
    rows = [(i, "\n".join(rng.choices(["a", "b", "c", "", "  ", "dd"], k=rng.randint(0, 14)))) for i in range(40)]
    rows += [(50, None), (51, rows[3][1]), (52, "\n".join("xyz" * 4)), (53, "x\n" * 9)]
    assert sorted(rows_of(line_runs.cut_runs(frame(DOCS, *rows), level))) == plain_lines(rows, 2**level)


def test_runs_have_full_length_and_depth(frame):
    lines = [f"line {i}" for i in range(9)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new", *lines[1:8], "end"])), (None, "\n".join(lines))]
    got = line_runs.repeated_runs(frame(DOCS, *rows)).drop("tag")
    assert rows_of(got) == [(2, 1, 7, 4)]
