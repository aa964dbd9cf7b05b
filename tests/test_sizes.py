"""Time joins deal their rows once: long keys by buckets, others whole, and not at all where the other table is small."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.operators import temporal as X
from usagelake.session import settle

LEFT = "id int, key string, own string, at date"
RIGHT = "uid string, k string, acc string, s date, e date"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(n):
    return None if n is None else date(2024, 1, 1) + timedelta(days=n)


def sides(seed):
    rng = random.Random(seed)
    left = [(i, rng.choice(["x", "x", "y", None]), rng.choice(["p", "q", "r", None]), rng.choice([None, *range(40)])) for i in range(90)]
    right = [(f"u{i:02}", rng.choice(["x", "x", "y", "z", None]), rng.choice(["p", "q", "r", None]), a, a + rng.randint(0, 12))
             for i in range(40) for a in [rng.randint(0, 40)]]
    return left, right


def frames(frame, left, right, stored=False):
    l = frame(LEFT, *[(i, k, o, day(a)) for i, k, o, a in left])
    r = frame(RIGHT, *[(u, k, o, day(a), day(b)) for u, k, o, a, b in right])
    return l, settle(r) if stored else r


@pytest.mark.parametrize("rows, stored", [(4096, False), (3, False), (4096, True)])
@pytest.mark.parametrize("direction, inclusive", [("previous", True), ("previous", False), ("next", True), ("next", False)])
def test_asof_by_whole_keys_by_buckets_and_by_steps(frame, monkeypatch, rows, stored, direction, inclusive):
    monkeypatch.setattr(X, "HOT_ROWS", rows)
    left, right = sides(5)
    l, r = frames(frame, left, right, stored)
    got = X.asof_join(l, r, {"key": "k"}, at="at", time="s", take={"uid": "uid"}, tie=["uid"], direction=direction, inclusive=inclusive, bucket="6 days")
    want = []
    for i, k, o, at in left:
        back = direction == "previous"
        hits = [(a, u) for u, rk, _, a, _ in right if None not in (k, at) and rk == k and (a < at if back else a > at) or inclusive and at is not None and k and rk == k and a == at]
        want.append((i, k, o, day(at), (max(hits) if back else min(hits))[1] if hits else None))
    assert rows_of(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("rows, stored", [(4096, False), (3, False), (4096, True)])
def test_intervals_by_whole_keys_by_buckets_and_by_steps(frame, monkeypatch, rows, stored):
    monkeypatch.setattr(X, "HOT_ROWS", rows)
    left, right = sides(6)
    l, r = frames(frame, left, right, stored)
    got = X.interval_join(l, r, {"key": "k"}, at="at", start="s", end="e", closed="both", tie=["uid"], take={"uid": "uid"}, bucket="6 days",
                          prefer=[F.col("acc") == "p", F.coalesce(F.col("acc") != "p", F.lit(True))])
    want = []
    for i, k, _, at in left:
        hits = [(acc == "p", e, u) for u, rk, acc, s, e in right if None not in (k, at) and rk == k and s <= at <= e]
        want.append((i, max(hits)[2] if hits else None))
    assert rows_of(got, "id", "uid") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("rows", [4096, 3])
def test_other_owners_by_whole_keys_and_by_buckets(frame, monkeypatch, rows):
    monkeypatch.setattr(X, "HOT_ROWS", rows)
    left, right = sides(7)
    l, r = frames(frame, left, right)
    got = X.other_owner_join(l, r, {"key": "k"}, at="at", start="s", end="e", owner={"own": "acc"}, tie=["uid"],
                             take={"uid": "uid", "whose": "acc", "till": "e", "word": F.concat("uid", F.lit("!"))}, bucket="6 days")
    want = []
    for i, k, own, at in left:
        fits_ = [(-e, u, acc) for u, rk, acc, s, e in right if None not in (k, own, acc, at) and rk == k and acc != own and s <= at <= e]
        best = min(fits_) if fits_ else None
        want.append((i, k, own, day(at), *((best[1], best[2], day(-best[0]), best[1] + "!") if best else (None,) * 4)))
    assert rows_of(got) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_time_joins_deal_their_rows_once(frame):
    l, r = frames(frame, *sides(8))
    within = X.interval_join(l, r, {"key": "k"}, at="at", start="s", end="e", take={"uid": "uid"})
    other = X.other_owner_join(l, r, {"key": "k"}, at="at", start="s", end="e", owner={"own": "acc"}, take={"uid": "uid"})
    assert [plan(x).count("Exchange hashpartitioning") for x in (within, other)] == [1, 1]


def test_a_small_table_comes_to_the_rows(frame):
    l, r = frames(frame, *sides(9), stored=True)
    within = X.interval_join(l, r, {"key": "k"}, at="at", start="s", end="e", take={"uid": "uid"})
    assert "hashpartitioning(key" not in plan(within) and "_spread" not in plan(within) and "BroadcastHashJoin" in plan(within)
