"""Time-aware joins against brute force, with overlaps, ties, null keys and a hot key."""

import random
from datetime import date, datetime, timedelta

import pytest

from tests.conftest import rows_of
from usagelake.operators import temporal as X


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    key = lambda: "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
    left = [(i, key(), day(rng.randrange(60)) if rng.random() > 0.05 else None) for i in range(150)]
    right = []
    for i in range(80):
        s = rng.randrange(60)
        right.append((i, key(), day(s), day(s + rng.randrange(0, 25)), rng.choice([0, 1])))
    L = spark.createDataFrame(left, "id int, key string, at date")
    R = spark.createDataFrame(right, "rid int, key string, start date, end date, lane int")
    L.persist().count(), R.persist().count()
    return L, R, left, right


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("bucket", ["5 days", "365 days"])
def test_interval_join_takes_the_latest_end(sides, closed, bucket):
    L, R, left, right = sides
    got = X.interval_join(L, R, ["key"], at="at", start="start", end="end", closed=closed, tie=["rid"], take={"rid": "rid"}, bucket=bucket)
    want = []
    for i, k, t in left:
        hits = [r for r in right if k and t and r[1] == k and r[2] <= t and (t < r[3] if closed == "left" else t <= r[3])]
        want.append((i, max(hits, key=lambda r: (r[3], r[0]))[0] if hits else None))
    assert set(rows_of(got, "id", "rid")) == set(want) and got.count() == len(want)


def test_preferred_lane_wins_even_if_it_ends_sooner(sides):
    from pyspark.sql import functions as F

    L, R, left, right = sides
    got = X.interval_join(L, R, ["key"], at="at", start="start", end="end", closed="both", tie=["rid"], take={"rid": "rid"},
                          prefer=[F.col("lane") == 0, F.col("lane") == 1], bucket="5 days")
    want = []
    for i, k, t in left:
        hits = [r for r in right if k and t and r[1] == k and r[2] <= t <= r[3]]
        want.append((i, min(hits, key=lambda r: (r[4], -r[3].toordinal(), -r[0]))[0] if hits else None))
    assert set(rows_of(got, "id", "rid")) == set(want) and got.count() == len(want)


@pytest.mark.parametrize("direction", ["previous", "next"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof(sides, direction, inclusive):
    L, R, left, right = sides
    got = X.asof_join(L, R, ["key"], at="at", time="start", take={"s": "start"}, direction=direction, inclusive=inclusive, bucket="5 days")
    want = set()
    for i, k, t in left:
        if direction == "previous":
            hits = [r[2] for r in right if k and t and r[1] == k and (r[2] < t or (inclusive and r[2] == t))]
            want.add((i, max(hits) if hits else None))
        else:
            hits = [r[2] for r in right if k and t and r[1] == k and (r[2] > t or (inclusive and r[2] == t))]
            want.add((i, min(hits) if hits else None))
    assert set(rows_of(got, "id", "s")) == want
    assert got.count() == len(left)


def test_range_join_keeps_all_matches_beyond_its_clamp(sides):
    L, R, left, right = sides
    got = X.range_join(L, R, ["key"], at="at", start="start", end="end", take={"rid": "rid"}, bucket="3 days",
                       origin="2024-01-10", horizon="2024-02-05", closed="both")
    want = {(i, r[0]) for i, k, t in left for r in right if k and t and r[1] == k and r[2] <= t <= r[3]}
    assert set(rows_of(got, "id", "rid")) == want and got.count() == len(want)


def test_containing_join_takes_the_latest_start(frame):
    inner = frame("id int, key string, a date, b date", (1, "x", day(5), day(8)), (2, "x", day(1), day(30)), (3, "x", day(4), day(8)))
    outer = frame("oid int, key string, s date, e date", (10, "x", day(0), day(40)), (11, "x", day(4), day(9)), (12, "x", day(2), day(7)))
    got = X.containing_join(inner, outer, ["key"], inner_start="a", inner_end="b", start="s", end="e", take={"oid": "oid"}, bucket="7 days")
    assert rows_of(got, "id", "oid") == [(1, 11), (2, 10), (3, 10)]


@pytest.mark.parametrize("span, strict", [(2, True), (3, False), (64, True)])
def test_containers_by_search_equal_all_pairs(frame, monkeypatch, span, strict):
    monkeypatch.setattr(X, "SPAN", span)
    rng = random.Random(span)
    inner = [(i, rng.choice(["x", "x", "y", None]), a, rng.choice([a + rng.randint(0, 9), None, a])) for i in range(80) for a in [rng.randint(0, 60)]]
    outer = [(i, rng.choice(["x", "x", "x", "y", None]), a, rng.choice([a + rng.randint(-2, 25), a + 3, None])) for i in range(120) for a in [rng.randint(0, 60)]]
    to = lambda rows: [(i, k, day(a), None if b is None else day(b)) for i, k, a, b in rows]
    got = X.containing_join(frame("id int, key string, a date, b date", *to(inner)), frame("oid int, k string, s date, e date", *to(outer)),
                            {"key": "k"}, inner_start="a", inner_end="b", start="s", end="e", take={"oid": "oid"}, bucket="7 days", strict=strict)
    want = []
    for i, k, a, b in inner:
        fits = [(-s, e, o) for o, ok, s, e in outer if None not in (k, b, e) and ok == k and s <= e and ((s < a and b < e) if strict else (s <= a and b <= e))]
        want += [(i, min(fits)[2])] if fits else []
    assert rows_of(got, "id", "oid") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r)) and want


def test_many_containers_make_no_pairs(spark, frame):
    """A key with 300 inner rows in each of 400 containers: no join gives more than a row per inner one."""
    inner = frame("id int, key string, a date, b date", *[(i, "x", day(500), day(501)) for i in range(300)])
    outer = frame("oid int, key string, s date, e date", *[(i, "x", day(i), day(1000 - i)) for i in range(400)])
    got = X.containing_join(inner, outer, ["key"], inner_start="a", inner_end="b", start="s", end="e", take={"oid": "oid"}, bucket="30 days")
    got.write.format("noop").mode("overwrite").save()
    plan = got._jdf.queryExecution().executedPlan()
    assert rows_of(got, "oid") == [(399,)] * 300
    assert "CartesianProduct" not in plan.toString() and "BroadcastNestedLoopJoin" not in plan.toString()
    assert all("_from" not in line for line in plan.toString().splitlines() if "Join" in line)  # equality on keys and blocks only


def test_other_owner_equals_all_pairs(frame):
    rng = random.Random(9)
    left = [(i, rng.choice(["x", "y", None]), rng.choice(["p", "q", "r", None]), rng.randint(0, 40)) for i in range(120)]
    right = [(f"u{i}", rng.choice(["x", "x", "y", None]), rng.choice(["p", "q", "r", None]), a, rng.choice([a + rng.randint(0, 12), a + 5]))
             for i in range(60) for a in [rng.randint(0, 40)]]
    got = X.other_owner_join(
        frame("id int, key string, own string, at date", *[(i, k, o, day(a)) for i, k, o, a in left]),
        frame("uid string, key string, acc string, s date, e date", *[(u, k, o, day(a), day(b)) for u, k, o, a, b in right]),
        ["key"], at="at", start="s", end="e", owner={"own": "acc"}, tie=["uid"], take={"uid": "uid"}, bucket="6 days")
    want = []
    for i, k, own, at in left:
        fits = [(-b, u) for u, rk, o, a, b in right if None not in (k, own, o) and rk == k and o != own and a <= at <= b]
        want.append((i, min(fits)[1] if fits else None))
    assert rows_of(got, "id", "uid") == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_scd2_tiles_each_key(sides):
    from pyspark.sql import functions as F

    _, R, _, right = sides
    one = R.groupBy("key", "start").agg(F.min("rid").alias("rid"))
    rows = rows_of(X.scd2_from_changes(one, "key", ["start"], start="start", bucket="5 days", with_load_order=True), "key", "start", "valid_to", "load_order")
    for k in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == k)
        for a, b in zip(mine, mine[1:]):
            assert a[2] == b[1]
        assert mine[-1][2] == date(2111, 11, 11)
        assert [r[3] for r in mine] == list(range(len(mine), 0, -1))


def test_pairs_gaps_and_previous_end(frame):
    t = lambda h: datetime(2024, 1, 1, h)
    starts = frame("k string, at timestamp", ("x", t(1)), ("x", t(3)), ("x", t(5)))
    ends = frame("k string, at timestamp", ("x", t(2)), ("x", t(4)))
    paired = X.pair_nth(starts, ends, ["k"], start_order=["at"], end_order=["at"], take={"done": "at"}, bucket="1 hour")
    assert rows_of(paired, "pair_no", "at", "done") == [(1, t(1), t(2)), (2, t(3), t(4)), (3, t(5), None)]
    numbers = frame("k string, n int", ("x", 1), ("x", 1), ("x", 4), ("x", 5), ("y", 9), ("y", None))
    assert rows_of(X.missing_numbers(numbers, ["k"], "n", bucket=2)) == [("x", 2), ("x", 3)]
    subs = frame("c string, s date, e date", ("x", day(0), day(10)), ("x", day(20), day(30)))
    assert rows_of(X.previous_end(subs, ["c"], start="s", end="e", gap_days=150), "s", "previous_end") == [
        (day(0), day(-150)), (day(20), day(10))]
