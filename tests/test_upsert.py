"""Upserts: modes, both physical paths, duplicate sources, replay."""

import pytest

from tests.conftest import rows_of
from usagelake.operators import upsert as U

SCHEMA = "k int, ts int, v string"


@pytest.fixture(params=[1 << 40, 0], ids=["broadcast", "shuffle"])
def limit(request):
    return {"broadcast_limit": request.param}


@pytest.fixture
def sides(frame):
    return frame(SCHEMA, (1, 5, "a"), (2, 5, "b"), (3, 5, None)), frame(SCHEMA, (2, 9, None), (3, 1, "z"), (4, 1, "n"))


def test_modes(sides, limit):
    t, s = sides
    assert rows_of(U.insert_only(t, s, ["k"], **limit)) == [(1, 5, "a"), (2, 5, "b"), (3, 5, None), (4, 1, "n")]
    assert rows_of(U.update_if_newer(t, s, ["k"], "ts", **limit)) == [(1, 5, "a"), (2, 9, None), (3, 5, None), (4, 1, "n")]
    assert rows_of(U.scd1(t, s, ["k"], keep=["ts"], **limit)) == [(1, 5, "a"), (2, 5, None), (3, 5, "z"), (4, 1, "n")]
    assert rows_of(U.update_if_changed(t, s, ["k"], ["v"], **limit)) == [(1, 5, "a"), (2, 5, None), (3, 5, "z"), (4, 1, "n")]
    assert rows_of(U.keep_nulls_out(t, s, ["k"], ["v"], **limit)) == [(1, 5, "a"), (2, 5, "b"), (3, 5, "z")]
    assert rows_of(U.fill_if_null(t, s, ["k"], {"v": "v"}, **limit)) == [(1, 5, "a"), (2, 5, "b"), (3, 5, "z")]
    assert rows_of(U.set_status(t, s, ["k"], "v", "done", allowed_from=["b"], **limit)) == [(1, 5, "a"), (2, 5, "done"), (3, 5, None)]


@pytest.mark.parametrize("mode", [lambda t, s, o: U.insert_only(t, s, ["k"], **o), lambda t, s, o: U.scd1(t, s, ["k"], **o),
                                  lambda t, s, o: U.update_if_newer(t, s, ["k"], "ts", **o)])
def test_replay_changes_nothing(sides, limit, mode):
    t, s = sides
    once = mode(t, s, limit)
    assert rows_of(mode(once, s, limit)) == rows_of(once)


def test_repeated_source_key_fails(sides, frame, limit):
    t, _ = sides
    with pytest.raises(Exception, match="more than one source row"):
        U.scd1(t, frame(SCHEMA, (2, 1, "x"), (2, 2, "y")), ["k"], **limit).collect()


def test_null_keys(frame, limit):
    t, s = frame("k string, v int", (None, 1), ("a", 1)), frame("k string, v int", (None, 2), ("b", 2))
    assert rows_of(U.scd1(t, s, ["k"], null_safe=True, **limit)) == [("a", 1), ("b", 2), (None, 2)]
    assert rows_of(U.scd1(t, s, ["k"], **limit)) == [("a", 1), ("b", 2), (None, 1), (None, 2)]


def test_accumulate_and_versions(frame, limit):
    t = frame("k int, n bigint, ids string", (1, 2, "a, b"), (2, 1, None))
    s = frame("k int, n bigint, ids string", (1, 3, "c, b"), (3, 1, "z"))
    assert rows_of(U.accumulate(t, s, ["k"], add=["n"], merge_sets=["ids"], **limit)) == [(1, 5, "a, b, c"), (2, 1, None), (3, 1, "z")]
    target = frame("id string, note string, version int", ("a", "x", 1), ("b", "x", 1))
    new = frame("id string, note string, replaces string", ("a2", "moved", "a"))
    assert rows_of(U.version_bump(target, new, "id", replaces="replaces", update={"note": "note"})) == [
        ("a", "moved", 2), ("a2", "moved", 1), ("b", "x", 1)]


def test_missing_and_unknown_columns(frame):
    t, s = frame("k int, a int, b int", (1, 1, 1)), frame("k int, a int", (2, 2))
    assert rows_of(U.insert_only(t, s, ["k"])) == [(1, 1, 1), (2, 2, None)]
    with pytest.raises(ValueError):
        U.upsert(t, s, ["k"], update={"zz": "s.a"})


def test_null_keys_of_the_source_may_repeat(frame, limit):
    t, s = frame("k string, v int", ("a", 1)), frame("k string, v int", (None, 2), (None, 2), (None, 3), ("a", 5))
    assert rows_of(U.scd1(t, s, ["k"], **limit)) == [("a", 5), (None, 2), (None, 2), (None, 3)]
    with pytest.raises(Exception, match="more than one source row"):
        U.scd1(t, s, ["k"], null_safe=True, **limit).collect()


def test_insert_only_takes_repeats(frame, limit):
    t, s = frame("k string, v int", ("a", 1)), frame("k string, v int", ("b", 2), ("b", 3), ("a", 9), (None, 4))
    assert rows_of(U.insert_only(t, s, ["k"], **limit)) == [("a", 1), ("b", 2), ("b", 3), (None, 4)]


def test_accumulate_with_any_separator_and_missing_counters(frame, limit):
    schema = "k int, n bigint, ids string"
    t = frame(schema, (1, None, "x|z"), (2, 4, None), (3, None, None), (4, 1, "it's"))
    s = frame(schema, (1, 3, "y|x"), (2, None, "q"), (3, None, None), (4, 1, "b"))
    got = U.accumulate(t, s, ["k"], add=["n"], merge_sets=["ids"], separator="|", **limit)
    assert rows_of(got) == [(1, 3, "x|y|z"), (2, 4, "q"), (3, None, None), (4, 2, "b|it's")]


def test_status_values_are_quoted(frame, limit):
    t, s = frame("k int, v string", (1, "o'k"), (2, "b\\c")), frame("k int", (1,), (2,))
    assert rows_of(U.set_status(t, s, ["k"], "v", "it's \\ done", allowed_from=["o'k", "b\\c"], **limit)) == [(1, "it's \\ done"), (2, "it's \\ done")]
