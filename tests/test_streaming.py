"""Streams equal batches; failed batches are captured and replayed; replays are harmless."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.operators.upsert import insert_only
from usagelake.sources import files as S
from usagelake.sources.snapshots import read_snapshot
from usagelake.streaming import runner as R

AT = datetime(2024, 1, 1)


def write_parts(frame, path, n=3):
    for i in range(n):
        frame("k int, v string", (i, f"v{i}"), (i + 1, f"v{i + 1}")).coalesce(1).write.mode("append").parquet(path)


def test_drain_equals_batch_and_resumes(spark, frame, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    write_parts(frame, src)
    schema = spark.read.parquet(src).schema
    empty = spark.read.parquet(src).limit(0)

    def merge(target, batch):
        return insert_only(target, batch.dropDuplicates(["k"]), ["k"])

    def run():
        R.drain(S.stream_table(spark, src, schema, max_files=1), R.upsert_batches(out, empty, merge), check)

    run()
    whole = spark.read.parquet(src).dropDuplicates(["k"])
    assert rows_of(read_snapshot(spark, out)) == rows_of(whole)
    frame("k int, v string", (9, "late")).coalesce(1).write.mode("append").parquet(src)
    run()
    assert rows_of(read_snapshot(spark, out)) == rows_of(spark.read.parquet(src).dropDuplicates(["k"]))


def test_chain_of_streams_over_an_appended_table(spark, frame, tmp_path):
    raw, mid, out = (str(tmp_path / n) for n in ("raw", "mid", "out"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "f.csv").write_text("1,2024-01-02,03:04:05.678,LOG,a,b,c,9,14020,{\"startts\": \"x\"}\n")
    R.drain(S.stream_header_json_lines(spark, raw), R.append_batches(mid), str(tmp_path / "c1"))
    table = spark.read.parquet(mid)
    second = S.stream_table(spark, f"{mid}/batch_id=*", table.drop("batch_id").schema)
    R.drain(second, R.append_batches(out, lambda b: b.select("contract", "file_name")), str(tmp_path / "c2"))
    assert rows_of(spark.read.parquet(out), "contract", "file_name") == [("14020", "f.csv")]
    R.append_batches(out, lambda b: b.select("contract", "file_name"))(table, 0)  # a replayed batch replaces itself
    assert spark.read.parquet(out).count() == 1


def test_failed_batch_is_captured_and_replayed(spark, frame, tmp_path):
    seen, fail = [], {"on": True}

    def job(batch, batch_id):
        if fail["on"]:
            raise RuntimeError("no disk")
        seen.extend(rows_of(batch))

    wrapped = R.with_capture(job, "cycles", str(tmp_path / "log"), lambda: AT)
    schema = "k int, at timestamp"
    wrapped(frame(schema, (1, AT)), 0)
    log = read_snapshot(spark, f"{tmp_path}/log/stage=cycles")
    assert rows_of(log, "status", "error_message") == [("Failed", "RuntimeError: no disk")]
    wrapped(frame(schema, (2, AT)), 1)  # fails again: both batches are kept
    assert read_snapshot(spark, f"{tmp_path}/log/stage=cycles").count() == 2
    fail["on"] = False
    wrapped(frame(schema, (3, AT)), 2)
    assert sorted(seen) == [(1, AT), (2, AT), (3, AT)]
    wrapped(frame(schema, (4, AT)), 3)
    assert sorted(seen)[-1] == (4, AT) and len(seen) == 4


def test_delimited_stream_and_trigger(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("1,x\n")
    got = []
    df = S.stream_delimited(spark, str(tmp_path / "in"), "k int, v string")
    query = R.run_stream(df, lambda b, i: got.extend(rows_of(b, "k", "v")), str(tmp_path / "c"), name="delimited", every="1 seconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert got == [(1, "x")] and df.isStreaming and F is not None


def test_the_whole_error_text_is_kept(spark, frame, tmp_path):
    def job(batch, batch_id):
        raise RuntimeError("x" * 9000)

    R.with_capture(job, "long", str(tmp_path / "log"), lambda: AT)(frame("k int", (1,)), 0)
    assert len(read_snapshot(spark, f"{tmp_path}/log/stage=long").first().error_message) == 9000 + len("RuntimeError: ")


def test_captured_rows_come_back_whole(frame):
    from usagelake.plans.intake import capture_failed, replay_failed

    schema = "k long, at timestamp, local timestamp_ntz, v double, s string, b boolean, d date"
    exact = datetime(2024, 1, 2, 3, 4, 5, 123456)
    batch = frame(schema, (2**60 + 1, exact, exact, 0.1, "é\n\"", True, exact.date()), (None,) * 7)
    captured = capture_failed(batch, "s", "1", "m", AT)
    assert sorted(map(str, replay_failed(captured, "s", batch.schema).collect())) == sorted(map(str, batch.collect()))


def test_a_repeated_batch_counts_once_and_untouched_buckets_stay(spark, frame, tmp_path):
    from usagelake.operators.upsert import accumulate
    from usagelake.sources.snapshots import bucket_column, current_version, read_buckets

    path, schema = str(tmp_path / "state"), "k int, n bigint"
    empty = frame(schema)
    merge = R.upsert_batches(path, empty, lambda t, s: accumulate(t, s, ["k"], add=["n"]), stream="s", keys=["k"], buckets=8)
    merge(frame(schema, *[(k, 1) for k in range(40)]), 0)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet")}
    one = frame(schema, (3, 10))
    bucket = bucket_column(one, ["k"], 8).first().key_bucket
    for _ in range(2):
        merge(one, 1)
    assert current_version(spark, path) == 2
    assert {k: n for k, n in rows_of(read_buckets(spark, path, empty))} == {k: 11 if k == 3 else 1 for k in range(40)}
    after = set((tmp_path / "state").rglob("*.parquet")) - set(before)
    assert after and {f.parent.name for f in after} == {f"key_bucket={bucket}"}
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    for i in range(2, 5):  # folders that neither the newest nor the former version reads go
        merge(one, i)
    kept = {f.parent for f in (tmp_path / "state").rglob("*.parquet") if f.parent.name == f"key_bucket={bucket}"}
    assert len(kept) == 2 and dict(rows_of(read_buckets(spark, path, empty)))[3] == 41


def test_a_stream_keeps_its_last_batch_beside_a_whole_snapshot(spark, frame, tmp_path):
    from usagelake.operators.upsert import accumulate

    path, empty = str(tmp_path / "state"), frame("k int, n bigint")
    one, two = (R.upsert_batches(path, empty, lambda t, s: accumulate(t, s, ["k"], add=["n"]), stream=name) for name in ("a", "b"))
    for batch_id in (0, 0, 1, 1, 0):
        one(frame("k int, n bigint", (1, 1)), batch_id)
    two(frame("k int, n bigint", (1, 5)), 0)
    assert rows_of(read_snapshot(spark, path)) == [(1, 7)]
