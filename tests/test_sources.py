"""Readers, writers, snapshots and archive routing on small files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.operators.upsert import scd1
from usagelake.sources import files as S
from usagelake.sources import manifest as M
from usagelake.sources import snapshots as N

LINE = "1,2024-01-02,03:04:05.678,LOG,a,b,c,9,25003:1,"


def test_delimited_scan_keeps_bad_lines_and_file_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1|x\n2|y\n")
    (tmp_path / "b.csv").write_text("oops|z\n")
    df = S.read_delimited(spark, f"{tmp_path}/{{a,b}}.csv", "k int, v string", sep="|", rescued="_bad")
    assert rows_of(df, "k", "v", "_bad", "file_name") == [(1, "x", None, "a.csv"), (2, "y", None, "a.csv"), (None, "z", "oops|z", "b.csv")]
    assert df.where("file_size > 0 AND file_mtime IS NOT NULL AND file_path LIKE 'file:%'").count() == 3


def test_header_json_lines(spark, tmp_path):
    (tmp_path / "l.csv").write_text(LINE + '{"a": "x,y", "b": {"c": 1}}\n' + LINE + '"{""a"": ""q""}"\n' + "short,2024-01-02\n")
    df = S.read_header_json_lines(spark, str(tmp_path / "l.csv"))
    assert rows_of(df, "format_version", "contract", "header_ts", "payload") == [
        (1, "25003:1", datetime(2024, 1, 2, 3, 4, 5, 678000), '{"a": "q"}'), (1, "25003:1", datetime(2024, 1, 2, 3, 4, 5, 678000), '{"a": "x,y", "b": {"c": 1}}'),
        (None, None, None, None)]


def test_hub_messages(frame):
    df = frame("body binary, properties map<string,string>", (bytearray(b'{"x":1}'), {"deviceId": "d1", "opType": "updateTwin"}), (None, {}))
    assert rows_of(S.parse_hub_messages(df), "body", "device_id", "operation_type") == [('{"x":1}', "d1", "updateTwin"), (None, None, None)]


def test_latest_file_and_unique_files(frame):
    df = frame("folder string, file_path string, file_mtime int, file_size int", ("f", "a", 1, 9), ("f", "b", 2, 9), ("f", "b", 2, 9), ("g", "c", 1, 9))
    assert rows_of(S.latest_file_rows(df), "file_path") == [("b",), ("b",), ("c",)]
    assert rows_of(S.unique_files(df), "file_path", "record_count") == [("a", 1), ("b", 2), ("c", 1)]


def test_incremental_read_pushes_the_bound_down(spark, frame, tmp_path):
    frame("k int, at int", (1, 5), (2, 8), (3, 9)).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    df = S.read_incremental(source, frame("k int, at int", (1, 8)), "at", "at")
    assert rows_of(df, "k") == [(3,)] and "GreaterThan(at,8)" in df._jdf.queryExecution().executedPlan().toString()
    empty = frame("k int, at timestamp", (1, datetime(2024, 1, 1))).limit(0)
    assert S.high_watermark(empty, "at").first()[0] == datetime(1900, 1, 1)


def test_copy_quotes_everything(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,x\n")
    S.copy_delimited(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert '"1","x"' in text


def test_append_merge_and_compact(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        S.append(frame("k int", (i,)), path, single_file=True)
    S.append(frame("k int, more string", (9, "x")), path)
    assert S.read_merged(spark, path).columns == ["k", "more"]
    assert N.compact(spark, path, str(tmp_path / "c")) == 1
    assert len(list((tmp_path / "c").glob("part-*"))) == 1 and spark.read.parquet(str(tmp_path / "c")).count() == 6


def test_snapshots_survive_a_failed_write(spark, frame, tmp_path):
    path = str(tmp_path / "snap")
    with pytest.raises(FileNotFoundError):
        N.read_snapshot(spark, path)
    assert N.write_snapshot(frame("k int, v string", (1, "a")), path) == 1
    (tmp_path / "snap" / "v=2").mkdir()  # a write that never finished
    assert rows_of(N.read_snapshot(spark, path)) == [(1, "a")]
    assert N.update_snapshot(spark, path, lambda t: scd1(t, frame("k int, v string", (1, "b"), (2, "c")), ["k"])) == 2
    assert rows_of(N.read_snapshot(spark, path)) == [(1, "b"), (2, "c")] and rows_of(N.read_snapshot(spark, path, 1)) == [(1, "a")]


def test_only_touched_partitions_are_rewritten(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    frame("k int, v string, m int", (1, "a", 1), (2, "a", 2)).write.partitionBy("m").parquet(path)
    before = {f.name for f in (tmp_path / "p" / "m=2").glob("*.parquet")}
    N.update_partitions(spark, path, frame("k int, v string, m int", (1, "z", 1), (7, "n", 1), (8, "n", 3)), "m", lambda t, s: scd1(t, s, ["k"]))
    assert rows_of(spark.read.parquet(path), "k", "v", "m") == [(1, "z", 1), (2, "a", 2), (7, "n", 1), (8, "n", 3)]
    assert {f.name for f in (tmp_path / "p" / "m=2").glob("*.parquet")} == before


def test_archive_routing(frame):
    df = frame("container string, folder string, file_name string, event_type string",
               ("logs-scanned", "d", "a_b_dev1_c_20240102030405.zip", "created"), ("logs-scanned", "d", "zlog_b_c_d_e.zip", "created"),
               ("usbdecrypted-zip", "dev2", "short.zip", "created"), ("usbdecrypted-zip", "d", "a_b_c_d_e.txt", "created"), ("other", "d", "a_b_c_d_e.zip", "created"),
               ("logs-scanned", "d", "a_b_c_d_e.zip", "deleted"))
    got = M.classify_archives(df)
    assert rows_of(got.where("route = 'valid'"), "file_name", "load_type", "device_id", "log_day") == [("a_b_dev1_c_20240102030405.zip", "IOT", "DEV1", "20240102")]
    assert sorted(r.route for r in got.collect()) == ["duplicate", "ignored", "ignored", "invalid", "invalid", "valid"]
    members = frame("member_name string", ("com3_x_UL_1",), ("com3_x_zAssert_1",), ("com3_x_OTHER_1",), ("com3",))
    assert [r.route for r in M.classify_members(members).orderBy("member_name").collect()] == ["invalid", "invalid", "valid", "valid"]
    known = frame("destination string, file_size bigint", ("d1", 10), ("d1", 12))
    new = frame("destination string, file_size bigint", ("d1", 13), ("d1", 12), ("d2", 1), ("d3", None))
    assert sorted(r.status for r in M.classify_files(new, known).collect()) == ["Duplicate", "Failed", "New", "Replace"]


def test_reference_csv_and_bucket(spark, frame, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,x\nz,y\n")
    assert rows_of(S.read_reference_csv(spark, str(tmp_path / "r.csv"), {"a": "int"})) == [(1, "x"), (None, "y")]
    assert N.bucket_column(frame("k int", (1,)), ["k"], 8).where(F.col("key_bucket").between(0, 7)).count() == 1


def test_an_archive_behind_many_dots_is_an_archive(frame):
    df = frame("container string, folder string, file_name string, event_type string",
               ("usbdecrypted-zip", "d", "a_b_dev1_c_20240102030405" + ".x" * 30 + ".ZIP", "created"))
    assert [r.route for r in M.classify_archives(df).collect()] == ["valid"]


def test_hashes_keep_nulls_in_place(frame):
    from usagelake.operators.dedup import hashed_history
    from usagelake.plans.quality import compare_hashed

    rows = frame("a string, b string, c string", ("a", None, "b"), ("a", "b", None), ("a", "b", None))
    assert hashed_history(rows).count() == 2
    left, right = frame("k int, x string, y string", (1, "1", "23"), (2, None, "b")), frame("k int, x string, y string", (1, "12", "3"), (2, "b", None))
    assert {r[-1] for r in compare_hashed(left, right, ["k"], ["x", "y"]).select("verdict").collect()} == {"Not Matched"}


def test_an_emptied_partition_goes_and_old_versions_expire(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    frame("k int, m int", (1, 1), (2, 2), (3, 2)).write.partitionBy("m").parquet(path)
    N.update_partitions(spark, path, frame("k int, m int", (2, 2), (3, 2)), "m", lambda t, s: t.join(s, ["k", "m"], "left_anti").select("k", "m"))
    assert rows_of(spark.read.parquet(path), "k", "m") == [(1, 1)]
    assert not (tmp_path / "p" / "m=2").exists()
    for k in range(4):
        N.write_snapshot(frame("k int", (k,)), str(tmp_path / "s"))
    N.expire_snapshots(spark, str(tmp_path / "s"))
    assert sorted(x.name for x in (tmp_path / "s").iterdir() if x.is_dir()) == ["v=3", "v=4"]
    assert rows_of(N.read_snapshot(spark, str(tmp_path / "s"))) == [(3,)]


def test_null_and_escaped_partitions_lose_nothing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame("k int, m string", (1, None), (2, None), (3, "b:c d"), (4, "x/y"), (5, "plain")).write.partitionBy("m").parquet(path)
    N.update_partitions(spark, path, frame("k int, m string", (9, None)), "m", lambda t, s: t.select("k", "m").unionByName(s))
    assert rows_of(spark.read.parquet(path), "k", "m") == [(1, None), (2, None), (3, "b:c d"), (4, "x/y"), (5, "plain"), (9, None)]
    gone = frame("k int, m string", (3, "b:c d"), (1, None), (2, None), (9, None))
    N.update_partitions(spark, path, gone, "m", lambda t, s: t.join(s.select("k"), "k", "left_anti").select("k", "m"))
    assert rows_of(spark.read.parquet(path), "k", "m") == [(4, "x/y"), (5, "plain")]


def test_attempts_on_archives(frame):
    from usagelake.sources.manifest import archive_states, replay_attempts

    t = lambda m: datetime(2024, 1, 1, 0, m)
    attempts = frame("attempt_id int, archive string, destination string, file_size bigint, attempted_at timestamp",
                     (1, "a", "x", None, t(1)), (2, "a", "x", 10, t(2)), (3, "b", "x", 10, t(3)), (4, "c", "x", 12, t(3)), (5, "b", "x", 11, t(4)),
                     (6, "d", "y", 5, t(1)), (7, "e", "z", None, t(1)), (8, "e", "z", None, t(2)), (9, "e", "z", None, t(3)), (10, "f", "z", None, t(9)))
    judged = replay_attempts(attempts, frame("destination string, file_size bigint", ("y", 7), ("y", 5)))
    assert dict(rows_of(judged, "attempt_id", "status")) == {
        1: "Failed", 2: "New", 3: "Duplicate", 4: "Replace", 5: "Duplicate", 6: "Duplicate", 7: "Failed", 8: "Failed", 9: "Failed", 10: "Failed"}
    assert dict(rows_of(archive_states(judged), "archive", "state")) == {
        "a": "loaded", "b": "duplicate", "c": "loaded", "d": "duplicate", "e": "given_up", "f": "waiting"}
