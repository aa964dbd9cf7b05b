"""Text, time and key functions, and JSON mapping."""

import base64
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows_of
from usagelake.functions import columns as C
from usagelake.functions import jsonmap as J


def one(frame, value, build, kind="string"):
    return frame(f"x {kind}", (value,)).select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize("build, value, want", [
    (C.norm_key, " ab ", "AB"), (lambda c: C.pad_serial(c, 5), "12", "00012"), (C.strip_zeros, "00120", "120"), (C.strip_zeros, "0A1", "0A1"),
    (C.clean_consumer, "123", "123"), (C.clean_consumer, "0000", "MISSING"), (C.clean_consumer, "x1", "MISSING"), (C.clean_consumer, None, "MISSING"),
    (C.format_id10, "1234567890", "123-456-7890"), (C.format_id10, "12", "12"), (C.clean_text, "a%20b c", "abc"),
    (C.zone_offset, "Eastern (UTC-05:00:00)", "-05:00"), (C.zone_offset, "India (UTC05:30:00)", "+05:30"), (C.zone_offset, "", "+00:00"),
    (C.zone_offset, "Pacific Daylight Time", "-07:00"), (C.zone_offset, "nothing", None), (C.escape_file_name, "a b/c+1", "a%20b%2Fc%2B1"),
    (lambda c: C.recode(c, C.BODY_PART, when_null="U"), None, "U"), (lambda c: C.recode(c, C.BODY_PART, when_null="U"), "UBA", "A1"),
    (lambda c: C.recode(c, C.SAME_NEXT, when_null="U", other="U"), "Odd", "U"), (C.unless_unknown, "unknown", None),
])
def test_text(frame, build, value, want):
    assert one(frame, value, build) == want


def test_valid_consumer(frame):
    df = frame("x string", ("1",), ("unknown",), ("Missing",), ("",), ("0000000000",), (None,))
    assert rows_of(df.where(C.valid_consumer("x"))) == [("1",)]


def test_event_times(frame):
    head = datetime(2024, 5, 1)
    df = frame("t string, h timestamp", ("2024-01-02,03:04:05", head), ("20240102030405", head), ("soon", head), (None, None), ("2024-99-02,03:04:05", head))
    got = [r[0] for r in df.select(C.event_time(F.col("t"), F.col("h"))).collect()]
    assert got == [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [head, datetime(1901, 1, 1), None]
    assert one(frame, "20240102030405.678", C.compact_time) == datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert one(frame, "20240102", C.compact_time) is None


def test_minutes_and_local_dates(frame):
    df = frame("a timestamp, b timestamp", (datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 9, 29, 30)), (None, datetime(2024, 1, 1)))
    assert [r[0] for r in df.select(C.minutes_between(F.col("a"), F.col("b"))).collect()] == [30, None]
    df = frame("at timestamp, zone string, off string", (datetime(2024, 1, 1, 3), "America/New_York", "+09:00"), (datetime(2024, 1, 1, 3), None, "-04:00"), (datetime(2024, 1, 1, 3), None, None))
    assert [r[0] for r in df.select(C.local_date("at", F.col("zone"), F.col("off"))).collect()] == [date(2023, 12, 31), date(2023, 12, 31), date(2024, 1, 1)]
    recent = frame("d date", (date(2024, 1, 1),), (date(2023, 1, 1),)).where(C.recent("d", date(2024, 1, 5), 10))
    assert recent.count() == 1


def test_file_names_and_paths(frame):
    df = frame("file_name string, file_path string, contract string", ("ct_ab 1_UL_20240101_2_7.csv", "raw/x/dev%201/f", "25003:2"), ("ct.csv", "raw", "14020"), ("a_b_c_d", "a/b/c/d", "9:x"))
    got = C.split_contract(C.parse_path(C.parse_file_name(df, "file_name"), "file_path"))
    assert rows_of(got, "file_device_type", "file_serial", "file_message_type", "file_port", "file_cycle_nbr", "internal_serial", "head") == [
        ("A", "B", "c", "", None, "C", 0), ("CT", "AB1", "UL", "2", "7", "DEV1", 2), ("CT", None, None, "", None, None, 0)]


def test_tagged_text(frame):
    line = "SBC:abc4567890123456789 UPM: UPM 00012345678901234 SIM:89012345678901234567 LastContact:Mon Jan 15 10:20:30 UTC 2024 end"
    df = frame("text string, file_name string", (line, "01-16-24.01-02-03.txt"), ("SBC:? UPM: UNKNOWN SIM:?", "bad"), ("nothing", "01-16-24.01-02-03"))
    got = C.parse_tagged_text(df)
    assert rows_of(got, "internal_serial", "external_serial", "sim_card", "last_contact", "reported_at") == [
        ("ABC4567890123456789", "UPM000123456789012", "89012345678901234567", datetime(2024, 1, 15, 10, 20, 30), datetime(2024, 1, 16, 1, 2, 3)),
        (None, "UNKNOWN", None, None, None), (None, None, None, None, datetime(2024, 1, 16, 1, 2, 3))]


def test_frames(frame):
    df = frame("a int, Email string", (1, "x"))
    assert C.drop_pii(df, ["email"]).columns == ["a"] and C.prefix_columns(df, "p_").columns == ["p_a", "p_Email"]
    at = datetime(2024, 1, 1)
    one_, two = C.stamp(df, "me", at, ["a"]).first(), C.stamp(df, "me", at, ["a"]).first()
    assert one_.row_id == two.row_id and one_.created_by == "me" and one_.updated_at == at
    text = df.select(C.render_template(F.lit("<A> and <B>"), {"A": F.col("a"), "B": F.lit(None)})).first()[0]
    assert text == "1 and "
    assert C.version_slices(frame("v string", ("12.34.56.78.90.ABCDEFGH",)), "v").select("sw_os", "sw_app", "sw_applicator_cfg").first() == ("12", "56", "ABCDEFGH")


def test_unmask(spark, frame):
    key = "0123456789abcdef"
    sealed = spark.sql(f"SELECT base64(aes_encrypt('555', '{key}')) AS x").first()[0]
    assert base64.b64decode(sealed)
    df = frame("v string, f string", (sealed, "true"), ("777", "False"), ("888", None), ("junk", "True"))
    got = C.unmask(df, "v", "f", "id", F.lit(key))
    assert rows_of(got, "id", "id_decrypted") == [("555", "True"), ("777", None), (None, "True"), (None, None)]


FIELDS = [J.FieldMap("t", "1", ("a", "b"), "first", "int"), J.FieldMap("t", "1", ("n.x",), "nested"), J.FieldMap("t", "1", ("when",), "when", "timestamp", updatable=False),
          J.FieldMap("t", "1", ("gone",), "off", active=False)]


def test_json_mapping(frame):
    df = frame("p string", ('{"b": "7", "n": {"x": "in"}, "when": "20240101"}',), ('{"a": "oops", "b": 3}',), ("broken",), (None,))
    got = J.flatten_json(df, "p", FIELDS)
    assert got.columns == ["p", "first", "nested", "when"]
    assert rows_of(got, "first", "nested", "when") == [(3, None, None), (7, "in", "20240101"), (None, None, None), (None, None, None)]
    assert J.update_set(FIELDS) == {"first": "s.`first`", "nested": "s.`nested`"}
    table = frame("table string, contract string, source_names array<string>, target string, data_type string, update_enabled string, is_active string",
                  ("t", "1", ["a", "b"], "first", "int", "1", "1"), ("t", "2", ["z"], "zed", "string", "0", "1"), ("t", "1", ["q"], "q", "string", "1", "0"))
    read = J.mappings_from(table, "t")
    assert [f.target for f in read] == ["first", "zed"] and J.contracts_of(read, "t") == ["1", "2"]


def test_schema_alignment(frame):
    df = frame("a int, c string", (1, "x"))
    schema = T.StructType().add("a", T.LongType()).add("b", T.DateType())
    out = J.align_to_schema(df, schema)
    assert out.dtypes == [("a", "bigint"), ("b", "date"), ("c", "string")]
    assert [f.name for f in J.new_columns(df, schema)] == ["c"]
    with pytest.raises(ValueError, match="disagree"):
        J.align_to_schema(df, schema, FIELDS)
    nested = J.parse_struct(frame("k int, p string", (1, '{"x": {"y": 2}}')), "p", "struct<x: struct<y: int>>")
    assert nested.select("k", "x.y").first() == (1, 2)
