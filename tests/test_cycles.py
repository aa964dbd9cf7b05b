"""Cycle builders on hand-made log rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.functions.jsonmap import FieldMap
from usagelake.plans import cycles as C
from usagelake.plans import intake as I

EQUIPMENT = "serial string, ship_start date, ship_end date, transit_status string, sold_to string, ship_to string, material string, mfg_batch string"
OPEN = date(2111, 11, 11)
ROW = ("file_id string, file_path string, file_size bigint, contract string, head int, header_date date, header_ts timestamp, format_version int, "
       "external_serial string, internal_serial string, payload string")
START = [FieldMap("c", "s", ("card",), "card"), FieldMap("c", "s", ("nbr",), "cycle_nbr", "int"), FieldMap("c", "s", ("mlt",), "treatment_file")]
END = [FieldMap("c", "e", ("st",), "final_status")]


def row(file, contract, at, payload, ext="E1", head=0):
    return (file, f"p/{file}", 10, contract, head, at.date(), at, 2, ext, "I1", payload)


@pytest.fixture
def equipment(frame):
    return frame(EQUIPMENT, ("E1", date(2024, 1, 1), date(2024, 2, 1), "SHIPPED", "so1", "sh1", "M", "B"),
                 ("E1", date(2024, 2, 1), OPEN, "SHIPPED", "so2", "sh2", "M", "B"), ("c1", date(2024, 1, 1), OPEN, "SHIPPED", "x", "y", "CARD", "B"),
                 ("E1", date(2024, 1, 1), OPEN, "IN WAREHOUSE", "no", "no", "M", "B"), ("000000000000000077", date(2024, 1, 1), date(2024, 2, 1), "SHIPPED", "soct", "shct", "M", "B"))


def test_gen3_cycles(frame, equipment):
    t = lambda d, h: datetime(2024, *d, h)
    rows = frame(ROW, row("f1", "25003:1", t((1, 31), 9), '{"card": "c1", "nbr": "5", "mlt": "m1"}', head=1), row("f1", "25004:1", t((1, 31), 10), '{"st": "Stopped"}'),
                 row("f1", "25004:1", t((1, 31), 11), '{"st": "Completed"}'), row("f2", "25003", t((2, 1), 9), '{"card": "zz", "nbr": 4}'),
                 row("f3", "25003", t((2, 1), 9), '{"card": "zz", "nbr": 4}'), row("f4", "84005", t((2, 1), 9), "{}"))
    times = frame("file_id string, log_start timestamp, log_end timestamp", ("f1", t((1, 31), 8), t((1, 31), 12)), ("f2", t((2, 1), 8), t((2, 1), 10)), ("f3", t((2, 1), 8), t((2, 1), 11)))
    registry = frame("file_id string, file_name string, file_path string, message_type string, updated_at timestamp",
                     ("r1", "m1.stx", "old", "MLT", t((1, 1), 1)), ("r2", "m1.stx", "new", "MLT", t((1, 2), 1)))
    built = C.build_cycles(rows, C.GEN3, START, END, times=times, equipment=equipment, registry=registry, first_id=500)
    assert rows_of(built, "cycle_id", "file_id", "card", "cycle_nbr", "final_status", "sold_to", "ship_to", "device_shipped", "card_shipped", "card_material", "treatment_path", "event_end") == [
        (501, "f1", "c1", 5, "Completed", "so1", "sh1", 1, 1, "CARD", "new", t((1, 31), 12)),
        (502, "f3", "zz", 4, None, "so2", "sh2", 1, 0, None, None, t((2, 1), 11))]
    target = built.limit(0)
    merged = C.merge_cycles(target, built, C.GEN3)
    assert merged.count() == 2 and C.merge_cycles(merged, built, C.GEN3).count() == 2


def test_ct_owner_is_closed_and_padded(frame, equipment):
    at = datetime(2024, 2, 1, 9)
    rows = frame(ROW, row("f1", "84005", at, '{"card": "q", "nbr": 1}', ext="77"), row("f2", "84005:1", at, '{"card": "q", "nbr": 2}', ext="99"))
    times = frame("file_id string, log_start timestamp, log_end timestamp", ("f1", at, at))
    built = C.build_cycles(rows, C.CT, START, END, times=times, equipment=equipment)
    assert rows_of(built, "external_serial", "sold_to", "device_shipped") == [("77", "soct", 1), ("99", "0000000000", 0)]
    clocks = C.ct_times(frame("end_date string, end_clock string, start_date string, start_clock string", ("2024-01-02", "03:04:05", "x", None)))
    assert rows_of(clocks, "cycle_end", "interrupt_start") == [(datetime(2024, 1, 2, 3, 4, 5), None)]


def test_rs_cycles_and_cartridges(frame, equipment):
    at = datetime(2024, 2, 2, 9)
    rows = frame(ROW, row("f1", "87900:1", at, "{}", ext="e1"), row("f1", "87901:1", at, '{"st": "ok"}'), row("f1", "87902:1", at, '{"ser": "k1", "dose": 3}'),
                 row("f1", "87903:1", at, '{"ser": "k1", "used": 2}'), row("f2", "87902:1", datetime(2024, 2, 1), '{"ser": "k1", "dose": 3}'))
    times = frame("file_id string, log_start timestamp, log_end timestamp", ("f1", at, at))
    cycles = C.build_cycles(rows, C.RS, [FieldMap("c", "s", ("a",), "kind")], END, times=times, equipment=equipment)
    assert rows_of(cycles, "final_status", "ship_to") == [("ok", "sh2")]
    ser = FieldMap("k", "s", ("ser",), "cartridge_serial")
    got = C.cartridges(rows, [ser, FieldMap("k", "s", ("dose",), "dose_count", "int")], [ser, FieldMap("k", "e", ("used",), "used", "int")], cycles)
    assert rows_of(got, "cartridge_serial", "dose_count", "used", "cycle_id", "event_end") == [("K1", 3, 2, 1, at)]
    assert C.merge_cartridges(got.limit(0), got).count() == 1


GEN1 = "contract string, event_date string, event_time string, cycle_count string, card string, file_name string, line_no int, " + ", ".join(f"column{i} string" for i in range(4, 27))


def flat(n, contract, clock, count=None, card=None, **cols):
    return (contract, "1/5/2024", clock, count, card, "f_SBC1_x.txt", n, *[cols.get(f"column{i}") for i in range(4, 27)])


def test_gen1_reconstruction(frame):
    rows = frame(
        GEN1,
        flat(1, "~MA", "08:00:00"),
        # a plain cycle
        flat(2, "~MB", "09:00:00", "10", "card1", column4="01.02.03.04.05.ABCDEFGH", column8="Same", column23="777"),
        flat(3, "~ME", "09:35:00", "10", None, column4="Successful", column6="none"),
        # interrupted: two starts, two ends; the card of the second start is missing
        flat(4, "~MB", "10:00:00", "11", "card1", column25="first", column23="778"),
        flat(5, "~ME", "10:10:00", "11", "card1", column4="Interrupted", column6="E1"),
        flat(6, "~MB", "10:20:00", "11", None, column25="second", column23="779"),
        flat(7, "~ME", "10:40:00", "11", None, column4="Successful", column6="none"),
        # two ends for one start
        flat(8, "~MB", "11:00:00", "12", "card1", column23="Unknown"),
        flat(9, "~ME", "11:05:00", "12", "card1", column4="Paused", column6="E2"),
        flat(10, "~ME", "11:30:00", "12", "card1", column4="Successful"),
        # never ended
        flat(11, "~MB", "12:00:00", "13", "card1"),
        flat(12, "~MM", "13:00:00"),
    )
    t = lambda h, m: datetime(2024, 1, 5, h, m)
    got = C.reconstruct_gen1(rows)
    assert rows_of(got, "cycle_count", "begin_ts", "end_ts", "status", "interrupt_start", "interrupt_status", "interrupt_end", "consumer_id", "pre_cycle", "post_cycle") == [
        (10, t(9, 0), t(9, 35), "Successful", None, None, None, "777", t(8, 0), t(10, 0)),
        (11, t(10, 0), t(10, 40), "Successful", t(10, 10), "Interrupted", t(10, 20), "779", t(9, 35), t(11, 0)),
        (12, t(11, 0), t(11, 30), "Successful", t(11, 5), "Paused", None, "U", t(10, 40), t(12, 0)),
        (13, t(12, 0), None, None, None, None, None, "U", t(11, 30), t(13, 0)),
    ]
    assert rows_of(got.where("cycle_count = 11"), "card", "contour", "interrupt_error") == [("card1", "first", "E1")]
    assert rows_of(got.where("cycle_count = 10"), "same_next", "sw_os", "sw_applicator_cfg") == [("S", "01", "ABCDEFGH")]


def test_gen1_successful_interruption_becomes_the_end(frame):
    rows = frame(GEN1, flat(1, "~MB", "09:00:00", "1", "c"), flat(2, "~ME", "09:30:00", "1", "c", column4="Successful"), flat(3, "~ME", "09:30:00", "1", "c", column4="Successful", column6="again"))
    got = C.reconstruct_gen1(rows)
    assert rows_of(got, "end_ts", "status", "interrupt_start") == [(datetime(2024, 1, 5, 9, 30), "Successful", None)]


def test_gen1_owner_and_merge(frame):
    cycles = frame("file_name string, card string, cycle_count int, begin_ts timestamp, end_ts timestamp",
                   ("f", "c1", 3, datetime(2024, 1, 10), datetime(2024, 1, 11)), ("g", "c1", 3, datetime(2024, 1, 12), datetime(2024, 3, 1)), ("f", None, 2, datetime(2024, 1, 10), None))
    equipment = frame(EQUIPMENT, ("c1", date(2024, 1, 1), date(2024, 2, 1), "SHIPPED", "so", "sh", "M", "B"))
    got = C.own_gen1(cycles, equipment)
    assert rows_of(got, "card", "begin_ts", "unsold_flag", "ship_to") == [("c1", datetime(2024, 1, 12), "Y", "0000000000"), (None, datetime(2024, 1, 10), "Y", "0000000000")]
    assert C.merge_gen1(got, got).count() == 2


def test_log_times_and_device_state(frame):
    at = datetime(2024, 1, 2, 3)
    rows = frame(ROW, row("f1", "14020", at, '{"startts": "20240101000000", "prodtype": "A"}'), row("f1", "14020", at, '{"startts": "2023-12-31,00:00:00", "prodtype": "B"}'),
                 row("f1", "14023", at, '{"endts": "bad"}'), row("f2", "14020", at, "{}"))
    assert rows_of(I.log_times(rows), "file_id", "log_start", "log_end", "product_type") == [("f1", datetime(2023, 12, 31), at, "B"), ("f2", at, None, None)]
    fields = [FieldMap("s", "*", (n,), t) for n, t in (("sim", "sim_card"), ("pwr", "power_on_text"), ("sig", "signal_text"), ("path", "path"))]
    state = frame(ROW, row("a", "15008", at, '{"x": 1}'), row("b", "15024", at, '{"sig": "RSRP:-99.5 RSRQ:-7"}'), row("c", "87516", at, '{"pwr": "20240102030405.678"}'),
                  row("d", "15011", at, '{"path": "C:\\temp"}'), row("e", "15024", datetime(2024, 1, 1), '{"sig": "RSRP:1"}'))
    got = I.device_state(state, fields)
    assert rows_of(got, "contract", "rsrp", "rsrq", "power_on", "path") == [
        ("15011", None, None, None, "C:\\temp"), ("15024", "-99.5", "-7", None, None), ("87516", None, None, datetime(2024, 1, 2, 3, 4, 5, 678000), None)]
    newer = got.withColumn("header_ts", F.col("header_ts") - F.expr("INTERVAL 1 DAY")).withColumn("rsrp", F.lit("0"))
    assert rows_of(I.merge_device_state(got, newer), "contract", "rsrp") == rows_of(got, "contract", "rsrp")


def test_user_events_history_and_registry(frame):
    at = datetime(2024, 1, 2)
    rows = frame(ROW, row("a", "21544", at, '{"tm": "1", "z": "q"}'), row("b", "21544", at, '{"tm": "2", "z": "w"}'))
    fields = [FieldMap("u", "*", ("tm",), "error_time"), FieldMap("u", "*", ("z",), "z")]
    empty = frame("internal_serial string, external_serial string, header_ts timestamp, contract string, head int, error_time string, z string", ("x", "x", at, "x", 0, "", "")).limit(0)
    got = I.user_events(empty, rows, fields)
    assert rows_of(got, "error_time", "z") == [("2", "w")] and I.user_events(got, rows, fields).count() == 1
    lines = frame("file_path string, file_name string, file_size bigint, contract string, event_ts timestamp",
                  ("a/b/c/d/e/f/Measurement/x", "n_sn1.txt", 1, "x", at), ("a/b/c/d/e/f/Measurement/x", "n_sn1.txt", 1, "x", datetime(2024, 1, 3)),
                  ("a/b/c/d/e/f/Assert/y", "n_sn2_1", 1, "Assert occurred on 1/2/2024 3:04:05 PM", None), ("a/b/c/d/e/f/Other/z", "n_s", 1, "x", at))
    assert rows_of(I.log_registry(lines), "message_type", "internal_serial", "log_start", "log_end", "record_count") == [
        ("Assert", "SN2", datetime(2024, 1, 2, 15, 4, 5), datetime(2024, 1, 2, 15, 4, 5), 1), ("ML", "SN1", at, datetime(2024, 1, 3), 2)]
    audit = I.audit_rows(rows, ["file_id"], "cycles", "Succeeded", None, at)
    assert audit.count() == 2 and set(audit.columns) == {"file_id", "stage", "status", "error_message", "created_at"}


def test_last_contacts(frame, equipment):
    line = "SBC:B234567890123456789 UPM: ? SIM:1 LastContact:Mon Jan 15 10:20:30 UTC 2024 "
    lines = frame("text string, file_name string", (line, "01-16-24.01-02-03"), (line.replace("Jan 15", "Jan 14"), "01-17-24.01-02-03"))
    owner = frame(EQUIPMENT, ("UPM9", date(2024, 1, 1), OPEN, "SHIPPED", "s", "s", "M", "B234567890123456789"))
    target = frame("internal_serial string, external_serial string, last_contact timestamp", ("x", "x", None)).limit(0)
    assert rows_of(I.last_contacts(target, lines, owner)) == [("B234567890123456789", "UPM9", datetime(2024, 1, 15, 10, 20, 30))]


def test_heads_of_one_record_are_both_inserted(frame):
    schema = "external_serial string, internal_serial string, card string, cycle_nbr int, start_ts timestamp, head int, event_end timestamp, cycle_id bigint"
    at = datetime(2024, 1, 5)
    rows = [("e", "i", None, 1, at, 1, at, 1), ("e", "i", None, 1, at, 2, at, 2), ("e", "i", "c", 1, at, 1, at, 3), ("e", "i", "c", 1, at, 1, None, 4)]
    target = frame(schema)
    got = C.merge_cycles(target, frame(schema, *rows), C.GEN3)
    assert rows_of(got, "cycle_id") == [(1,), (2,), (3,)]
    again = C.merge_cycles(got, frame(schema, *rows), C.GEN3)
    assert rows_of(again.where("card IS NOT NULL"), "cycle_id") == [(3,)]


def test_a_gen1_cycle_in_two_files_is_inserted_once(frame):
    schema = "file_name string, card string, cycle_count int, begin_ts timestamp"
    at = datetime(2024, 1, 5)
    target = frame(schema, ("UL_s1_a.csv", "C1", 3, at))
    batch = frame(schema, ("UL_S1%20_b.csv", "c1", 3, at), ("UL_s2_b.csv", "c1", 3, at), ("UL_s2_c.csv", "C1", 3, at), ("UL_s2_c.csv", None, None, at),
                  ("UL_s2_d.csv", "", 0, at), ("UL_s3_d.csv", "c", 1, None), ("UL_s3_d.csv", "c", 1, None))
    assert rows_of(C.merge_gen1(target, batch), "file_name", "card") == [
        ("UL_s1_a.csv", "C1"), ("UL_s2_b.csv", "c1"), ("UL_s2_c.csv", None), ("UL_s3_d.csv", "c"), ("UL_s3_d.csv", "c")]
