"""Master data on hand-made frames."""

import json
from datetime import date, datetime

from tests.conftest import rows_of
from usagelake.plans import masters as M

AT = datetime(2024, 1, 1)
CHANGE = ("equipment_key string, serial string, material string, changed_on string, created_on string, status string, transit_status string, ship_to string, "
          "mfg_batch string, file_path string, created_at timestamp, load_order bigint")


def change(key, serial, changed, status="SHIPPED", created="20240101", at=AT, scrap="OK", folder="BW", material="MAT01"):
    return (key, serial, material, changed, created, scrap, status, "s1", " b1 ", f"x/{folder}/f.csv", at, None)


def test_equipment_cleaning(frame):
    df = frame(CHANGE, change("k1", " ab ", "00000000"), change("k2", None, None, folder="S4", material="M99"), change("k3", "x", "20240102", scrap="SCRAPPED"), change("k4", "y", "20249999"))
    assert rows_of(M.clean_equipment(df, refurbished=["99"]), "equipment_key", "serial", "changed_on", "ship_start", "file_priority", "is_refurbished", "mfg_batch") == [
        ("k1", "AB", "20240101", date(2024, 1, 1), "1", 0, "B1"), ("k2", "UNKNOWN", "20240101", date(2024, 1, 1), "2", 1, "B1"), ("k4", "Y", "20249999", None, "1", 0, "B1")]


def test_equipment_history_recomputes_touched_serials_only(frame):
    first = M.clean_equipment(frame(CHANGE, change("k1", "a", "20240105"), change("k2", "a", "20240110", status="IN WAREHOUSE"), change("k9", "z", "20240101")))
    from pyspark.sql import functions as F

    empty = first.limit(0).withColumns({"ship_end": F.lit(None).cast("date"), "movement_status": F.lit(None).cast("string"), "return_date": F.lit(None).cast("date")})
    history = M.equipment_history(empty, first)
    shown = ("serial", "ship_start", "ship_end", "movement_status", "return_date", "load_order")
    open_ = date(2111, 11, 11)
    assert rows_of(history, *shown) == [
        ("A", date(2024, 1, 5), date(2024, 1, 10), "SHIPPED", None, 2), ("A", date(2024, 1, 10), open_, "RETURNED", date(2024, 1, 10), 1), ("Z", date(2024, 1, 1), open_, "SHIPPED", None, 1)]
    again = M.equipment_history(history, first)
    assert rows_of(again, *shown) == rows_of(history, *shown)
    late = M.clean_equipment(frame(CHANGE, change("k3", "a", "20240107", status="SHIPPED", at=datetime(2024, 2, 1))))
    assert rows_of(M.equipment_history(history, late), *shown) == [
        ("A", date(2024, 1, 5), date(2024, 1, 7), "SHIPPED", None, 3), ("A", date(2024, 1, 7), date(2024, 1, 10), "SHIPPED", None, 2),
        ("A", date(2024, 1, 10), open_, "RETURNED", date(2024, 1, 10), 1), ("Z", date(2024, 1, 1), open_, "SHIPPED", None, 1)]


def test_equipment_splice_equals_a_whole_recompute(spark, frame):
    """Random late changes: batch after batch gives what one load of all rows gives; rows before the change are not ordered again."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(5)
    days = rng.sample(range(1, 300), 60)
    rows = [change(f"k{i}", rng.choice(["a", "b", None]), date.fromordinal(date(2023, 1, 1).toordinal() + day).strftime("%Y%m%d"),
                   status=rng.choice(["SHIPPED", "IN WAREHOUSE"])) for i, day in enumerate(days)]
    shown = ("equipment_key", "serial", "ship_start", "ship_end", "movement_status", "return_date", "load_order")
    clean = M.clean_equipment(frame(CHANGE, *rows))
    empty = clean.limit(0).withColumns({"ship_end": F.lit(None).cast("date"), "movement_status": F.lit(None).cast("string"), "return_date": F.lit(None).cast("date")})
    whole = rows_of(M.equipment_history(empty, clean), *shown)
    history = empty
    for part in (rows[:25], rows[25:50], rows[50:], rows[40:]):
        history = spark.createDataFrame(M.equipment_history(history, M.clean_equipment(frame(CHANGE, *part))).collect(), empty.schema)
    assert rows_of(history, *shown) == whole
    # plain Python on the same rows
    by_serial = {}
    for key, serial, _, changed, *rest in rows:
        by_serial.setdefault((serial or "UNKNOWN").upper(), []).append((changed, key, rest[2]))
    for serial, moves in by_serial.items():
        moves.sort()
        got = sorted((r[2].strftime("%Y%m%d"), r[0], r[4], r[6]) for r in whole if r[1] == serial)
        assert got == [
            (d, k, "RETURNED" if s == "IN WAREHOUSE" and i and moves[i - 1][2] == "SHIPPED" else s, len(moves) - i) for i, (d, k, s) in enumerate(moves)]


def test_simple_masters(frame):
    c = frame("account_id string, file_name string, city string, city2 string, name string", ("1", "f1", "x", "", "old"), ("1", "f2", "a", "", "new"))
    assert rows_of(M.customers(c.limit(0), c), "account_id", "name") == [("1", "new")]
    p = frame("code string, channel string, description string, category string", ("m", "1", "a", "z"), ("m", "2", "b", "z"))
    got = M.products(p.limit(0), p)
    assert rows_of(got, "code", "description") == [("m", "b")]
    t = frame("account_id string, territory string", ("1", "CP2"), ("1", "CP1"), ("1", "AA"), ("2", "AA"))
    assert rows_of(M.territories(t)) == [("1", "CP1")]
    gone = M.deactivate_missing(frame("k string, per_patient boolean", ("a", True), ("b", True)), frame("k string", ("a",)), ["k"])
    assert rows_of(gone) == [("b", False)]
    cards = M.programme_cards(frame("serial string, material string", ("c1", "m1"), ("c1", "m2"), ("c2", "old")),
                              frame("material string, promotion_uuid string, effective date, termination date", ("m1", "P", date(2024, 2, 1), date(2025, 1, 1)),
                                    ("m2", "P", date(2024, 1, 1), date(2025, 1, 1)), ("old", "P", date(2020, 1, 1), date(2021, 1, 1))), date(2024, 6, 1))
    assert rows_of(cards, "card", "material") == [("c1", "m2")]
    loaded = M.load_reference(frame("name string, effective date", ("a", date(2020, 1, 1))), frame("name string, effective string", ("a", "01/02/2024"), ("b", "x"), (None, "01/02/2024")), ["name"], ["effective"])
    assert rows_of(loaded) == [("a", date(2024, 1, 2)), ("b", None)]


def test_hierarchy_is_null_tolerant_and_change_only(frame):
    schema = "ship_to string, sold_to string, payer string, effective date, termination date, is_current string, updated_at timestamp"
    old = frame(schema, ("1", None, "p", AT.date(), date(2025, 1, 1), "Y", AT), ("2", "s", "p", AT.date(), date(2025, 1, 1), "Y", AT))
    new = datetime(2024, 5, 1)
    src = frame(schema, ("1", None, "p", AT.date(), date(2026, 1, 1), "Y", new), ("2", "s", "p", AT.date(), date(2025, 1, 1), "Y", new), ("2", "s", "p", AT.date(), date(2024, 1, 1), "Y", new))
    assert rows_of(M.account_hierarchy(old, src), "ship_to", "termination", "updated_at") == [("1", date(2026, 1, 1), new), ("2", date(2025, 1, 1), AT)]


def test_twin_full_load_and_changes(frame):
    def twin(version, **reported):
        return json.dumps({"version": str(version), "status": None, "properties": {"reported": reported}})

    fw = lambda a, b, c: {"fw": {"mj": a, "md": b, "mn": c}}
    schema = "device_id string, twin_json string, operation_type string, operation_ts timestamp"
    messages = frame(
        schema,
        (" d1 ", twin(1, FluidFilter="old", Versions={"App1": fw("1", "0", "0"), "OS": fw("9", "9", "9")}), "FullLoad", AT),
        ("d1", twin(0, FluidFilter="older"), "FullLoad", datetime(2023, 1, 1)),
        ("d1", twin(5, FluidFilter="new", softwareVersions={"App1": fw("2", "1", "0")}), "updateTwin", AT),
        ("d1", twin(7), "updateTwin", AT), ("d2", twin(3, AirFilter="x"), "updateTwin", AT))
    empty = M.parse_twin(messages.limit(0)).drop("twin_json", "operation_type", "operation_ts", "has_versions")
    got = M.merge_twins(empty, messages)
    # d2 was never fully loaded; the message of version 7 carries no state and is ignored
    assert rows_of(got, "device_id", "version_nbr", "fluid_filter", "app1_version", "os_version") == [("D1", 5, "new", "2.1.0", "9.9.9")]


def test_twin_epochs_equal_one_merge_per_epoch(spark, frame):
    import random

    rng = random.Random(3)
    schema = "device_id string, twin_json string, operation_type string, operation_ts timestamp"
    hour = lambda h: datetime(2024, 1, 1 + h // 24, h % 24)
    epochs, n = [], 0
    for e in range(4):
        rows = []
        if e:
            for d in rng.sample(range(6), 4):
                n += 1
                rows.append((f"d{d}", json.dumps({"version": str(n), "properties": {"reported": {"AirFilter": f"full{n}"}}}), "FullLoad", hour(10 * e)))
        for _ in range(8):
            n += 1
            reported = {}
            if rng.random() < 0.7:
                reported["FluidFilter"] = f"f{rng.randint(0, 99):02d}"
            if rng.random() < 0.4:
                reported["softwareVersions"] = {"App1": {"fw": {"mj": str(rng.randint(1, 9)), "md": "0", "mn": "0"}}}
            rows.append((f"d{rng.randint(0, 6)}", json.dumps({"version": str(n), "properties": {"reported": reported}}), "updateTwin", hour(10 * e + rng.randint(1, 9))))
        epochs.append(rows)
    empty = M.parse_twin(frame(schema, *epochs[0]).limit(0)).drop("twin_json", "operation_type", "operation_ts", "has_versions")
    held = M.merge_twins(empty, frame(schema, ("d6", json.dumps({"version": "0", "properties": {"reported": {"FluidFilter": "old"}}}), "FullLoad", AT)))
    held = spark.createDataFrame(held.collect(), empty.schema)
    shown = ("device_id", "version_nbr", "fluid_filter", "air_filter", "app1_version")
    want = held
    for rows in epochs:
        want = spark.createDataFrame(M.merge_twins(want, frame(schema, *rows)).collect(), empty.schema)
    mixed = [row for rows in epochs for row in rows]
    rng.shuffle(mixed)
    got = M.merge_twin_epochs(held, frame(schema, *mixed), lanes=4)
    assert rows_of(got, *shown) == rows_of(want, *shown) and got.count() > 4


def test_consumer_numbers_continue(frame):
    known = frame("consumer_id string, scanned_id bigint", ("1", 10))
    got = M.number_consumers(known, frame("consumer_id string", ("1",), ("2",), ("3",), ("2",), ("MISSING",), (None,)))
    assert sorted(r.scanned_id for r in got.collect()) == [10, 11, 12] and got.count() == 3


def test_ownership(frame):
    eq = frame("equipment_key string, serial string, material string, ship_start date, ship_end date, ship_to string, sold_to string, transit_status string",
               ("k", "0012", "m", date(2024, 1, 1), date(2024, 2, 1), "a", "b", "SHIPPED"), ("k", "0012", "m", date(2024, 2, 1), date(2111, 11, 11), "c", "b", "SHIPPED"))
    accounts = frame("account_id string, name string, city string, country string", ("b", "Buyer", "X", "US"), ("c", "Clinic", "Y", "US"))
    got = M.ownership(eq, frame("code string, description string", ("m", "Device")), accounts, frame("account_id string, territory string", ("c", "CP1")))
    assert rows_of(got, "external_serial", "ship_to_name", "sold_to_name", "territory", "product_name") == [("12", "Clinic", "Buyer", "CP1", "Device")]
