"""Equipment history: serials of many rows in buckets, and what a splice shuffles."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.plans import masters as M

CHANGE = ("equipment_key string, serial string, material string, changed_on string, created_on string, status string, transit_status string, ship_to string, "
          "mfg_batch string, file_path string, created_at timestamp, load_order bigint")
SHOWN = ("equipment_key", "serial", "ship_start", "ship_end", "movement_status", "return_date", "load_order")


def cleaned(frame, rows):
    return M.clean_equipment(frame(CHANGE, *rows))


def blank(changes):
    return changes.limit(0).withColumns(
        {"ship_end": F.lit(None).cast("date"), "movement_status": F.lit(None).cast("string"), "return_date": F.lit(None).cast("date")})


def some_rows(n):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        day = date.fromordinal(date(2023, 1, 1).toordinal() + rng.randint(0, 80)).strftime("%Y%m%d")
        rows.append((f"k{i:03d}", rng.choice(["a", "b", None, None]), "M", rng.choice([day, day, day, "20239999"]), "20240101", "OK",
                     rng.choice(["SHIPPED", "IN WAREHOUSE"]), "s", "b", "x/BW/f.csv", datetime(2024, 1, 1), None))
    return rows


@pytest.mark.parametrize("hot", [1, 15, 4096])
def test_splices_equal_plain_python_whatever_is_hot(spark, frame, monkeypatch, hot):
    monkeypatch.setattr(M, "HOT_ROWS", hot)
    rows = some_rows(70)
    empty = blank(cleaned(frame, rows))
    history = empty
    for part in (rows[:40], rows[40:], rows[30:50]):
        history = spark.createDataFrame(M.equipment_history(history, cleaned(frame, part)).collect(), empty.schema)
    got = rows_of(history, *SHOWN)
    by_serial = {}
    for key, serial, _, changed, _, _, status, *_ in rows:
        day = None if changed.endswith("9999") else datetime.strptime(changed, "%Y%m%d").date()
        by_serial.setdefault((serial or "UNKNOWN").upper(), []).append((day or date.min, key, day, status))
    # Rows of one day keep the order in which they came, so numbers are compared by day.
    assert len(got) == len(rows)
    for serial, moves in by_serial.items():
        of = sorted((r for r in got if r[1] == serial), key=lambda r: -r[6])
        assert [r[6] for r in of] == list(range(len(moves), 0, -1))
        assert [r[2] for r in of] == [m[2] for m in sorted(moves)]
        assert [r[3] for r in of] == [*(r[2] or date(2111, 11, 11) for r in of[1:]), date(2111, 11, 11)]
        status = {m[1]: m[3] for m in moves}
        for i, r in enumerate(of):
            back = status[r[0]] == "IN WAREHOUSE" and i > 0 and status[of[i - 1][0]] == "SHIPPED"
            assert (r[4], r[5]) == (("RETURNED", r[2]) if back else (status[r[0]], None))


def test_a_splice_shuffles_rows_once(spark, frame):
    rows = some_rows(30)
    first = cleaned(frame, rows[:20])
    history = spark.createDataFrame(M.equipment_history(blank(first), first).collect(), blank(first).schema)
    plan = M.equipment_history(history, cleaned(frame, rows[15:]))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 1
