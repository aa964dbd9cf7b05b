"""Bucketed group operators against plain windows, with a hot key, nulls and bucket borders."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows_of
from usagelake.operators import dedup as D
from usagelake.operators import groups as G


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(7)
    rows, start = [], datetime(2024, 1, 1)
    for i in range(400):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        at = start + timedelta(hours=rng.randrange(0, 24 * 12, 4)) if rng.random() > 0.03 else None
        rows.append((i, key, at, rng.choice([None, rng.randrange(100)])))
    df = spark.createDataFrame(rows, "id int, key string, at timestamp, value int")
    df.persist().count()
    return df


def same(a, b):
    assert rows_of(a.select(*sorted(a.columns))) == rows_of(b.select(*sorted(b.columns)))


def w():
    return Window.partitionBy("key").orderBy("at", "id")


@pytest.mark.parametrize("bucket", ["1 day", "4 hours", "60 days"])
def test_neighbours_and_numbers(events, bucket):
    got = G.with_neighbours(events, ["key"], ["at", "id"], previous={"p": "value"}, following={"n": "id"},
                            number="k", number_from_end="z", bucket=bucket)
    back = Window.partitionBy("key").orderBy(F.col("at").desc(), F.col("id").desc())
    want = events.select("*", F.lag("value").over(w()).alias("p"), F.lead("id").over(w()).alias("n"),
                         F.row_number().over(w()).cast("long").alias("k"), F.row_number().over(back).cast("long").alias("z"))
    same(got, want)


def test_numbering_without_keys_has_no_gaps(events):
    got = D.assign_sequence(events.where("at IS NOT NULL"), ["at", "id"], "seq", bucket="1 day", start=100)
    numbers = [r.seq for r in got.orderBy("at", "id").collect()]
    assert numbers == list(range(101, 101 + len(numbers)))


def test_fill_forward(events):
    got = G.fill_forward(events, ["key"], ["at", "id"], {"filled": "value"}, bucket="1 day")
    want = events.withColumn("filled", F.last("value", ignorenulls=True).over(w()))
    same(got, want)


def test_group_totals_and_marks(events):
    part = Window.partitionBy("key")
    got = G.with_group_totals(events, ["key"], n=F.count(F.lit(1)), top=F.max("value"))
    same(got, events.select("*", F.count(F.lit(1)).over(part).alias("n"), F.max("value").over(part).alias("top")))
    marked = D.mark_first_last(events, ["key"], ["at", "id"])
    back = Window.partitionBy("key").orderBy(F.col("at").desc(), F.col("id").desc())
    same(marked, events.select("*", (F.row_number().over(w()) == 1).alias("is_first"), (F.row_number().over(back) == 1).alias("is_last")))


def test_skeleton_gives_the_same_numbers(events):
    fat = events.withColumn("more", F.lit("x"))
    a = G.number_in_group(fat, ["key"], ["at", "id"], "k", bucket="1 day", skeleton=events)
    same(a.drop("more"), G.number_in_group(events, ["key"], ["at", "id"], "k", bucket="1 day"))


def test_text_cannot_be_bucketed(events):
    with pytest.raises(TypeError):
        G.number_in_group(events, ["id"], ["key"], "k", bucket=10)
    with pytest.raises(ValueError):
        G.width_seconds("soon")


def test_latest_by_limits_rows_before_the_shuffle(events):
    last = D.latest_by(events, ["key"], [F.col("at").desc_nulls_last(), F.col("id").desc()])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert last.count() == 4


def test_duplicate_flags(frame):
    day = datetime(2024, 1, 1).date()
    df = frame("card string, nbr int, head int, day date, ext string, at timestamp, shipped int",
               ("c", 1, 0, day, "d1", datetime(2024, 1, 1, 1), 1), ("c", 1, 0, day, "d1", datetime(2024, 1, 1, 2), 1),
               ("c", 1, 0, day, "d2", datetime(2024, 1, 1, 3), 0))
    got = D.duplicate_flags(df, card="card", cycle="nbr", head="head", date="day", device=["ext"], order=["at"],
                            sold=F.col("shipped") == 1, bucket="1 day")
    assert rows_of(got, "at", "unsold_flag", "duplicate_flag", "utilisation_flag", "used_count", "fraud_flag") == [
        (datetime(2024, 1, 1, 1), "N", "N", "N", 1, "N"),
        (datetime(2024, 1, 1, 2), "N", "Y", "Y", 0, "Y"),
        (datetime(2024, 1, 1, 3), "Y", "Y", "Y", 1, "Y"),
    ]


def test_row_key_separates_nulls_and_parts(frame):
    df = frame("a string, b string", ("x", None), ("x", ""), ("xy", "z"), ("x", "yz"))
    assert df.select(D.row_key("a", "b")).distinct().count() == 4
