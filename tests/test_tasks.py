"""Tasks of bounded size: what a task takes doesn't grow with the input, and no join on few keys deals all rows to few tasks."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from usagelake.operators.temporal import other_owner_join
from usagelake.plans import audit, billing
from usagelake.session import _RUNTIME, small_by_nature, tune


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tuned(spark):
    before = {key: spark.conf.get(key, None) for key in _RUNTIME}
    yield tune(spark)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_shuffle_is_cut_by_size_not_by_a_fixed_number_of_partitions(tuned):
    rows = tuned.range(1_000_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).groupBy("s").agg(F.min("id"))
    assert tuned.conf.get("spark.sql.shuffle.partitions") == "2"
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 2


def test_rows_made_by_the_driver_and_totals_are_broadcast(spark, frame):
    few = frame("k string, n int", ("a", 1), ("b", 2), ("b", 3))
    total = few.groupBy("k").agg(F.max("n").alias("n"))
    facts = spark.range(10).withColumn("k", F.when(F.col("id") >= 0, "b").otherwise("a"))
    joined = facts.join(small_by_nature(total), "k")
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)
    assert {r.n for r in joined.collect()} == {3}
    assert "SortMergeJoin" in plan(facts.join(small_by_nature(few, limit=1).hint("merge"), "k"))


def test_lines_get_prices_without_being_dealt_by_class(spark, frame):
    classes = frame("class_uuid string, promotion_uuid string, class_name string, list_price int, calc_type string, effective date, termination date",
                    ("c", "P", "Fee", 5, "PerCycle", date(2000, 1, 1), date(2001, 1, 1)))
    lines = spark.range(3).select(F.lit("Fee").alias("class_name"), F.lit("P").alias("promotion_uuid"), F.lit(date(2000, 5, 5)).alias("cycle_date"))
    priced = billing._priced(lines, classes)
    assert "SortMergeJoin" not in plan(priced) and [r.list_price for r in priced.collect()] == [5, 5, 5]


def test_last_invoices_reach_visits_without_being_dealt_by_programme(spark, frame):
    usage = spark.range(2).select(
        F.lit("1").alias("consumer_id"), F.lit("P").alias("promotion_uuid"), F.lit("p").alias("plan_type"), F.lit("Yes").alias("efficacy"),
        F.lit("").alias("flag_type"), F.lit("").alias("flag_sub_type"), F.lit(date(2000, 5, 5)).alias("cycle_date"),
        F.lit("a").alias("account_uuid"), F.col("id").cast("timestamp").alias("first_cycle_ts"), F.col("id").cast("string").alias("visit_id"))
    subs = frame("consumer_id string, promotion_uuid string, subscription_uuid string, sub_start date, sub_end date, pilot_flag string, "
                 "comments string, created_at timestamp, version int")
    invoices = frame("promotion_uuid string, invoice_date date", ("P", date(2000, 6, 1)), ("P", date(1999, 6, 1)))
    facts = audit.visit_facts(usage, subs, invoices, date(2001, 1, 1))
    assert "promotion_uuid" not in "".join(x for x in plan(facts).splitlines() if "hashpartitioning(promotion_uuid" in x)
    assert [r.late for r in facts.collect()] == [True, True]


def test_usage_is_read_once_for_all_its_joins(spark, frame):
    usage = spark.range(4).select(
        F.lit("c").alias("card"), F.lit("US").alias("country"), F.col("id").alias("ship_to"), F.lit(date(2000, 5, 5)).alias("cycle_date"))
    sent = frame("serial string, country string, ship_start date, ship_end date, ship_to long, sold_to long, transit_status string",
                 ("c", "US", date(2000, 1, 1), date(2001, 1, 1), 1, 1, "SHIPPED"))
    accounts = frame("ship_to long, account_uuid string, effective date, termination date", (2, "a", date(2000, 1, 1), date(2000, 12, 31)))
    out = billing.cards_used_elsewhere(usage, sent, accounts)
    assert "Range (" not in plan(out)
    assert sorted((r.ship_to, r.sent_ship_to, r.sent_in_programme) for r in out.collect()) == [(0, 1, 0), (3, 1, 0)]


def test_slots_of_owners_are_made_once(frame):
    held = frame("k int, a date, b date, who string", (1, date(2000, 1, 1), date(2000, 2, 1), "x"), (1, date(2000, 1, 5), date(2000, 1, 9), "y"))
    asked = frame("k int, at date, who string", (1, date(2000, 1, 6), "x"), (1, date(2000, 1, 6), "z"), (None, date(2000, 1, 6), "x"))
    out = other_owner_join(asked, held, ["k"], at="at", start="a", end="b", owner="who", take={"other": "who"})
    assert "lag(" not in plan(out)
    assert sorted((r.who, r.k, r.other) for r in out.collect() if r.k) == [("x", 1, "y"), ("z", 1, "x")]
