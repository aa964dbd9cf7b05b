"""Broadcasts are judged by the rows in memory, not by the size of a packed file."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from usagelake.catalog import business
from usagelake.catalog.registry import Tables
from usagelake.plans import billing
from usagelake.session import fits, plan_bytes, settle, small


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def card(spark):
    return F.when(F.col("id") >= 0, "the same card").alias("card")


def packed(spark, card):
    """300,000 cards of some MB in memory, of a few KB as a file."""
    return settle(spark.range(300_000).select(card, F.lit("P").alias("promotion_uuid"),
                                               F.lit(date(2000, 1, 1)).alias("effective"), F.lit(date(2001, 1, 1)).alias("termination")))


def test_a_table_that_is_small_only_as_a_file_is_not_broadcast(spark, card):
    cards = packed(spark, card)
    assert plan_bytes(cards) < 1_000_000 and not fits(cards, 1_000_000) and fits(cards, 100_000_000)
    few = spark.range(3).select(card)
    assert "Broadcast" not in plan(few.join(small(cards, 1_000_000), "card"))
    assert "BroadcastHashJoin" in plan(few.join(small(cards, 100_000_000), "card"))


def test_cards_of_all_programmes_are_not_broadcast_by_the_size_of_their_file(spark, frame, card):
    ref = billing.Reference(
        promotions=frame("promotion_uuid string, device_type string, rule_type string, effective date, termination date", ("P", "D", "Consumer", date(2000, 1, 1), date(2001, 1, 1))),
        accounts=frame("account_uuid string, ship_to string, promotion_uuid string, effective date, termination date, per_patient boolean", ("A", "1", "P", date(2000, 1, 1), date(2001, 1, 1), True)),
        cards=packed(spark, card), applicators=None, classes=None, account_flags=None, flag_types=None, invoices=None, periods=None, rules=(), active_promotions=())
    cycles = spark.range(2).select("id", card, F.when(F.col("id") >= 0, "1").alias("ship_to"), F.when(F.col("id") >= 0, "D").alias("device_type"))
    joined = plan(billing._on_programmes(cycles, ref, "inner"))
    assert "SortMergeJoin [card" in joined and joined.count("BroadcastExchange") <= 2


def test_cycles_are_joined_once_for_visits_and_their_flags(frame, tmp_path):
    tables = {
        "nation": frame("n_nationkey int, n_name string, n_regionkey int", (1, "N", 1)),
        "supplier": frame("s_suppkey long, s_name string, s_nationkey int", (5, "S", 1)),
        "part": frame("p_partkey long, p_size int", (7, 3)),
        "orders": frame("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
                        (1, 11, "F", datetime(1997, 5, 5), "1-URGENT"), (2, 11, "O", datetime(1997, 5, 5), "1-URGENT")),
        "lineitem": frame("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_linestatus string", (1, 7, 5, 40.0, "F"), (2, 7, 5, 40.0, "O")),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(frame("x int").sparkSession, str(tmp_path))
    visits = business.visits_of(t, business.reference(t), "Consumer")
    assert "l_orderkey" not in plan(visits)
    assert [(r.consumer_id, r.cycle_count, r.flag_type) for r in visits.collect()] == [("11", 1, "Fraud")]
