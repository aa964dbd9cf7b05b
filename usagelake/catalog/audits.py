"""Checks of the billing engine's lines against lines recomputed from usage, with errors planted in the lines."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog import business as C
from usagelake.catalog.registry import Tables, query
from usagelake.constants import RULE_CONSUMER
from usagelake.plans import audit as A
from usagelake.plans import billing as B
from usagelake.session import settle

PERIOD = datetime(2001, 8, 1), datetime(2001, 10, 1)


def _billed(t: Tables, ref: B.Reference) -> tuple[DataFrame, DataFrame]:
    """(lines that the rules write, lines recomputed) of all consumer visits in one batch."""
    usage = settle(C.visits_of(t, ref, RULE_CONSUMER))
    state = C.empty_state(t)
    flagged = settle(B.flag_visits(usage, state, ref, RULE_CONSUMER, C.CLOCK))
    opened = settle(B.open_subscriptions(state.subscriptions, flagged, ref, RULE_CONSUMER, C.CLOCK))
    details = B.live_details(flagged, B.State(opened, state.details), ref, RULE_CONSUMER, C.CLOCK)
    return details, A.recomputed_lines(usage, opened, ref.invoices, ref.classes, C.CLOCK.now)


@query("check_lines", f"""
    WITH {C.CYCLES_SQL}, {C.LIVE_SQL},
    lines AS (
        SELECT p.*, row_number() OVER (PARTITION BY l.sub_start IS NOT NULL, CASE WHEN l.sub_start IS NOT NULL THEN p.cid END
                                       ORDER BY p.cycle_date, p.first_ts, p.account_uuid, p.visit_id) AS visit_no, l.sub_start IS NOT NULL AS covered
        FROM pc p LEFT JOIN live l ON p.cid = l.consumer_id AND p.cycle_date BETWEEN l.sub_start AND l.sub_end AND (p.per_cycle = 0 OR p.small = 1)),
    days AS (
        SELECT cid AS consumer_id, account_uuid, cycle_date, CAST(sum(cycle_count) AS BIGINT) AS cycles, day(cycle_date) AS d,
               bool_or(cid <> 'MISSING' AND visit_no > 1 AND coalesce(flag_type, '') <> 'Fraud' AND (small = 0 OR covered)) AS followed
        FROM lines GROUP BY ALL)
    SELECT consumer_id, account_uuid, cycle_date, cycles,
           CASE WHEN d = 23 OR d = 3 AND followed THEN 'Unknown' ELSE 'Matched' END AS class_verdict,
           CASE WHEN d IN (11, 23) THEN 'Unknown' ELSE 'Matched' END AS comment_verdict,
           CASE WHEN d IN (7, 23) THEN 'Unknown' ELSE 'Matched' END AS charge_verdict,
           CASE WHEN d IN (17, 23) THEN 'Unknown' ELSE 'Matched' END AS count_verdict
    FROM days
""")
def check_lines(t: Tables) -> DataFrame:
    """Every visit day is judged; planted: follow-ups made fees, charges and cycles raised, comments typed, lines lost."""
    ref = C.reference(t)
    details, expected = _billed(t, ref)
    day = F.dayofmonth("cycle_date")
    spoilt = details.where(day != 23).withColumns({
        "class_uuid": F.when(day == 3, F.replace("class_uuid", F.lit(":FollowUpVisit"), F.lit(":PerPatientFee"))).otherwise(F.col("class_uuid")),
        "charge": F.col("charge") + F.when(day == 7, 50).otherwise(0),
        "comments": F.when(day == 11, F.lit("typed by hand")).otherwise(F.col("comments")),
        "cycle_count": F.col("cycle_count") + F.when(day == 17, 1).otherwise(0),
    })
    judged = A.check_lines(expected, spoilt, ref.classes, *PERIOD)
    return judged.select("consumer_id", "account_uuid", "cycle_date", F.col("l_cycle_count").alias("cycles"),
                         "class_verdict", "comment_verdict", "charge_verdict", "count_verdict")


_FLAGS_SQL = """
flg_more AS (
    SELECT vis.*, CASE WHEN region = 1 AND cycle_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 'Fraud'
                       WHEN region = 2 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' THEN 'Map'
                       WHEN region = 3 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' THEN 'Offboarding'
                       WHEN region = 4 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' THEN 'TNC' END AS flag_type,
           CASE WHEN region = 2 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' THEN 'PerSubscription'
                WHEN region = 1 AND cycle_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 'PerCycle'
                WHEN region IN (3, 4) AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' THEN 'PerCycle' END AS flag_sub_type
    FROM vis)"""


@query("check_flag_charges", f"""
    WITH {C.CYCLES_SQL}, {_FLAGS_SQL}, {C.LIVE_SQL.replace("FROM flg ", "FROM flg_more ")},
    charged AS (
        SELECT p.* FROM pc p LEFT JOIN live l ON p.cid = l.consumer_id AND p.cycle_date BETWEEN l.sub_start AND l.sub_end
        WHERE p.cid <> 'MISSING' AND p.efficacy = 'Yes'
          AND (p.flag_type IN ('Fraud', 'Offboarding') AND p.small = 0 OR p.flag_type = 'TNC' AND (p.small = 0 OR l.sub_start IS NOT NULL)))
    SELECT cid AS consumer_id, account_uuid, cycle_date, CAST(200 * sum(cycle_count) AS DOUBLE) AS expected,
           CAST(200 * sum(cycle_count) AS DOUBLE) / CASE WHEN day(cycle_date) = 5 THEN 2 ELSE 1 END AS billed,
           CASE WHEN day(cycle_date) = 5 THEN 'Unknown' ELSE 'Matched' END AS charge_verdict
    FROM charged GROUP BY cid, account_uuid, cycle_date
""")
def check_flag_charges(t: Tables) -> DataFrame:
    """Amounts of visits under fraud, terms and offboarding flags, recomputed; planted: half amounts on one day."""
    ref = C.reference(t)
    both = F.explode(F.array(*[F.lit(p) for p in C.PROGRAMMES])).alias("promotion_uuid")
    left = t.nation.where("n_regionkey IN (3, 4)").select("n_nationkey", "n_regionkey", both).select(
        F.when(F.col("n_regionkey") == 3, "left").otherwise("terms").alias("flag_type_uuid"),
        F.concat_ws("/", "promotion_uuid", F.col("n_nationkey").cast("string")).alias("account_uuid"), "promotion_uuid",
        F.lit(date(1996, 1, 1)).alias("flag_start"), F.lit(date(1997, 12, 31)).alias("flag_end"))
    kinds = t.spark.createDataFrame(
        [("left", "Offboarding", "PerCycle", 3), ("terms", "TNC", "PerCycle", 4)], ref.flag_types.schema)
    more = ref.classes.where("class_name = 'NonProgrammeFee'").withColumns({
        "class_name": F.lit("NonProgrammeFeeOffboarding"), "class_uuid": F.concat("promotion_uuid", F.lit(":NonProgrammeFeeOffboarding"))})
    ref = replace(ref, account_flags=ref.account_flags.unionByName(left), flag_types=ref.flag_types.unionByName(kinds),
                  classes=ref.classes.unionByName(more))
    details, expected = _billed(t, ref)
    spoilt = details.withColumn("charge", F.col("charge") / F.when(F.dayofmonth("cycle_date") == 5, 2).otherwise(1))
    judged = A.check_lines(expected, spoilt, ref.classes, *PERIOD, only=A.FLAG_CLASSES)
    return judged.select("consumer_id", "account_uuid", "cycle_date", F.col("l_charge").cast("double").alias("expected"),
                         F.col("r_charge").cast("double").alias("billed"), "charge_verdict")
