"""Queries for billing on the test tables.

An order is a cycle: its customer the consumer, the nation of its first supplier
the ship-to, that nation's region the sold-to, its first part the card, its
status the device type. Orders of status F run under a consumer programme,
of status O under a consumer-account programme; status P has none.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog.registry import Tables, query
from usagelake.constants import FULL_PLAN, RULE_CONSUMER, RULE_CONSUMER_ACCOUNT, SMALL_PLAN
from usagelake.plans import billing as B
from usagelake.plans import rules as R
from usagelake.session import settle

CLOCK = B.Clock(datetime(2001, 9, 1))
EARLY = date(1995, 1, 1)
PROGRAMMES = ("P-F", "P-O")
PRICES = {
    "PerPatientFee": (950, "PerSubscription"), "FollowUpVisit": (0, "PerSubscription"),
    "NoPatientAssociationFee": (200, "PerCycle"), "PerCycleFee": (200, "PerCycle"), "FraudViolation": (200, "PerCycle"),
    "NonProgrammeFee": (200, "PerCycle"), "PerCycleEfficacyFail": (0, "PerCycle"),
}


def cycles(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_partkey").cast("string").alias("card"), F.min("l_suppkey").alias("s_suppkey"),
        F.max("l_quantity").cast("int").alias("minutes"), F.max("l_linestatus").alias("applicator_cfg"),
    )
    site = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("s_nationkey").cast("string").alias("ship_to"), F.col("n_regionkey").cast("string").alias("sold_to")
    )
    begin = F.col("o_orderdate").cast("timestamp")
    return (
        t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(site, "s_suppkey", "left")
        .select(
            F.col("o_orderkey").alias("cycle_id"), F.col("o_custkey").cast("string").alias("consumer_id"), "ship_to", "sold_to",
            F.col("o_orderdate").cast("date").alias("cycle_date"), begin.alias("begin_ts"),
            (begin + F.make_dt_interval(mins=F.col("minutes"))).alias("end_ts"),
            "card", "applicator_cfg", F.col("s_suppkey").cast("string").alias("applicator_serial"),
            F.col("o_orderstatus").alias("device_type"),
            F.when(F.col("o_orderpriority") == "5-LOW", SMALL_PLAN).otherwise(FULL_PLAN).alias("plan_type"),
        )
    )


def reference(t: Tables) -> B.Reference:
    spark = t.spark
    both = F.explode(F.array(*[F.lit(p) for p in PROGRAMMES])).alias("promotion_uuid")
    site = t.nation.select("n_nationkey", "n_regionkey", both)
    uuid = F.concat_ws("/", "promotion_uuid", F.col("n_nationkey").cast("string"))
    flagged = F.col("n_regionkey").isin(1, 2)
    kind = F.when(F.col("n_regionkey") == 1, "fraud").otherwise("map")
    return B.Reference(
        promotions=t.orders.select("o_orderstatus").distinct().where("o_orderstatus <> 'P'").select(
            F.concat(F.lit("P-"), "o_orderstatus").alias("promotion_uuid"), F.col("o_orderstatus").alias("promotion_name"),
            F.col("o_orderstatus").alias("device_type"), F.lit(EARLY).alias("effective"), F.lit(date(2001, 12, 31)).alias("termination"),
            F.when(F.col("o_orderstatus") == "F", RULE_CONSUMER).otherwise(RULE_CONSUMER_ACCOUNT).alias("rule_type"),
        ),
        accounts=site.select(
            uuid.alias("account_uuid"), F.col("n_nationkey").cast("string").alias("ship_to"), "promotion_uuid",
            F.date_add(F.lit(EARLY), F.col("n_nationkey") * 10).alias("effective"), F.lit(date(2001, 5, 1)).alias("termination"),
            (F.col("n_regionkey") != 0).alias("per_patient"),
        ),
        cards=t.part.select("p_partkey", "p_size", both).select(
            F.col("p_partkey").cast("string").alias("card"), "promotion_uuid",
            F.date_add(F.lit(EARLY), F.col("p_size")).alias("effective"), F.lit(date(2001, 7, 1)).alias("termination"),
        ),
        applicators=t.lineitem.select("l_linestatus").distinct().select(
            F.col("l_linestatus").alias("applicator_cfg"), F.when(F.col("l_linestatus") == "F", 20).otherwise(30).alias("full_efficacy")
        ),
        classes=spark.createDataFrame(
            [(f"{p}:{n}", p, n, price, calc, EARLY, date(9999, 12, 31)) for p in PROGRAMMES for n, (price, calc) in PRICES.items()],
            "class_uuid string, promotion_uuid string, class_name string, list_price int, calc_type string, effective date, termination date",
        ),
        account_flags=site.where(flagged).select(
            kind.alias("flag_type_uuid"), uuid.alias("account_uuid"), "promotion_uuid",
            F.when(F.col("n_regionkey") == 1, F.lit(date(1997, 1, 1))).otherwise(F.lit(date(1996, 1, 1))).alias("flag_start"),
            F.lit(date(1998, 6, 30)).alias("flag_end"),
        ),
        flag_types=spark.createDataFrame(
            [("fraud", "Fraud", "PerCycle", 1), ("map", "Map", "PerSubscription", 2)],
            "flag_type_uuid string, flag_type string, flag_sub_type string, flag_rank int",
        ),
        invoices=t.orders.where("o_orderdate < '2000-01-01'").groupBy(F.concat(F.lit("P-"), "o_orderstatus").alias("promotion_uuid")).agg(
            F.max("o_orderdate").cast("date").alias("invoice_date")
        ),
        periods=spark.createDataFrame([], "invoice_date date, period_start timestamp, period_end timestamp"),
        rules=[*R.seed_rules("P-F"), *R.seed_rules("P-O", full=False)],
        active_promotions=list(PROGRAMMES),
    )


def empty_state(t: Tables) -> B.State:
    return B.State(t.spark.createDataFrame([], B.SUBSCRIPTION_SCHEMA), t.spark.createDataFrame([], B.DETAIL_SCHEMA))


def visits_of(t: Tables, ref: B.Reference, rule_type: str) -> DataFrame:
    # Stored, as the flags read the visits too: cycles would be joined and broadcast to twice.
    return B.with_flags(settle(B.aggregate_visits(B.eligible_cycles(cycles(t), ref))), ref).where(F.col("rule_type") == rule_type)


CYCLES_SQL = """
cyc AS (
    SELECT o_orderkey AS cycle_id, CAST(o_custkey AS VARCHAR) AS consumer_id, CAST(s_nationkey AS VARCHAR) AS ship_to,
           CAST(n_regionkey AS VARCHAR) AS sold_to, n_regionkey, s_nationkey, CAST(o_orderdate AS DATE) AS cycle_date,
           o_orderdate AS begin_ts, minutes, card, cfg, o_orderstatus AS status, 'P-' || o_orderstatus AS promo,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'SmallTreatmentPlan' ELSE 'ComprehensiveTreatmentPlan' END AS plan_type
    FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS card, min(l_suppkey) AS supp, max(CAST(l_quantity AS INTEGER)) AS minutes,
                                  max(l_linestatus) AS cfg FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
    LEFT JOIN supplier ON supp = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey),
elig AS (
    SELECT cyc.*, promo || '/' || ship_to AS account_uuid,
           CASE WHEN minutes >= CASE cfg WHEN 'F' THEN 20 ELSE 30 END THEN 'Yes' ELSE 'No' END AS efficacy
    FROM cyc JOIN part ON card = p_partkey
    WHERE status <> 'P' AND n_regionkey <> 0
      AND cycle_date BETWEEN DATE '1995-01-01' + s_nationkey * 10 AND DATE '2001-05-01'
      AND cycle_date BETWEEN DATE '1995-01-01' + p_size AND DATE '2001-07-01'),
vis AS (
    SELECT consumer_id, sold_to, ship_to, account_uuid, promo AS promotion_uuid, cycle_date, plan_type, efficacy, any_value(n_regionkey) AS region,
           CASE WHEN promo = 'P-F' THEN 'Consumer' ELSE 'Consumer-ShipTo-SoldTo' END AS rule_type,
           count(*) AS cycle_count, min(begin_ts) AS first_ts, count(DISTINCT card) AS n_cards
    FROM elig GROUP BY consumer_id, sold_to, ship_to, account_uuid, promo, cycle_date, plan_type, efficacy),
flg AS (
    SELECT vis.*, CASE WHEN region = 1 AND cycle_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 'Fraud'
                       WHEN region = 2 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' THEN 'Map' END AS flag_type,
           CASE WHEN region = 1 AND cycle_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 'PerCycle'
                WHEN region = 2 AND cycle_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' THEN 'PerSubscription' END AS flag_sub_type
    FROM vis)"""


@query("eligibility_log", f"""
    WITH {CYCLES_SQL}
    SELECT c.cycle_id, c.cycle_date, strftime(c.cycle_date, '%Y-%m') AS cycle_month, e.cycle_id IS NOT NULL AS eligible
    FROM cyc c LEFT JOIN elig e ON c.cycle_id = e.cycle_id
""")
def eligibility_log(t: Tables) -> DataFrame:
    return B.best_eligibility(B.eligibility_log(cycles(t), reference(t)))


@query("visits", f"""
    WITH {CYCLES_SQL}
    SELECT consumer_id, account_uuid, promotion_uuid, cycle_date, plan_type, efficacy, cycle_count, n_cards FROM vis
""")
def visits(t: Tables) -> DataFrame:
    out = B.aggregate_visits(B.eligible_cycles(cycles(t), reference(t)))
    return out.select("consumer_id", "account_uuid", "promotion_uuid", "cycle_date", "plan_type", "efficacy", "cycle_count", "n_cards")


@query("visit_members", f"""
    WITH {CYCLES_SQL},
    m AS (SELECT consumer_id, promo AS promotion_uuid, 'card' AS kind, CAST(card AS VARCHAR) AS value FROM elig
          UNION SELECT consumer_id, promo, 'cycle', CAST(cycle_id AS VARCHAR) FROM elig)
    SELECT consumer_id, promotion_uuid, kind, count(DISTINCT value) AS n, min(value) AS lowest FROM m GROUP BY ALL
""")
def visit_members(t: Tables) -> DataFrame:
    eligible = B.eligible_cycles(cycles(t), reference(t))
    named = B.visit_members(eligible).where("kind <> 'applicator'").join(
        B.aggregate_visits(eligible).select("visit_id", "consumer_id", "promotion_uuid"), "visit_id"
    )
    return named.groupBy("consumer_id", "promotion_uuid", "kind").agg(F.count_distinct("value").alias("n"), F.min("value").alias("lowest"))


@query("flags_as_of", f"""
    WITH {CYCLES_SQL}
    SELECT DISTINCT account_uuid, promotion_uuid, cycle_date, flag_type, flag_sub_type FROM flg WHERE flag_type IS NOT NULL
""")
def flags_as_of(t: Tables) -> DataFrame:
    ref = reference(t)
    return B.flags_as_of(B.aggregate_visits(B.eligible_cycles(cycles(t), ref)), ref)


@query("rules_fold", f"""
    WITH {CYCLES_SQL},
    r AS (SELECT consumer_id AS raw_id, account_uuid, promotion_uuid, cycle_date, plan_type, efficacy, flag_type, flag_sub_type,
                 CASE WHEN coalesce(TRY_CAST(consumer_id AS BIGINT), 0) = 0 THEN 'MISSING' ELSE consumer_id END AS consumer_id,
                 CASE WHEN plan_type LIKE 'Small%' THEN 1 ELSE 0 END AS is_small_plan FROM flg),
    a AS (SELECT *, CASE WHEN consumer_id = 'MISSING' THEN 1 ELSE 0 END AS is_anonymous FROM r)
    SELECT raw_id, account_uuid, promotion_uuid, cycle_date, plan_type, efficacy, consumer_id, is_small_plan, is_anonymous,
           CASE WHEN cycle_date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderdate < '2000-01-01' AND 'P-' || o_orderstatus = promotion_uuid)
                THEN 1 ELSE 0 END AS is_late,
           CASE WHEN is_anonymous = 1 OR is_small_plan = 1 OR coalesce(flag_sub_type, '') = 'PerCycle' THEN 1 ELSE 0 END AS is_per_cycle,
           CASE WHEN promotion_uuid = 'P-O' THEN 1 WHEN efficacy = 'Yes' THEN 1 ELSE 0 END AS is_effective,
           CASE WHEN promotion_uuid = 'P-F' THEN CASE WHEN coalesce(flag_type, '') = 'Fraud' THEN 1 ELSE 0 END END AS is_fraud
    FROM a
""")
def rules_fold(t: Tables) -> DataFrame:
    ref = reference(t)
    raw = B.with_flags(B.aggregate_visits(B.eligible_cycles(cycles(t), ref)), ref).withColumns(
        {
            "raw_id": F.col("consumer_id"), "subscription_uuid": F.lit(None).cast("string"), "pilot_flag": F.lit(None).cast("string"),
            "previous_end": F.lit(None).cast("date"), "sub_start": F.lit(None).cast("date"),
        }
    )
    dated = raw.join(B.last_invoice_dates(ref.invoices), "promotion_uuid", "left")
    out = R.apply_rules(dated, ref.rules, R.CYCLE, promotions=ref.active_promotions, as_of=CLOCK.today)
    return out.select(
        "raw_id", "account_uuid", "promotion_uuid", "cycle_date", "plan_type", "efficacy", "consumer_id", "is_small_plan",
        "is_anonymous", "is_late", "is_per_cycle", "is_effective", "is_fraud",
    )


# Subscriptions made of the small-plan visits; low efficacy marks a pilot.
def sample_subscriptions(t: Tables, ref: B.Reference) -> DataFrame:
    some = B.aggregate_visits(B.eligible_cycles(cycles(t), ref)).where(F.col("plan_type") == SMALL_PLAN)
    keys = ["consumer_id", "account_uuid", "sold_to", "promotion_uuid", "cycle_date"]
    one = some.groupBy(*keys).agg(F.min("efficacy").alias("efficacy"))
    return one.select(
        F.concat_ws("|", *keys).alias("subscription_uuid"), "consumer_id", "account_uuid", "sold_to", "promotion_uuid",
        F.col("cycle_date").alias("sub_start"), F.date_add("cycle_date", 150).alias("sub_end"),
        F.when(F.col("efficacy") == "No", "Y").alias("pilot_flag"), F.lit(1).alias("version"),
        F.lit(None).cast("string").alias("comments"), F.lit(None).cast("string").alias("exception_flag"),
    )


SUBS_SQL = """
sub AS (
    SELECT concat_ws('|', consumer_id, account_uuid, sold_to, promotion_uuid, CAST(cycle_date AS VARCHAR)) AS uuid, consumer_id, account_uuid,
           sold_to, promotion_uuid, cycle_date AS sub_start, cycle_date + 150 AS sub_end, CASE WHEN min(efficacy) = 'No' THEN 'Y' ELSE 'N' END AS pilot
    FROM vis WHERE plan_type = 'SmallTreatmentPlan' GROUP BY consumer_id, account_uuid, sold_to, promotion_uuid, cycle_date)"""


@query("subscription_match_consumer", f"""
    WITH {CYCLES_SQL}, {SUBS_SQL},
    rng AS (SELECT *, coalesce(lag(sub_end) OVER (PARTITION BY consumer_id ORDER BY sub_end, sub_start, uuid), sub_start - 150) AS prev FROM sub)
    SELECT v.consumer_id, v.account_uuid, v.promotion_uuid, v.cycle_date, v.plan_type, v.efficacy, r.uuid AS subscription_uuid, r.prev AS previous_end
    FROM vis v LEFT JOIN rng r ON v.consumer_id = r.consumer_id AND v.promotion_uuid = r.promotion_uuid AND v.cycle_date BETWEEN r.prev AND r.sub_end
    WHERE v.promotion_uuid = 'P-F'
    QUALIFY row_number() OVER (PARTITION BY v.consumer_id, v.account_uuid, v.promotion_uuid, v.cycle_date, v.plan_type, v.efficacy
                               ORDER BY r.sub_end DESC NULLS LAST, r.pilot, r.uuid DESC) = 1
""")
def subscription_match_consumer(t: Tables) -> DataFrame:
    return _matched(t, RULE_CONSUMER, "P-F")


@query("subscription_match_account", f"""
    WITH {CYCLES_SQL}, {SUBS_SQL},
    rng AS (SELECT *, coalesce(lag(sub_end) OVER (PARTITION BY account_uuid, consumer_id ORDER BY sub_end, sub_start, uuid), sub_start - 150) AS prev FROM sub)
    SELECT v.consumer_id, v.account_uuid, v.promotion_uuid, v.cycle_date, v.plan_type, v.efficacy, r.uuid AS subscription_uuid, r.prev AS previous_end
    FROM vis v LEFT JOIN rng r ON v.consumer_id = r.consumer_id AND v.promotion_uuid = r.promotion_uuid AND v.cycle_date BETWEEN r.prev AND r.sub_end
      AND (v.account_uuid = r.account_uuid OR (v.sold_to = r.sold_to AND v.account_uuid <> r.account_uuid))
    WHERE v.promotion_uuid = 'P-O'
    QUALIFY row_number() OVER (PARTITION BY v.consumer_id, v.account_uuid, v.promotion_uuid, v.cycle_date, v.plan_type, v.efficacy
                               ORDER BY r.pilot NULLS LAST, r.sub_end DESC NULLS LAST, r.uuid DESC) = 1
""")
def subscription_match_account(t: Tables) -> DataFrame:
    return _matched(t, RULE_CONSUMER_ACCOUNT, "P-O")


def _matched(t: Tables, rule_type: str, promotion: str) -> DataFrame:
    ref = reference(t)
    of_type = settle(B.aggregate_visits(B.eligible_cycles(cycles(t), ref)).where(F.col("promotion_uuid") == promotion))
    out = B.match_subscriptions(of_type, sample_subscriptions(t, ref), rule_type, EARLY)
    return out.select(
        "consumer_id", "account_uuid", "promotion_uuid", "cycle_date", "plan_type", "efficacy", "subscription_uuid", "previous_end"
    )


LIVE_SQL = """
fv AS (
    SELECT *, CASE WHEN coalesce(TRY_CAST(consumer_id AS BIGINT), 0) = 0 THEN 'MISSING' ELSE consumer_id END AS cid,
           CASE WHEN plan_type = 'SmallTreatmentPlan' THEN 1 ELSE 0 END AS small,
           sha256(concat_ws(chr(31), consumer_id, sold_to, ship_to, account_uuid, promotion_uuid, CAST(cycle_date AS VARCHAR), rule_type, plan_type, efficacy)) AS visit_id
    FROM flg WHERE promotion_uuid = 'P-F'),
pc AS (SELECT *, CASE WHEN cid = 'MISSING' OR small = 1 OR coalesce(flag_sub_type, '') = 'PerCycle' THEN 1 ELSE 0 END AS per_cycle FROM fv),
live AS (
    SELECT cid AS consumer_id, account_uuid, sold_to, promotion_uuid, cycle_date AS sub_start, cycle_date + 150 AS sub_end
    FROM pc WHERE per_cycle = 0
    QUALIFY row_number() OVER (PARTITION BY cid, promotion_uuid ORDER BY cycle_date, first_ts, account_uuid, visit_id) = 1)"""


def _flagged(t: Tables, ref: B.Reference) -> DataFrame:
    return settle(B.flag_visits(settle(visits_of(t, ref, RULE_CONSUMER)), empty_state(t), ref, RULE_CONSUMER, CLOCK))


@query("subscriptions_live", f"WITH {CYCLES_SQL}, {LIVE_SQL} SELECT * FROM live")
def subscriptions_live(t: Tables) -> DataFrame:
    ref = reference(t)
    opened = B.open_subscriptions(empty_state(t).subscriptions, _flagged(t, ref), ref, RULE_CONSUMER, CLOCK)
    return opened.select("consumer_id", "account_uuid", "sold_to", "promotion_uuid", "sub_start", "sub_end")


DETAIL_SQL = """
    m AS (
        SELECT p.*, l.sub_start, row_number() OVER (PARTITION BY CASE WHEN l.sub_start IS NOT NULL THEN p.cid END ORDER BY p.cycle_date, p.first_ts, p.account_uuid, p.visit_id) AS visit_no
        FROM pc p LEFT JOIN live l ON p.cid = l.consumer_id AND p.cycle_date BETWEEN l.sub_start AND l.sub_end AND (p.per_cycle = 0 OR p.small = 1)),
    f AS (
        SELECT *, CASE WHEN visit_no = 1 THEN 1 ELSE 0 END AS pp, CASE WHEN cid = 'MISSING' THEN 1 ELSE 0 END AS anon,
               CASE WHEN coalesce(flag_type, '') = 'Fraud' THEN 1 ELSE 0 END AS fraud,
               CASE WHEN coalesce(flag_type, '') = 'Map' AND visit_no = 1 AND cid <> 'MISSING' THEN 1 ELSE 0 END AS mapv,
               CASE WHEN cycle_date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderdate < '2000-01-01' AND o_orderstatus = 'F') THEN 1 ELSE 0 END AS late
        FROM m),
    k AS (
        SELECT *, CASE WHEN anon = 1 THEN 'NoPatientAssociationFee'
                       WHEN small = 1 AND (sub_start IS NULL OR fraud = 1 OR mapv = 1) THEN 'PerCycleFee'
                       WHEN fraud = 1 THEN 'FraudViolation' WHEN pp = 1 THEN 'PerPatientFee' ELSE 'FollowUpVisit' END AS pre
        FROM f),
    c AS (SELECT *, CASE WHEN efficacy = 'No' AND pre NOT IN ('FollowUpVisit', 'PerPatientFee') THEN 'PerCycleEfficacyFail' ELSE pre END AS class FROM k),
    n AS (
        SELECT *, CASE WHEN class = 'PerCycleEfficacyFail' THEN 'PerCycleEfficacyFail'
                       WHEN late = 1 AND anon = 0 AND small = 1 AND (sub_start IS NULL OR fraud = 1 OR mapv = 1) THEN 'LateCycle_PerCycleFee'
                       WHEN late = 1 AND fraud = 1 AND anon = 0 AND small = 0 THEN 'LateCycle_Flag_FraudViolation'
                       WHEN fraud = 1 AND anon = 0 AND small = 0 THEN 'Flag_FraudViolation'
                       WHEN late = 0 THEN '' WHEN anon = 1 THEN 'LateCycle_NoPatientAssociation'
                       WHEN pp = 1 THEN 'LateCycle_NewSubscription' ELSE 'LateCycle_FollowUp' END AS comments
        FROM c)"""


@query("detail_lines", f"""
    WITH {CYCLES_SQL}, {LIVE_SQL}, {DETAIL_SQL}
    SELECT cid AS consumer_id, account_uuid, cycle_date, class, comments, CAST(sum(cycle_count) AS BIGINT) AS cycle_count,
           CAST(CASE WHEN class IN ('PerPatientFee') THEN 950 WHEN class IN ('FollowUpVisit', 'PerCycleEfficacyFail') THEN 0 ELSE 200 * sum(cycle_count) END AS DOUBLE) AS charge
    FROM n GROUP BY cid, account_uuid, sold_to, cycle_date, class, comments, sub_start
""")
def detail_lines(t: Tables) -> DataFrame:
    ref = reference(t)
    flagged = _flagged(t, ref)
    state = empty_state(t)
    opened = settle(B.open_subscriptions(state.subscriptions, flagged, ref, RULE_CONSUMER, CLOCK))
    details = B.live_details(flagged, B.State(opened, state.details), ref, RULE_CONSUMER, CLOCK)
    return details.select(
        "consumer_id", "account_uuid", "cycle_date", F.element_at(F.split("class_uuid", ":"), -1).alias("class"), "comments",
        "cycle_count", F.col("charge").cast("double").alias("charge"),
    )


@query("late_adjust", f"""
    WITH {CYCLES_SQL}, {LIVE_SQL},
    held AS (
        SELECT cid AS consumer_id, account_uuid, cycle_date AS sub_start FROM pc WHERE per_cycle = 0 AND cycle_date >= DATE '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY cid ORDER BY cycle_date, first_ts, account_uuid, visit_id) = 1),
    moved AS (
        SELECT h.consumer_id, h.account_uuid, p.cycle_date AS new_start FROM held h JOIN pc p ON p.cid = h.consumer_id
        WHERE p.cycle_date < DATE '1998-01-01' AND p.per_cycle = 0 AND p.cycle_date > h.sub_start - 150 AND p.cycle_date < h.sub_start
        QUALIFY row_number() OVER (PARTITION BY h.consumer_id ORDER BY p.cycle_date) = 1)
    SELECT h.consumer_id, h.account_uuid, h.sub_start, h.sub_start + 150 AS sub_end, CASE WHEN m.consumer_id IS NULL THEN 1 ELSE 2 END AS version,
           CASE WHEN m.consumer_id IS NOT NULL THEN 'LateCycle_SubscriptionAdjust' END AS comments
    FROM held h LEFT JOIN moved m USING (consumer_id)
    UNION ALL
    SELECT consumer_id, account_uuid, new_start, new_start + 150, 1, 'LateCycle_SubscriptionAdjust' FROM moved
""")
def late_adjust(t: Tables) -> DataFrame:
    ref = reference(t)
    every = settle(visits_of(t, ref, RULE_CONSUMER))
    state = empty_state(t)
    first = settle(B.flag_visits(every.where("cycle_date >= '1998-01-01'"), state, ref, RULE_CONSUMER, CLOCK))
    held = settle(B.open_subscriptions(state.subscriptions, first, ref, RULE_CONSUMER, CLOCK))
    clock = B.Clock(datetime(1998, 6, 1))
    late = B.flag_visits(every.where("cycle_date < '1998-01-01'"), B.State(held, state.details), ref, RULE_CONSUMER, clock)
    return B.adjust_subscriptions(held, late, ref, clock).select(
        "consumer_id", "account_uuid", "sub_start", "sub_end", "version", "comments"
    )


@query("billing_batch", f"""
    WITH {CYCLES_SQL}, {LIVE_SQL}, {DETAIL_SQL},
    fo AS (
        SELECT *, CASE WHEN coalesce(TRY_CAST(consumer_id AS BIGINT), 0) = 0 THEN 'MISSING' ELSE consumer_id END AS cid,
               CASE WHEN plan_type = 'SmallTreatmentPlan' THEN 1 ELSE 0 END AS small,
               sha256(concat_ws(chr(31), consumer_id, sold_to, ship_to, account_uuid, promotion_uuid, CAST(cycle_date AS VARCHAR), rule_type, plan_type, efficacy)) AS visit_id
        FROM flg WHERE promotion_uuid = 'P-O'),
    po AS (SELECT *, CASE WHEN cid = 'MISSING' OR small = 1 OR coalesce(flag_sub_type, '') = 'PerCycle' THEN 1 ELSE 0 END AS per_cycle FROM fo),
    live_o AS (
        SELECT cid, sold_to, account_uuid, cycle_date AS sub_start, cycle_date + 150 AS sub_end FROM po WHERE per_cycle = 0
        QUALIFY row_number() OVER (PARTITION BY cid, sold_to ORDER BY cycle_date, first_ts, account_uuid, visit_id) = 1),
    mo AS (
        SELECT p.*, l.sub_start, p.account_uuid <> l.account_uuid AS elsewhere,
               row_number() OVER (PARTITION BY l.sub_start IS NULL, CASE WHEN l.sub_start IS NOT NULL THEN p.cid END, CASE WHEN l.sub_start IS NOT NULL THEN p.sold_to END
                                  ORDER BY p.cycle_date, p.first_ts, p.account_uuid, p.visit_id) AS visit_no,
               p.cycle_date <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderdate < '2000-01-01' AND o_orderstatus = 'O') AS late
        FROM po p LEFT JOIN live_o l ON p.cid = l.cid AND p.sold_to = l.sold_to AND p.cycle_date BETWEEN l.sub_start AND l.sub_end
          AND (p.account_uuid <> l.account_uuid OR p.per_cycle = 0 OR p.small = 1)),
    no AS (
        SELECT *, CASE WHEN cid = 'MISSING' THEN 'NoPatientAssociationFee' WHEN visit_no > 1 THEN 'FollowUpVisit'
                       WHEN small = 1 THEN 'PerCycleFee' ELSE 'PerPatientFee' END AS class,
               CASE WHEN elsewhere AND visit_no > 1 THEN CASE WHEN late THEN 'DifferentShipToID_LateCycle_FollowUp' ELSE 'DifferentShipToID_FollowUp' END
                    WHEN NOT late THEN '' WHEN cid = 'MISSING' THEN 'LateCycle_NoPatientAssociation' WHEN visit_no > 1 THEN 'LateCycle_FollowUp'
                    WHEN small = 1 THEN 'LateCycle_PerCycleFee' ELSE 'LateCycle_NewSubscription' END AS comments
        FROM mo),
    lines AS (
        SELECT 'P-F' AS promo, cid, class, comments, sum(cycle_count) AS cycles FROM n GROUP BY cid, account_uuid, sold_to, cycle_date, class, comments, sub_start
        UNION ALL
        SELECT 'P-O', cid, class, comments, sum(cycle_count) FROM no GROUP BY cid, account_uuid, sold_to, cycle_date, class, comments, sub_start),
    again AS (SELECT cid FROM (SELECT consumer_id AS cid FROM live UNION ALL SELECT cid FROM live_o) GROUP BY cid HAVING count(*) > 1)
    SELECT promo AS promotion_uuid, promo || ':' || class AS class_uuid,
           CASE WHEN class = 'PerPatientFee' AND comments = '' AND cid IN (SELECT cid FROM again) THEN 'ReturnSubscription' ELSE comments END AS comments,
           count(*) AS n_lines, CAST(sum(cycles) AS BIGINT) AS cycle_count,
           CAST(sum(CASE WHEN class = 'PerPatientFee' THEN 950 WHEN class IN ('FollowUpVisit', 'PerCycleEfficacyFail') THEN 0 ELSE 200 * cycles END) AS DOUBLE) AS charge
    FROM lines GROUP BY ALL
""")
def billing_batch(t: Tables) -> DataFrame:
    """A whole batch over all cycles: both programmes, subscriptions, lines and comments."""
    state, _ = B.run_batch(cycles(t), empty_state(t), reference(t), CLOCK)
    return state.details.groupBy("promotion_uuid", "class_uuid", "comments").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("cycle_count").alias("cycle_count"), F.sum("charge").cast("double").alias("charge")
    )


@query("cards_used_elsewhere", """
    WITH supply AS (
        SELECT l_partkey, l_shipdate AS a, suppkey, lead(l_shipdate, 1, TIMESTAMP '2111-11-11') OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS b
        FROM (SELECT l_partkey, l_shipdate, min(l_suppkey) AS suppkey FROM lineitem GROUP BY ALL)),
    usage AS (SELECT l_partkey, l_suppkey, o_orderdate, count(*) AS cycles FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
    SELECT CAST(u.l_partkey AS VARCHAR) AS card, u.l_suppkey AS ship_to, s.suppkey AS sent_ship_to, CAST(u.o_orderdate AS DATE) AS cycle_date, u.cycles,
           CASE WHEN ms.s_nationkey < 5 AND u.o_orderdate BETWEEN '1996-01-01' AND '1999-12-31' THEN 1 ELSE 0 END AS sent_in_programme
    FROM usage u JOIN supply s ON s.l_partkey = u.l_partkey AND u.o_orderdate >= s.a AND u.o_orderdate < s.b
    JOIN supplier mu ON mu.s_suppkey = u.l_suppkey JOIN supplier ms ON ms.s_suppkey = s.suppkey
    WHERE s.suppkey <> u.l_suppkey AND NOT (mu.s_nationkey < 5 AND u.o_orderdate BETWEEN '1996-01-01' AND '1999-12-31')
""")
def cards_used_elsewhere(t: Tables) -> DataFrame:
    from usagelake.operators.temporal import scd2_from_changes

    daily = t.lineitem.groupBy("l_partkey", F.col("l_shipdate").cast("date").alias("ship_start")).agg(F.min("l_suppkey").alias("ship_to"))
    shipments = scd2_from_changes(daily, "l_partkey", ["ship_start"], start="ship_start", end="ship_end").select(
        F.col("l_partkey").cast("string").alias("serial"), "ship_start", "ship_end", "ship_to", F.col("ship_to").alias("sold_to"),
        F.lit("SHIPPED").alias("transit_status"), F.lit("US").alias("country"),
    )
    # Grouped by the number: a shuffled text would be wider.
    usage = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        "l_partkey", F.col("l_suppkey").alias("ship_to"), F.col("o_orderdate").cast("date").alias("cycle_date")
    ).agg(F.count(F.lit(1)).alias("cycles")).select(
        F.col("l_partkey").cast("string").alias("card"), "ship_to", "cycle_date", "cycles", F.lit("US").alias("country"))
    accounts = t.supplier.where("s_nationkey < 5").select(
        F.col("s_suppkey").alias("ship_to"), F.col("s_name").alias("account_uuid"), F.lit(date(1996, 1, 1)).alias("effective"), F.lit(date(1999, 12, 31)).alias("termination")
    )
    return B.cards_used_elsewhere(usage, shipments, accounts).select("card", "ship_to", "sent_ship_to", "cycle_date", "cycles", "sent_in_programme")


@query("invoice_numbers", """
    WITH top AS (
        SELECT l_orderkey, l_suppkey FROM (SELECT l_orderkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY amount DESC, l_suppkey) = 1)
    SELECT o_orderkey AS sales_order, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE l_suppkey END AS invoice_number
    FROM orders LEFT JOIN top ON o_orderkey = l_orderkey
""")
def invoice_numbers(t: Tables) -> DataFrame:
    invoices = t.orders.select(
        F.col("o_orderkey").alias("sales_order"), F.when(F.col("o_orderstatus") == "F", F.lit(-1)).cast("bigint").alias("invoice_number")
    )
    found = t.lineitem.select(
        F.col("l_orderkey").alias("order_number"), F.col("l_suppkey").alias("invoice_number"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")
    )
    return B.back_fill_invoice_numbers(invoices, found)
