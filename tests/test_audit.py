from __future__ import annotations

from datetime import date, datetime
from itertools import product

from pyspark.sql import functions as F

from usagelake.constants import FULL_PLAN, SMALL_PLAN
from usagelake.plans import audit as A
from usagelake.plans import rules as R
from tests.conftest import rows_of

DAY, NOW = date(2024, 3, 5), datetime(2024, 4, 1)
PERIOD = datetime(2024, 1, 1), datetime(2024, 6, 1)


def test_sets_part_all_visits_and_agree_with_the_rules(spark):
    """Each mix of facts is in one set, and the fold of the rules, which shares no code with the sets, says the same."""
    yes = (False, True)
    flags = ["", *R.FLAG_TYPES.values()]
    rows = [
        (str(i), *mix) for i, mix in enumerate(product(yes, yes, yes, yes, yes, yes, yes, yes, yes, flags))
        if not (mix[5] and not mix[4]) and not (mix[6] and not mix[4]) and not (mix[8] and not mix[4])  # all three tell of a subscription
    ]
    facts = spark.createDataFrame(rows, "visit_id string, anonymous boolean, small boolean, late boolean, ineffective boolean, "
                                  "covered boolean, known boolean, pilot boolean, first boolean, adjusted boolean, flag string")
    ours = A.classed(facts)
    parts = facts.withColumn("n", sum((c.cast("int") for c in A.class_sets().values()), F.lit(0)))
    assert parts.where("n <> 1").count() == 0 and len(rows) > 1000

    # The same facts as the rules read them, with flags of a visit as they stood before the batch.
    kind = {k: F.col("flag") == v for k, v in R.FLAG_TYPES.items()}
    read = facts.withColumns({
        "promotion_uuid": F.lit("P"), "consumer_id": F.when(F.col("anonymous"), "MISSING").otherwise("7"),
        "cycle_date": F.lit(DAY), "last_invoice_date": F.when(F.col("late"), F.lit(DAY)),
        "is_anonymous": F.col("anonymous").cast("int"), "is_small_plan": F.col("small").cast("int"),
        "is_fraud": kind["fraud"].cast("int"), "is_map": kind["map"].cast("int"),
        **{f"{k}_per_cycle": (kind[k] & ~F.col("known")).cast("int") for k in ("terms", "offboarding", "offboarding_treatment")},
        "is_effective": (~F.col("ineffective")).cast("int"), "subscription_uuid": F.when(F.col("covered"), "S"),
        "pilot_flag": F.when(F.col("pilot"), "Y"), "visit_no": F.when(F.col("first"), 1).otherwise(2), "billed_amount": F.lit(0),
        "sub_comments": F.when(F.col("adjusted"), R.COMMENTS["adjusted"]), "sub_account_uuid": F.lit("A"), "account_uuid": F.lit("A"),
        "sub_start": F.lit(DAY),
    })
    theirs = R.apply_rules(read, R.seed_rules("P"), R.CLASSIFY, promotions=["P"], as_of=DAY)
    both = ours.select("visit_id", "class_name", "line_comment").join(
        theirs.select("visit_id", F.col("class_name").alias("rule_class"), "comments"), "visit_id")
    wrong = both.where("NOT (class_name <=> rule_class AND line_comment <=> nullif(comments, '~'))")
    assert wrong.limit(3).collect() == []


def _usage(frame, *rows):
    return frame("consumer_id string, sold_to string, account_uuid string, promotion_uuid string, cycle_date date, plan_type string, "
                 "efficacy string, flag_type string, flag_sub_type string, cycle_count int, first_cycle_ts timestamp, visit_id string", *rows)


def test_lines_of_hand_made_visits_and_planted_errors(frame):
    early = datetime(2024, 3, 1)
    usage = _usage(
        frame,
        ("7", "s", "A", "P", DAY, FULL_PLAN, "Yes", None, None, 2, datetime(2024, 3, 5, 9), "v1"),
        ("7", "s", "A", "P", date(2024, 3, 9), FULL_PLAN, "Yes", None, None, 1, datetime(2024, 3, 9), "v2"),
        ("x7", "s", "A", "P", DAY, FULL_PLAN, None, None, None, 3, datetime(2024, 3, 5), "v3"),
        (None, "s", "A", "P", DAY, None, "Yes", None, None, 1, None, "v4"),
        ("8", "s", "B", "P", DAY, SMALL_PLAN, "Yes", None, None, 4, datetime(2024, 3, 5), "v5"),
        ("9", "s", "B", "P", DAY, FULL_PLAN, "Yes", "Fraud", "PerCycle", 2, datetime(2024, 3, 5), "v6"),
    )
    subs = frame("subscription_uuid string, consumer_id string, promotion_uuid string, sub_start date, sub_end date, version int, "
                 "pilot_flag string, comments string, created_at timestamp", ("S", "7", "P", DAY, date(2024, 8, 2), 1, None, None, early))
    invoices = frame("promotion_uuid string, invoice_date date", ("P", date(2024, 3, 6)))
    price = {"PerPatientFee": (950, "PerSubscription"), "FollowUpVisit": (0, "PerSubscription")}
    classes = frame("class_uuid string, class_name string, promotion_uuid string, list_price int, calc_type string, effective date, termination date",
                    *[(f"c:{n}", n, "P", *price.get(n, (200, "PerCycle")), date(2020, 1, 1), date(9999, 1, 1)) for n in R.CLASSES.values()])
    lines = A.recomputed_lines(usage, subs, invoices, classes, NOW)
    assert rows_of(lines, "consumer_id", "cycle_date", "class_name", "comments", "cycle_count", "charge") == sorted([
        ("7", DAY, "PerPatientFee", "LateCycle_NewSubscription", 2, 950), ("7", date(2024, 3, 9), "FollowUpVisit", "", 1, 0),
        ("8", DAY, "PerCycleFee", "LateCycle_PerCycleFee", 4, 800), ("9", DAY, "FraudViolation", "LateCycle_Flag_FraudViolation", 2, 400),
        ("MISSING", DAY, "NoPatientAssociationFee", "LateCycle_NoPatientAssociation", 1, 200),
        ("MISSING", DAY, "PerCycleEfficacyFail", "PerCycleEfficacyFail", 3, 600),
    ])
    stored = lines.withColumns({"class_uuid": F.concat(F.lit("c:"), "class_name"), "version": F.lit(1), "updated_at": F.lit(NOW),
                                "created_by": F.lit("x")}).drop("class_name")
    good = A.check_lines(lines, stored, classes, *PERIOD)
    verdicts = ("class_verdict", "comment_verdict", "charge_verdict", "count_verdict")
    assert set(rows_of(good, *verdicts)) == {("Matched",) * 4} and good.count() == 5
    spoilt = stored.where("consumer_id <> '8'").withColumn("charge", F.when(F.col("consumer_id") == "9", 1).otherwise(F.col("charge")))
    judged = rows_of(A.check_lines(lines, spoilt, classes, *PERIOD).where("class_verdict = 'Unknown' OR charge_verdict = 'Unknown'"), "consumer_id", *verdicts)
    assert judged == [("8", *["Unknown"] * 4), ("9", "Matched", "Matched", "Unknown", "Matched")]
    only = A.check_lines(lines, spoilt, classes, *PERIOD, only=A.FLAG_CLASSES)
    assert rows_of(only, "consumer_id", "charge_verdict") == [("9", "Unknown")]
    assert A.recomputed_lines(usage.limit(0), subs, invoices, classes, NOW).isEmpty()
    assert rows_of(A.recomputed_lines(usage, subs.limit(0), invoices.limit(0), classes, NOW).where("consumer_id = '8'"), "charge") == [(800,)]
