"""Invoice lines recomputed from usage and ledgers by sets, to check what the rules wrote.

Nothing of the rules is used: each class is the set of visits that meets a whole condition of its own, not the first
case of a list. The sets part the visits, so a visit in two sets or in none has no class and fails its check. The
first visit of a subscription is an arg-min, comments come from a table by class and lateness.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.constants import MISSING_CONSUMER, SMALL_PLAN
from usagelake.operators.temporal import interval_join
from usagelake.plans.quality import BILL_KEYS, line_period_cases, reconcile, verdict
from usagelake.plans.rules import CLASSES, COMMENTS, FLAG_TYPES
from usagelake.session import small_by_nature

#: Class -> comment of a line in time, and of a late one.
LINE_COMMENTS = {
    "per_patient": ("", COMMENTS["late_new"]),
    "follow_up": ("", COMMENTS["late_follow_up"]),
    "no_association": ("", COMMENTS["late_no_association"]),
    "per_cycle": ("", COMMENTS["late_per_cycle"]),
    "fraud": (COMMENTS["fraud"], COMMENTS["late_fraud"]),
    "terms": (COMMENTS["terms"], COMMENTS["terms"]),
    "offboarding": (COMMENTS["offboarding"], COMMENTS["offboarding"]),
    "offboarding_treatment": (COMMENTS["offboarding"], COMMENTS["offboarding"]),
    "efficacy": (CLASSES["efficacy"], CLASSES["efficacy"]),
}
#: Classes whose amounts an account flag brings about.
FLAG_CLASSES = tuple(CLASSES[k] for k in ("fraud", "terms", "offboarding", "offboarding_treatment"))


def visit_facts(usage: DataFrame, subscriptions: DataFrame, invoices: DataFrame, as_of: datetime, bucket: str = "30 days") -> DataFrame:
    """What is true of each visit: anonymous, small, late, ineffective, flag, covered, known, pilot, adjusted, first.

    `usage` has one row per visit with its account flag, `subscriptions` is the ledger after the batch of `as_of`; a
    subscription is known if it is older than that. Visits that are charged by the cycle take no place in a subscription.
    """
    number = F.coalesce(F.col("consumer_id").try_cast("bigint"), F.lit(0))
    last = invoices.groupBy("promotion_uuid").agg(F.max("invoice_date").alias("_invoiced"))
    flag = F.coalesce("flag_type", F.lit(""))
    told = usage.join(small_by_nature(last), "promotion_uuid", "left").withColumns({
        "anonymous": number == 0,
        "small": F.coalesce(F.col("plan_type") == SMALL_PLAN, F.lit(False)),
        "late": F.coalesce(F.col("cycle_date") <= F.col("_invoiced"), F.lit(False)),
        "ineffective": ~F.coalesce(F.col("efficacy") == "Yes", F.lit(False)),
        "flag": flag,
    }).drop("_invoiced")
    waits = F.col("small") | flag.isin(*[FLAG_TYPES[k] for k in ("terms", "offboarding", "offboarding_treatment")])
    by_cycle = F.coalesce((flag != "") & (F.col("flag_sub_type") == "PerCycle"), F.lit(False))
    day = F.when(~F.col("anonymous") & (waits | ~by_cycle), F.col("cycle_date"))
    under = interval_join(
        told.withColumn("_day", day), subscriptions.where("version = 1"), ["consumer_id", "promotion_uuid"], at="_day",
        start="sub_start", end="sub_end", closed="both", tie=["subscription_uuid"], bucket=bucket,
        take={"subscription_uuid": "subscription_uuid", "_pilot": "pilot_flag", "_words": "comments", "_opened": "created_at"},
    ).withColumns({
        "covered": F.col("subscription_uuid").isNotNull(),
        "known": F.coalesce(F.col("_opened") < F.lit(as_of), F.lit(False)),
        "pilot": F.coalesce(F.col("_pilot") == "Y", F.lit(False)),
        "adjusted": F.coalesce(F.col("_words") == COMMENTS["adjusted"], F.lit(False)),
    }).drop("_day", "_pilot", "_words", "_opened")
    order = F.struct("cycle_date", "first_cycle_ts", "account_uuid", "visit_id")
    heads = under.groupBy("subscription_uuid", "promotion_uuid").agg(F.min(order).alias("head"))
    heads = heads.select(F.col("head.visit_id").alias("visit_id"), F.lit(True).alias("first"))
    return under.join(heads, "visit_id", "left").withColumn("first", F.coalesce("first", F.lit(False)))


def class_sets() -> dict[str, Column]:
    """Class -> the visits in it, by the facts alone. Efficacy comes after: it takes all but paid and follow-up visits."""
    anonymous, small, covered = F.col("anonymous"), F.col("small"), F.col("covered")
    paid = F.col("first") & ~F.col("pilot")
    has = {k: ~anonymous & (F.col("flag") == v) for k, v in FLAG_TYPES.items()}
    broken = {k: has[k] & ~F.col("known") for k in ("terms", "offboarding", "offboarding_treatment")}
    small_alone = small & ~covered
    per_cycle = ~anonymous & small & (~covered | has["fraud"] | broken["offboarding"] | (has["map"] & paid))
    free = ~anonymous & ~per_cycle & ~has["fraud"] & ~broken["terms"] & ~broken["offboarding"] & ~broken["offboarding_treatment"]
    return {
        "no_association": anonymous,
        "per_cycle": per_cycle,
        "fraud": has["fraud"] & ~small,
        "terms": broken["terms"] & ~small_alone,
        "offboarding": broken["offboarding"] & ~small,
        "offboarding_treatment": broken["offboarding_treatment"] & ~small_alone,
        "per_patient": free & paid,
        "follow_up": free & ~paid,
    }


def classed(facts: DataFrame) -> DataFrame:
    """`facts` with class_name and line_comment; null where the sets don't part the visits."""
    sets = F.array_compact(F.array(*[F.when(condition, F.lit(k)) for k, condition in class_sets().items()]))
    fails = F.col("ineffective") & ~F.col("_set").isin("per_patient", "follow_up")
    words = F.create_map(*[F.lit(x) for k, pair in LINE_COMMENTS.items() for x in (k, F.array(F.lit(pair[0]), F.lit(pair[1])))])
    names = F.create_map(*[F.lit(x) for pair in CLASSES.items() for x in pair])
    by_table = words[F.col("_class")][F.col("late").cast("int")]
    # A small plan under a new subscription is charged as its flag says and told like a visit without one.
    told_plain = F.col("_class").isin("terms", "offboarding_treatment") & F.col("small")
    visit_kind = F.when(F.col("first") & ~F.col("pilot"), F.lit("per_patient")).otherwise(F.lit("follow_up"))
    adjusted = F.col("late") & F.col("adjusted") & (F.coalesce(F.when(told_plain, visit_kind), F.col("_class")) == "follow_up")
    return (
        facts.withColumn("_sets", sets)
        .withColumn("_set", F.when(F.size("_sets") == 1, F.element_at("_sets", 1)))
        .withColumn("_class", F.when(fails, F.lit("efficacy")).otherwise(F.col("_set")))
        .withColumn("class_name", names[F.col("_class")])
        .withColumn("line_comment", F.when(adjusted, F.lit(COMMENTS["late_follow_up_adjusted"])).otherwise(
            F.when(told_plain, words[visit_kind][F.col("late").cast("int")]).otherwise(by_table)))
        .drop("_sets", "_set", "_class")
    )


def recomputed_lines(usage: DataFrame, subscriptions: DataFrame, invoices: DataFrame, classes: DataFrame, as_of: datetime,
                     bucket: str = "30 days") -> DataFrame:
    """Lines that usage and ledgers ask for, with class, comment, cycles and charge, and `created_at` of the batch."""
    prices = classes.select(
        "class_name", "promotion_uuid", "list_price", "calc_type", F.col("effective").alias("_from"), F.col("termination").alias("_to"))
    visits = classed(visit_facts(usage, subscriptions, invoices, as_of, bucket)).withColumn(
        "consumer_id", F.when(F.col("anonymous"), F.lit(MISSING_CONSUMER)).otherwise(F.col("consumer_id")))
    keys = ["subscription_uuid", "consumer_id", "account_uuid", "sold_to", "promotion_uuid", "cycle_date", "class_name", "line_comment"]
    lines = visits.groupBy(*keys).agg(F.sum("cycle_count").alias("cycle_count"))
    priced = lines.join(small_by_nature(prices), ["class_name", "promotion_uuid"], "left").where(
        F.col("_from").isNull() | F.col("cycle_date").between(F.col("_from"), F.col("_to")))
    times = F.when(F.col("calc_type") == "PerCycle", F.col("cycle_count")).otherwise(F.lit(1))
    return priced.withColumns({"charge": F.col("list_price") * times, "comments": F.col("line_comment"), "created_at": F.lit(as_of)}).drop(
        "line_comment", "_from", "_to", "list_price", "calc_type")


def _bills(lines: DataFrame) -> DataFrame:
    """A day's lines of a consumer at an account; the sets hold no more than there are classes and comments."""
    extra = [F.max(c).alias(c) if c in lines.columns else F.lit(None).cast(kind).alias(c) for c, kind in (
        ("updated_at", "timestamp"), ("created_by", "string"), ("invoiced", "boolean"), ("pilot_flag", "string"))]
    return lines.groupBy(*BILL_KEYS).agg(
        F.sort_array(F.collect_set(F.coalesce("class_name", F.lit("?")))).alias("classes"),
        F.sort_array(F.collect_set(F.coalesce("comments", F.lit("")))).alias("comments"),
        F.sum("cycle_count").alias("cycle_count"), F.sum("charge").cast("decimal(28,2)").alias("charge"),
        F.max("created_at").alias("created_at"), *extra,
    )


def check_lines(expected: DataFrame, details: DataFrame, classes: DataFrame, start: datetime, end: datetime,
                only: Sequence[str] = ()) -> DataFrame:
    """Recomputed and billed lines side by side: a verdict for class, comment, charge and cycles of each day.

    `only` compares lines of these classes alone, on both sides.
    """
    named = details.where("version = 1").join(small_by_nature(classes.select("class_uuid", "class_name").distinct()), "class_uuid", "left")
    if only:
        expected, named = (side.where(F.col("class_name").isin(*only)) for side in (expected, named))
    told = line_period_cases(start, end)

    def agree(column: str) -> list[tuple[Column, str]]:
        return [(F.col(f"l_{column}") == F.col(f"r_{column}"), "Matched"), *told]

    judged = reconcile(_bills(expected), _bills(named), BILL_KEYS, agree("classes"), name="class_verdict")
    return judged.withColumns({
        "comment_verdict": verdict(agree("comments")), "charge_verdict": verdict(agree("charge")), "count_verdict": verdict(agree("cycle_count")),
    })
