"""Rules as data: ordered SQL expressions per category and programme.

A rule adds (or overwrites) the column of its name. Later rules see earlier
results. All programmes are evaluated in one pass over the data: rules of the
same name become one CASE over the programme, so no per-programme plan and no
union is needed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.constants import (
    MISSING_CONSUMER,
    NOT_A_CONSUMER,
    PER_CYCLE_PRICE,
    PER_PATIENT_PRICE,
    SMALL_PLAN,
    SUBSCRIPTION_DAYS,
)


@dataclass(frozen=True)
class Rule:
    name: str
    category: str
    code: str
    order: int
    promotion_uuid: str
    effective: date = date(1900, 1, 1)
    termination: date = date(9999, 12, 31)
    active: bool = True
    note: str = ""


RULE_SCHEMA = (
    "name string, category string, code string, order int, promotion_uuid string, "
    "effective date, termination date, active boolean, note string"
)


def rules_to_frame(spark, rules: Iterable[Rule]) -> DataFrame:
    rows = [(r.name, r.category, r.code, r.order, r.promotion_uuid, r.effective, r.termination, r.active, r.note) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rules_from_frame(df: DataFrame) -> list[Rule]:
    """Read the hand-kept rule table to the driver. Its text is run as SQL, so keep it trusted."""
    return [Rule(**row.asDict()) for row in df.select(*[c.split()[0] for c in RULE_SCHEMA.split(", ")]).collect()]


def active_rules(rules: Iterable[Rule], category: str, as_of: date) -> list[Rule]:
    return sorted(
        (r for r in rules if r.active and r.category == category and r.effective <= as_of <= r.termination),
        key=lambda r: (r.order, r.name),
    )


def fold_steps(rules: Sequence[Rule]) -> list[tuple[str, dict[str, str]]]:
    """Merge the programmes' rule lists into shared steps of (name, {programme: code}).

    Each programme keeps its own order; a step serves every programme whose next
    rule has that name.
    """
    queues: dict[str, list[Rule]] = {}
    for rule in rules:
        queues.setdefault(rule.promotion_uuid, []).append(rule)
    steps = []
    while any(queues.values()):
        heads: dict[str, list[str]] = {}
        for promotion, queue in queues.items():
            if queue:
                heads.setdefault(queue[0].name, []).append(promotion)
        waiting = {name: sum(any(r.name == name for r in q[1:]) for q in queues.values()) for name in heads}
        # Prefer a name nobody still has further down, then the most shared one.
        name = min(heads, key=lambda n: (waiting[n], -len(heads[n]), n))
        steps.append((name, {p: queues[p].pop(0).code for p in heads[name]}))
    return steps


def apply_rules(
    df: DataFrame,
    rules: Iterable[Rule],
    category: str,
    *,
    promotions: Sequence[str],
    as_of: date,
) -> DataFrame:
    """Evaluate a category; rows of programmes not in `promotions` (the active ones) are dropped."""
    chosen = [r for r in active_rules(rules, category, as_of) if r.promotion_uuid in set(promotions)]
    out = df.where(F.col("promotion_uuid").isin(*promotions)) if promotions else df.where(F.lit(False))
    for name, codes in fold_steps(chosen):
        rest = f"`{name}`" if name in out.columns else "NULL"
        # Rules with the same text share one branch.
        by_code: dict[str, list[str]] = {}
        for promotion, code in codes.items():
            by_code.setdefault(code, []).append(promotion)
        if len(by_code) == 1 and set(codes) == set(promotions):
            text = next(iter(by_code))
        else:
            branches = " ".join(
                f"WHEN promotion_uuid IN ({', '.join(_quote(p) for p in members)}) THEN ({code})"
                for code, members in by_code.items()
            )
            text = f"CASE {branches} ELSE {rest} END"
        out = out.withColumn(name, F.expr(text))
    return out


def rule_audit(df: DataFrame, category: str, who: str, at: datetime) -> DataFrame:
    """Audit copy of a rule result: every column as upper-case text."""
    seen: dict[str, int] = {}
    columns = []
    for name in df.columns:
        upper = name.upper()
        repeat = seen.get(upper, 0)
        seen[upper] = repeat + 1
        columns.append(F.upper(F.col(name).cast("string")).alias(upper if not repeat else f"{upper}_{repeat}"))
    return df.select(
        *columns, F.lit(category).alias("RULECATEGORY"), F.lit(who).alias("CREATEDBY"), F.lit(at).alias("CREATEDDATE")
    )


# ---- seed ------------------------------------------------------------------

EXCEPTION, CYCLE, SUBSCRIBE = "InvoiceException", "CycleFlag", "SubscriptionLive"
CLASSIFY, AMOUNT = "DetailLive", "DetailLiveAmount"
ADJUST, REALIGN, TRUE_UP = "AdjustSubscription", "RealignSubscription", "DetailTrueUp"

# Classes, account flag types and line comments written by the rules.
CLASSES = {
    "per_patient": "PerPatientFee",
    "follow_up": "FollowUpVisit",
    "no_association": "NoPatientAssociationFee",
    "per_cycle": "PerCycleFee",
    "fraud": "FraudViolation",
    "terms": "NonProgrammeFee",
    "offboarding": "NonProgrammeFeeOffboarding",
    "offboarding_treatment": "NonProgrammeFeeOffboardingTreatment",
    "efficacy": "PerCycleEfficacyFail",
}
FLAG_TYPES = {
    "fraud": "Fraud",
    "map": "Map",
    "terms": "TNC",
    "offboarding": "Offboarding",
    "offboarding_treatment": "OffboardingTreatment",
}
COMMENTS = {
    "adjusted": "LateCycle_SubscriptionAdjust",
    "realigned": "LateCycle_RealignNewSubscription",
    "late_new": "LateCycle_NewSubscription",
    "late_follow_up": "LateCycle_FollowUp",
    "late_follow_up_adjusted": "LateCycle_FollowUp_Adjust",
    "late_no_association": "LateCycle_NoPatientAssociation",
    "late_per_cycle": "LateCycle_PerCycleFee",
    "late_fraud": "LateCycle_Flag_FraudViolation",
    "fraud": "Flag_FraudViolation",
    "terms": "Flag_NonProgrammeFee",
    "offboarding": "OffboardingFlag_NonProgrammeFee",
    "other_follow_up": "DifferentShipToID_FollowUp",
    "other_late_follow_up": "DifferentShipToID_LateCycle_FollowUp",
    "return": "ReturnSubscription",
    "update_new": "UpdateCycle_NewSubscription",
    "update_no_association": "UpdateCycle_NoPatientAssociation",
}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _choose(*cases: tuple[str, str], otherwise: str | None = "''") -> str:
    branches = " ".join(f"WHEN {condition} THEN {value}" for condition, value in cases)
    return f"CASE {branches}{f' ELSE {otherwise}' if otherwise is not None else ''} END"


def _end_rule(days: int) -> str:
    return f"CASE WHEN coalesce(exception_flag, 'N') = 'N' THEN date_add(cycle_date, {days}) ELSE sub_end END"


def _exception_outcomes(kind: str, patient: int, cycle: int) -> list[tuple[str, str]]:
    """(condition, text) by credited amount and whether the line was invoiced; `kind` is comment or class."""
    comment = {"patient": "Exception_PerPatient", "cycle": "Exception_PerCycleFee", "none": "Exception_NoPatient"}
    named = {"patient": "PerPatientFeeException", "cycle": "PerCycleFeeException", "none": "NoPatientAssociationFeeException"}
    words = comment if kind == "comment" else named
    out = []
    for who, amount in (
        ("patient", f"credit_amount = {patient}"),
        ("cycle", f"credit_amount = cycle_count * {cycle}"),
        ("none", f"credit_amount <> {patient}"),
    ):
        for invoiced, when in ((0, "PreInvoice"), (1, "PostInvoice")):
            out.append((f"is_invoiced = {invoiced} AND {amount}", _quote(words[who] + when)))
        if who == "patient" and kind == "comment":
            out.append(("credit_amount = 0", _quote(comment["patient"] + "PostInvoice")))
    return out


def seed_rules(
    promotion_uuid: str,
    *,
    full: bool = True,
    days: int = SUBSCRIPTION_DAYS,
    per_patient_price: int = PER_PATIENT_PRICE,
    per_cycle_price: int = PER_CYCLE_PRICE,
    classes: dict[str, str] = CLASSES,
    flag_types: dict[str, str] = FLAG_TYPES,
) -> list[Rule]:
    """The standard rule set of one programme: 48 rules when `full`, else 32.

    The full set knows account flags, violations and efficacy; the short one adds
    the "other ship-to" comments.
    """
    c = {k: _quote(v) for k, v in classes.items()}
    t = {k: _quote(v) for k, v in flag_types.items()}
    m = {k: _quote(v) for k, v in COMMENTS.items()}
    no_ids = ", ".join(_quote(v) for v in NOT_A_CONSUMER)
    rows: list[tuple[str, int, str, str]] = []

    def add(category: str, order: int, name: str, code: str) -> None:
        rows.append((category, order, name, code))

    # Exceptions granted by customer care.
    shift = 1 if full else 0
    dated = [("is_date_change = 1", "'Exception_SubscriptionDateChange'")] if full else []
    dated_end = [("is_date_change = 1", "exception_end")] if full else []
    dated_class = [(f"is_date_change = 1 AND credit_amount = {per_patient_price}", c["per_patient"])] if full else []
    if full:
        add(EXCEPTION, 1, "is_date_change", _flag("upper(exception_sub_type) = 'SUBSCRIPTION DATE CHANGE'"))
    add(EXCEPTION, 1 + shift, "comments", _choose(*dated, *_exception_outcomes("comment", per_patient_price, per_cycle_price), otherwise=None))
    add(EXCEPTION, 2 + shift, "new_end", _choose(*dated_end, ("sub_end > exception_created", "exception_created"), otherwise="sub_end"))
    add(EXCEPTION, 3 + shift, "class_name", _choose(*dated_class, *_exception_outcomes("class", per_patient_price, per_cycle_price), otherwise=None))

    # Flags of one visit.
    add(CYCLE, 1, "consumer_id", f"CASE WHEN coalesce(try_cast(consumer_id AS BIGINT), 0) = 0 THEN '{MISSING_CONSUMER}' ELSE consumer_id END")
    add(CYCLE, 2, "is_new", _flag("subscription_uuid IS NULL"))
    add(CYCLE, 3, "is_adjust", _choose(("pilot_flag = 'Y'", "0"), ("cycle_date > previous_end AND cycle_date < sub_start", "1"), otherwise="0"))
    add(CYCLE, 4, "is_anonymous", _flag(f"consumer_id IS NULL OR consumer_id IN ({no_ids})"))
    add(CYCLE, 5, "is_late", _flag("cycle_date <= last_invoice_date"))
    if full:
        add(CYCLE, 6, "is_fraud", _flag(f"flag_type = {t['fraud']}"))
        add(CYCLE, 7, "is_map", _flag(f"flag_type = {t['map']}"))
        for i, kind in enumerate(("terms", "offboarding", "offboarding_treatment")):
            add(CYCLE, 8 + i, f"is_{kind}", _flag(f"flag_type = {t[kind]}"))
            add(CYCLE, 11 + i, f"{kind}_per_cycle", _flag(f"flag_type = {t[kind]} AND subscription_uuid IS NULL"))
    add(CYCLE, 14, "is_small_plan", _flag(f"plan_type = '{SMALL_PLAN}'"))
    add(CYCLE, 15, "is_per_cycle", _flag("is_anonymous = 1 OR is_small_plan = 1 OR (flag_type IS NOT NULL AND flag_sub_type = 'PerCycle')"))
    waits = ["is_small_plan"] + (["is_terms", "is_offboarding", "is_offboarding_treatment"] if full else [])
    add(CYCLE, 16, "waits_for_subscription", _flag(" OR ".join(f"{w} = 1" for w in waits)))
    add(CYCLE, 17, "is_effective", _flag("efficacy = 'Yes'") if full else "1")

    # A subscription opened by a visit.
    add(SUBSCRIBE, 1, "new_start", "cycle_date")
    add(SUBSCRIBE, 2, "new_end", _end_rule(days))

    # Class and comment of one invoice line.
    add(CLASSIFY, 1, "is_per_patient", _choose(("pilot_flag = 'Y'", "0"), ("visit_no = 1 AND billed_amount = 0", "1"), otherwise="0"))
    add(CLASSIFY, 2, "is_follow_up", _flag("pilot_flag = 'Y' OR billed_amount > 0 OR (billed_amount = 0 AND visit_no > 1)"))
    late = _flag("cycle_date <= last_invoice_date")
    if full:
        add(CLASSIFY, 3, "map_violation", _flag("is_map = 1 AND is_per_patient = 1 AND is_anonymous = 0"))
        for i, kind in enumerate(("terms", "offboarding", "offboarding_treatment")):
            add(CLASSIFY, 4 + i, f"{kind}_violation", _flag(f"{kind}_per_cycle = 1 AND is_anonymous = 0"))
        add(CLASSIFY, 9, "is_late", late)
        # A small plan is charged per cycle unless a subscription without violations covers it.
        charged = "is_small_plan = 1 AND (subscription_uuid IS NULL OR is_fraud = 1 OR offboarding_violation = 1 OR map_violation = 1)"
        add(CLASSIFY, 49, "class_before_efficacy", _choose(
            ("is_anonymous = 1", c["no_association"]),
            (charged, c["per_cycle"]),
            ("is_fraud = 1", c["fraud"]),
            ("terms_violation = 1", c["terms"]),
            ("offboarding_violation = 1", c["offboarding"]),
            ("offboarding_treatment_violation = 1", c["offboarding_treatment"]),
            ("is_per_patient = 1", c["per_patient"]),
            ("is_follow_up = 1", c["follow_up"]),
        ))
        add(CLASSIFY, 50, "class_name", (
            f"CASE WHEN is_effective = 0 AND class_before_efficacy NOT IN ({c['follow_up']}, {c['per_patient']}) "
            f"THEN {c['efficacy']} ELSE class_before_efficacy END"
        ))
        add(CLASSIFY, 100, "comments", _choose(
            (f"class_name = {c['efficacy']}", c["efficacy"]),
            (f"is_late = 1 AND is_anonymous = 0 AND {charged}", m["late_per_cycle"]),
            ("is_late = 1 AND is_fraud = 1 AND is_anonymous = 0 AND is_small_plan = 0", m["late_fraud"]),
            ("is_fraud = 1 AND is_anonymous = 0 AND is_small_plan = 0", m["fraud"]),
            ("terms_violation = 1 AND is_small_plan = 0", m["terms"]),
            ("(offboarding_violation = 1 OR offboarding_treatment_violation = 1) AND is_small_plan = 0", m["offboarding"]),
            ("is_late = 0", "''"),
            ("is_anonymous = 1", m["late_no_association"]),
            ("is_per_patient = 1", m["late_new"]),
            (f"is_follow_up = 1 AND sub_comments = {m['adjusted']}", m["late_follow_up_adjusted"]),
            ("is_follow_up = 1", m["late_follow_up"]),
        ))
    else:
        charged = "is_small_plan = 1 AND is_follow_up = 0 AND is_anonymous = 0"
        add(CLASSIFY, 3, "class_name", _choose(
            ("is_anonymous = 1", c["no_association"]),
            (charged, c["per_cycle"]),
            ("is_per_patient = 1", c["per_patient"]),
            ("is_follow_up = 1", c["follow_up"]),
        ))
        add(CLASSIFY, 4, "is_late", late)
        elsewhere = "sub_account_uuid <> account_uuid AND is_follow_up = 1"
        add(CLASSIFY, 5, "comments", _choose(
            (f"is_late = 1 AND {charged}", m["late_per_cycle"]),
            (f"{elsewhere} AND is_late = 1", m["other_late_follow_up"]),
            (f"{elsewhere} AND is_late = 0", m["other_follow_up"]),
            ("is_late = 0", "''"),
            ("is_anonymous = 1", m["late_no_association"]),
            ("is_per_patient = 1", m["late_new"]),
            (f"is_follow_up = 1 AND cycle_date = sub_start AND sub_comments = {m['adjusted']}", m["late_follow_up_adjusted"]),
            ("is_follow_up = 1", m["late_follow_up"]),
        ))
    add(AMOUNT, 1, "charge", "CASE WHEN calc_type = 'PerCycle' THEN cycle_count * list_price ELSE list_price END")

    # Late visits.
    add(ADJUST, 1, "comments", _choose(("is_adjust = 1", m["adjusted"])))
    add(ADJUST, 2, "new_start", "cycle_date")
    add(ADJUST, 3, "new_end", _end_rule(days))
    add(REALIGN, 1, "needs_subscription", _flag("version > 1 AND covering_uuid IS NULL"))
    add(REALIGN, 2, "new_start", "cycle_date")
    add(REALIGN, 3, "new_end", _end_rule(days))
    add(REALIGN, 4, "comments", m["realigned"])
    add(TRUE_UP, 1, "is_per_patient", _flag("charge > 0 OR (visit_no = 1 AND subscription_amount = 0)"))
    add(TRUE_UP, 2, "is_follow_up", _flag("subscription_amount > 0 OR (billed_amount = 0 AND visit_no > 1)"))
    if full:
        add(TRUE_UP, 3, "is_map", _flag(f"flag_type = {t['map']}"))
        add(TRUE_UP, 4, "map_violation", _flag("is_map = 1 AND is_per_patient = 1"))
    at = 5 if full else 3
    add(TRUE_UP, at, "class_name", _choose(("is_per_patient = 1", c["per_patient"]), ("is_follow_up = 1", c["follow_up"])))
    add(TRUE_UP, at + 1, "is_late", late)
    add(TRUE_UP, at + 2, "comments", _choose(
        ("is_late = 0", "''"),
        ("covering_comments IS NOT NULL", "covering_comments"),
        ("is_per_patient = 1", m["late_new"]),
        ("is_follow_up = 1", m["late_follow_up"]),
    ))
    return [Rule(name, category, code, order, promotion_uuid) for category, order, name, code in rows]


def upsert_rules(target: DataFrame, source: DataFrame) -> DataFrame:
    """Change-only upsert of the rule table, keyed by name, category and programme."""
    from usagelake.operators.upsert import update_if_changed

    return update_if_changed(
        target, source, ["name", "category", "promotion_uuid"],
        tracked=["code", "note", "order", "active"], also=["effective", "termination"],
    )
