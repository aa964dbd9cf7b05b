"""Usage-based billing: eligible cycles to visits, subscriptions and invoice lines.

Every step takes frames and returns a frame; `run_batch` chains them in the
order the business needs (adjust, realign, true-up, open, classify, comment).

Frames (see FIXTURES.md for the full column lists):
  subscription: subscription_uuid, previous_uuid, consumer_id, account_uuid, sold_to,
                promotion_uuid, sub_start, sub_end, exception_flag, pilot_flag,
                version (1 = current), comments, created_by, created_at, updated_by, updated_at
  detail:       detail_uuid, subscription_uuid, consumer_id, account_uuid, sold_to, promotion_uuid,
                cycle_date, cycle_count, charge, class_uuid, version, comments, audit columns
Id lists of a visit are kept in long form (`visit_members`), never as one cell.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.constants import LOOKBACK_DAYS, RULE_CONSUMER, RULE_CONSUMER_ACCOUNT, SUBSCRIPTION_DAYS
from usagelake.functions.columns import minutes_between
from usagelake.operators.dedup import latest_by, row_key
from usagelake.operators.groups import number_in_group, with_group_totals
from usagelake.operators.temporal import interval_join, other_owner_join, previous_end
from usagelake.operators.upsert import insert_uncovered, set_status, upsert, version_bump
from usagelake.plans import rules as R
from usagelake.session import settle, small, small_by_nature

BUCKET = "30 days"

SUBSCRIPTION_SCHEMA = (
    "subscription_uuid string, previous_uuid string, consumer_id string, account_uuid string, sold_to string, "
    "promotion_uuid string, sub_start date, sub_end date, exception_flag string, pilot_flag string, version int, "
    "comments string, created_by string, created_at timestamp, updated_by string, updated_at timestamp"
)
DETAIL_SCHEMA = (
    "detail_uuid string, subscription_uuid string, consumer_id string, account_uuid string, sold_to string, "
    "promotion_uuid string, cycle_date date, cycle_count bigint, charge decimal(18,2), class_uuid string, version int, "
    "comments string, created_by string, created_at timestamp, updated_by string, updated_at timestamp"
)
VISIT_KEYS = (
    "consumer_id", "sold_to", "ship_to", "account_uuid", "promotion_uuid", "cycle_date", "rule_type", "plan_type", "efficacy",
)
OVERRIDES = (
    "device_type_override", "per_patient_override", "account_start_override", "account_end_override",
    "card_override", "card_start_override", "card_end_override",
)


@dataclass(frozen=True)
class Reference:
    """Reference tables a batch reads."""

    promotions: DataFrame
    accounts: DataFrame
    cards: DataFrame
    applicators: DataFrame
    classes: DataFrame
    account_flags: DataFrame
    flag_types: DataFrame
    invoices: DataFrame
    periods: DataFrame
    rules: Sequence[R.Rule]
    active_promotions: Sequence[str]


@dataclass(frozen=True)
class Clock:
    """The moment a batch runs at; plans never read the wall clock."""

    now: datetime
    user: str = "billing"

    @property
    def today(self) -> date:
        return self.now.date()


@dataclass(frozen=True)
class State:
    subscriptions: DataFrame
    details: DataFrame
    audit: dict[str, DataFrame] = field(default_factory=dict)


# ---- eligibility and visits ------------------------------------------------


def _with_efficacy(df: DataFrame, applicators: DataFrame) -> DataFrame:
    joined = df.join(small_by_nature(applicators.select("applicator_cfg", "full_efficacy")), "applicator_cfg", "left")
    enough = minutes_between(F.col("begin_ts"), F.col("end_ts")) >= F.col("full_efficacy")
    return joined.withColumn("efficacy", F.when(enough, "Yes").otherwise("No"))


def _dated(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({"effective": f"{prefix}_from", "termination": f"{prefix}_to"})


def _on_programmes(cycles: DataFrame, ref: Reference, how: str) -> DataFrame:
    """Cycles with the programme, account and card rows they may belong to."""
    promotions = _dated(ref.promotions.select("promotion_uuid", "device_type", "rule_type", "effective", "termination"), "promo")
    accounts = _dated(ref.accounts.where("per_patient").select("account_uuid", "ship_to", "promotion_uuid", "effective", "termination"), "account")
    cards = _dated(ref.cards.select("card", "promotion_uuid", "effective", "termination"), "card").withColumn("card_known", F.lit(True))
    if how == "inner":
        return (
            cycles.join(small_by_nature(promotions), "device_type")
            .join(small(accounts), ["ship_to", "promotion_uuid"])
            .join(small(cards), ["card", "promotion_uuid"])
        )
    return (
        cycles.join(small(accounts), "ship_to", "left")
        .join(small_by_nature(promotions), ["device_type", "promotion_uuid"], "left")
        .join(small(cards), ["card", "promotion_uuid"], "left")
    )


def _in_force() -> Column:
    day = F.col("cycle_date")
    return day.between(F.col("promo_from"), F.col("promo_to")) & day.between(
        F.col("account_from"), F.col("account_to")
    ) & day.between(F.col("card_from"), F.col("card_to"))


def eligible_cycles(cycles: DataFrame, ref: Reference) -> DataFrame:
    """Cycles whose programme, account and card were all in force on the day."""
    return _with_efficacy(_on_programmes(cycles, ref, "inner").where(_in_force()), ref.applicators)


def _override_clauses() -> Column:
    day = F.col("cycle_date")

    def allowed(rule: Column, *flags: str) -> Column:
        clause = F.coalesce(rule, F.lit(False))
        for flag in flags:
            clause = clause | F.coalesce(F.col(flag), F.lit(False))
        return clause

    return (
        F.coalesce(day.between(F.col("promo_from"), F.col("promo_to")), F.lit(False))
        & allowed(F.col("device_type") == F.col("promo_device_type"), "device_type_override")
        & allowed(F.col("per_patient"), "per_patient_override")
        & allowed(day >= F.col("account_from"), "account_start_override")
        & allowed(day <= F.col("account_to"), "account_end_override")
        & allowed(F.col("card_known"), "card_override")
        & allowed(day >= F.col("card_from"), "card_start_override", "card_override")
        & allowed(day <= F.col("card_to"), "card_end_override", "card_override")
    )


def _with_overrides(cycles: DataFrame, overrides: DataFrame, ref: Reference) -> DataFrame:
    asked = overrides.select("cycle_id", "promotion_uuid", *OVERRIDES).dropDuplicates(["cycle_id", "promotion_uuid"])
    promotions = _dated(
        ref.promotions.select("promotion_uuid", F.col("device_type").alias("promo_device_type"), "rule_type", "effective", "termination"), "promo"
    )
    accounts = _dated(ref.accounts.select("account_uuid", "ship_to", "promotion_uuid", "per_patient", "effective", "termination"), "account")
    cards = _dated(ref.cards.select("card", "promotion_uuid", "effective", "termination"), "card").withColumn("card_known", F.lit(True))
    return (
        cycles.join(small(asked), "cycle_id")
        .join(small_by_nature(promotions), "promotion_uuid")
        .join(small(accounts), ["ship_to", "promotion_uuid"])
        .join(small(cards), ["card", "promotion_uuid"], "left")
    )


def eligible_overrides(cycles: DataFrame, overrides: DataFrame, ref: Reference) -> DataFrame:
    """Cycles let in by hand: each condition may be waived by its override flag."""
    return _with_efficacy(_with_overrides(cycles, overrides, ref).where(_override_clauses()), ref.applicators)


def eligibility_log(cycles: DataFrame, ref: Reference, overrides: DataFrame | None = None) -> DataFrame:
    """One verdict per candidate row of each cycle."""
    if overrides is not None:
        judged = _with_overrides(cycles, overrides, ref).withColumn("eligible", _override_clauses())
    else:
        judged = _on_programmes(cycles, ref, "left").withColumn("eligible", F.coalesce(_in_force(), F.lit(False)))
    return judged.select("cycle_id", "cycle_date", F.date_format("cycle_date", "yyyy-MM").alias("cycle_month"), "eligible")


def best_eligibility(log: DataFrame) -> DataFrame:
    """One row per cycle: eligible if any candidate was."""
    return log.groupBy("cycle_id", "cycle_date", "cycle_month").agg(F.max("eligible").alias("eligible"))


def aggregate_visits(eligible: DataFrame) -> DataFrame:
    """Cycles of a consumer at an account on a day, per plan and efficacy."""
    return (
        eligible.groupBy(*VISIT_KEYS)
        .agg(
            F.count(F.lit(1)).alias("cycle_count"),
            F.min("begin_ts").alias("first_cycle_ts"),
            F.count_distinct("card").alias("n_cards"),
        )
        .withColumn("visit_id", row_key(*VISIT_KEYS))
    )


def visit_members(eligible: DataFrame) -> DataFrame:
    """Cards, applicators and cycles of each visit as (visit_id, kind, value) rows."""
    long = eligible.select(
        row_key(*VISIT_KEYS).alias("visit_id"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("value"))
                    for kind, column in (("card", "card"), ("applicator", "applicator_serial"), ("cycle", "cycle_id"))
                ]
            )
        ).alias("m"),
    ).select("visit_id", "m.*")
    return long.where("value IS NOT NULL").distinct()


def flags_as_of(visits: DataFrame, ref: Reference, sub_type: str | None = None) -> DataFrame:
    """The account flag in force on the day, lowest rank first."""
    types = ref.flag_types.where("flag_sub_type <> 'FraudReport'")
    if sub_type:
        types = types.where(F.col("flag_sub_type") == sub_type)
    named = ref.account_flags.join(small(types.select("flag_type_uuid", "flag_type", "flag_sub_type", "flag_rank")), "flag_type_uuid")
    days = visits.select("account_uuid", "promotion_uuid", "cycle_date").distinct()
    # A lane per flag type, best first: types are kept by hand, as rules are. In a lane the interval that ends last tells
    # whether any is open, so a day meets one candidate per type and no flag row.
    kinds = types.select("flag_rank", "flag_type_uuid", "flag_type", "flag_sub_type").distinct().collect()
    lanes = [
        F.col("flag_type_uuid").eqNullSafe(k.flag_type_uuid) & F.col("flag_rank").eqNullSafe(k.flag_rank)
        & F.col("flag_type").eqNullSafe(k.flag_type) & F.col("flag_sub_type").eqNullSafe(k.flag_sub_type)
        for k in sorted(kinds, key=lambda k: [(v is not None, v) for v in k])
    ]
    flagged = interval_join(
        days, named, ["account_uuid", "promotion_uuid"], at="cycle_date", start="flag_start", end="flag_end", closed="both",
        prefer=lanes, take={"_hit": F.lit(True), "flag_type": "flag_type", "flag_sub_type": "flag_sub_type"}, bucket=BUCKET,
    )
    return flagged.where("_hit").drop("_hit")


def with_flags(visits: DataFrame, ref: Reference, sub_type: str | None = None) -> DataFrame:
    return visits.join(flags_as_of(visits, ref, sub_type), ["account_uuid", "promotion_uuid", "cycle_date"], "left")


def last_invoice_dates(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("promotion_uuid").agg(F.max("invoice_date").alias("last_invoice_date"))


# ---- matching visits to subscriptions --------------------------------------

_SUB = {
    "subscription_uuid": "subscription_uuid", "sub_start": "sub_start", "sub_end": "sub_end", "version": "version",
    "sub_comments": "comments", "pilot_flag": "pilot_flag", "previous_end": "previous_end", "exception_flag": "exception_flag",
}


def _current(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.where("version = 1")


def _only_of(table: DataFrame, batch: DataFrame, keys: Sequence[str] = ("consumer_id",)) -> DataFrame:
    """The rows of a ledger a batch can touch: work grows with the batch, not the ledger."""
    wanted = batch.select(*keys).where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).distinct()
    return table.join(small(wanted), list(keys), "left_semi")


def _best_of(df: DataFrame, names: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Collapse candidate structs ``c0, c1`` of a row into the columns of the better one."""
    first, second = F.col("c0"), F.col("c1")
    take_first = second["subscription_uuid"].isNull() | (
        first["subscription_uuid"].isNotNull() & (order[0] >= order[1])
    )
    kept = [c for c in df.columns if c not in ("c0", "c1")]
    return df.withColumn("_c", F.when(take_first, first).otherwise(second)).select(
        *kept, *[F.col("_c")[n].alias(n) for n in names]
    )


def _packed(df: DataFrame, take: Sequence[str], name: str) -> DataFrame:
    kept = [c for c in df.columns if c not in take]
    return df.select(*kept, F.struct(*[F.col(c) for c in take]).alias(name))


Cut = Callable[[DataFrame], DataFrame]


def match_subscriptions(visits: DataFrame, subscriptions: DataFrame, rule_type: str, as_of: date, cut: Cut = settle) -> DataFrame:
    """Each visit with the subscription it falls in, or in the gap before one.

    Consumer rule: any account. Consumer-account rule: the same account, or another
    account of the same sold-to.
    """
    recent = _current(subscriptions).where(F.col("sub_end") >= F.lit(as_of - timedelta(days=LOOKBACK_DAYS)))
    recent = _only_of(recent, visits)
    recent = recent.withColumn("pilot_flag", F.coalesce("pilot_flag", F.lit("N")))
    lag_keys = ["consumer_id"] if rule_type == RULE_CONSUMER else ["account_uuid", "consumer_id"]
    ranged = cut(
        previous_end(
            recent, lag_keys, start="sub_start", end="sub_end", gap_days=SUBSCRIPTION_DAYS, tie=["sub_start", "subscription_uuid"]
        )
    )
    not_pilot = F.when(F.col("pilot_flag") == "Y", 0).otherwise(1)
    common = {"at": "cycle_date", "start": "previous_end", "end": "sub_end", "closed": "both", "bucket": BUCKET, "take": _SUB}
    if rule_type == RULE_CONSUMER:
        matched = interval_join(visits, ranged, ["consumer_id", "promotion_uuid"], tie=[not_pilot, "subscription_uuid"], **common)
    elif rule_type == RULE_CONSUMER_ACCOUNT:
        lanes = [F.col("pilot_flag") != "Y", F.col("pilot_flag") == "Y"]
        names = list(_SUB)
        same = interval_join(
            visits, ranged, ["consumer_id", "promotion_uuid", "account_uuid"], tie=["subscription_uuid"], prefer=lanes, **common
        )
        both = interval_join(
            _packed(same, names, "c0"), ranged, ["consumer_id", "promotion_uuid", "sold_to"],
            tie=["subscription_uuid"], prefer=lanes, skeleton=visits, **common,
        )
        both = _packed(both, names, "c1")
        rank = [
            F.struct(
                F.when(F.col(c)["pilot_flag"] == "Y", 0).otherwise(1).alias("n"),
                F.col(c)["sub_end"].alias("e"),
                F.col(c)["subscription_uuid"].alias("u"),
            )
            for c in ("c0", "c1")
        ]
        matched = _best_of(both, names, rank)
    else:
        raise ValueError(rule_type)
    return matched.withColumn("exception_flag", F.coalesce("exception_flag", F.lit("N")))


def flag_visits(visits: DataFrame, state: State, ref: Reference, rule_type: str, clock: Clock, cut: Cut = settle) -> DataFrame:
    """Match, add the last invoice date and evaluate the visit flags."""
    matched = match_subscriptions(visits, state.subscriptions, rule_type, clock.today, cut)
    dated = matched.join(small_by_nature(last_invoice_dates(ref.invoices)), "promotion_uuid", "left")
    return R.apply_rules(dated, ref.rules, R.CYCLE, promotions=ref.active_promotions, as_of=clock.today)


# ---- subscriptions ---------------------------------------------------------


def _audit(clock: Clock, who: str) -> dict[str, Column]:
    return {
        "created_by": F.lit(who), "created_at": F.lit(clock.now),
        "updated_by": F.lit(who), "updated_at": F.lit(clock.now),
    }


def _new_subscriptions(df: DataFrame, clock: Clock, who: str) -> DataFrame:
    return df.withColumns(
        {
            "sub_start": F.col("new_start"),
            "sub_end": F.col("new_end"),
            "version": F.lit(1),
            **_audit(clock, who),
        }
    ).withColumn(
        "subscription_uuid", row_key("consumer_id", "account_uuid", "sold_to", "promotion_uuid", "sub_start", "created_by", "created_at")
    )


def open_subscriptions(subscriptions: DataFrame, visits: DataFrame, ref: Reference, rule_type: str, clock: Clock, cut: Cut = settle) -> DataFrame:
    """Open one subscription per group at its first unmatched visit, unless one already covers that day."""
    group = ["consumer_id", "promotion_uuid"] + (["sold_to"] if rule_type == RULE_CONSUMER_ACCOUNT else [])
    unmatched = visits.where("is_new = 1 AND is_adjust = 0 AND is_per_cycle = 0")
    first = latest_by(
        unmatched, group,
        [F.col("cycle_date").asc(), F.col("first_cycle_ts").asc(), F.col("account_uuid").asc(), F.col("visit_id").asc()],
    )
    fresh = R.apply_rules(first, ref.rules, R.SUBSCRIBE, promotions=ref.active_promotions, as_of=clock.today)
    fresh = fresh.withColumns({"previous_uuid": F.lit(None).cast("string"), "comments": F.col("sub_comments"), "pilot_flag": F.lit(None).cast("string")})
    fresh = cut(_new_subscriptions(fresh, clock, "subscription_live"))
    current = _only_of(_current(subscriptions), fresh)
    seen = {"_seen": "subscription_uuid"}
    common = {"at": "new_start", "start": "sub_start", "end": "sub_end", "closed": "both", "take": seen, "bucket": BUCKET}
    probe = fresh.select("visit_id", "consumer_id", "promotion_uuid", "account_uuid", "sold_to", "new_start")
    if rule_type == RULE_CONSUMER:
        covered = interval_join(probe, current, ["consumer_id", "promotion_uuid"], **common).where("_seen IS NOT NULL")
    else:
        by_account = interval_join(probe, current, ["consumer_id", "promotion_uuid", "account_uuid"], **common)
        by_sold_to = interval_join(probe, current, ["consumer_id", "promotion_uuid", "sold_to"], **common)
        covered = by_account.unionByName(by_sold_to).where("_seen IS NOT NULL")
    return insert_uncovered(subscriptions, fresh, covered=covered, row_key=["visit_id"])


def adjust_subscriptions(subscriptions: DataFrame, visits: DataFrame, ref: Reference, clock: Clock) -> DataFrame:
    """A visit in the gap before a subscription moves its start: the old one is superseded."""
    who = "subscription_adjust"
    late = visits.where("is_adjust = 1 AND is_per_cycle = 0")
    owners = _current(subscriptions).select("subscription_uuid", F.col("account_uuid").alias("_owner"))
    owned = late.join(owners, "subscription_uuid", "left").withColumn("account_uuid", F.coalesce("_owner", "account_uuid")).drop("_owner")
    first = latest_by(
        owned, ["promotion_uuid", "subscription_uuid"],
        [F.col("cycle_date").asc(), F.col("first_cycle_ts").asc(), F.col("account_uuid").asc(), F.col("visit_id").asc()],
    )
    moved = R.apply_rules(first, ref.rules, R.ADJUST, promotions=ref.active_promotions, as_of=clock.today)
    moved = moved.withColumns({"previous_uuid": F.col("subscription_uuid"), "pilot_flag": F.lit(None).cast("string")})
    replacements = _new_subscriptions(moved, clock, who)
    return version_bump(
        subscriptions, replacements, "subscription_uuid", replaces="previous_uuid",
        update={"comments": "comments", "updated_by": "updated_by", "updated_at": "updated_at"},
    )


def _covering(details: DataFrame, subscriptions: DataFrame, rule_type: str, take: dict[str, str]) -> DataFrame:
    """The current subscription covering each line's day (latest end first)."""
    current = _only_of(_current(subscriptions), details)
    common = {"at": "cycle_date", "start": "sub_start", "end": "sub_end", "closed": "both", "tie": ["subscription_uuid"], "bucket": BUCKET}
    if rule_type == RULE_CONSUMER:
        return interval_join(details, current, ["consumer_id", "promotion_uuid"], take=take, **common)
    inner = {**take, "subscription_uuid": "subscription_uuid", "_e": "sub_end"}
    by_account = interval_join(
        details.withColumnRenamed("subscription_uuid", "_own"), current, ["consumer_id", "promotion_uuid", "account_uuid"], take=inner, **common
    )
    both = interval_join(
        _packed(by_account, list(inner), "c0"), current, ["consumer_id", "promotion_uuid", "sold_to"], take=inner, skeleton=details, **common
    )
    rank = [F.struct(F.col(c)["_e"].alias("e"), F.col(c)["subscription_uuid"].alias("u")) for c in ("c0", "c1")]
    best = _best_of(_packed(both, list(inner), "c1"), list(take), rank)
    return best.withColumnRenamed("_own", "subscription_uuid")


def _touched(details: DataFrame, visits: DataFrame, *more: str) -> DataFrame:
    """Current lines of the consumers seen in `visits`."""
    consumers = visits.where("is_per_cycle = 0").select("consumer_id", "promotion_uuid", *more).distinct()
    return details.where("version = 1").join(consumers, ["consumer_id", "promotion_uuid"])


def realign_subscriptions(
    subscriptions: DataFrame, details: DataFrame, visits: DataFrame, ref: Reference, rule_type: str, clock: Clock
) -> DataFrame:
    """Open a subscription for the first line left without one after an adjustment."""
    lines = _touched(details, visits).select(
        "cycle_date", "account_uuid", "sold_to", "promotion_uuid", "consumer_id", "charge", "subscription_uuid", "detail_uuid"
    )
    owned = lines.join(
        subscriptions.select("subscription_uuid", "version", "exception_flag", "sub_end"), "subscription_uuid", "left"
    )
    covered = _covering(owned, subscriptions, rule_type, {"covering_uuid": "subscription_uuid"})
    judged = R.apply_rules(covered, ref.rules, R.REALIGN, promotions=ref.active_promotions, as_of=clock.today)
    group = ["consumer_id", "promotion_uuid"] + (["account_uuid"] if rule_type == RULE_CONSUMER_ACCOUNT else [])
    first = latest_by(
        judged.where("needs_subscription = 1"), group,
        [F.col("cycle_date").asc(), F.col("account_uuid").asc(), F.col("detail_uuid").asc()],
    )
    first = first.withColumns({"previous_uuid": F.lit(None).cast("string"), "pilot_flag": F.lit(None).cast("string")})
    fresh = _new_subscriptions(first, clock, "subscription_realign")
    known = _current(subscriptions).select(*group, F.col("sub_start").alias("new_start")).distinct()
    held = fresh.join(known, [*group, "new_start"], "left_semi")
    return insert_uncovered(subscriptions, fresh, covered=held, row_key=["detail_uuid"])


# ---- invoice lines ---------------------------------------------------------


def billed_to_date(details: DataFrame) -> DataFrame:
    return details.where("version = 1").groupBy("subscription_uuid").agg(F.sum("charge").alias("billed"))


def _priced(df: DataFrame, classes: DataFrame, how: str = "inner") -> DataFrame:
    prices = classes.select(
        "class_name", "promotion_uuid", "class_uuid", "list_price", "calc_type",
        F.col("effective").alias("_class_from"), F.col("termination").alias("_class_to"),
    )
    return (
        df.join(small_by_nature(prices), ["class_name", "promotion_uuid"], how)
        .where(F.col("cycle_date").between(F.col("_class_from"), F.col("_class_to")))
        .drop("_class_from", "_class_to")
    )


def _other_account_match(visits: DataFrame, current: DataFrame) -> DataFrame:
    """A subscription of the same sold-to but another account that covers the visit."""
    take = {
        "_o_uuid": "subscription_uuid", "_o_billed": "billed", "_o_start": "sub_start", "_o_end": "sub_end",
        "_o_pilot": "pilot_flag", "_o_account": "account_uuid",
    }
    return other_owner_join(
        visits, current, ["consumer_id", "sold_to", "promotion_uuid"], at="cycle_date", start="sub_start", end="sub_end",
        owner="account_uuid", tie=["subscription_uuid"], take=take, bucket=BUCKET,
    )


def number_visits(visits: DataFrame) -> DataFrame:
    """Order of each visit within its subscription and programme."""
    return number_in_group(
        visits, ["subscription_uuid", "promotion_uuid"],
        ["cycle_date", "first_cycle_ts", "account_uuid", "visit_id"], "visit_no", bucket="1 day",
    )


def classify_visits(visits: DataFrame, state: State, ref: Reference, rule_type: str, clock: Clock, cut: Cut = settle) -> DataFrame:
    """Visits with subscription, amount billed so far, visit order, class and comment."""
    held = _only_of(_current(state.subscriptions), visits)
    billed = billed_to_date(_only_of(state.details, held, ["subscription_uuid"]))
    current = cut(held.join(billed, "subscription_uuid", "left"))
    take = {
        "subscription_uuid": "subscription_uuid", "billed": "billed", "sub_start": "sub_start",
        "pilot_flag": "pilot_flag", "sub_comments": "comments", "sub_account_uuid": "account_uuid",
    }
    bare = visits.drop(*_SUB)
    may_match = (F.col("is_per_cycle") == 0) | (F.col("waits_for_subscription") == 1)
    probe = bare.withColumn("_match_day", F.when(may_match, F.col("cycle_date")))
    keys = ["consumer_id", "promotion_uuid"] + (["account_uuid"] if rule_type == RULE_CONSUMER_ACCOUNT else [])
    matched = interval_join(
        probe, current, keys, at="_match_day", start="sub_start", end="sub_end", closed="both",
        tie=["subscription_uuid"], take=take, bucket=BUCKET,
    ).drop("_match_day")
    if rule_type == RULE_CONSUMER_ACCOUNT:
        other = _other_account_match(matched, current)
        matched = other.withColumns(
            {
                "sub_account_uuid": F.col("_o_account"),
                "subscription_uuid": F.coalesce("subscription_uuid", "_o_uuid"),
                "billed": F.coalesce("billed", "_o_billed"),
                "sub_start": F.coalesce("sub_start", "_o_start"),
                "pilot_flag": F.coalesce("pilot_flag", "_o_pilot"),
            }
        ).drop("_o_uuid", "_o_billed", "_o_start", "_o_end", "_o_pilot", "_o_account")
    else:
        matched = matched.withColumn("sub_account_uuid", F.col("account_uuid"))
    numbered = number_visits(cut(matched.withColumn("billed_amount", F.coalesce("billed", F.lit(0)).cast("decimal(28,2)")).drop("billed")))
    return R.apply_rules(numbered, ref.rules, R.CLASSIFY, promotions=ref.active_promotions, as_of=clock.today)


LINE_KEYS = ("cycle_date", "subscription_uuid", "promotion_uuid", "account_uuid")


def live_details(visits: DataFrame, state: State, ref: Reference, rule_type: str, clock: Clock, cut: Cut = settle) -> DataFrame:
    """New invoice lines of the batch, priced; repeats of a known line are added to it."""
    billable = visits.where("is_adjust = 0 OR is_per_cycle = 1")
    priced = _priced(classify_visits(billable, state, ref, rule_type, clock, cut), ref.classes)
    lines = priced.groupBy(
        "subscription_uuid", "consumer_id", "account_uuid", "sold_to", "promotion_uuid", "cycle_date",
        "class_uuid", "comments", "calc_type", "list_price", "last_invoice_date",
    ).agg(F.sum("cycle_count").alias("cycle_count"))
    charged = R.apply_rules(lines, ref.rules, R.AMOUNT, promotions=ref.active_promotions, as_of=clock.today)
    stamped = charged.withColumns({"version": F.lit(1), **_audit(clock, "detail_live")}).withColumn(
        "detail_uuid",
        row_key("subscription_uuid", "consumer_id", "account_uuid", "sold_to", "promotion_uuid", "cycle_date", "class_uuid", "comments", "created_at"),
    )
    return merge_details(state.details, cut(stamped))


def merge_details(details: DataFrame, lines: DataFrame) -> DataFrame:
    """Add cycle counts to current lines of the same day, subscription, programme and account; insert the rest."""
    current = details.where("version = 1").select(*LINE_KEYS).distinct()
    repeats = lines.join(current, list(LINE_KEYS), "left_semi")
    added = repeats.groupBy(*LINE_KEYS).agg(
        F.sum("cycle_count").alias("cycle_count"), F.max("last_invoice_date").alias("last_invoice_date"),
        F.max("updated_by").alias("updated_by"), F.max("updated_at").alias("updated_at"),
    ).withColumn("version", F.lit(1))
    invoiced = "CAST(t.created_at AS DATE) <= s.last_invoice_date"
    grown = upsert(
        details, added, [*LINE_KEYS, "version"], insert=False,
        update={
            "cycle_count": "t.cycle_count + s.cycle_count",
            "comments": (
                f"CASE WHEN {invoiced} AND t.consumer_id <> 'MISSING' THEN '{R.COMMENTS['update_new']}' "
                f"WHEN {invoiced} AND t.consumer_id = 'MISSING' THEN '{R.COMMENTS['update_no_association']}' ELSE t.comments END"
            ),
            "updated_by": "s.updated_by",
            "updated_at": "s.updated_at",
        },
    )
    return insert_uncovered(grown, lines, covered=repeats, row_key=["detail_uuid"])


def true_up_details(visits: DataFrame, state: State, ref: Reference, rule_type: str, clock: Clock, cut: Cut = settle) -> DataFrame:
    """Reclassify lines whose subscription was superseded, under the one that now covers them."""
    lines = _touched(state.details, visits, "last_invoice_date")
    superseded = state.subscriptions.where("version <> 1").select("subscription_uuid")
    orphaned = lines.join(superseded, "subscription_uuid", "left_semi")
    covered = cut(_covering(orphaned, state.subscriptions, rule_type, {"covering_uuid": "subscription_uuid", "covering_comments": "comments"}))
    summed = with_group_totals(covered, ["covering_uuid"], subscription_amount=F.sum("charge"))
    flagged = with_flags(summed, ref, "PerSubscription")
    numbered = number_in_group(
        flagged.withColumn("billed_amount", F.coalesce("subscription_amount", F.lit(0))),
        ["covering_uuid", "promotion_uuid"], ["cycle_date", "account_uuid", "detail_uuid"], "visit_no", bucket="1 day", skeleton=covered,
    )
    judged = R.apply_rules(
        numbered.withColumnRenamed("comments", "_old_comments"), ref.rules, R.TRUE_UP,
        promotions=ref.active_promotions, as_of=clock.today,
    )
    priced = _priced(judged.drop("class_uuid"), ref.classes)
    who = "true_up"
    fresh = priced.withColumns(
        {
            "_replaced": F.col("detail_uuid"),
            "subscription_uuid": F.col("covering_uuid"),
            "charge": F.col("list_price"),
            **_audit(clock, who),
        }
    ).withColumn("detail_uuid", row_key("_replaced", "subscription_uuid", "class_uuid", "created_at"))
    return version_bump(
        state.details, cut(fresh), "detail_uuid", replaces="_replaced",
        update={"comments": "comments", "updated_by": "updated_by", "updated_at": "updated_at"},
    )


# ---- comments --------------------------------------------------------------

#: Lines created or changed in this time before a batch get comments again.
RECENT_MINUTES = 15


def _recent(clock: Clock, minutes: int) -> Column:
    since = F.lit(clock.now - timedelta(minutes=minutes))
    return F.coalesce((F.col("version") == 1) & ((F.col("created_at") >= since) | (F.col("updated_at") >= since)), F.lit(False))


def backfill_comments(details: DataFrame, subscriptions: DataFrame, ref: Reference, clock: Clock, minutes: int = RECENT_MINUTES,
                      rest: State | None = None) -> DataFrame:
    """Comments that depend on the whole ledger, for lines touched in the last `minutes`.

    `rest` is what else the ledgers hold: it is looked up, and not returned.

    Of several invoice periods in force, a line is late if it is so for any one. Two choices are deliberate: a line
    without `updated_by` counts as not patched, and invoice dates are taken per programme.
    """
    m = R.COMMENTS
    since = F.lit(clock.now - timedelta(minutes=minutes))
    touched = _recent(clock, minutes)
    recent, others = details.where(touched), details.where(~touched)
    ledger = details.unionByName(rest.details) if rest else details
    everyone = subscriptions.unionByName(rest.subscriptions) if rest else subscriptions
    several = (
        _only_of(_current(everyone), recent).groupBy("consumer_id").agg(F.count_distinct("subscription_uuid").alias("_n"))
        .where("_n > 1").select("consumer_id", F.lit(True).alias("_several"))
    )
    names = small_by_nature(ref.classes.select("class_uuid", F.col("class_name").alias("_class")).distinct())
    invoiced = small_by_nature(last_invoice_dates(ref.invoices).withColumnRenamed("last_invoice_date", "_invoiced"))

    def described(df: DataFrame) -> DataFrame:
        return df.join(names, "class_uuid", "left").join(invoiced, "promotion_uuid", "left")

    day_keys = ["account_uuid", "cycle_date", "class_uuid"]
    earlier = (
        described(_only_of(ledger, recent, day_keys))
        .where(F.expr(f"version = 1 AND _class = '{R.CLASSES['no_association']}' AND created_at <= _invoiced"))
        .select(*day_keys).distinct().withColumn("_earlier", F.lit(True))
    )
    periods = ref.periods.where(F.lit(clock.now).between(F.col("period_start"), F.col("period_end"))).select("period_start").distinct().orderBy("period_start")
    starts = [row.period_start for row in periods.collect()]
    joined = described(recent).join(several, "consumer_id", "left").join(earlier, day_keys, "left")
    current = F.col("version") == 1
    empty = F.coalesce(F.col("comments"), F.lit("")) == ""
    by_patch = F.coalesce(F.col("updated_by"), F.lit("")).startswith("patch")
    created, updated = F.col("created_at"), F.col("updated_at")

    def note(df: DataFrame, condition: Column, text: Column | str) -> DataFrame:
        hit = F.coalesce(condition, F.lit(False))
        return df.withColumns(
            {
                "_hit": hit,
            }
        ).withColumns(
            {
                "comments": F.when(F.col("_hit"), F.lit(text) if isinstance(text, str) else text).otherwise(F.col("comments")),
                "updated_at": F.when(F.col("_hit"), F.lit(clock.now)).otherwise(updated),
                "updated_by": F.when(F.col("_hit"), F.lit("comments")).otherwise(F.col("updated_by")),
            }
        ).drop("_hit")

    out = note(joined, current & empty & (F.col("_class") == R.CLASSES["per_patient"]) & F.col("_several") & (created >= since), m["return"])
    out = note(
        out,
        current & empty & (created.cast("date") <= F.col("_invoiced")) & (updated.cast("date") > F.col("_invoiced"))
        & (updated >= since) & ~by_patch,
        m["update_new"],
    )
    open_comment = empty | (F.col("comments") == m["late_no_association"])
    out = note(
        out,
        current & open_comment & F.col("_earlier") & (created > F.col("_invoiced")) & (created >= since) & ~by_patch,
        m["update_no_association"],
    )
    if starts:
        text = (
            F.when(F.col("_class") == R.CLASSES["per_patient"], m["late_new"])
            .when(F.col("_class") == R.CLASSES["follow_up"], m["late_follow_up"])
            .when(F.col("_class") == R.CLASSES["no_association"], m["late_no_association"])
        )
        late = reduce(or_, [(F.col("cycle_date") < F.lit(s).cast("date")) & (created > F.lit(s)) for s in starts])
        out = note(out, current & empty & text.isNotNull() & late & (created >= since), text)
    return out.select(*details.columns).unionByName(others)


# ---- the batch -------------------------------------------------------------


def batch_part(state: State, eligible: DataFrame, clock: Clock, cut: Cut = settle) -> tuple[State, State]:
    """What a batch may change, stored, and what it only reads, which stays where it is.

    Steps change rows of the batch's consumers, lines of their subscriptions, and comments of recent lines.
    """
    consumers = cut(eligible.select(F.col("consumer_id").alias("_consumer")).where("_consumer IS NOT NULL").distinct())

    def split(table: DataFrame, own: DataFrame, also: Column | None = None) -> tuple[DataFrame, DataFrame]:
        marked = table.join(small(consumers.withColumn("_ours", F.lit(True))), F.col("consumer_id") == F.col("_consumer"), "left").drop("_consumer")
        if also is not None:
            marked = marked.join(small(own), F.col("subscription_uuid") == F.col("_own"), "left").withColumn(
                "_ours", F.col("_ours").isNotNull() | F.col("_own").isNotNull() | also).drop("_own")
        ours = F.coalesce("_ours", F.lit(False))
        return cut(marked.where(ours).drop("_ours")), marked.where(~ours).drop("_ours")

    subscriptions, other_subscriptions = split(state.subscriptions, consumers)
    own = subscriptions.select(F.col("subscription_uuid").alias("_own")).where("_own IS NOT NULL").distinct()
    details, other_details = split(state.details, own, _recent(clock, RECENT_MINUTES))
    return State(subscriptions, details, state.audit), State(other_subscriptions, other_details)


def whole_ledgers(part: State, rest: State, cut: Cut = settle) -> State:
    """The ledgers after a batch, each written once."""
    return State(cut(rest.subscriptions.unionByName(part.subscriptions)), cut(rest.details.unionByName(part.details)), part.audit)


def process_visits(visits: DataFrame, state: State, ref: Reference, rule_type: str, clock: Clock,
                   cut: Cut = settle, rest: State | None = None) -> State:
    """One rule type of a batch. Each step reads what the one before wrote, so lineage is cut between them.

    With `rest` (see `batch_part`) the state is the batch's part of the ledgers, so a step stores no more than that.
    """
    flagged = cut(flag_visits(visits, state, ref, rule_type, clock, cut))
    subscriptions, details = state.subscriptions, state.details
    if not flagged.where("is_adjust = 1 AND is_per_cycle = 0").isEmpty():
        subscriptions = cut(adjust_subscriptions(subscriptions, flagged, ref, clock))
        subscriptions = cut(realign_subscriptions(subscriptions, details, flagged, ref, rule_type, clock))
        details = cut(true_up_details(flagged, State(subscriptions, details), ref, rule_type, clock, cut))
    subscriptions = cut(open_subscriptions(subscriptions, flagged, ref, rule_type, clock, cut))
    details = cut(live_details(flagged, State(subscriptions, details), ref, rule_type, clock, cut))
    details = cut(backfill_comments(details, subscriptions, ref, clock, rest=rest))
    audit = {**state.audit, f"{R.CYCLE}/{rule_type}": R.rule_audit(flagged, R.CYCLE, clock.user, clock.now)}
    return State(subscriptions, details, audit)


def process_eligible(eligible: DataFrame, state: State, ref: Reference, clock: Clock,
                     cut: Cut = settle, rest: State | None = None) -> State:
    visits = cut(with_flags(cut(aggregate_visits(eligible)), ref))
    for rule_type in (RULE_CONSUMER, RULE_CONSUMER_ACCOUNT):
        of_type = visits.where(F.col("rule_type") == rule_type)
        if not of_type.isEmpty():
            state = process_visits(of_type, state, ref, rule_type, clock, cut, rest)
    return state


def run_batch(cycles: DataFrame, state: State, ref: Reference, clock: Clock, *,
              overrides: DataFrame | None = None, all_cycles: DataFrame | None = None,
              cut: Cut = settle) -> tuple[State, DataFrame | None]:
    """Overrides first, then the new cycles. Returns the state and the overrides with their new status.

    The batch's part of the ledgers is taken out once, all steps work on it, and each ledger is written once at the end.
    """
    done, turns = overrides, []
    if overrides is not None and all_cycles is not None:
        waiting = overrides.where("coalesce(workflow_status, '') = ''")
        if not waiting.isEmpty():
            turns.append((cut(eligible_overrides(all_cycles, waiting, ref)), replace(clock, user="override")))
            done = set_status(overrides, waiting, ["cycle_id", "promotion_uuid", "created_at"], "workflow_status", "Success")
    turns.append((cut(eligible_cycles(cycles, ref)), clock))
    turns = [turn for turn in turns if not turn[0].isEmpty()]
    if not turns:
        return state, done
    part, rest = batch_part(state, reduce(DataFrame.union, [eligible.select("consumer_id") for eligible, _ in turns]), clock, cut)
    for eligible, moment in turns:
        part = process_eligible(eligible, part, ref, moment, cut, rest)
    return whole_ledgers(part, rest, cut), done


def judge_exceptions(exceptions: DataFrame, ref: Reference, clock: Clock) -> DataFrame:
    """Comment, class and new end date of care exceptions, by the exception rules."""
    return R.apply_rules(exceptions, ref.rules, R.EXCEPTION, promotions=ref.active_promotions, as_of=clock.today)


def end_subscriptions(subscriptions: DataFrame, judged: DataFrame, clock: Clock) -> DataFrame:
    """Write the new end of judged exceptions and mark the subscription as fixed by an exception."""
    ends = judged.groupBy("subscription_uuid").agg(F.min("new_end").alias("new_end")).withColumn("at", F.lit(clock.now))
    return upsert(
        subscriptions, ends, ["subscription_uuid"], condition="t.version = 1", insert=False,
        update={"sub_end": "s.new_end", "exception_flag": "'Y'", "updated_by": "'exception'", "updated_at": "s.at"},
    )


# ---- other account used ----------------------------------------------------


def cards_used_elsewhere(usage: DataFrame, shipments: DataFrame, accounts: DataFrame, *, bucket: str = BUCKET) -> DataFrame:
    """Cards used at another account than they were shipped to, where the using account has no programme.

    usage: card, serial, ship_to, sold_to, cycle_date, promotion_name, country, cycles
    """
    # Each join reads its left side twice, so it is stored; rows that the result can't have leave at once.
    sent = settle(interval_join(
        settle(usage), settle(shipments.where("transit_status = 'SHIPPED'")), {"card": "serial", "country": "country"},
        at="cycle_date", start="ship_start", end="ship_end",
        take={"sent_ship_to": "ship_to", "sent_sold_to": "sold_to"}, bucket=bucket,
    ).where("sent_ship_to <> ship_to"))
    flag = {"start": "effective", "end": "termination", "closed": "both", "at": "cycle_date", "bucket": bucket}
    used = settle(interval_join(sent, accounts, ["ship_to"], take={"_used": "account_uuid"}, **flag).where("_used IS NULL"))
    both = interval_join(used, accounts, {"sent_ship_to": "ship_to"}, take={"_sent": "account_uuid"}, **flag)
    return (
        both.withColumns({"usage_in_programme": F.lit(0), "sent_in_programme": F.when(F.col("_sent").isNull(), 0).otherwise(1)})
        .drop("_used", "_sent")
        .distinct()
    )


def back_fill_invoice_numbers(invoices: DataFrame, orders: DataFrame) -> DataFrame:
    """Invoice number of the largest order total, for lines that have none yet."""
    from usagelake.operators.dedup import top_by_sum
    from usagelake.operators.upsert import fill_if_null

    top = top_by_sum(orders, "order_number", "invoice_number", F.col("amount"), "total")
    found = top.select(F.col("order_number").alias("sales_order"), F.col("invoice_number").alias("found_number"))
    return fill_if_null(invoices, found, ["sales_order"], {"invoice_number": "found_number"})


def apply_billing_cases(invoices: DataFrame, cases: DataFrame, clock: Clock) -> DataFrame:
    """Case and sales-order numbers of the newest case row, onto its invoice lines."""
    last = latest_by(cases, ["case_id"], [F.col("updated_at").desc(), F.col("case_number").desc()])
    return upsert(
        invoices, last.withColumn("_at", F.lit(clock.now)), ["case_id"], insert=False,
        update={"case_number": "s.case_number", "sales_order": "s.sales_order", "updated_at": "s._at"},
    )


def apply_case_status(rows: DataFrame, statuses: DataFrame, clock: Clock) -> DataFrame:
    return upsert(
        rows, statuses.withColumnRenamed("status", "_status").withColumn("_at", F.lit(clock.now)), ["case_id"], insert=False,
        update={"case_status": "s._status", "updated_at": "s._at"},
    )
