"""Checks as data: each returns rows with a verdict; 'Unknown' means a failure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.constants import BUFFER_MINUTES
from usagelake.functions.columns import prefix_columns
from usagelake.operators.dedup import duplicate_keys

Cases = Sequence[tuple[Column, str]]


def verdict(cases: Cases, otherwise: str = "Unknown") -> Column:
    """First matching case; conditions that are null do not match."""
    out = None
    for condition, text in cases:
        out = F.when(condition, F.lit(text)) if out is None else out.when(condition, F.lit(text))
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], cases: Cases, *, left_prefix: str = "l_", right_prefix: str = "r_",
              how: str = "full_outer", name: str = "verdict") -> DataFrame:
    """Join two independent computations on their keys and judge every row.

    Key columns come out once; all other columns are prefixed by side.
    """
    a, b = prefix_columns(left, left_prefix), prefix_columns(right, right_prefix)
    condition = F.lit(True)
    for k in keys:
        condition = condition & (a[f"{left_prefix}{k}"] == b[f"{right_prefix}{k}"])
    joined = a.join(b, condition, how)
    return joined.select(
        *[F.coalesce(f"{left_prefix}{k}", f"{right_prefix}{k}").alias(k) for k in keys],
        *[c for c in joined.columns if c not in {f"{p}{k}" for k in keys for p in (left_prefix, right_prefix)}],
        verdict(cases).alias(name),
    )


def failures(judged: DataFrame, name: str = "verdict", good: Sequence[str] = ()) -> DataFrame:
    """Rows that failed: verdict 'Unknown', or anything outside `good` when given."""
    return judged.where(~F.col(name).isin(*good)) if good else judged.where(F.col(name) == "Unknown")


def check_result(judged: DataFrame, check: str, at: datetime, name: str = "verdict") -> DataFrame:
    """One summary row of a check, for the results table."""
    bad = F.count(F.when(F.col(name) == "Unknown", 1))
    return judged.agg(
        F.lit(check).alias("check_name"), F.count(F.lit(1)).alias("n_rows"), bad.alias("n_failed"),
        F.when(bad == 0, "Passed").otherwise("Failed").alias("result"), F.lit(at).alias("checked_at"),
    )


def near_edge(at: Column, edge: Column, minutes: int = BUFFER_MINUTES, before: bool = True) -> Column:
    """Within the buffer before (or after) a period edge."""
    gap = F.make_dt_interval(mins=F.lit(minutes))
    return at.between(edge - gap, edge) if before else at.between(edge, edge + gap)


def duplicate_audit(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    return duplicate_keys(df, keys).agg(
        F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")
    )


def missing_rows(expected: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct expected rows the store lacks (null-safe, as EXCEPT)."""
    return expected.select(*columns).subtract(stored.select(*columns))


def stored_rows(expected: DataFrame, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    return expected.select(*columns).intersect(stored.select(*columns))


def daily_counts(left: DataFrame, right: DataFrame, day: str, left_name: str = "left_count", right_name: str = "right_count") -> DataFrame:
    """Rows per day on both sides and their difference."""
    a = left.groupBy(day).agg(F.count(F.lit(1)).alias(left_name))
    b = right.groupBy(day).agg(F.count(F.lit(1)).alias(right_name))
    return a.join(b, day, "full_outer").withColumn("difference", F.col(left_name) - F.col(right_name))


def count_report(left: DataFrame, right: DataFrame, day: str, keys: Sequence[str]) -> DataFrame:
    """Per day: totals, keys present on one side only, matches, and which side is complete."""
    names = [day, *keys]
    a = left.groupBy(*names).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(*names).agg(F.count(F.lit(1)).alias("_b"))
    gap = F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))
    per_key = a.join(b, names, "full_outer").withColumn("_gap", gap)
    tally = per_key.groupBy(day).agg(
        F.sum("_a").alias("left_count"), F.sum("_b").alias("right_count"),
        F.count(F.when(F.col("_gap") < 0, 1)).alias("missing_left"),
        F.count(F.when(F.col("_gap") > 0, 1)).alias("missing_right"),
        F.count(F.when(F.col("_gap") == 0, 1)).alias("matching"),
    ).withColumn("expected", F.col("missing_left") + F.col("missing_right") + F.col("matching"))
    left_ok, right_ok = F.col("expected") == F.col("left_count"), F.col("expected") == F.col("right_count")
    return tally.withColumn(
        "comment", verdict([(left_ok & right_ok, "Both good"), (left_ok, "Left good"), (right_ok, "Right good")], "Neither good")
    )


def measure_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the measures; values are kept apart and nulls in place."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)


def compare_hashed(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Snapshot against summary: hash of measures per key."""
    a = left.withColumn("hash", measure_hash(measures)).select(*keys, "hash")
    b = right.withColumn("hash", measure_hash(measures)).select(*keys, "hash")
    return reconcile(
        a, b, keys,
        [
            (F.col("l_hash") == F.col("r_hash"), "Matched"),
            (F.col("l_hash") != F.col("r_hash"), "Not Matched"),
            (F.col("l_hash").isNull(), "Missing left"),
            (F.col("r_hash").isNull(), "Missing right"),
        ],
    )


# Accrual totals and the class orders they add up.
ACCRUAL: Mapping[str, tuple[int, ...]] = {
    "total_invoices": (1, 2, 3, 4, 5, 6, 7, 12, 13, 14),
    "per_patient": (1,),
    "per_patient_exception_pre": (2,),
    "per_patient_invoiced": (1, 2),
    "per_cycle": (3,),
    "per_cycle_exception_pre": (4,),
    "per_cycle_invoiced": (3, 4),
    "no_association": (5,),
    "no_association_exception_pre": (6,),
    "no_association_invoiced": (5, 6),
    "per_cycle_exception": (7,),
    "post_invoice_exception": (9, 10, 11),
    "map_violation": (12,),
    "fraud_violation": (13,),
    "non_programme": (14,),
}
MIDWAY_ORDER = 15


def accrual_details(rows: DataFrame, keys: Sequence[str], order: str = "class_order", amount: str = "amount",
                    totals: Mapping[str, Sequence[int]] = ACCRUAL) -> DataFrame:
    """Conditional totals per account and period, in one pass."""
    return rows.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(order).isin(*places), F.col(amount))), F.lit(0)).cast("bigint").alias(name)
            for name, places in totals.items()
        ]
    )


def accrual_summary(rows: DataFrame, keys: Sequence[str], account: str, order: str = "class_order", amount: str = "amount",
                    totals: Mapping[str, Sequence[int]] = ACCRUAL) -> DataFrame:
    """The same totals per period in long form, with the number of accounts."""
    accounts = rows.groupBy(*keys).agg(F.count_distinct(account).alias("n_accounts"))
    wide = accrual_details(rows, keys, order, amount, totals).join(accounts, list(keys))
    return wide.unpivot([*keys, "n_accounts"], list(totals), "description", "total")


def midway_summary(rows: DataFrame, keys: Sequence[str], account: str, order: str = "class_order", amount: str = "amount") -> DataFrame:
    return accrual_summary(rows.where(F.col(order) == MIDWAY_ORDER), keys, account, order, amount, {"midway": (MIDWAY_ORDER,)})


# ---- billing checks --------------------------------------------------------


def expected_lines(visits: DataFrame) -> DataFrame:
    """Cycles per account, consumer, programme and day, recomputed from the usage facts."""
    return visits.groupBy("account_uuid", "consumer_id", "promotion_uuid", "cycle_date").agg(
        F.sum("cycle_count").alias("cycle_count"), F.max("created_at").alias("created_at")
    )


BILL_KEYS = ("account_uuid", "consumer_id", "promotion_uuid", "cycle_date")


def _billed(details: DataFrame) -> DataFrame:
    return details.where("version = 1").groupBy(*BILL_KEYS).agg(
        F.sum("cycle_count").alias("cycle_count"), F.sum("charge").alias("charge"), F.max("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"), F.max("created_by").alias("created_by"), F.max("invoiced").alias("invoiced"),
        F.max("pilot_flag").alias("pilot_flag"), F.max("class_name").alias("class_name"), F.max("sub_end").alias("sub_end"),
    )


def line_period_cases(start: datetime, end: datetime) -> Cases:
    """What explains a difference between usage (l_) and lines (r_)."""
    return [
        (F.col("r_invoiced"), "Already invoiced"),
        (near_edge(F.col("l_created_at"), F.lit(end)), "Received at the period end"),
        (near_edge(F.col("r_created_at"), F.lit(start), before=False), "Received at the period start"),
        (F.col("r_pilot_flag") == "Y", "Pilot subscription"),
        (F.col("l_created_at").isNull() & F.col("r_created_by").startswith("patch"), "Data patch"),
        (near_edge(F.col("r_updated_at"), F.lit(end), before=False), "Updated after the period end"),
    ]


def check_cycle_counts(visits: DataFrame, details: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Cycle counts of usage and invoice lines agree."""
    same = F.col("l_cycle_count") == F.col("r_cycle_count")
    return reconcile(expected_lines(visits), _billed(details), BILL_KEYS, [(same, "Matched"), *line_period_cases(start, end)])


def check_visit_dates(visits: DataFrame, details: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Every treated day is on an invoice line and the other way round."""
    both = F.col("l_cycle_count").isNotNull() & F.col("r_cycle_count").isNotNull()
    return reconcile(expected_lines(visits), _billed(details), BILL_KEYS, [(both, "Matched"), *line_period_cases(start, end)])


def check_charges(expected: DataFrame, details: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Amounts recomputed per line agree. `expected` adds `charge` to the line keys and `created_at`."""
    same = F.col("l_charge") == F.col("r_charge")
    return reconcile(expected, _billed(details), BILL_KEYS, [(same, "Matched"), *line_period_cases(start, end)])


def check_class(expected: DataFrame, details: DataFrame, start: datetime, end: datetime, column: str = "class_name") -> DataFrame:
    """Class (or comment) recomputed per line agrees."""
    same = F.col(f"l_{column}") == F.col(f"r_{column}")
    return reconcile(expected, _billed(details), BILL_KEYS, [(same, "Matched"), *line_period_cases(start, end)])


def check_exceptions(exceptions: DataFrame, details: DataFrame, subscriptions: DataFrame, end: datetime) -> DataFrame:
    """Granted exceptions reached the invoice lines, and full credits ended their subscription."""
    lines = details.where("case_number IS NOT NULL").select(F.col("case_number").alias("_case")).distinct()
    subs = subscriptions.where("version = 1").select("subscription_uuid", F.col("sub_end").alias("_sub_end"), "pilot_flag")
    joined = exceptions.join(lines, F.col("case_number") == F.col("_case"), "left").join(subs, "subscription_uuid", "left")
    ended = (F.col("credit_amount") != 950) | (F.col("_sub_end") <= F.col("exception_created").cast("date"))
    return joined.withColumn(
        "verdict",
        verdict([
            (F.col("_case").isNotNull() & ended, "Matched"),
            (F.col("ship_to").isNull(), "Invalid account"),
            (near_edge(F.col("exception_created"), F.lit(end)), "Received at the period end"),
            (F.col("pilot_flag") == "Y", "Pilot subscription"),
        ]),
    ).drop("_case", "_sub_end")
