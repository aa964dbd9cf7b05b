"""Keep-one, duplicate audits, content hashes and numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.operators.groups import BUCKET, GROUP, as_column, number_in_group, split_groups


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, first in `order` (give a full tie-break).

    ``row_number() = 1`` is planned with a partial group limit, so each map task
    already drops all but one row per key before the shuffle.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).where("_rn = 1").drop("_rn")


def arg_min(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows carrying the smallest `value` of their key (all of them on ties)."""
    lowest = df.groupBy(*keys).agg(F.min(value).alias(value))
    return df.join(lowest, [*keys, value])


def top_by_sum(df: DataFrame, key: str, candidate: str, amount: Column, total: str) -> DataFrame:
    """Sum per (key, candidate), then the candidate with the largest sum per key."""
    sums = df.groupBy(key, candidate).agg(F.sum(amount).alias(total))
    return latest_by(sums, [key], [F.col(total).desc(), F.col(candidate).asc()])


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).where(F.col(count) > 1)


def concat_set(value: Column, separator: str = ", ") -> Column:
    """Sorted distinct values as text, for value sets that are small by nature."""
    return F.concat_ws(separator, F.array_sort(F.collect_set(value)))


def content_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the business columns in name order; a null is written as a marker, so it keeps its place."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in sorted(columns)]), 256)


def hashed_history(df: DataFrame, ignore: Sequence[str] = (), name: str = "hash_id") -> DataFrame:
    """Add the content hash and keep one row per hash."""
    business = [c for c in df.columns if c not in {*ignore, name}]
    return df.withColumn(name, content_hash(business)).dropDuplicates([name])


def row_key(*columns: str) -> Column:
    """Replay-stable row id from a natural key (in place of a random UUID)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def assign_sequence(
    df: DataFrame, order: Sequence[str | Column], name: str, *, bucket: str | int, start: int = 0
) -> DataFrame:
    """Gap-free numbers from `start + 1`; no task ever sorts the whole table."""
    return number_in_group(df, [], order, name, bucket=bucket, start=start)


def next_start(target: DataFrame, column: str, seed: int = 0) -> int:
    """Largest number in use, or the seed: one scalar reaches the driver."""
    top = target.agg(F.max(column)).first()[0]
    return max(int(top), seed) if top is not None else seed


def mark_first_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], first: str = "is_first", last: str = "is_last"
) -> DataFrame:
    """Flag the first and last row of each group through pre-aggregated bounds."""
    position = F.struct(*[F.col(o) for o in order])
    group = F.struct(*[F.col(k) for k in keys])
    keyed = df.withColumn("_grp", group).withColumn("_pos", position)
    bounds = keyed.groupBy("_grp").agg(F.min("_pos").alias("_lo"), F.max("_pos").alias("_hi"))
    return keyed.join(bounds, "_grp").select(
        *[keyed[c] for c in df.columns],
        (F.col("_pos") == F.col("_lo")).alias(first),
        (F.col("_pos") == F.col("_hi")).alias(last),
    )


def duplicate_flags(
    df: DataFrame,
    *,
    card: str,
    cycle: str,
    head: str,
    date: str,
    device: Sequence[str],
    order: Sequence[str | Column],
    sold: Column,
    bucket: str | int,
) -> DataFrame:
    """Four repeat counters of a card's cycle and the usage flags read from them.

    Counters: by card-cycle-head, the same within a date, within a device, and
    within device and date. Flags are 'Y'/'N'; `used_count` counts the first
    sighting per device and date.

    Rows move three times: by cycle and date for the two counters of a date, by cycle and bucket for the two that
    cross dates, and to the counts of earlier buckets. Those counts are one small table for both counters.
    """
    split = split_groups(df, [card, cycle, head], order, bucket).withColumn("_device", F.struct(*[F.col(d) for d in device]))
    sorting = [as_column(o) for o in order]
    day = Window.partitionBy(GROUP, date).orderBy(*sorting)
    day_device = Window.partitionBy(GROUP, date, "_device").orderBy(*sorting)
    inside = Window.partitionBy(GROUP, BUCKET).orderBy(*sorting)
    inside_device = Window.partitionBy(GROUP, BUCKET, "_device").orderBy(*sorting)
    so_far = Window.partitionBy(GROUP, "_device").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.partitionBy(GROUP).orderBy(BUCKET).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = split.groupBy(GROUP, "_device", BUCKET).agg(F.count(F.lit(1)).alias("_n")).select(
        GROUP, "_device", BUCKET, F.coalesce(F.sum("_n").over(so_far), F.lit(0)).alias("_before_device"),
        (F.sum("_n").over(up_to) - F.sum("_n").over(Window.partitionBy(GROUP, BUCKET))).alias("_before"))
    numbered = split.withColumns({
        "seq_cycle_date": F.row_number().over(day).cast("long"),
        "seq_cycle_date_device": F.row_number().over(day_device).cast("long"),
    }).withColumns({"_rn": F.row_number().over(inside), "_rn_device": F.row_number().over(inside_device)})
    numbered = numbered.join(before, [GROUP, "_device", BUCKET]).withColumns({
        "seq_cycle": F.col("_before") + F.col("_rn"), "seq_cycle_device": F.col("_before_device") + F.col("_rn_device"),
    }).drop(GROUP, BUCKET, "_device", "_rn", "_rn_device", "_before", "_before_device")
    first_use = (F.col("seq_cycle") == 1) & (F.col("seq_cycle_date_device") == 1)

    def flag(good: Column) -> Column:
        return F.when(good, "N").otherwise("Y")

    return numbered.withColumns(
        {
            "unsold_flag": flag(sold),
            "duplicate_flag": flag(F.col("seq_cycle") == 1),
            "utilisation_flag": flag(first_use),
            "used_count": F.when(F.col("seq_cycle_date_device") == 1, 1).otherwise(0),
            "fraud_flag": flag(sold & first_use),
        }
    )


def rank_by_priority(df: DataFrame, keys: Sequence[str], priority: Column, *tie: Column) -> DataFrame:
    """One row per key by a CASE priority, smallest first."""
    return latest_by(df, keys, [priority.asc(), *tie])


def any_order(*columns: str | Column) -> list[Column]:
    return [as_column(c) for c in columns]
