"""Ordered work inside groups that may hold most of the table.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here a
group is first cut into order-preserving buckets (a day, an hour, a block of
numbers). Rows are windowed per (group, bucket) and each bucket is reduced to
one edge row; a second, small window over the edge rows carries values across
bucket borders. Results equal the plain window, no task holds a whole hot group.

The edge pass reads its input a second time (only keys and order). When such
operators are chained, pass the unjoined input as `skeleton` or settle the
frame in between, so that passes add up instead of multiplying.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
_BELOW = -(2**62)
GROUP, BUCKET = "_grp", "_bkt"


def width_seconds(width: str) -> int:
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", width)
    if not match or match.group(2) not in _UNITS:
        raise ValueError(f"not a bucket width: {width!r}")
    return int(match.group(1)) * _UNITS[match.group(2)]


def bucket_of(value: Column, data_type: T.DataType, width: str | int) -> Column:
    """Monotone bucket number of a date, timestamp or number."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        seconds = width_seconds(width) if isinstance(width, str) else int(width)
        return F.floor(value.cast("timestamp").cast("long") / F.lit(seconds)).cast("long")
    if isinstance(data_type, T.NumericType):
        return F.floor(value / F.lit(width)).cast("long")
    raise TypeError(f"cannot bucket {data_type.simpleString()}; order by a date, timestamp or number first")


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def order_key(order: Sequence[str | Column]) -> Column:
    """The order as one value, for aggregates; windows sort by its parts, so that no row carries it through a shuffle."""
    return F.struct(*[as_column(o).alias(f"o{i}") for i, o in enumerate(order)])


def split_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: str | int) -> DataFrame:
    """Add group and bucket columns; the first order column decides the bucket."""
    lead = as_column(order[0])
    lead_type = df.select(lead).schema.fields[0].dataType
    return df.select(
        "*",
        # A struct key keeps null keys equal to each other in joins and windows alike.
        F.struct(*[F.col(k) for k in keys]).alias(GROUP),
        F.coalesce(bucket_of(lead, lead_type, bucket), F.lit(_BELOW)).alias(BUCKET),
    )


def _inside(order: Sequence[str | Column]) -> Window:
    return Window.partitionBy(GROUP, BUCKET).orderBy(*[as_column(o) for o in order])


def _across() -> Window:
    return Window.partitionBy(GROUP).orderBy(BUCKET)


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    *,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    number: str | None = None,
    number_from_end: str | None = None,
    bucket: str | int,
) -> DataFrame:
    """lag(1), lead(1) and row numbers per group in one pass.

    ``previous={"prev_end": "end_ts"}`` adds the prior row's value; `number` counts
    from the first row, `number_from_end` from the last.
    """
    previous, following = dict(previous or {}), dict(following or {})
    base = split_groups(df, keys, order, bucket)
    rows, edge_aggs, carried = base, [F.count(F.lit(1)).alias("_n")], []
    for name, wanted, shift in (("_p", previous, F.lag), ("_f", following, F.lead)):
        if not wanted:
            continue
        payload = F.struct(*[F.col(source).alias(target) for target, source in wanted.items()])
        rows = rows.withColumn(name, shift(payload).over(_inside(order)))
        pick = F.max_by if shift is F.lag else F.min_by
        edge_aggs.append(pick(payload, order_key(order)).alias(name))
        carried.append(shift(F.col(name)).over(_across()).alias(f"{name}c"))
    if number or number_from_end:
        rows = rows.withColumn("_rn", F.row_number().over(_inside(order)))
        before = F.sum("_n").over(_across().rowsBetween(Window.unboundedPreceding, -1))
        after = F.sum("_n").over(_across().rowsBetween(1, Window.unboundedFollowing))
        carried += [F.coalesce(before, F.lit(0)).alias("_before"), F.coalesce(after, F.lit(0)).alias("_after"), "_n"]
    edges = base.groupBy(GROUP, BUCKET).agg(*edge_aggs).select(GROUP, BUCKET, *carried)
    joined = rows.join(edges, [GROUP, BUCKET])
    added = [
        F.coalesce(F.col(name), F.col(f"{name}c"))[target].alias(target)
        for name, wanted in (("_p", previous), ("_f", following))
        for target in wanted
    ]
    if number:
        added.append((F.col("_before") + F.col("_rn")).cast("long").alias(number))
    if number_from_end:
        added.append((F.col("_after") + F.col("_n") - F.col("_rn") + 1).cast("long").alias(number_from_end))
    replaced = {*previous, *following, number, number_from_end}
    return joined.select(*[c for c in df.columns if c not in replaced], *added)


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    *,
    bucket: str | int,
    start: int = 0,
    skeleton: DataFrame | None = None,
) -> DataFrame:
    """``row_number()`` per group (all rows when `keys` is empty), plus `start`.

    `skeleton` is a cheaper frame with the same keys and order (such as `df`
    before other joins); the counting pass reads that instead.
    """
    if not keys:
        df = df.withColumn("_all", F.lit(0))
        skeleton = skeleton.withColumn("_all", F.lit(0)) if skeleton is not None else None
        keys = ["_all"]
    base = split_groups(df, keys, order, bucket)
    counted = split_groups(skeleton, keys, order, bucket) if skeleton is not None else base
    offsets = (
        counted.groupBy(GROUP, BUCKET)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            GROUP,
            BUCKET,
            F.coalesce(
                F.sum("_n").over(_across().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
        )
    )
    kept = [c for c in df.columns if c not in ("_all", name)]
    return (
        base.withColumn("_rn", F.row_number().over(_inside(order)))
        .join(offsets, [GROUP, BUCKET])
        .select(*kept, (F.col("_before") + F.col("_rn") + F.lit(start)).cast("long").alias(name))
    )


def fill_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    columns: Mapping[str, str],
    *,
    bucket: str | int,
) -> DataFrame:
    """Last non-null value so far per group: ``columns={"filled": "value"}``."""
    base = split_groups(df, keys, order, bucket)
    running = _inside(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = _across().rowsBetween(Window.unboundedPreceding, -1)
    edges = base.groupBy(GROUP, BUCKET).agg(
        *[
            F.max_by(F.col(source), F.when(F.col(source).isNotNull(), order_key(order))).alias(f"_e{i}")
            for i, source in enumerate(columns.values())
        ]
    )
    edges = edges.select(
        GROUP,
        BUCKET,
        *[F.last(f"_e{i}", ignorenulls=True).over(earlier).alias(f"_c{i}") for i in range(len(columns))],
    )
    filled = base.select(
        "*",
        *[
            F.last(source, ignorenulls=True).over(running).alias(f"_r{i}")
            for i, source in enumerate(columns.values())
        ],
    ).join(edges, [GROUP, BUCKET])
    kept = [c for c in df.columns if c not in columns]
    return filled.select(
        *kept, *[F.coalesce(f"_r{i}", f"_c{i}").alias(target) for i, target in enumerate(columns)]
    )


def with_group_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Aggregate beside the rows (a partition-only window): pre-aggregate, then join back.

    The join is an ordinary equi join, so a hot key is split by adaptive execution.
    """
    group = F.struct(*[F.col(k) for k in keys])
    summed = df.groupBy(group.alias(GROUP)).agg(*[expr.alias(name) for name, expr in totals.items()])
    kept = [c for c in df.columns if c not in totals]
    return df.withColumn(GROUP, group).join(summed, GROUP, "left").select(
        *[df[c] for c in kept], *[summed[name] for name in totals]
    )
