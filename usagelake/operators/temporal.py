"""Joins in time: as-of, point-in-time, containment, SCD2 and gaps.

`match_running` is the base of all one-best-match joins. Both sides are put on
one time line per key and the best right row so far is carried along with a
running maximum, so work is linear in the rows: no pair of a fact and a
candidate is ever formed. Long keys are cut into time buckets (see `groups`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelake.constants import OPEN_END
from usagelake.operators.dedup import latest_by
from usagelake.operators.groups import (
    BUCKET,
    GROUP,
    as_column,
    bucket_of,
    number_in_group,
    with_neighbours,
)
from usagelake.session import BROADCAST_BYTES, fits, plan_bytes, settle, small

Keys = Mapping[str, str] | Sequence[str]
DEFAULT_BUCKET = "30 days"
_NULL_SPREAD = 1024


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def match_running(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    *,
    at: str,
    since: str,
    best: Sequence[str | Column],
    take: Mapping[str, str | Column],
    backward: bool = True,
    inclusive: bool = True,
    bucket: str | int = DEFAULT_BUCKET,
    skeleton: DataFrame | None = None,
) -> DataFrame:
    """Left rows plus the `take` columns of one right row each (nulls where none).

    backward: among right rows with ``since <= at`` the greatest `best`;
    otherwise among those with ``since >= at`` the least. `inclusive=False`
    excludes equality. Rows with a null key or time match nothing. `skeleton`
    is a cheaper frame with the keys and times of `left`, for the edge pass.
    """
    hits = _running_hits(left, right, on, at, since, best, take, [F.lit(True)], backward, inclusive, bucket, skeleton)
    return hits.select(*left.columns, *[F.col("_hit0")[target].alias(target) for target in take])


def _running_hits(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    at: str,
    since: str,
    best: Sequence[str | Column],
    take: Mapping[str, str | Column],
    lanes: Sequence[Column],
    backward: bool,
    inclusive: bool,
    bucket: str | int,
    skeleton: DataFrame | None = None,
) -> DataFrame:
    """Left rows with one struct column ``_hit{i}`` per lane (a condition on right rows)."""
    pairs = _pairs(on)
    candidate = F.struct(
        *[as_column(b).alias(f"b{i}") for i, b in enumerate(best)],
        *[as_column(source).alias(target) for target, source in take.items()],
    )
    # On the time line a right row of the same instant comes first only if equality counts.
    left_side, right_side = (1, 0) if inclusive else (0, 1)
    keys = [f"{GROUP}{i}" for i in range(len(pairs))]
    rhs = right.where(
        " AND ".join(f"`{k}` IS NOT NULL" for k in [*(r for _, r in pairs), since])
    ).select(
        *[F.col(k).alias(name) for name, (_, k) in zip(keys, pairs)],
        F.col(since).alias("_t"),
        F.lit(right_side).alias("_side"),
        *[F.when(lane, candidate).alias(f"_best{i}") for i, lane in enumerate(lanes)],
    )
    n = range(len(lanes))
    pick = F.max if backward else F.min
    alike = all(left.schema[l].dataType == rhs.schema[name].dataType for name, (l, _) in [*zip(keys, pairs), ("_t", (at, ""))])
    steps = _few_steps(rhs, keys, len(lanes), backward) if alike else None
    if steps is not None:
        return _step_hits(left, steps, pairs, keys, at, len(lanes), backward, inclusive)
    line, same = _time_line(left, rhs, pairs, keys, at, left_side)
    places = (left if skeleton is None else skeleton).select(*[F.col(k).alias(name) for name, (k, _) in zip(keys, pairs)], F.col(at).alias("_t"))
    hot = _hot_keys(places.unionByName(rhs.select(*keys, "_t")).where("_t IS NOT NULL"), keys)
    by_time = [F.col("_t").asc() if backward else F.col("_t").desc(), F.col("_side")]
    sofar = Window.unboundedPreceding, Window.currentRow
    if hot is None:
        in_key = Window.partitionBy(*keys, "_spread").orderBy(*by_time).rowsBetween(*sofar)
        matched = line.withColumns({f"_run{i}": pick(f"_best{i}").over(in_key) for i in n}).where("_isleft")
        hits = [F.when(F.col("_spread").isNull(), F.col(f"_run{i}")) for i in n]
        return matched.select(*_restored(left, same), *[hit.alias(f"_hit{i}") for i, hit in enumerate(hits)])
    slot = bucket_of(F.col("_t"), line.schema["_t"].dataType, bucket)
    # Edges: the best right row of each bucket, and a mark for each bucket of left rows, which takes the best one of the
    # buckets before. This pass reads keys and times of the left rows only, and rows of long keys alone.
    bones = places.unionByName(rhs.select(*keys, "_t").limit(0)).where("_t IS NOT NULL").join(hot, keys, "left_semi")
    marks = bones.select(*keys, slot.alias(BUCKET)).distinct().withColumn("_mark", F.lit(0))
    bests = (
        places.limit(0).unionByName(rhs.drop("_side"), allowMissingColumns=True).join(hot, keys, "left_semi")
        .groupBy(*keys, slot.alias(BUCKET))
        .agg(*[pick(f"_best{i}").alias(f"_edge{i}") for i in n])
        .withColumn("_mark", F.lit(1))
    )
    by_bucket = (
        Window.partitionBy(*keys)
        .orderBy(F.col(BUCKET).asc() if backward else F.col(BUCKET).desc(), "_mark")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = (
        marks.unionByName(bests, allowMissingColumns=True)
        .select(*keys, BUCKET, "_mark", *[pick(f"_edge{i}").over(by_bucket).alias(f"_carry{i}") for i in n])
        .where("_mark = 0 AND (" + " OR ".join(f"_carry{i} IS NOT NULL" for i in n) + ")")
        .drop("_mark")
    )
    line = line.join(hot.withColumn("_hot", F.lit(True)), keys, "left")
    line = line.withColumn(BUCKET, F.coalesce("_spread", F.when(F.col("_hot"), slot), F.lit(0))).drop("_hot")
    in_bucket = Window.partitionBy(*keys, BUCKET).orderBy(*by_time).rowsBetween(*sofar)
    matched = (
        line.withColumns({f"_run{i}": pick(f"_best{i}").over(in_bucket) for i in n})
        .where("_isleft")
        .join(edges, [*keys, BUCKET], "left")
        .withColumn("_keyless", F.col("_spread").isNotNull())
    )
    return matched.select(
        *_restored(left, same),
        *[
            F.when(~F.col("_keyless"), _better(F.col(f"_run{i}"), F.col(f"_carry{i}"), backward)).alias(f"_hit{i}")
            for i in n
        ],
    )


def _time_line(left: DataFrame, rhs: DataFrame, pairs: Sequence[tuple[str, str]], keys: Sequence[str], at: str, side: int,
               ) -> tuple[DataFrame, dict[str, str]]:
    """Both sides on one time line (`_t`, `_side`), and which left columns the line holds as its keys or time already."""
    lost = reduce(or_, [F.col(c).isNull() for c in (*[k for k, _ in pairs], at)])
    same = {l: name for name, (l, _) in [*zip(keys, pairs), ("_t", (at, ""))] if left.schema[l].dataType == rhs.schema[name].dataType}
    lhs = left.select(
        *[F.col(f"`{c}`") for c in left.columns if c not in same],
        *[F.col(k).alias(name) for name, (k, _) in zip(keys, pairs)],
        F.col(at).alias("_t"),
        F.lit(side).alias("_side"),
        F.lit(True).alias("_isleft"),
        # Rows that can match nothing are spread out instead of gathering under one null key.
        F.when(lost, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(_NULL_SPREAD))).alias("_spread"),
    )
    return lhs.unionByName(rhs.withColumn("_isleft", F.lit(False)), allowMissingColumns=True), same


def _restored(left: DataFrame, same: Mapping[str, str]) -> list[Column]:
    return [F.col(same[c]).alias(c) if c in same else F.col(f"`{c}`") for c in left.columns]


#: Rows of a key, both sides together, up to which it is worked on as one bucket.
HOT_ROWS = 4096


def _hot_keys(places: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys of more than `HOT_ROWS` rows, stored, or None (as usual): only their rows need buckets and edges."""
    known = places.where(" AND ".join(f"{c} IS NOT NULL" for c in keys))
    hot = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(*keys)
    return None if hot.isEmpty() else small(settle(hot))


#: Changes of a key's best right row up to which a left row may look through them in memory.
FEW_STEPS = 64


def _few_steps(rhs: DataFrame, keys: Sequence[str], lanes: int, backward: bool) -> DataFrame | None:
    """The best right row from each instant of a key to its next one, if all this is small enough for every task; else None.

    Then left rows stay where they are. Each instant has one row, so a left row meets one step at most.
    """
    if plan_bytes(rhs) > BROADCAST_BYTES:
        return None
    pick = F.max if backward else F.min
    instants = rhs.groupBy(*keys, "_t").agg(*[pick(f"_best{i}").alias(f"_best{i}") for i in range(lanes)])
    line = Window.partitionBy(*keys).orderBy(F.col("_t").asc() if backward else F.col("_t").desc())
    steps = instants.select(*keys, "_t", F.lead("_t").over(line).alias("_next"), F.row_number().over(line).alias("_nth"),
                            *[pick(f"_best{i}").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_hit{i}") for i in range(lanes)])
    most = steps.agg(F.max("_nth")).first()[0] or 0
    steps = steps.drop("_nth")
    return F.broadcast(steps) if most <= FEW_STEPS and fits(steps) else None


def _step_hits(left: DataFrame, steps: DataFrame, pairs: Sequence[tuple[str, str]], keys: Sequence[str], at: str, lanes: int,
               backward: bool, inclusive: bool) -> DataFrame:
    time, begin, end = F.col(f"`{at}`"), F.col("_t"), F.col("_next")
    if backward:
        held = (time >= begin) & (end.isNull() | (time < end)) if inclusive else (time > begin) & (end.isNull() | (time <= end))
    else:
        held = (time <= begin) & (end.isNull() | (time > end)) if inclusive else (time < begin) & (end.isNull() | (time >= end))
    same = [F.col(f"`{l}`") == F.col(name) for name, (l, _) in zip(keys, pairs)]
    return left.join(steps, reduce(and_, same, held), "left").select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_hit{i}") for i in range(lanes)])


def _better(one: Column, other: Column, greatest: bool) -> Column:
    wins = one >= other if greatest else one <= other
    return F.when(one.isNull(), other).when(other.isNull(), one).when(wins, one).otherwise(other)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    *,
    at: str,
    time: str,
    take: Mapping[str, str | Column],
    direction: str = "previous",
    inclusive: bool = True,
    tie: Sequence[str | Column] = (),
    bucket: str | int = DEFAULT_BUCKET,
    skeleton: DataFrame | None = None,
) -> DataFrame:
    """Nearest right row before ('previous') or after ('next') each left row."""
    if direction not in ("previous", "next"):
        raise ValueError(direction)
    return match_running(
        left, right, on, at=at, since=time, best=[time, *tie], take=take,
        backward=direction == "previous", inclusive=inclusive, bucket=bucket, skeleton=skeleton,
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    *,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str | Column],
    closed: str = "left",
    tie: Sequence[str | Column] = (),
    prefer: Sequence[Column] | None = None,
    bucket: str | int = DEFAULT_BUCKET,
    skeleton: DataFrame | None = None,
) -> DataFrame:
    """Point-in-time lookup: the interval holding `at`, latest end (then `tie`, then start) first.

    Exact for overlapping intervals too: of all intervals begun by `at`, the one
    ending last is the winner if it is still open, and none is open otherwise.
    `prefer` lists disjoint conditions on right rows; a hit of an earlier one wins.
    """
    if closed not in ("left", "both"):
        raise ValueError(closed)
    lanes = list(prefer) if prefer else [F.lit(True)]
    hits = _running_hits(
        left, right, on, at, start, [end, *tie, start], {**take, "_until": end}, lanes, True, True, bucket, skeleton
    )
    open_hits = []
    for i in range(len(lanes)):
        until = F.col(f"_hit{i}")["_until"]
        open_hits.append(F.when(F.col(at) < until if closed == "left" else F.col(at) <= until, F.col(f"_hit{i}")))
    return hits.withColumn("_hit", F.coalesce(*open_hits)).select(
        *left.columns, *[F.col("_hit")[target].alias(target) for target in take]
    )


#: Intervals under one entry of the search index.
SPAN = 64


def _last(values: str, above: Column, before: Column, strict: bool) -> Column:
    """Greatest place before `before` whose value lies above, or null."""
    return F.array_max(F.transform(values, lambda v, i: F.when(((v > above) if strict else (v >= above)) & (i < before), i)))


def containing_join(
    inner: DataFrame,
    outer: DataFrame,
    on: Keys,
    *,
    inner_start: str,
    inner_end: str,
    start: str,
    end: str,
    take: Mapping[str, str | Column],
    bucket: str,
    strict: bool = True,
) -> DataFrame:
    """The outer interval around each whole inner one, latest outer start first, then least end and `take`.

    A dominance search: the outers of a key are numbered by start, so those begun in time are the first ones, and the
    last of these that ends late enough is wanted. Ends lie in blocks of `SPAN`, their maxima in blocks of the next
    level, and so on. An inner row climbs from its place until a block left of it holds a late enough end, and then
    comes down to it: one row and one short array a level, whatever the number of containers. Inner rows without a
    container, key or bounds are dropped.
    """
    pairs = _pairs(on)
    keys = [f"_k{i}" for i in range(len(pairs))]
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in [*(r for _, r in pairs), start, end])
    # Of equal intervals only the one of least `take` can win.
    bare = outer.where(f"{known} AND `{start}` <= `{end}`").groupBy(
        *[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)], F.col(start).alias("_from"), F.col(end).alias("_until"),
    ).agg(F.min(F.struct(*[as_column(source).alias(target) for target, source in take.items()])).alias("_take"))
    # Backwards from a place: latest start, then least end.
    latest_first = -F.unix_micros(F.col("_until").cast("timestamp"))
    numbered = settle(number_in_group(bare, keys, ["_from", latest_first], "_n", bucket=bucket))
    place = match_running(inner, numbered, dict(zip([l for l, _ in pairs], keys)), at=inner_start, since="_from",
                          best=["_n"], take={"_before": "_n"}, inclusive=not strict, bucket=bucket)
    levels = [settle(numbered.groupBy(*keys, ((F.col("_n") - 1) / SPAN).cast("long").alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_n", "_until", "_take"))).alias("_rows"),
    ).select(*keys, "_block", F.col("_rows._until").alias("_values"), F.col("_rows._take").alias("_takes")))]
    while levels[-1].agg(F.max("_block")).first()[0]:
        levels.append(settle(levels[-1].groupBy(*keys, (F.col("_block") / SPAN).cast("long").alias("_up")).agg(
            F.sort_array(F.collect_list(F.struct("_block", F.array_max("_values").alias("_value")))).alias("_rows"),
        ).select(*keys, F.col("_up").alias("_block"), F.col("_rows._value").alias("_values"))))

    def look(rows: DataFrame, level: int, block: Column, *columns: str) -> DataFrame:
        index = levels[level].select(*[F.col(k).alias(f"_i{k}") for k in keys], F.col("_block").alias("_i_block"), *columns)
        same = [F.col(f"`{l}`") == F.col(f"_i{k}") for (l, _), k in zip(pairs, keys)]
        return rows.join(index, reduce(and_, same, block == F.col("_i_block")), "left").drop(*[f"_i{k}" for k in keys], "_i_block")

    found = place.where(F.col("_before").isNotNull() & F.col(inner_end).isNotNull()).withColumns(
        {"_before": F.col("_before").cast("long"), "_at": F.lit(None).cast("long"), "_level": F.lit(None).cast("int")})
    for level in range(len(levels)):
        block = (F.col("_before") / SPAN).cast("long")
        found = look(found, level, block, "_values").withColumn("_hit", _last("_values", F.col(inner_end), F.col("_before") - block * SPAN, strict))
        new = F.col("_at").isNull() & F.col("_hit").isNotNull()
        found = found.withColumns({
            "_level": F.when(new, level).otherwise(F.col("_level")), "_at": F.when(new, block * SPAN + F.col("_hit")).otherwise(F.col("_at")),
            "_before": block}).drop("_values", "_hit")
    found = found.where("_at IS NOT NULL")
    for level in range(len(levels) - 2, -1, -1):
        down = F.col("_level") > level
        found = look(found, level, F.when(down, F.col("_at")), "_values")
        found = found.withColumn("_hit", _last("_values", F.col(inner_end), F.lit(SPAN), strict))
        found = found.withColumn("_at", F.when(down, F.col("_at") * SPAN + F.col("_hit")).otherwise(F.col("_at"))).drop("_values", "_hit")
    block = (F.col("_at") / SPAN).cast("long")
    taken = F.get("_takes", (F.col("_at") - block * SPAN).cast("int"))
    return look(found, 0, block, "_takes").select(*[F.col(f"`{c}`") for c in inner.columns], *[taken[c].alias(c) for c in take])


def other_owner_join(
    left: DataFrame,
    right: DataFrame,
    on: Keys,
    *,
    at: str,
    start: str,
    end: str,
    owner: Mapping[str, str] | str,
    take: Mapping[str, str | Column],
    tie: Sequence[str] = (),
    bucket: str | int = DEFAULT_BUCKET,
) -> DataFrame:
    """Left rows plus the interval that holds `at` and belongs to another owner, latest end first, then least `tie`.

    Two slots run along the intervals of a key: the best one so far, and the best one of any other owner than its. When
    the owner of the first slot changes, the former first is the best of all others, and within such a stretch the
    second slot is a running minimum. A left row takes the second slot if it owns the first. No pair is formed. Bounds
    are closed; a left row without an owner, or right rows without one, match nothing.
    """
    pairs = _pairs(on)
    mine, theirs = next(iter(owner.items())) if isinstance(owner, Mapping) else (owner, owner)
    keys = [f"_k{i}" for i in range(len(pairs))]
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in [*(r for _, r in pairs), start, end, theirs])
    # What the order holds already isn't carried twice.
    held = {end: "_until", theirs: "_owner", **{c: f"_tie{i}" for i, c in enumerate(tie)}}
    more = {target: source for target, source in take.items() if not isinstance(source, str) or source not in held}
    best = F.struct(
        (-F.unix_micros(F.col(end).cast("timestamp"))).alias("_late"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.col(theirs).alias("_owner"), F.col(end).alias("_until"), *[as_column(source).alias(f"_take_{target}") for target, source in more.items()],
    )
    rows = right.where(known).select(*[F.col(r).alias(k) for (_, r), k in zip(pairs, keys)], F.col(start).alias("_t"), best.alias("_c"))
    places = left.select(*[F.col(l).alias(k) for (l, _), k in zip(pairs, keys)], F.col(at).alias("_t"))
    hot = _hot_keys(places.unionByName(rows.select(*keys, "_t")).where("_t IS NOT NULL"), keys)

    def slots(line: DataFrame, within: Sequence[str], order: Sequence[str]) -> DataFrame:
        ordered = Window.partitionBy(*within).orderBy(*order)
        sofar = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        line = line.select("*", F.min("_c").over(sofar).alias("_one"), F.min("_c").over(ordered.rowsBetween(Window.unboundedPreceding, -1)).alias("_former"))
        turned = F.coalesce(F.col("_former._owner") != F.col("_one._owner"), F.lit(False))
        line = line.withColumns({"_turned": turned, "_stretch": F.sum(turned.cast("int")).over(sofar)})
        inside = Window.partitionBy(*within, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        other = F.least(F.when(F.col("_turned"), F.col("_former")), F.when(F.col("_c._owner") != F.col("_one._owner"), F.col("_c")))
        return line.withColumn("_two", F.min(other).over(inside))

    def picked(hits: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
        pick = F.when(F.col("_one._owner") != F.col(mine), F.col("_one")).when(F.col("_one._owner") == F.col(mine), F.col("_two"))
        hits = hits.select(*columns, pick.alias("_pick")).withColumn("_open", F.col("_pick._until") >= F.col(at))
        places = {target: f"_take_{target}" if target in more else held[source] for target, source in take.items()}
        return hits.select(*left.columns, *[F.when(F.col("_open"), F.col("_pick")[place]).alias(target) for target, place in places.items()])

    def on_line(some: DataFrame, theirs_: DataFrame) -> DataFrame:
        # Left rows stand on the line themselves: they change no slot and read those of the row before.
        line, same = _time_line(some, theirs_.withColumn("_side", F.lit(0)), pairs, keys, at, 1)
        hits = slots(line, [*keys, "_spread"], ["_t", "_side", "_c"]).where("_isleft").withColumn("_one", F.when(F.col("_spread").isNull(), F.col("_one")))
        restored = dict(zip(left.columns, _restored(left, same)))
        return picked(hits.select(*restored.values(), "_one", "_two"), left.columns)

    if hot is None:
        return on_line(left, rows)
    # Left rows of long keys are dealt by bucket; the slots are stored, as that reads them twice.
    mark = [F.col(f"`{l}`") == F.col(k) for (l, _), k in zip(pairs, keys)]
    long = left.join(hot, reduce(and_, mark), "left_semi")
    held_long = rows.join(hot, keys, "left_semi").withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy("_t", "_c")))
    stored = settle(slots(held_long, keys, ["_t", "_c"]).select(*keys, F.col("_t").alias("_from"), "_nth", "_one", "_two"))
    hits = match_running(long, stored, dict(zip([l for l, _ in pairs], keys)), at=at, since="_from", best=["_from", "_nth"],
                         take={"_one": "_one", "_two": "_two"}, bucket=bucket)
    others = on_line(left.join(hot, reduce(and_, mark), "left_anti"), rows.join(hot, keys, "left_anti"))
    return others.unionByName(picked(hits, [*left.columns]))


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Keys,
    *,
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str | Column],
    bucket: str,
    origin: str,
    horizon: str,
    closed: str = "left",
    how: str = "inner",
    extra: Column | None = None,
) -> DataFrame:
    """All intervals holding each point, as an equi join on (keys, time bucket).

    Intervals are spread over the buckets they touch. Times are clamped to
    [origin, horizon] only for choosing buckets, which bounds the copies of an
    open-ended interval; the exact range test follows, so nothing is lost.
    """
    pairs = _pairs(on)
    low, high = F.to_timestamp(F.lit(origin)), F.to_timestamp(F.lit(horizon))

    def slot(value: Column) -> Column:
        clamped = F.least(F.greatest(value.cast("timestamp"), low), high)
        return F.when(value.isNotNull(), bucket_of(clamped, T.TimestampType(), bucket))

    spread = (
        intervals.where(F.col(start) <= F.col(end))
        .select(
            *[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(pairs)],
            F.col(start).alias("_from"),
            F.col(end).alias("_until"),
            *[as_column(source).alias(target) for target, source in take.items()],
        )
        .withColumn("_slot", F.explode(F.sequence(slot(F.col("_from")), slot(F.col("_until")))))
    )
    probe = points.withColumn("_at_slot", slot(F.col(at)))
    upper = F.col(at) < F.col("_until") if closed == "left" else F.col(at) <= F.col("_until")
    condition = (F.col("_at_slot") == F.col("_slot")) & (F.col("_from") <= F.col(at)) & upper
    for i, (l, _) in enumerate(pairs):
        condition = condition & (probe[l] == F.col(f"_k{i}"))
    if extra is not None:
        condition = condition & extra
    return probe.join(spread, condition, how).select(*[probe[c] for c in points.columns], *take)


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per fact after a join that may fan out."""
    return latest_by(df, keys, order)


def pair_nth(
    starts: DataFrame,
    ends: DataFrame,
    keys: Sequence[str],
    *,
    start_order: Sequence[str],
    end_order: Sequence[str],
    take: Mapping[str, str],
    bucket: str | int = DEFAULT_BUCKET,
    number: str = "pair_no",
) -> DataFrame:
    """Pair the nth start of a group with its nth end (open starts keep nulls)."""
    left = number_in_group(starts, keys, start_order, number, bucket=bucket)
    right = number_in_group(ends, keys, end_order, number, bucket=bucket).select(
        *keys, number, *[F.col(source).alias(target) for target, source in take.items()]
    )
    return left.join(right, [*keys, number], "left")


def scd2_from_changes(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    *,
    start: str,
    end: str = "valid_to",
    bucket: str | int = "365 days",
    open_end: str = OPEN_END,
    with_load_order: bool = False,
) -> DataFrame:
    """Close each change row at the start of the next one; the newest stays open.

    `order` runs from oldest to newest, its first column a date, timestamp or number.
    """
    closed = with_neighbours(
        df, [key], order, following={"_next_start": start}, bucket=bucket,
        # Load order numbers count back from the newest change (1 = newest).
        number_from_end="load_order" if with_load_order else None,
    )
    bound = F.coalesce(F.col("_next_start"), F.lit(open_end).cast(df.schema[start].dataType))
    return closed.withColumn(end, bound).drop("_next_start")


def previous_end(
    subs: DataFrame,
    keys: Sequence[str],
    *,
    start: str,
    end: str,
    gap_days: int,
    tie: Sequence[str] = (),
    name: str = "previous_end",
    bucket: str | int = "365 days",
) -> DataFrame:
    """End of the prior interval of the group, else start minus `gap_days`."""
    lagged = with_neighbours(subs, keys, [end, *tie], previous={"_prior": end}, bucket=bucket)
    return lagged.withColumn(
        name, F.coalesce(F.col("_prior"), F.date_sub(F.col(start), gap_days).cast(subs.schema[end].dataType))
    ).drop("_prior")


def missing_numbers(
    df: DataFrame, keys: Sequence[str], number: str, name: str = "missing_no", bucket: int = 1_000_000
) -> DataFrame:
    """Numbers skipped inside each group's run of whole numbers."""
    seen = df.select(*keys, number).where(F.col(number).isNotNull()).distinct()
    gaps = with_neighbours(seen, keys, [number], previous={"_prior": number}, bucket=bucket)
    return gaps.where(F.col(number) - F.col("_prior") > 1).select(
        *keys, F.explode(F.sequence(F.col("_prior") + 1, F.col(number) - 1)).alias(name)
    )
