"""MERGE-style upserts as pure functions: ``new_target = f(target, source)``.

Expressions are Spark SQL over the aliases ``t`` (target) and ``s`` (source).
A source whose size estimate is under the broadcast limit never shuffles the
target; a larger one is full-joined on the keys.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.session import BROADCAST_BYTES, fits


def check_unique(df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Pass rows through, failing the job on a repeated key (as MERGE does).

    Unless `null_safe`, keys with a null match nothing and may repeat; their rows are spread over all tasks.
    """
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    repeated = F.raise_error(F.concat(F.lit("more than one source row for key: "), shown))
    missing = F.lit(False)
    for key in [] if null_safe else keys:
        missing = missing | F.col(key).isNull()
    spread = F.when(missing, F.xxhash64(*df.columns)).otherwise(F.lit(0))
    same = F.count(F.lit(1)).over(Window.partitionBy(*keys, spread))
    counted = df.withColumn("_same", F.when(missing, F.lit(1)).otherwise(same))
    return counted.where(F.when(F.col("_same") > 1, repeated.cast("boolean")).otherwise(F.lit(True))).drop("_same")


def _on(keys: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        left, right = F.col(f"t.{key}"), F.col(f"s.{key}")
        condition = condition & (left.eqNullSafe(right) if null_safe else left == right)
    return condition


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Mapping[str, str] | None = None,
    condition: str | None = None,
    insert: bool = True,
    insert_values: Mapping[str, str] | None = None,
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Matched rows get `update` where `condition` holds; unmatched source rows are inserted."""
    update, insert_values = dict(update or {}), dict(insert_values or {})
    unknown = set(update) - set(target.columns)
    if unknown:
        raise ValueError(f"update of columns the target lacks: {sorted(unknown)}")
    names, have = target.columns, set(source.columns)
    tgt = target.withColumn("_in_t", F.lit(1)).alias("t")
    if insert and not update:
        return _inserted(target, source, keys, insert_values, null_safe)
    src = check_unique(source, keys, null_safe).withColumn("_in_s", F.lit(1)).alias("s")
    on = _on(keys, null_safe)
    hit = F.col("s._in_s").isNotNull()
    if condition:
        hit = hit & F.coalesce(F.expr(condition), F.lit(False))

    def kept(name: str) -> Column:
        old = F.col(f"t.{name}")
        return F.when(hit, F.expr(update[name])).otherwise(old) if name in update else old

    def new(name: str) -> Column:
        if name in insert_values:
            return F.expr(insert_values[name])
        return F.col(f"s.{name}") if name in have else F.lit(None).cast(target.schema[name].dataType)

    if fits(source, broadcast_limit):
        merged = tgt.join(F.broadcast(src), on, "left").select(*[kept(n).alias(n) for n in names])
        if not insert:
            return merged
        source_keys = source.select(*keys).distinct()
        taken = target.select(*keys).alias("t").join(F.broadcast(source_keys.alias("s")), on, "left_semi")
        fresh = src.join(taken.distinct().alias("t"), on, "left_anti")
        return merged.unionByName(fresh.select(*[new(n).alias(n) for n in names]))
    if not insert:
        return tgt.join(src, on, "left").select(*[kept(n).alias(n) for n in names])
    joined = tgt.join(src, on, "full_outer")
    return joined.select(
        *[F.when(F.col("t._in_t").isNull(), new(n)).otherwise(kept(n)).alias(n) for n in names]
    )


def _inserted(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Mapping[str, str], null_safe: bool) -> DataFrame:
    """Target and the source rows whose key it lacks; repeated source rows all come in, as in a merge."""
    fresh = source.alias("s").join(target.select(*keys).distinct().alias("t"), _on(keys, null_safe), "left_anti")
    have = set(source.columns)
    return target.unionByName(fresh.select(*[
        (F.expr(values[f.name]) if f.name in values else F.col(f"s.{f.name}") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.schema.fields
    ]))


def _others(target: DataFrame, source: DataFrame, keys: Sequence[str], skip: Sequence[str] = ()) -> list[str]:
    return [c for c in target.columns if c in source.columns and c not in keys and c not in skip]


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    return upsert(target, source, keys, **options)


def update_if_newer(target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: str, **options) -> DataFrame:
    changes = {c: f"s.`{c}`" for c in _others(target, source, keys)}
    return upsert(target, source, keys, update=changes, condition=f"s.`{stamp}` > t.`{stamp}`", **options)


def scd1(
    target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), **options
) -> DataFrame:
    """Update every shared column except `keep` (such as created-at), insert the rest."""
    return upsert(target, source, keys, update={c: f"s.`{c}`" for c in _others(target, source, keys, keep)}, **options)


def update_if_changed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    also: Sequence[str] = (),
    **options,
) -> DataFrame:
    differs = " OR ".join(f"NOT (t.`{c}` <=> s.`{c}`)" for c in tracked)
    changes = {c: f"s.`{c}`" for c in [*tracked, *also]}
    return upsert(target, source, keys, update=changes, condition=differs, **options)


def keep_nulls_out(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    condition: str | None = None,
    **options,
) -> DataFrame:
    """Take the source value where it has one, else keep the target's; no inserts."""
    changes = {c: f"coalesce(s.`{c}`, t.`{c}`)" for c in columns}
    return upsert(target, source, keys, update=changes, condition=condition, insert=False, **options)


def _quoted(text: str) -> str:
    """A SQL text literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def accumulate(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    add: Sequence[str] = (),
    merge_sets: Sequence[str] = (),
    separator: str = ", ",
    update: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """Add counters and unite delimited id sets of matched rows; a missing counter adds nothing.

    Where both counters are missing the sum stays missing.
    """
    changes = {c: f"CASE WHEN t.`{c}` IS NULL THEN s.`{c}` ELSE t.`{c}` + coalesce(s.`{c}`, 0) END" for c in add}
    apart, pattern = _quoted(separator), _quoted(re.escape(separator))
    for c in merge_sets:
        both = f"filter(split(concat_ws({apart}, t.`{c}`, s.`{c}`), {pattern}), x -> x <> '')"
        changes[c] = f"nullif(concat_ws({apart}, array_sort(array_distinct({both}))), '')"
    return upsert(target, source, keys, update={**changes, **dict(update or {})}, **options)


def fill_if_null(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Mapping[str, str], **options
) -> DataFrame:
    """``columns={"invoice_no": "found_no"}``: write only where the target is null."""
    changes = {c: f"coalesce(t.`{c}`, s.`{new}`)" for c, new in columns.items()}
    return upsert(target, source, keys, update=changes, insert=False, **options)


def set_status(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    column: str,
    value: str,
    allowed_from: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Status transition of the rows named by `source`, optionally only from given states."""
    condition = None
    if allowed_from is not None:
        states = ", ".join(_quoted(s) for s in allowed_from)
        condition = f"t.`{column}` IN ({states})"
    picked = source.select(*keys).distinct()
    return upsert(target, picked, keys, update={column: _quoted(value)}, condition=condition, insert=False, **options)


def version_bump(
    target: DataFrame,
    replacements: DataFrame,
    key: str,
    *,
    replaces: str,
    version: str = "version",
    update: Mapping[str, str] | None = None,
) -> DataFrame:
    """Supersede rows named by `replaces` (their version grows by one) and add the new ones as version 1.

    `replacements` carries the full new row (with its own `key`) plus `replaces`.
    """
    superseded = replacements.select(
        F.col(replaces).alias(key),
        *[F.col(c).alias(f"_new_{c}") for c in dict(update or {})],
    )
    bumped = upsert(
        target, superseded, [key],
        update={version: f"t.`{version}` + 1", **{c: f"s.`_new_{c}`" for c in dict(update or {})}},
        insert=False,
    )
    fresh = replacements.withColumn(version, F.lit(1).cast(target.schema[version].dataType))
    return bumped.unionByName(_shape(fresh, target))


def _shape(df: DataFrame, like: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def insert_uncovered(
    target: DataFrame,
    source: DataFrame,
    *,
    covered: DataFrame,
    row_key: Sequence[str],
) -> DataFrame:
    """Insert the source rows that are not among `covered` (those inside an existing interval)."""
    fresh = source.join(covered.select(*row_key).distinct(), list(row_key), "left_anti")
    return target.unionByName(_shape(fresh, target))


def match_all(target: DataFrame, source: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Update and insert over every shared column."""
    return scd1(target, source, keys, **options)
