"""Column mapping as data: JSON text to typed columns, and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldMap:
    """One target column and the JSON names it may come from, in order of preference."""

    table: str
    contract: str
    source_names: tuple[str, ...]
    target: str
    data_type: str = "string"
    updatable: bool = True
    active: bool = True


def mappings_from(df: DataFrame, table: str, contract: str | None = None) -> list[FieldMap]:
    """Read the (small, hand-kept) mapping table of one target to the driver."""
    rows = df.where((F.col("table") == table) & (F.col("is_active") == "1"))
    if contract is not None:
        rows = rows.where(F.col("contract") == contract)
    return [
        FieldMap(r.table, r.contract, tuple(r.source_names), r.target, r.data_type, r.update_enabled == "1")
        for r in rows.orderBy("target").collect()
    ]


def contracts_of(fields: Iterable[FieldMap], table: str) -> list[str]:
    return sorted({f.contract for f in fields if f.table == table and f.active})


def _typed(value: Column, data_type: str) -> Column:
    # Times stay text here: their layout differs per contract and is parsed by the job.
    if data_type.lower() in ("string", "timestamp"):
        return value
    return value.try_cast(data_type)


def flatten_json(df: DataFrame, payload: str, fields: Sequence[FieldMap]) -> DataFrame:
    """Add one column per mapping: the first non-null of its JSON names, cast softly.

    Top-level names are read from one parse of the payload; dotted paths use
    ``get_json_object``.
    """
    active = [f for f in fields if f.active]
    parsed = df.withColumn("_json", F.from_json(F.col(payload), T.MapType(T.StringType(), T.StringType())))

    def read(name: str) -> Column:
        if "." in name or "[" in name:
            return F.get_json_object(F.col(payload), f"$.{name}")
        return F.try_element_at(F.col("_json"), F.lit(name))

    added = [
        F.coalesce(*[_typed(read(n), f.data_type) for n in f.source_names]).alias(f.target) for f in active
    ]
    targets = {f.target for f in active}
    return parsed.select(*[c for c in df.columns if c not in targets], *added)


def expand(df: DataFrame, column: str) -> DataFrame:
    """``select *, s.*`` for a struct column."""
    return df.select("*", f"{column}.*")


def parse_struct(df: DataFrame, payload: str, schema: T.StructType | str) -> DataFrame:
    return expand(df.withColumn(payload, F.from_json(F.col(payload), schema)), payload).drop(payload)


def align_to_schema(df: DataFrame, schema: T.StructType, fields: Sequence[FieldMap] | None = None) -> DataFrame:
    """Shape `df` for a target: null-fill what it lacks, append what the target lacks.

    With `fields`, the mapping must name exactly the resulting columns.
    """
    have = {f.name: f for f in df.schema.fields}
    known = {f.name for f in schema.fields}
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [c for c in df.columns if c not in known]
    aligned = df.select(*columns, *extra)
    if fields is not None:
        named = {f.target for f in fields if f.active}
        if named != set(aligned.columns):
            raise ValueError(
                f"mapping and frame disagree: only in frame {sorted(set(aligned.columns) - named)}, "
                f"only in mapping {sorted(named - set(aligned.columns))}"
            )
    return aligned


def new_columns(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    """Columns a target would gain from `df`."""
    known = {f.name for f in schema.fields}
    return [f for f in df.schema.fields if f.name not in known]


def update_set(fields: Sequence[FieldMap]) -> dict[str, str]:
    """Update expressions of the updatable columns, for `upsert`."""
    return {f.target: f"s.`{f.target}`" for f in fields if f.active and f.updatable}
