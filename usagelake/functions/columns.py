"""Column expressions and small frame transforms, all JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.constants import MISSING_CONSUMER, NOT_A_CONSUMER, UNKNOWN_EVENT_TIME
from usagelake.operators.dedup import row_key
from usagelake.operators.groups import as_column

# ---- keys -----------------------------------------------------------------


def norm_key(value: str | Column) -> Column:
    return F.trim(F.upper(as_column(value)))


def pad_serial(value: str | Column, width: int = 18) -> Column:
    return F.lpad(as_column(value), width, "0")


def strip_zeros(value: str | Column) -> Column:
    """Drop leading zeros of all-digit serials; leave others as they are."""
    text = as_column(value)
    return F.when(text.rlike("^[0-9]*$"), F.regexp_replace(text, "^0+", "")).otherwise(text)


def clean_text(value: str | Column) -> Column:
    """Remove blanks, written plainly or as %20."""
    return F.regexp_replace(as_column(value), "%20| ", "")


def clean_consumer(value: str | Column) -> Column:
    """Non-numeric and zero ids become the missing-consumer sentinel."""
    text = as_column(value)
    number = F.coalesce(text.try_cast("bigint"), F.lit(0))
    return F.when(number == 0, F.lit(MISSING_CONSUMER)).otherwise(text)


def valid_consumer(value: str | Column) -> Column:
    text = as_column(value)
    return text.isNotNull() & ~F.upper(text).isin(*NOT_A_CONSUMER)


def format_id10(value: str | Column) -> Column:
    """Write ten-character ids as 123-456-7890."""
    text = as_column(value)
    dashed = F.concat_ws("-", F.substring(text, 1, 3), F.substring(text, 4, 3), F.substring(text, 7, 4))
    return F.when(F.length(text) == 10, dashed).otherwise(text)


# ---- file names and paths --------------------------------------------------


def parse_file_name(df: DataFrame, name: str) -> DataFrame:
    """``TYPE_serial_message_stamp_port_cycle.ext`` into six columns (nulls when short)."""
    parts = F.split(clean_text(F.get(F.split(F.col(name), r"\."), F.lit(0))), "_")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    return df.withColumns(
        {
            "file_device_type": norm_key(part(0)),
            "file_serial": norm_key(part(1)),
            "file_message_type": F.trim(part(2)),
            "file_stamp": part(3),
            "file_port": F.coalesce(part(4), F.lit("")),
            "file_cycle_nbr": part(5),
        }
    )


def path_part(path: str | Column, index: int) -> Column:
    return F.get(F.split(as_column(path), "/"), F.lit(index))


def parse_path(df: DataFrame, path: str, device_index: int = 2) -> DataFrame:
    return df.withColumn("internal_serial", norm_key(clean_text(path_part(path, device_index))))


def code_map(value: Column, codes: Mapping[str, object]) -> Column:
    """Recode by a small literal map; unknown values become null."""
    out = None
    for key, code in codes.items():
        out = F.when(value == key, F.lit(code)) if out is None else out.when(value == key, F.lit(code))
    return out


def split_contract(df: DataFrame, contract: str = "contract") -> DataFrame:
    """Head number behind ``contract:head``, else 0."""
    head = F.when(F.col(contract).contains(":"), F.get(F.split(F.col(contract), ":"), F.lit(1)).try_cast("int"))
    return df.withColumn("head", F.coalesce(head, F.lit(0)))


# ---- text slices -----------------------------------------------------------


def tagged(text: Column, tag: str, length: int) -> Column:
    """`length` characters behind `tag`; null when the tag is absent."""
    where = F.instr(text, tag)
    return F.when(where > 0, F.substring(text, where + len(tag), F.lit(length)))


def parse_tagged_text(df: DataFrame, text: str = "text", file_name: str = "file_name") -> DataFrame:
    """Last-contact lines: tagged serials, SIM and contact time, stamp from the file name."""
    line = F.col(text)

    def field(tag: str, length: int) -> Column:
        raw = tagged(line, tag, length)
        return F.when(raw.startswith("?") | raw.startswith("UNKNOWN"), None).otherwise(raw)

    upm = tagged(line, "UPM: ", 19)
    # Weekday names cannot be parsed, so the text after them is taken: 'MMM dd HH:mm:ss Z yyyy'.
    contact = F.substring(tagged(line, "LastContact:", 28), 5, 24)
    stamp = F.substring(F.col(file_name), 1, 17)
    return df.withColumns(
        {
            "reported_at": F.try_to_timestamp(stamp, F.lit("MM-dd-yy.HH-mm-ss")),
            "internal_serial": F.upper(field("SBC:", 19)),
            "external_serial": F.when(upm.startswith("?"), None)
            .when(upm.startswith("UNKNOWN"), F.lit("UNKNOWN"))
            .otherwise(F.replace(F.upper(upm), F.lit(" "), F.lit(""))),
            "sim_card": F.when(tagged(line, "SIM:", 1) != "?", tagged(line, "SIM:", 20)),
            "last_contact": F.try_to_timestamp(contact, F.lit("MMM dd HH:mm:ss zzz yyyy")),
        }
    )


# Slices of the software version text and recodes of the start record.
VERSION_SLICES = {"os": (1, 2), "interface": (4, 2), "app": (7, 2), "cooler": (10, 2), "adapter": (13, 2), "applicator_cfg": (16, 8)}
SAME_NEXT = {"Same": "S", "Next": "N"}
RETURNING = {"NP": "N", "RP": "R", "Unknown": "U"}
BODY_PART = {"Unknown": "U", "UBA": "A1"}


def version_slices(df: DataFrame, version: str, prefix: str = "sw_") -> DataFrame:
    return df.withColumns(
        {f"{prefix}{name}": F.substring(F.col(version), at, n) for name, (at, n) in VERSION_SLICES.items()}
    )


def recode(value: Column, codes: Mapping[str, str], when_null: str | None = None, other: str | None = None) -> Column:
    """Recode known values; others pass through (or become `other`), null becomes `when_null`."""
    fallback = F.lit(other) if other is not None else value
    return F.when(value.isNull(), F.lit(when_null if when_null is not None else other)).otherwise(
        F.coalesce(code_map(value, codes), fallback)
    )


def unless_unknown(value: Column) -> Column:
    return F.when(F.upper(value) != "UNKNOWN", value)


# ---- times -----------------------------------------------------------------


def event_time(text: Column, header: Column) -> Column:
    """19-character, 14-character or header time; a fixed instant when there is none."""
    return (
        F.when(F.length(text) == 19, F.try_to_timestamp(text, F.lit("yyyy-MM-dd,HH:mm:ss")))
        .when(F.length(text) == 14, F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
        .otherwise(F.coalesce(header, F.to_timestamp(F.lit(UNKNOWN_EVENT_TIME))))
    )


def compact_time(text: Column) -> Column:
    """``yyyyMMddHHmmss.SSS`` (18 characters) or null."""
    return F.when(F.length(text) == 18, F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss.SSS")))


def join_date_time(day: Column, clock: Column, pattern: str) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", day, clock), F.lit(pattern))


def minutes_between(one: Column, other: Column) -> Column:
    """Whole minutes between two times, whichever comes first; null if either is."""
    seconds = F.abs(other.cast("timestamp").cast("double") - one.cast("timestamp").cast("double"))
    return F.floor(seconds / 60)


# Time-zone names without an offset in their text.
ZONE_OFFSETS = {"": "+00:00", "Pacific Standard Time": "-08:00", "Pacific Daylight Time": "-07:00"}


def zone_offset(text: str | Column) -> Column:
    """Offset such as ``-05:00`` from a zone text ending in ``(UTC-05:00:00)``."""
    zone = as_column(text)
    inside = F.regexp_extract(zone, r"\([A-Z]{3}([^()]*)\)$", 1)
    offset = F.regexp_replace(inside, r":00$", "")
    signed = F.when(offset.startswith("-"), offset).otherwise(F.concat(F.lit("+"), F.ltrim(offset, F.lit("+"))))
    return F.coalesce(code_map(zone, ZONE_OFFSETS), F.when(inside != "", signed))


def local_date(at: str | Column, address_zone: Column, device_offset: Column) -> Column:
    """Business date: the address's zone first, then the device's offset, else as is."""
    utc = as_column(at)
    shift = F.coalesce(address_zone, device_offset)
    return F.when(shift.isNull(), utc.cast("date")).otherwise(F.from_utc_timestamp(utc, shift).cast("date"))


# ---- filters ---------------------------------------------------------------


def effective_on(at: str | Column, start: str | Column, end: str | Column) -> Column:
    return as_column(at).between(as_column(start), as_column(end))


def recent(at: str | Column, as_of: date | datetime, days: int) -> Column:
    """Within `days` before a caller-given moment (no wall clock inside a plan)."""
    return as_column(at) >= F.lit(as_of) - F.make_dt_interval(days=F.lit(days))


# ---- frames ----------------------------------------------------------------


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def drop_pii(df: DataFrame, names: Sequence[str]) -> DataFrame:
    hidden = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in hidden])


def stamp(df: DataFrame, who: str, at: datetime, key: Sequence[str] | None = None) -> DataFrame:
    """Audit columns; the row id is a hash of the natural key, so replays agree."""
    audit = {
        "created_by": F.lit(who),
        "created_at": F.lit(at),
        "updated_by": F.lit(who),
        "updated_at": F.lit(at),
    }
    if key:
        audit["row_id"] = row_key(*key)
    return df.withColumns(audit)


def render_template(text: str | Column, values: Mapping[str, Column]) -> Column:
    """Fill ``<Name>`` placeholders; a null value leaves an empty text."""
    out = as_column(text)
    for name, value in values.items():
        out = F.replace(out, F.lit(f"<{name}>"), F.coalesce(value.cast("string"), F.lit("")))
    return out


# Characters escaped in report file names.
URL_ESCAPES = {" ": "%20", "!": "%21", "#": "%23", "$": "%24", "&": "%26", "(": "%28", ")": "%29", "*": "%2A", "+": "%2B", ",": "%2C", "/": "%2F", ":": "%3A"}


def escape_file_name(text: str | Column) -> Column:
    out = as_column(text)
    for plain, escaped in URL_ESCAPES.items():
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def unmask(df: DataFrame, value: str, flag: str, out: str, key: Column) -> DataFrame:
    """Decrypt flagged ids (AES, base64), pass the others; rows with a null flag stay with a null id."""
    raised = F.initcap(F.lower(F.col(flag)))
    opened = F.try_aes_decrypt(F.try_to_binary(F.col(value), F.lit("base64")), key).cast("string")
    return df.withColumns(
        {
            out: F.when(raised == "True", opened).when(raised.isNotNull(), F.col(value)),
            f"{out}_decrypted": F.when(raised == "True", F.lit("True")),
        }
    )
