"""Log intake: raw lines to typed rows, the file registry, audit and replay."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelake.constants import (
    ESCAPED_CONTRACTS,
    PARAMETER_END,
    PARAMETER_START,
    POWER_ON_CONTRACT,
    SIGNAL_CONTRACT,
    SIM_CONTRACT,
)
from usagelake.functions.columns import (
    code_map,
    compact_time,
    event_time,
    norm_key,
    parse_file_name,
    parse_path,
    parse_tagged_text,
    path_part,
    split_contract,
)
from usagelake.functions.jsonmap import FieldMap, flatten_json
from usagelake.operators.dedup import hashed_history, latest_by, row_key
from usagelake.operators.upsert import insert_only, scd1, set_status, update_if_newer, upsert

# Message types an intake keeps.
LOG_TYPES = ("UL", "UE", "SYS", "ENGR")


def typed_log_rows(lines: DataFrame, log_types: Sequence[str] = LOG_TYPES, device_index: int = 2) -> DataFrame:
    """Header+JSON rows with file-name columns, file id and head; other types are dropped.

    Start and end parameter records are kept whatever the file's type.
    """
    named = parse_path(parse_file_name(lines.where("contract IS NOT NULL"), "file_name"), "file_path", device_index)
    kept = F.col("file_message_type").isin(*log_types) | F.col("contract").isin(PARAMETER_START, PARAMETER_END)
    return split_contract(
        named.where(kept).withColumns(
            {"external_serial": F.col("file_serial"), "file_id": row_key("file_path", "file_size")}
        )
    )


def registry_rows(rows: DataFrame, status: str, config_id: int, run_id: str, at: datetime) -> DataFrame:
    """One registry row per file with its record count."""
    return rows.groupBy("file_id", "file_path", "file_name", "file_size").agg(
        F.max("file_mtime").alias("file_mtime"),
        F.max("file_device_type").alias("device_type"),
        F.max("external_serial").alias("external_serial"),
        F.max("internal_serial").alias("internal_serial"),
        F.max("file_message_type").alias("message_type"),
        F.count(F.lit(1)).alias("record_count"),
    ).withColumns(
        {
            "config_id": F.lit(config_id),
            "status": F.lit(status),
            "run_id": F.lit(run_id),
            "log_start": F.lit(None).cast("timestamp"),
            "log_end": F.lit(None).cast("timestamp"),
            "error_message": F.lit(None).cast("string"),
            "updated_at": F.lit(at),
        }
    )


def open_files(registry: DataFrame, batch: DataFrame) -> DataFrame:
    """Fail what an earlier run left in progress for these files, then add the batch."""
    config = [r[0] for r in batch.select("config_id").distinct().collect()]
    stale = registry.where((F.col("status") == "InProgress") & F.col("config_id").isin(config)).select("file_id").distinct()
    return set_status(registry, stale, ["file_id"], "status", "Failed", allowed_from=["InProgress"]).unionByName(batch)


def close_files(registry: DataFrame, files: DataFrame, status: str, message: str | None, at: datetime) -> DataFrame:
    """Move in-progress files to their final status, with log times where known."""
    have = files.columns
    source = files.select(
        "file_id",
        *[(F.col(c) if c in have else F.lit(None).cast("timestamp")).alias(f"_{c}") for c in ("log_start", "log_end")],
        F.lit(status).alias("_status"), F.lit(message).cast("string").alias("_message"), F.lit(at).alias("_at"),
    ).distinct()
    return upsert(
        registry, source, ["file_id"], condition="t.status = 'InProgress'", insert=False,
        update={
            "status": "s._status", "error_message": "s._message", "updated_at": "s._at",
            "log_start": "coalesce(s._log_start, t.log_start)", "log_end": "coalesce(s._log_end, t.log_end)",
        },
    )


# JSON names of the start and end parameter records.
START_FIELDS = [
    FieldMap("parameter", PARAMETER_START, (name,), target)
    for name, target in (("startts", "start_text"), ("prodtype", "product_type"), ("type", "cycle_type"), ("esn", "parameter_serial"),
                         ("version", "sw_version"), ("app", "app_version"), ("priority", "priority"), ("timezone", "time_zone"))
]
END_FIELDS = [FieldMap("parameter", PARAMETER_END, ("endts",), "end_text")]


def log_times(rows: DataFrame) -> DataFrame:
    """Earliest start and latest end per file, with the parameters of the first start record."""
    starts = flatten_json(rows.where(F.col("contract") == PARAMETER_START), "payload", START_FIELDS)
    by_header = (F.col("format_version") == 1) & (F.col("cycle_type") == "CT")
    starts = starts.withColumn(
        "log_start", F.when(by_header, F.col("header_ts")).otherwise(event_time(F.col("start_text"), F.col("header_ts")))
    )
    ends = flatten_json(rows.where(F.col("contract") == PARAMETER_END), "payload", END_FIELDS).withColumn(
        "log_end", event_time(F.col("end_text"), F.col("header_ts"))
    )
    described = ("product_type", "sw_version", "app_version", "priority", "time_zone")
    first = starts.groupBy("file_id").agg(
        F.min(F.struct("log_start", *described)).alias("s")
    ).select("file_id", "s.log_start", *[f"s.{c}" for c in described])
    last = ends.groupBy("file_id").agg(F.max("log_end").alias("log_end"))
    return first.join(last, "file_id", "left")


def device_state(rows: DataFrame, fields: Sequence[FieldMap]) -> DataFrame:
    """Newest row per device and contract, with the contract-specific clean-ups."""
    escaped = rows.withColumn(
        "payload",
        F.when(F.col("contract").isin(*ESCAPED_CONTRACTS), F.replace("payload", F.lit("\\"), F.lit("\\\\"))).otherwise(F.col("payload")),
    )
    parsed = flatten_json(escaped, "payload", fields)
    last = latest_by(
        parsed, ["external_serial", "internal_serial", "contract"],
        [F.col("header_ts").desc(), F.col("file_size").desc(), F.col("file_id").asc()],
    )
    out = last.where((F.col("contract") != SIM_CONTRACT) | F.col("sim_card").isNotNull())
    signal = F.col("contract") == SIGNAL_CONTRACT
    return out.withColumns(
        {
            "power_on": F.when(F.col("contract") == POWER_ON_CONTRACT, compact_time(F.col("power_on_text"))),
            "rsrp": F.when(signal, F.regexp_extract("signal_text", r"RSRP:([-\d.]+)", 1)),
            "rsrq": F.when(signal, F.regexp_extract("signal_text", r"RSRQ:([-\d.]+)", 1)),
        }
    )


def merge_device_state(target: DataFrame, state: DataFrame) -> DataFrame:
    return update_if_newer(target, state, ["external_serial", "internal_serial", "contract"], "header_ts")


def history_fact(target: DataFrame, rows: DataFrame, ignore: Sequence[str]) -> DataFrame:
    """Insert rows whose business content was not seen before (key: content hash)."""
    return insert_only(target, hashed_history(rows, ignore), ["hash_id"])


USER_EVENT_KEYS = ("internal_serial", "external_serial", "header_ts", "contract", "head")


def user_events(target: DataFrame, rows: DataFrame, fields: Sequence[FieldMap]) -> DataFrame:
    """Mapped user events, latest error time per natural key, insert-only."""
    parsed = flatten_json(rows, "payload", fields).drop("payload")
    fresh = latest_by(parsed, USER_EVENT_KEYS, [F.col("error_time").desc(), F.col("file_id").asc()])
    return insert_only(target, fresh.select(*target.columns), USER_EVENT_KEYS)


# Folder names of the older log kinds.
LOG_KINDS = {"Measurement": "ML", "UserException": "UE", "Exception": "EX", "Assert": "Assert"}


def log_registry(lines: DataFrame, kind_index: int = 6) -> DataFrame:
    """Registry rows of measurement, exception and assert files: kind from the path, times from the content."""
    kind = code_map(path_part("file_path", kind_index), LOG_KINDS)
    asserted = F.try_to_timestamp(F.replace("contract", F.lit("Assert occurred on "), F.lit("")), F.lit("M/d/yyyy h:m:ss a"))
    typed = lines.withColumns(
        {
            "message_type": kind,
            "internal_serial": F.upper(F.replace(F.get(F.split("file_name", "_"), F.lit(1)), F.lit(".txt"), F.lit(""))),
        }
    ).withColumn(
        "event_ts",
        F.when((F.col("message_type") == "Assert") & F.col("contract").startswith("Assert occurred on"), asserted).when(
            F.col("message_type") != "Assert", F.col("event_ts")
        ),
    )
    return (
        typed.where("message_type IS NOT NULL AND event_ts IS NOT NULL")
        .groupBy("file_path", "file_name", "file_size", "message_type", "internal_serial")
        .agg(F.min("event_ts").alias("log_start"), F.max("event_ts").alias("log_end"), F.count(F.lit(1)).alias("record_count"))
    )


def last_contacts(target: DataFrame, lines: DataFrame, equipment: DataFrame) -> DataFrame:
    """Latest contact per device; the serial comes from equipment when the text has none."""
    parsed = parse_tagged_text(lines).where("internal_serial IS NOT NULL")
    newest = latest_by(
        equipment.where("mfg_batch IS NOT NULL"), ["mfg_batch"], [F.col("ship_start").desc(), F.col("serial").asc()]
    ).select(F.col("mfg_batch").alias("internal_serial"), "serial")
    named = parsed.join(newest, "internal_serial", "left").withColumn(
        "external_serial", F.when(F.col("external_serial").like("UPM%"), F.col("external_serial")).otherwise(F.col("serial"))
    )
    fresh = latest_by(named, ["internal_serial"], [F.col("last_contact").desc(), F.col("reported_at").desc(), F.col("external_serial").asc()])
    return scd1(target, fresh.select(*target.columns), ["internal_serial"], keep=["created_at"] if "created_at" in target.columns else [])


# ---- audit and replay ------------------------------------------------------


def audit_rows(df: DataFrame, keys: Sequence[str], stage: str, status: str, message: str | None, at: datetime) -> DataFrame:
    return df.select(*keys).distinct().select(
        "*", F.lit(stage).alias("stage"), F.lit(status).alias("status"),
        F.lit(message).cast("string").alias("error_message"), F.lit(at).alias("created_at"),
    )


#: Captured rows keep their times whole; nulls are written out.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false",
}


def capture_failed(batch: DataFrame, stage: str, run_id: str, message: str, at: datetime) -> DataFrame:
    """The rows of a failed batch as JSON text, ready to be replayed."""
    return batch.select(
        F.to_json(F.struct(*batch.columns), _JSON).alias("batch_data"),
        F.lit(stage).alias("stage"), F.lit(run_id).alias("run_id"), F.lit(message).alias("error_message"),
        F.lit("Failed").alias("status"), F.lit(at).alias("created_at"),
    )


def replay_failed(captured: DataFrame, stage: str, schema: T.StructType) -> DataFrame:
    """Rebuild the rows of captured batches that still wait."""
    waiting = captured.where((F.col("stage") == stage) & (F.col("status") == "Failed"))
    return waiting.select(F.from_json("batch_data", schema, _JSON).alias("r")).select("r.*")


def normalise_serials(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: norm_key(c) for c in columns})
