"""Cycle facts from device logs: the newer generations and the flat older one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake import constants as K
from usagelake.functions.columns import join_date_time, pad_serial, recode, unless_unknown, version_slices
from usagelake.functions.columns import BODY_PART, RETURNING, SAME_NEXT
from usagelake.functions.jsonmap import FieldMap, flatten_json
from usagelake.operators.dedup import assign_sequence, latest_by
from usagelake.operators.groups import fill_forward, number_in_group, with_neighbours
from usagelake.operators.temporal import interval_join
from usagelake.operators.upsert import insert_only, scd1
from usagelake.session import settle

Cut = Callable[[DataFrame], DataFrame]

@dataclass(frozen=True)
class Generation:
    """What differs between device generations."""

    name: str
    starts: tuple[str, ...]
    ends: tuple[str, ...]
    closed: str = "left"
    pad_device: bool = False
    with_card: bool = True


GEN3 = Generation("gen3", K.GEN3_START, K.GEN3_END)
CT = Generation("ct", K.CT_START, K.CT_END, closed="both", pad_device=True)
RS = Generation("rs", K.RS_START, K.RS_END, with_card=False)

CYCLE_KEYS = ("external_serial", "internal_serial", "card", "cycle_nbr", "start_ts")
RS_CYCLE_KEYS = ("external_serial", "internal_serial", "start_ts")


def pair_records(rows: DataFrame, generation: Generation, start_fields: Sequence[FieldMap], end_fields: Sequence[FieldMap]) -> DataFrame:
    """Start records with the end record of the same file (the last one, should there be several)."""
    starts = flatten_json(rows.where(F.col("contract").isin(*generation.starts)), "payload", start_fields).drop("payload")
    ends = flatten_json(rows.where(F.col("contract").isin(*generation.ends)), "payload", end_fields)
    taken = [f.target for f in end_fields]
    last = ends.groupBy("file_path", "file_id").agg(
        F.max_by(F.struct(*taken), F.struct("header_ts", "head", "payload")).alias("_end")
    )
    return starts.join(last, ["file_path", "file_id"], "left").select(
        *starts.columns, *[F.col("_end")[c].alias(c) for c in taken]
    )


def with_owners(cycles: DataFrame, equipment: DataFrame, generation: Generation, bucket: str = "365 days") -> DataFrame:
    """Device (and card) shipment in force on the cycle date; a fixed account where there is none."""
    shipped = equipment.where("transit_status = 'SHIPPED'")
    serial = pad_serial("external_serial") if generation.pad_device else F.upper("external_serial")
    out = interval_join(
        cycles.withColumn("_device", serial), shipped.withColumn("_serial", F.upper("serial")), {"_device": "_serial"},
        at="cycle_date", start="ship_start", end="ship_end", closed=generation.closed, bucket=bucket,
        take={"_owner": "serial", "_sold": "sold_to", "_ship": "ship_to"},
    )
    added: dict[str, Column] = {
        "device_shipped": F.when(F.col("_owner").isNull(), 0).otherwise(1),
        "sold_to": F.coalesce("_sold", F.lit(K.MISSING_ACCOUNT)),
        "ship_to": F.coalesce("_ship", F.lit(K.MISSING_ACCOUNT)),
    }
    if generation.with_card:
        out = interval_join(
            out, shipped, {"card": "serial"}, skeleton=cycles, at="cycle_date", start="ship_start", end="ship_end",
            closed=generation.closed, bucket=bucket,
            take={"_card": "serial", "card_material": "material", "card_ship_date": "ship_start"},
        )
        added["card_shipped"] = F.when(F.col("_card").isNull(), 0).otherwise(1)
    return out.withColumns(added).drop("_device", "_owner", "_sold", "_ship", "_card")


def treatment_files(registry: DataFrame, suffix: str = ".stx") -> DataFrame:
    """Newest registry row of each treatment measurement file, by name without suffix."""
    last = latest_by(registry.where("message_type = 'MLT'"), ["file_name"], [F.col("updated_at").desc(), F.col("file_id").asc()])
    return last.select(F.replace("file_name", F.lit(suffix), F.lit("")).alias("treatment_file"), F.col("file_path").alias("treatment_path"))


def build_cycles(
    rows: DataFrame,
    generation: Generation,
    start_fields: Sequence[FieldMap],
    end_fields: Sequence[FieldMap],
    *,
    times: DataFrame,
    equipment: DataFrame,
    registry: DataFrame | None = None,
    first_id: int = 0,
    cut: Cut = settle,
) -> DataFrame:
    """Cycle rows of one batch: paired, timed, owned, deduplicated and numbered.

    `cut` stores the two frames that later passes read more than once.
    """
    paired = cut(
        pair_records(rows, generation, start_fields, end_fields).withColumnsRenamed(
            {"header_ts": "start_ts", "header_date": "cycle_date"}
        )
    )
    owned = with_owners(paired, equipment, generation)
    timed = owned.join(
        times.select("file_id", F.col("log_start").alias("event_start"), F.col("log_end").alias("event_end")), "file_id", "left"
    )
    if registry is not None and "treatment_file" in timed.columns:
        timed = timed.join(treatment_files(registry), "treatment_file", "left")
    keys = ["external_serial", "internal_serial", "head", "start_ts"]
    if generation.with_card:
        keys += ["card", "cycle_nbr"]
    unique = cut(latest_by(timed, keys, [F.col("event_end").desc(), F.col("file_id").asc()]))
    return assign_sequence(unique, ["start_ts", *[k for k in keys if k != "start_ts"], "file_id"], "cycle_id", bucket="1 minute", start=first_id)


def merge_cycles(target: DataFrame, cycles: DataFrame, generation: Generation) -> DataFrame:
    """Insert cycles whose keys the target lacks; heads of one record are rows of their own."""
    keys = CYCLE_KEYS if generation.with_card else RS_CYCLE_KEYS
    one = latest_by(cycles, [*keys, "head"], [F.col("event_end").desc(), F.col("cycle_id").asc()])
    return insert_only(target, one.select(*target.columns), keys)


def ct_times(cycles: DataFrame) -> DataFrame:
    """CT records carry date and clock apart."""
    return cycles.withColumns(
        {
            "cycle_end": join_date_time(F.col("end_date"), F.col("end_clock"), "yyyy-MM-dd HH:mm:ss"),
            "interrupt_start": join_date_time(F.col("start_date"), F.col("start_clock"), "yyyy-MM-dd HH:mm:ss"),
        }
    )


def cartridges(rows: DataFrame, start_fields: Sequence[FieldMap], end_fields: Sequence[FieldMap], cycles: DataFrame) -> DataFrame:
    """Cartridge start and end of the same file and serial, linked to the file's cycle."""
    starts = flatten_json(rows.where(F.col("contract").isin(*K.RS_CARTRIDGE_START)), "payload", start_fields)
    ends = flatten_json(rows.where(F.col("contract").isin(*K.RS_CARTRIDGE_END)), "payload", end_fields)
    taken = [f.target for f in end_fields if f.target != "cartridge_serial"]
    last = ends.groupBy("file_path", "file_id", "cartridge_serial").agg(
        F.max_by(F.struct(*taken, F.col("header_ts").alias("event_end")), F.struct("header_ts", "payload")).alias("_end")
    )
    linked = cycles.groupBy("file_id").agg(F.min("cycle_id").alias("cycle_id"))
    joined = starts.join(last, ["file_path", "file_id", "cartridge_serial"], "left").join(linked, "file_id", "left")
    out = joined.select(
        "file_id", "file_path", "cycle_id", F.upper("cartridge_serial").alias("cartridge_serial"), "header_ts",
        *[f.target for f in start_fields if f.target != "cartridge_serial"],
        *[F.col("_end")[c].alias(c) for c in [*taken, "event_end"]],
    )
    return latest_by(out, ["cartridge_serial", "dose_count"], [F.col("header_ts").desc(), F.col("file_id").asc()])


def merge_cartridges(target: DataFrame, rows: DataFrame) -> DataFrame:
    return scd1(target, rows, ["cartridge_serial", "dose_count"])


# ---- the flat older generation ---------------------------------------------

_GROUP = ["file_name", "cycle_count", "card"]


def decode_start(df: DataFrame) -> DataFrame:
    """Readable columns of a gen-1 start row."""
    sliced = version_slices(df, "column4")
    return sliced.withColumns(
        {
            "same_next": recode(F.col("column8"), SAME_NEXT, when_null="U", other="U"),
            "returning": recode(F.col("column9"), RETURNING),
            "patient_type": recode(F.col("column10"), {"Unknown": "U"}, when_null="U"),
            "body_part": recode(F.col("column11"), BODY_PART, when_null="U"),
            "consumer_id": recode(F.col("column23"), {"Unknown": "U"}, when_null="U"),
            "upper_module": F.when(F.col("column22").startswith("UPM"), F.col("column22")),
            "applicator_serial": F.when(F.lower(F.substring("column24", 1, 1)) == "v", F.col("column24")),
            "treatment_plan": unless_unknown(F.col("column21")),
        }
    )


def reconstruct_gen1(rows: DataFrame, bucket: str = "1 day", cut: Cut = settle) -> DataFrame:
    """One cycle per (file, countdown, card) from flat start and end rows.

    rows: contract (~MA start of log, ~MB cycle start, ~ME cycle end, ~MM end of log), event_date,
    event_time, cycle_count, card, column4..column26, file_name, line_no. A cycle with several
    starts was interrupted: it runs from its first start to its last end.
    """
    stamped = rows.withColumn("event_ts", F.try_to_timestamp(F.concat_ws(" ", "event_date", "event_time"), F.lit("M/d/yyyy HH:mm:ss")))
    marks = stamped.groupBy("file_name").agg(
        F.min(F.when(F.col("contract") == "~MA", F.col("event_ts"))).alias("_first_mark"),
        F.max(F.when(F.col("contract") == "~MM", F.col("event_ts"))).alias("_last_mark"),
    )
    body = stamped.where(F.col("contract").isin("~MB", "~ME")).withColumn(
        "cycle_count", F.coalesce("cycle_count", "column5").try_cast("int")
    )
    filled = cut(
        fill_forward(
            body.withColumnRenamed("card", "_card"), ["file_name"], ["cycle_count", "event_ts", "line_no"], {"card": "_card"}, bucket=1000
        )
    )
    starts = decode_start(filled.where("contract = '~MB'"))
    shown = ["same_next", "returning", "patient_type", "body_part", "consumer_id", "upper_module", "applicator_serial",
             "treatment_plan", "sw_os", "sw_applicator_cfg"]
    at = F.struct("event_ts", "line_no")
    group = F.struct(*_GROUP)
    opened = starts.groupBy(group.alias("g")).agg(
        F.count(F.lit(1)).alias("n_starts"),
        F.min("event_ts").alias("first_start"),
        F.max("event_ts").alias("last_start"),
        F.max_by(F.struct(*shown), at).alias("about"),
        F.max_by("column25", at).alias("_last_contour"),
        F.min_by("column25", at).alias("_first_contour"),
    )
    ends = filled.where("contract = '~ME'").select(
        group.alias("g"), F.col("event_ts").alias("end_ts"), F.col("column4").alias("status"), F.col("column6").alias("error"), "line_no"
    )
    # Ends count up to the last successful one; of those the first, the last and the successful ones matter.
    limits = ends.groupBy("g").agg(F.max(F.when(F.col("status") == "Successful", F.col("end_ts"))).alias("_done"))
    valid = ends.join(limits, "g").where("_done IS NULL OR end_ts <= _done")
    position = F.struct("end_ts", "line_no")
    edges = valid.groupBy("g").agg(F.min(position).alias("_lo"), F.max(position).alias("_hi"))
    kept = valid.join(edges, "g").where((position == F.col("_lo")) | (position == F.col("_hi")) | (F.col("status") == "Successful"))
    kept = number_in_group(cut(kept.drop("_lo", "_hi", "_done")), ["g"], ["end_ts", "line_no"], "nth", bucket=bucket)
    counted = kept.groupBy("g").agg(F.count(F.lit(1)).alias("n_ends"))
    # The nth latest start belongs to the nth latest end; a start without one takes the earliest end.
    ranked = kept.join(counted, "g").join(opened.select("g", "n_starts"), "g").withColumns(
        {
            "_is_final": F.col("nth") == F.col("n_ends"),
            "_is_first": F.col("nth") == 1,
            "_is_paired": F.col("nth") == F.col("n_ends") - F.least("n_starts", "n_ends") + 1,
        }
    )
    end = F.struct("end_ts", "status", "error")
    closed = ranked.groupBy("g").agg(
        F.max("n_ends").alias("n_ends"),
        F.max_by(end, F.when(F.col("_is_final"), 1)).alias("final"),
        F.max_by(end, F.when(F.col("_is_paired"), 1)).alias("paired"),
        F.max_by(end, F.when(F.col("_is_first"), 1)).alias("earliest"),
    )
    joined = opened.join(closed, "g", "left")
    interrupted = F.when(F.col("n_starts") > 1, F.col("paired"))
    second = F.when(F.col("n_ends") > 1, F.col("earliest"))

    def stop(name: str) -> Column:
        return F.coalesce(interrupted[name], second[name])

    merged = joined.select(
        "g.*",
        F.col("first_start").alias("begin_ts"),
        F.col("final.end_ts").alias("end_ts"), F.col("final.status").alias("status"), F.col("final.error").alias("error"),
        stop("end_ts").alias("interrupt_start"), stop("status").alias("interrupt_status"), stop("error").alias("interrupt_error"),
        F.when((F.col("n_starts") > 1) & interrupted["end_ts"].isNotNull(), F.col("last_start")).alias("interrupt_end"),
        F.when(F.col("n_starts") > 1, F.coalesce("_first_contour", "_last_contour")).otherwise(F.col("_last_contour")).alias("contour"),
        "about.*",
    )
    bounded = neighbour_bounds(cut(merged), marks)
    # An interruption that was itself a success is the real end of the cycle.
    real = F.coalesce(F.col("interrupt_status") == "Successful", F.lit(False))
    swapped = bounded.withColumn("_real", real).withColumns(
        {
            "end_ts": F.when(F.col("_real"), F.col("interrupt_start")).otherwise(F.col("end_ts")),
            "status": F.when(F.col("_real"), F.col("interrupt_status")).otherwise(F.col("status")),
            "error": F.when(F.col("_real"), F.col("interrupt_error")).otherwise(F.col("error")),
        }
    ).withColumns(
        {c: F.when(~F.col("_real"), F.col(c)) for c in ("interrupt_start", "interrupt_status", "interrupt_error")}
    )
    open_end = F.col("end_ts").isNull() | (F.col("end_ts") < F.coalesce("interrupt_end", F.lit(K.LAG_BOUND).cast("timestamp")))
    return swapped.withColumn("_open", open_end).withColumns(
        {c: F.when(~F.col("_open"), F.col(c)) for c in ("end_ts", "status", "error")}
    ).drop("_open", "_real")


def neighbour_bounds(cycles: DataFrame, marks: DataFrame, bucket: str = "1 day") -> DataFrame:
    """Idle time around each cycle: to the neighbouring cycle of the file, else to the log's own marks."""
    near = with_neighbours(
        cycles, ["file_name"], ["begin_ts", "cycle_count", "card"],
        previous={"_before": "end_ts"}, following={"_after": "begin_ts"}, bucket=bucket,
    ).join(marks, "file_name", "left")
    before, after = F.coalesce("_before", "_first_mark"), F.coalesce("_after", "_last_mark")
    low = F.lit(K.LAG_BOUND).cast("timestamp")
    return near.withColumns(
        {
            "pre_cycle": F.when(before < F.col("begin_ts"), before).otherwise(F.col("begin_ts")),
            "post_cycle": F.when(F.coalesce(after, F.col("end_ts")) > F.coalesce("end_ts", low), after).otherwise(F.col("end_ts")),
        }
    ).drop("_before", "_after", "_first_mark", "_last_mark")


def own_gen1(cycles: DataFrame, equipment: DataFrame, bucket: str = "365 days") -> DataFrame:
    """Card shipment around the whole cycle, unsold flag, newest cycle per countdown and card."""
    shipped = equipment.where("transit_status = 'SHIPPED'")
    owned = interval_join(
        cycles, shipped, {"card": "serial"}, at="begin_ts", start="ship_start", end="ship_end", bucket=bucket,
        take={"_card": "serial", "_sold": "sold_to", "_ship": "ship_to", "card_material": "material", "_until": "ship_end"},
    )
    held = F.col("_card").isNotNull() & (F.col("end_ts") < F.col("_until"))
    marked = owned.withColumn("_held", F.coalesce(held, F.lit(False))).withColumns(
        {
            "unsold_flag": F.when(F.col("_held"), "N").otherwise("Y"),
            "sold_to": F.coalesce(F.when(F.col("_held"), F.col("_sold")), F.lit(K.MISSING_ACCOUNT)),
            "ship_to": F.coalesce(F.when(F.col("_held"), F.col("_ship")), F.lit(K.MISSING_ACCOUNT)),
            "card_material": F.when(F.col("_held"), F.col("card_material")),
        }
    ).drop("_held", "_card", "_sold", "_ship", "_until")
    return latest_by(marked, ["cycle_count", "card"], [F.col("begin_ts").desc(), F.col("file_name").asc()])


def file_serial(file_name: str | Column) -> Column:
    """Device serial in a gen-1 file name: its second part."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.trim(F.upper(F.get(F.split(F.replace(name, F.lit("%20"), F.lit(" ")), "_"), F.lit(1))))


def merge_gen1(target: DataFrame, cycles: DataFrame) -> DataFrame:
    """Insert cycles that are new by device serial, card, cycles left and begin time, in whichever file they come.

    Missing serials and cards are empty, a missing count is 0; a cycle without begin time equals no other. Of equal
    cycles in one batch the first file's stays.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "_serial": F.coalesce(file_serial("file_name"), F.lit("")), "_card": F.upper(F.coalesce("card", F.lit(""))),
            "_left": F.coalesce("cycle_count", F.lit(0)), "_begin": F.col("begin_ts"),
        })

    keys = ["_serial", "_card", "_left", "_begin"]
    batch = keyed(cycles.select(*target.columns))
    order = [F.col(c).asc_nulls_first() for c in ("file_name", "cycle_count", "card")]
    dated = latest_by(batch.where("begin_ts IS NOT NULL"), keys, order)
    fresh = insert_only(keyed(target), dated.unionByName(batch.where("begin_ts IS NULL")), keys)
    return fresh.select(*target.columns)
