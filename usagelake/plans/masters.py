"""Master data: customers, products, territories, hierarchy, equipment history, device twin."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.constants import OPEN_END
from usagelake.functions.columns import norm_key, path_part
from usagelake.operators.dedup import arg_min, latest_by, row_key
from usagelake.operators.groups import as_column, bucket_of, order_key
from usagelake.operators.temporal import asof_join
from usagelake.operators.upsert import keep_nulls_out, match_all, insert_only, scd1, update_if_changed, upsert
from usagelake.session import settle, small

# ---- SCD1 masters ----------------------------------------------------------


def load_master(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """Dedup by a stated order, then update + insert."""
    return scd1(target, latest_by(source.distinct(), keys, order), keys, keep)


def customers(target: DataFrame, source: DataFrame) -> DataFrame:
    order = [F.col(c).desc() for c in ("file_name", "city", "city2", "name")]
    return load_master(target, source, ["account_id"], order)


def products(target: DataFrame, source: DataFrame) -> DataFrame:
    order = [F.col(c).desc() for c in ("channel", "code", "description", "category")]
    return load_master(target, source.withColumn("product_hash", row_key("code")), ["code"], order)


def territories(source: DataFrame, account: str = "account_id", code: str = "territory", pattern: str = "CP%") -> DataFrame:
    """The lowest sales territory of each account."""
    return arg_min(source.where(F.col(code).like(pattern)), [account], code).distinct()


HIERARCHY_KEYS = ("ship_to", "sold_to", "payer", "effective")


def account_hierarchy(target: DataFrame, source: DataFrame) -> DataFrame:
    """Latest termination per null-tolerant key; only changed rows are written."""
    fresh = latest_by(source, HIERARCHY_KEYS, [F.col("termination").desc(), F.col("is_current").desc(), F.col("updated_at").desc()])
    return update_if_changed(
        target, fresh, HIERARCHY_KEYS, tracked=["termination", "is_current"], also=["updated_at"], null_safe=True
    )


def deactivate_missing(history: DataFrame, snapshot: DataFrame, keys: Sequence[str], flag: str = "per_patient") -> DataFrame:
    """Members absent from a new snapshot, with their flag switched off."""
    return history.join(snapshot.select(*keys).distinct(), list(keys), "left_anti").withColumn(flag, F.lit(False))


def programme_cards(equipment: DataFrame, materials: DataFrame, as_of: date) -> DataFrame:
    """Cards of programme materials in force: one row per card and programme, earliest start."""
    in_force = materials.where(F.lit(as_of).between(F.col("effective"), F.col("termination")))
    joined = equipment.select(F.col("serial").alias("card"), "material").join(in_force, "material")
    first = latest_by(joined, ["card", "promotion_uuid"], [F.col("effective").asc(), F.col("termination").desc(), F.col("material").asc()])
    return first.withColumn("active", F.lit(True))


def load_reference(target: DataFrame, source: DataFrame, keys: Sequence[str], dated: Sequence[str] = (), pattern: str = "MM/dd/yyyy") -> DataFrame:
    """Reference rows from text files: dates parsed, rows without a key dropped, all shared columns upserted."""
    typed = source.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(pattern)).cast("date") for c in dated})
    present = typed.dropna(subset=list(keys)).distinct()
    return match_all(target, present, keys)


# ---- equipment history -----------------------------------------------------

# Change dates that mean "unknown", and file priorities by source folder.
NO_CHANGE_DATE = ("00000000", "19000101")
FILE_PRIORITY = {"BW": "1", "S4": "2"}


def clean_equipment(changes: DataFrame, refurbished: Sequence[str] = (), scrapped: str = "SCRAPPED") -> DataFrame:
    """Typed change rows: scrapped dropped, change date fallback, refurbished flag, file priority."""
    changed = F.when(
        F.col("changed_on").isNull() | F.col("changed_on").isin(*NO_CHANGE_DATE), F.col("created_on")
    ).otherwise(F.col("changed_on"))
    folder = path_part("file_path", 1)
    priority = F.lit("")
    for name, rank in FILE_PRIORITY.items():
        priority = F.when(folder == name, rank).otherwise(priority)
    return changes.where(F.coalesce(F.col("status"), F.lit("")) != scrapped).withColumns(
        {
            "changed_on": changed,
            "ship_start": F.try_to_timestamp(changed, F.lit("yyyyMMdd")).cast("date"),
            "serial": F.coalesce(norm_key("serial"), F.lit("UNKNOWN")),
            "file_priority": priority,
            "is_refurbished": F.when(F.right(F.col("material"), F.lit(2)).isin(*refurbished), 1).otherwise(0)
            if refurbished
            else F.lit(0),
            "mfg_batch": norm_key("mfg_batch"),
        }
    )


EQUIPMENT_KEY = ("equipment_key", "serial", "changed_on")


#: Sorts before every shipment; a row without a date is the oldest of its serial.
NO_SHIPMENT = "0001-01-01"


def _shipped(name: str = "ship_start") -> Column:
    return F.coalesce(F.col(name), F.lit(NO_SHIPMENT).cast("date"))


#: A serial of more rows is ordered in buckets of time, one of fewer as a whole.
HOT_ROWS = 4096


def _spliced(rows: DataFrame, order: Sequence[str | Column], bucket: str) -> DataFrame:
    """History and changes (`_new`) by serial and bucket: repeated changes dropped, `_later` rows ordered in their bucket.

    All windows share the partitioning by (serial, bucket), so rows are shuffled once. `rows` has `_n` and `_from`, which
    are null but for hot serials.
    """
    lead = bucket_of(F.col("ship_start"), rows.schema["ship_start"].dataType, bucket)
    place = Window.partitionBy("serial", "_bkt")
    since = F.when(F.col("_n").isNotNull(), F.col("_from")).otherwise(F.min(F.when(F.col("_new"), _shipped())).over(place))
    placed = rows.withColumn("_bkt", F.when(F.col("_n").isNotNull(), F.coalesce(lead, F.lit(-(2**62)))).otherwise(F.lit(0))).withColumn("_since", since)
    placed = placed.withColumn("_later", F.col("_new") | F.coalesce(_shipped() >= F.col("_since"), F.lit(False)))
    best = Window.partitionBy("serial", "_bkt", "_later", "equipment_key", "changed_on").orderBy(
        F.col("created_at").desc(), F.col("file_priority").desc(), F.col("is_refurbished").desc(), F.col("load_order").asc_nulls_last())
    unique = placed.withColumn("_nth", F.row_number().over(best)).where("NOT _later OR _nth = 1").drop("_nth")
    inside = Window.partitionBy("serial", "_bkt", "_later").orderBy(*[as_column(o) for o in order])
    return unique.withColumns({
        "_prior": F.lag(F.struct("transit_status")).over(inside), "_next": F.lead(F.struct("ship_start")).over(inside),
        "_rn": F.row_number().over(inside),
    })


def _facts() -> dict[str, Column]:
    """What a bucket tells of its early rows (the last one's number and status) and of its later ones (number, first date)."""
    early = F.when(~F.col("_later") & F.col("_since").isNotNull(), F.col("load_order"))
    return {
        "_carried": F.min(early), "_carried_status": F.min_by("transit_status", early),
        "_count": F.count(F.when(F.col("_later"), 1)), "_first": F.min(F.when(F.col("_later"), _shipped())),
    }


def equipment_history(history: DataFrame, changes: DataFrame, bucket: str = "7 days") -> DataFrame:
    """Splice changes into the history: from each touched serial's earliest changed date on, rows are ordered anew.

    `history` is as this function left it (or empty), `changes` as `clean_equipment` did: the change date gives the date
    of shipment. Of a touched serial, rows before that date keep their content: the last of them is closed at that date
    and is the prior row of what follows, and load orders move by the number of rows that came in. Other serials stay as
    they are. So a serial that many rows share (`UNKNOWN`) is ordered from its first changed date on, in buckets, and not
    as a whole.

    Rows are shuffled once, by serial and, of the few serials of more than `HOT_ROWS` rows, bucket. Only these are read
    once more, for what goes over the borders of their buckets.
    """
    rows = history.withColumn("_new", F.lit(False)).unionByName(
        changes.where("serial IS NOT NULL").withColumn("_new", F.lit(True)), allowMissingColumns=True)
    sized = rows.groupBy("serial").agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("_new"), _shipped())).alias("_from"))
    hot = small(settle(sized.where(F.col("_n") > HOT_ROWS)))
    # Oldest to newest; the earlier load order of a known row ranks it (1 = newest).
    order: list[str | Column] = [
        "ship_start", "file_priority", (-F.coalesce(F.col("load_order"), F.lit(0))), "created_at", "is_refurbished", "equipment_key",
    ]
    facts = _facts()
    edges = _spliced(rows.join(hot, "serial"), order, bucket).groupBy("serial", "_bkt").agg(
        *[fact.alias(name) for name, fact in facts.items()],
        F.max_by(F.struct("transit_status"), F.when(F.col("_later"), order_key(order))).alias("_last"),
        F.min_by(F.struct("ship_start"), F.when(F.col("_later"), order_key(order))).alias("_head"),
    )
    line = Window.partitionBy("serial").orderBy("_bkt")
    whole, after = Window.partitionBy("serial"), line.rowsBetween(1, Window.unboundedFollowing)
    edges = settle(edges.select(
        "serial", "_bkt", F.min("_carried").over(whole).alias("_h_carried"), F.min_by("_carried_status", "_carried").over(whole).alias("_h_status"),
        F.sum("_count").over(whole).alias("_h_total"), F.min("_first").over(whole).alias("_h_first"),
        F.coalesce(F.sum("_count").over(after), F.lit(0)).alias("_h_after"),
        F.last("_last", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("_h_prior"),
        F.first("_head", ignorenulls=True).over(after).alias("_h_next"),
    ))
    place = Window.partitionBy("serial", "_bkt")
    rows = _spliced(rows.join(hot, "serial", "left"), order, bucket).withColumns({name: fact.over(place) for name, fact in facts.items()})
    rows = rows.join(small(edges), ["serial", "_bkt"], "left")
    is_hot, carried = F.col("_n").isNotNull(), F.coalesce("_h_carried", "_carried")
    total = F.when(is_hot, F.col("_h_total")).otherwise(F.col("_count"))
    carried_status = F.when(is_hot, F.col("_h_status")).otherwise(F.col("_carried_status"))
    number = (F.coalesce("_h_after", F.lit(0)) + F.col("_count") - F.col("_rn") + 1).cast("long")
    prior = F.when(number == total, carried_status).otherwise(F.coalesce("_prior", "_h_prior")["transit_status"])
    returned = F.coalesce((prior == "SHIPPED") & (F.col("transit_status") == "IN WAREHOUSE"), F.lit(False))
    status = F.when(returned, "RETURNED").otherwise(F.col("transit_status"))
    later, early = F.col("_later"), F.col("_since").isNotNull()
    closed = F.when(F.col("load_order") == carried, F.when(is_hot, F.col("_h_first")).otherwise(F.col("_first"))).otherwise(F.col("ship_end"))
    spliced = {
        "ship_end": F.when(later, F.coalesce(F.coalesce("_next", "_h_next")["ship_start"], F.lit(OPEN_END).cast("date")))
        .when(early, closed).otherwise(F.col("ship_end")),
        "load_order": F.when(later, number).when(early, F.col("load_order") - carried + total + 1).otherwise(F.col("load_order")),
        "movement_status": F.when(later, status).otherwise(F.col("movement_status")),
        "return_date": F.when(~later, F.col("return_date")).when(status == "RETURNED", F.col("ship_start")),
    }
    return rows.select(*[spliced.get(c, F.col(c)).alias(c) for c in history.columns])


def ownership(equipment: DataFrame, products_: DataFrame, accounts: DataFrame, territory: DataFrame) -> DataFrame:
    """Latest shipment of each serial with product, both account roles and territory."""
    from usagelake.functions.columns import strip_zeros

    last = latest_by(
        equipment, ["serial"], [F.col("ship_start").desc(), F.col("ship_end").desc(), F.col("equipment_key").asc()]
    )
    roles = {}
    for role in ("sold_to", "ship_to"):
        roles[role] = accounts.select(
            F.col("account_id").alias(role), F.col("name").alias(f"{role}_name"), F.col("city").alias(f"{role}_city"),
            F.col("country").alias(f"{role}_country"),
        )
    return (
        last.join(small(products_.select(F.col("code").alias("material"), F.col("description").alias("product_name"))), "material")
        .join(roles["sold_to"], "sold_to", "left")
        .join(roles["ship_to"], "ship_to", "left")
        .join(territory.select(F.col("account_id").alias("ship_to"), "territory"), "ship_to", "left")
        .withColumn("external_serial", strip_zeros("serial"))
    )


# ---- device twin -----------------------------------------------------------

# Components whose version is reported as {"fw": {"mj", "md", "mn"}}.
VERSION_PARTS = ("App1", "App2", "CCB", "Cooler", "Maestro", "OS", "Pib", "Vac1", "Vac2")
TWIN_STATE = ("status_flag", "connection_state", "last_activity", "version_nbr", "desired_packages", "reported_packages",
              "fluid_filter", "air_filter", "hand_piece")
TWIN_VERSIONS = tuple(f"{p.lower()}_version" for p in VERSION_PARTS)


def parse_twin(messages: DataFrame) -> DataFrame:
    """Twin JSON to columns; component versions prefer `softwareVersions` over `Versions`."""
    part = "struct<fw: struct<mj: string, md: string, mn: string>>"
    versions = "struct<" + ", ".join(f"{p}: {part}" for p in VERSION_PARTS) + ">"
    schema = (
        "struct<etag: string, status: string, connection_state: string, last_activity_time: string, version: string, "
        "properties: struct<desired: struct<packages: string>, reported: struct<externalSerialNumber: string, "
        "internalSerialNumber: string, packages: string, FluidFilter: string, AirFilter: string, HandPiece: string, "
        f"softwareVersions: {versions}, Versions: {versions}>>>"
    )
    twin = messages.withColumn("twin", F.from_json("twin_json", schema))
    reported = F.col("twin.properties.reported")

    def dotted(container: str, name: str) -> Column:
        fw = reported[container][name]["fw"]
        return F.when(fw.isNotNull(), F.concat_ws(".", fw["mj"], fw["md"], fw["mn"]))

    return twin.withColumns(
        {
            "device_id": norm_key("device_id"),
            "etag": F.col("twin.etag"),
            "status_flag": F.col("twin.status"),
            "connection_state": F.col("twin.connection_state"),
            "last_activity": F.col("twin.last_activity_time").try_cast("timestamp"),
            "version_nbr": F.col("twin.version").try_cast("bigint"),
            "external_serial": norm_key(reported["externalSerialNumber"]),
            "internal_serial": norm_key(reported["internalSerialNumber"]),
            "desired_packages": F.col("twin.properties.desired.packages"),
            "reported_packages": reported["packages"],
            "fluid_filter": reported["FluidFilter"],
            "air_filter": reported["AirFilter"],
            "hand_piece": reported["HandPiece"],
            "has_versions": reported["softwareVersions"].isNotNull() | reported["Versions"].isNotNull(),
            **{
                f"{p.lower()}_version": F.coalesce(dotted("softwareVersions", p), dotted("Versions", p))
                for p in VERSION_PARTS
            },
        }
    ).drop("twin")


def twin_full_load(target: DataFrame, twins: DataFrame) -> DataFrame:
    full = twins.where("operation_type = 'FullLoad'")
    last = latest_by(full, ["device_id"], [F.col("operation_ts").desc(), F.col("version_nbr").desc(), F.col("etag").asc()])
    return insert_only(target, last.select(*[c for c in target.columns if c in last.columns]), ["device_id"])


def _informative() -> str:
    """A change message that carries state; a version number alone does not count."""
    return " OR ".join([*(f"{c} IS NOT NULL" for c in TWIN_STATE if c != "version_nbr"), "has_versions"])


def twin_changes(target: DataFrame, twins: DataFrame) -> DataFrame:
    """Collapse change messages by column maximum, then update without overwriting by nulls."""
    columns = [*TWIN_STATE, *TWIN_VERSIONS]
    changes = (
        twins.where("operation_type = 'updateTwin'").where(_informative())
        .groupBy("device_id").agg(*[F.max(c).alias(c) for c in columns], F.max("has_versions").alias("has_versions"))
    )
    versioned = keep_nulls_out(target, changes, ["device_id"], TWIN_VERSIONS, condition="s.has_versions")
    return keep_nulls_out(versioned, changes, ["device_id"], TWIN_STATE)


def merge_twins(target: DataFrame, messages: DataFrame) -> DataFrame:
    twins = parse_twin(messages)
    return twin_changes(twin_full_load(target, twins), twins)


def merge_twin_epochs(target: DataFrame, messages: DataFrame, bucket: str = "1 day", lanes: int = 256) -> DataFrame:
    """Full loads and the changes between them, folded epoch by epoch in one plan.

    An epoch begins with each full-load run (an `operation_ts` of FullLoad messages) and ends before the next one;
    messages before the first run, or without a time, are epoch 0. The result is that of `merge_twins` called with one
    epoch after the other: a device enters the target with the latest message of its first run, changes of earlier
    epochs miss it, and each later epoch, collapsed by column maximum, overwrites what it has a value for.
    """
    twins = parse_twin(messages).withColumn("_lane", F.pmod(F.xxhash64("device_id"), F.lit(lanes)))
    # One row per run; every lane of devices gets its own copies, so that no lane's time line holds all messages.
    runs = messages.where("operation_type = 'FullLoad'").select(F.col("operation_ts").alias("_run")).dropna().distinct()
    runs = runs.select("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("_lane"))
    dated = settle(asof_join(twins, runs, ["_lane"], at="operation_ts", time="_run", take={"epoch": "_run"}, bucket=bucket).drop("_lane"))
    epoch = F.coalesce("epoch", F.lit("0001-01-01").cast(dated.schema["epoch"].dataType))
    dated = dated.withColumn("epoch", epoch)

    entered = dated.where("operation_type = 'FullLoad'").join(target.select("device_id"), "device_id", "left_anti")
    born = entered.groupBy("device_id").agg(F.min("epoch").alias("born"))
    first = entered.join(born, "device_id").where(F.col("epoch") == F.col("born"))
    first = latest_by(first, ["device_id"], [F.col("operation_ts").desc(), F.col("version_nbr").desc(), F.col("etag").asc()])
    columns = [*TWIN_STATE, *TWIN_VERSIONS]
    per_epoch = (
        dated.where("operation_type = 'updateTwin'").where(_informative())
        .groupBy("device_id", "epoch").agg(*[F.max(c).alias(c) for c in columns])
        .join(born, "device_id", "left").where("born IS NULL OR epoch >= born")
    )
    # The last epoch with a value decides; a column without one in any epoch is null and changes nothing.
    folded = per_epoch.groupBy("device_id").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("epoch"))).alias(c) for c in columns]
    )
    loaded = insert_only(target, first.select(*[c for c in target.columns if c in first.columns]), ["device_id"])
    return keep_nulls_out(loaded, folded, ["device_id"], columns)


def number_consumers(target: DataFrame, ids: DataFrame, column: str = "consumer_id", number: str = "scanned_id", seed: int = 0) -> DataFrame:
    """Give new valid consumer ids the next numbers."""
    from usagelake.functions.columns import valid_consumer
    from usagelake.operators.dedup import assign_sequence, next_start

    fresh = ids.select(column).where(valid_consumer(column)).distinct().join(target.select(column), column, "left_anti")
    spread = fresh.withColumn("_h", F.pmod(F.xxhash64(column), F.lit(4096)))
    numbered = assign_sequence(spread, ["_h", column], number, bucket=1, start=next_start(target, number, seed))
    return upsert(target, numbered.select(column, number), [column])
