"""Archive intake as a set operation: manifest rows in, routed rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.operators.groups import number_in_group
from usagelake.operators.temporal import match_running
from usagelake.session import settle

# Intake containers with their load types, and the member types that are processed.
LOAD_TYPES = {"logs-scanned": "IOT", "usbdecrypted-zip": "USB"}
MEMBER_TYPES = ("UL", "UE", "SYS", "ML", "MLT", "ENGR", "MEDAPPUI-USERINTERACTION")
NAME_PARTS, MEMBER_PARTS = 5, 3
ATTEMPTS_PER_BUCKET = 10_000


def classify_archives(manifest: DataFrame, created: str = "created") -> DataFrame:
    """Judge archives by container and name.

    Needs `container`, `folder`, `file_name`, `event_type` (only `created` events count);
    adds `load_type`, `device_id`, `log_day`, `name_status` and `route`
    (valid, invalid, duplicate or ignored).
    """
    name, container = F.col("file_name"), F.lower("container")
    parts = F.split(name, "_")
    extensions = F.filter(F.split(F.lower(name), r"\."), lambda _, i: i > 0)
    zipped = F.array_contains(extensions, "zip")
    named = F.size(parts) >= NAME_PARTS
    status = F.when(~zipped, "notzipfile").when(named, "valid").otherwise("invalid")
    copy = (container == "logs-scanned") & F.lower(name).startswith("zlog")
    load = F.lit(None).cast("string")
    for key, value in LOAD_TYPES.items():
        load = F.when(container == key, value).otherwise(load)
    return manifest.withColumns(
        {
            "load_type": load,
            "name_status": status,
            "device_id": F.when(zipped & named, F.upper(F.get(parts, F.lit(2))))
            .when(zipped, F.upper("folder"))
            .otherwise(F.col("folder")),
            "log_day": F.when(zipped & named, F.substring(F.get(parts, F.lit(4)), 1, 8)),
            "route": F.when((F.col("event_type") != created) | load.isNull(), "ignored")
            .when(copy, "duplicate")
            .when(status != "valid", "invalid")
            .otherwise("valid"),
        }
    )


def classify_members(members: DataFrame, types: tuple[str, ...] = MEMBER_TYPES) -> DataFrame:
    """Device type, log type and route of an archive member, by its name."""
    parts = F.split("member_name", "_")
    kind = F.when(F.size(parts) >= MEMBER_PARTS, F.upper(F.get(parts, F.lit(2))))
    known = kind.isin(*types) | kind.contains("ASSERT")
    return members.withColumns(
        {
            "device_type": F.upper(F.get(parts, F.lit(0))),
            "log_type": kind,
            "route": F.when(F.coalesce(known, F.lit(False)), "valid").otherwise("invalid"),
        }
    )


def classify_files(members: DataFrame, registry: DataFrame) -> DataFrame:
    """Judge unpacked members against files already loaded at the same `destination`.

    A larger member replaces the loaded file, any other is a duplicate; a member
    without a size could not be read.
    """
    loaded = registry.groupBy("destination").agg(F.max("file_size").alias("_size"))
    joined = members.join(loaded, "destination", "left")
    return joined.withColumn(
        "status",
        F.when(F.col("file_size").isNull(), "Failed")
        .when(F.col("_size").isNull(), "New")
        .when(F.col("file_size") > F.col("_size"), "Replace")
        .otherwise("Duplicate"),
    ).drop("_size")


def replay_attempts(attempts: DataFrame, registry: DataFrame, *, bucket: str = "30 days") -> DataFrame:
    """Attempts to load archive members, in order, each judged against what its destination held by then.

    attempts: attempt_id, archive, destination, file_size (null: it could not be read), attempted_at;
    registry: destination, file_size of what was loaded before. Adds `status`: New, Replace (larger than what is there),
    Duplicate or Failed. What a destination holds is the greatest size of the registry and of all earlier attempts, so
    a running maximum is all the state there is; a destination of many attempts is cut into buckets.
    """
    ordered = number_in_group(attempts, ["destination"], ["attempted_at", "attempt_id"], "_nth", bucket=bucket)
    ordered = settle(ordered)
    read = ordered.where("file_size IS NOT NULL").select("destination", "_nth", F.col("file_size").alias("_size"))
    held = match_running(ordered, read, ["destination"], at="_nth", since="_nth", best=["_size"], take={"_held": "_size"},
                         inclusive=False, bucket=ATTEMPTS_PER_BUCKET)
    loaded = registry.groupBy("destination").agg(F.max("file_size").alias("_loaded"))
    there = F.greatest("_held", "_loaded")
    return held.join(loaded, "destination", "left").withColumn(
        "status",
        F.when(F.col("file_size").isNull(), "Failed")
        .when(there.isNull(), "New")
        .when(F.col("file_size") > there, "Replace")
        .otherwise("Duplicate"),
    ).drop("_nth", "_held", "_loaded")


def archive_states(judged: DataFrame, give_up: int = 3) -> DataFrame:
    """Where the attempts on each archive have led: loaded, duplicate, given_up (failed `give_up` times) or waiting."""
    def count(*statuses: str) -> Column:
        return F.sum(F.col("status").isin(*statuses).cast("long"))

    counted = judged.groupBy("archive").agg(
        F.count(F.lit(1)).alias("n_attempts"), count("Failed").alias("n_failed"), count("Replace").alias("n_replaced"),
        count("New", "Replace").alias("_loaded"), count("Duplicate").alias("_copies"))
    state = F.when(F.col("_loaded") > 0, "loaded").when(F.col("_copies") > 0, "duplicate").when(
        F.col("n_failed") >= give_up, "given_up").otherwise("waiting")
    return counted.withColumn("state", state).drop("_loaded", "_copies")
