"""Report frames. Presentation order is left to the caller (`present`)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelake.functions.columns import escape_file_name, format_id10, local_date, norm_key, render_template, zone_offset
from usagelake.operators.dedup import latest_by, rank_by_priority
from usagelake.operators.temporal import asof_join, interval_join, missing_numbers, range_join
from usagelake.operators.groups import with_neighbours
from usagelake.session import small


def present(df: DataFrame, *order: str | Column) -> DataFrame:
    """Final sort of a report."""
    return df.orderBy(*order)


# ---- log files and their cycles --------------------------------------------


def source_files(registry: DataFrame, parameters: DataFrame | None = None, plain_type: str = "COM1") -> DataFrame:
    """Registry rows with derived log times and `unique_sequence` (1 = the row to use) per file identity."""
    stamped = F.try_to_timestamp(F.substring("file_stamp", 1, 14), F.lit("yyyyMMddHHmmss"))
    own = F.coalesce(F.col("device_type") == plain_type, F.lit(False))
    out = registry.withColumns(
        {
            "external_serial": F.upper("external_serial"),
            "internal_serial": F.upper("internal_serial"),
            "file_stamp": F.replace("file_stamp", F.lit(".csv"), F.lit("")),
            **{c: F.when(own, F.col(c)).otherwise(F.coalesce(F.col(c), stamped)) for c in ("log_start", "log_end")},
        }
    )
    if parameters is not None:
        zones = latest_by(parameters, ["file_id"], [F.col("time_zone").asc_nulls_last()]).select("file_id", "time_zone")
        out = out.join(zones, "file_id", "left")
    identity = ["internal_serial", "external_serial", "device_type", "message_type", "file_stamp", "file_port", "file_cycle_nbr"]
    newest = latest_by(out, identity, [F.col("log_start").desc(), F.col("updated_at").desc(), F.col("file_id").asc()])
    marked = out.join(newest.select("file_id", F.lit(1).alias("unique_sequence")), "file_id", "left")
    return marked.withColumn("unique_sequence", F.coalesce("unique_sequence", F.lit(2)))


def associate_files(cycles: DataFrame, files: DataFrame, kind: str, bucket: str = "30 days") -> DataFrame:
    """The log file of a kind before and after each cycle.

    Before: ``start >= file start``; after: ``start < file start``. One row per cycle.
    """
    chosen = files.where((F.col("unique_sequence") == 1) & F.upper("message_type").contains(kind.upper())).withColumn(
        "_serial", F.upper("external_serial")
    )
    probe = cycles.withColumn("_key", F.upper("external_serial"))
    k = kind.lower()
    on = {"_key": "_serial"}

    def take(side: str) -> dict[str, str]:
        return {f"{side}_{k}_file_id": "file_id", f"{side}_{k}_path": "file_path"}

    before = asof_join(probe, chosen, on, at="start_ts", time="log_start", take=take("pre"), tie=["updated_at", "file_id"], bucket=bucket)
    after = asof_join(before, chosen, on, at="start_ts", time="log_start", take=take("post"), direction="next",
                      inclusive=False, tie=["updated_at", "file_id"], bucket=bucket, skeleton=probe)
    return after.drop("_key")


def associate_events(cycles: DataFrame, events: DataFrame, *, bucket: str, origin: str, horizon: str) -> DataFrame:
    """User event inside each cycle (latest), the last one by its start and the first one from its start.

    An event at exactly the cycle start counts as both. Head 0 (or none) of an
    event applies to every head of the device.
    """
    def serials(df: DataFrame) -> DataFrame:
        return df.withColumns({"_ext": F.upper("external_serial"), "_int": F.upper("internal_serial")})

    keys = {"_ext": "_ext", "_int": "_int", "device_type": "device_type"}
    evs = serials(events).withColumn("_head", F.coalesce("head", F.lit(0)))
    probe = serials(cycles)
    # Wildcard head: an event of head 0 is joined without the head, any other with it.
    parts = [(evs.where("_head = 0"), keys), (evs.where("_head <> 0"), {**keys, "head": "_head"})]
    sides, bones = {}, probe
    for side, direction in (("pre", "previous"), ("post", "next")):
        out = probe
        for i, (part, on) in enumerate(parts):
            out = asof_join(out, part, on, at="start_ts", time="event_ts", direction=direction, bucket=bucket,
                            take={f"_{side}{i}_ts": "event_ts", f"_{side}{i}_id": "file_id"}, tie=["file_id"], skeleton=bones)
        probe = out
        a, b = (F.struct(F.col(f"_{side}{i}_ts"), F.col(f"_{side}{i}_id")) for i in (0, 1))
        first = F.col(f"_{side}1_ts").isNull() | (
            F.col(f"_{side}0_ts").isNotNull() & ((a >= b) if side == "pre" else (a <= b))
        )
        sides[f"{side}_event_file_id"] = F.when(first, F.col(f"_{side}0_id")).otherwise(F.col(f"_{side}1_id"))
    linked = probe.withColumns(sides).select(*cycles.columns, *sides)
    span = serials(cycles).select("cycle_id", "_ext", "_int", "device_type", "head", "event_start", "event_end")
    inside = range_join(
        evs, span, keys, at="event_ts", start="event_start", end="event_end", closed="both",
        take={"cycle_id": "cycle_id", "_cycle_head": "head"}, bucket=bucket, origin=origin, horizon=horizon,
        extra=(F.col("_head") == 0) | (F.col("_head") == F.col("_cycle_head")),
    )
    last = inside.groupBy("cycle_id").agg(F.max(F.struct("event_ts", "file_id")).alias("_e")).select(
        "cycle_id", F.col("_e.file_id").alias("inside_event_file_id")
    )
    return linked.join(last, "cycle_id", "left")


# ---- devices ---------------------------------------------------------------


def device_overview(state: DataFrame, contacts: DataFrame, twins: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    """One row per device: collapsed newest system rows and contacts, joined to the newest twin."""
    newest = latest_by(state, ["internal_serial", "contract"], [F.col("updated_at").desc(), F.col("header_ts").desc(), F.col("external_serial").asc()])
    seen = F.when(F.max("header_ts").cast("date") >= F.date_sub(F.lit(as_of).cast("date"), days), "Connected").otherwise("Disconnected")
    system = newest.groupBy("external_serial", "internal_serial", "device_type").agg(
        F.max("sw_version").alias("sw_version"),
        F.coalesce(F.max("sim_card"), F.lit("NoSysLogEntry")).alias("sim_card"),
        F.max(F.when(F.col("sim_card").isNotNull(), F.col("header_ts"))).alias("sim_reported_at"),
        F.max("header_ts").alias("last_contact"),
        F.max("rsrp").alias("rsrp"),
        F.max("rsrq").alias("rsrq"),
        seen.alias("connection_state"),
    )
    plain = contacts.select(
        "external_serial", "internal_serial", F.lit("COM1").alias("device_type"), "sim_card",
        F.when(F.col("sim_card").isNotNull(), F.col("last_contact")).alias("sim_reported_at"), "last_contact",
        F.when(F.col("last_contact").cast("date") >= F.date_sub(F.lit(as_of).cast("date"), days), "Connected")
        .otherwise("Disconnected").alias("connection_state"),
    )
    devices = system.unionByName(plain, allowMissingColumns=True)
    twin = latest_by(
        twins.withColumn("_key", F.coalesce("external_serial", "device_id")), ["_key"],
        [F.col("last_activity").desc(), F.col("device_id").asc()],
    ).drop("_key")
    s, t = devices.alias("s"), twin.alias("t")
    both = s.join(t, F.col("s.internal_serial") == F.col("t.device_id"), "full_outer").select(
        F.coalesce("t.external_serial", "s.external_serial").alias("external_serial"),
        F.coalesce("t.device_id", "t.internal_serial", "s.internal_serial").alias("internal_serial"),
        "s.device_type", "s.sw_version", F.coalesce("s.sim_card", F.lit("NoSysLogEntry")).alias("sim_card"), "s.sim_reported_at",
        F.coalesce("t.connection_state", "s.connection_state").alias("connection_state"),
        F.coalesce("t.last_activity", "s.last_contact").alias("last_activity"),
        "s.rsrp", "s.rsrq", "t.status_flag", "t.version_nbr",
        F.coalesce("s.last_contact", "t.last_activity").alias("_rank"),
    )
    return latest_by(both, ["external_serial"], [F.col("_rank").desc(), F.col("internal_serial").asc()]).drop("_rank")


# Log types that have a second stage.
STAGED_TYPES = ("UL", "UE", "SYS", "ENGR", "Usage", "Measurement", "UserException", "Exception", "Assert")
FILE_ID = ("source_container", "source_folder", "source_file", "dest_container", "dest_folder", "dest_file", "source_type")


def lineage(raw_log: DataFrame, silver_log: DataFrame) -> DataFrame:
    """Best raw status and latest silver status of each file, side by side."""
    def derived(status: Column) -> Column:
        return F.when(status.isin("Succeeded", "Duplicate"), "Succeeded").when(
            status.isin("InProgress", "Failed") | status.isNull(), status
        ).otherwise("NotApplicable")

    success_first = F.when(F.col("status") == "Succeeded", 1).otherwise(2)
    tie = [F.col("log_type").asc(), F.col("status").asc()]
    raw = rank_by_priority(raw_log, FILE_ID, success_first, F.col("created_at").desc(), *tie).withColumn(
        "raw_status", F.when(F.col("status").isNull(), "NotApplicable").otherwise(derived(F.col("status")))
    )
    silver = latest_by(silver_log, FILE_ID, [F.col("created_at").desc(), *tie]).withColumn("silver_status", derived(F.col("status")))
    r, s = raw.alias("r"), silver.alias("s")
    on = (F.col("r.dest_folder") == F.col("s.source_folder")) & (F.col("r.dest_file") == F.col("s.source_file"))
    unstaged = ~F.col("r.log_type").isin(*STAGED_TYPES) | (F.col("r.raw_status") == "NotApplicable")
    return r.join(s, on, "full_outer").select(
        F.col("r.source_folder").alias("landing_folder"), F.col("r.source_file").alias("landing_file"), "r.log_type", "r.raw_status",
        F.col("r.created_at").alias("raw_at"),
        F.coalesce("r.dest_folder", "s.source_folder").alias("raw_folder"),
        F.coalesce("r.dest_file", "s.source_file").alias("raw_file"),
        F.when(unstaged, "NotApplicable").otherwise(F.col("s.silver_status")).alias("silver_status"),
        F.col("s.created_at").alias("silver_at"),
    )


# ---- cycles ----------------------------------------------------------------


def cycle_report(cycles: DataFrame, applicators: DataFrame, errors: DataFrame, parameters: DataFrame) -> DataFrame:
    """Cycles with applicator name, error text and time zone."""
    zones = parameters.groupBy("file_id", "external_serial").agg(F.max("time_zone").alias("time_zone"))
    codes = errors.select(
        F.col("device_type"), F.when(F.col("device_type") == "CT", F.col("error_code")).otherwise(F.expr("substr(error_code, 2)")).alias("_code"),
        "event_text", "error_description",
    )
    named = applicators.select(F.col("applicator_cfg").alias("_cfg"), "applicator_name")
    return (
        cycles.where("event_start IS NOT NULL")
        .withColumns({"_cfg": F.left("applicator_cfg", F.lit(7)), "_code": F.coalesce("error_code", "z_code")})
        .join(small(named), "_cfg", "left")
        .join(zones, ["file_id", "external_serial"], "left")
        .join(small(codes), ["device_type", "_code"], "left")
        .withColumns({"begin_time": F.date_trunc("second", "event_start"), "end_time": F.date_trunc("second", "event_end")})
        .drop("_cfg", "_code")
    )


def missing_cycles(cycles: DataFrame, ownership: DataFrame) -> DataFrame:
    """Numbers a card's countdown skipped, with the card's range and owner."""
    span = cycles.groupBy("device_type", "card").agg(
        F.min("cycle_nbr").alias("min_cycle"), F.max("cycle_nbr").alias("max_cycle"),
        F.min("begin_ts").alias("first_begin"), F.max("begin_ts").alias("last_begin"),
    )
    gaps = missing_numbers(cycles.where("card IS NOT NULL"), ["device_type", "card"], "cycle_nbr", "missing_cycle", bucket=1000)
    return gaps.join(span, ["device_type", "card"]).join(
        ownership.select(F.col("serial").alias("card"), "ship_to"), "card", "left"
    )


def business_dates(cycles: DataFrame, addresses: DataFrame, parameters: DataFrame) -> DataFrame:
    """Local date of each cycle: time zone of the address first, then of the device."""
    zones = addresses.select("ship_to", F.when(F.col("time_zone") != "No Results", F.col("time_zone")).alias("_zone"))
    offsets = parameters.select("file_id", zone_offset("time_zone").alias("_offset"))
    return (
        cycles.join(zones, "ship_to", "left").join(offsets, "file_id", "left")
        .withColumn("local_date", local_date("start_ts", F.col("_zone"), F.col("_offset"))).drop("_zone", "_offset")
    )


# ---- billing reports -------------------------------------------------------

# Order of classes and class groups in an invoice.
CLASS_ORDER = (
    "PerPatientFee", "PerPatientFeeExceptionPreInvoice", "PerCycleFee", "PerCycleFeeExceptionPreInvoice",
    "NoPatientAssociationFee", "NoPatientAssociationFeeExceptionPreInvoice", "NoPatientAssociationFeePerCycleException",
    "FollowUpVisit", "PerPatientFeeExceptionPostInvoice", "PerCycleFeeExceptionPostInvoice",
    "NoPatientAssociationFeeExceptionPostInvoice", "PerPatientFeeMapViolation", "FraudViolation", "NonProgrammeFee", "MidwayPatient",
)


def class_order(name: Column, order: Sequence[str] = CLASS_ORDER) -> Column:
    place = F.array_position(F.array(*[F.lit(n) for n in order]), name)
    return F.when(place > 0, place).otherwise(F.lit(len(order) + 1)).cast("int")


def invoice_summary(invoices: DataFrame, accounts: DataFrame, classes: DataFrame, periods: DataFrame, promotions: DataFrame, customers: DataFrame) -> DataFrame:
    """Displayed invoice rows with signed amounts, billing period and file address."""
    shown = classes.where("display").select("class_uuid", "class_name", "display_name", "multiplier", "calc_type", F.col("list_price").alias("_price"))
    joined = (
        invoices.join(accounts.select("account_uuid", "ship_to", F.col("name").alias("account_name")).dropDuplicates(["account_uuid"]), "account_uuid", "left")
        .join(small(shown), "class_uuid")
        .join(small(periods.select("invoice_date", "period_start", "period_end")), "invoice_date", "left")
        .join(small(promotions.select("promotion_uuid", "promotion_name", "country", "file_template")), "promotion_uuid")
        .join(customers.select(F.col("account_id").alias("sold_to"), F.col("name").alias("sold_to_name")), "sold_to", "left")
    )
    signed = {c: F.coalesce(c, F.lit(0)) * F.col("multiplier") for c in ("cycle_count", "visit_count", "amount")}
    quantity = F.when(F.col("calc_type") == "PerSubscription", F.col("visit_count")).when(F.col("calc_type") == "PerCycle", F.col("cycle_count"))
    folder = F.concat(F.col("ship_to"), F.lit("/"), F.date_format("invoice_date", "yyyy-MM"), F.lit("/"))
    plain = F.concat(F.col("ship_to"), F.lit(" "), F.replace("account_name", F.lit("/"), F.lit("-")), F.lit(" "), F.date_format("invoice_date", "MM.dd.yyyy"), F.lit(" Summary.xlsx"))
    return joined.select(
        "invoice_date", "promotion_uuid", "promotion_name", "country", "account_uuid", "ship_to", "account_name", "sold_to", "sold_to_name",
        "class_name", "display_name", class_order(F.col("class_name")).alias("class_order"),
        *[v.alias(k) for k, v in signed.items()],
        (F.col("_price") * F.col("multiplier")).alias("list_price"),
        (F.coalesce(quantity, F.lit(0)) * F.col("multiplier")).alias("quantity"),
        "period_start", "period_end",
        render_template("file_template", {"FilePath": F.concat(folder, escape_file_name(plain))}).alias("summary_url"),
    )


def invoice_details(details: DataFrame, subscriptions: DataFrame, accounts: DataFrame, classes: DataFrame, comments: DataFrame, consumers: DataFrame) -> DataFrame:
    """Current invoice lines with visit dates, consumer number and rendered comment."""
    subs = with_neighbours(
        subscriptions.where("version = 1"), ["account_uuid", "consumer_id"], ["sub_start", "subscription_uuid"],
        previous={"previous_start": "sub_start"}, bucket="365 days",
    ).select("subscription_uuid", "sub_start", "sub_end", "previous_start", F.col("account_uuid").alias("sub_account_uuid"))
    own = accounts.select("account_uuid", "ship_to", F.col("name").alias("account_name")).dropDuplicates(["account_uuid"])
    other = own.select(F.col("account_uuid").alias("sub_account_uuid"), F.col("ship_to").alias("_other_ship_to"), F.col("account_name").alias("_other_name"))
    shown = classes.where("display").select("class_uuid", "class_name", "display_name", "multiplier", "calc_type", "list_price")
    per_cycle = F.col("calc_type") == "PerCycle"
    joined = (
        details.where("version = 1")
        .join(small(shown), "class_uuid")
        .join(subs, "subscription_uuid", "left")
        .join(own, "account_uuid", "left")
        .join(other, "sub_account_uuid", "left")
        .join(consumers.select("consumer_id", "scanned_id"), "consumer_id", "left")
        .join(small(comments.select(F.col("code").alias("comments"), F.col("description").alias("_text"))), "comments", "left")
    )
    note = render_template("_text", {
        "ExceptionDate": F.date_format("created_at", "MM-dd-yyyy"), "DifferentShipToNumber": F.col("_other_ship_to"),
        "DifferentShipToName": F.col("_other_name"), "ListPrice": F.coalesce("list_price", F.lit(0)),
    })
    return joined.select(
        "detail_uuid", "ship_to", "account_name", format_id10("consumer_id").alias("phone"), "scanned_id", "sold_to",
        F.col("cycle_date").alias("visit_date"),
        F.when(~per_cycle, F.col("sub_start")).alias("initial_visit"), F.when(~per_cycle, F.col("sub_end")).alias("final_visit"),
        "previous_start", "cycle_count", F.col("display_name").alias("class_shown"), class_order(F.col("class_name")).alias("class_order"),
        (F.col("charge") * F.col("multiplier")).alias("charge"), F.date_format("cycle_date", "MMM-yy").alias("data_period"),
        note.alias("comment_text"),
    )


def metrics_report(invoices: DataFrame, promotions: DataFrame, classes: DataFrame) -> DataFrame:
    """Accounts, orders, invoices, cases and amount per invoice date, programme, country and class."""
    shown = classes.where("display AND sku IS NOT NULL").select("class_uuid", "class_name")
    return (
        invoices.join(small(promotions.select("promotion_uuid", "promotion_name", "country")), "promotion_uuid")
        .join(small(shown), "class_uuid")
        .groupBy("invoice_date", "promotion_name", "country", "class_name")
        .agg(
            F.count_distinct("account_uuid").alias("n_accounts"), F.count("sales_order").alias("n_orders"),
            F.count("invoice_number").alias("n_invoices"), F.count("case_number").alias("n_cases"), F.sum("amount").alias("total_amount"),
        )
    )


def eligible_with_subscription(cycles: DataFrame, accounts: DataFrame, subscriptions: DataFrame, promotions: DataFrame, cards: DataFrame, bucket: str = "365 days") -> DataFrame:
    """Error-free cycles inside a current subscription of the same account or sold-to, one row per cycle."""
    clean = cycles.where(F.coalesce("z_code", "error_code", F.lit("NA")) == "NA")
    at = {"at": "cycle_date", "closed": "both", "bucket": bucket}
    located = interval_join(
        clean, accounts.withColumnRenamed("account_uuid", "_a"), ["ship_to"], start="effective", end="termination",
        take={"account_uuid": "_a"}, **at,
    ).where("account_uuid IS NOT NULL")
    programmes = promotions.select("device_type", "promotion_uuid", "promotion_name", "country", F.col("effective").alias("_pf"), F.col("termination").alias("_pt"))
    offered = located.join(small(programmes), "device_type").where(F.col("cycle_date").between(F.col("_pf"), F.col("_pt"))).drop("_pf", "_pt")
    carded = interval_join(
        offered, cards, ["card", "promotion_uuid"], start="effective", end="termination", take={"_card": "card"}, **at
    ).where("_card IS NOT NULL").drop("_card")
    homes = accounts.select("account_uuid", F.col("ship_to").alias("_sub_ship_to"), "promotion_uuid").distinct()
    subs = subscriptions.where("version = 1").join(homes, ["account_uuid", "promotion_uuid"])
    plain = F.coalesce("exception_flag", F.lit("")) == ""
    lanes = [plain, ~plain & (F.col("exception_flag") == "N"), F.col("exception_flag") == "Y"]
    take = {"subscription_uuid": "subscription_uuid", "sub_start": "sub_start", "sub_end": "sub_end",
            "sub_ship_to": "_sub_ship_to", "exception_flag": "exception_flag"}
    rows = []
    for i, keys in enumerate(({"ship_to": "_sub_ship_to"}, {"sold_to": "sold_to"})):
        rows.append(
            interval_join(
                carded, subs, {"consumer_id": "consumer_id", "promotion_uuid": "promotion_uuid", **keys},
                start="sub_start", end="sub_end", take=take, prefer=lanes, tie=["subscription_uuid"], **at,
            ).where("subscription_uuid IS NOT NULL").withColumn("_by", F.lit(i))
        )
    return latest_by(
        rows[0].unionByName(rows[1]), ["cycle_id"],
        [F.col("exception_flag").asc(), F.col("sub_end").desc(), F.col("subscription_uuid").desc(), F.col("_by").asc()],
    ).drop("_by")


def different_sold_to(details: DataFrame, subscriptions: DataFrame, accounts: DataFrame, classes: DataFrame, consumers: DataFrame) -> DataFrame:
    """Lines of subscriptions used at several accounts and several sold-tos, labelled against the first visit."""
    homes = accounts.select("account_uuid", "ship_to").dropDuplicates(["account_uuid"])
    lines = details.where("version = 1").join(small(classes.select("class_uuid", "class_name", "calc_type")), "class_uuid").join(homes, "account_uuid")
    spread = (
        lines.where("calc_type = 'PerSubscription'").groupBy("consumer_id", "subscription_uuid")
        .agg(F.count_distinct("ship_to").alias("_ship_tos"), F.count_distinct("sold_to").alias("_sold_tos"))
        .where("_ship_tos > 1 AND _sold_tos > 1").select("consumer_id", "subscription_uuid")
    )
    opened = subscriptions.where("version = 1").join(homes, "account_uuid").select(
        "subscription_uuid", F.col("ship_to").alias("initial_ship_to"), F.col("sold_to").alias("initial_sold_to"), "sub_start", "sub_end"
    )
    other_ship, other_sold = F.col("initial_ship_to") != F.col("ship_to"), F.col("sold_to") != F.col("initial_sold_to")
    label = (
        F.when(other_ship & other_sold, "DifferentShipToDifferentSoldTo").when(other_sold, "SameShipToDifferentSoldTo")
        .when(other_ship, "DifferentShipToSameSoldTo").when(~other_ship & ~other_sold, "SameShipToSameSoldTo").otherwise("Unknown")
    )
    return (
        lines.join(spread, ["consumer_id", "subscription_uuid"]).join(opened, "subscription_uuid")
        .join(consumers.select("consumer_id", "scanned_id"), "consumer_id", "left")
        .select("consumer_id", "scanned_id", "ship_to", "sold_to", "class_name", "cycle_date", "cycle_count", "initial_ship_to", "initial_sold_to",
                F.col("sub_start").alias("initial_visit"), F.col("sub_end").alias("final_visit"), label.alias("sold_to_comment"))
    )


def non_compliance(findings: DataFrame, subscriptions: DataFrame, accounts: DataFrame, fraud_classes: DataFrame, promotions: DataFrame, consumers: DataFrame, customers: DataFrame) -> DataFrame:
    """Active non-compliance findings with account, rule and consumer columns."""
    homes = accounts.select("account_uuid", "ship_to", F.col("name").alias("account_name")).dropDuplicates(["account_uuid"])
    used = homes.select(F.col("account_uuid").alias("cycle_account_uuid"), F.col("ship_to").alias("cycle_ship_to"))
    current = subscriptions.where("version = 1").select("subscription_uuid").distinct()
    return (
        findings.where("active").join(current, "subscription_uuid", "left_semi")
        .join(small(promotions.select("promotion_uuid", "promotion_name", "country")), "promotion_uuid")
        .join(homes, "account_uuid").join(used, "cycle_account_uuid")
        .join(small(fraud_classes.select("fraud_class_uuid", "rule_name", "rule_category", "base_limit")), "fraud_class_uuid")
        .join(consumers.select("consumer_id", "scanned_id"), "consumer_id")
        .join(customers.select(F.col("account_id").alias("sold_to"), F.col("name").alias("sold_to_name")), "sold_to", "left")
        .select("sold_to", "sold_to_name", "ship_to", "account_name", "cycle_ship_to", format_id10("consumer_id").alias("phone"), "scanned_id",
                "rule_name", "rule_category", "base_limit", "cycle_count", F.col("cycle_date").alias("exceeded_on"), "promotion_name", "country")
    )


def programme_cards_report(cards: DataFrame, promotions: DataFrame) -> DataFrame:
    return cards.join(small(promotions.select("promotion_uuid", "promotion_name", "country")), "promotion_uuid")


# ---- locations -------------------------------------------------------------


def location_tracking(distances: DataFrame, accounts: DataFrame, red_miles: float = 10.0, bucket: str = "365 days") -> DataFrame:
    """One row per device and day with a distance band and programme flag."""
    one = latest_by(distances, ["external_serial", "seen_on"], [F.col("device_address").desc(), F.col("sap_ship_to").asc()])
    member = interval_join(
        one, accounts.where("per_patient").withColumnRenamed("ship_to", "sap_ship_to"), ["sap_ship_to"],
        at="seen_on", start="effective", end="termination", closed="both", take={"_member": "account_uuid"}, bucket=bucket,
    )
    band = F.when(F.col("miles") >= red_miles, "Red").when(F.col("miles") >= 0, "Green").otherwise("NA")
    return member.withColumns(
        {
            "programme_flag": F.when(F.col("_member").isNotNull() & (F.col("device_type") == "COM3"), "Member").otherwise("Other"),
            "status": band,
            "serial_day": F.concat_ws("_", "external_serial", F.col("seen_on").cast("string")),
        }
    ).drop("_member")


def location_labels(tracking: DataFrame) -> DataFrame:
    """Long form: the device's own and the registered address of each device-day."""
    pairs = F.array(
        F.struct(F.col("device_address").alias("location"), F.lit("Device Location").alias("label")),
        F.struct(F.col("sap_address").alias("location"), F.lit("SAP Location").alias("label")),
    )
    return tracking.select("external_serial", "seen_on", F.explode(pairs).alias("p"), "serial_day").select(
        "external_serial", "seen_on", "p.location", "p.label", "serial_day"
    ).distinct()


def card_mismatch(rows: DataFrame, home: str = "US", abroad: bool = False) -> DataFrame:
    """Cards used at another account, for the home country or for all others."""
    return rows.where(F.col("country") != home) if abroad else rows.where(F.col("country") == home)


def normalised(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: norm_key(c) for c in columns})
