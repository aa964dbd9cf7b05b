"""Queries for reports, masters, log intake and streams on the test tables."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelake.catalog.operators import EVENT_FIELDS, of_type
from usagelake.catalog.registry import Tables, query
from usagelake.functions.columns import zone_offset
from usagelake.functions.jsonmap import FieldMap, flatten_json
from usagelake.operators.dedup import latest_by
from usagelake.operators.upsert import update_if_newer
from usagelake.plans import intake, masters, reports
from usagelake.session import settle, shared_folder
from usagelake.sources.files import parse_header_json, parse_hub_messages
from usagelake.sources.files import stream_table
from usagelake.sources.snapshots import read_buckets
from usagelake.streaming.runner import drain, upsert_batches

# ---- associations ----------------------------------------------------------


@query("file_association", """
    WITH f AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error')
    SELECT p.event_id AS cycle_id, a.event_id AS pre_id,
           (SELECT arg_min(n.event_id, n.ts) FROM f n WHERE n.user_id = p.user_id AND n.ts > p.ts) AS post_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN f a ON p.user_id = a.user_id AND p.ts >= a.ts
""")
def file_association(t: Tables) -> DataFrame:
    serial = F.col("user_id").cast("string")
    cycles = of_type(t, "purchase").select(F.col("event_id").alias("cycle_id"), F.concat(F.lit("dev"), serial).alias("external_serial"), F.col("ts").alias("start_ts"))
    registry = of_type(t, "error").select(
        F.col("event_id").alias("file_id"), F.concat(F.lit("DEV"), serial).alias("external_serial"), F.lit(None).cast("string").alias("internal_serial"),
        F.lit("COM3").alias("device_type"), F.lit("zASSERTx").alias("message_type"), F.date_format("ts", "yyyyMMddHHmmssSSSSSS").alias("file_stamp"),
        F.lit("").alias("file_port"), F.lit("").alias("file_cycle_nbr"), F.col("props").alias("file_path"),
        F.col("ts").alias("log_start"), F.col("ts").alias("log_end"), F.col("ts").alias("updated_at"),
    )
    files = settle(reports.source_files(registry))
    return reports.associate_files(cycles, files, "ASSERT", bucket="7 days").select(
        "cycle_id", F.col("pre_assert_file_id").alias("pre_id"), F.col("post_assert_file_id").alias("post_id")
    )


@query("event_association", """
    WITH c AS (SELECT event_id AS cycle_id, user_id, ts AS s, ts + INTERVAL 1 MINUTE * CAST(floor(value) AS INTEGER) AS e,
                      CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1 AS head FROM events WHERE event_type = 'signup'),
    v AS (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS head FROM events WHERE event_type = 'view'),
    j AS (SELECT c.cycle_id, v.event_id, v.ts, c.s, c.e FROM c JOIN v ON c.user_id = v.user_id AND (v.head = 0 OR v.head = c.head))
    SELECT c.cycle_id,
           (SELECT arg_max(j.event_id, j.ts) FROM j WHERE j.cycle_id = c.cycle_id AND j.ts <= c.s) AS pre_id,
           (SELECT arg_min(j.event_id, j.ts) FROM j WHERE j.cycle_id = c.cycle_id AND j.ts >= c.s) AS post_id,
           (SELECT arg_max(j.event_id, j.ts) FROM j WHERE j.cycle_id = c.cycle_id AND j.ts BETWEEN c.s AND c.e) AS inside_id
    FROM c
""")
def event_association(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    device = [F.col("user_id").cast("string").alias("external_serial"), F.col("user_id").cast("string").alias("internal_serial"), F.lit("COM3").alias("device_type")]
    cycles = of_type(t, "signup").select(
        F.col("event_id").alias("cycle_id"), *device, (k % 3 + 1).alias("head"), F.col("ts").alias("start_ts"), F.col("ts").alias("event_start"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))).alias("event_end"),
    )
    events = of_type(t, "view").select(*device, (k % 4).alias("head"), F.col("ts").alias("event_ts"), F.col("event_id").alias("file_id"))
    out = reports.associate_events(cycles, events, bucket="1 day", origin="2024-01-01", horizon="2024-02-01")
    return out.select(
        "cycle_id", F.col("pre_event_file_id").alias("pre_id"), F.col("post_event_file_id").alias("post_id"), F.col("inside_event_file_id").alias("inside_id")
    )


# ---- devices and files -----------------------------------------------------


@query("device_overview", """
    WITH last AS (SELECT * FROM events WHERE event_type <> 'click'
                  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1),
    sys AS (SELECT user_id, coalesce(max(CASE WHEN event_type = 'signup' THEN props END), 'NoSysLogEntry') AS sim_card, max(ts) AS last_contact,
                   CASE WHEN CAST(max(ts) AS DATE) >= DATE '2024-01-30' - 1 THEN 'Connected' ELSE 'Disconnected' END AS state
            FROM last GROUP BY user_id),
    twin AS (SELECT user_id, ts, event_type AS state FROM events WHERE event_type = 'click' AND value > 450
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
    SELECT CAST(coalesce(twin.user_id, sys.user_id) AS VARCHAR) AS external_serial, coalesce(sys.sim_card, 'NoSysLogEntry') AS sim_card,
           coalesce(twin.state, sys.state) AS connection_state, coalesce(twin.ts, sys.last_contact) AS last_activity
    FROM sys FULL JOIN twin ON sys.user_id = twin.user_id
""")
def device_overview(t: Tables) -> DataFrame:
    serial = F.col("user_id").cast("string")
    state = t.events.where("event_type <> 'click'").select(
        serial.alias("external_serial"), serial.alias("internal_serial"), F.lit("COM3").alias("device_type"), F.col("event_type").alias("contract"),
        F.col("ts").alias("header_ts"), F.col("ts").alias("updated_at"), F.lit(None).cast("string").alias("sw_version"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("sim_card"), F.lit(None).cast("string").alias("rsrp"), F.lit(None).cast("string").alias("rsrq"),
    )
    contacts = state.where("contract = 'none'").select("external_serial", "internal_serial", "sim_card", F.col("header_ts").alias("last_contact"))
    twins = t.events.where("event_type = 'click' AND value > 450").select(
        serial.alias("device_id"), serial.alias("external_serial"), serial.alias("internal_serial"), F.col("event_type").alias("connection_state"),
        F.col("ts").alias("last_activity"), F.lit("enabled").alias("status_flag"), F.lit(1).alias("version_nbr"),
    )
    out = reports.device_overview(state, contacts, twins, datetime(2024, 1, 30), days=1)
    return out.select("external_serial", "sim_card", "connection_state", "last_activity")


@query("lineage", """
    WITH raw AS (SELECT o_custkey AS k, CASE o_orderstatus WHEN 'F' THEN 'Succeeded' WHEN 'O' THEN 'Failed' ELSE 'Skipped' END AS status, o_orderdate AS at,
                        CASE WHEN o_orderpriority < '3' THEN 'UL' ELSE 'ML' END AS log_type FROM orders
                 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END, o_orderdate DESC, log_type, status) = 1),
    silver AS (SELECT l_partkey AS k, CASE l_returnflag WHEN 'N' THEN 'Duplicate' WHEN 'R' THEN 'InProgress' ELSE 'Odd' END AS status, l_shipdate AS at FROM lineitem
               QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, status) = 1)
    SELECT CAST(coalesce(raw.k, silver.k) AS VARCHAR) AS raw_file,
           CASE raw.status WHEN 'Skipped' THEN 'NotApplicable' ELSE raw.status END AS raw_status, raw.at AS raw_at,
           CASE WHEN raw.log_type <> 'UL' OR raw.status = 'Skipped' THEN 'NotApplicable'
                ELSE CASE silver.status WHEN 'Duplicate' THEN 'Succeeded' WHEN 'Odd' THEN 'NotApplicable' ELSE silver.status END END AS silver_status
    FROM raw FULL JOIN silver ON raw.k = silver.k
""")
def lineage(t: Tables) -> DataFrame:
    def log(df: DataFrame, key: str, status, at: str, log_type) -> DataFrame:
        name = F.col(key).cast("string")
        return df.select(
            F.lit("c").alias("source_container"), F.lit("raw").alias("source_folder"), name.alias("source_file"), F.lit("d").alias("dest_container"),
            F.lit("raw").alias("dest_folder"), name.alias("dest_file"), F.lit(1).alias("source_type"), status.alias("status"), F.col(at).alias("created_at"), log_type.alias("log_type"),
        )

    s, f = F.col("o_orderstatus"), F.col("l_returnflag")
    raw = log(t.orders, "o_custkey", F.when(s == "F", "Succeeded").when(s == "O", "Failed").otherwise("Skipped"), "o_orderdate",
              F.when(F.col("o_orderpriority") < "3", "UL").otherwise("ML"))
    silver = log(t.lineitem, "l_partkey", F.when(f == "N", "Duplicate").when(f == "R", "InProgress").otherwise("Odd"), "l_shipdate", F.lit("UL"))
    return reports.lineage(raw, silver).select("raw_file", "raw_status", "raw_at", "silver_status")


@query("missing_cycles", """
    WITH c AS (SELECT DISTINCT l_suppkey AS card, l_linenumber * 1000 + CAST(l_quantity AS INTEGER) AS n FROM lineitem),
    g AS (SELECT card, n, lag(n) OVER (PARTITION BY card ORDER BY n) AS p, min(n) OVER (PARTITION BY card) AS lo, max(n) OVER (PARTITION BY card) AS hi FROM c),
    x AS (SELECT card, unnest(generate_series(p + 1, n - 1)) AS missing, lo, hi FROM g WHERE n - p > 1)
    SELECT CAST(card AS VARCHAR) AS card, count(*) AS n_missing, CAST(sum(missing) AS BIGINT) AS total, any_value(lo) AS min_cycle, any_value(hi) AS max_cycle, any_value(s_nationkey) AS ship_to
    FROM x JOIN supplier ON card = s_suppkey GROUP BY card
""")
def missing_cycles(t: Tables) -> DataFrame:
    cycles = t.lineitem.select(
        F.lit("COM3").alias("device_type"), F.col("l_suppkey").cast("string").alias("card"),
        (F.col("l_linenumber") * 1000 + F.col("l_quantity").cast("int")).alias("cycle_nbr"), F.col("l_shipdate").alias("begin_ts"),
    )
    owners = t.supplier.select(F.col("s_suppkey").cast("string").alias("serial"), F.col("s_nationkey").alias("ship_to"))
    return reports.missing_cycles(cycles, owners).groupBy("card").agg(
        F.count(F.lit(1)).alias("n_missing"), F.sum("missing_cycle").alias("total"), F.min("min_cycle").alias("min_cycle"),
        F.max("max_cycle").alias("max_cycle"), F.max("ship_to").alias("ship_to"),
    )


@query("local_dates", """
    SELECT event_id, CAST(ts + INTERVAL 1 HOUR * (CAST(user_id % 24 AS INTEGER) - 12) AS DATE) AS local_date FROM events
""")
def local_dates(t: Tables) -> DataFrame:
    hours = (F.col("user_id") % 24 - 12).cast("int")
    sign = F.when(hours < 0, "-").otherwise("")
    zone = F.concat(F.lit("Some Zone (UTC"), sign, F.lpad(F.abs(hours).cast("string"), 2, "0"), F.lit(":00:00)"))
    offset = zone_offset(zone)
    return t.events.select("event_id", F.from_utc_timestamp(F.col("ts").cast("timestamp"), offset).cast("date").alias("local_date"))


@query("distance_band", """
    WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, props, value / 25 AS miles FROM events
               QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY props DESC, value, event_id) = 1)
    SELECT CAST(user_id AS VARCHAR) AS external_serial, day AS seen_on, CASE WHEN miles >= 10 THEN 'Red' ELSE 'Green' END AS status,
           user_id || '_' || day AS serial_day, CASE WHEN user_id % 25 < 10 AND day >= DATE '2024-01-10' THEN 'Member' ELSE 'Other' END AS programme_flag
    FROM d
""")
def distance_band(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.col("user_id").cast("string").alias("external_serial"), F.col("ts").cast("date").alias("seen_on"), F.lit("COM3").alias("device_type"),
        F.col("props").alias("device_address"), F.format_string("%02d|%010.2f|%010d", F.col("user_id") % 25, F.col("value"), F.col("event_id")).alias("sap_ship_to"),
        (F.col("value") / 25).alias("miles"), (F.col("user_id") % 25).cast("string").alias("site"),
    )
    accounts = t.nation.where("n_nationkey < 10").select(
        F.col("n_nationkey").cast("string").alias("ship_to"), F.col("n_name").alias("account_uuid"), F.lit(True).alias("per_patient"),
        F.lit("2024-01-10").cast("date").alias("effective"), F.lit("2111-11-11").cast("date").alias("termination"),
    )
    one = latest_by(rows, ["external_serial", "seen_on"], [F.col("device_address").desc(), F.col("sap_ship_to").asc()])
    tracked = reports.location_tracking(one.withColumn("sap_ship_to", F.col("site")), accounts, bucket="30 days")
    return tracked.select("external_serial", "seen_on", "status", "serial_day", "programme_flag")


@query("location_labels", """
    WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, props FROM events)
    SELECT CAST(user_id AS VARCHAR) AS external_serial, day AS seen_on, location, label FROM (
        SELECT user_id, day, props AS location, 'Device Location' AS label FROM d UNION SELECT user_id, day, 'S' || user_id, 'SAP Location' FROM d)
""")
def location_labels(t: Tables) -> DataFrame:
    serial = F.col("user_id").cast("string")
    tracked = t.events.select(
        serial.alias("external_serial"), F.col("ts").cast("date").alias("seen_on"), F.col("props").alias("device_address"),
        F.concat(F.lit("S"), serial).alias("sap_address"), serial.alias("serial_day"),
    )
    return reports.location_labels(tracked).drop("serial_day")


@query("metrics_report", """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS invoice_date, o_orderstatus AS promotion_name, 'US' AS country, o_orderpriority AS class_name,
           count(DISTINCT c_nationkey) AS n_accounts, count(nullif(o_custkey, 0)) AS n_orders, count(CASE WHEN o_totalprice > 200000 THEN 1 END) AS n_invoices,
           count(*) AS n_cases, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW' GROUP BY ALL
""")
def metrics_report(t: Tables) -> DataFrame:
    invoices = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.trunc("o_orderdate", "month").alias("invoice_date"), F.col("o_orderstatus").alias("promotion_uuid"), F.col("o_orderpriority").alias("class_uuid"),
        F.col("c_nationkey").alias("account_uuid"), F.expr("nullif(o_custkey, 0)").alias("sales_order"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderkey")).alias("invoice_number"), F.col("o_orderkey").alias("case_number"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )
    promotions = t.orders.select(F.col("o_orderstatus").alias("promotion_uuid"), F.col("o_orderstatus").alias("promotion_name"), F.lit("US").alias("country")).distinct()
    classes = t.orders.select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("class_uuid"), F.col("o_orderpriority").alias("class_name"), F.lit(True).alias("display"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit("sku")).alias("sku"),
    )
    out = reports.metrics_report(invoices, promotions, classes)
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


# ---- masters ---------------------------------------------------------------


def equipment_moves(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey", "l_shipdate").agg(F.min("l_suppkey").alias("ship_to"), F.min("l_returnflag").alias("flag"))


def equipment_changes(moved: DataFrame, known: Column | None = None) -> DataFrame:
    """Lines as equipment changes: a part is a serial, a ship date a change, returned lines are back in the warehouse."""
    return moved.select(
        F.concat(F.lit("E"), F.col("l_partkey").cast("string")).alias("equipment_key"), F.when(F.lit(True) if known is None else known, F.concat(F.lit(" p"), F.col("l_partkey").cast("string"))).alias("serial"),
        F.lit("MAT01").alias("material"), F.when(F.dayofmonth("l_shipdate") != 1, F.date_format("l_shipdate", "yyyyMMdd")).otherwise("00000000").alias("changed_on"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("created_on"), F.lit("OK").alias("status"),
        F.when(F.col("flag") == "R", "IN WAREHOUSE").otherwise("SHIPPED").alias("transit_status"), F.col("ship_to").cast("string").alias("ship_to"),
        F.col("ship_to").cast("string").alias("sold_to"), F.lit("b1").alias("mfg_batch"), F.lit("x/BW/f.csv").alias("file_path"),
        F.lit(datetime(2024, 1, 1)).alias("created_at"), F.lit(None).cast("bigint").alias("load_order"),
    )


@query("equipment_history", """
    WITH m AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, min(l_suppkey) AS ship_to, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL)
    SELECT 'P' || l_partkey AS serial, d AS ship_start, lead(d, 1, DATE '2111-11-11') OVER w AS ship_end, CAST(ship_to AS VARCHAR) AS ship_to,
           row_number() OVER (PARTITION BY l_partkey ORDER BY d DESC) AS load_order,
           CASE WHEN flag = 'R' AND lag(flag) OVER w <> 'R' THEN 'RETURNED' WHEN flag = 'R' THEN 'IN WAREHOUSE' ELSE 'SHIPPED' END AS movement_status,
           CASE WHEN flag = 'R' AND lag(flag) OVER w <> 'R' THEN d END AS return_date
    FROM m WINDOW w AS (PARTITION BY l_partkey ORDER BY d)
""")
def equipment_history(t: Tables) -> DataFrame:
    changes = masters.clean_equipment(equipment_changes(equipment_moves(t)))
    empty = changes.limit(0).withColumns(
        {"ship_end": F.lit(None).cast("date"), "movement_status": F.lit(None).cast("string"), "return_date": F.lit(None).cast("date")}
    )
    out = masters.equipment_history(empty, changes)
    return out.select("serial", "ship_start", "ship_end", "ship_to", "load_order", "movement_status", "return_date")


@query("equipment_splice", """
    WITH m AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, min(l_suppkey) AS ship_to, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
    s AS (SELECT *, CASE WHEN min(ship_to) OVER (PARTITION BY l_partkey) > 2 THEN 'P' || l_partkey ELSE 'UNKNOWN' END AS serial, day(d) > 20 AS late FROM m)
    SELECT serial, d AS ship_start, lead(d, 1, DATE '2111-11-11') OVER w AS ship_end, CAST(ship_to AS VARCHAR) AS ship_to,
           count(*) OVER (PARTITION BY serial) - row_number() OVER w + 1 AS load_order,
           CASE WHEN flag = 'R' AND lag(flag) OVER w <> 'R' THEN 'RETURNED' WHEN flag = 'R' THEN 'IN WAREHOUSE' ELSE 'SHIPPED' END AS movement_status,
           CASE WHEN flag = 'R' AND lag(flag) OVER w <> 'R' THEN d END AS return_date
    FROM s WINDOW w AS (PARTITION BY serial ORDER BY d, late, 'E' || l_partkey)
""")
def equipment_splice(t: Tables) -> DataFrame:
    """Changes of the last third of each month come late into a filled history, and then once more; many parts have no serial."""
    # A part has one row a day at most, so that none is too much for one task.
    moved = equipment_moves(t).where("l_partkey IS NOT NULL").withColumn("least", F.min("ship_to").over(Window.partitionBy("l_partkey")))
    changes = masters.clean_equipment(equipment_changes(moved, known=F.col("least") > 2))
    # Stored steps hide from Catalyst that nothing below reads the other columns.
    changes = settle(changes.drop("material", "created_on", "status", "sold_to", "mfg_batch", "file_path"))
    empty = changes.limit(0).withColumns(
        {"ship_end": F.lit(None).cast("date"), "movement_status": F.lit(None).cast("string"), "return_date": F.lit(None).cast("date")}
    )
    late = changes.where("dayofmonth(ship_start) > 20")
    history = settle(masters.equipment_history(empty, changes.where("dayofmonth(ship_start) <= 20")))
    history = settle(masters.equipment_history(history, late))
    history = masters.equipment_history(history, late)
    return history.select("serial", "ship_start", "ship_end", "ship_to", "load_order", "movement_status", "return_date")


@query("territories", """
    SELECT c_nationkey AS account_id, min(c_mktsegment) AS territory FROM customer WHERE c_mktsegment LIKE '%U%' GROUP BY c_nationkey
""")
def territories(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_nationkey").alias("account_id"), F.col("c_mktsegment").alias("territory"))
    return masters.territories(rows, pattern="%U%")


@query("account_hierarchy", """
    WITH t AS (SELECT o_custkey AS ship_to, nullif(o_orderstatus, 'P') AS sold_to, o_orderpriority AS payer, year(o_orderdate) AS effective, max(o_orderdate) AS termination
               FROM orders WHERE o_orderdate < '2000-06-01' GROUP BY ALL),
    s AS (SELECT o_custkey AS ship_to, nullif(o_orderstatus, 'P') AS sold_to, o_orderpriority AS payer, year(o_orderdate) AS effective, max(o_orderdate) AS termination
          FROM orders WHERE o_orderdate >= '2000-01-01' GROUP BY ALL)
    SELECT coalesce(t.ship_to, s.ship_to) AS ship_to, coalesce(t.sold_to, s.sold_to) AS sold_to, coalesce(t.payer, s.payer) AS payer,
           coalesce(t.effective, s.effective) AS effective, coalesce(s.termination, t.termination) AS termination
    FROM t FULL JOIN s ON t.ship_to = s.ship_to AND t.payer = s.payer AND t.effective = s.effective AND t.sold_to IS NOT DISTINCT FROM s.sold_to
""")
def account_hierarchy(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_custkey").alias("ship_to"), F.expr("nullif(o_orderstatus, 'P')").alias("sold_to"), F.col("o_orderpriority").alias("payer"),
        F.year("o_orderdate").alias("effective"), F.col("o_orderdate").alias("termination"), F.lit(True).alias("is_current"), F.col("o_orderdate").alias("updated_at"),
    )
    old = latest_by(rows.where("termination < '2000-06-01'"), masters.HIERARCHY_KEYS, [F.col("termination").desc()])
    out = masters.account_hierarchy(old, rows.where("termination >= '2000-01-01'"))
    return out.drop("is_current", "updated_at")


def twin_message(df: DataFrame, operation: str, version, filter_text, part: str, app, at: str = "ts") -> DataFrame:
    """Rows as twin messages of the hub."""
    reported = F.struct(filter_text.alias("FluidFilter"), F.struct(F.struct(F.struct(app[0].alias("mj"), app[1].alias("md"), app[2].alias("mn")).alias("fw")).alias("App1")).alias(part))
    twin = F.to_json(F.struct(version.cast("string").alias("version"), F.struct(reported.alias("reported")).alias("properties")))
    body = F.struct(F.encode(twin, "utf-8").alias("body"), F.create_map(F.lit("deviceId"), F.concat(F.lit("d"), F.col("user_id").cast("string")), F.lit("opType"), F.lit(operation)).alias("properties"))
    hub = parse_hub_messages(df.select(body.alias("m"), at).select("m.*", at))
    return hub.select("device_id", F.col("body").alias("twin_json"), "operation_type", F.col(at).alias("operation_ts"))


def twin_views(t: Tables) -> DataFrame:
    return twin_message(
        of_type(t, "view").where("value > 150"), "updateTwin", F.col("event_id"), F.when(F.col("value") > 200, F.col("props")),
        "softwareVersions", [F.lit("2"), F.lpad(F.col("event_id").cast("string"), 9, "0"), F.lit("1")],
    )


@query("twin_merge", """
    WITH full_load AS (SELECT user_id, event_id, value FROM events WHERE event_type = 'signup'
                       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    chg AS (SELECT user_id, max(event_id) AS version, max(CASE WHEN value > 200 THEN props END) AS filter FROM events WHERE event_type = 'view' AND value > 150 GROUP BY user_id)
    SELECT 'D' || f.user_id AS device_id, coalesce(c.version, f.event_id) AS version_nbr, coalesce(c.filter, '{"k": -1}') AS fluid_filter,
           CASE WHEN c.user_id IS NULL THEN '1.0.0' ELSE '2.' || lpad(CAST(c.version AS VARCHAR), 9, '0') || '.1' END AS app1_version
    FROM full_load f LEFT JOIN chg c ON f.user_id = c.user_id
""")
def twin_merge(t: Tables) -> DataFrame:
    first = twin_message(of_type(t, "signup"), "FullLoad", F.col("event_id"), F.lit('{"k": -1}'), "Versions", [F.lit("1"), F.lit("0"), F.lit("0")])
    messages = settle(first.unionByName(twin_views(t)))
    empty = masters.parse_twin(messages.limit(0)).drop("twin_json", "operation_type", "operation_ts", "has_versions")
    return masters.merge_twins(empty, messages).select("device_id", "version_nbr", "fluid_filter", "app1_version")


@query("twin_epochs", """
    WITH signup AS (SELECT user_id, event_id, date_trunc('month', ts) + INTERVAL 10 DAY AS run FROM events WHERE event_type = 'signup'),
    runs AS (SELECT DISTINCT run FROM signup),
    held AS (SELECT user_id, max(event_id) AS version FROM events WHERE event_type = 'purchase' AND value > 300 GROUP BY user_id),
    born AS (SELECT user_id, run, event_id FROM signup WHERE user_id NOT IN (SELECT user_id FROM held)
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY run, event_id DESC) = 1),
    base AS (SELECT user_id, TIMESTAMP '0001-01-01' AS since, version, '{"k": -2}' AS filter FROM held
             UNION ALL SELECT user_id, run, event_id, '{"k": -1}' FROM born),
    chg AS (SELECT e.user_id, coalesce(r.run, TIMESTAMP '0001-01-01') AS epoch, max(e.event_id) AS version, max(CASE WHEN e.value > 200 THEN e.props END) AS filter
            FROM (SELECT * FROM events WHERE event_type = 'view' AND value > 150) e ASOF LEFT JOIN runs r ON e.ts >= r.run GROUP BY ALL)
    SELECT 'D' || b.user_id AS device_id, coalesce(arg_max(c.version, c.epoch), b.version) AS version_nbr,
           coalesce(arg_max(c.filter, c.epoch) FILTER (c.filter IS NOT NULL), b.filter) AS fluid_filter,
           CASE WHEN count(c.version) = 0 THEN '1.0.0' ELSE '2.' || lpad(CAST(arg_max(c.version, c.epoch) AS VARCHAR), 9, '0') || '.1' END AS app1_version
    FROM base b LEFT JOIN chg c ON c.user_id = b.user_id AND c.epoch >= b.since GROUP BY b.user_id, b.version, b.filter
""")
def twin_epochs(t: Tables) -> DataFrame:
    """A full load each month loads who signed up in it, changes come in between; dear purchases were in the target before."""
    run = F.date_trunc("month", "ts") + F.expr("INTERVAL 10 DAYS")
    first = [F.lit("1"), F.lit("0"), F.lit("0")]
    held = of_type(t, "purchase").where("value > 300").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max("ts").alias("ts"))
    known = masters.parse_twin(twin_message(held, "FullLoad", F.col("event_id"), F.lit('{"k": -2}'), "Versions", first))
    target = settle(known.drop("twin_json", "operation_type", "operation_ts", "has_versions"))
    loads = twin_message(of_type(t, "signup").withColumn("run", run), "FullLoad", F.col("event_id"), F.lit('{"k": -1}'), "Versions", first, at="run")
    messages = settle(loads.unionByName(twin_views(t)))
    return masters.merge_twin_epochs(target, messages).select("device_id", "version_nbr", "fluid_filter", "app1_version")


@query("consumer_numbers", """
    SELECT count(*) AS n, min(CAST(o_custkey AS VARCHAR)) AS lowest, count(*) AS top FROM (SELECT DISTINCT o_custkey FROM orders)
""")
def consumer_numbers(t: Tables) -> DataFrame:
    ids = t.orders.select(F.col("o_custkey").cast("string").alias("consumer_id"))
    empty = t.spark.createDataFrame([], "consumer_id string, scanned_id bigint")
    numbered = masters.number_consumers(empty, ids)
    return numbered.agg(F.count_distinct("scanned_id").alias("n"), F.min("consumer_id").alias("lowest"), F.max("scanned_id").alias("top"))


# ---- log intake ------------------------------------------------------------


def log_lines(t: Tables) -> DataFrame:
    """Events as raw log lines: nine header fields and the payload, one file per user and type."""
    contract = F.when(F.col("event_type") == "signup", "14020").when(F.col("event_type") == "purchase", "14023").when(
        F.col("event_type") == "error", "15008"
    ).otherwise("25003:1")
    compact = F.date_format("ts", "yyyyMMddHHmmss")
    payload = F.when(F.col("event_type") == "signup", F.format_string('{"startts": "%s", "prodtype": "T,3", "timezone": "UTC"}', compact)).when(
        F.col("event_type") == "purchase", F.format_string('{"endts": "%s"}', F.date_format("ts", "yyyy-MM-dd,HH:mm:ss"))
    ).otherwise(F.col("props"))
    kind = F.when(F.col("event_type") == "click", "ML").otherwise("UL")
    name = F.format_string("com3_sn %d_%s_20240101000000_1.csv", F.col("user_id"), kind)
    value = F.concat_ws(
        ",", F.lit("2"), F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss.SSS"), F.lit("LOG"), F.lit("a"), F.lit("b"), F.lit("c"),
        F.lit("9"), contract, payload,
    )
    return t.events.select(
        value.alias("value"), name.alias("file_name"), F.concat(F.lit("raw/x/int"), F.col("user_id").cast("string"), F.lit("/"), name).alias("file_path"),
        F.lit(10).cast("bigint").alias("file_size"), F.lit(datetime(2024, 2, 1)).alias("file_mtime"),
    )


def log_rows(t: Tables) -> DataFrame:
    return intake.typed_log_rows(parse_header_json(log_lines(t)), ("UL",))


@query("log_intake", """
    SELECT 'SN' || user_id AS external_serial, 'INT' || user_id AS internal_serial,
           CASE event_type WHEN 'signup' THEN '14020' WHEN 'purchase' THEN '14023' WHEN 'error' THEN '15008' ELSE '25003:1' END AS contract,
           CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS head, count(*) AS n, min(date_trunc('millisecond', ts)) AS first_ts,
           min(CASE WHEN event_type IN ('error', 'view') THEN props END) AS low_payload
    FROM events WHERE event_type <> 'click' GROUP BY ALL
""")
def log_intake(t: Tables) -> DataFrame:
    return log_rows(t).groupBy("external_serial", "internal_serial", "contract", "head").agg(
        F.count(F.lit(1)).alias("n"), F.min("header_ts").cast("timestamp_ntz").alias("first_ts"),
        F.min(F.when(F.col("contract").isin("15008", "25003:1"), F.col("payload"))).alias("low_payload"),
    )


@query("log_times", """
    SELECT user_id, date_trunc('second', min(CASE WHEN event_type = 'signup' THEN ts END)) AS log_start,
           date_trunc('second', max(CASE WHEN event_type = 'purchase' THEN ts END)) AS log_end, 'T,3' AS product_type
    FROM events GROUP BY user_id
""")
def log_times(t: Tables) -> DataFrame:
    rows = log_rows(t)
    names = rows.select("file_id", F.regexp_extract("file_name", r"sn (\d+)_", 1).cast("bigint").alias("user_id")).distinct()
    return intake.log_times(rows).join(names, "file_id").select(
        "user_id", F.col("log_start").cast("timestamp_ntz").alias("log_start"), F.col("log_end").cast("timestamp_ntz").alias("log_end"), "product_type"
    )


@query("file_registry", """
    SELECT 'com3_sn ' || user_id || '_UL_20240101000000_1.csv' AS file_name, count(*) AS record_count, 'Succeeded' AS status,
           date_trunc('second', min(CASE WHEN event_type = 'signup' THEN ts END)) AS log_start
    FROM events WHERE event_type <> 'click' GROUP BY user_id
""")
def file_registry(t: Tables) -> DataFrame:
    rows = log_rows(t)
    at = datetime(2024, 2, 1)
    batch = settle(intake.registry_rows(rows, "InProgress", 7, "run1", at))
    opened = intake.open_files(batch.limit(0), batch)
    closed = intake.close_files(opened, intake.log_times(rows), "Succeeded", None, at)
    return closed.select("file_name", "record_count", "status", F.col("log_start").cast("timestamp_ntz").alias("log_start"))


@query("device_state", """
    SELECT 'SN' || user_id AS external_serial, CASE event_type WHEN 'error' THEN '15008' ELSE '25003:1' END AS contract, date_trunc('millisecond', ts) AS header_ts,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE event_type IN ('error', 'view')
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('millisecond', ts) DESC) = 1
""")
def device_state(t: Tables) -> DataFrame:
    fields = [FieldMap("state", "*", ("k",), "k", "int"), FieldMap("state", "*", ("sim", "k"), "sim_card"), FieldMap("state", "*", ("pwr",), "power_on_text"),
              FieldMap("state", "*", ("crsp",), "signal_text")]
    rows = log_rows(t).where(F.col("contract").isin("15008", "25003:1"))
    return intake.device_state(rows, fields).select("external_serial", "contract", F.col("header_ts").cast("timestamp_ntz").alias("header_ts"), "k")


@query("history_insert", """
    SELECT DISTINCT user_id, event_type, props FROM events
""")
def history_insert(t: Tables) -> DataFrame:
    from usagelake.operators.dedup import hashed_history

    rows = t.events.select("user_id", "event_type", "props", "event_id")
    target = hashed_history(rows.where("event_type < 'p'"), ["event_id"])
    return intake.history_fact(target, rows, ["event_id"]).select("user_id", "event_type", "props")


# ---- streams ---------------------------------------------------------------


@query("stream_latest_state", """
    SELECT user_id, event_type, event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_latest_state(t: Tables) -> DataFrame:
    """Events drained through a file stream, each micro-batch merged into the state table."""
    keys = ["user_id", "event_type"]

    def state(batch: DataFrame) -> DataFrame:
        last = latest_by(batch, keys, [F.col("ts").desc(), F.col("event_id").desc()])
        return flatten_json(last, "props", EVENT_FIELDS[:1]).select("user_id", "event_type", "event_id", "ts", "k")

    root = f"{shared_folder(t.spark)}/stream-{uuid4().hex}"
    empty = state(t.events).limit(0)
    merge = upsert_batches(
        f"{root}/state", empty, lambda old, new: update_if_newer(old, state(new), keys, "ts"), stream="events", keys=keys, buckets=16)
    drain(stream_table(t.spark, f"{t.folder}/events*.parquet", t.events.schema, max_files=1), merge, f"{root}/checkpoint")
    return read_buckets(t.spark, f"{root}/state", empty)
