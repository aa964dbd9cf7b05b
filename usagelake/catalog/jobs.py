"""Queries that run the composite jobs over the whole test tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog import business as Z
from usagelake.catalog.registry import Tables, query
from usagelake.constants import RULE_CONSUMER
from usagelake.functions.columns import parse_tagged_text, unmask
from usagelake.functions.jsonmap import FieldMap
from usagelake.operators.temporal import scd2_from_changes
from usagelake.plans import billing as B
from usagelake.plans import cycles as C
from usagelake.plans import intake, masters, reports
from usagelake.session import settle
from usagelake.sources.manifest import classify_archives

# ---- cycles ----------------------------------------------------------------


@query("gen3_cycles", """
    WITH own AS (
        SELECT o_custkey, d, lead(d, 1, DATE '2111-11-11') OVER (PARTITION BY o_custkey ORDER BY d) AS until, day(d) % 4 <> 0 AS shipped
        FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)),
    rec AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) + 3 AS day, o_orderdate + INTERVAL 3 DAY AS at, o_orderstatus, length(o_orderpriority) AS nbr,
                   (SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS card FROM orders)
    SELECT r.o_orderkey AS file_id, CAST(r.card AS VARCHAR) AS card, r.nbr AS cycle_nbr, CASE WHEN r.o_orderstatus <> 'P' THEN r.o_orderstatus END AS final_status,
           CASE WHEN o.o_custkey IS NULL THEN '0000000000' ELSE CAST(o.d AS VARCHAR) END AS ship_to, CASE WHEN o.o_custkey IS NULL THEN 0 ELSE 1 END AS device_shipped,
           CASE WHEN p.p_partkey IS NULL THEN 0 ELSE 1 END AS card_shipped, p.p_brand AS card_material, r.at + INTERVAL 1 HOUR AS event_end
    FROM rec r LEFT JOIN own o ON o.o_custkey = r.o_custkey AND o.shipped AND r.day >= o.d AND r.day < o.until
    LEFT JOIN part p ON p.p_partkey = r.card AND r.day >= DATE '1996-01-01' + p.p_size * 10 AND r.day < DATE '2001-01-01'
    QUALIFY row_number() OVER (PARTITION BY r.o_custkey, r.at, r.card, r.nbr ORDER BY r.o_orderkey) = 1
""")
def gen3_cycles(t: Tables) -> DataFrame:
    cards = t.lineitem.groupBy("l_orderkey").agg(F.min("l_partkey").cast("string").alias("card"))
    orders = t.orders.join(cards, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    at = (F.col("o_orderdate") + F.make_dt_interval(days=F.lit(3))).cast("timestamp")
    device = F.concat(F.lit("E"), F.col("o_custkey").cast("string"))

    def record(df: DataFrame, contract: str, payload) -> DataFrame:
        return df.select(
            F.format_string("%012d", "o_orderkey").alias("file_id"), F.lit("p").alias("file_path"), F.lit(contract).alias("contract"), F.lit(1).alias("head"),
            at.cast("date").alias("header_date"), at.alias("header_ts"), device.alias("external_serial"), F.lit("I").alias("internal_serial"), F.to_json(payload).alias("payload"),
        )

    starts = record(orders, "25003:1", F.struct("card", F.length("o_orderpriority").alias("nbr")))
    ends = record(orders.where("o_orderstatus <> 'P'"), "25004:1", F.struct(F.col("o_orderstatus").alias("st")))
    rows = settle(starts.unionByName(ends))
    times = rows.groupBy("file_id").agg(F.min("header_ts").alias("log_start"), (F.max("header_ts") + F.make_dt_interval(hours=F.lit(1))).alias("log_end"))
    days = t.orders.select(device.alias("serial"), F.col("o_orderdate").cast("date").alias("ship_start")).distinct()
    devices = scd2_from_changes(days, "serial", ["ship_start"], start="ship_start", end="ship_end").select(
        "serial", "ship_start", "ship_end", F.when(F.dayofmonth("ship_start") % 4 != 0, "SHIPPED").otherwise("IN WAREHOUSE").alias("transit_status"),
        F.col("ship_start").cast("string").alias("ship_to"), F.lit("x").alias("sold_to"), F.lit("m").alias("material"),
    )
    held = t.part.select(
        F.col("p_partkey").cast("string").alias("serial"), F.date_add(F.lit(date(1996, 1, 1)), F.col("p_size") * 10).alias("ship_start"), F.lit(date(2001, 1, 1)).alias("ship_end"),
        F.lit("SHIPPED").alias("transit_status"), F.lit("x").alias("ship_to"), F.lit("x").alias("sold_to"), F.col("p_brand").alias("material"),
    )
    fields = [FieldMap("c", "s", ("card",), "card"), FieldMap("c", "s", ("nbr",), "cycle_nbr", "int")], [FieldMap("c", "e", ("st",), "final_status")]
    built = C.build_cycles(rows, C.GEN3, *fields, times=times, equipment=settle(devices.unionByName(held)), first_id=1000)
    return built.select(
        F.col("file_id").cast("bigint").alias("file_id"), "card", "cycle_nbr", "final_status", "ship_to", "device_shipped", "card_shipped", "card_material",
        F.col("event_end").cast("timestamp_ntz").alias("event_end"),
    )


@query("gen1_cycles", """
    WITH e AS (SELECT event_id AS line, 'u' || user_id AS f, date_trunc('second', ts) AS ts, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS cnt, value FROM events),
    marks AS (SELECT f, min(CASE WHEN event_type = 'click' THEN ts END) AS first_mark, max(CASE WHEN event_type = 'error' THEN ts END) AS last_mark FROM e GROUP BY f),
    b AS (SELECT *, CASE WHEN event_type = 'signup' OR line % 2 = 0 THEN 'card' || (cnt % 3) END AS raw_card FROM e WHERE event_type IN ('signup', 'view', 'purchase')),
    fb AS (SELECT *, last_value(raw_card IGNORE NULLS) OVER (PARTITION BY f ORDER BY cnt, ts, line) AS card FROM b),
    st AS (SELECT f, cnt, card, count(*) AS n, min(ts) AS first_start, max(ts) AS last_start FROM fb WHERE event_type = 'signup' GROUP BY ALL),
    en0 AS (SELECT f, cnt, card, ts, line, CASE WHEN event_type = 'purchase' THEN 'Successful' ELSE 'Paused' END AS status FROM fb WHERE event_type <> 'signup'),
    en1 AS (SELECT *, max(CASE WHEN status = 'Successful' THEN ts END) OVER (PARTITION BY f, cnt, card) AS done FROM en0),
    en2 AS (SELECT *, row_number() OVER w AS a, row_number() OVER (PARTITION BY f, cnt, card ORDER BY ts DESC, line DESC) AS z FROM en1 WHERE done IS NULL OR ts <= done
            WINDOW w AS (PARTITION BY f, cnt, card ORDER BY ts, line)),
    en3 AS (SELECT *, row_number() OVER (PARTITION BY f, cnt, card ORDER BY ts DESC, line DESC) AS top, count(*) OVER (PARTITION BY f, cnt, card) AS m
            FROM en2 WHERE a = 1 OR z = 1 OR status = 'Successful'),
    j AS (
        SELECT st.*, fin.ts AS end_ts, fin.status AS status,
               CASE WHEN st.n > 1 AND par.ts IS NOT NULL THEN par.ts WHEN ear.m > 1 THEN ear.ts END AS int_start,
               CASE WHEN st.n > 1 AND par.status IS NOT NULL THEN par.status WHEN ear.m > 1 THEN ear.status END AS int_status,
               CASE WHEN st.n > 1 AND par.ts IS NOT NULL THEN last_start END AS int_end
        FROM st LEFT JOIN en3 fin ON fin.f = st.f AND fin.cnt = st.cnt AND fin.card = st.card AND fin.top = 1
        LEFT JOIN en3 par ON par.f = st.f AND par.cnt = st.cnt AND par.card = st.card AND par.top = least(st.n, par.m)
        LEFT JOIN en3 ear ON ear.f = st.f AND ear.cnt = st.cnt AND ear.card = st.card AND ear.top = ear.m),
    k AS (SELECT *, lag(end_ts) OVER w AS before, lead(first_start) OVER w AS after FROM j WINDOW w AS (PARTITION BY f ORDER BY first_start, cnt, card)),
    x AS (
        SELECT k.f, cnt, card, first_start AS begin_ts, coalesce(int_status = 'Successful', FALSE) AS swap, int_start, int_status, int_end, end_ts, status,
               CASE WHEN coalesce(before, first_mark) < first_start THEN coalesce(before, first_mark) ELSE first_start END AS pre_cycle,
               CASE WHEN coalesce(after, last_mark, end_ts) > coalesce(end_ts, TIMESTAMP '1900-01-01') THEN coalesce(after, last_mark) ELSE end_ts END AS post_cycle
        FROM k JOIN marks USING (f)),
    y AS (SELECT *, CASE WHEN swap THEN int_start ELSE end_ts END AS real_end, CASE WHEN swap THEN int_status ELSE status END AS real_status FROM x)
    SELECT f AS file_name, cnt AS cycle_count, card, begin_ts, CASE WHEN real_end >= coalesce(int_end, TIMESTAMP '1900-01-01') THEN real_end END AS end_ts,
           CASE WHEN real_end >= coalesce(int_end, TIMESTAMP '1900-01-01') THEN real_status END AS status,
           CASE WHEN NOT swap THEN int_start END AS interrupt_start, int_end AS interrupt_end, pre_cycle, post_cycle
    FROM y
""")
def gen1_cycles(t: Tables) -> DataFrame:
    count = F.get_json_object("props", "$.k").cast("int") % 20
    kind = F.col("event_type")
    contract = F.when(kind == "click", "~MA").when(kind == "error", "~MM").when(kind == "signup", "~MB").otherwise("~ME")
    own = F.concat(F.lit("card"), (count % 3).cast("string"))
    blank = {f"column{i}": F.lit(None).cast("string") for i in range(5, 27)}
    rows = t.events.select(
        contract.alias("contract"), F.date_format("ts", "M/d/yyyy").alias("event_date"), F.date_format("ts", "HH:mm:ss").alias("event_time"),
        count.cast("string").alias("cycle_count"), F.when((kind == "signup") | (F.col("event_id") % 2 == 0), own).alias("card"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_name"), F.col("event_id").alias("line_no"),
        F.when(kind == "purchase", "Successful").otherwise("Paused").alias("column4"), *[v.alias(k) for k, v in blank.items()],
    )
    got = C.reconstruct_gen1(settle(rows))
    shown = ("begin_ts", "end_ts", "interrupt_start", "interrupt_end", "pre_cycle", "post_cycle")
    return got.select("file_name", "cycle_count", "card", "status", *[F.col(c).cast("timestamp_ntz").alias(c) for c in shown])


# ---- late billing ----------------------------------------------------------


@query("true_up", f"""
    WITH {Z.CYCLES_SQL}, {Z.LIVE_SQL},
    held AS (SELECT cid, account_uuid, sold_to, cycle_date AS s FROM pc WHERE per_cycle = 0 AND cycle_date >= DATE '1998-01-01'
             QUALIFY row_number() OVER (PARTITION BY cid ORDER BY cycle_date, first_ts, account_uuid, visit_id) = 1),
    moved AS (SELECT h.cid, min(p.cycle_date) AS s FROM held h JOIN pc p ON p.cid = h.cid
              WHERE p.cycle_date < DATE '1998-01-01' AND p.per_cycle = 0 AND p.cycle_date > h.s - 150 AND p.cycle_date < h.s GROUP BY h.cid),
    det AS (SELECT p.cid, p.account_uuid, p.cycle_date, sum(p.cycle_count) AS n, CASE WHEN min(p.cycle_date) = any_value(h.s) AND p.account_uuid = any_value(h.account_uuid) THEN 950 ELSE 0 END AS charge
            FROM pc p JOIN held h ON h.cid = p.cid AND p.cycle_date BETWEEN h.s AND h.s + 150 WHERE p.per_cycle = 0 GROUP BY p.cid, p.account_uuid, p.cycle_date),
    o AS (SELECT d.*, CASE WHEN d.cycle_date BETWEEN m.s AND m.s + 150 THEN m.cid END AS cov FROM det d JOIN moved m ON m.cid = d.cid),
    w AS (SELECT *, sum(charge) OVER (PARTITION BY cov) AS amount, row_number() OVER (PARTITION BY cov ORDER BY cycle_date, account_uuid, cid) AS visit_no FROM o),
    c AS (SELECT *, CASE WHEN charge > 0 OR (visit_no = 1 AND amount = 0) THEN 'PerPatientFee' ELSE 'FollowUpVisit' END AS class FROM w)
    SELECT cid AS consumer_id, account_uuid, cycle_date, CAST(n AS BIGINT) AS cycle_count, class, CAST(CASE class WHEN 'PerPatientFee' THEN 950 ELSE 0 END AS DOUBLE) AS charge,
           CASE WHEN cov IS NOT NULL THEN 'LateCycle_SubscriptionAdjust' WHEN class = 'PerPatientFee' THEN 'LateCycle_NewSubscription' ELSE 'LateCycle_FollowUp' END AS comments, 1 AS version
    FROM c
    UNION ALL SELECT cid, account_uuid, cycle_date, CAST(n AS BIGINT), NULL, CAST(charge AS DOUBLE), NULL, CASE WHEN cid IN (SELECT cid FROM o) THEN 2 ELSE 1 END FROM det
""")
def true_up(t: Tables) -> DataFrame:
    ref = Z.reference(t)
    every = settle(Z.visits_of(t, ref, RULE_CONSUMER))
    empty = Z.empty_state(t)
    first = settle(B.flag_visits(every.where("cycle_date >= '1998-01-01'"), empty, ref, RULE_CONSUMER, Z.CLOCK))
    held = settle(B.open_subscriptions(empty.subscriptions, first, ref, RULE_CONSUMER, Z.CLOCK))
    inside = first.where("is_per_cycle = 0").drop("subscription_uuid", "sub_start", "sub_end").join(
        held.select("consumer_id", "subscription_uuid", "sub_start", "sub_end", F.col("account_uuid").alias("home")), "consumer_id"
    ).where(F.col("cycle_date").between(F.col("sub_start"), F.col("sub_end")))
    opening = (F.col("cycle_date") == F.col("sub_start")) & (F.col("account_uuid") == F.col("home"))
    lines = inside.groupBy("subscription_uuid", "consumer_id", "account_uuid", "sold_to", "promotion_uuid", "cycle_date").agg(
        F.sum("cycle_count").alias("cycle_count"), F.max(F.when(opening, 950).otherwise(0)).cast("decimal(18,2)").alias("charge")
    )
    shaped = empty.details.unionByName(
        lines.withColumns({"version": F.lit(1), "detail_uuid": F.concat_ws("|", "account_uuid", "consumer_id", F.col("cycle_date").cast("string"))}), allowMissingColumns=True
    )
    details = settle(shaped.select(*empty.details.columns))
    clock = B.Clock(datetime(1998, 6, 1))
    late = settle(B.flag_visits(every.where("cycle_date < '1998-01-01'"), B.State(held, details), ref, RULE_CONSUMER, clock))
    moved = settle(B.adjust_subscriptions(held, late, ref, clock))
    done = B.true_up_details(late, B.State(moved, details), ref, RULE_CONSUMER, clock)
    return done.select(
        "consumer_id", "account_uuid", "cycle_date", "cycle_count", F.element_at(F.split("class_uuid", ":"), -1).alias("class"),
        F.col("charge").cast("double").alias("charge"), F.when(F.col("version") == 1, F.col("comments")).alias("comments"), "version",
    )


# ---- reports ---------------------------------------------------------------


@query("ownership", """
    WITH last AS (SELECT l_partkey, l_shipdate, l_suppkey, l_orderkey FROM lineitem
                  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_suppkey) = 1)
    SELECT ltrim(lpad(CAST(l.l_partkey AS VARCHAR), 12, '0'), '0') AS external_serial, CAST(l_shipdate AS DATE) AS ship_start, p.p_name AS product_name, s.s_name AS sold_to_name, c.c_name AS ship_to_name, n.n_name AS territory
    FROM last l JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN orders o ON o.o_orderkey = l.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def ownership(t: Tables) -> DataFrame:
    moved = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.format_string("%010d|%05d", "l_orderkey", "l_suppkey").alias("equipment_key"), F.format_string("%012d", "l_partkey").alias("serial"), F.col("l_partkey").alias("material"),
        F.col("l_shipdate").cast("date").alias("ship_start"), F.lit(date(2111, 11, 11)).alias("ship_end"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("ship_to"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("sold_to"),
    )
    accounts = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("account_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city"), F.lit("US").alias("country")).unionByName(
        t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("account_id"), F.col("s_name").alias("name"), F.lit("x").alias("city"), F.lit("US").alias("country"))
    )
    territory = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("account_id"), F.col("n_name").alias("territory"))
    products = t.part.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description"))
    return masters.ownership(moved, products, accounts, territory).select("external_serial", "ship_start", "product_name", "sold_to_name", "ship_to_name", "territory")


@query("different_sold_to", """
    WITH l AS (SELECT o_custkey, l_suppkey, s_nationkey, o_orderdate, o_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
    sub AS (SELECT o_orderkey, min(l_suppkey) AS home FROM l GROUP BY o_orderkey),
    w AS (SELECT o_orderkey FROM l GROUP BY o_orderkey HAVING count(DISTINCT l_suppkey) > 1 AND count(DISTINCT s_nationkey) > 1)
    SELECT CAST(l.o_orderkey AS VARCHAR) AS consumer_id, CAST(l.l_suppkey AS VARCHAR) AS ship_to, l.l_linenumber AS cycle_count, CAST(sub.home AS VARCHAR) AS initial_ship_to,
           CASE WHEN sub.home <> l.l_suppkey AND h.s_nationkey <> l.s_nationkey THEN 'DifferentShipToDifferentSoldTo' WHEN h.s_nationkey <> l.s_nationkey THEN 'SameShipToDifferentSoldTo'
                WHEN sub.home <> l.l_suppkey THEN 'DifferentShipToSameSoldTo' ELSE 'SameShipToSameSoldTo' END AS sold_to_comment
    FROM l JOIN w USING (o_orderkey) JOIN sub USING (o_orderkey) JOIN supplier h ON h.s_suppkey = sub.home
""")
def different_sold_to(t: Tables) -> DataFrame:
    order, site = F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    details = lines.select(
        order.alias("consumer_id"), order.alias("subscription_uuid"), site.alias("account_uuid"), F.col("s_nationkey").cast("string").alias("sold_to"),
        F.col("o_orderdate").alias("cycle_date"), F.col("l_linenumber").alias("cycle_count"), F.lit("c").alias("class_uuid"), F.lit(1).alias("version"),
    )
    homes = lines.groupBy("l_orderkey").agg(F.min(F.struct("l_suppkey", "s_nationkey")).alias("h")).select(
        order.alias("subscription_uuid"), F.col("h.l_suppkey").cast("string").alias("account_uuid"), F.col("h.s_nationkey").cast("string").alias("sold_to"),
        F.lit(1).alias("version"), F.lit(None).cast("date").alias("sub_start"), F.lit(None).cast("date").alias("sub_end"),
    )
    accounts = t.supplier.select(F.col("s_suppkey").cast("string").alias("account_uuid"), F.col("s_suppkey").cast("string").alias("ship_to"))
    classes = t.region.where("r_regionkey = 0").select(F.lit("c").alias("class_uuid"), F.lit("n").alias("class_name"), F.lit("PerSubscription").alias("calc_type"))
    consumers = t.orders.select(F.col("o_orderkey").cast("string").alias("consumer_id"), F.col("o_orderkey").alias("scanned_id"))
    out = reports.different_sold_to(details, homes, accounts, classes, consumers)
    return out.select("consumer_id", "ship_to", "cycle_count", "initial_ship_to", "sold_to_comment")


@query("eligible_with_subscription", f"""
    WITH {Z.CYCLES_SQL}, {Z.SUBS_SQL},
    g AS (SELECT c.*, 'P-' || status || '/' || ship_to AS account_uuid FROM cyc c WHERE status <> 'P'
          AND n_regionkey <> 0 AND cycle_date BETWEEN DATE '1995-01-01' + s_nationkey * 10 AND DATE '2001-05-01')
    SELECT g.cycle_id, s.uuid AS subscription_uuid FROM g JOIN part ON card = p_partkey AND cycle_date BETWEEN DATE '1995-01-01' + p_size AND DATE '2001-07-01'
    JOIN sub s ON s.consumer_id = g.consumer_id AND s.promotion_uuid = g.promo AND g.cycle_date BETWEEN s.sub_start AND s.sub_end
      AND (s.account_uuid = g.account_uuid OR (s.account_uuid <> g.account_uuid AND s.sold_to = g.sold_to))
    QUALIFY row_number() OVER (PARTITION BY g.cycle_id ORDER BY s.sub_end DESC, s.uuid DESC) = 1
""")
def eligible_with_subscription(t: Tables) -> DataFrame:
    ref = Z.reference(t)
    usage = Z.cycles(t).withColumns({"error_code": F.lit(None).cast("string"), "z_code": F.lit(None).cast("string"), "promotion_hint": F.concat(F.lit("P-"), "device_type")})
    # An account belongs to one programme here, so its site is looked up per programme.
    sites = ref.accounts.where("per_patient").withColumn("ship_to", F.concat_ws("@", "ship_to", "promotion_uuid"))
    usage = usage.withColumn("ship_to", F.when(F.col("ship_to").isNotNull(), F.concat_ws("@", "ship_to", "promotion_hint"))).drop("promotion_hint")
    promotions = ref.promotions.withColumn("country", F.lit("US"))
    subs = settle(Z.sample_subscriptions(t, ref))
    return reports.eligible_with_subscription(settle(usage), settle(sites), subs, promotions, ref.cards).select("cycle_id", "subscription_uuid")


# ---- intake and text -------------------------------------------------------


@query("unmask_ids", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS consumer_id, CASE o_orderstatus WHEN 'F' THEN 'True' END AS consumer_id_decrypted FROM orders
""")
def unmask_ids(t: Tables) -> DataFrame:
    key = F.lit("0123456789abcdef")
    plain = F.col("o_custkey").cast("string")
    masked = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.base64(F.aes_encrypt(plain, key))).otherwise(plain).alias("masked"),
        F.when(F.col("o_orderstatus") == "F", "true").when(F.col("o_orderstatus") == "O", "False").alias("flag"),
    )
    return unmask(masked, "masked", "flag", "consumer_id", key).select("o_orderkey", "consumer_id", "consumer_id_decrypted")


@query("archive_routing", """
    WITH m AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'logs-scanned' WHEN 'view' THEN 'usbdecrypted-zip' ELSE 'other' END AS container,
                      CASE WHEN value > 300 THEN 'zlog_' ELSE 'log_' END || event_type || '_dev' || user_id || '_x_' || strftime(ts, '%Y%m%d%H%M%S') || CASE WHEN value < 100 THEN '.txt' ELSE '.zip' END AS name, value, user_id, ts, event_type FROM events)
    SELECT event_id, CASE WHEN container = 'other' THEN 'ignored' WHEN container = 'logs-scanned' AND name LIKE 'zlog%' THEN 'duplicate' WHEN value < 100 THEN 'invalid' ELSE 'valid' END AS route,
           CASE WHEN value >= 100 THEN upper('dev' || user_id) ELSE 'folder' END AS device_id, CASE WHEN value >= 100 THEN strftime(ts, '%Y%m%d') END AS log_day FROM m
""")
def archive_routing(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    name = F.concat(
        F.when(F.col("value") > 300, "zlog_").otherwise("log_"), kind, F.lit("_dev"), F.col("user_id").cast("string"), F.lit("_x_"),
        F.date_format("ts", "yyyyMMddHHmmss"), F.when(F.col("value") < 100, ".txt").otherwise(".zip"),
    )
    manifest = t.events.select(
        "event_id", F.when(kind == "click", "logs-scanned").when(kind == "view", "usbdecrypted-zip").otherwise("other").alias("container"),
        F.lit("folder").alias("folder"), name.alias("file_name"), F.lit("created").alias("event_type"),
    )
    return classify_archives(manifest).select("event_id", "route", "device_id", "log_day")


@query("tagged_text", """
    SELECT event_id, upper('sbc' || lpad(CAST(user_id AS VARCHAR), 16, '0')) AS internal_serial, CASE WHEN value < 100 THEN NULL ELSE 'UPM' || lpad(CAST(user_id AS VARCHAR), 16, '0') END AS external_serial,
           lpad(CAST(event_id AS VARCHAR), 20, '8') AS sim_card, date_trunc('second', ts) AS last_contact FROM events
""")
def tagged_text(t: Tables) -> DataFrame:
    serial = F.lpad(F.col("user_id").cast("string"), 16, "0")
    text = F.concat(
        F.lit("SBC:sbc"), serial, F.lit(" UPM: "), F.when(F.col("value") < 100, "?").otherwise(F.concat(F.lit("UPM"), serial)), F.lit(" SIM:"),
        F.lpad(F.col("event_id").cast("string"), 20, "8"), F.lit(" LastContact:"), F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" UTC "), F.date_format("ts", "yyyy"),
    )
    lines = t.events.select("event_id", text.alias("text"), F.date_format("ts", "MM-dd-yy.HH-mm-ss").alias("file_name"))
    return parse_tagged_text(lines).select("event_id", "internal_serial", "external_serial", "sim_card", F.col("last_contact").cast("timestamp_ntz").alias("last_contact"))


@query("user_events", """
    SELECT 'u' || user_id AS external_serial, CAST(ts AS DATE) AS day, event_type AS contract, CAST(max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS INTEGER) AS error_time
    FROM events GROUP BY ALL
""")
def user_events(t: Tables) -> DataFrame:
    rows = t.events.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("external_serial"), F.lit("i").alias("internal_serial"), F.col("ts").cast("date").alias("header_ts"),
        F.col("event_type").alias("contract"), F.lit(0).alias("head"), F.col("event_id").alias("file_id"), F.col("props").alias("payload"),
    )
    empty = rows.select("internal_serial", "external_serial", "header_ts", "contract", "head", F.lit(0).alias("error_time")).limit(0)
    merged = intake.user_events(empty, rows, [FieldMap("u", "*", ("k",), "error_time", "int")])
    return merged.select("external_serial", F.col("header_ts").alias("day"), "contract", "error_time")


@query("invoice_details", """
    WITH sub AS (SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS consumer, c_nationkey, CAST(o_orderdate AS DATE) AS d,
                        lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY c_nationkey, o_custkey ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) AS before
                 FROM orders JOIN customer ON o_custkey = c_custkey),
    det AS (SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n, min(CAST(l_shipdate AS DATE)) AS visit, min(l_suppkey) % 25 AS site FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL)
    SELECT det.l_orderkey || '/' || l_linenumber || '/' || l_returnflag AS detail_uuid, CAST(site AS VARCHAR) AS ship_to,
           substr(consumer, 1, 3) || '-' || substr(consumer, 4, 3) || '-' || substr(consumer, 7, 4) AS phone, visit AS visit_date,
           CASE WHEN l_returnflag = 'N' THEN d END AS initial_visit, CASE WHEN l_returnflag = 'N' THEN d + 150 END AS final_visit, before AS previous_start,
           n AS cycle_count, CASE l_returnflag WHEN 'N' THEN 1 ELSE 4 END AS class_order, CASE l_returnflag WHEN 'N' THEN 100 ELSE -100 END AS charge,
           'From ' || c_nationkey || ' at ' || CASE l_returnflag WHEN 'N' THEN 950 ELSE 200 END AS comment_text
    FROM det JOIN sub ON det.l_orderkey = sub.o_orderkey
""")
def invoice_details(t: Tables) -> DataFrame:
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("subscription_uuid"), F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("consumer_id"),
        F.col("c_nationkey").cast("string").alias("home"), F.col("o_orderdate").cast("date").alias("sub_start"),
    )
    subs = placed.select("subscription_uuid", "consumer_id", F.col("home").alias("account_uuid"), "sub_start", F.date_add("sub_start", 150).alias("sub_end"), F.lit(1).alias("version"))
    lines = t.lineitem.groupBy("l_orderkey", "l_linenumber", "l_returnflag").agg(
        F.count(F.lit(1)).alias("cycle_count"), F.min(F.col("l_shipdate").cast("date")).alias("cycle_date"), (F.min("l_suppkey") % 25).cast("string").alias("account_uuid")
    )
    details = lines.withColumn("subscription_uuid", F.col("l_orderkey").cast("string")).join(placed.select("subscription_uuid", "consumer_id"), "subscription_uuid").select(
        F.concat_ws("/", "subscription_uuid", F.col("l_linenumber").cast("string"), "l_returnflag").alias("detail_uuid"), "subscription_uuid", "consumer_id", "account_uuid",
        F.lit("so").alias("sold_to"), "cycle_date", "cycle_count", F.lit(100).alias("charge"), F.col("l_returnflag").alias("class_uuid"), F.lit(1).alias("version"),
        F.lit("note").alias("comments"), F.lit(datetime(2024, 1, 1)).alias("created_at"),
    )
    flag = F.col("l_returnflag")
    classes = t.lineitem.select("l_returnflag").distinct().select(
        flag.alias("class_uuid"), F.when(flag == "N", "PerPatientFee").otherwise("PerCycleFeeExceptionPreInvoice").alias("class_name"), flag.alias("display_name"),
        (flag != "A").alias("display"), F.when(flag == "N", 1).otherwise(-1).alias("multiplier"), F.when(flag == "N", "PerSubscription").otherwise("PerCycle").alias("calc_type"),
        F.when(flag == "N", 950).otherwise(200).alias("list_price"),
    )
    key = F.col("n_nationkey").cast("string")
    accounts = t.nation.select(key.alias("account_uuid"), key.alias("ship_to"), F.col("n_name").alias("name"))
    comments = t.region.where("r_regionkey = 0").select(F.lit("note").alias("code"), F.lit("From <DifferentShipToNumber> at <ListPrice>").alias("description"))
    consumers = placed.select("consumer_id", F.lit(1).alias("scanned_id")).distinct()
    out = reports.invoice_details(details, subs, accounts, classes, comments, consumers)
    return out.select("detail_uuid", "ship_to", "phone", "visit_date", "initial_visit", "final_visit", "previous_start", "cycle_count", "class_order", "charge", "comment_text")
