"""Queries that exercise the operators on the test tables.

Roles: a user of `events` is a device or consumer, an event type a message
contract, `props` a JSON payload; orders are shipments, customers ship-to
accounts, suppliers sold-to accounts, parts card materials, lines usage rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog.registry import Tables, query
from usagelake.functions.columns import render_template
from usagelake.functions.jsonmap import FieldMap, flatten_json
from usagelake.operators.dedup import (
    arg_min,
    assign_sequence,
    concat_set,
    content_hash,
    duplicate_flags,
    duplicate_keys,
    hashed_history,
    latest_by,
    mark_first_last,
    rank_by_priority,
    top_by_sum,
)
from usagelake.operators.groups import fill_forward, with_group_totals, with_neighbours
from usagelake.operators.temporal import (
    asof_join,
    containing_join,
    interval_join,
    missing_numbers,
    other_owner_join,
    pair_nth,
    previous_end,
    range_join,
    scd2_from_changes,
)
from usagelake.session import settle

EVENT_FIELDS = [
    FieldMap("events", "*", ("kk", "k"), "k", "bigint"),
    FieldMap("events", "*", ("missing_name",), "absent", "string"),
    FieldMap("events", "*", ("k",), "k_text", "timestamp"),
]
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def of_type(t: Tables, *types: str) -> DataFrame:
    return t.events.where(F.col("event_type").isin(*types))


def supply_history(t: Tables) -> DataFrame:
    """Who supplied a part from which ship date on (one row per part and date)."""
    daily = t.lineitem.groupBy("l_partkey", "l_shipdate").agg(F.min("l_suppkey").alias("suppkey"))
    history = scd2_from_changes(daily, "l_partkey", ["l_shipdate"], start="l_shipdate")
    # A dimension is a stored table: it is read by both passes of a lookup.
    return settle(history.withColumnRenamed("l_shipdate", "valid_from"))


def part_usage(t: Tables) -> DataFrame:
    """Parts used by an order on its day, stored like any batch of facts."""
    lines = t.lineitem.select("l_orderkey", "l_partkey").distinct()
    return settle(
        lines.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")).select(
            "l_partkey", "l_orderkey", "o_orderdate"
        )
    )


SUPPLY_SQL = """
supply AS (
    SELECT l_partkey, l_shipdate AS valid_from, suppkey,
           lead(l_shipdate, 1, TIMESTAMP '2111-11-11') OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS valid_to
    FROM (SELECT l_partkey, l_shipdate, min(l_suppkey) AS suppkey FROM lineitem GROUP BY ALL)
)"""


@query("latest_state", """
    SELECT user_id, event_type, event_id, ts, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_state(t: Tables) -> DataFrame:
    last = latest_by(t.events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return flatten_json(last, "props", EVENT_FIELDS[:1]).select(
        "user_id", "event_type", "event_id", "ts", "value", "k"
    )


@query("collapse_device", """
    WITH last AS (
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
    SELECT user_id, max(ts) AS last_seen,
           max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase_value,
           max(CASE WHEN event_type = 'error' THEN value END) AS error_value,
           coalesce(max(CASE WHEN event_type = 'signup' THEN props END), 'NoEntry') AS signup_props
    FROM last GROUP BY user_id
""")
def collapse_device(t: Tables) -> DataFrame:
    last = latest_by(t.events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])

    def of(kind: str, column: str):
        return F.max(F.when(F.col("event_type") == kind, F.col(column)))

    return last.groupBy("user_id").agg(
        F.max("ts").alias("last_seen"),
        of("purchase", "value").alias("purchase_value"),
        of("error", "value").alias("error_value"),
        F.coalesce(of("signup", "props"), F.lit("NoEntry")).alias("signup_props"),
    )


@query("json_flatten", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(NULL AS VARCHAR) AS absent, json_extract_string(props, '$.k') AS k_text
    FROM events
""")
def json_flatten(t: Tables) -> DataFrame:
    return flatten_json(t.events, "props", EVENT_FIELDS).select("event_id", "k", "absent", "k_text")


@query("content_hash", """
    WITH h AS (
        SELECT DISTINCT event_type,
               sha256(concat_ws('||', event_type, props, CAST(user_id AS VARCHAR))) AS hash_id
        FROM events)
    SELECT event_type, count(*) AS n_hashes, min(hash_id) AS lowest, max(hash_id) AS highest
    FROM h GROUP BY event_type
""")
def content_hash_counts(t: Tables) -> DataFrame:
    history = hashed_history(t.events.select("event_type", "props", "user_id"))
    return history.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_hashes"), F.min("hash_id").alias("lowest"), F.max("hash_id").alias("highest")
    )


@query("scd2_customer", """
    WITH days AS (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
        FROM orders GROUP BY ALL)
    SELECT o_custkey, valid_from, CAST(amount AS DOUBLE) AS amount,
           lead(valid_from, 1, DATE '2111-11-11') OVER w AS valid_to,
           row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from DESC) AS load_order
    FROM days WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from)
""")
def scd2_customer(t: Tables) -> DataFrame:
    days = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("valid_from")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount")
    )
    return scd2_from_changes(days, "o_custkey", ["valid_from"], start="valid_from", with_load_order=True)


@query("interval_owner", f"""
    WITH {SUPPLY_SQL},
    usage AS (SELECT DISTINCT l_partkey, l_orderkey, o_orderdate
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT u.l_partkey, u.l_orderkey, s.suppkey, s.valid_from
    FROM usage u LEFT JOIN supply s
      ON s.l_partkey = u.l_partkey AND u.o_orderdate >= s.valid_from AND u.o_orderdate < s.valid_to
""")
def interval_owner(t: Tables) -> DataFrame:
    return interval_join(
        part_usage(t), supply_history(t), ["l_partkey"], at="o_orderdate", start="valid_from", end="valid_to",
        take={"suppkey": "suppkey", "valid_from": "valid_from"}, bucket="365 days",
    ).select("l_partkey", "l_orderkey", "suppkey", "valid_from")


@query("interval_owner_closed", f"""
    WITH {SUPPLY_SQL},
    usage AS (SELECT DISTINCT l_partkey, l_orderkey, o_orderdate
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT u.l_partkey, u.l_orderkey, s.suppkey, s.valid_to
    FROM usage u LEFT JOIN supply s
      ON s.l_partkey = u.l_partkey AND u.o_orderdate BETWEEN s.valid_from AND s.valid_to
    QUALIFY row_number() OVER (PARTITION BY u.l_partkey, u.l_orderkey
                               ORDER BY s.valid_to DESC NULLS LAST, s.valid_from DESC NULLS LAST) = 1
""")
def interval_owner_closed(t: Tables) -> DataFrame:
    return interval_join(
        part_usage(t), supply_history(t), ["l_partkey"], at="o_orderdate", start="valid_from", end="valid_to",
        closed="both", take={"suppkey": "suppkey", "valid_to": "valid_to"}, bucket="365 days",
    ).select("l_partkey", "l_orderkey", "suppkey", "valid_to")


@query("asof_previous", """
    SELECT p.event_id, p.user_id, e.event_id AS error_id, e.ts AS error_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
      ON p.user_id = e.user_id AND p.ts >= e.ts
""")
def asof_previous(t: Tables) -> DataFrame:
    return asof_join(
        of_type(t, "purchase"), of_type(t, "error"), ["user_id"], at="ts", time="ts",
        take={"error_id": "event_id", "error_ts": "ts"}, bucket="7 days",
    ).select("event_id", "user_id", "error_id", "error_ts")


@query("asof_next", """
    SELECT p.event_id, p.user_id, e.event_id AS error_id, e.ts AS error_ts
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
      ON p.user_id = e.user_id AND p.ts < e.ts
""")
def asof_next(t: Tables) -> DataFrame:
    return asof_join(
        of_type(t, "purchase"), of_type(t, "error"), ["user_id"], at="ts", time="ts", direction="next",
        inclusive=False, take={"error_id": "event_id", "error_ts": "ts"}, bucket="7 days",
    ).select("event_id", "user_id", "error_id", "error_ts")


@query("within_session", """
    WITH s AS (
        SELECT user_id, event_id AS session_id, ts AS opened,
               lead(ts, 1, TIMESTAMP '9999-12-31') OVER (PARTITION BY user_id ORDER BY ts) AS closed
        FROM events WHERE event_type = 'signup')
    SELECT v.event_id, v.user_id, s.session_id
    FROM events v JOIN s ON v.user_id = s.user_id AND v.ts >= s.opened AND v.ts < s.closed
    WHERE v.event_type = 'view'
""")
def within_session(t: Tables) -> DataFrame:
    opened = of_type(t, "signup").select("user_id", F.col("event_id").alias("session_id"), F.col("ts").alias("opened"))
    sessions = scd2_from_changes(
        opened, "user_id", ["opened"], start="opened", end="closed", open_end="9999-12-31", bucket="7 days"
    )
    return range_join(
        of_type(t, "view"), sessions, ["user_id"], at="ts", start="opened", end="closed",
        take={"session_id": "session_id"}, bucket="7 days", origin="2024-01-01", horizon="2024-02-01",
    ).select("event_id", "user_id", "session_id")


@query("containing_interval", """
    WITH span AS (
        SELECT l_suppkey, l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_suppkey, l_orderkey),
    wide AS (
        SELECT l_suppkey, l_partkey, min(l_shipdate) AS opened, max(l_shipdate) AS closed
        FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1)
    SELECT s.l_suppkey, s.l_orderkey, w.l_partkey
    FROM span s JOIN wide w
      ON w.l_suppkey = s.l_suppkey AND w.opened < s.first_ship AND s.last_ship < w.closed
    QUALIFY row_number() OVER (PARTITION BY s.l_suppkey, s.l_orderkey
                               ORDER BY w.opened DESC, w.closed, w.l_partkey) = 1
""")
def containing_interval(t: Tables) -> DataFrame:
    span = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    wide = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(
        F.min("l_shipdate").alias("opened"), F.max("l_shipdate").alias("closed"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    return containing_join(
        span, wide, ["l_suppkey"], inner_start="first_ship", inner_end="last_ship", start="opened", end="closed",
        take={"l_partkey": "l_partkey"}, bucket="60 days",
    ).select("l_suppkey", "l_orderkey", "l_partkey")


@query("other_owner", """
    WITH held AS (SELECT *, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS until FROM lineitem),
    shipped AS (SELECT *, row_number() OVER () AS n FROM lineitem)
    SELECT p.l_orderkey, p.l_linenumber, s.l_suppkey AS other_supplier, s.until
    FROM shipped p JOIN held s ON s.l_partkey = p.l_partkey AND s.l_suppkey <> p.l_suppkey AND p.l_shipdate BETWEEN s.l_shipdate AND s.until
    QUALIFY row_number() OVER (PARTITION BY p.n ORDER BY s.until DESC, s.l_orderkey, s.l_linenumber, s.l_suppkey) = 1
""")
def other_owner(t: Tables) -> DataFrame:
    """The stock of the same part from another supplier that lasts longest of those in use when a line is shipped."""
    shipped = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    held = t.lineitem.select(*shipped.columns, F.expr("l_shipdate + make_dt_interval(CAST(l_quantity AS INT))").alias("until"))
    return other_owner_join(
        shipped, held, ["l_partkey"], at="l_shipdate", start="l_shipdate", end="until", owner="l_suppkey",
        tie=["l_orderkey", "l_linenumber"], take={"other_supplier": "l_suppkey", "until": "until"},
    ).where("other_supplier IS NOT NULL").select("l_orderkey", "l_linenumber", "other_supplier", "until")


@query("pair_start_end", """
    WITH n AS (
        SELECT event_id, user_id, event_type, ts,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS pair_no
        FROM events WHERE event_type IN ('signup', 'purchase'))
    SELECT s.user_id, s.pair_no, s.event_id AS start_id, s.ts AS start_ts, e.event_id AS end_id, e.ts AS end_ts
    FROM n s LEFT JOIN n e ON e.user_id = s.user_id AND e.pair_no = s.pair_no AND e.event_type = 'purchase'
    WHERE s.event_type = 'signup'
""")
def pair_start_end(t: Tables) -> DataFrame:
    return pair_nth(
        of_type(t, "signup"), of_type(t, "purchase"), ["user_id"],
        start_order=["ts", "event_id"], end_order=["ts", "event_id"],
        take={"end_id": "event_id", "end_ts": "ts"}, bucket="7 days",
    ).select(
        "user_id", "pair_no", F.col("event_id").alias("start_id"), F.col("ts").alias("start_ts"), "end_id", "end_ts"
    )


@query("fill_forward", """
    SELECT event_id, user_id,
           last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_purchase
    FROM events
""")
def filled_values(t: Tables) -> DataFrame:
    tagged = t.events.withColumn("spent", F.when(F.col("event_type") == "purchase", F.col("value")))
    return fill_forward(tagged, ["user_id"], ["ts", "event_id"], {"last_purchase": "spent"}, bucket="7 days").select(
        "event_id", "user_id", "last_purchase"
    )


@query("neighbour_bounds", """
    SELECT event_id, user_id, event_type,
           lag(ts, 1, TIMESTAMP '1900-01-01') OVER w AS previous_ts,
           lead(ts, 1, TIMESTAMP '9999-12-31') OVER w AS next_ts
    FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)
""")
def neighbour_bounds(t: Tables) -> DataFrame:
    near = with_neighbours(
        t.events, ["user_id", "event_type"], ["ts", "event_id"],
        previous={"p": "ts"}, following={"n": "ts"}, bucket="7 days",
    )
    return near.select(
        "event_id", "user_id", "event_type",
        F.coalesce("p", F.lit("1900-01-01").cast("timestamp_ntz")).alias("previous_ts"),
        F.coalesce("n", F.lit("9999-12-31").cast("timestamp_ntz")).alias("next_ts"),
    )


@query("previous_end", """
    WITH d AS (
        SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS start_date,
               CAST(o_orderdate AS DATE) + 150 AS end_date FROM orders)
    SELECT o_custkey, start_date, end_date,
           coalesce(lag(end_date) OVER (PARTITION BY o_custkey ORDER BY end_date), start_date - 150) AS previous_end
    FROM d
""")
def previous_ends(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    subs = t.orders.select("o_custkey", day.alias("start_date"), F.date_add(day, 150).alias("end_date")).distinct()
    return previous_end(subs, ["o_custkey"], start="start_date", end="end_date", gap_days=150)


@query("missing_numbers", """
    WITH seen AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
    span AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM seen GROUP BY l_orderkey)
    SELECT s.l_orderkey, g.n AS missing_no
    FROM span s, (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS n) g
    WHERE g.n BETWEEN s.lo AND s.hi
      AND NOT EXISTS (SELECT 1 FROM seen x WHERE x.l_orderkey = s.l_orderkey AND x.l_linenumber = g.n)
""")
def missing_line_numbers(t: Tables) -> DataFrame:
    return missing_numbers(t.lineitem, ["l_orderkey"], "l_linenumber")


@query("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_line_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("duplicate_flags", """
    WITH n AS (
        SELECT *, row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_shipdate, l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS a,
               row_number() OVER (PARTITION BY l_partkey, l_linenumber, l_shipdate, l_suppkey ORDER BY l_shipdate, l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS d,
               row_number() OVER (PARTITION BY l_partkey, l_linenumber, l_shipdate ORDER BY l_shipdate, l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS b,
               row_number() OVER (PARTITION BY l_partkey, l_linenumber, l_suppkey ORDER BY l_shipdate, l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS c
        FROM lineitem)
    SELECT l_linestatus,
           count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS sold_rows,
           count(CASE WHEN a > 1 THEN 1 END) AS duplicates,
           count(CASE WHEN a + d <> 2 THEN 1 END) AS over_used,
           count(CASE WHEN d = 1 THEN 1 END) AS used_rows,
           count(CASE WHEN NOT (l_returnflag = 'N' AND a + d = 2) THEN 1 END) AS frauds,
           max(a) AS max_seq, max(b) AS max_seq_date, max(c) AS max_seq_device
    FROM n GROUP BY l_linestatus
""")
def duplicate_flag_counts(t: Tables) -> DataFrame:
    flagged = duplicate_flags(
        t.lineitem.withColumn("head", F.lit(0)),
        card="l_partkey", cycle="l_linenumber", head="head", date="l_shipdate", device=["l_suppkey"],
        order=["l_shipdate", "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        sold=F.col("l_returnflag") == "N", bucket="365 days",
    )

    def count_y(column: str):
        return F.count(F.when(F.col(column) == "Y", 1))

    return flagged.groupBy("l_linestatus").agg(
        F.count(F.when(F.col("unsold_flag") == "N", 1)).alias("sold_rows"),
        count_y("duplicate_flag").alias("duplicates"),
        count_y("utilisation_flag").alias("over_used"),
        F.sum("used_count").alias("used_rows"),
        count_y("fraud_flag").alias("frauds"),
        F.max("seq_cycle").alias("max_seq"),
        F.max("seq_cycle_date").alias("max_seq_date"),
        F.max("seq_cycle_device").alias("max_seq_device"),
    )


@query("assign_sequence", """
    SELECT o_orderkey, 10000 + row_number() OVER (ORDER BY o_orderkey) AS cycle_id FROM orders
""")
def sequence_numbers(t: Tables) -> DataFrame:
    return assign_sequence(t.orders.select("o_orderkey"), ["o_orderkey"], "cycle_id", bucket=100_000, start=10_000)


@query("first_last_marks", """
    SELECT event_id, user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 AS is_first,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS is_last
    FROM events
""")
def first_last_marks(t: Tables) -> DataFrame:
    return mark_first_last(t.events, ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", "is_first", "is_last"
    )


@query("group_totals", """
    SELECT DISTINCT o_orderkey, o_custkey,
           count(*) OVER (PARTITION BY o_custkey) AS n_orders,
           max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_order,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS spent
    FROM orders
""")
def group_totals(t: Tables) -> DataFrame:
    return with_group_totals(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"), ["o_custkey"],
        n_orders=F.count(F.lit(1)), last_order=F.max("o_orderdate"),
        spent=F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"),
    ).select("o_orderkey", "o_custkey", "n_orders", "last_order", "spent")


@query("arg_min_code", """
    SELECT p_type, p_brand, p_partkey, p_size FROM part
    WHERE (p_type, p_brand) IN (SELECT p_type, min(p_brand) FROM part GROUP BY p_type)
""")
def arg_min_code(t: Tables) -> DataFrame:
    return arg_min(t.part, ["p_type"], "p_brand").select("p_type", "p_brand", "p_partkey", "p_size")


@query("top_by_sum", """
    SELECT l_partkey, l_suppkey, CAST(revenue AS DOUBLE) AS revenue FROM (
        SELECT l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
        FROM lineitem GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY revenue DESC, l_suppkey) = 1
""")
def top_supplier(t: Tables) -> DataFrame:
    top = top_by_sum(t.lineitem, "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)"), "revenue")
    return top.withColumn("revenue", F.col("revenue").cast("double"))


@query("concat_set", """
    SELECT l_orderkey, string_agg(DISTINCT l_returnflag || l_linestatus, ', ' ORDER BY l_returnflag || l_linestatus) AS flags
    FROM lineitem GROUP BY l_orderkey
""")
def concat_flags(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(
        concat_set(F.concat("l_returnflag", "l_linestatus")).alias("flags")
    )


@query("count_distinct_having", """
    SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_type) AS n_types,
           count(DISTINCT props) AS n_props, count(*) AS n_events
    FROM events GROUP BY user_id, CAST(ts AS DATE) HAVING count(DISTINCT event_type) > 1
""")
def busy_days(t: Tables) -> DataFrame:
    return (
        t.events.groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(
            F.count_distinct("event_type").alias("n_types"),
            F.count_distinct("props").alias("n_props"),
            F.count(F.lit(1)).alias("n_events"),
        )
        .where("n_types > 1")
    )


@query("time_range_per_file", """
    SELECT user_id, event_type, min(ts) AS log_start, max(ts) AS log_end, count(*) AS n_records
    FROM events GROUP BY user_id, event_type
""")
def time_range_per_file(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", "event_type").agg(
        F.min("ts").alias("log_start"), F.max("ts").alias("log_end"), F.count(F.lit(1)).alias("n_records")
    )


@query("priority_status", """
    SELECT o_custkey, o_orderstatus AS status, o_orderdate AS reported, o_orderkey
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) = 1
""")
def priority_status(t: Tables) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3)
    return rank_by_priority(t.orders, ["o_custkey"], rank, F.col("o_orderdate").desc(), F.col("o_orderkey")).select(
        "o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("reported"), "o_orderkey"
    )


@query("template_render", """
    SELECT c_custkey, replace(replace(replace('Account <Name> (<Segment>) balance <Balance>',
             '<Name>', coalesce(c_name, '')), '<Segment>', coalesce(c_mktsegment, '')),
             '<Balance>', CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)) AS note
    FROM customer
""")
def template_note(t: Tables) -> DataFrame:
    note = render_template(
        F.lit("Account <Name> (<Segment>) balance <Balance>"),
        {"Name": F.col("c_name"), "Segment": F.col("c_mktsegment"), "Balance": F.floor("c_acctbal")},
    )
    return t.customer.select("c_custkey", note.alias("note"))


@query("row_hashes", """
    SELECT p_partkey, sha256(concat_ws('||', p_brand, CAST(p_size AS VARCHAR), p_type)) AS hash_id FROM part
""")
def row_hashes(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", content_hash(["p_type", "p_size", "p_brand"]).alias("hash_id"))
