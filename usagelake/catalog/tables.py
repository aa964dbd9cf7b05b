"""Queries for upserts, set operations, joins and checks on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog.registry import Tables, query
from usagelake.operators import upsert as U
from usagelake.operators.temporal import interval_join
from usagelake.plans import quality as Q
from usagelake.session import small

ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def target_orders(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderdate") < "1999-01-01").select(*ORDER)


def changed_orders(t: Tables) -> DataFrame:
    """Later orders as a batch of changes: other status, price and date, some prices unknown."""
    shift = F.when(F.col("o_orderpriority") < "3", F.lit(1)).otherwise(F.lit(-1))
    return t.orders.where(F.col("o_orderdate") >= "1998-01-01").select(
        "o_orderkey",
        F.lit("X").alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 1000).alias("o_totalprice"),
        (F.col("o_orderdate") + F.make_dt_interval(days=shift)).alias("o_orderdate"),
    )


SIDES = """
    WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < '1999-01-01'),
    s AS (SELECT o_orderkey, 'X' AS o_orderstatus,
                 CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1000 END AS o_totalprice,
                 o_orderdate + (CASE WHEN o_orderpriority < '3' THEN INTERVAL 1 DAY ELSE INTERVAL (-1) DAY END) AS o_orderdate
          FROM orders WHERE o_orderdate >= '1998-01-01')
"""


def _merged(condition: str, status: str, price: str, day: str, insert: bool = True) -> str:
    """SQL of a merge: `condition` decides whether a matched row takes the new values."""
    matched = f"""
    SELECT t.o_orderkey,
           CASE WHEN {condition} THEN {status} ELSE t.o_orderstatus END AS o_orderstatus,
           CASE WHEN {condition} THEN {price} ELSE t.o_totalprice END AS o_totalprice,
           CASE WHEN {condition} THEN {day} ELSE t.o_orderdate END AS o_orderdate
    FROM t LEFT JOIN s USING (o_orderkey)"""
    fresh = " UNION ALL SELECT s.* FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)"
    return SIDES + matched + (fresh if insert else "")


HIT = "s.o_orderstatus IS NOT NULL"
KEY = ["o_orderkey"]


@query("upsert_insert_only", _merged("FALSE", "NULL", "NULL", "NULL"))
def upsert_insert_only(t: Tables) -> DataFrame:
    return U.insert_only(target_orders(t), changed_orders(t), KEY)


@query("upsert_newer", _merged(f"{HIT} AND s.o_orderdate > t.o_orderdate", "s.o_orderstatus", "s.o_totalprice", "s.o_orderdate"))
def upsert_newer(t: Tables) -> DataFrame:
    return U.update_if_newer(target_orders(t), changed_orders(t), KEY, "o_orderdate")


@query("upsert_scd1", _merged(HIT, "s.o_orderstatus", "s.o_totalprice", "t.o_orderdate"))
def upsert_scd1(t: Tables) -> DataFrame:
    return U.scd1(target_orders(t), changed_orders(t), KEY, keep=["o_orderdate"])


@query("upsert_changed", _merged(f"{HIT} AND s.o_totalprice IS DISTINCT FROM t.o_totalprice", "t.o_orderstatus", "s.o_totalprice", "s.o_orderdate"))
def upsert_changed(t: Tables) -> DataFrame:
    return U.update_if_changed(target_orders(t), changed_orders(t), KEY, tracked=["o_totalprice"], also=["o_orderdate"])


@query("upsert_null_keep", _merged(HIT, "t.o_orderstatus", "coalesce(s.o_totalprice, t.o_totalprice)", "t.o_orderdate", insert=False))
def upsert_null_keep(t: Tables) -> DataFrame:
    return U.keep_nulls_out(target_orders(t), changed_orders(t), KEY, ["o_totalprice"])


@query("upsert_fill_null", SIDES + """
    SELECT t.o_orderkey, t.o_orderstatus, coalesce(nullif(t.o_orderstatus, 'P'), s.o_orderstatus) AS filled
    FROM t LEFT JOIN s USING (o_orderkey)
""")
def upsert_fill_null(t: Tables) -> DataFrame:
    target = target_orders(t).select("o_orderkey", "o_orderstatus", F.expr("nullif(o_orderstatus, 'P')").alias("filled"))
    return U.fill_if_null(target, changed_orders(t), KEY, {"filled": "o_orderstatus"})


@query("upsert_status", SIDES + """
    SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderstatus IN ('O', 'P') THEN 'Closed' ELSE t.o_orderstatus END AS o_orderstatus
    FROM t LEFT JOIN s USING (o_orderkey)
""")
def upsert_status(t: Tables) -> DataFrame:
    target = target_orders(t).select("o_orderkey", "o_orderstatus")
    return U.set_status(target, changed_orders(t), KEY, "o_orderstatus", "Closed", allowed_from=["O", "P"])


@query("upsert_accumulate", """
    WITH t AS (SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds
               FROM events WHERE ts < '2024-01-10' GROUP BY user_id),
    s AS (SELECT user_id, count(*) AS n, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds
          FROM events WHERE ts >= '2024-01-10' GROUP BY user_id)
    SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.n, 0) + coalesce(s.n, 0) AS n,
           (SELECT string_agg(DISTINCT event_type, ', ' ORDER BY event_type) FROM events e
            WHERE e.user_id = coalesce(t.user_id, s.user_id)) AS kinds
    FROM t FULL JOIN s ON t.user_id = s.user_id
""")
def upsert_accumulate(t: Tables) -> DataFrame:
    from usagelake.operators.dedup import concat_set

    def part(condition: str) -> DataFrame:
        return t.events.where(condition).groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"), concat_set(F.col("event_type")).alias("kinds")
        )

    return U.accumulate(part("ts < '2024-01-10'"), part("ts >= '2024-01-10'"), ["user_id"], add=["n"], merge_sets=["kinds"])


@query("upsert_version", SIDES + """
    SELECT CAST(t.o_orderkey AS VARCHAR) AS id, t.o_orderdate, CASE WHEN s.o_orderkey IS NULL THEN 1 ELSE 2 END AS version
    FROM t LEFT JOIN s USING (o_orderkey)
    UNION ALL
    SELECT s.o_orderkey || '-new', s.o_orderdate, 1 FROM s WHERE o_orderkey IN (SELECT o_orderkey FROM t)
""")
def upsert_version(t: Tables) -> DataFrame:
    target = target_orders(t).select(F.col("o_orderkey").cast("string").alias("id"), "o_orderdate", F.lit(1).alias("version"))
    known = target.select(F.col("id").alias("replaces"))
    replacements = (
        changed_orders(t).select(F.col("o_orderkey").cast("string").alias("replaces"), "o_orderdate")
        .join(known, "replaces", "left_semi").withColumn("id", F.concat("replaces", F.lit("-new")))
    )
    return U.version_bump(target, replacements, "id", replaces="replaces")


@query("upsert_guarded", """
    WITH held AS (SELECT o_custkey, o_orderkey AS id, CAST(o_orderdate AS DATE) AS sub_start, CAST(o_orderdate AS DATE) + 150 AS sub_end
                  FROM orders WHERE o_orderdate < '1998-01-01'),
    asked AS (SELECT o_custkey, o_orderkey AS id, CAST(o_orderdate AS DATE) AS sub_start, CAST(o_orderdate AS DATE) + 150 AS sub_end
              FROM orders WHERE o_orderdate >= '1998-01-01')
    SELECT * FROM held
    UNION ALL
    SELECT * FROM asked a WHERE NOT EXISTS (
        SELECT 1 FROM held h WHERE h.o_custkey = a.o_custkey AND a.sub_start BETWEEN h.sub_start AND h.sub_end)
""")
def upsert_guarded(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    subs = t.orders.select("o_custkey", F.col("o_orderkey").alias("id"), day.alias("sub_start"), F.date_add(day, 150).alias("sub_end"), "o_orderdate")
    held = subs.where("o_orderdate < '1998-01-01'").drop("o_orderdate")
    asked = subs.where("o_orderdate >= '1998-01-01'").drop("o_orderdate")
    inside = interval_join(
        asked, held, ["o_custkey"], at="sub_start", start="sub_start", end="sub_end", closed="both",
        take={"_held": "id"}, tie=["id"], bucket="365 days",
    ).where("_held IS NOT NULL")
    return U.insert_uncovered(held, asked, covered=inside, row_key=["id"])


# ---- sets and joins --------------------------------------------------------


@query("except_keys", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_keys(t: Tables) -> DataFrame:
    return Q.missing_rows(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query("intersect_keys", """
    SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'
    INTERSECT SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O'
""")
def intersect_keys(t: Tables) -> DataFrame:
    return Q.stored_rows(
        t.lineitem.where("l_returnflag = 'R'"), t.lineitem.where("l_linestatus = 'O'"), ["l_suppkey", "l_linenumber"]
    )


@query("semi_in", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def semi_in(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(returned, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


@query("anti_members", """
    SELECT c_custkey, FALSE AS active FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '2001-01-01')
""")
def anti_members(t: Tables) -> DataFrame:
    from usagelake.plans.masters import deactivate_missing

    seen = t.orders.where("o_orderdate >= '2001-01-01'").select(F.col("o_custkey").alias("c_custkey"))
    return deactivate_missing(t.customer.select("c_custkey"), seen, ["c_custkey"], flag="active")


@query("union_generations", """
    SELECT 'supplier' AS kind, s_suppkey AS account_id, s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT 'customer', c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
""")
def union_generations(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("account_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    customers = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
    )
    return suppliers.unionByName(customers, allowMissingColumns=True)


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("role_join", """
    SELECT l_orderkey, l_suppkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    GROUP BY ALL
""")
def role_join(t: Tables) -> DataFrame:
    def role(key: str, name: str) -> DataFrame:
        return small(t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name)))

    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(small(t.supplier), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(role("c_nationkey", "customer_nation"), "c_nationkey", "left")
        .join(role("s_nationkey", "supplier_nation"), "s_nationkey", "left")
        .groupBy("l_orderkey", "l_suppkey", "l_linenumber", "customer_nation", "supplier_nation")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("null_safe_upsert", """
    WITH t AS (SELECT c_mktsegment AS seg, nullif(c_nationkey, 0) AS nat, count(*) AS n FROM customer GROUP BY ALL),
    s AS (SELECT c_mktsegment AS seg, nullif(c_nationkey, 0) AS nat, count(*) + 1 AS n FROM customer WHERE c_acctbal > 5000 GROUP BY ALL)
    SELECT t.seg, t.nat, CASE WHEN s.n IS DISTINCT FROM t.n AND s.n IS NOT NULL THEN s.n ELSE t.n END AS n
    FROM t LEFT JOIN s ON t.seg = s.seg AND t.nat IS NOT DISTINCT FROM s.nat
""")
def null_safe_upsert(t: Tables) -> DataFrame:
    keyed = t.customer.select(F.col("c_mktsegment").alias("seg"), F.expr("nullif(c_nationkey, 0)").alias("nat"), "c_acctbal")
    target = keyed.groupBy("seg", "nat").agg(F.count(F.lit(1)).alias("n"))
    source = keyed.where("c_acctbal > 5000").groupBy("seg", "nat").agg((F.count(F.lit(1)) + 1).alias("n"))
    return U.update_if_changed(target, source, ["seg", "nat"], tracked=["n"], null_safe=True)


@query("key_expression_join", """
    SELECT l_partkey, CAST(lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS VARCHAR) AS padded, s_name, count(*) AS n
    FROM lineitem LEFT JOIN supplier ON lpad(CAST(l_suppkey AS VARCHAR), 6, '0') = right(s_name, 6)
    GROUP BY ALL
""")
def key_expression_join(t: Tables) -> DataFrame:
    from usagelake.functions.columns import pad_serial

    lines = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    lines = lines.withColumn("padded", pad_serial(F.col("l_suppkey").cast("string"), 6)).drop("l_suppkey")
    named = t.supplier.select(F.right("s_name", F.lit(6)).alias("padded"), "s_name")
    return lines.join(named, "padded", "left").groupBy("l_partkey", "padded", "s_name").agg(F.sum("n").alias("n"))


# ---- checks ----------------------------------------------------------------


@query("reconcile_full", """
    WITH a AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
    b AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount FROM lineitem GROUP BY l_orderkey)
    SELECT coalesce(a.k, b.k) AS k, CAST(a.amount AS DOUBLE) AS l_amount, CAST(b.amount AS DOUBLE) AS r_amount,
           CASE WHEN a.amount = b.amount THEN 'Matched' WHEN a.k IS NULL THEN 'Missing left' WHEN b.k IS NULL THEN 'Missing right'
                WHEN abs(a.amount - b.amount) <= 100000 THEN 'Near' ELSE 'Unknown' END AS verdict
    FROM a FULL JOIN b ON a.k = b.k
""")
def reconcile_full(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    l, r = F.col("l_amount"), F.col("r_amount")
    judged = Q.reconcile(a, b, ["k"], [
        (l == r, "Matched"), (l.isNull(), "Missing left"), (r.isNull(), "Missing right"), (F.abs(l - r) <= 100000, "Near"),
    ])
    return judged.withColumns({c: F.col(c).cast("double") for c in ("l_amount", "r_amount")})


@query("counts_by_day", """
    WITH a AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY ALL),
    b AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL)
    SELECT coalesce(a.day, b.day) AS day, a.n AS left_count, b.n AS right_count, a.n - b.n AS difference FROM a FULL JOIN b ON a.day = b.day
""")
def counts_by_day(t: Tables) -> DataFrame:
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    return Q.daily_counts(days.where("event_type = 'signup'"), days.where("event_type = 'purchase'"), "day")


@query("count_report", """
    WITH a AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY ALL),
    b AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL),
    j AS (SELECT coalesce(a.day, b.day) AS day, a.n AS an, b.n AS bn, coalesce(a.n, 0) - coalesce(b.n, 0) AS gap
          FROM a FULL JOIN b ON a.day = b.day AND a.user_id = b.user_id),
    c AS (SELECT day, CAST(sum(an) AS BIGINT) AS left_count, CAST(sum(bn) AS BIGINT) AS right_count,
                 count(CASE WHEN gap < 0 THEN 1 END) AS missing_left, count(CASE WHEN gap > 0 THEN 1 END) AS missing_right,
                 count(CASE WHEN gap = 0 THEN 1 END) AS matching, count(*) AS expected FROM j GROUP BY day)
    SELECT *, CASE WHEN expected = left_count AND expected = right_count THEN 'Both good' WHEN expected = left_count THEN 'Left good'
                   WHEN expected = right_count THEN 'Right good' ELSE 'Neither good' END AS comment FROM c
""")
def count_report(t: Tables) -> DataFrame:
    days = t.events.withColumn("day", F.col("ts").cast("date"))
    return Q.count_report(days.where("event_type = 'signup'"), days.where("event_type = 'purchase'"), "day", ["user_id"])


def invoice_rows(t: Tables) -> DataFrame:
    """Orders as invoice rows: account = customer nation, class order from priority and status."""
    place = F.substring("o_orderpriority", 1, 1).cast("int") + F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 5).otherwise(10)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("ship_to"), F.year("o_orderdate").alias("period"), place.alias("class_order"),
        F.round("o_totalprice").cast("bigint").alias("amount"),
    )


INVOICE_SQL = """
    WITH inv AS (SELECT c_nationkey AS ship_to, year(o_orderdate) AS period,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 5 ELSE 10 END AS class_order,
        CAST(round(o_totalprice) AS BIGINT) AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _accrual_sql(keys: str) -> str:
    parts = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN class_order IN ({', '.join(map(str, places))}) THEN amount END), 0) AS BIGINT) AS {name}"
        for name, places in Q.ACCRUAL.items()
    )
    return f"SELECT {keys}, {parts} FROM inv GROUP BY {keys}"


@query("accrual_details", INVOICE_SQL + _accrual_sql("ship_to, period"))
def accrual_details(t: Tables) -> DataFrame:
    return Q.accrual_details(invoice_rows(t), ["ship_to", "period"])


@query("accrual_summary", INVOICE_SQL + f""", wide AS ({_accrual_sql('period')}),
    n AS (SELECT period, count(DISTINCT ship_to) AS n_accounts FROM inv GROUP BY period)
    SELECT period, n_accounts, description, total FROM (
        UNPIVOT (SELECT * FROM wide JOIN n USING (period)) ON {', '.join(Q.ACCRUAL)} INTO NAME description VALUE total)
""")
def accrual_summary(t: Tables) -> DataFrame:
    return Q.accrual_summary(invoice_rows(t), ["period"], "ship_to")


@query("compare_hashed", """
    WITH a AS (SELECT o_custkey AS k, count(*) AS n, CAST(min(o_orderkey) AS BIGINT) AS m FROM orders GROUP BY o_custkey),
    b AS (SELECT o_custkey AS k, count(DISTINCT o_orderkey) AS n, min(l_orderkey) AS m FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey)
    SELECT coalesce(a.k, b.k) AS k, sha256(a.n || chr(31) || a.m) AS l_hash, sha256(b.n || chr(31) || b.m) AS r_hash,
           CASE WHEN a.n = b.n AND a.m = b.m THEN 'Matched' WHEN a.k IS NULL THEN 'Missing left' WHEN b.k IS NULL THEN 'Missing right' ELSE 'Not Matched' END AS verdict
    FROM a FULL JOIN b ON a.k = b.k
""")
def compare_hashed(t: Tables) -> DataFrame:
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("m"))
    lined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    b = lined.groupBy(F.col("o_custkey").alias("k")).agg(F.count_distinct("o_orderkey").alias("n"), F.min("l_orderkey").alias("m"))
    return Q.compare_hashed(a, b, ["k"], ["n", "m"])


@query("duplicate_audit", """
    SELECT 'lineitem' AS table_name, count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def duplicate_audit(t: Tables) -> DataFrame:
    return Q.duplicate_audit(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")
