"""Queries for file sources and sinks, streams of several batches, and merges into filled targets, on the test tables."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelake.catalog.registry import Tables, query
from usagelake.functions import columns as K
from usagelake.operators import upsert as U
from usagelake.operators.dedup import latest_by
from usagelake.plans import cycles as C
from usagelake.plans import masters, reports
from usagelake.session import settle, shared_folder
from usagelake.sources import files
from usagelake.sources.manifest import archive_states, replay_attempts
from usagelake.sources.snapshots import bucket_column, compact, read_buckets, read_snapshot, update_partitions
from usagelake.streaming.runner import append_batches, drain, upsert_batches, with_capture

#: Files of one part of a streamed table, and of one micro-batch.
PART_FILES = 4


def _folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid4().hex}"


# ---- files -----------------------------------------------------------------


@query("delimited_rescued", """
    SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'no. ' || c_custkey || '|' || c_name || '|7' END AS rescued,
           CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey ELSE 7 END AS c_nationkey, TRUE AS has_file
    FROM customer
""")
def delimited_rescued(t: Tables) -> DataFrame:
    """Customers as delimited lines, every tenth with a key that is no number."""
    path, broken = _folder(t, "delimited"), F.col("c_custkey") % 10 == 0
    lines = F.concat_ws("|", F.when(broken, F.concat(F.lit("no. "), "c_custkey")).otherwise(F.col("c_custkey").cast("string")), "c_name",
                        F.when(broken, F.lit("7")).otherwise(F.col("c_nationkey").cast("string")))
    t.customer.select(lines.alias("value")).write.text(path)
    got = files.read_delimited(t.spark, path, "c_custkey long, c_name string, c_nationkey int", sep="|", rescued="rescued")
    return got.select("c_custkey", "rescued", "c_nationkey", (F.col("file_size") > 0).alias("has_file"))


@query("header_json_file", """
    SELECT 4 AS format_version, CAST(ts AS DATE) AS header_date, event_type AS source, CAST(event_id AS VARCHAR) AS store_id, props AS payload FROM events
""")
def header_json_file(t: Tables) -> DataFrame:
    path = _folder(t, "lines")
    line = F.concat_ws(",", F.lit("4"), F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss.SSS"), F.lit("L"), F.lit("d"), "event_type",
                       F.lit("c"), F.col("event_id").cast("string"), F.lit("25003:1"), "props")
    t.events.select(line.alias("value")).write.text(path)
    return files.read_header_json_lines(t.spark, path).select("format_version", "header_date", "source", "store_id", "payload")


@query("json_batch", """
    SELECT p_partkey, p_name, CASE WHEN p_size > 10 THEN p_size END AS p_size FROM part
""")
def json_batch(t: Tables) -> DataFrame:
    """Parts as JSON lines without their small sizes."""
    path = _folder(t, "json")
    t.part.select("p_partkey", "p_name", F.when(F.col("p_size") > 10, F.col("p_size")).alias("p_size")).write.json(path)
    return files.read_json(t.spark, path, "p_partkey long, p_name string, p_size int").select("p_partkey", "p_name", "p_size")


@query("copy_quoted", """
    SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ', "x"' AS s_name FROM supplier
""")
def copy_quoted(t: Tables) -> DataFrame:
    src, dst = _folder(t, "source"), _folder(t, "copy")
    rows = t.supplier.select(F.col("s_suppkey").cast("string"), F.concat("s_name", F.lit(', "x"')).alias("s_name"))
    rows.write.option("header", True).option("escape", '"').option("sep", ";").csv(src)
    files.copy_delimited(t.spark, src, dst, sep=";", escape='"')
    return files.read_delimited(t.spark, dst, "s_suppkey string, s_name string", sep=";", header=True, escape='"').select("s_suppkey", "s_name")


@query("newest_file_rows", """
    WITH f AS (SELECT event_type, user_id, date_trunc('day', max(ts)) AS mtime FROM events GROUP BY event_type, user_id
               QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY mtime DESC, user_id DESC) = 1)
    SELECT event_type AS folder, user_id, event_id FROM events JOIN f USING (event_type, user_id)
""")
def newest_file_rows(t: Tables) -> DataFrame:
    """One file per user; its time is the user's last day in the folder."""
    last = t.events.groupBy("event_type", "user_id").agg(F.date_trunc("day", F.max("ts")).alias("file_mtime"))
    rows = t.events.join(last, ["event_type", "user_id"]).withColumnsRenamed({"event_type": "folder"})
    return files.latest_file_rows(rows, path="user_id").select("folder", "user_id", "event_id")


@query("watermark_pull", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 97 = 0)
""")
def watermark_pull(t: Tables) -> DataFrame:
    held = t.orders.where("o_orderstatus = 'F' AND o_orderkey % 97 = 0")
    return files.read_incremental(t.orders, held, "o_orderdate", "o_orderdate").select("o_orderkey", "o_orderdate")


@query("appended_columns", """
    SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 1 THEN n_regionkey END AS n_regionkey FROM nation
""")
def appended_columns(t: Tables) -> DataFrame:
    """Two appends, the second with one more column, compacted to one file and read as one table."""
    path, dst = _folder(t, "appends"), _folder(t, "compacted")
    files.append(t.nation.where("n_nationkey % 2 = 0").select("n_nationkey", "n_name"), path)
    files.append(t.nation.where("n_nationkey % 2 = 1").select("n_nationkey", "n_name", "n_regionkey"), path, single_file=True)
    files.read_merged(t.spark, path).repartition(7).write.parquet(f"{dst}/small")
    compact(t.spark, f"{dst}/small", f"{dst}/large")
    return t.spark.read.parquet(f"{dst}/large").select("n_nationkey", "n_name", "n_regionkey")


@query("partition_upsert", """
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 3 AND c_nationkey < 5 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def partition_upsert(t: Tables) -> DataFrame:
    """Customers in hash partitions; only those of the changed rows are rewritten."""
    path = _folder(t, "partitions")
    rows = bucket_column(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey"), ["c_custkey"], 8)
    rows.drop("c_nationkey").write.partitionBy("key_bucket").parquet(path)
    changed = rows.where("c_custkey % 7 = 3 AND c_nationkey < 5").select("c_custkey", F.lit("new").alias("c_mktsegment"), "key_bucket")
    update_partitions(t.spark, path, changed, "key_bucket", lambda old, new: U.scd1(old, new, ["c_custkey"], keep=["key_bucket"]))
    return t.spark.read.parquet(path).select("c_custkey", "c_mktsegment")


# ---- streams ---------------------------------------------------------------


@query("stream_replay", """
    SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_replay(t: Tables) -> DataFrame:
    """Events in four parts, one per micro-batch; the second batch fails, is captured and comes again with the third."""
    root, keys = _folder(t, "replay"), ["user_id", "event_type"]
    rows = t.events.select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    for part in range(4):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).repartition(PART_FILES).write.mode("append").parquet(f"{root}/in")

    def last(batch: DataFrame) -> DataFrame:
        return latest_by(batch, keys, [F.col("ts").desc(), F.col("event_id").desc()])

    merge = upsert_batches(f"{root}/state", rows.limit(0), lambda old, new: U.update_if_newer(old, last(new), keys, "ts"))

    def flaky(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("no disk")
        merge(batch, batch_id)

    source = files.stream_table(t.spark, f"{root}/in", rows.schema, max_files=PART_FILES)
    drain(source, with_capture(flaky, "state", f"{root}/log", lambda: datetime(2024, 1, 1)), f"{root}/checkpoint")
    return read_snapshot(t.spark, f"{root}/state").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_accumulate", """
    SELECT user_id, event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY ALL
""")
def stream_accumulate(t: Tables) -> DataFrame:
    """Events in four batches added up in a bucketed state; each batch comes twice, as after a crash, and counts once."""
    root, keys = _folder(t, "accumulate"), ["user_id", "event_type"]
    rows = t.events.select(*keys, "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))

    def summed(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))

    empty = summed(rows).limit(0)
    merge = upsert_batches(f"{root}/state", empty, lambda old, new: U.accumulate(old, summed(new), keys, add=["n", "total"]),
                           stream="events", keys=keys, buckets=16)
    for part in range(4):
        batch = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part)
        merge(batch, part)
        merge(batch, part)
    return read_buckets(t.spark, f"{root}/state", empty)


@query("stream_chain", """
    SELECT user_id, count(*) AS n, max(event_id) AS last_id,
           count(DISTINCT event_type) AS n_types FROM events GROUP BY user_id
""")
def stream_chain(t: Tables) -> DataFrame:
    """A source with two hops: events are appended to a table, which feeds two states; all streams restart half-way."""
    root = _folder(t, "chain")
    rows = t.events.select("user_id", "event_type", "event_id")

    def counted(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"))

    def typed(batch: DataFrame) -> DataFrame:
        return batch.select("user_id", "event_type").distinct()

    counts, types = counted(rows).limit(0), typed(rows).limit(0)
    add = upsert_batches(
        f"{root}/counts", counts, lambda old, new: U.upsert(
            old, counted(new), ["user_id"], update={"n": "t.n + s.n", "last_id": "greatest(t.last_id, s.last_id)"}),
        stream="counts", keys=["user_id"], buckets=8)
    meet = upsert_batches(f"{root}/types", types, lambda old, new: U.insert_only(old, typed(new), ["user_id", "event_type"]),
                          stream="types", keys=["user_id"], buckets=8)
    for half in range(2):
        for part in (2 * half, 2 * half + 1):
            rows.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == part).repartition(PART_FILES).write.mode("append").parquet(f"{root}/in")
        drain(files.stream_table(t.spark, f"{root}/in", rows.schema, max_files=PART_FILES), append_batches(f"{root}/middle"), f"{root}/c0")
        for name, sink in (("c1", add), ("c2", meet)):
            drain(files.stream_table(t.spark, f"{root}/middle/batch_id=*", rows.schema, max_files=PART_FILES), sink, f"{root}/{name}")
    by_user = read_buckets(t.spark, f"{root}/types", types).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_types"))
    return read_buckets(t.spark, f"{root}/counts", counts).join(by_user, "user_id")


# ---- columns, filters, file lists ------------------------------------------


@query("row_stamps", """
    SELECT p_partkey, 'job' AS created_by, TIMESTAMP '2024-01-01' AS updated_at,
           sha256(CAST(p_partkey AS VARCHAR) || chr(31) || coalesce(CASE WHEN p_size > 10 THEN p_name END, '\\N')) AS row_id FROM part
""")
def row_stamps(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_name")).alias("p_name"))
    stamped = K.stamp(rows, "job", datetime(2024, 1, 1), ["p_partkey", "p_name"])
    return stamped.select("p_partkey", "created_by", F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), "row_id")


@query("hidden_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def hidden_columns(t: Tables) -> DataFrame:
    return K.drop_pii(t.customer, ["C_NAME", "c_AcctBal", "absent"])


@query("recent_and_effective", """
    SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01' - INTERVAL 90 DAY AND o_totalprice BETWEEN o_custkey AND o_custkey * 100.0
""")
def recent_and_effective(t: Tables) -> DataFrame:
    held = K.effective_on("o_totalprice", F.col("o_custkey").cast("double"), F.col("o_custkey") * 100.0)
    return t.orders.where(K.recent("o_orderdate", datetime(2000, 8, 1), 90) & held).select("o_orderkey")


@query("insert_uncovered", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
""")
def insert_uncovered(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    covered = t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return U.insert_uncovered(rows.where("o_orderkey % 3 = 0"), rows.where("o_orderkey % 3 > 0"), covered=covered, row_key=["o_orderkey"])


@query("source_files", """
    WITH r AS (SELECT event_id AS file_id, upper('dev' || user_id) AS serial, CASE WHEN event_id % 3 = 0 THEN 'COM1' ELSE 'COM3' END AS device_type, event_type,
                      date_trunc('day', ts) AS stamp, CASE WHEN event_id % 2 = 0 THEN date_trunc('hour', ts) END AS given, ts FROM events),
    f AS (SELECT *, CASE WHEN device_type = 'COM1' THEN given ELSE coalesce(given, stamp) END AS log_start FROM r)
    SELECT file_id, serial AS external_serial, log_start,
           CASE WHEN row_number() OVER (PARTITION BY serial, device_type, event_type, stamp ORDER BY log_start DESC NULLS LAST, ts DESC, file_id) = 1 THEN 1 ELSE 2 END AS unique_sequence
    FROM f
""")
def source_files(t: Tables) -> DataFrame:
    """Several registry rows of one file, half of them without log times."""
    at = F.col("event_id")
    given = F.when(at % 2 == 0, F.date_trunc("hour", "ts")).cast("timestamp")
    registry = t.events.select(
        at.alias("file_id"), F.concat(F.lit("dev"), F.col("user_id").cast("string")).alias("external_serial"), F.lit(None).cast("string").alias("internal_serial"),
        F.when(at % 3 == 0, "COM1").otherwise("COM3").alias("device_type"), F.col("event_type").alias("message_type"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("000000.csv")).alias("file_stamp"), F.lit("").alias("file_port"), F.lit("").alias("file_cycle_nbr"),
        given.alias("log_start"), given.alias("log_end"), F.col("ts").alias("updated_at"))
    return reports.source_files(registry).select("file_id", "external_serial", F.col("log_start").cast("timestamp_ntz").alias("log_start"), "unique_sequence")


# ---- merges into filled targets --------------------------------------------


@query("merge_cycles", """
    WITH c AS (SELECT 'p' || l_partkey % 40 AS external_serial, CASE WHEN l_suppkey % 9 > 0 THEN 's' || l_suppkey % 5 END AS internal_serial, 'c' || l_suppkey % 3 AS card,
                      l_linenumber AS cycle_nbr, l_shipdate AS start_ts, l_partkey % 2 AS head, max(l_orderkey) AS cycle_id
               FROM lineitem GROUP BY ALL),
    target AS (SELECT * FROM c WHERE cycle_id % 4 = 0)
    SELECT * FROM target
    UNION ALL
    SELECT * FROM c WHERE cycle_id % 4 <> 0 AND NOT EXISTS (SELECT 1 FROM target g WHERE g.external_serial = c.external_serial
        AND g.internal_serial = c.internal_serial AND g.card = c.card AND g.cycle_nbr = c.cycle_nbr AND g.start_ts = c.start_ts)
""")
def merge_cycles(t: Tables) -> DataFrame:
    """Cycles of two heads; a known record is not inserted again under its other head."""
    part = F.col("l_partkey")
    cycles = t.lineitem.groupBy(
        F.concat(F.lit("p"), (part % 40).cast("string")).alias("external_serial"),
        F.when(F.col("l_suppkey") % 9 > 0, F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string"))).alias("internal_serial"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 3).cast("string")).alias("card"), F.col("l_linenumber").alias("cycle_nbr"),
        F.col("l_shipdate").alias("start_ts"), (part % 2).alias("head"),
    ).agg(F.max("l_orderkey").alias("cycle_id"))
    target = cycles.where("cycle_id % 4 = 0")
    batch = cycles.where("cycle_id % 4 <> 0").withColumn("event_end", F.col("start_ts"))
    return C.merge_cycles(target, batch.union(batch), C.GEN3)


@query("merge_gen1", """
    WITH e AS (SELECT 'UL_s' || user_id || '_' || event_id % 5 || '.csv' AS file_name, CASE WHEN event_id % 7 > 0 THEN 'Card' || event_id % 3 END AS card,
                      CASE WHEN event_id % 11 > 0 THEN CAST(event_id % 4 AS INTEGER) END AS cycle_count, CASE WHEN event_id % 13 > 0 THEN date_trunc('day', ts) END AS begin_ts, event_id
               FROM events),
    k AS (SELECT *, 'S' || split_part(substr(file_name, 5), '_', 1) AS s, upper(coalesce(card, '')) AS c, coalesce(cycle_count, 0) AS n FROM e),
    target AS (SELECT * FROM k WHERE event_id % 3 = 0)
    SELECT file_name, card, cycle_count, begin_ts FROM target
    UNION ALL
    SELECT file_name, card, cycle_count, begin_ts FROM (
        SELECT *, CASE WHEN begin_ts IS NOT NULL THEN row_number() OVER (PARTITION BY s, c, n, begin_ts ORDER BY file_name, cycle_count NULLS FIRST, card NULLS FIRST) ELSE 1 END AS nth
        FROM k WHERE event_id % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM target g WHERE g.s = k.s AND g.c = k.c AND g.n = k.n AND g.begin_ts = k.begin_ts))
    WHERE nth = 1
""")
def merge_gen1(t: Tables) -> DataFrame:
    """Gen-1 cycles that come again in other files of the same device."""
    at = F.col("event_id")
    rows = t.events.select(
        F.concat(F.lit("UL_s"), F.col("user_id").cast("string"), F.lit("_"), (at % 5).cast("string"), F.lit(".csv")).alias("file_name"),
        F.when(at % 7 > 0, F.concat(F.lit("Card"), (at % 3).cast("string"))).alias("card"), F.when(at % 11 > 0, (at % 4).cast("int")).alias("cycle_count"),
        F.when(at % 13 > 0, F.date_trunc("day", "ts")).cast("timestamp_ntz").alias("begin_ts"), "event_id")
    return C.merge_gen1(rows.where("event_id % 3 = 0").drop("event_id"), rows.where("event_id % 3 <> 0"))


@query("upsert_null_keys", """
    WITH s AS (SELECT CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey END AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 2 = 0),
    t AS (SELECT CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS k, o_totalprice - 1 AS v FROM orders WHERE o_orderkey % 4 > 0)
    SELECT t.k, coalesce(s.v, t.v) AS v FROM t LEFT JOIN s ON s.k = t.k
    UNION ALL SELECT k, v FROM s WHERE k IS NULL OR k NOT IN (SELECT k FROM t WHERE k IS NOT NULL)
""")
def upsert_null_keys(t: Tables) -> DataFrame:
    """Null keys match nothing and repeat on both sides."""
    key = F.col("o_orderkey")
    source = t.orders.where("o_orderkey % 2 = 0").select(F.when(key % 5 > 0, key).alias("k"), F.col("o_totalprice").alias("v"))
    target = t.orders.where("o_orderkey % 4 > 0").select(F.when(key % 3 > 0, key).alias("k"), (F.col("o_totalprice") - 1).alias("v"))
    return U.scd1(target, source, ["k"])


@query("accumulate_sets", """
    WITH s AS (SELECT user_id AS k, count(*) FILTER (WHERE value > 400) AS n, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS ids FROM events WHERE event_id % 3 = 0 GROUP BY 1),
    t AS (SELECT user_id AS k, CASE WHEN user_id % 4 > 0 THEN count(*) END AS n, string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS ids FROM events WHERE event_id % 3 > 0 GROUP BY 1)
    SELECT coalesce(t.k, s.k) AS k, CASE WHEN t.n IS NULL THEN s.n ELSE t.n + coalesce(s.n, 0) END AS n,
           list_aggregate(list_sort(list_distinct(string_split(concat_ws('|', t.ids, s.ids), '|'))), 'string_agg', '|') AS ids
    FROM t FULL JOIN s USING (k)
""")
def accumulate_sets(t: Tables) -> DataFrame:
    """Counters with gaps and sets behind a separator that means something in patterns."""
    def side(rows: DataFrame, n) -> DataFrame:
        return rows.groupBy(F.col("user_id").alias("k")).agg(n.alias("n"), F.concat_ws("|", F.array_sort(F.collect_set("event_type"))).alias("ids"))

    source = side(t.events.where("event_id % 3 = 0"), F.count(F.when(F.col("value") > 400, 1)))
    target = side(t.events.where("event_id % 3 > 0"), F.count(F.lit(1))).withColumn("n", F.when(F.col("k") % 4 > 0, F.col("n")))
    return U.accumulate(target, source, ["k"], add=["n"], merge_sets=["ids"], separator="|")


# ---- repeats: attempts on archives, later loads of numbers ------------------


@query("dead_letter_replay", """
    WITH a AS (SELECT event_id, 'd' || user_id AS destination, 'a' || user_id || '-' || (event_id % 20) AS archive, ts,
                      CASE WHEN value >= 80 THEN CAST(floor(value) AS BIGINT) END AS size FROM events),
    r AS (SELECT DISTINCT 'd' || user_id AS destination, 150 AS loaded FROM events WHERE user_id % 2 = 0),
    h AS (SELECT a.*, greatest(max(size) OVER (PARTITION BY a.destination ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), loaded) AS held
          FROM a LEFT JOIN r ON r.destination = a.destination),
    j AS (SELECT *, CASE WHEN size IS NULL THEN 'Failed' WHEN held IS NULL THEN 'New' WHEN size > held THEN 'Replace' ELSE 'Duplicate' END AS status FROM h)
    SELECT archive, count(*) AS n_attempts, count(*) FILTER (WHERE status = 'Failed') AS n_failed, count(*) FILTER (WHERE status = 'Replace') AS n_replaced,
           CASE WHEN bool_or(status IN ('New', 'Replace')) THEN 'loaded' WHEN bool_or(status = 'Duplicate') THEN 'duplicate'
                WHEN count(*) FILTER (WHERE status = 'Failed') >= 3 THEN 'given_up' ELSE 'waiting' END AS state
    FROM j GROUP BY archive
""")
def dead_letter_replay(t: Tables) -> DataFrame:
    """Attempts on archives of which some can't be read; half of the destinations hold a file already."""
    user = F.col("user_id").cast("string")
    attempts = t.events.select(
        F.col("event_id").alias("attempt_id"), F.concat(F.lit("d"), user).alias("destination"),
        F.concat(F.lit("a"), user, F.lit("-"), (F.col("event_id") % 20).cast("string")).alias("archive"),
        F.when(F.col("value") >= 80, F.floor("value")).cast("long").alias("file_size"), F.col("ts").cast("timestamp").alias("attempted_at"))
    registry = t.events.where("user_id % 2 = 0").select(F.concat(F.lit("d"), user).alias("destination"), F.lit(150).cast("long").alias("file_size")).distinct()
    return archive_states(replay_attempts(attempts, registry))


@query("consumer_numbers_later", """
    WITH ids AS (SELECT DISTINCT o_custkey FROM orders)
    SELECT o_custkey % 3 = 0 AS first_load, count(*) AS n,
           CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 1 + (SELECT count(*) FROM ids WHERE o_custkey % 3 = 0) END AS lowest,
           CASE WHEN o_custkey % 3 = 0 THEN count(*) ELSE (SELECT count(*) FROM ids) END AS highest
    FROM ids GROUP BY 1, 3, o_custkey % 3 = 0
""")
def consumer_numbers_later(t: Tables) -> DataFrame:
    """A second load goes on after the greatest number of the first, whose numbers stay."""
    ids = t.orders.select(F.col("o_custkey").cast("string").alias("consumer_id"))
    early = F.col("consumer_id").cast("long") % 3 == 0
    first = settle(masters.number_consumers(t.spark.createDataFrame([], "consumer_id string, scanned_id bigint"), ids.where(early)))
    both = masters.number_consumers(first, ids)
    return both.groupBy(early.alias("first_load")).agg(
        F.count_distinct("scanned_id").alias("n"), F.min("scanned_id").alias("lowest"), F.max("scanned_id").alias("highest"))
