"""Micro-batches around the pure functions of `plans`.

State lives in target tables, not in state stores: a micro-batch reads the
current tables, applies a batch function and writes. Natural keys and content
hashes make replays harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from usagelake.plans.intake import capture_failed, replay_failed
from usagelake.sources.snapshots import (
    bucket_column,
    current_version,
    expire_snapshots,
    read_buckets,
    read_note,
    read_snapshot,
    write_buckets,
    write_noted,
    write_snapshot,
)

BatchFunction = Callable[[DataFrame, int], None]


def run_stream(
    df: DataFrame,
    function: BatchFunction,
    checkpoint: str,
    *,
    name: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Start a foreachBatch stream in update mode.

    With `every` (such as "10 seconds") it runs until stopped; without, it drains
    what is there and stops.
    """
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(function)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def drain(df: DataFrame, function: BatchFunction, checkpoint: str) -> None:
    run_stream(df, function, checkpoint).awaitTermination()


def append_batches(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchFunction:
    """Write each batch into its own folder, so a replayed batch replaces itself.

    Readers of the table use ``path`` with the partition column `batch_id`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def upsert_batches(
    path: str,
    empty: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    *,
    stream: str | None = None,
    keys: Sequence[str] = (),
    buckets: int = 0,
) -> BatchFunction:
    """Merge each batch into a snapshot table: ``new = merge(target, batch)``.

    `stream` names one checkpoint: its last merged batch is noted in the same write as the state, and a batch that
    comes again is skipped, so counters add once. A stream with a new checkpoint needs a new name.
    With `buckets` the state is split by a hash of `keys`, and a batch reads and writes only the buckets that it
    touches; read such a state with `read_buckets`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        note = read_note(spark, path) if stream or buckets else {}
        merged = note.get("merged", {})
        if stream and merged.get(stream, -1) >= batch_id:
            return
        if batch.isEmpty():
            return
        if stream:
            merged = {**merged, stream: batch_id}
        batch.persist()
        try:
            if buckets:
                touched = [row[0] for row in bucket_column(batch, keys, buckets).select("key_bucket").distinct().collect()]
                write_buckets(merge(read_buckets(spark, path, empty, touched), batch), path, keys, buckets, touched, merged)
                return
            target = read_snapshot(spark, path) if current_version(spark, path) else empty
            new = merge(target, batch)
            write_noted(new, path, {"merged": merged}) if stream else write_snapshot(new, path)
            expire_snapshots(spark, path)
        finally:
            batch.unpersist()

    return write


def jdbc_batches(url: str, table: str, drop: Sequence[str] = (), properties: dict[str, str] | None = None) -> BatchFunction:
    from usagelake.sources.files import append_jdbc

    def write(batch: DataFrame, batch_id: int) -> None:
        append_jdbc(batch, url, table, drop=drop, properties=properties)

    return write


def with_capture(function: BatchFunction, stage: str, log_path: str, clock: Callable[[], datetime]) -> BatchFunction:
    """Replay captured rows first; capture a failing batch as JSON instead of stopping the stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{log_path}/stage={stage}"
        waiting = _captured(spark, folder)
        if waiting is not None:
            again = replay_failed(waiting.withColumn("stage", F.lit(stage)), stage, batch.schema)
            batch = again.unionByName(batch)
        version = current_version(spark, folder) or 0
        try:
            function(batch, batch_id)
        except Exception as error:  # noqa: BLE001 - any failure is kept for replay
            failed = capture_failed(batch, stage, str(batch_id), f"{type(error).__name__}: {error}", clock())
            failed.drop("stage").write.mode("overwrite").parquet(f"{folder}/v={version + 1}")
            return
        if waiting is not None:
            waiting.limit(0).write.mode("overwrite").parquet(f"{folder}/v={version + 1}")

    return write


def _captured(spark: SparkSession, folder: str) -> DataFrame | None:
    if not current_version(spark, folder):
        return None
    rows = read_snapshot(spark, folder)
    return None if rows.isEmpty() else rows
