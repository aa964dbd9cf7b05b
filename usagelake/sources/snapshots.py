"""Tables that are replaced as a whole, on plain Parquet directories.

Without a row-level table format an upsert writes a new snapshot: ``v=N+1`` is
staged beside ``v=N`` and becomes current once its success marker exists, so a
failed write leaves the old one readable. Large tables are partitioned and only
the touched partitions are rewritten.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelake.session import settle


def _versions(spark: SparkSession, path: str) -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v=") and fs.exists(marker):
            found.append(int(name[2:]))
    return sorted(found)


def current_version(spark: SparkSession, path: str) -> int | None:
    versions = _versions(spark, path)
    return versions[-1] if versions else None


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = current_version(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no complete snapshot under {path}")
    return spark.read.parquet(f"{path}/v={version}")


def write_snapshot(df: DataFrame, path: str) -> int:
    """Write the next version and return its number. One writer per table."""
    version = (current_version(df.sparkSession, path) or 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest `keep` versions; a reader of an older one must be done."""
    newest = current_version(spark, path) or 0
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    for status in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root) if newest else ():
        name = status.getPath().getName()
        if name.startswith("v=") and name[2:].isdigit() and int(name[2:]) <= newest - keep:
            _remove(spark, f"{path}/{name}")
            _remove(spark, f"{path}/notes/{name}")


def update_snapshot(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> int:
    """Read the current version, apply a pure function, write the next version."""
    return write_snapshot(change(read_snapshot(spark, path)), path)


def update_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    partition: str,
    change: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Upsert into a partitioned directory, reading and rewriting only touched partitions.

    `partition` is a column of both sides (such as a month or a hash of the key);
    its distinct values in the source are the partitions of one batch. The new
    rows are stored apart first, so the folder is not read while it is written;
    a touched partition that has no rows left is removed.
    """
    touched = settle(source.select(F.col(partition).alias("_touched")).distinct())
    if touched.isEmpty():
        return
    # Null-safe: a null partition is read and rewritten like any other.
    target = spark.read.parquet(path)
    target = target.join(F.broadcast(touched), F.col(partition).eqNullSafe(F.col("_touched").cast(target.schema[partition].dataType)), "left_semi")
    changed = settle(change(target, source))
    left = changed.select(F.col(partition).alias("_left")).distinct()
    emptied = touched.join(left, F.col("_touched").eqNullSafe(F.col("_left").cast(touched.schema["_touched"].dataType)), "left_anti")
    emptied = [row[0] for row in emptied.select(F.col("_touched").cast("string")).collect()]
    (
        changed.repartition(F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in emptied:  # folders are named as Spark escapes them
        _remove(spark, f"{path}/{named.getPartitionPathString(partition, value)}")


BUCKET = "key_bucket"


def read_note(spark: SparkSession, path: str) -> dict:
    """What was noted with the current version: `merged` (last batch of each stream) and `newest` (version of each bucket)."""
    version = current_version(spark, path)
    if not version:
        return {}
    return json.loads(spark.read.text(f"{path}/notes/v={version}").first()[0])


def _write_note(spark: SparkSession, path: str, version: int, note: dict) -> None:
    """Notes are written before their version, and count once that is complete."""
    spark.createDataFrame([(json.dumps(note),)], "note string").coalesce(1).write.mode("overwrite").text(f"{path}/notes/v={version}")


def write_noted(df: DataFrame, path: str, note: dict) -> int:
    """Write the next version with a note."""
    _write_note(df.sparkSession, path, (current_version(df.sparkSession, path) or 0) + 1, note)
    return write_snapshot(df, path)


def read_buckets(spark: SparkSession, path: str, empty: DataFrame, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows of a bucketed state (or of some buckets), each bucket in its newest version."""
    newest = read_note(spark, path).get("newest", {})
    folders = [f"{path}/v={version}/{BUCKET}={b}" for b, version in newest.items() if buckets is None or int(b) in buckets]
    return spark.read.schema(empty.schema).parquet(*folders) if folders else empty


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int, touched: Sequence[int], merged: dict[str, int]) -> int:
    """Replace the touched buckets by `df` in one write; the files of all others stay as they are.

    Bucket numbers, at most `buckets`, are all that reaches the driver.
    """
    spark = df.sparkSession
    rows = settle(bucket_column(df, keys, buckets, BUCKET))
    version = (current_version(spark, path) or 0) + 1
    newest = {b: v for b, v in read_note(spark, path).get("newest", {}).items() if int(b) not in touched}
    filled = [row[0] for row in rows.select(BUCKET).distinct().collect()]
    note = {"merged": merged, "newest": {**newest, **{str(b): version for b in filled}}}
    former = read_note(spark, path)
    _write_note(spark, path, version, note)
    rows.repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/v={version}")
    _expire_buckets(spark, path, version, [note, former])
    return version


def _expire_buckets(spark: SparkSession, path: str, newest: int, notes: Sequence[dict]) -> None:
    """Remove bucket folders that neither the current nor the former version reads."""
    read = {f"v={v}/{BUCKET}={b}" for note in notes for b, v in note.get("newest", {}).items()}
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        version = status.getPath().getName()
        if not version.startswith("v=") or int(version[2:]) >= newest - 1:
            continue
        folders = [s.getPath().getName() for s in fs.listStatus(status.getPath()) if s.getPath().getName().startswith(f"{BUCKET}=")]
        gone = [f for f in folders if f"{version}/{f}" not in read]
        if len(gone) == len(folders):
            _remove(spark, f"{path}/{version}")
            _remove(spark, f"{path}/notes/{version}")
        else:
            for folder in gone:
                _remove(spark, f"{path}/{version}/{folder}")


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = 512 * 1024 * 1024) -> int:
    """Rewrite a directory of small files into files near `target_bytes`; returns the file count."""
    root = spark._jvm.org.apache.hadoop.fs.Path(src)
    size = root.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(root).getLength()
    files = max(1, math.ceil(size / target_bytes))
    spark.read.parquet(src).repartition(files).write.mode("overwrite").parquet(dst)
    return files


def bucket_column(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "key_bucket") -> DataFrame:
    """Hash partition column for large upsert targets."""
    return df.withColumn(name, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))
