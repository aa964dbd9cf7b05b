"""Session set-up, lineage cuts and the size check that guards every broadcast."""

from __future__ import annotations

import tempfile
from functools import reduce
from operator import add
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest table (bytes, by the plan's estimate and by its rows in memory) that `small` will broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024

_RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # A task takes so many bytes whatever the input: many fine partitions, which adaptive execution joins up to this
    # size, and small splits of files. With few partitions a task's sort and hash table grow with the input.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "usagelake", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session; `master` only for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on to a session made elsewhere."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only where none is named and the master is local,
    so that driver and executors share the machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="usagelake-checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back.

    Survives lost executors, is computed once, and gives later steps real sizes
    and column pruning.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; grows with the input and is never a row sample."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def memory_bytes(df: DataFrame) -> int:
    """What the rows take in a hash table, roughly: some 64 bytes a row, 8 a field, and their texts. Reads the rows once."""
    atomic = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema if not isinstance(f.dataType, atomic)]
    row = F.lit(64 + 8 * len(df.columns)).cast("long")
    return df.select(reduce(add, texts, row).alias("_bytes")).agg(F.sum("_bytes")).first()[0] or 0


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """The estimate alone isn't enough: it is that of packed files, which may hold a hundred times as much in memory."""
    return plan_bytes(df) <= limit and memory_bytes(df) <= limit


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only while `df` is under `limit`; else leave the join to Catalyst.

    Where only the estimate is under it, Catalyst would be misled as well, so the join is told to be a shuffled one.
    """
    if plan_bytes(df) > limit:
        return df
    return F.broadcast(df) if memory_bytes(df) <= limit else df.hint("merge")


def small_by_nature(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`small`, for a table with few rows whose plan can't tell: a total over a large table, rows made by the driver.

    It is stored first, so that the estimate is its real size. A join on its few keys would deal all rows to few tasks.
    """
    return small(df if plan_bytes(df) <= limit else settle(df), limit)
