"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from usagelake.session import shared_folder

#: Spark removes a finished query's shuffle files at once where this is on.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables in the folder that all executors share; `drop` removes those that nothing reads any more.

    A stored table cuts lineage, is computed once and outlives lost executors. The shuffle files of the query that
    wrote it are removed as soon as it is complete.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"

    def store(self, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
        path = f"{self.path}/{name}"
        with shuffle_cleanup(self.spark):
            df.write.mode("overwrite").parquet(path, compression=codec)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB: many long texts at once would fill the memory that is left beside the heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def whole_text(column: str = "text") -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def long_ids(docs: DataFrame) -> DataFrame:
    """`docs` with doc_id as long, for operators whose rows pass through Python with that type."""
    return docs if docs.schema["doc_id"].dataType.simpleString() == "bigint" else docs.withColumn("doc_id", F.col("doc_id").cast("long"))


def digest(column: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(column, 256))


def keep_rows(docs: DataFrame, verdicts: DataFrame, *, once: bool = False) -> DataFrame:
    """Rows of `docs` whose (doc_id, text digest) is in `verdicts` (doc_id, text_digest); columns stay as they are.

    Rows are matched null-safe and by content, so a doc_id that stands on several texts is judged text by text.
    `once` leaves one of rows that repeat both doc_id and text. Own columns may have any names.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"),
                         digest(whole_text()).alias("sha"))
    wanted = verdicts.select(F.col("doc_id").alias("want_id"), F.col("text_digest").alias("want_sha"))
    kept = packed.join(wanted, F.col("id").eqNullSafe(F.col("want_id")) & (F.col("sha") == F.col("want_sha")), "left_semi")
    if once:
        order = Window.partitionBy("id", "sha").orderBy(F.lit(0))
        kept = kept.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return kept.select("row.*")
