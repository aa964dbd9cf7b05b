"""File sources and sinks: delimited text, header+JSON lines, streams, copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_COLUMNS = {
    "file_path": "_metadata.file_path",
    "file_name": "_metadata.file_name",
    "file_size": "_metadata.file_size",
    "file_mtime": "_metadata.file_modification_time",
}

# The nine header fields before the JSON payload of a log line.
HEADER_FIELDS = ("format_version", "header_date", "header_time", "log_type", "dest", "source", "command", "store_id", "contract")


def with_file_columns(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.col(source).alias(name) for name, source in FILE_COLUMNS.items()])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = False,
    rescued: str | None = None,
    **options: str,
) -> DataFrame:
    """Delimited scan with a fixed schema; path globs such as ``{a,b}/*.csv`` are allowed.

    `rescued` names a column that keeps lines which do not fit the schema.
    """
    return with_file_columns(_delimited(spark.read, schema, sep, header, rescued, options).csv(path))


def stream_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = False,
    rescued: str | None = None,
    max_files: int = 5000,
    **options: str,
) -> DataFrame:
    """The same scan as an incremental file stream with a cap on files per trigger."""
    reader = _delimited(spark.readStream, schema, sep, header, rescued, options)
    return with_file_columns(reader.option("maxFilesPerTrigger", max_files).csv(path))


def _delimited(reader, schema, sep, header, rescued, options):
    if rescued:
        parsed = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        if rescued not in parsed.fieldNames():
            parsed = T.StructType([*parsed.fields, T.StructField(rescued, T.StringType())])
        schema = parsed
        options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescued}
    return reader.schema(schema).option("sep", sep).option("header", header).options(**options)


def read_reference_csv(spark: SparkSession, path: str, casts: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """Small headered reference file: all text, then soft casts."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()})


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, **options: str) -> DataFrame:
    """JSON lines with a fixed schema; fields that a line lacks are null."""
    return with_file_columns(spark.read.schema(schema).options(**options).json(path))


def parse_header_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Log line = nine comma-separated header fields, then JSON up to the line end.

    The split limit keeps commas inside the JSON untouched.
    """
    parts = F.split(F.col(value), ",", len(HEADER_FIELDS) + 1)
    fields = {name: F.trim(F.get(parts, F.lit(i))) for i, name in enumerate(HEADER_FIELDS)}
    raw = F.trim(F.get(parts, F.lit(len(HEADER_FIELDS))))
    payload = F.when(raw.startswith('"{'), F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"')))
    day = fields["header_date"]
    fields.update(
        {
            "format_version": fields["format_version"].try_cast("int"),
            "header_date": day.try_cast("date"),
            "header_ts": F.try_to_timestamp(F.concat_ws(" ", day, fields["header_time"]), F.lit("yyyy-MM-dd HH:mm:ss.SSS")),
            "payload": F.coalesce(payload, raw),
        }
    )
    return df.select(*[c for c in df.columns if c != value], *[v.alias(k) for k, v in fields.items()])


def read_header_json_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return parse_header_json(with_file_columns(spark.read.text(path)))


def stream_header_json_lines(spark: SparkSession, path: str, max_files: int = 5000) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return parse_header_json(with_file_columns(lines))


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 5000) -> DataFrame:
    """Rows appended to a Parquet directory. Directories are append-only, so rewrites never show."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def parse_hub_messages(df: DataFrame, body: str = "body", properties: str = "properties") -> DataFrame:
    """Queue messages: body bytes to text, device id and operation from the property map."""
    return df.withColumns(
        {
            body: F.col(body).cast("string"),
            "device_id": F.try_element_at(F.col(properties), F.lit("deviceId")),
            "operation_type": F.try_element_at(F.col(properties), F.lit("opType")),
        }
    )


def latest_file_rows(df: DataFrame, folder: str = "folder", mtime: str = "file_mtime", path: str = "file_path") -> DataFrame:
    """Rows of the newest file of each folder (path breaks ties)."""
    newest = df.groupBy(folder).agg(F.max(F.struct(F.col(mtime), F.col(path)))[path].alias(path))
    return df.join(newest, [folder, path], "left_semi")


def copy_delimited(spark: SparkSession, src: str, dst: str, sep: str = ",", header: bool = True, **options: str) -> None:
    """Delimited to delimited, every field quoted; `options` (such as the escape sign) hold on both sides."""
    df = spark.read.option("sep", sep).option("header", header).option("inferSchema", False).options(**options).csv(src)
    df.write.options(**options).mode("overwrite").option("sep", sep).option("header", header).option("quoteAll", True).csv(dst)


def append(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), single_file: bool = False) -> None:
    """Append to a Parquet directory; `single_file` is for a handful of audit rows only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a directory whose appends added columns over time."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """JDBC scan; give a partition column and bounds to read it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def append_jdbc(df: DataFrame, url: str, table: str, *, drop: Sequence[str] = (), properties: dict[str, str] | None = None) -> None:
    df.drop(*drop).write.format("jdbc").mode("append").options(url=url, dbtable=table, **(properties or {})).save()


def high_watermark(target: DataFrame, column: str, default: str = "1900-01-01 00:00:00") -> DataFrame:
    """One row with the newest value in the target, or the default."""
    return target.agg(F.coalesce(F.max(column), F.lit(default).cast(target.schema[column].dataType)).alias("watermark"))


def read_incremental(source: DataFrame, target: DataFrame, source_column: str, target_column: str) -> DataFrame:
    """Source rows newer than anything in the target; the bound is a literal, so it is pushed down."""
    bound = high_watermark(target, target_column).first()["watermark"]
    return source.where(F.col(source_column) > F.lit(bound))


def unique_files(df: DataFrame, path: str = "file_path", size: str = "file_size", newest: str = "file_mtime") -> DataFrame:
    """One row per (path, size) with its record count."""
    return df.groupBy(path, size).agg(F.max(newest).alias(newest), F.count(F.lit(1)).alias("record_count"))


def files_by_folder(df: DataFrame, path: str = "file_path") -> DataFrame:
    return df.withColumn("folder", F.regexp_replace(F.col(path), "/[^/]*$", ""))


