"""Landed files and upstream tables, as batch and stream."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from seriesflow.operators.checks import concat

CORRUPT_COLUMN = "_corrupt_record"

# The file source forgets, and ignores, files much older than the newest one (a week by default). Landed
# files must never be skipped, whenever they arrive.
_KEEP_ALL_FILES = {"maxFileAge": "36500d"}

# Landing CSV doubles a quote inside a quoted field.
CSV = {"header": "true", "escape": '"'}


# Runs land in folders of their own; folders whose name starts with an underscore are never data.
RUN_FOLDERS = {"recursiveFileLookup": "true"}


def streaming(spark: SparkSession, schema: StructType | str, limits: dict[str, str] | None):
    """A stream reader of files; none is skipped for its age."""
    reader = spark.readStream.schema(schema).options(**_KEEP_ALL_FILES)
    return reader.options(**(limits or {}))


def stream_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str | None = None,
    limits: dict[str, str] | None = None,
) -> DataFrame:
    """Incremental CSV source with a header line, files and run folders below ``path`` (which may be a glob).

    CSV columns go by position, so a header that differs from ``schema`` stops the stream, rather than shifting
    values into wrong columns; :mod:`seriesflow.streaming.named_csv` takes any header. ``limits`` takes
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.
    """
    reader = streaming(spark, schema, limits).options(**CSV, **RUN_FOLDERS).option("enforceSchema", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(path)


def stream_json(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pattern: str | None = None,
    limits: dict[str, str] | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Incremental JSON-lines source, files and run folders below ``path``; columns go by name, a broken line is a row of NULLs.

    With ``corrupt_column`` its text is kept in a column of that name.
    """
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
    reader = streaming(spark, schema, limits).options(**RUN_FOLDERS).option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, limits: dict[str, str] | None = None, nested: bool = False
) -> DataFrame:
    """Stream the rows that an upstream append flow commits; ``nested`` where it has a folder for each batch."""
    reader = streaming(spark, schema, limits)
    return (reader.options(**RUN_FOLDERS) if nested else reader).parquet(path)


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_csv_runs(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Batch read by column name: every path with its own header, missing columns NULL, extra ones dropped."""
    frames = [spark.read.options(**CSV).csv(p) for p in paths]
    kept = [df.select(*(c for c in schema.names if c in df.columns)) for df in frames]
    empty = spark.createDataFrame([], schema)
    return concat([empty, *kept]).select(*schema.names)


def infer_csv_schema(spark: SparkSession, sample: str | list[str], ratio: float = 1.0) -> StructType:
    """Column types of landed CSV files, from a sample of files or rows."""
    reader = spark.read.options(**CSV).option("inferSchema", True).option("samplingRatio", ratio)
    return reader.csv(sample).schema


def infer_json_schema(spark: SparkSession, sample: str | list[str], ratio: float = 1.0) -> StructType:
    return spark.read.option("samplingRatio", ratio).json(sample).schema


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Freeze a schema as one line of JSON next to the data."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))


def evolve_schema(frozen: StructType, found: StructType) -> StructType:
    """The frozen columns in their order and types, then the columns only the new files have."""
    known = set(frozen.names)
    return StructType([*frozen.fields, *(f for f in found.fields if f.name not in known)])


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size, file_modification_time) of all files below ``path``.

    File contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("file_modification_time"),
    )


def landed_rows(rows: DataFrame, path: str) -> DataFrame:
    """(file_path, file_size, file_modification_time, rows) of all files below ``path``: how many of ``rows`` each gave.

    ``rows`` are read from these files without a change of their number; a file that gave none has 0. Files
    without any byte are not listed.
    """
    lineage = ("file_path", "file_size", "file_modification_time")
    listed = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listed.select(*(F.col(f"_metadata.{c}").alias(c) for c in lineage))
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("_n"))
    return files.join(counted, "file_path", "left").select(*lineage, F.coalesce("_n", F.lit(0)).cast("bigint").alias("rows"))


def total_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files below the paths; one number reaches the driver."""
    # Scan tasks are cut by file size, but here nothing is read: let every core take one share of the files.
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 50))
    sizes = [landed_files(lister, path).select("file_size") for path in paths]
    return concat(sizes).agg(F.sum("file_size")).first()[0] or 0


def between_dates(
    df: DataFrame, start: str | None = None, end: str | None = None, date: str = "date"
) -> DataFrame:
    """Rows with ``start <= date <= end``; each bound is optional.

    A timestamp column is compared as it is stored, so that the filter still reaches the file scan.
    """
    column = F.col(date)
    if isinstance(df.schema[date].dataType, DateType):
        low, high = column >= F.lit(start).cast("date"), column <= F.lit(end).cast("date")
    else:
        day_type = df.schema[date].dataType
        after = None if end is None else (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
        low, high = column >= F.lit(start).cast(day_type), column < F.lit(after).cast(day_type)
    if start is not None:
        df = df.filter(low)
    return df if end is None else df.filter(high)
