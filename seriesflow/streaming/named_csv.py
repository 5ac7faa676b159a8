"""CSV files of any header as a stream: columns go by name, never by place.

Each micro-batch takes the files that have landed, groups them by their header line and reads every group in one
scan with its own columns. So runs with columns in another order, with more or with fewer columns may land side by
side. What headers there were is kept as rows. Spark's own CSV stream has one schema for all files and goes by place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from seriesflow.operators.checks import concat
from seriesflow.session import path_exists
from seriesflow.sources.landing import CSV, RUN_FOLDERS, streaming

#: Files of a micro-batch where the caller sets no limit: their names pass through the driver.
MOST_FILES = 10_000

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_HEADERS = "header string, columns array<string>, added array<string>, missing array<string>, files bigint, _batch bigint"


def stream_files(
    spark: SparkSession, path: str, pattern: str | None = None, limits: dict[str, str] | None = None
) -> DataFrame:
    """``(path)`` of files as they land; they are listed, not read."""
    reader = streaming(spark, _FILES, limits or {"maxFilesPerTrigger": str(MOST_FILES)}).options(**RUN_FOLDERS)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format("binaryFile").load(path).select("path")


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, header)``: the first line of each file; a file without any line has no row.

    Only the first block of a file is read, and its lines are reduced to one before any shuffle.
    """
    # The name of a file arrives as a URI.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = spark.read.text(list(paths)).select(
        path.alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    return lines.where("start = 0").groupBy("path").agg(F.min_by("value", "place").alias("header"))


def _named(spark: SparkSession, paths: list[str], corrupt: str | None) -> tuple[DataFrame, list[str]]:
    """Files of one header as text columns of its names, and those names."""
    names = spark.read.options(**CSV).csv(paths[:1]).columns
    fields = [StructField(n, StringType()) for n in names]
    reader = spark.read.options(**CSV).option("enforceSchema", False)
    if corrupt:
        fields.append(StructField(corrupt, StringType()))
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(StructType(fields)).csv(paths), names


def read_named(
    spark: SparkSession,
    paths: Sequence[str],
    schema: StructType,
    required: Sequence[str] = (),
    extra: str | None = None,
    corrupt: str | None = None,
) -> tuple[DataFrame, list[tuple]]:
    """The files as the columns of ``schema``, and a row for each header: line, columns, added, missing, files.

    Columns that a file lacks are NULL; those that ``schema`` lacks go, or are kept as JSON text in column ``extra``.
    With ``corrupt`` the text of a line that has too few or too many fields is kept in a column of that name. A
    header without all ``required`` columns is an error: such a file is no run, or has no header line.
    """
    grouped = headers(spark, paths).groupBy("header").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    kept = StructType([*schema.fields, *(StructField(c, StringType()) for c in (extra, corrupt) if c)])
    frames, versions = [spark.createDataFrame([], kept)], []
    for header, own in grouped.orderBy("header").collect():
        rows, names = _named(spark, own, corrupt)
        lacking = [c for c in required if c not in names]
        if lacking:
            raise ValueError(f"no column {', '.join(lacking)} in {own[0]}")
        added = [c for c in names if c not in schema.names]
        versions.append((header, names, added, [c for c in schema.names if c not in names], len(own)))
        columns = [(F.col(f"`{c}`") if c in names else F.lit(None).cast("string")).alias(c) for c in schema.names]
        if extra:
            columns.append((F.to_json(F.struct(*(f"`{c}`" for c in added))) if added else F.lit(None).cast("string")).alias(extra))
        frames.append(rows.select(*columns, *([corrupt] if corrupt else [])))
    return concat(frames), versions


def start_named_csv(
    spark: SparkSession,
    path: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    transform: Callable[[DataFrame], DataFrame],
    interval: str | None = None,
    pattern: str | None = None,
    limits: dict[str, str] | None = None,
    **reading,
) -> StreamingQuery:
    """Append the files below ``path``, after ``transform``, to a folder of ``target`` for each micro-batch.

    A replayed batch that was complete is left alone, else its folder is written again, so nothing is added twice.
    Readers see a batch as its files are moved into place; one that must not see a batch that a crash cut short
    starts after this query has ended, as :func:`seriesflow.plans.update.run_update` does. Read ``target`` with
    ``recursiveFileLookup``.
    """
    checkpoint, target = checkpoint.rstrip("/"), target.rstrip("/")

    def load(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        folder = f"{target}/batch-{batch_id:09d}"
        if path_exists(own, f"{folder}/_SUCCESS"):
            return
        paths = [r["path"] for r in batch.collect()]
        rows, versions = read_named(own, paths, schema, **reading)
        noted = own.createDataFrame([(*v, batch_id) for v in versions], _HEADERS)
        noted.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/headers/{batch_id}")
        transform(rows).write.mode("overwrite").parquet(folder)

    writer = stream_files(spark, path, pattern, limits).writeStream.foreachBatch(load)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def seen_headers(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The headers that a flow has met: ``(header, columns, added, missing, files, first_batch, last_batch)``."""
    noted = spark.read.schema(_HEADERS).option("recursiveFileLookup", True).parquet(f"{checkpoint.rstrip('/')}/headers")
    return noted.groupBy("header", "columns", "added", "missing").agg(
        F.sum("files").alias("files"), F.min("_batch").alias("first_batch"), F.max("_batch").alias("last_batch")
    )
