"""Append flows: a streaming DataFrame into a parquet folder, exactly once."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesflow.operators.quality import FAILED_RULES, KEPT, OUTCOME, Expectations
from seriesflow.session import path_exists
from seriesflow.sources.landing import landed_files


def start_append(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, interval: str | None = None
) -> StreamingQuery:
    """Append the stream to ``path``.

    Without ``interval`` the query drains what is there and stops; with one (``"1 minute"``) it keeps
    running micro-batches. The checkpoint and the sink's commit log make a rerun add nothing twice.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)


def start_sorted(
    df: DataFrame, rules: Expectations, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Write the rows that keep all rules and those that break one beside each other, from one read of the stream.

    Both are partitions of one sink and are committed together under one batch id: after a replay nothing is there
    twice, and kept and rejected rows add up to what was read.
    """
    writer = rules.sorted_out(df).writeStream.format("parquet").outputMode("append").partitionBy(OUTCOME)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def read_sorted(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    """The kept rows, or the rejected ones with the rules they break; only their files are read."""
    rows = spark.read.parquet(path).where(F.col(OUTCOME) == outcome).drop(OUTCOME)
    return rows.drop(FAILED_RULES) if outcome == KEPT else rows


def drain(*queries: StreamingQuery) -> None:
    """Wait for triggered queries; the first failure is raised after all have ended."""
    failure = None
    for query in queries:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - raised below
            failure = failure or error
    if failure is not None:
        raise failure


def committed(spark: SparkSession, checkpoint: str) -> tuple[str, int]:
    """Identity of a flow and its last committed batch, -1 before the first; the state of what it has written.

    Taken before the output is read, it never names a state newer than the rows.
    """
    if not path_exists(spark, f"{checkpoint}/metadata"):
        return "", -1
    identity = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    if not path_exists(spark, f"{checkpoint}/commits"):
        return identity, -1
    number = F.element_at(F.split("file_path", "/"), -1).try_cast("bigint")
    last = landed_files(spark, f"{checkpoint}/commits").agg(F.max(number)).first()[0]
    return identity, -1 if last is None else last


_BATCH, _PERIOD = "_batch", "_period"


def appender_once(
    target: str, keys: Sequence[str] = ("series_id", "date", "run_timestamp"), date: str = "date"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the rows whose key the target does not hold yet, however late they come.

    A key is compared null-safe, so that a missing run time is a value like others. Only the calendar periods that the
    batch touches are read. Rows go to folders of their batch; a replayed batch is compared with the batches before it
    and replaces its own folders, so it adds nothing twice.
    """
    period = F.date_format(F.col(date), "yyyy-MM")

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(list(keys)).withColumn(_PERIOD, period)
        if batch_id and path_exists(spark, target):
            # One short text for each calendar period: bounded by the calendar, not by the rows.
            periods = [r[0] for r in rows.select(_PERIOD).distinct().collect()]
            touched = F.coalesce(_PERIOD, F.lit("")).isin([p or "" for p in periods])
            present = spark.read.schema(_stored(batch)).parquet(target).where((F.col(_BATCH) < batch_id) & touched)
            present = present.select(*(F.col(k).alias(f"_held_{k}") for k in keys), F.col(_PERIOD).alias("_held_period"))
            same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
            rows = rows.join(present, reduce(and_, same, F.col(_PERIOD).eqNullSafe(F.col("_held_period"))), "left_anti")
        rows.withColumn(_BATCH, F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(_BATCH, _PERIOD).parquet(target)

    return append


def _stored(rows: DataFrame) -> str:
    columns = [f"`{name}` {kind}" for name, kind in rows.dtypes]
    return ", ".join([*columns, f"{_BATCH} bigint", f"{_PERIOD} string"])


def start_append_once(
    df: DataFrame, target: str, checkpoint: str, interval: str | None = None, **options
) -> StreamingQuery:
    """Append each row of the stream once, however often and however late it is delivered. No watermark, no state."""
    writer = df.writeStream.foreachBatch(appender_once(target, **options)).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def read_once(spark: SparkSession, target: str) -> DataFrame:
    """What :func:`start_append_once` has written, without its bookkeeping columns."""
    return spark.read.parquet(target).drop(_BATCH, _PERIOD)


def drop_redelivered(
    df: DataFrame,
    delay: str,
    time: str = "run_timestamp",
    keys: tuple[str, ...] = ("series_id", "date", "run_timestamp"),
) -> DataFrame:
    """Drop rows of a stream that were delivered before, within ``delay`` of the newest run.

    State is keyed by row identity, so it spreads over all partitions, and is bounded by the watermark. Rows of
    a run that arrives later than ``delay`` are late for the watermark and dropped, so it has to exceed any
    lateness; :func:`start_append_once` and the upsert flow have no such bound.
    """
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
