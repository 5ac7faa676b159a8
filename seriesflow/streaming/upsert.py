"""Upsert of revised observations into a partitioned parquet folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seriesflow.operators.revisions import latest_wins
from seriesflow.session import path_exists, spread_writes
from seriesflow.sources.landing import total_bytes

TOUCHED, CONFIRMED = "touched", "confirmed"

_PERIOD_FORMATS = {"year": "yyyy", "month": "yyyy-MM"}


def _staged(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether ``path`` holds the committed rows of this batch."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return False
    first = spark.read.parquet(path).select("_batch_id").first()
    return first is not None and first[0] == batch_id


def upserter(
    target: str,
    staging: str,
    keys: Sequence[str] = ("series_id", "date"),
    order_by: Sequence[str] = ("run_timestamp",),
    date: str = "date",
    period: str = "year",
    notes: str | None = None,
    confirmed: str | None = None,
    audit: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: latest run wins, whatever order runs arrive in.

    Only the periods that a batch touches are read and rewritten. The merged rows are first committed to
    ``staging``, then replace those partitions of ``target``. A batch that is replayed after a crash in
    between takes the staged rows again instead of reading a half-replaced target. The merge is idempotent
    and does not depend on order, so any other replay is harmless, too. Two staging folders take turns, so
    nothing piles up. ``notes`` is a folder for the periods of each batch, see :func:`touched_since`.

    ``audit`` names columns that say when a row was delivered and are not part of its content, the run (the first
    of ``order_by``) among them. With it, and a folder ``confirmed``, a period that a batch delivers with the content
    that the target holds is neither read nor rewritten: the digests of the contents are compared, and the run is noted
    as one that confirms the whole period. :func:`read_current` shows rows at the run that last confirmed them.
    """
    part = f"_{period}"
    period_of = F.date_format(F.col(date), _PERIOD_FORMATS[period])
    run = order_by[0]
    by_difference = bool(audit)
    if by_difference and (run not in audit or not notes or not confirmed):
        raise ValueError(f"{run} has to be one of the audit columns, and the folders notes and confirmed are needed")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{staging.rstrip('/')}/{batch_id % 2}"
        if not _staged(spark, staged, batch_id):
            incoming = batch.withColumn(part, period_of)
            if by_difference and path_exists(spark, notes):
                content = [c for c in batch.columns if c not in audit]
                delivered = period_digests(latest_wins(incoming, keys, order_by), part, content, run)
                held = _held(spark, notes, batch_id).drop("last").withColumnRenamed("period", "held_period")
                same = F.col("period").eqNullSafe(F.col("held_period")) & F.col("run").isNotNull()
                again = delivered.join(held, ["rows", "one", "two"]).where(same).select("period", "run")
                note = f"{confirmed}/_batch={batch_id}"
                again.coalesce(1).write.mode("overwrite").parquet(note)
                unchanged = [r[0] for r in spark.read.schema(again.schema).parquet(note).collect()]
                incoming = incoming.filter(~_one_of(part, unchanged))
            merged = incoming
            if path_exists(spark, target):
                # One short text for each calendar period: bounded by the calendar, not by the rows.
                periods = [r[0] for r in incoming.select(part).distinct().collect()]
                present = spark.read.schema(incoming.schema).parquet(target).filter(_one_of(part, periods))
                if by_difference:
                    present = _at_confirmed_run(present, _confirmations(spark, notes, confirmed, batch_id, incoming, run), part, run)
                merged = incoming.unionByName(present)
            merged = latest_wins(merged, keys, order_by).withColumn("_batch_id", F.lit(batch_id))
            if notes and not by_difference:
                # Noted first: a batch that is found staged has been noted.
                note_touched(incoming, notes, part, batch_id)
            merged.write.mode("overwrite").parquet(staged)
        rows = spark.read.parquet(staged).drop("_batch_id")
        if by_difference:
            # Noted from the staged rows, also in a replay, and before the target has them.
            content = [c for c in batch.columns if c not in audit]
            written = period_digests(rows, part, content, run).drop("run")
            written.coalesce(1).write.mode("overwrite").parquet(f"{notes}/_batch={batch_id}")
        with spread_writes(spark, total_bytes(spark, staged)):
            rows.hint("rebalance", part).sortWithinPartitions(part, *keys).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(part).parquet(target)

    return upsert


def _one_of(part: str, periods: Sequence[str | None]) -> Column:
    """Whether a row is of one of the periods, never NULL."""
    known = F.coalesce(F.col(part).isin([p for p in periods if p is not None]), F.lit(False))
    return known | F.col(part).isNull() if None in periods else known


def period_digests(rows: DataFrame, part: str, content: Sequence[str], run: str) -> DataFrame:
    """``(period, rows, one, two, run)``: number and digest of the rows of each period, whatever their order, and their
    run if all have the same one.

    The digest is two sums of 64-bit hashes of each row, in which missing values count as values.
    """
    missing = [F.col(c).isNull() for c in content]

    def digest(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *content, *missing).cast("decimal(20,0)"))

    one_run = (F.count(run) == F.count("*")) & (F.min(run) == F.max(run))
    return rows.groupBy(F.col(part).alias("period")).agg(
        F.count("*").alias("rows"),
        digest(1).alias("one"),
        digest(2).alias("two"),
        F.when(one_run, F.max(run)).alias("run"),
    )


_NOTE = "period string, rows bigint, one decimal(30,0), two decimal(30,0), _batch bigint"


def _held(spark: SparkSession, notes: str, batch_id: int) -> DataFrame:
    """Digests of the periods as the batches before ``batch_id`` left them, and the batch that last wrote each."""
    if not path_exists(spark, notes):
        return spark.createDataFrame([], _NOTE.replace("_batch", "last"))
    noted = spark.read.schema(_NOTE).parquet(notes).where(F.col("_batch") < batch_id)
    last = noted.groupBy("period").agg(F.max(F.struct("_batch", "rows", "one", "two")).alias("n"))
    return last.select("period", "n.rows", "n.one", "n.two", F.col("n._batch").alias("last"))


def _confirmations(
    spark: SparkSession, notes: str, confirmed: str, batch_id: int, rows: DataFrame, run: str
) -> DataFrame:
    """``(period, run)``: the latest run before ``batch_id`` that delivered a period as the target holds it since."""
    schema = f"period string, run {rows.schema[run].dataType.simpleString()}, _batch bigint"
    if not path_exists(spark, confirmed):
        return spark.createDataFrame([], schema).drop("_batch")
    again = spark.read.schema(schema).parquet(confirmed).where(F.col("_batch") < batch_id)
    held = _held(spark, notes, batch_id).select(F.col("period").alias("held_period"), "last")
    since = F.col("period").eqNullSafe(F.col("held_period")) & (F.col("_batch") > F.col("last"))
    return again.join(held, since).groupBy("period").agg(F.max("run").alias("run"))


def _at_confirmed_run(present: DataFrame, confirmations: DataFrame, part: str, run: str) -> DataFrame:
    """``present`` with the run that last delivered each row with the content it has."""
    later = confirmations.select(F.col("period").alias("_again"), F.col("run").alias("_later"))
    joined = present.join(later, F.col(part).eqNullSafe(F.col("_again")), "left")
    return joined.withColumn(run, F.greatest(run, "_later")).select(*present.columns)


def read_current(
    spark: SparkSession, rows: DataFrame, target: str, checkpoint: str, run: str = "run_timestamp", period: str = "year"
) -> DataFrame:
    """What an upsert by difference holds, each row at the run that last delivered it; ``rows`` gives the columns."""
    part, checkpoint = f"_{period}", checkpoint.rstrip("/")
    columns = ", ".join([*(f"`{name}` {kind}" for name, kind in rows.dtypes), f"{part} string"])
    present = spark.read.schema(columns).parquet(target)
    batch_id = (1 << 63) - 1
    found = _confirmations(spark, f"{checkpoint}/{TOUCHED}", f"{checkpoint}/{CONFIRMED}", batch_id, rows, run)
    return _at_confirmed_run(present, found, part, run).drop(part)


def note_touched(incoming: DataFrame, path: str, part: str, batch_id: int) -> None:
    """Keep the periods of a batch as rows; a replayed batch replaces its own."""
    periods = incoming.select(F.col(part).alias("period")).distinct()
    periods.coalesce(1).write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")


def touched_since(spark: SparkSession, checkpoint: str, batch_id: int) -> list[str | None]:
    """Periods that the batches after ``batch_id`` of an upsert flow wrote: bounded by the calendar."""
    path = f"{checkpoint.rstrip('/')}/{TOUCHED}"
    if not path_exists(spark, path):
        return []
    noted = spark.read.schema("period string, _batch bigint").parquet(path)
    return [r[0] for r in noted.where(F.col("_batch") > batch_id).select("period").distinct().orderBy("period").collect()]


def start_upsert(
    df: DataFrame,
    target: str,
    checkpoint: str,
    interval: str | None = None,
    then: Callable[[], object] | None = None,
    **options,
) -> StreamingQuery:
    """Start the upsert flow. Staged rows live with the checkpoint, since both are keyed by batch id.

    ``then`` is called after each merged batch.
    """
    checkpoint = checkpoint.rstrip("/")
    folders = {"notes": f"{checkpoint}/{TOUCHED}", "confirmed": f"{checkpoint}/{CONFIRMED}"}
    upsert = upserter(target, f"{checkpoint}/staged", **folders, **options)

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id)
        if then is not None:
            then()

    writer = df.writeStream.foreachBatch(merge)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
