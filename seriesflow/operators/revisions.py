"""Revisions: which of several deliveries of the same observation counts.

All of these reduce before they shuffle: an aggregate sends one row for each key and map task, and Catalyst
puts a group limit under the window. A key that holds a third of the rows is therefore no hot spot. The price is a
sort of each map task's rows by key, since a row of texts can't be updated in place in a hash aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesflow.operators.joins import key_digest


def _ordered_rest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[str]:
    return [*order_by, *(c for c in df.columns if c not in keys and c not in order_by)]


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    # The remaining columns end the ordering, so ties fall the same way in every run.
    row = pick(F.struct(*_ordered_rest(df, keys, order_by))).alias("_row")
    best = df.groupBy(*keys).agg(row)
    return best.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns))


def latest_wins(
    df: DataFrame,
    keys: Sequence[str] = ("series_id", "date"),
    order_by: Sequence[str] = ("run_timestamp",),
) -> DataFrame:
    """The row with the greatest ``order_by`` of each key."""
    return _one_per_key(df, keys, order_by, F.max)


def latest_wins_ranked(
    df: DataFrame,
    keys: Sequence[str] = ("series_id", "date"),
    order_by: Sequence[str] = ("run_timestamp",),
) -> DataFrame:
    """The contract of :func:`latest_wins` as a ranking; also takes columns that have no order (maps)."""
    order = [F.desc(c) for c in order_by]
    order += [
        F.desc(f.name)
        for f in df.schema.fields
        if f.name not in keys and f.name not in order_by and not f.dataType.typeName() in ("map", "variant")
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def keep_first(
    df: DataFrame,
    keys: Sequence[str] = ("series_id", "date"),
    order_by: Sequence[str] = ("run_timestamp",),
) -> DataFrame:
    """Duplicates on ``keys`` dropped, the first row in the stated order kept; a row without a run comes last."""
    unknown = {f"_{c}_unknown": F.col(c).isNull() for c in order_by}
    flagged = [x for c in order_by for x in (f"_{c}_unknown", c)]
    return _one_per_key(df.withColumns(unknown), keys, flagged, F.min).drop(*unknown)


def latest_dimension(
    df: DataFrame, key: str = "series_id", order_by: Sequence[str] = ("run_timestamp",)
) -> DataFrame:
    """The latest row of each series, to be joined to facts on the key."""
    digested = df.withColumn("_digest", key_digest([key]))
    return latest_wins(digested, [key, "_digest"], order_by).drop("_digest")


def latest_only(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    order_by: Sequence[str] = ("date", "run_timestamp"),
) -> DataFrame:
    """The last observation of each series."""
    return latest_wins(df, keys, order_by)


def at_latest_date(df: DataFrame, key: str = "series_id", date: str = "date") -> DataFrame:
    """All rows at the latest date of their series, ties kept."""
    last = df.groupBy(F.col(key).alias("_key"), key_digest([key])).agg(F.max(date).alias("_last")).drop("_digest")
    return df.join(last, (F.col(key) == F.col("_key")) & (F.col(date) == F.col("_last")), "left_semi")
