"""Validation reports over the layers.

Each is a lazy DataFrame. Facts are aggregated by key before any join, so at most one row for each key and
map task is shuffled, however the rows are spread over the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesflow.functions.parsing import today
from seriesflow.operators.joins import drop_referenced
from seriesflow.operators.quality import any_null, in_range, key_duplicates, not_in_future, valid_id
from seriesflow.operators.revisions import at_latest_date


def _rows() -> Column:
    return F.count(F.lit(1))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(_rows().alias(name))


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(layer_table, rows) of each table."""
    counts = [
        row_count(df).select(F.lit(name).alias("layer_table"), F.col("rows")) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames below each other by column name; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coverage(
    metadata: DataFrame,
    observations: DataFrame,
    attributes: Sequence[str] = ("friendly_name", "frequency"),
    key: str = "series_id",
    date: str = "date",
) -> DataFrame:
    """Observation count, first and last date of every series, 0 for one without data.

    Both sides shrink to one row for each key (and attributes) before the join. A dimension with several
    rows for a key multiplies the count, as the plain outer join would.
    """
    facts = observations.groupBy(key).agg(
        F.count(date).alias("_n"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )
    series = metadata.groupBy(key, *attributes).agg(_rows().alias("_copies"))
    count = F.coalesce(F.col("_n") * F.col("_copies"), F.lit(0).cast("bigint"))
    return series.join(facts, key, "left").select(
        key, *attributes, count.alias("observation_count"), "first_date", "last_date"
    )


def freshness(
    observations: DataFrame, as_of: str | None = None, key: str = "series_id", date: str = "date"
) -> DataFrame:
    """Latest date of each series and days since then."""
    latest = observations.groupBy(key).agg(F.max(date).alias("latest_date"))
    return latest.withColumn("days_since_update", F.datediff(today(as_of), F.col("latest_date")))


def stalest_first(fresh: DataFrame, key: str = "series_id") -> DataFrame:
    """Longest without an update first; the key ends the order, so that equal ages spread over partitions."""
    return fresh.orderBy(F.desc("days_since_update"), key)


def null_counts(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """One column of null counts for each entry (output name -> column), from one pass."""
    return df.agg(
        *(F.count_if((F.col(c) if isinstance(c, str) else c).isNull()).alias(n) for n, c in columns.items())
    )


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns is NULL."""
    return df.filter(any_null(*columns))


def latest_and_count(df: DataFrame, date: str = "date") -> DataFrame:
    return df.agg(F.max(date).alias("latest_date"), _rows().alias("row_count"))


def distinct_series(df: DataFrame, key: str = "series_id", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(key) if approximate else F.count_distinct(F.col(key))
    return df.agg(count.alias("n_series"))


def rows_per_run(df: DataFrame, key: str = "series_id", run: str = "run_timestamp") -> DataFrame:
    return df.groupBy(key, run).agg(_rows().alias("n"))


def orphans_by_series(facts: DataFrame, dimension: DataFrame, on: str = "series_id") -> DataFrame:
    """Number of facts without a dimension row, for each key."""
    per_key = facts.groupBy(on).agg(_rows().alias("orphaned_records"))
    return per_key.join(dimension.select(on).distinct(), on, "left_anti")


def orphans_by_group(facts: DataFrame, dimension: DataFrame, on: str, group_by: str) -> DataFrame:
    """Number of facts without a dimension row, for each value of another column."""
    orphans = drop_referenced(facts.select(on, group_by), dimension, on)
    return orphans.groupBy(group_by).agg(_rows().alias("orphaned_records"))


def orphan_count(
    facts: DataFrame,
    dimension: DataFrame,
    on: str = "series_id",
    check_name: str = "Orphaned observations (no metadata)",
) -> DataFrame:
    """(check_name, count) of facts without a dimension row."""
    total = orphans_by_series(facts, dimension, on).agg(F.sum("orphaned_records").alias("_n"))
    return total.select(
        F.lit(check_name).alias("check_name"), F.coalesce("_n", F.lit(0)).cast("bigint").alias("count")
    )


def without_facts(dimension: DataFrame, facts: DataFrame, on: str = "series_id") -> DataFrame:
    """Dimension rows without a fact; the facts are first reduced to their distinct keys."""
    return dimension.join(facts.select(on).distinct(), on, "left_anti")


def missing_members(facts: DataFrame, expected: DataFrame, on: str = "series_id") -> DataFrame:
    """Expected keys, as of a catalog, that the facts never mention."""
    return without_facts(expected.select(on), facts, on)


def first_rows(df: DataFrame, order_by: Sequence[str | Column], n: int = 10) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def by_date(df: DataFrame, sort_order: str = "asc", date: str = "date") -> DataFrame:
    """Rows in date order. The other columns end the order, so that a busy date spreads over partitions."""
    first = F.desc(date) if sort_order == "desc" else F.asc(date)
    return df.orderBy(first, *(c for c in df.columns if c != date))


def latest_values(gold: DataFrame, key: str = "series_id", date: str = "date") -> DataFrame:
    """Listing of all rows at the latest date of their series, in series order."""
    columns = [key, "friendly_name", date, "value", "units"]
    return at_latest_date(gold.select(*columns), key, date).orderBy(*columns)


def report(
    observations: DataFrame,
    metadata: DataFrame,
    as_of: str | None = None,
    low: float = -5,
    high: float = 25,
) -> DataFrame:
    """All checks as (check_name, count) rows. Row-wise checks share one pass over the facts."""
    row_checks = {
        "Null series_id": F.col("series_id").isNull(),
        "Null date": F.col("date").isNull(),
        "Null value": F.col("value").isNull(),
        "Value out of range": ~in_range("value", low, high),
        "Date in the future": ~not_in_future("date", as_of),
        "Malformed series_id": ~valid_id("series_id"),
    }
    counted = observations.agg(*(F.count_if(c).alias(n) for n, c in row_checks.items()))
    entries = [F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("count")) for n in row_checks]
    duplicates = row_count(key_duplicates(metadata, ["series_id"]), "count")
    return concat(
        [
            counted.select(F.inline(F.array(*entries))),
            orphan_count(observations, metadata),
            duplicates.select(F.lit("Duplicate series_id in metadata").alias("check_name"), "count"),
        ]
    )
