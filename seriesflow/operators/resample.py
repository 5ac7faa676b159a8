"""Frequency resampling and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Frequency codes.
FREQUENCIES = {"d": "day", "w": "week", "m": "month", "q": "quarter", "a": "year"}

_METHODS = {
    "avg": lambda date, value: F.avg(value),
    "sum": lambda date, value: F.sum(value),
    "min": lambda date, value: F.min(value),
    "max": lambda date, value: F.max(value),
    "count": lambda date, value: F.count(value),
    "last": lambda date, value: F.max(F.when(F.col(value).isNotNull(), F.struct(date, value)))[value],
}


def period_start(date: Column | str, frequency: str) -> Column:
    """First day of the period; weeks start on Monday."""
    unit = FREQUENCIES[frequency]
    column = F.col(date) if isinstance(date, str) else date
    return column.cast("date") if unit == "day" else F.trunc(column, unit)


def resample(
    df: DataFrame,
    frequency: str,
    method: str = "avg",
    key: str = "series_id",
    date: str = "date",
    value: str = "value",
    **methods: str,
) -> DataFrame:
    """One row for each series and period. Further outputs can be asked for as ``name="method"``.

    Partial aggregation leaves one row for each series, period and map task to shuffle.
    """
    wanted = {value: method, **methods}
    aggregates = [_METHODS[m](date, value).alias(name) for name, m in wanted.items()]
    return df.groupBy(key, period_start(date, frequency).alias("period")).agg(*aggregates)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row for each day of the closed interval."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("calendar_date"))


def dates_outside_calendar(df: DataFrame, days: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates of the facts that the calendar lacks; distinct runs first, so few rows are joined."""
    seen = df.select(date).filter(F.col(date).isNotNull()).distinct()
    return seen.join(days.select(F.col("calendar_date").alias(date)), date, "left_anti")
