"""The series catalog as data."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The interest-rate series of the daily run and their friendly names.
RATE_SERIES = {
    "DFF": "Federal Funds Effective Rate",
    "DTB3": "3-Month Treasury Bill Rate",
    "DGS1": "1-Year Treasury Rate",
    "DGS2": "2-Year Treasury Rate",
    "DGS5": "5-Year Treasury Rate",
    "DGS10": "10-Year Treasury Rate",
    "DGS30": "30-Year Treasury Rate",
    "SOFR": "Secured Overnight Financing Rate (SOFR)",
    "DPRIME": "Bank Prime Loan Rate",
    "MORTGAGE30US": "30-Year Fixed Rate Mortgage Average",
    "MORTGAGE15US": "15-Year Fixed Rate Mortgage Average",
    "BAMLC0A0CM": "ICE BofA US Corporate Index Effective Yield",
    "BAMLH0A0HYM2": "ICE BofA US High Yield Index Effective Yield",
    "T10YIE": "10-Year Breakeven Inflation Rate",
    "T5YIE": "5-Year Breakeven Inflation Rate",
}

# Series groups.
TREASURY_SERIES = ("DGS1", "DGS2", "DGS5", "DGS10", "DGS30")
MORTGAGE_SERIES = ("MORTGAGE30US", "MORTGAGE15US")
INFLATION_SERIES = ("T10YIE", "T5YIE")


def catalog_map(series: Mapping[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(series.items())))


def catalog(spark: SparkSession, series: Mapping[str, str] = RATE_SERIES) -> DataFrame:
    """(series_id, friendly_name), one row for each entry of the literal."""
    return spark.range(1).select(F.explode(catalog_map(series)).alias("series_id", "friendly_name"))


def friendly_name(series_id: Column | str, series: Mapping[str, str] = RATE_SERIES) -> Column:
    """Look the name up; NULL for a series outside the catalog."""
    key = F.col(series_id) if isinstance(series_id, str) else series_id
    return F.try_element_at(catalog_map(series), key)


def with_friendly_name(df: DataFrame, entries: DataFrame, series_id: str = "series_id", column: str = "friendly_name") -> DataFrame:
    """The same lookup in a catalog that is a table of any size, as :func:`catalog` has it: a join, not a literal.

    Of several entries for a series the first name counts, so that no row is doubled.
    """
    names = entries.groupBy(F.col("series_id").alias("_key"), F.xxhash64("series_id").alias("_digest"))
    names = names.agg(F.min("friendly_name").alias("_name")).drop("_digest")
    kept = [c for c in df.columns if c != column]
    return df.join(names, F.col(series_id) == F.col("_key"), "left").select(*kept, F.col("_name").alias(column))
