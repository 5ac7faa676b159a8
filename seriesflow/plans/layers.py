"""The layer transforms: pure, lazy, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesflow.functions.parsing import parse_offset_timestamp, parse_timestamp, project, stamp
from seriesflow.operators.quality import Expectations
from seriesflow.operators.revisions import latest_dimension, latest_wins
from seriesflow.schemas import (
    BRONZE_METADATA,
    BRONZE_OBSERVATIONS,
    SILVER_METADATA,
    SILVER_OBSERVATIONS,
    TABLES,
)


def bronze_observations(landed: DataFrame, as_of: str | None = None) -> DataFrame:
    return project(landed, BRONZE_OBSERVATIONS, ingestion_timestamp=stamp(as_of))


def bronze_metadata(landed: DataFrame) -> DataFrame:
    return project(landed, BRONZE_METADATA)


def expectations(table: str, mode: str = "drop") -> Expectations:
    return Expectations(TABLES[table].rules, mode)


def silver_observations_typed(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    """Typed rows before any rule, so that every failure can be counted."""
    return project(bronze, SILVER_OBSERVATIONS, updated_at=stamp(as_of))


def silver_metadata_typed(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    return project(
        bronze,
        SILVER_METADATA,
        last_updated=parse_offset_timestamp("last_updated"),
        run_timestamp=parse_timestamp("run_timestamp"),
        updated_at=stamp(as_of),
    )


def silver_observations(bronze: DataFrame, as_of: str | None = None, mode: str = "drop") -> DataFrame:
    return expectations("silver_observations", mode).enforce(silver_observations_typed(bronze, as_of))


def silver_metadata(bronze: DataFrame, as_of: str | None = None, mode: str = "drop") -> DataFrame:
    return expectations("silver_metadata", mode).enforce(silver_metadata_typed(bronze, as_of))


def gold_join(observations: DataFrame, metadata: DataFrame, source: str) -> DataFrame:
    """Facts joined to the dimension with all their copies.

    No side is forced to be broadcast: the planner compares its size with the threshold. Beyond it, the
    sort-merge join stays exact and AQE splits the partitions of hot series.
    """
    facts = observations.select("series_id", "date", "value")
    series = metadata.select("series_id", "title", "friendly_name", "units")
    return facts.join(series, "series_id").select(
        "series_id", "date", "value", "title", "friendly_name", "units", F.lit(source).alias("source")
    )


def _latest_series(metadata: DataFrame) -> DataFrame:
    return latest_dimension(metadata.select("series_id", "title", "friendly_name", "units", "run_timestamp"))


def gold_current(observations: DataFrame, metadata: DataFrame, source: str) -> DataFrame:
    """The join over the latest run of each observation and of each series, so every date appears once."""
    facts = latest_wins(observations.select("series_id", "date", "value", "run_timestamp"))
    return gold_join(facts, _latest_series(metadata), source)


def gold_upserted(current: DataFrame, metadata: DataFrame, source: str) -> DataFrame:
    """The same rows from observations that the upsert flow keeps at their latest run."""
    return gold_join(current, _latest_series(metadata), source)


def latest_series(metadata: DataFrame) -> DataFrame:
    """What the gold view takes from the dimension: one row for each series, without its run."""
    return _latest_series(metadata).drop("run_timestamp")


GOLD_VIEWS = {"current": gold_current, "join": gold_join, "upserted": gold_upserted, "incremental": gold_upserted}
