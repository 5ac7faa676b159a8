"""The landing run: response files to time-stamped snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from seriesflow.schemas import LANDING_METADATA, LANDING_OBSERVATIONS
from seriesflow.sinks.snapshots import save_csv, save_json_lines
from seriesflow.sources.catalog import RATE_SERIES
from seriesflow.sources.payloads import fetch_metadata, fetch_observations, read_payloads

OBSERVATIONS_PREFIX = "observations_historical"
METADATA_PREFIX = "series_metadata"


@dataclass(frozen=True)
class Landed:
    """Where a run landed; None where there was nothing to land."""

    observations: str | None
    metadata: str | None


def land(
    spark: SparkSession,
    observation_payloads: str,
    series_payloads: str,
    observations_dir: str,
    metadata_dir: str,
    run: dt.datetime,
    series: Mapping[str, str] = RATE_SERIES,
    observation_start: str | None = None,
    observation_end: str | None = None,
) -> Landed:
    """Land one run. Nothing is written for a part without rows."""
    run_timestamp = f"{run:%Y-%m-%d %H:%M:%S}"
    metadata = fetch_metadata(read_payloads(spark, series_payloads), run_timestamp, series)
    observations = fetch_observations(
        read_payloads(spark, observation_payloads), run_timestamp, series, observation_start, observation_end
    )
    return Landed(
        None
        if observations.isEmpty()
        else save_csv(observations.select(*LANDING_OBSERVATIONS.names), observations_dir, OBSERVATIONS_PREFIX, run),
        None
        if metadata.isEmpty()
        else save_json_lines(metadata.select(*LANDING_METADATA.names), metadata_dir, METADATA_PREFIX, run),
    )
