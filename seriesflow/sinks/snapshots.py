"""Time-stamped landing snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def snapshot_path(directory: str, prefix: str, run: dt.datetime) -> str:
    return f"{directory.rstrip('/')}/{prefix}_{run:%Y%m%d_%H%M%S}"


def save_csv(df: DataFrame, directory: str, prefix: str, run: dt.datetime) -> str:
    """A folder of CSV files with header and empty nulls; an existing snapshot is never overwritten."""
    path = snapshot_path(directory, prefix, run)
    df.write.option("header", True).option("escape", '"').mode("errorifexists").csv(path)
    return path


def save_json_lines(df: DataFrame, directory: str, prefix: str, run: dt.datetime) -> str:
    """A folder of JSON-lines files that keep null fields."""
    path = snapshot_path(directory, prefix, run)
    df.write.option("ignoreNullFields", False).mode("errorifexists").json(path)
    return path
