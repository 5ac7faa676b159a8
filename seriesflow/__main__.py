"""Jobs for spark-submit: ``land`` a run, ``update`` the tables, ``report`` on them.

    spark-submit --py-files seriesflow.zip seriesflow/__main__.py update --root hdfs:///rates --database rates \\
        --observations hdfs:///landing/observations --metadata hdfs:///landing/metadata --source NAME
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from seriesflow.operators import checks
from seriesflow.plans.landing_run import land
from seriesflow.plans.update import Layout, run_update
from seriesflow.session import configure


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="seriesflow")
    jobs = parser.add_subparsers(dest="job", required=True)
    landing = jobs.add_parser("land")
    for name in ("--observation-payloads", "--series-payloads", "--observations", "--metadata"):
        landing.add_argument(name, required=True)
    landing.add_argument("--observation-start")
    landing.add_argument("--observation-end")
    updating = jobs.add_parser("update")
    for name in ("--root", "--database", "--observations", "--metadata", "--source"):
        updating.add_argument(name, required=True)
    updating.add_argument("--mode", choices=("warn", "drop", "fail"), default="drop")
    updating.add_argument("--gold", choices=("current", "upserted", "join"), default="current")
    reporting = jobs.add_parser("report")
    reporting.add_argument("--database", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    given = _arguments(argv)
    spark = configure(SparkSession.builder.appName(f"seriesflow {given.job}").getOrCreate())
    if given.job == "land":
        landed = land(
            spark,
            given.observation_payloads,
            given.series_payloads,
            given.observations,
            given.metadata,
            dt.datetime.now(dt.UTC),
            observation_start=given.observation_start,
            observation_end=given.observation_end,
        )
        print(landed)
    elif given.job == "update":
        layout = Layout(
            root=given.root,
            database=given.database,
            landing_observations=given.observations,
            landing_metadata=given.metadata,
            source=given.source,
            mode=given.mode,
            gold=given.gold,
        )
        print("gold refreshed" if run_update(spark, layout) else "gold unchanged")
    else:
        tables = [spark.table(f"{given.database}.{n}") for n in ("silver_observations", "silver_metadata")]
        checks.report(*tables).show(truncate=False)


if __name__ == "__main__":
    main()
