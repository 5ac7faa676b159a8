"""A series that holds most rows is split over tasks, and results stay whole."""

import re

import pytest
from pyspark.sql import functions as F

from seriesflow.operators import joins, revisions
from seriesflow.plans import layers
from seriesflow.sinks import tables
from seriesflow.streaming.upsert import upserter

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def skewed(spark):
    """50,000 facts, nine in ten of one series, and 200 series."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    series = F.when(F.col("id") % 10 > 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), F.col("id") % 200))
    facts = spark.range(0, 50_000, 1, 8).select(
        series.alias("series_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 2).cast("int")).alias("date"),
        F.col("id").cast("double").alias("value"),
        F.timestamp_seconds("id").alias("run_timestamp"),
    )
    names = spark.range(0, 200, 1, 8).select(F.concat(F.lit("S"), "id").alias("series_id"))
    hot = spark.range(1).select(F.lit("HOT").alias("series_id"))
    dimension = names.union(hot).select(
        "series_id",
        *(F.col("series_id").alias(c) for c in ("title", "friendly_name", "units")),
        F.timestamp_seconds(F.lit(0)).alias("run_timestamp"),
    )
    yield facts, dimension
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_dimension(dimension):
    return dimension.union(dimension).union(dimension)


def test_gold_join_splits_the_hot_series(skewed):
    facts, dimension = skewed
    joined = layers.gold_join(facts, dimension, "SRC")
    assert re.search(r"SortMergeJoin\(skew=true\)", _final_plan(joined))
    assert joined.count() == 50_000


def test_gold_current_splits_the_hot_series(skewed):
    facts, dimension = skewed
    current = layers.gold_current(facts, _hot_dimension(dimension), "SRC")
    assert re.search(r"SortMergeJoin\(skew=true\)", _final_plan(current))
    assert current.count() == facts.select("series_id", "date").distinct().count()


@pytest.mark.parametrize("join, rows", [(joins.keep_referenced, 50_000), (joins.drop_referenced, 0)])
def test_referential_filters_split_the_hot_series(skewed, join, rows):
    facts, dimension = skewed
    kept = join(facts, _hot_dimension(dimension))
    assert re.search(r"SortMergeJoin\(skew=true\)", _final_plan(kept))
    assert kept.count() == rows


def test_revisions_shrink_before_the_shuffle(skewed):
    facts, _ = skewed
    for reduced in (revisions.latest_wins(facts), revisions.latest_only(facts), revisions.latest_wins_ranked(facts)):
        plan = _final_plan(reduced)
        below = plan[plan.index("Exchange") :]
        assert "partial_max" in below or "WindowGroupLimit" in below


def _rows_per_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]


def test_sized_writes_split_the_hot_series(spark, skewed, tmp_path):
    facts, _ = skewed
    tables.sized(facts, "series_id").write.parquet(f"{tmp_path}/t")
    found = _rows_per_file(spark, f"{tmp_path}/t")
    assert sum(found) == 50_000 and max(found) < 15_000


def test_upsert_splits_a_hot_period(spark, skewed, tmp_path):
    facts, _ = skewed
    busy = facts.withColumn("series_id", F.col("value").cast("string")).withColumn("date", F.lit("2024-01-01").cast("date"))
    upserter(f"{tmp_path}/target", f"{tmp_path}/staged")(busy, 0)
    found = _rows_per_file(spark, f"{tmp_path}/target")
    assert sum(found) == 50_000 and max(found) < 15_000
