"""One update of the five tables: two bronze flows, two silver flows, one gold view."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from seriesflow.operators.joins import keep_referenced
from seriesflow.operators.quality import FAILED_RULES, KEPT, OUTCOME, REJECTED
from seriesflow.plans import layers
from seriesflow.schemas import (
    BRONZE_METADATA,
    BRONZE_OBSERVATIONS,
    LANDING_METADATA,
    LANDING_OBSERVATIONS,
    SILVER_METADATA,
    SILVER_OBSERVATIONS,
    TABLES,
)
from seriesflow.session import path_exists, size_shuffles, spread_writes
from seriesflow.sinks.tables import clustered, create_from_spec, quoted, ranged, refresh, refresh_partitions, table_properties
from seriesflow.sources.landing import RUN_FOLDERS, landed_files, stream_csv, stream_json, stream_table, total_bytes
from seriesflow.streaming.flows import committed, drain, start_append, start_sorted
from seriesflow.streaming.metrics import QualityRecorder, metric_name
from seriesflow.streaming.named_csv import start_named_csv
from seriesflow.streaming.upsert import start_upsert, touched_since

# What the gold view was made of, as table properties: the committed batches of its inputs, and for a view that is
# refreshed by period the last batch of observations and the number of the dimension's snapshot.
_VERSION = "seriesflow.inputs"
_BATCH = "seriesflow.observations"
_DIMENSION = "seriesflow.dimension"
_PERIOD = "period"


@dataclass(frozen=True)
class Layout:
    """Where the tables live and how the flows behave. All paths are on storage every executor reaches.

    ``gold`` picks the view: ``current`` takes the latest run out of all that silver holds; ``upserted`` has the
    same rows, but merges each run into a table of current observations, so that a refresh reads every
    observation once, not once for each run that delivered it; ``incremental`` keeps those rows by year and rewrites
    only the years that new observations or changed series touch; ``join`` keeps all copies.
    ``strict_header`` stops the flow at a file whose header differs; without it columns go by name, whatever their order.
    ``keep_rejected`` (drop mode) keeps the rows that break a rule, with its names, in ``silver_*_rejected``.
    ``range_clustered`` pays one more exchange at each refresh of the gold view for files that each hold a
    narrow range of series and dates. ``ranged_batches`` does so in each micro-batch of the four streamed tables, for one
    more exchange and one more pass over the batch, which samples the ranges.
    """

    root: str
    database: str
    landing_observations: str
    landing_metadata: str
    source: str
    mode: str = "drop"
    gold: str = "current"
    as_of: str | None = None
    limits: dict[str, str] = field(default_factory=dict)
    strict_header: bool = True
    keep_rejected: bool = False
    range_clustered: bool = False
    ranged_batches: bool = False
    gold_versions: int = 2

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"

    @property
    def metrics(self) -> str:
        return f"{self.root.rstrip('/')}/quality_metrics"


def _append(df: DataFrame, layout: Layout, name: str, interval: str | None) -> StreamingQuery:
    return start_append(df, layout.path(name), layout.checkpoint(name), interval=interval)


def _laid_out(df: DataFrame, layout: Layout, name: str) -> DataFrame:
    """The rows of a table as its files are to hold them."""
    if not layout.ranged_batches:
        return df
    by = TABLES[name].cluster_by
    return ranged(df, by) if df.isStreaming else clustered(df, by)


def start_bronze(spark: SparkSession, layout: Layout, interval: str | None = None) -> list[StreamingQuery]:
    metadata = layers.bronze_metadata(stream_json(spark, layout.landing_metadata, LANDING_METADATA, limits=layout.limits))
    described = _append(_laid_out(metadata, layout, "bronze_metadata"), layout, "bronze_metadata", interval)

    def observations_of(landed: DataFrame) -> DataFrame:
        return _laid_out(layers.bronze_observations(landed, layout.as_of), layout, "bronze_observations")

    if not layout.strict_header:
        observed = start_named_csv(
            spark,
            layout.landing_observations,
            layout.path("bronze_observations"),
            layout.checkpoint("bronze_observations"),
            LANDING_OBSERVATIONS,
            observations_of,
            interval,
            limits=layout.limits,
            required=("series_id", "date", "value"),
        )
        return [described, observed]
    observations = stream_csv(spark, layout.landing_observations, LANDING_OBSERVATIONS, limits=layout.limits)
    return [described, _append(observations_of(observations), layout, "bronze_observations", interval)]


def start_silver(spark: SparkSession, layout: Layout, interval: str | None = None) -> list[StreamingQuery]:
    def flow(name: str, typed: DataFrame) -> StreamingQuery:
        rules = layers.expectations(name, layout.mode)
        # Before the rows are counted: the pass that samples the ranges would count them once more.
        typed = _laid_out(typed, layout, name)
        if layout.keep_rejected:
            observed = rules.observe(typed, metric_name(name))
            return start_sorted(observed, rules, layout.path(name), layout.checkpoint(name), interval)
        return _append(rules.enforce(rules.observe(typed, metric_name(name))), layout, name, interval)

    metadata = stream_table(spark, layout.path("bronze_metadata"), BRONZE_METADATA, layout.limits)
    observations = stream_table(
        spark, layout.path("bronze_observations"), BRONZE_OBSERVATIONS, layout.limits, nested=not layout.strict_header
    )
    return [
        flow("silver_metadata", layers.silver_metadata_typed(metadata, layout.as_of)),
        flow("silver_observations", layers.silver_observations_typed(observations, layout.as_of)),
    ]


def _stream_silver(spark: SparkSession, layout: Layout, name: str, schema: StructType, limits: dict[str, str] | None = None) -> DataFrame:
    """The rows that a silver flow keeps."""
    if not layout.keep_rejected:
        return stream_table(spark, layout.path(name), schema, limits)
    stored = StructType([*schema.fields, StructField(OUTCOME, StringType())])
    return stream_table(spark, layout.path(name), stored, limits).where(F.col(OUTCOME) == KEPT).drop(OUTCOME)


def start_current(
    spark: SparkSession,
    layout: Layout,
    interval: str | None = None,
    then: Callable[[], object] | None = None,
) -> StreamingQuery:
    """Merge new silver observations into the table of current ones."""
    silver = _stream_silver(spark, layout, "silver_observations", SILVER_OBSERVATIONS, layout.limits)
    return start_upsert(
        silver,
        layout.path("current_observations"),
        layout.checkpoint("current_observations"),
        interval,
        then,
        order_by=("run_timestamp", "value"),
        audit=("run_timestamp", "updated_at"),
    )


def _observations(spark: SparkSession, layout: Layout) -> DataFrame:
    if not _merging(layout):
        return spark.table(layout.table("silver_observations"))
    current = layout.path("current_observations")
    if not path_exists(spark, current):
        return spark.createDataFrame([], SILVER_OBSERVATIONS)
    return spark.read.schema(SILVER_OBSERVATIONS).parquet(current)


def register(spark: SparkSession, layout: Layout) -> None:
    """Describe the four streamed tables in the catalog, with comments and properties."""
    home = quoted(f"{layout.root.rstrip('/')}/database")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.database} LOCATION {home}")
    for name in ("bronze_metadata", "bronze_observations", "silver_metadata", "silver_observations"):
        sorted_out = (path_exists(spark, f"{layout.path(name)}/{OUTCOME}={outcome}") for outcome in (KEPT, REJECTED))
        if layout.keep_rejected and name.startswith("silver") and any(sorted_out):
            _register_sorted(spark, layout, name)
            continue
        nested = name == "bronze_observations" and not layout.strict_header
        create_from_spec(spark, layout.table(name), TABLES[name], layout.path(name), RUN_FOLDERS if nested else None)
        spark.catalog.refreshTable(layout.table(name))


def _register_sorted(spark: SparkSession, layout: Layout, name: str) -> None:
    """Two views over one sink: the rows that were kept, and those that were not with the rules they break."""
    table, spec = layout.table(name), TABLES[name]
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        # Registered before the first batch.
        spark.sql(f"DROP TABLE {table}")
    columns = [f.name for f in spec.schema.fields]
    views = ((table, KEPT, columns), (f"{table}_{REJECTED}", REJECTED, [*columns, FAILED_RULES]))
    for view, outcome, shown in views:
        listed = ", ".join(f"`{c}`" for c in shown)
        spark.sql(
            f"CREATE OR REPLACE VIEW {view} COMMENT {quoted(spec.comment + ', ' + outcome)} AS "
            f"SELECT {listed} FROM parquet.`{layout.path(name)}` WHERE `{OUTCOME}` = {quoted(outcome)}"
        )


def _merging(layout: Layout) -> bool:
    return layout.gold in ("upserted", "incremental")


def _input_flows(layout: Layout) -> tuple[str, str]:
    return ("current_observations" if _merging(layout) else "silver_observations", "silver_metadata")


def input_version(spark: SparkSession, layout: Layout) -> str:
    """Which batches of its inputs the gold view would be made of now: their flows and last committed batches.

    Rows that change without changing any count or maximum make a new version, too, as they come with a batch.
    """
    states = [committed(spark, layout.checkpoint(name)) for name in _input_flows(layout)]
    return ";".join([layout.gold, layout.source, *(f"{identity}@{batch}" for identity, batch in states)])


# Two flows may ask for a refresh at the same time.
_REFRESHING = threading.Lock()


def refresh_gold(spark: SparkSession, layout: Layout, force: bool = False, arrived: bool = False) -> bool:
    """Bring the gold view up to date unless its inputs are unchanged; says whether it was.

    ``force`` recomputes all of it. ``arrived`` says that there is something new, whose batch need not be committed yet.
    """
    with _REFRESHING:
        for name in ("silver_observations", "silver_metadata"):
            spark.catalog.refreshTable(layout.table(name))
        return _refresh_gold(spark, layout, force, arrived)


def _refresh_gold(spark: SparkSession, layout: Layout, force: bool, arrived: bool) -> bool:
    # The version is taken before the rows, so the view is never older than it says.
    version = input_version(spark, layout)
    observations, metadata = _observations(spark, layout), spark.table(layout.table("silver_metadata"))
    table = layout.table("gold_observations")
    exists = spark.catalog.tableExists(table)
    if exists and (_PERIOD in spark.table(table).columns) != (layout.gold == "incremental"):
        # Another kind of table: it is described anew, its files stay.
        spark.sql(f"DROP TABLE {table}")
        exists = False
    found = table_properties(spark, table) if exists else {}
    if not (force or arrived) and found.get(_VERSION) == version:
        return False
    size_shuffles(spark, total_bytes(spark, layout.path("silver_observations"), layout.path("silver_metadata")))
    if layout.gold == "incremental":
        _refresh_periods(spark, layout, metadata, version, {} if force else found, arrived)
        return True
    spec = TABLES["gold_observations"]
    view = layers.GOLD_VIEWS[layout.gold](observations, metadata, layout.source)
    # The sort needs no exchange, and none at all where the join left the rows in that order.
    ordered = clustered(view, spec.cluster_by) if layout.range_clustered else view.sortWithinPartitions(*spec.cluster_by)
    refresh(
        ordered,
        table,
        layout.path("gold_observations"),
        spec.comment,
        {**spec.properties, _VERSION: version},
        spec.schema,
        layout.gold_versions,
    )
    return True


def _same_descriptions(version: str, found: dict[str, str]) -> bool:
    """Whether the view was made of the committed batch of the dimension that ``version`` names."""
    _, _, described = version.rpartition(";")
    return not described.startswith("@") and found.get(_VERSION, "").rpartition(";")[2] == described


def _changed_series(series: DataFrame, known: DataFrame) -> DataFrame:
    """Series that one of two snapshots of the dimension holds and the other does not, or not as often: in one pass."""
    counted = series.withColumn("_n", F.lit(1)).unionByName(known.withColumn("_n", F.lit(-1)))
    return counted.groupBy(*series.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").select("series_id")


def _refresh_periods(
    spark: SparkSession, layout: Layout, metadata: DataFrame, version: str, found: dict[str, str], arrived: bool
) -> None:
    """Rewrite the years that changed: those that batches since the last refresh brought rows for, and those that
    hold a series whose description changed. The dimension of each refresh is kept for that comparison; without a new
    batch of it the one that is there stays."""
    spec, table = TABLES["gold_observations"], layout.table("gold_observations")
    identity, batch = committed(spark, layout.checkpoint("current_observations"))
    current = layout.path("current_observations")
    facts = spark.createDataFrame([], SILVER_OBSERVATIONS).withColumn(_PERIOD, F.lit(None).cast("string"))
    if path_exists(spark, current):
        stored = StructType([*SILVER_OBSERVATIONS.fields, StructField("_year", StringType())])
        facts = spark.read.schema(stored).parquet(current)
        facts = facts.withColumnRenamed("_year", _PERIOD)
    # The snapshots take turns; the one that the table names stays until the refresh is complete.
    turn = int(found.get(_DIMENSION, "1"))
    snapshots = f"{layout.path('gold_observations')}/dimension"
    # A batch that arrived need not be committed, so the version does not tell it.
    same = _DIMENSION in found and not arrived and _same_descriptions(version, found)
    if not same:
        turn = 1 - turn
        layers.latest_series(metadata).write.mode("overwrite").parquet(f"{snapshots}/{turn}")
    series = spark.read.parquet(f"{snapshots}/{turn}")
    known_identity, _, known_batch = found.get(_BATCH, "").partition("@")
    if _DIMENSION in found and known_identity == identity:
        touched = touched_since(spark, layout.checkpoint("current_observations"), int(known_batch))
        periods = set(touched)
        if not same:
            known = spark.read.schema(series.schema).parquet(f"{snapshots}/{1 - turn}")
            # A year that is rewritten anyway need not be searched.
            others = facts.where(~F.col(_PERIOD).isin([p for p in touched if p]))
            described = keep_referenced(others, _changed_series(series, known)).select(_PERIOD).distinct()
            periods |= {r[0] for r in described.collect()}
    else:
        periods = {r[0] for r in facts.select(_PERIOD).distinct().collect()}
        if spark.catalog.tableExists(table):
            periods |= {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    # Observations without a date never reach silver, so no period is NULL.
    periods = sorted(p for p in periods if p)
    view = layers.gold_join(facts.where(F.col(_PERIOD).isin(periods)), series, layout.source)
    view = view.withColumn(_PERIOD, F.date_format("date", "yyyy"))
    properties = {**spec.properties, _VERSION: version, _BATCH: f"{identity}@{batch}", _DIMENSION: str(turn)}
    with spread_writes(spark, _period_bytes(spark, current, periods)):
        refresh_partitions(
            view.hint("rebalance", _PERIOD).sortWithinPartitions(_PERIOD, *spec.cluster_by),
            table,
            layout.path("gold_observations"),
            _PERIOD,
            periods,
            spec.comment,
            properties,
            spec.schema,
        )


def _period_bytes(spark: SparkSession, current: str, periods: list[str]) -> int:
    """Size of the files that hold these years of the current observations."""
    if not path_exists(spark, current):
        return 0
    held = F.element_at(F.split("file_path", "/"), -2).isin([f"_year={p}" for p in periods])
    return landed_files(spark, current).where(held).agg(F.sum("file_size")).first()[0] or 0


def run_update(spark: SparkSession, layout: Layout) -> bool:
    """Drain everything that has landed through all layers; says whether the gold view was refreshed."""
    recorder = QualityRecorder()
    spark.streams.addListener(recorder)
    try:
        drain(*start_bronze(spark, layout))
        silver = start_silver(spark, layout)
        try:
            drain(*silver)
        finally:
            recorder.wait(*silver)
            recorder.flush(spark, layout.metrics)
    finally:
        spark.streams.removeListener(recorder)
    register(spark, layout)
    if _merging(layout):
        drain(start_current(spark, layout))
    return refresh_gold(spark, layout)


def start_gold(spark: SparkSession, layout: Layout, interval: str) -> list[StreamingQuery]:
    """Refresh the gold view after each micro-batch that brings its inputs something new."""

    def refreshed(*_) -> None:
        if layout.keep_rejected:
            register(spark, layout)
        refresh_gold(spark, layout, arrived=True)

    changes = _stream_silver(spark, layout, "silver_metadata", SILVER_METADATA).select("series_id")
    queries = []
    if _merging(layout):
        queries.append(start_current(spark, layout, interval, refreshed))
    else:
        facts = _stream_silver(spark, layout, "silver_observations", SILVER_OBSERVATIONS).select("series_id")
        changes = changes.unionByName(facts)
    writer = changes.writeStream.foreachBatch(refreshed).trigger(processingTime=interval)
    return [*queries, writer.option("checkpointLocation", layout.checkpoint("gold_observations")).start()]


def start_continuous(spark: SparkSession, layout: Layout, interval: str = "1 minute") -> list[StreamingQuery]:
    """Keep all flows running in micro-batches, with the gold view behind them."""
    queries = [*start_bronze(spark, layout, interval), *start_silver(spark, layout, interval)]
    register(spark, layout)
    return [*queries, *start_gold(spark, layout, interval)]
