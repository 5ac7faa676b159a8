"""The operators over the driver's tables, one function for each registered query.

Stand-ins: ``events`` are observations with revisions, ``customer`` their series; ``lineitem`` are the large
observations, ``part`` their series; ``documents`` and ``labels`` have orphans and free text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesflow.functions import parsing as P
from seriesflow.operators import checks, joins, quality, resample, revisions
from seriesflow.operators.quality import Expectations
from seriesflow.plans import layers, update
from seriesflow.schemas import LANDING_METADATA, LANDING_OBSERVATIONS, TABLES
from seriesflow.session import configure, scratch_path, size_shuffles
from seriesflow.sinks import snapshots, tables
from seriesflow.sources import catalog, landing, payloads
from seriesflow.streaming import flows, metrics, upsert

SOURCE = "SRC"
AS_OF = "2024-02-15"

# Event types with a friendly name; "refund" has no rows.
EVENT_CATALOG = {
    "click": "Clicks",
    "view": "Views",
    "purchase": "Purchases",
    "signup": "Sign-ups",
    "refund": "Refunds",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("string")
    return _read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("series_id"),
        F.col("event_type").alias("series_name"),
        F.col("ts").cast("date").alias("date"),
        F.when(F.col("event_type") == "error", P.MISSING_MARKER).otherwise(value).alias("raw_value"),
        "value",
        F.col("ts").alias("run_timestamp"),
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("series_id"),
        F.col("c_name").alias("friendly_name"),
        F.col("c_mktsegment").alias("units"),
    )


def big(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("series_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("value"),
    )


def bmeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("series_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("friendly_name"),
        F.col("p_type").alias("units"),
    )


def typed_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with their value parsed from text, so that missing ones are NULL."""
    return obs(spark, sf_dir).withColumn("value", P.parse_double("raw_value"))


# --- joins -----------------------------------------------------------------------------------------------


def d1_gold_join(spark, d):
    return layers.gold_join(big(spark, d), bmeta(spark, d), SOURCE)


def d2_gold_current(spark, d):
    series = meta(spark, d).withColumns({"title": F.col("friendly_name"), "run_timestamp": F.lit(AS_OF).cast("timestamp")})
    return layers.gold_current(obs(spark, d), series, SOURCE).drop("title")


def d4_orphan_count(spark, d):
    return checks.orphan_count(
        _read(spark, d, "documents"), _read(spark, d, "labels"), "doc_id", "Orphaned documents (no label)"
    )


def d5_orphans_by_key(spark, d):
    documents = _read(spark, d, "documents").withColumnRenamed("source", "series_id")
    return checks.orphans_by_group(documents, _read(spark, d, "labels"), "doc_id", "series_id")


def d5_orphans_by_series(spark, d):
    """Series without facts in the other table: every lineitem part against the events' users."""
    return checks.orphans_by_series(big(spark, d), obs(spark, d))


def d6_dimension_without_facts(spark, d):
    return checks.without_facts(meta(spark, d), obs(spark, d)).select("series_id", "friendly_name")


def d7_latest_values(spark, d):
    latest = revisions.at_latest_date(obs(spark, d).select("series_id", "date", "value"))
    named = latest.join(meta(spark, d), "series_id")
    return named.select("series_id", "friendly_name", "date", "value", "units").orderBy("series_id", "date", "value")


def d7_latest_listing(spark, d):
    """The same listing taken from the joined rows."""
    gold = layers.gold_join(big(spark, d), bmeta(spark, d), SOURCE)
    return checks.latest_values(gold)


def d8_referential_filter(spark, d):
    documents = _read(spark, d, "documents").select("doc_id", "lang")
    return joins.keep_referenced(documents, _read(spark, d, "labels"), "doc_id")


def d9_calendar_gaps(spark, d):
    days = resample.calendar(spark, "1995-06-01", "2001-06-30")
    return resample.dates_outside_calendar(big(spark, d), days)


# --- revisions -------------------------------------------------------------------------------------------


def e6_latest_wins(spark, d):
    return revisions.latest_wins(obs(spark, d)).select("series_id", "date", "value", "series_name")


def f1_latest_wins_ranked(spark, d):
    return revisions.latest_wins_ranked(obs(spark, d)).select("series_id", "date", "value", "series_name")


def e6_latest_wins_large(spark, d):
    """Large observations: the greatest order key and line of each part and day is its latest run."""
    lines = _read(spark, d, "lineitem").select(
        F.col("l_partkey").alias("series_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_orderkey").alias("run"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("value"),
    )
    return revisions.latest_wins(lines, order_by=("run", "line"))


def e7_drop_duplicates(spark, d):
    return revisions.keep_first(obs(spark, d)).select("series_id", "date", "value")


def f2_latest_only(spark, d):
    return revisions.latest_only(obs(spark, d)).select("series_id", "date", "value")


# --- projections, filters, functions ----------------------------------------------------------------------


def c1_typed_projection(spark, d):
    text = obs(spark, d).select(
        P.parse_int("series_id").alias("series_no"),
        P.parse_date(P.format_timestamp("run_timestamp", "yyyy-MM-dd")).alias("date"),
        P.format_timestamp("run_timestamp").alias("run_ts_text"),
    )
    # The text is read back and written again in the form file names carry.
    return text.withColumn("file_stamp", P.format_timestamp(P.parse_timestamp("run_ts_text"), P.FILE_STAMP_FORMAT))


def c8_missing_marker(spark, d):
    return typed_obs(spark, d).filter(F.col("value").isNotNull()).select("series_id", "date", "value")


def c7_null_violations(spark, d):
    violations = checks.null_violations(typed_obs(spark, d), ["series_id", "date", "value"])
    return violations.select("series_id", "date", "series_name")


def c9_out_of_range(spark, d):
    return obs(spark, d).filter(~quality.in_range()).select("series_id", "date", "value")


def c10_future_dates(spark, d):
    return obs(spark, d).filter(~quality.not_in_future(as_of="2024-01-20")).select("series_id", "date")


def c11_id_format(spark, d):
    return _read(spark, d, "nation").select(
        "n_name", quality.valid_id("n_name").alias("ok"), quality.is_upper("n_name").alias("is_upper")
    )


def c11_id_format_large(spark, d):
    checked = bmeta(spark, d).select(
        "friendly_name",
        quality.valid_id("friendly_name").alias("ok"),
        quality.is_upper("friendly_name").alias("is_upper"),
    )
    return checked.groupBy("friendly_name", "ok", "is_upper").agg(F.count(F.lit(1)).alias("n"))


def c12_membership(spark, d):
    kept = obs(spark, d).filter(F.col("series_name").isin("click", "view"))
    return kept.select("series_id", "date", "series_name")


def c12_missing_members(spark, d):
    expected = catalog.catalog(spark, EVENT_CATALOG)
    facts = obs(spark, d).select(F.col("series_name").alias("series_id"))
    return checks.missing_members(facts, expected)


def i6_clean_text(spark, d):
    return _read(spark, d, "documents").select("doc_id", P.clean_text(P.or_empty("text")).alias("notes"))


def i12_catalog_lookup(spark, d):
    return obs(spark, d).select(
        "series_id", "date", "value", catalog.friendly_name("series_name", EVENT_CATALOG).alias("friendly_name")
    )


# --- sources ---------------------------------------------------------------------------------------------


def a7_batch_read(spark, d):
    return landing.read_table(spark, f"{d}/events.parquet").select("event_id", "event_type", "value")


def a8_payload_explode(spark, d):
    """Each event becomes a response with two observations, without gathering any rows."""
    observations = F.array(
        F.struct(F.col("date").cast("string").alias("date"), F.col("raw_value").alias("value")),
        F.struct(F.date_add("date", 1).cast("string").alias("date"), F.col("value").cast("string").alias("value")),
    )
    responses = obs(spark, d).select("series_id", F.to_json(F.struct(observations.alias("observations"))).alias("payload"))
    return payloads.observations_of(responses)


def a9_payload_first(spark, d):
    first = F.struct(
        F.col("series_id").alias("id"), F.col("friendly_name").alias("title"), F.col("units").alias("units")
    )
    second = F.struct(F.lit("other").alias("id"), F.lit("other").alias("title"), F.lit("other").alias("units"))
    responses = meta(spark, d).select(
        "series_id", F.to_json(F.struct(F.array(first, second).alias("seriess"))).alias("payload")
    )
    return payloads.series_of(responses).select(
        F.col("id").alias("series_id"), F.col("title").alias("friendly_name"), "units"
    )


def a10_catalog(spark, d):
    """Rows of each catalog entry, 0 where the facts lack it."""
    counts = obs(spark, d).groupBy(F.col("series_name").alias("series_id")).agg(F.count(F.lit(1)).alias("_n"))
    entries = catalog.catalog(spark, EVENT_CATALOG)
    return entries.join(counts, "series_id", "left").select(
        "series_id", "friendly_name", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n")
    )


def a12_date_range(spark, d):
    events = landing.between_dates(_read(spark, d, "events"), "2024-01-10", "2024-01-20", "ts")
    found = events.select(
        F.col("user_id").cast("string").alias("series_id"), F.col("ts").cast("date").alias("date"), "value"
    )
    return checks.by_date(found, "desc")


# --- aggregations, reports --------------------------------------------------------------------------------


def e1_layer_counts(spark, d):
    typed = typed_obs(spark, d)
    return checks.layer_counts(
        {
            "bronze_observations": typed,
            "silver_observations": typed.filter(F.col("value").isNotNull()),
            "silver_metadata": meta(spark, d),
        }
    )


def h2_concat(spark, d):
    columns = ["series_id", "date", "value"]
    return checks.concat([obs(spark, d).select(*columns), big(spark, d).select(*columns)])


def h2_concat_missing_columns(spark, d):
    return checks.concat([obs(spark, d).select("series_id", "date", "series_name"), big(spark, d)])


def e2_coverage(spark, d):
    return checks.coverage(meta(spark, d), obs(spark, d), ("friendly_name", "units")).orderBy("series_id")


def e2_coverage_copies(spark, d):
    """A dimension with two rows for a series counts its facts twice, as the plain outer join does."""
    twice = meta(spark, d).unionByName(meta(spark, d))
    return checks.coverage(twice, obs(spark, d), ("friendly_name", "units"))


def e3_freshness(spark, d):
    return checks.stalest_first(checks.freshness(obs(spark, d), AS_OF))


def e4_null_counts(spark, d):
    columns = {"null_series_id": "series_id", "null_dates": "date", "null_values": "value"}
    return checks.null_counts(typed_obs(spark, d), columns)


def e5_max_count(spark, d):
    return checks.latest_and_count(big(spark, d))


def e8_resample_month(spark, d):
    found = resample.resample(big(spark, d), "m")
    return found.withColumn("value", F.round("value", 6))


def e8_resample_week(spark, d):
    return resample.resample(obs(spark, d), "w", "max", n="count")


def e8_resample_quarter(spark, d):
    return resample.resample(obs(spark, d).select("series_id", "date", "value"), "q", "min", n="count")


def e8_resample_year_last(spark, d):
    return resample.resample(big(spark, d), "a", "last")


def e8_resample_day_sum(spark, d):
    found = resample.resample(obs(spark, d), "d", "sum")
    return found.withColumn("value", F.round("value", 4))


def e9_pk_duplicates(spark, d):
    return quality.key_duplicates(_read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def e10_distinct_series(spark, d):
    return checks.distinct_series(big(spark, d))


def e11_rows_per_series_run(spark, d):
    runs = obs(spark, d).select("series_id", F.col("date").alias("run_date"))
    return checks.rows_per_run(runs, run="run_date")


def g3_first_n(spark, d):
    return checks.first_rows(obs(spark, d), ["date", "run_timestamp"]).select("series_id", "date", "value")


# --- quality ---------------------------------------------------------------------------------------------

_RULES = {"value_not_null": "value IS NOT NULL", "in_range": "value BETWEEN 0 AND 100"}


def k1_expect_or_drop(spark, d):
    return Expectations(_RULES).enforce(typed_obs(spark, d)).select("series_id", "date", "value")


def k2_fail_mode(spark, d):
    rules = Expectations.not_null("series_id", "date", "value", mode="fail")
    return rules.enforce(obs(spark, d).select("series_id", "date", "value"))


def k2_refused(spark, d):
    """Rows that break a rule and rows that are published: a good batch, a bad one, and a bad one with a later filter."""
    rules = Expectations.not_null("series_id", "date", "value", mode="fail")
    good, bad = (f(spark, d).select("series_id", "date", "value") for f in (obs, typed_obs))

    def filtered() -> DataFrame:
        return rules.enforce(bad).where("value < 10")

    found = []
    for case, rows in (("good", lambda: rules.gate(good)), ("bad", lambda: rules.gate(bad)), ("filtered", filtered)):
        path = scratch_path(spark, f"k2_{case}")
        try:
            rows().write.parquet(path)
            published = spark.read.parquet(path).count()
        except quality.ExpectationError as error:
            found.append((case, sum(error.broken.values()), 0))
        except PySparkException as error:
            if "expectation failed" not in str(error):
                raise
            found.append((case, -1, 0))
        else:
            found.append((case, 0, published))
    return spark.createDataFrame(found, "batch string, broken bigint, published bigint")


def k3_warn_mode(spark, d):
    return Expectations(_RULES, "warn").enforce(typed_obs(spark, d)).select("series_id", "date", "value")


def k4_rule_metrics(spark, d):
    return Expectations(_RULES).metrics(typed_obs(spark, d))


def k5_primary_key(spark, d):
    return quality.primary_key_violations(_read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def k8_quarantine(spark, d):
    held = Expectations(_RULES).quarantine(typed_obs(spark, d))
    return held.select("series_id", "date", F.array_join("failed_rules", ",").alias("failed_rules"))


def k9_report(spark, d):
    return checks.report(typed_obs(spark, d), meta(spark, d), as_of="2024-01-20", low=0, high=100)


# --- files, tables and streams: each query lands the driver's rows in the shared scratch folder first --------

_RUN = dt.datetime(2024, 2, 1, 8, 0, 0)


def _landing_rows(spark, d) -> DataFrame:
    run = P.format_timestamp("run_timestamp")
    return typed_obs(spark, d).withColumn("run_timestamp", run).select(*LANDING_OBSERVATIONS.names)


def _land_metadata(spark, d, directory: str) -> str:
    rows = meta(spark, d).withColumns(
        {
            "run_timestamp": F.lit("2024-02-01 08:00:00"),
            "title": F.col("friendly_name"),
            "popularity": F.col("series_id"),
        }
    )
    text = [(F.col(n) if n in rows.columns else F.lit("")).alias(n) for n in LANDING_METADATA.names]
    return snapshots.save_json_lines(rows.select(*text), directory, "series_metadata", _RUN)


def _updated(spark, d, purpose: str, **options) -> update.Layout:
    """Land one run and drain it through all layers."""
    root = scratch_path(spark, purpose)
    snapshots.save_csv(_landing_rows(spark, d), f"{root}/landing/observations", "observations", _RUN)
    _land_metadata(spark, d, f"{root}/landing/metadata")
    layout = update.Layout(
        root=root,
        database="db_" + root.rsplit("-", 1)[-1],
        landing_observations=f"{root}/landing/observations",
        landing_metadata=f"{root}/landing/metadata",
        source=SOURCE,
        **options,
    )
    update.run_update(spark, layout)
    return layout


def _taken(spark, layout: update.Layout, name: str) -> DataFrame:
    """The rows of a table, read from its files; the catalog entries of this run go."""
    rows = landing.read_table(spark, tables.table_location(spark, layout.table(name)))
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")
    return rows


def a3_inferred_schema(spark, d):
    """Landed text read back with the types found in it, after they were frozen as JSON."""
    root = scratch_path(spark, "a3")
    path = snapshots.save_csv(_landing_rows(spark, d), root, "observations", _RUN)
    landing.save_schema(spark, landing.infer_csv_schema(spark, path), f"{root}/schema")
    frozen = landing.load_schema(spark, f"{root}/schema")
    return spark.read.schema(frozen).option("header", True).csv(path).select("series_id", "series_name", "date", "value")


_HALF = "2024-01-15"


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    newer = F.col("run_timestamp") >= F.lit(_HALF)
    return rows.filter(~newer), rows.filter(newer)


def a4_schema_evolution(spark, d):
    """An early run without names, a later one with one column more, in another order."""
    root = scratch_path(spark, "a4")
    early, late = _halves(_landing_rows(spark, d))
    reordered = late.select("value", F.lit("x").alias("extra"), "date", "series_name", "series_id", "run_timestamp")
    paths = [
        snapshots.save_csv(early.drop("series_name"), root, "early", _RUN),
        snapshots.save_csv(reordered, root, "late", _RUN),
    ]
    bronze = layers.bronze_observations(landing.read_csv_runs(spark, paths, LANDING_OBSERVATIONS))
    return bronze.select("series_id", "series_name", "date", "value")


def a4_stream_evolution(spark, d):
    """Runs of three headers through all layers: full, reordered with one column more, and without names."""
    root = scratch_path(spark, "a4stream")
    layout = update.Layout(
        root=root,
        database="db_" + root.rsplit("-", 1)[-1],
        landing_observations=f"{root}/landing/observations",
        landing_metadata=f"{root}/landing/metadata",
        source=SOURCE,
        strict_header=False,
    )
    _land_metadata(spark, d, layout.landing_metadata)
    early, late = _halves(_landing_rows(spark, d))
    latest = F.col("run_timestamp") >= F.lit("2024-01-25")
    reordered = late.filter(~latest).select("value", F.lit("x").alias("extra"), "date", "series_name", "series_id", "run_timestamp")
    for number, part in enumerate((early, reordered)):
        snapshots.save_csv(part, layout.landing_observations, "observations", _RUN + dt.timedelta(days=number))
    update.run_update(spark, layout)
    snapshots.save_csv(late.filter(latest).drop("series_name"), layout.landing_observations, "observations", _RUN + dt.timedelta(days=2))
    update.run_update(spark, layout)
    return _taken(spark, layout, "silver_observations").select("series_id", "series_name", "date", "value")


def a5_load_by_pattern(spark, d):
    """Only the runs that fit the pattern are loaded, and a second load adds nothing."""
    root = scratch_path(spark, "a5")
    early, late = _halves(_landing_rows(spark, d))
    snapshots.save_csv(early, f"{root}/landing", "observations_historical", _RUN)
    snapshots.save_csv(late, f"{root}/landing", "observations_other", _RUN)
    for _ in range(2):
        stream = landing.stream_csv(spark, f"{root}/landing/observations_historical_*", LANDING_OBSERVATIONS)
        flows.drain(flows.start_append(layers.bronze_observations(stream), f"{root}/bronze", f"{root}/checkpoint"))
    return landing.read_table(spark, f"{root}/bronze").select("series_id", "series_name", "date", "value")


def a11_landed_files(spark, d):
    return landing.landed_files(spark, d)


def a11_landed_rows(spark, d):
    """Rows of each landed run, by the file that each row came from."""
    root = scratch_path(spark, "a11")
    for name, part in zip(("early", "late"), _halves(_landing_rows(spark, d)), strict=True):
        snapshots.save_csv(part, root, name, _RUN)
    rows = spark.read.schema(LANDING_OBSERVATIONS).option("header", True).option("recursiveFileLookup", True).csv(root)
    files = landing.landed_rows(rows, root)
    run = F.regexp_extract("file_path", "/(early|late)_[0-9_]+/", 1).alias("run")
    return files.where(F.col("file_path").endswith(".csv")).groupBy(run).agg(
        F.sum("rows").alias("rows"), (F.min("file_size") > 0).alias("has_bytes")
    )


def a8_large_response(spark, d):
    """One response file for each event type, read in as many tasks as its size asks for."""
    root = scratch_path(spark, "a8")
    one = F.to_json(F.struct(F.col("date").cast("string").alias("date"), F.col("raw_value").alias("value")))
    inner = F.expr("substring(record, 2, length(record) - 2)")
    for name in (*EVENT_CATALOG, "error"):
        rows = obs(spark, d).where(F.col("series_name") == name).select(one.alias("record")).coalesce(1)
        head = F.when(F.monotonically_increasing_id() == 0, '{"observations":[{').otherwise("")
        rows.select(F.concat(head, inner)).write.option("lineSep", payloads.RECORD_BORDER).text(f"{root}/{name}")
    found = [
        payloads.read_records(spark, f"{root}/{name}").withColumn("series_id", F.lit(name)) for name in (*EVENT_CATALOG, "error")
    ]
    fetched = payloads.fetch_records(checks.concat(found), "2024-02-01 08:00:00", _RESPONSE_CATALOG, "2024-01-05", "2024-01-25")
    return fetched.select(*LANDING_OBSERVATIONS.names)


def a13_fetch_metadata(spark, d):
    """One response for each part, named by a catalog that is a table; absent attributes empty, notes cleaned."""
    series = F.struct(
        F.col("series_id").alias("id"), F.col("title"), F.col("units"), F.concat(F.lit(" a\n  b "), F.col("friendly_name")).alias("notes")
    )
    responses = bmeta(spark, d).select("series_id", F.to_json(F.struct(F.array(series).alias("seriess"))).alias("payload"))
    named = bmeta(spark, d).where("units <> 'ECONOMY'").select("series_id", F.concat(F.lit("Part "), "series_id").alias("friendly_name"))
    found = payloads.fetch_metadata(responses, "2024-02-01 08:00:00", named)
    return found.select("run_timestamp", "series_id", "friendly_name", "title", "units", "frequency", "notes")


def i12_catalog_join(spark, d):
    """The names of a catalog that is a table: each series of the events by its customer."""
    return catalog.with_friendly_name(obs(spark, d).select("series_id", "date", "value"), meta(spark, d))


def c5_audit_stamps(spark, d):
    bronze = layers.bronze_observations(_landing_rows(spark, d), AS_OF)
    silver = layers.silver_observations(bronze, "2024-02-16 10:00:00")
    stamped = bronze.select("series_id", "date", F.col("ingestion_timestamp").alias("stamp")).unionByName(
        silver.select("series_id", "date", F.col("updated_at").alias("stamp"))
    )
    return stamped.withColumn("stamp", P.format_timestamp("stamp"))


def i3_offset_timestamps(spark, d):
    """Run times with full and short offsets, and without one, read and written in UTC."""
    text = P.format_timestamp("run_timestamp")
    offset = F.element_at(F.create_map(*map(F.lit, ("click", "-06", "view", "+05:30", "purchase", "Z"))), F.col("series_name"))
    found = obs(spark, d).select("series_id", "date", F.concat(text, F.coalesce(offset, F.lit(""))).alias("text"))
    return found.withColumn("utc", P.format_timestamp(P.parse_offset_timestamp("text"))).drop("text")


def h3_empty_result(spark, d):
    """No response at all leaves no rows, but all columns."""
    none = _responses(spark, d).where(F.col("payload").isNull())
    return payloads.fetch_observations(none, "2024-02-01 08:00:00", _RESPONSE_CATALOG).select(*LANDING_OBSERVATIONS.names)


def _responses(spark, d) -> DataFrame:
    """One response for each event: failed for errors, empty for sign-ups, else with one observation."""
    one = F.array(F.struct(F.col("date").cast("string").alias("date"), F.col("raw_value").alias("value")))
    payload = (
        F.when(F.col("series_name") == "error", F.lit('{"error_code": 400}'))
        .when(F.col("series_name") == "signup", F.lit('{"observations": []}'))
        .otherwise(F.to_json(F.struct(one.alias("observations"))))
    )
    return obs(spark, d).select(F.col("series_name").alias("series_id"), payload.alias("payload"))


_RESPONSE_CATALOG = {**EVENT_CATALOG, "error": "Errors"}


def a13_payload_status(spark, d):
    return payloads.payload_status(_responses(spark, d), _RESPONSE_CATALOG)


def a13_fetch(spark, d):
    fetched = payloads.fetch_observations(
        _responses(spark, d), "2024-02-01 08:00:00", _RESPONSE_CATALOG, "2024-01-05", "2024-01-25"
    )
    return fetched.select(*LANDING_OBSERVATIONS.names)


def b3_append_merged(spark, d):
    """The second append brings a new column and lacks an old one."""
    root = scratch_path(spark, "b3")
    table = "appended_" + root.rsplit("-", 1)[-1]
    tables.append(obs(spark, d).select("series_id", "date", "value"), table, root)
    tables.append(obs(spark, d).select("series_name", "date", "series_id"), table)
    columns = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    return spark.read.schema(columns).parquet(root)


def b1_csv_snapshot(spark, d):
    path = snapshots.save_csv(_landing_rows(spark, d), scratch_path(spark, "b1"), "observations", _RUN)
    bronze = layers.bronze_observations(landing.read_csv_runs(spark, [path], LANDING_OBSERVATIONS))
    return bronze.select("series_id", "series_name", "date", "value", P.format_timestamp("run_timestamp").alias("run"))


def b2_json_snapshot(spark, d):
    path = _land_metadata(spark, d, scratch_path(spark, "b2"))
    silver = layers.silver_metadata(layers.bronze_metadata(spark.read.schema(LANDING_METADATA).json(path)))
    return silver.select("series_id", "friendly_name", "title", "units", "popularity", "notes")


def b5_view_refresh(spark, d):
    """Two full refreshes; the second reads the view it replaces."""
    root = scratch_path(spark, "b5")
    table = "view_" + root.rsplit("-", 1)[-1]
    tables.refresh(big(spark, d), table, root)
    path = tables.refresh(spark.table(table).withColumn("value", F.col("value") + 1), table, root)
    spark.sql(f"DROP TABLE {table}")
    return landing.read_table(spark, path)


def b8_clustered_table(spark, d):
    path = scratch_path(spark, "b8")
    tables.clustered(big(spark, d), ["series_id", "date"]).write.parquet(path)
    return spark.read.parquet(path)


def b7_described_table(spark, d):
    """A table made from its description: rows beside the comments and properties that the catalog has."""
    root = scratch_path(spark, "b7")
    spec, table = TABLES["silver_observations"], "described_" + root.rsplit("-", 1)[-1]
    tables.create_from_spec(spark, table, spec, root)
    tables.append(layers.silver_observations(_landing_rows(spark, d), AS_OF), table)
    properties = tables.table_properties(spark, table)
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    rows = spark.read.schema(spec.schema).parquet(root).select(
        "series_id", "date", "value", F.lit(properties["quality"]).alias("quality"), F.lit(comments["value"]).alias("comment")
    )
    spark.sql(f"DROP TABLE {table}")
    return rows


def b8_layout(spark, d):
    """Files of a clustered table whose ranges of series and dates overlap, and the rows in all files."""
    path = scratch_path(spark, "b8layout")
    ranges = tables.range_count(landing.total_bytes(spark, f"{d}/lineitem.parquet"), 8)
    tables.clustered(big(spark, d), ["series_id", "date"], ranges).write.parquet(path)
    return _overlaps(spark.read.parquet(path), ["series_id", "date"], 8)


def _overlaps(rows: DataFrame, by: Sequence[str], several: int) -> DataFrame:
    """How many files of a table overlap others in their ranges of ``by``, the rows, and whether there are ``several`` files.

    Bounds of texts can't be updated in place, so that each task would sort all its rows by file: the series of a file come
    first, with the bounds of their dates, which can.
    """
    *texts, last = by if len(by) > 1 else (*by, None)
    # A missing date counts as the lowest.
    dates = [F.when(F.count(last) == F.count(F.lit(1)), F.min(last)).alias("first"), F.max(last).alias("last")] if last else []
    each = rows.groupBy(F.col("_metadata.file_path").alias("file"), *texts).agg(F.count(F.lit(1)).alias("n"), *dates)
    low, high = (F.struct(*texts, *([F.col(bound).alias("at")] if last else [])) for bound in ("first", "last"))
    held = each.groupBy("file").agg(F.min(low).alias("low"), F.max(high).alias("high"), F.sum("n").alias("n"))
    before = F.max("high").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    marked = held.withColumn("overlaps", F.coalesce(before > F.col("low"), F.lit(False)))
    return marked.agg(F.count_if("overlaps").alias("overlapping"), F.sum("n").alias("n"), (F.count("file") >= several).alias("many"))


_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def b8_streamed_layout(spark, d):
    """The same of the four streamed tables after one micro-batch; small ranges are not merged here."""
    before = spark.conf.get(_COALESCE)
    spark.conf.set(_COALESCE, "false")
    try:
        layout = _updated(spark, d, "b8s", ranged_batches=True)
    finally:
        spark.conf.set(_COALESCE, before)
    facts = []
    for name in ("bronze_metadata", "bronze_observations", "silver_metadata", "silver_observations"):
        held = _overlaps(landing.read_table(spark, layout.path(name)), TABLES[name].cluster_by, 2)
        facts.append(held.select(F.lit(name).alias("table"), "*"))
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")
    return reduce(DataFrame.unionByName, facts)


def b9_compacted(spark, d):
    """Many small files become few, with the same rows."""
    root = scratch_path(spark, "b9c")
    table = "compacted_" + root.rsplit("-", 1)[-1]
    tables.append(big(spark, d).repartition(16), table, f"{root}/small")
    before = landing.landed_files(spark, f"{root}/small").count()
    path = tables.compact(spark, table, root, ["series_id", "date"])
    spark.sql(f"DROP TABLE {table}")
    fewer = landing.landed_files(spark, path).where(F.col("file_path").endswith(".parquet")).count() < before
    return spark.read.parquet(path).withColumn("fewer_files", F.lit(fewer))


def b9_compacted_table(spark, d):
    path = scratch_path(spark, "b9")
    tables.sized(big(spark, d), "series_id", "date").write.parquet(path)
    return spark.read.parquet(path)


def j4_stream_silver(spark, d):
    silver = _taken(spark, _updated(spark, d, "j4"), "silver_observations")
    return silver.select("series_id", "series_name", "date", "value")


def j9_stream_gold(spark, d):
    return _taken(spark, _updated(spark, d, "j9"), "gold_observations")


def _later_half_first(spark, d, purpose: str, **options) -> update.Layout:
    """The newer half of the runs lands and is drained first, the older one with its revisions later, at the same time."""
    root = scratch_path(spark, purpose)
    layout = update.Layout(
        root=root,
        database="db_" + root.rsplit("-", 1)[-1],
        landing_observations=f"{root}/landing/observations",
        landing_metadata=f"{root}/landing/metadata",
        source=SOURCE,
        as_of=AS_OF,
        **options,
    )
    _land_metadata(spark, d, layout.landing_metadata)
    early, late = _halves(_landing_rows(spark, d))
    for number, part in enumerate((late, early)):
        snapshots.save_csv(part, layout.landing_observations, "observations", _RUN + dt.timedelta(days=number))
        update.run_update(spark, layout)
    return layout


def j2_continuous(spark, d):
    """Flows that keep running: a second run lands while they do."""
    root = scratch_path(spark, "j2")
    parts = _halves(_landing_rows(spark, d))
    snapshots.save_csv(parts[0], f"{root}/landing", "observations", _RUN)
    stream = layers.bronze_observations(landing.stream_csv(spark, f"{root}/landing", LANDING_OBSERVATIONS))
    query = flows.start_append(stream, f"{root}/bronze", f"{root}/checkpoint", interval="0 seconds")
    try:
        query.processAllAvailable()
        snapshots.save_csv(parts[1], f"{root}/landing", "observations", _RUN + dt.timedelta(days=1))
        query.processAllAvailable()
    finally:
        query.stop()
    return landing.read_table(spark, f"{root}/bronze").select("series_id", "series_name", "date", "value")


def k8_stream_quarantine(spark, d):
    """Two runs through all layers: kept and rejected rows of the silver flow, each with the rules it breaks."""
    layout = _later_half_first(spark, d, "k8", keep_rejected=True)
    path = layout.path("silver_observations")
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")
    kept, rejected = (flows.read_sorted(spark, path, outcome) for outcome in (quality.KEPT, quality.REJECTED))
    columns = ["series_id", "date", "value"]
    return kept.select(*columns, F.lit("").alias("failed_rules")).unionByName(
        rejected.select(*columns, F.array_join("failed_rules", ",").alias("failed_rules"))
    )


def j9_late_revision(spark, d):
    """An older run that arrives late, audit times being equal: the view follows the batches, not counts and maxima."""
    return _taken(spark, _later_half_first(spark, d, "j9late"), "gold_observations")


def b5_incremental_view(spark, d):
    """The same rows in a view that is refreshed by year: two updates, then a series is renamed, and renamed back."""
    layout = _later_half_first(spark, d, "b5inc", gold="incremental")
    for number, run in enumerate(("2024-02-02 08:00:00", "2024-02-03 08:00:00"), 1):
        named = meta(spark, d).withColumns(
            {
                "run_timestamp": F.lit(run),
                "title": F.concat(F.lit("Renamed " if number == 1 else ""), "friendly_name"),
            }
        )
        text = [(F.col(n) if n in named.columns else F.lit("")).alias(n) for n in LANDING_METADATA.names]
        few = named.where(F.col("series_id").cast("int") % 7 == 0).select(*text)
        snapshots.save_json_lines(few, layout.landing_metadata, "series_metadata", _RUN + dt.timedelta(days=number))
        update.run_update(spark, layout)
    path = f"{layout.root}/taken"
    spark.table(layout.table("gold_observations")).drop("period").write.parquet(path)
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")
    return landing.read_table(spark, path)


def j5_late_run(spark, d):
    """The older half of the runs arrives after the newer one, and rows without a run time twice: each row stays once."""
    root = scratch_path(spark, "j5late")
    rows = _landing_rows(spark, d)
    early, late = _halves(rows)
    lost = rows.where(F.col("series_name") == "click").withColumn("run_timestamp", F.lit(""))
    for number, part in enumerate((late.unionByName(lost), early, lost.unionByName(late))):
        snapshots.save_csv(part, f"{root}/landing", "observations", _RUN + dt.timedelta(days=number))
        stream = landing.stream_csv(spark, f"{root}/landing", LANDING_OBSERVATIONS)
        flows.drain(flows.start_append_once(layers.bronze_observations(stream), f"{root}/bronze", f"{root}/checkpoint"))
    return flows.read_once(spark, f"{root}/bronze").select(
        "series_id", "date", P.format_timestamp("run_timestamp").alias("run")
    )


def j8_stream_metrics(spark, d):
    layout = _updated(spark, d, "j8")
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")
    return metrics.read_metrics(spark, layout.metrics)


def j6_stream_upsert(spark, d):
    """The newer half of the runs arrives first; the late older half must not overwrite it."""
    root = scratch_path(spark, "j6")
    # Microseconds stay in the text, so that runs within a second keep their order.
    rows = obs(spark, d).withColumn("value", F.col("value").cast("string")).select(*LANDING_OBSERVATIONS.names)
    newer = F.col("run_timestamp") >= F.lit("2024-01-15").cast("timestamp_ntz")
    landed = f"{root}/landing"
    target = f"{root}/target"
    for number, part in enumerate((rows.filter(newer), rows.filter(~newer))):
        snapshots.save_csv(
            part.withColumn("run_timestamp", F.col("run_timestamp").cast("string")),
            landed,
            "observations",
            _RUN + dt.timedelta(days=number),
        )
        stream = landing.stream_csv(spark, landed, LANDING_OBSERVATIONS)
        bronze = layers.bronze_observations(stream).drop("ingestion_timestamp")
        flows.drain(upsert.start_upsert(bronze, target, f"{root}/checkpoint", period="month"))
    return spark.read.parquet(target).select("series_id", "date", "value", "series_name")


def j5_stream_drop_redelivered(spark, d):
    """The same run is delivered twice; each of its rows is kept once."""
    root = scratch_path(spark, "j5")
    for number in range(2):
        snapshots.save_csv(_landing_rows(spark, d), f"{root}/landing", "observations", _RUN + dt.timedelta(days=number))
    stream = landing.stream_csv(spark, f"{root}/landing", LANDING_OBSERVATIONS)
    once = flows.drop_redelivered(layers.bronze_observations(stream), "90 days")
    flows.drain(flows.start_append(once, f"{root}/bronze", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/bronze").select(
        "series_id", "date", P.format_timestamp("run_timestamp").alias("run")
    )


_REGISTERED = (
    d1_gold_join,
    d2_gold_current,
    d4_orphan_count,
    d5_orphans_by_key,
    d5_orphans_by_series,
    d6_dimension_without_facts,
    d7_latest_values,
    d7_latest_listing,
    d8_referential_filter,
    d9_calendar_gaps,
    e6_latest_wins,
    e6_latest_wins_large,
    f1_latest_wins_ranked,
    e7_drop_duplicates,
    f2_latest_only,
    c1_typed_projection,
    c7_null_violations,
    c8_missing_marker,
    c9_out_of_range,
    c10_future_dates,
    c11_id_format,
    c11_id_format_large,
    c12_membership,
    c12_missing_members,
    i6_clean_text,
    i12_catalog_lookup,
    a7_batch_read,
    a8_payload_explode,
    a9_payload_first,
    a10_catalog,
    a12_date_range,
    e1_layer_counts,
    h2_concat,
    h2_concat_missing_columns,
    e2_coverage,
    e2_coverage_copies,
    e3_freshness,
    e4_null_counts,
    e5_max_count,
    e8_resample_month,
    e8_resample_week,
    e8_resample_quarter,
    e8_resample_year_last,
    e8_resample_day_sum,
    e9_pk_duplicates,
    e10_distinct_series,
    e11_rows_per_series_run,
    g3_first_n,
    k1_expect_or_drop,
    k2_fail_mode,
    k2_refused,
    k3_warn_mode,
    k4_rule_metrics,
    k5_primary_key,
    k8_quarantine,
    k9_report,
    a3_inferred_schema,
    a4_schema_evolution,
    a4_stream_evolution,
    a5_load_by_pattern,
    a8_large_response,
    a11_landed_files,
    a11_landed_rows,
    a13_fetch_metadata,
    b7_described_table,
    b8_layout,
    b8_streamed_layout,
    b9_compacted,
    c5_audit_stamps,
    h3_empty_result,
    i3_offset_timestamps,
    i12_catalog_join,
    j2_continuous,
    a13_payload_status,
    a13_fetch,
    b1_csv_snapshot,
    b2_json_snapshot,
    b3_append_merged,
    b5_view_refresh,
    b8_clustered_table,
    b9_compacted_table,
    j4_stream_silver,
    j5_stream_drop_redelivered,
    j6_stream_upsert,
    j8_stream_metrics,
    j9_stream_gold,
    k8_stream_quarantine,
    j9_late_revision,
    b5_incremental_view,
    j5_late_run,
)


_sizes: dict[str, int] = {}


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        if sf_dir not in _sizes:
            _sizes[sf_dir] = landing.total_bytes(spark, sf_dir)
        size_shuffles(spark, _sizes[sf_dir])
        return query(spark, sf_dir)

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _configured(query) for query in _REGISTERED}
