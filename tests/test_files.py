"""Sources, sinks and payload jobs."""

import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

import driver_queries
from seriesflow import __main__ as jobs
from seriesflow.plans import layers
from seriesflow.plans.landing_run import land
from seriesflow.schemas import LANDING_METADATA, LANDING_OBSERVATIONS, TABLES
from seriesflow.session import path_exists, scratch_path, size_shuffles
from seriesflow.sinks import snapshots, tables
from seriesflow.sources import landing, payloads

RUN = dt.datetime(2024, 12, 10, 8, 0, 0)
HEADER = ",".join(LANDING_OBSERVATIONS.names)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_scratch_follows_the_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(base) and one != two


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1) == int(before)
        assert size_shuffles(spark, 1024**4) == 4096
        assert size_shuffles(spark, 1) == 4096
        assert size_shuffles(spark, 100 * 1024**4) == 50_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path))
    assert not path_exists(spark, f"{tmp_path}/none")


def test_csv_snapshot(spark, tmp_path, rows):
    df = spark.createDataFrame([("r", "DFF", 'a "b", c', "2024-01-01", None)], LANDING_OBSERVATIONS)
    path = snapshots.save_csv(df, str(tmp_path), "observations", RUN)
    assert path == f"{tmp_path}/observations_20241210_080000"
    lines = {x for f in (tmp_path / "observations_20241210_080000").glob("*.csv") for x in f.read_text().splitlines()}
    assert lines == {HEADER, 'r,DFF,"a ""b"", c",2024-01-01,'}
    assert rows(landing.read_csv_runs(spark, [path], LANDING_OBSERVATIONS)) == rows(df)
    with pytest.raises(AnalysisException):
        snapshots.save_csv(df, str(tmp_path), "observations", RUN)


def test_json_snapshot_keeps_nulls_and_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([("a\nb", None)], "notes string, title string")
    path = snapshots.save_json_lines(df, str(tmp_path), "metadata", RUN)
    lines = [x for f in (tmp_path / "metadata_20241210_080000").glob("*.json") for x in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"notes": "a\nb", "title": None}]
    assert rows(spark.read.schema(df.schema).json(path)) == rows(df)


def test_reading_by_name(spark, tmp_path, rows):
    """Columns in another order, one too many and one missing."""
    plain = write(tmp_path / "a" / "f.csv", f"{HEADER}\nr1,DFF,Fed,2024-01-01,1\n")
    extra = write(tmp_path / "b" / "f.csv", "series_id,extra,date,value,run_timestamp,series_name\nDFF,x,2024-01-02,2,r2,Fed\n")
    lacking = write(tmp_path / "c" / "f.csv", "run_timestamp,series_id,date,value\nr3,DFF,2024-01-03,\n")
    found = landing.read_csv_runs(spark, [plain, extra, lacking], LANDING_OBSERVATIONS)
    assert rows(found) == [
        ("r1", "DFF", "Fed", "2024-01-01", "1"),
        ("r2", "DFF", "Fed", "2024-01-02", "2"),
        ("r3", "DFF", None, "2024-01-03", None),
    ]


def test_schema_is_inferred_frozen_and_evolves(spark, tmp_path):
    first = write(tmp_path / "in" / "a.csv", f"{HEADER}\n2024-01-01 08:00:00,DFF,Fed,2024-01-01,1.5\n")
    found = landing.infer_csv_schema(spark, first)
    assert [f.dataType for f in found] == [TimestampType(), StringType(), StringType(), DateType(), DoubleType()]
    landing.save_schema(spark, found, f"{tmp_path}/schema")
    frozen = landing.load_schema(spark, f"{tmp_path}/schema")
    assert frozen == found
    second = write(tmp_path / "in" / "b.csv", "series_id,value,rank\nDFF,x,3\n")
    evolved = landing.evolve_schema(frozen, landing.infer_csv_schema(spark, second))
    assert evolved.fields[:5] == frozen.fields and evolved.fields[5].dataType == IntegerType()
    line = write(tmp_path / "in" / "c.json", '{"a": 1, "b": "x"}\n')
    assert landing.infer_json_schema(spark, line).names == ["a", "b"]


def test_landed_files(spark, tmp_path):
    write(tmp_path / "run1" / "a.csv", "12345")
    write(tmp_path / "run2" / "b.csv", "1")
    found = landing.landed_files(spark, str(tmp_path)).orderBy("file_path").collect()
    assert [r.file_path.rsplit("/", 2)[1:] for r in found] == [["run1", "a.csv"], ["run2", "b.csv"]]
    assert [r.file_size for r in found] == [5, 1]
    assert landing.total_bytes(spark, f"{tmp_path}/run1", f"{tmp_path}/run2") == 6


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    "start, end, days",
    [(None, None, 4), ("2024-01-02", None, 3), (None, "2024-01-03", 3), ("2024-01-02", "2024-01-03", 2)],
)
def test_date_range(spark, kind, start, end, days):
    stamps = [(f"2024-01-0{d} 23:59:59.5",) for d in range(1, 5)]
    df = spark.createDataFrame(stamps, "t string").select(F.col("t").cast("timestamp").cast(kind).alias("date"))
    assert landing.between_dates(df, start, end).count() == days


def test_date_range_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date date")
    df.write.parquet(f"{tmp_path}/t")
    ranged = landing.between_dates(landing.read_table(spark, f"{tmp_path}/t"), "2024-01-01", "2024-01-02")
    assert "GreaterThanOrEqual(date,2024-01-01)" in ranged._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def responses(tmp_path):
    obs, info = tmp_path / "obs", tmp_path / "info"
    write(
        obs / "DFF.json",
        json.dumps({"count": 3, "observations": [{"realtime_start": "x", "date": d, "value": v} for d, v in (("2024-01-01", "5.33"), ("2024-01-02", "."), ("2024-01-03", "5.30"))]}, indent=1),
    )
    write(obs / "DGS10-1.json", json.dumps({"observations": [{"date": "2024-01-01", "value": "4.0"}]}))
    write(obs / "DGS10-2.json", json.dumps({"observations": [{"date": "2024-01-02", "value": "4.1"}]}))
    write(obs / "SOFR.json", json.dumps({"observations": []}))
    write(obs / "DGS2.json", json.dumps({"error_code": 400}))
    write(obs / "DGS5.json", "<html>")
    write(obs / "OTHER.json", json.dumps({"observations": [{"date": "2024-01-01", "value": "1"}]}))
    write(
        info / "DFF.json",
        json.dumps({"seriess": [{"id": "DFF", "title": "Funds", "popularity": 86, "notes": "a\r\n b\n\nc ", "last_updated": "2024-12-10 08:00:00-06"}, {"id": "ZZZ"}]}),
    )
    write(info / "DGS10.json", json.dumps({"seriess": [{"title": "Ten"}]}))
    write(info / "SOFR.json", json.dumps({"seriess": []}))
    return str(obs), str(info)


def test_observations_of_responses(spark, responses, rows):
    read = payloads.read_payloads(spark, responses[0])
    found = payloads.fetch_observations(read, "2024-12-10 08:00:00")
    assert found.columns == LANDING_OBSERVATIONS.names
    assert rows(found, "series_id", F.col("date").cast("string"), "value") == [
        ("DFF", "2024-01-01", 5.33),
        ("DFF", "2024-01-02", None),
        ("DFF", "2024-01-03", 5.3),
        ("DGS10", "2024-01-01", 4.0),
        ("DGS10", "2024-01-02", 4.1),
    ]
    assert rows(found.select("run_timestamp", "series_name").distinct()) == [
        ("2024-12-10 08:00:00", "10-Year Treasury Rate"),
        ("2024-12-10 08:00:00", "Federal Funds Effective Rate"),
    ]
    ranged = payloads.fetch_observations(read, "r", observation_start="2024-01-02", observation_end="2024-01-02")
    assert rows(ranged, "series_id") == [("DFF",), ("DGS10",)]
    last = payloads.fetch_observations(read, "r", last_row_only=True)
    assert rows(last, "series_id", "value") == [("DFF", 5.3), ("DGS10", 4.1)]
    monthly = payloads.fetch_observations(read, "r", frequency="m", method="max")
    assert monthly.columns == LANDING_OBSERVATIONS.names
    assert rows(monthly, "series_id", "date", "value") == [
        ("DFF", dt.date(2024, 1, 1), 5.33),
        ("DGS10", dt.date(2024, 1, 1), 4.1),
    ]


def test_a_large_response_is_many_tasks(spark, tmp_path, rows):
    """The same rows as from one text, whatever the cuts; head, tail, empty and failed responses."""
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(9000)]
    records = [{"realtime_start": "x", "date": str(d), "value": "." if i % 7 == 0 else str(i)} for i, d in enumerate(days)]
    whole = {"count": 9000, "observations": records, "limit": 100000}
    folder = tmp_path / "r"
    folder.mkdir()
    (folder / "DFF.json").write_text(json.dumps(whole, separators=(",", ":")))
    (folder / "SOFR-2.json").write_text(json.dumps({"observations": records[:5]}, indent=1))
    (folder / "DGS1.json").write_text('{"observations":[]}')
    (folder / "DGS2.json").write_text('{"error_code":400}')
    (folder / "DGS5.json").write_text(json.dumps({"observations": records[:1]}, separators=(",", ":")))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = payloads.read_records(spark, str(folder))
        tasks = found.where("series_id = 'DFF'").select(F.spark_partition_id()).distinct().count()
        good = found.where("broken IS NULL").select("series_id", "date", "value")
        wanted = [("DFF", r["date"], r["value"]) for r in records] + [("SOFR", r["date"], r["value"]) for r in records[:5]]
        assert rows(good) == sorted([*wanted, ("DGS5", records[0]["date"], records[0]["value"])], key=repr)
        assert rows(found.where("broken IS NOT NULL"), "series_id", "broken") == [("DGS2", '{"error_code":400}')]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert tasks >= 5
    run = "2024-12-10 08:00:00"
    texts = payloads.read_payloads(spark, str(folder))
    one = payloads.fetch_observations(texts, run, observation_start="2001-01-01")
    assert rows(payloads.fetch_records(found, run, observation_start="2001-01-01")) == rows(one)


def test_a_catalog_that_is_a_table(spark, responses, rows):
    from seriesflow.sources.catalog import RATE_SERIES, catalog, with_friendly_name

    observations, series = (payloads.read_payloads(spark, str(p)) for p in responses)
    run, table = "2024-12-10 08:00:00", catalog(spark, RATE_SERIES)
    assert rows(payloads.fetch_observations(observations, run, table)) == rows(payloads.fetch_observations(observations, run))
    assert rows(payloads.fetch_metadata(series, run, table)) == rows(payloads.fetch_metadata(series, run))
    twice = table.unionByName(table.withColumn("friendly_name", F.lit("~")))
    df = spark.createDataFrame([("DFF", 1), ("none", 2), (None, 3)], "series_id string, friendly_name int")
    assert rows(with_friendly_name(df, twice)) == [("DFF", RATE_SERIES["DFF"]), ("none", None), (None, None)]


def test_rows_of_landed_files(spark, tmp_path):
    spark.range(7).coalesce(1).write.csv(f"{tmp_path}/x/run 1")
    spark.range(3).coalesce(1).write.csv(f"{tmp_path}/x/run%2B2")
    (tmp_path / "x" / "blank.csv").write_text("\n")
    rows = spark.read.option("recursiveFileLookup", True).schema("id int").csv(f"{tmp_path}/x")
    found = {r["file_path"].split("/x/")[1].split("/")[0]: r["rows"] for r in landing.landed_rows(rows, f"{tmp_path}/x").collect() if r["file_path"].endswith(".csv")}
    assert sorted(found.values()) == [0, 3, 7]


def test_failed_responses_are_counted(spark, responses, rows):
    status = payloads.payload_status(payloads.read_payloads(spark, responses[0]))
    found = {s: (k, n) for s, k, n in rows(status)}
    assert len(found) == 15
    assert found["DFF"] == ("ok", 1) and found["DGS10"] == ("ok", 2) and found["SOFR"] == ("empty", 1)
    assert found["DGS2"] == found["DGS5"] == ("failed", 1) and found["T5YIE"] == ("missing", 0)


def test_metadata_of_responses(spark, responses):
    found = payloads.fetch_metadata(payloads.read_payloads(spark, responses[1]), "2024-12-10 08:00:00")
    assert found.columns == LANDING_METADATA.names
    dff, dgs = found.orderBy("series_id").collect()
    assert (dff.series_id, dff.title, dff.popularity, dff.notes, dff.units) == ("DFF", "Funds", "86", "a b c", "")
    assert (dgs.series_id, dgs.friendly_name, dgs.notes) == ("DGS10", "10-Year Treasury Rate", "")


def test_nothing_to_fetch_is_empty_but_typed(spark, tmp_path):
    write(tmp_path / "p" / "SOFR.json", json.dumps({"observations": []}))
    read = payloads.read_payloads(spark, f"{tmp_path}/p")
    assert payloads.fetch_observations(read, "r").schema["value"].dataType == DoubleType()
    landed = land(spark, f"{tmp_path}/p", f"{tmp_path}/p", f"{tmp_path}/o", f"{tmp_path}/m", RUN)
    assert (landed.observations, landed.metadata) == (None, None)


def test_landing_run(spark, tmp_path, responses, rows):
    landed = land(spark, *responses, f"{tmp_path}/o", f"{tmp_path}/m", RUN)
    assert landed.observations.endswith("observations_historical_20241210_080000")
    bronze = layers.bronze_observations(landing.read_csv_runs(spark, [landed.observations], LANDING_OBSERVATIONS))
    silver = layers.silver_observations(bronze)
    assert (bronze.count(), silver.count()) == (5, 4)
    meta = layers.silver_metadata(spark.read.schema(LANDING_METADATA).json(landed.metadata))
    assert rows(meta, "series_id", "popularity", "last_updated") == [
        ("DFF", 86, dt.datetime(2024, 12, 10, 14)),
        ("DGS10", None, None),
    ]


@pytest.fixture
def table(spark):
    names = []

    def make(name):
        names.append(name)
        return name

    yield make
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_table_description(spark, tmp_path, table):
    spec = TABLES["silver_observations"]
    name = table("described")
    tables.create_from_spec(spark, name, spec, f"{tmp_path}/t")
    tables.create_from_spec(spark, name, spec, f"{tmp_path}/t")
    assert tables.table_properties(spark, name)["quality"] == "silver"
    said = "series_id in silver_metadata.series_id; never null: series_id, date, value"
    assert tables.table_properties(spark, name)["constraints"] == said
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["Comment"] == spec.comment
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["date"] == "observation date"


def test_comments_with_quotes(spark, tmp_path, table):
    name = table("quoted")
    schema = StructType([StructField("a", StringType(), True, {"comment": "it's a \\ sign"})])
    tables.create_table(spark, name, schema, f"{tmp_path}/t", "don't", {"k'": "v'"})
    assert spark.catalog.listColumns(name)[0].description == "it's a \\ sign"
    assert tables.table_properties(spark, name)["k'"] == "v'"


def test_append_merges_schemas(spark, table, rows):
    name = table("appended")
    tables.append(spark.createDataFrame([(1, "a")], "id int, name string"), name)
    tables.append(spark.createDataFrame([("x", 2)], "extra string, id int"), name)
    tables.append(spark.createDataFrame([("b", 3)], "name string, id int"), name)
    assert rows(spark.table(name), "id", "name", "extra") == [(1, "a", None), (2, None, "x"), (3, "b", None)]


def test_merged_schema_of_files(spark, tmp_path, rows):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/t")
    spark.createDataFrame([(2,)], "b int").write.mode("append").parquet(f"{tmp_path}/t")
    assert rows(landing.read_table(spark, f"{tmp_path}/t", merge_schema=True), "a", "b") == [(1, None), (None, 2)]


def test_refresh_swaps_only_complete_versions(spark, tmp_path, table, rows):
    name = table("viewed")
    tables.refresh(spark.range(3).toDF("n"), name, f"{tmp_path}/v", "a view", {"quality": "gold"})
    first = tables.table_location(spark, name)
    broken = spark.range(5).select(F.when(F.col("id") < 0, 1).otherwise(F.raise_error(F.lit("no"))).cast("long").alias("n"))
    with pytest.raises(Exception, match="no"):
        tables.refresh(broken, name, f"{tmp_path}/v")
    assert tables.table_location(spark, name) == first and rows(spark.table(name)) == [(0,), (1,), (2,)]
    for n in (4, 5, 6):
        tables.refresh(spark.range(n).toDF("n"), name, f"{tmp_path}/v")
        assert spark.table(name).count() == n
    assert sorted(p.name for p in (tmp_path / "v").iterdir()) == ["v0", "v1"]
    assert tables.table_properties(spark, name)["quality"] == "gold"


def test_a_reader_keeps_its_version(spark, tmp_path, table):
    name = table("versioned")
    tables.refresh(spark.range(3).toDF("n"), name, f"{tmp_path}/v", versions=3)
    reader = spark.read.parquet(tables.table_location(spark, name))
    for n in (4, 5):
        tables.refresh(spark.range(n).toDF("n"), name, f"{tmp_path}/v", versions=3)
        assert (reader.count(), spark.table(name).count()) == (3, n)
    assert sorted(p.name for p in (tmp_path / "v").iterdir()) == ["v0", "v1", "v2"]


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select(F.concat(F.lit("S"), F.col("id") % 40).alias("series_id"), F.col("id").alias("n"))
    tables.clustered(df, ["series_id"], 8).write.parquet(f"{tmp_path}/c")
    found = spark.read.parquet(f"{tmp_path}/c").groupBy(F.col("_metadata.file_path").alias("f"))
    found = found.agg(F.count_distinct("series_id").alias("k"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in found) == 4000 and len(found) > 1
    assert max(r.k for r in found) < 15


def test_a_hot_key_is_clustered_over_many_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select(F.lit("HOT").alias("series_id"), F.col("id").alias("n"))
    tables.clustered(df, ["series_id"], 8).write.parquet(f"{tmp_path}/c")
    sizes = spark.read.parquet(f"{tmp_path}/c").groupBy("_metadata.file_path").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1200


def test_compact(spark, tmp_path, table, rows):
    name = table("small_files")
    spark.range(0, 1000, 1, 8).toDF("n").write.option("path", f"{tmp_path}/s").saveAsTable(name)
    assert len(spark.table(name).inputFiles()) == 8
    tables.compact(spark, name, f"{tmp_path}/compacted")
    assert len(spark.table(name).inputFiles()) == 1 and spark.table(name).count() == 1000


def test_jobs(spark, tmp_path, responses, table, capsys):
    base = str(tmp_path)
    folders = ["--observations", f"{base}/landing/o", "--metadata", f"{base}/landing/m"]
    jobs.main(["land", "--observation-payloads", responses[0], "--series-payloads", responses[1], *folders])
    for _ in range(2):
        jobs.main(["update", "--root", f"{base}/root", "--database", "jobs_db", *folders, "--source", "SRC", "--gold", "upserted"])
    jobs.main(["report", "--database", "jobs_db"])
    printed = capsys.readouterr().out
    assert "gold refreshed" in printed and "gold unchanged" in printed and "Orphaned observations" in printed
    assert spark.table("jobs_db.gold_observations").count() == 4
    spark.sql("DROP DATABASE jobs_db CASCADE")


def test_series_ids_with_hyphens_and_dots_stay_apart(spark, tmp_path):
    for name in ("A-B.json", "A-C-1.json", "A-C-12.json", "A.D.json", "E.json"):
        (tmp_path / name).write_text('{"observations": []}')
    read = payloads.read_payloads(spark, str(tmp_path))
    assert sorted(r["series_id"] for r in read.collect()) == ["A-B", "A-C", "A-C", "A.D", "E"]


def test_layout_report_sorts_no_rows_by_file(spark, tmp_path):
    """Bounds of the files come from the series of each, not from all rows in order; missing dates are the lowest."""
    day = dt.date(2024, 1, 1)
    parts = [[("a", day), ("b", None)], [("b", day), ("c", day)], [("b", None), ("b", day)], [(None, day), (None, None)]]
    for number, part in enumerate(parts):
        spark.createDataFrame(part, "series_id string, date date").coalesce(1).write.parquet(f"{tmp_path}/t/run={number}")
    rows = spark.read.option("recursiveFileLookup", True).schema("series_id string, date date").parquet(f"{tmp_path}/t")
    report = driver_queries._overlaps(rows, ["series_id", "date"], 4)
    plan = report._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("HashAggregate") :]
    assert "Scan parquet" in below and "Sort" not in below
    # (a, 1) to (b, null), (b, null) to (b, 1), (b, 1) to (c, 1), and null to (null, 1): one bound is shared, none is crossed.
    assert [tuple(r) for r in report.collect()] == [(0, 8, True)]
    assert tuple(driver_queries._overlaps(rows, ["series_id"], 5).first())[1:] == (8, False)
    crossing = spark.createDataFrame([("a", None), ("z", day)], "series_id string, date date")
    crossing.coalesce(1).write.parquet(f"{tmp_path}/t/run=9")
    more = spark.read.option("recursiveFileLookup", True).schema("series_id string, date date").parquet(f"{tmp_path}/t")
    assert driver_queries._overlaps(more, ["series_id", "date"], 4).first()[0] > 0


def test_ranges_follow_the_input():
    assert tables.range_count(0, 8) == tables.range_count(8 * tables.RANGE_BYTES, 8) == 8
    assert tables.range_count(80 * tables.RANGE_BYTES + 1, 8) == 81
