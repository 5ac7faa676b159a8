"""Streaming flows: idempotence, late revisions, rules, metrics, replays, and the update of all tables."""

import datetime as dt
import json
import random
import time
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seriesflow.operators import checks
from seriesflow.operators.quality import KEPT, OUTCOME, Expectations
from seriesflow.plans import layers, update
from seriesflow.schemas import BRONZE_OBSERVATIONS, LANDING_METADATA, LANDING_OBSERVATIONS
from seriesflow.sinks import tables
from seriesflow.sources import landing
from seriesflow.streaming import flows, metrics, named_csv, upsert

HEADER = ",".join(LANDING_OBSERVATIONS.names)


class Landing:
    def __init__(self, base):
        self.base, self.observations, self.metadata = base, base / "observations", base / "metadata"
        self.observations.mkdir(parents=True)
        self.metadata.mkdir()

    def land(self, name, *lines, header=HEADER):
        (self.observations / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    def describe(self, name, *series, run="2024-12-10 08:00:00"):
        lines = [json.dumps({n: "" for n in LANDING_METADATA.names} | {"run_timestamp": run, "title": "T"} | s) for s in series]
        (self.metadata / f"{name}.json").write_text("\n".join(lines) + "\n")


@pytest.fixture
def files(tmp_path):
    return Landing(tmp_path / "landing")


@pytest.fixture
def layout(spark, files, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    yield update.Layout(
        root=f"{tmp_path}/root",
        database=database,
        landing_observations=str(files.observations),
        landing_metadata=str(files.metadata),
        source="SRC",
    )
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _bronze(spark, files, tmp_path, **options):
    stream = landing.stream_csv(spark, str(files.observations), LANDING_OBSERVATIONS, **options)
    flows.drain(flows.start_append(layers.bronze_observations(stream), f"{tmp_path}/bronze", f"{tmp_path}/cp"))
    return spark.read.schema(BRONZE_OBSERVATIONS).parquet(f"{tmp_path}/bronze")


def test_files_are_loaded_once(spark, files, tmp_path, rows):
    files.land("a", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    assert _bronze(spark, files, tmp_path).count() == 1
    assert _bronze(spark, files, tmp_path).count() == 1
    files.land("b", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.55", "2024-12-10 12:00:00,DFF,Fed,2024-12-02,.")
    assert rows(_bronze(spark, files, tmp_path), "value") == [(4.5,), (4.55,), (None,)]


def test_run_folders(spark, files, tmp_path):
    files.land("plain", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    for folder in ("run1", "run2/deep", "_schema", "run3/_temporary"):
        (files.observations / folder).mkdir(parents=True)
        files.land(f"{folder}/part", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    assert _bronze(spark, files, tmp_path).count() == 3


def test_load_by_pattern(spark, files, tmp_path):
    files.land("observations_historical_1", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    files.land("other", "2024-12-10 08:00:00,DFF,Fed,2024-12-02,4.5")
    for _ in range(2):
        assert _bronze(spark, files, tmp_path, pattern="observations_historical_*.csv").count() == 1


def test_small_micro_batches(spark, files, tmp_path):
    for i in range(3):
        files.land(f"f{i}", f"2024-12-10 08:00:00,DFF,Fed,2024-12-0{i + 1},4.5")
    assert _bronze(spark, files, tmp_path, limits={"maxFilesPerTrigger": "1"}).count() == 3
    assert len(list((tmp_path / "cp" / "commits").glob("[0-9]*"))) == 3


def test_old_files_are_not_ignored(spark, files, tmp_path):
    import os

    files.land("new", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    assert _bronze(spark, files, tmp_path).count() == 1
    files.land("late", "2024-11-10 08:00:00,DFF,Fed,2024-11-01,4.5")
    old = time.time() - 90 * 86400
    os.utime(files.observations / "late.csv", (old, old))
    assert _bronze(spark, files, tmp_path).count() == 2


def test_other_header_stops_the_stream(spark, files, tmp_path):
    files.land("a", "DFF,2024-12-10 08:00:00,Fed,2024-12-01,4.5", header="series_id,run_timestamp,series_name,date,value")
    with pytest.raises(PySparkException):
        _bronze(spark, files, tmp_path)


def _named(spark, files, tmp_path, **options):
    query = named_csv.start_named_csv(
        spark, str(files.observations), f"{tmp_path}/bronze", f"{tmp_path}/cp", LANDING_OBSERVATIONS,
        lambda rows: rows, required=("series_id", "date"), **options,
    )
    flows.drain(query)
    return spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/bronze")


def test_columns_go_by_name(spark, files, tmp_path, rows):
    files.land("plain", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    files.land("extra", '2024-12-10 08:00:00,DFF,"Fed, the",2024-12-02,4.6,x,y', header=HEADER + ",note,flag")
    files.land("missing a+b %41", "2024-12-10 08:00:00,DFF,Fed,2024-12-03", header=HEADER.removesuffix(",value"))
    files.land("swapped", "4.8,2024-12-04,Fed,DFF,2024-12-10 08:00:00", header="value,date,series_name,series_id,run_timestamp")
    (files.observations / "empty.csv").write_text("")
    files.land("nothing")
    found = _named(spark, files, tmp_path, extra="extra_columns")
    assert rows(found, "date", "value", "series_id", "series_name", "extra_columns") == [
        ("2024-12-01", "4.5", "DFF", "Fed", None),
        ("2024-12-02", "4.6", "DFF", "Fed, the", '{"note":"x","flag":"y"}'),
        ("2024-12-03", None, "DFF", "Fed", None),
        ("2024-12-04", "4.8", "DFF", "Fed", None),
    ]
    files.land("late", "2024-12-05,DFF", header="date,series_id")
    assert _named(spark, files, tmp_path, extra="extra_columns").count() == 5
    seen = {tuple(r["columns"]): r for r in named_csv.seen_headers(spark, f"{tmp_path}/cp").collect()}
    full = tuple(LANDING_OBSERVATIONS.names)
    assert {k: (r["files"], r["first_batch"]) for k, r in seen.items()} == {
        full: (2, 0), (*full, "note", "flag"): (1, 0), full[:-1]: (1, 0), ("date", "series_id"): (1, 1),
        ("value", "date", "series_name", "series_id", "run_timestamp"): (1, 0),
    }
    assert seen[(*full, "note", "flag")]["added"] == ["note", "flag"] and seen[full[:-1]]["missing"] == ["value"]


def test_a_file_without_the_key_columns_stops_the_flow(spark, files, tmp_path):
    files.land("headless", "2024-12-10 08:00:00,DFF,Fed,2024-12-02,4.5", header="2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    with pytest.raises(PySparkException, match="no column series_id, date"):
        _named(spark, files, tmp_path)
    assert not (tmp_path / "bronze").exists()


def test_broken_csv_lines(spark, files, tmp_path, rows):
    files.land("a", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5", "2024-12-10 08:00:00,DFF,Fed", "1,2,3,4,5,6,7")
    found = _named(spark, files, tmp_path, corrupt=landing.CORRUPT_COLUMN)
    assert rows(found.where(f"{landing.CORRUPT_COLUMN} IS NULL"), "value") == [("4.5",)]
    assert rows(found.where(f"{landing.CORRUPT_COLUMN} IS NOT NULL"), landing.CORRUPT_COLUMN) == [
        ("1,2,3,4,5,6,7",), ("2024-12-10 08:00:00,DFF,Fed",)
    ]


def test_many_small_batches_by_name(spark, files, tmp_path):
    for i in range(4):
        files.land(f"f{i}", f"2024-12-10 08:00:00,DFF,Fed,2024-12-0{i + 1},4.5")
    found = _named(spark, files, tmp_path, limits={"maxFilesPerTrigger": "1"})
    assert found.count() == 4 and len(list((tmp_path / "bronze").glob("batch-*"))) == 4


def test_rows_are_appended_once(spark, tmp_path, rows):
    columns = "series_id string, date date, run_timestamp timestamp, value double"
    run, other = dt.datetime(2024, 12, 10), dt.datetime(2019, 1, 1)
    day, early = dt.date(2024, 12, 1), dt.date(2018, 5, 1)
    first = spark.createDataFrame([("A", day, run, 1.0), ("A", day, None, 2.0), ("A", day, None, 2.0)], columns)
    late = spark.createDataFrame([("A", early, other, 3.0), ("A", day, run, 1.0), (None, None, run, 4.0)], columns)
    again = spark.createDataFrame([("A", day, None, 2.0), (None, None, run, 4.0), ("B", early, other, 5.0)], columns)
    append = flows.appender_once(f"{tmp_path}/t")
    for number, batch in enumerate((first, late, again)):
        append(batch, number)
        append(batch, number)  # replayed
    found = flows.read_once(spark, f"{tmp_path}/t").select("series_id", "value")
    assert rows(found) == [("A", 1.0), ("A", 2.0), ("A", 3.0), ("B", 5.0), (None, 4.0)]


def test_broken_json_lines(spark, files, tmp_path):
    files.describe("a", {"series_id": "DFF", "unknown": 1})
    with (files.metadata / "a.json").open("a") as f:
        f.write('{"series_id": \n')
    stream = landing.stream_json(spark, str(files.metadata), LANDING_METADATA, corrupt_column=landing.CORRUPT_COLUMN)
    flows.drain(flows.start_append(stream, f"{tmp_path}/t", f"{tmp_path}/cp"))
    found = spark.read.parquet(f"{tmp_path}/t")
    assert found.filter(F.col(landing.CORRUPT_COLUMN).isNull()).select("series_id").collect() == [("DFF",)]
    assert found.filter(F.col(landing.CORRUPT_COLUMN).isNotNull()).count() == 1


def test_redelivered_rows(spark, files, tmp_path):
    for i in range(2):
        files.land(f"f{i}", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5", "2024-12-10 08:00:00,DFF,Fed,2024-12-02,4.6")
        stream = layers.bronze_observations(landing.stream_csv(spark, str(files.observations), LANDING_OBSERVATIONS))
        once = flows.drop_redelivered(stream, "7 days")
        flows.drain(flows.start_append(once, f"{tmp_path}/t", f"{tmp_path}/cp"))
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def _upsert(spark, files, tmp_path, **options):
    stream = layers.bronze_observations(landing.stream_csv(spark, str(files.observations), LANDING_OBSERVATIONS))
    flows.drain(upsert.start_upsert(stream, f"{tmp_path}/target", f"{tmp_path}/cp", **options))
    return spark.read.parquet(f"{tmp_path}/target")


@pytest.mark.parametrize("period", ["year", "month"])
def test_upsert(spark, files, tmp_path, rows, period):
    files.land("a", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.55", "2024-12-10 12:00:00,DFF,Fed,2023-12-01,1.0")
    assert _upsert(spark, files, tmp_path, period=period).count() == 2
    # An older run that arrives late changes nothing, a newer one does, other periods stay as they are.
    files.land("b", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.50")
    assert rows(_upsert(spark, files, tmp_path, period=period), "value") == [(1.0,), (4.55,)]
    files.land("c", "2024-12-11 08:00:00,DFF,Fed,2024-12-01,4.60", "2024-12-11 08:00:00,X,X,,7")
    assert rows(_upsert(spark, files, tmp_path, period=period), "value") == [(1.0,), (4.6,), (7.0,)]
    files.land("d", "2024-12-11 08:00:00,Y,Y,,8")
    assert rows(_upsert(spark, files, tmp_path, period=period), "value") == [(1.0,), (4.6,), (7.0,), (8.0,)]
    assert len(list((tmp_path / "cp" / "staged").iterdir())) == 2


def test_upsert_survives_a_crash_while_partitions_are_replaced(spark, tmp_path, rows):
    run = upsert.upserter(f"{tmp_path}/target", f"{tmp_path}/staged")
    schema = "series_id string, date date, value double, run_timestamp string"
    day = dt.date(2024, 12, 1)
    run(spark.createDataFrame([("A", day, 1.0, "r1"), ("B", day, 2.0, "r1")], schema), 0)
    batch = spark.createDataFrame([("A", day, 3.0, "r2")], schema)
    run(batch, 1)
    # As if the job had died after the old partition was removed and before the new one was in place.
    for path in (tmp_path / "target").rglob("*.parquet"):
        path.unlink()
    run(batch, 1)
    assert rows(spark.read.parquet(f"{tmp_path}/target"), "series_id", "value") == [("A", 3.0), ("B", 2.0)]


SCHEMA = "series_id string, date date, value double, run_timestamp string, updated_at int"
AUDIT = ("run_timestamp", "updated_at")


def _differences(tmp_path):
    folders = {"notes": f"{tmp_path}/cp/touched", "confirmed": f"{tmp_path}/cp/confirmed"}
    return upsert.upserter(f"{tmp_path}/target", f"{tmp_path}/staged", audit=AUDIT, **folders)


def _files(tmp_path):
    found = {}
    for path in (tmp_path / "target").rglob("*.parquet"):
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


def test_upsert_rewrites_the_periods_that_differ(spark, tmp_path, rows):
    """A full history that comes again with one revision rewrites one year; the others are known to be confirmed."""
    run, days = _differences(tmp_path), [dt.date(2020 + i // 3, 1 + i % 3, 1) for i in range(12)]

    def history(name, revised=None):
        data = [(s, d, 2.0 if (s, d) == revised else 1.0, name, 0) for s in "AB" for d in days]
        return spark.createDataFrame(data, SCHEMA)

    run(history("r1"), 0)
    before = _files(tmp_path)
    assert len(before) == 4
    third = history("r3", ("A", days[4]))
    run(third, 1)
    after = _files(tmp_path)
    assert {p for p in after if after[p] != before[p]} == {"_year=2021"}
    assert upsert.touched_since(spark, f"{tmp_path}/cp", 0) == ["2021"]
    shown = upsert.read_current(spark, third, f"{tmp_path}/target", f"{tmp_path}/cp")
    assert rows(shown) == rows(third)
    # A replay of the batch writes the same rows.
    run(third, 1)
    assert rows(upsert.read_current(spark, third, f"{tmp_path}/target", f"{tmp_path}/cp")) == rows(third)
    # A late run is older than the one that confirmed a year, although no row of that run was written there.
    late = spark.createDataFrame([("A", days[0], 9.0, "r2", 0), ("C", days[0], 5.0, "r2", 0)], SCHEMA)
    run(late, 2)
    shown = upsert.read_current(spark, third, f"{tmp_path}/target", f"{tmp_path}/cp")
    assert rows(shown) == rows(third.unionByName(late.where("series_id = 'C'")))
    run(history("r3").limit(0), 3)
    assert rows(upsert.read_current(spark, third, f"{tmp_path}/target", f"{tmp_path}/cp")) == rows(shown)


def test_upsert_by_difference_is_latest_wins(spark, tmp_path, rows):
    """Any batches in any order, runs repeated and missing, keys and dates missing: always the latest run of all."""
    from seriesflow.operators.revisions import latest_wins

    rng, everything = random.Random(5), None
    run = _differences(tmp_path)
    days = [None, *(dt.date(2020 + i % 2, 1, 1 + i) for i in range(5))]
    for number in range(9):
        name = rng.choice([None, "r1", "r2", "r3", "r4"])
        keys = [(s, d) for s in ("A", None) for d in days]
        if number % 3 == 2:
            keys = rng.sample(keys, 4)
        odd = rng.choice(keys)
        names = [name] if number != 4 else ["r1", "r5"]
        data = [(s, d, float((s, d) == odd) if number % 2 else 0.0, rng.choice(names), 0) for s, d in keys]
        batch = spark.createDataFrame(data, SCHEMA)
        everything = batch if everything is None else everything.unionByName(batch)
        run(batch, number)
        shown = upsert.read_current(spark, batch, f"{tmp_path}/target", f"{tmp_path}/cp")
        assert rows(shown) == rows(latest_wins(everything))


def test_fail_mode_stops_the_stream_before_the_commit(spark, files, tmp_path):
    files.land("a", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,.")
    bronze = layers.bronze_observations(landing.stream_csv(spark, str(files.observations), LANDING_OBSERVATIONS))
    strict = Expectations.not_null("value", mode="fail").enforce(bronze)
    with pytest.raises(PySparkException, match="value_not_null"):
        flows.drain(flows.start_append(strict, f"{tmp_path}/t", f"{tmp_path}/cp"))
    assert not list((tmp_path / "cp" / "commits").glob("[0-9]*"))


def test_metrics_counted_twice_after_a_restart(spark, tmp_path, rows):
    data = [("f", "q", 0, "r", 1, 2, "t1"), ("f", "q", 0, "r", 1, 3, "t2"), ("f", "q", 1, "r", 0, 5, "t3")]
    spark.createDataFrame(data, metrics.METRICS_SCHEMA).write.parquet(f"{tmp_path}/m")
    assert rows(metrics.read_metrics(spark, f"{tmp_path}/m")) == [("f", "r", 1, 8)]


def test_counts_of_endless_flows(spark, files, tmp_path, rows):
    """Counts are flushed while the flow runs, and the rest when it stops; none is lost or counted twice."""
    recorder = metrics.QualityRecorder()
    spark.streams.addListener(recorder)
    rules = Expectations.not_null("value")
    stream = layers.bronze_observations(landing.stream_csv(spark, str(files.observations), LANDING_OBSERVATIONS))
    kept = rules.enforce(rules.observe(stream, metrics.metric_name("bronze")))
    stop = recorder.keep_flushing(spark, f"{tmp_path}/metrics", 0.5)
    query = flows.start_append(kept, f"{tmp_path}/t", f"{tmp_path}/cp", interval="0 seconds")
    try:
        for i in range(3):
            files.land(f"f{i}", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5", "2024-12-10 08:00:00,DFF,Fed,2024-12-02,.")
            query.processAllAvailable()
            time.sleep(1)
        assert (tmp_path / "metrics").exists()
    finally:
        query.stop()
        recorder.wait(query)
        stop()
        spark.streams.removeListener(recorder)
    assert rows(metrics.read_metrics(spark, f"{tmp_path}/metrics")) == [("bronze", "value_not_null", 3, 3)]
    with pytest.raises(TimeoutError):
        metrics.QualityRecorder().wait(query, timeout=0.1)


def _first_run(files):
    files.land(
        "run1",
        "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.50",
        "2024-12-10 08:00:00,DFF,Fed,2024-12-02,.",
        "2024-12-10 08:00:00,DFF,Fed,2024-12-03,NaN",
        "2024-12-10 08:00:00,DGS10,Ten,2024-12-01,3.90",
        "2024-12-10 08:00:00,ORPHAN,None,2024-12-01,1.0",
        "2024-12-10 08:00:00,DFF,Fed,2024-02-30,1.0",
    )
    files.describe("run1", {"series_id": "DFF", "popularity": "86", "last_updated": "2024-12-09 15:16:00-06"}, {"series_id": None})
    files.describe("run1b", {"series_id": "DGS10", "popularity": "None"})


def test_update(spark, files, layout, rows):
    _first_run(files)
    assert update.run_update(spark, layout)
    gold = spark.table(layout.table("gold_observations"))
    assert rows(gold, "series_id", "value", "source") == [("DFF", 4.5, "SRC"), ("DGS10", 3.9, "SRC")]
    silver = spark.table(layout.table("silver_metadata"))
    assert rows(silver, "series_id", "popularity", "last_updated") == [
        ("DFF", 86, dt.datetime(2024, 12, 9, 21, 16)),
        ("DGS10", None, None),
    ]
    counted = {(f, r): (n, m) for f, r, n, m in rows(metrics.read_metrics(spark, layout.metrics))}
    assert counted == {
        ("silver_metadata", "pk_series_id_not_null"): (1, 2),
        ("silver_observations", "fk_series_id_not_null"): (0, 6),
        ("silver_observations", "date_not_null"): (1, 5),
        ("silver_observations", "value_not_null"): (2, 4),
    }
    assert tables.table_properties(spark, layout.table("silver_metadata"))["quality"] == "silver"
    # Nothing new: nothing is added and the view is left alone.
    assert not update.run_update(spark, layout)
    assert spark.table(layout.table("bronze_observations")).count() == 6
    # The whole history again, with one revision.
    files.land("run2", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.55", "2024-12-10 12:00:00,DGS10,Ten,2024-12-01,3.90")
    files.describe("run2", {"series_id": "DFF", "title": "New"}, {"series_id": "DGS10"}, run="2024-12-10 12:00:00")
    assert update.run_update(spark, layout)
    gold = spark.table(layout.table("gold_observations"))
    assert rows(gold, "series_id", "value", "title") == [("DFF", 4.55, "New"), ("DGS10", 3.9, "T")]


def test_update_with_all_copies(spark, files, layout):
    from dataclasses import replace

    _first_run(files)
    files.land("run2", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.50")
    files.describe("run2", {"series_id": "DFF"}, run="2024-12-10 12:00:00")
    layout = replace(layout, gold="join", range_clustered=True)
    assert update.run_update(spark, layout)
    gold = spark.table(layout.table("gold_observations"))
    assert gold.filter("series_id = 'DFF'").count() == 4
    # A change of the view's definition is a reason to refresh.
    assert update.refresh_gold(spark, replace(layout, gold="current"))
    assert spark.table(layout.table("gold_observations")).count() == 2


def _file_ranges(stored, by):
    """Least and greatest key of each file, in order."""
    key = F.struct(*by)
    held = stored.groupBy(F.col("_metadata.file_path")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return sorted((tuple(r.low), tuple(r.high)) for r in held.collect())


def _apart(ranges):
    return all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:], strict=False))


@pytest.fixture
def small_ranges(spark):
    """AQE leaves ranges as they are, however small."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def _many_series(files, run, hour):
    """Three files that each hold all of twelve series, one of them with most rows and one row without a value."""
    for part in range(3):
        lines = [f"2024-12-10 {hour},S{n:02},N,2024-{m:02}-{part + 1:02},{n}.5" for n in range(12) for m in range(1, 5)]
        lines += [f"2024-12-10 {hour},S05,N,2023-{m:02}-{d:02},{m}.{d}" for m in range(1, 13) for d in range(part + 1, 28, 3)]
        files.land(f"{run}-{part}", *lines, f"2024-12-10 {hour},S07,N,2022-01-0{part + 1},.")
    files.describe(run, *({"series_id": f"S{n:02}"} for n in range(12)), run=f"2024-12-10 {hour}")


@pytest.mark.parametrize("options", [{}, {"keep_rejected": True}, {"strict_header": False}, {"gold": "incremental"}])
def test_files_of_a_batch_hold_narrow_ranges(spark, files, layout, rows, small_ranges, options):
    from dataclasses import replace

    layout = replace(layout, ranged_batches=True, **options)
    _many_series(files, "run1", "08:00:00")
    assert update.run_update(spark, layout)
    for name, by in (
        ("bronze_metadata", ["series_id"]),
        ("silver_metadata", ["series_id"]),
        ("bronze_observations", ["series_id", "date"]),
        ("silver_observations", ["series_id", "date"]),
    ):
        nested = name == "bronze_observations" and not layout.strict_header
        stored = spark.read.option("recursiveFileLookup", nested).parquet(layout.path(name))
        if layout.keep_rejected and name.startswith("silver"):
            stored = stored.where(F.col(OUTCOME) == KEPT)
        ranges = _file_ranges(stored, by)
        assert len(ranges) > 1 and _apart(ranges), (name, ranges)
    # The pass that samples the ranges does not count rows a second time.
    counted = {(f, r): (n, m) for f, r, n, m in rows(metrics.read_metrics(spark, layout.metrics))}
    assert counted["silver_observations", "value_not_null"] == (3, 468)
    assert counted["silver_metadata", "pk_series_id_not_null"] == (0, 12)
    gold = spark.table(layout.table("gold_observations"))
    assert gold.count() == gold.dropDuplicates(["series_id", "date"]).count() == 468
    # Nothing new: nothing is written. A second run comes as another batch.
    assert not update.run_update(spark, layout)
    _many_series(files, "run2", "12:00:00")
    assert update.run_update(spark, layout)
    assert spark.table(layout.table("silver_observations")).count() == 936
    assert spark.table(layout.table("gold_observations")).count() == 468


def test_without_ranges_files_overlap(spark, files, layout, small_ranges):
    _many_series(files, "run1", "08:00:00")
    flows.drain(*update.start_bronze(spark, layout))
    ranges = _file_ranges(spark.read.parquet(layout.path("bronze_observations")), ["series_id", "date"])
    assert len(ranges) > 1 and not _apart(ranges)


def test_an_empty_batch_has_no_ranges(spark, files, layout):
    from dataclasses import replace

    files.land("run1")
    files.describe("run1", {"series_id": "DFF"})
    assert update.run_update(spark, replace(layout, ranged_batches=True))
    assert spark.table(layout.table("silver_observations")).count() == 0
    assert spark.table(layout.table("silver_metadata")).count() == 1


def test_upserted_view_is_the_current_view(spark, files, layout, rows):
    from dataclasses import replace

    layout = replace(layout, gold="upserted")
    files.land("run2", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.55", "2024-12-10 12:00:00,DGS10,Ten,2024-12-01,3.90")
    files.describe("run2", {"series_id": "DFF", "title": "New"}, run="2024-12-10 12:00:00")
    assert update.run_update(spark, layout)
    _first_run(files)
    assert update.run_update(spark, layout)
    assert not update.run_update(spark, layout)
    gold = spark.table(layout.table("gold_observations"))
    assert rows(gold, "series_id", "value", "title") == [("DFF", 4.55, "New"), ("DGS10", 3.9, "T")]
    silver = [spark.table(layout.table(t)) for t in ("silver_observations", "silver_metadata")]
    assert rows(gold) == rows(layers.gold_current(*silver, "SRC"))


def test_the_view_follows_the_batches(spark, files, layout, rows):
    """A revision that changes neither a count nor a maximum of the inputs still reaches the view."""
    from dataclasses import replace

    layout = replace(layout, as_of="2024-12-11")
    files.land("b", "2024-12-10 08:00:00,DFF,Fed,2024-12-01,4.5")
    files.describe("b", {"series_id": "DFF"})
    assert update.run_update(spark, layout)
    before = update.input_version(spark, layout)
    assert not update.run_update(spark, layout) and update.input_version(spark, layout) == before
    files.land("a", "2024-12-09 08:00:00,DFF,Fed,2024-11-01,4.4")
    assert update.run_update(spark, layout) and update.input_version(spark, layout) != before
    assert rows(spark.table(layout.table("gold_observations")), "value") == [(4.4,), (4.5,)]


def _places(spark, layout):
    table = layout.table("gold_observations")
    found = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        year = r[0].partition("=")[2]
        found[year] = tables.partition_location(spark, table, "period", year).rsplit("/", 2)[-2]
    return found


def test_incremental_view(spark, files, layout, rows):
    from dataclasses import replace

    layout = replace(layout, gold="incremental")
    files.land("a", *(f"2024-12-10 08:00:00,{s},N,{y}-12-01,{y}" for s in ("DFF", "SOFR") for y in (2021, 2022, 2023)))
    files.describe("a", {"series_id": "DFF"}, {"series_id": "SOFR"})
    assert update.run_update(spark, layout)
    assert _places(spark, layout) == {"2021": "t0", "2022": "t0", "2023": "t0"}
    files.land("b", "2024-12-11 08:00:00,DFF,N,2022-12-01,7")
    assert update.run_update(spark, layout)
    assert _places(spark, layout) == {"2021": "t0", "2022": "t1", "2023": "t0"}
    # A series of its own year gets another title, then one that all years have.
    files.land("c", "2024-12-12 08:00:00,NEW,N,2019-12-01,1")
    files.describe("c", {"series_id": "NEW"}, run="2024-12-12 08:00:00")
    assert update.run_update(spark, layout)
    files.describe("d", {"series_id": "NEW", "title": "Second"}, run="2024-12-13 08:00:00")
    assert update.run_update(spark, layout)
    assert _places(spark, layout) == {"2019": "t1", "2021": "t0", "2022": "t1", "2023": "t0"}
    files.describe("e", {"series_id": "DFF", "title": "Other"}, run="2024-12-14 08:00:00")
    assert update.run_update(spark, layout) and not update.run_update(spark, layout)
    assert _places(spark, layout) == {"2019": "t1", "2021": "t1", "2022": "t0", "2023": "t1"}
    table = layout.table("gold_observations")
    silver = [spark.table(layout.table(t)) for t in ("silver_observations", "silver_metadata")]
    assert rows(spark.table(table).drop("period")) == rows(layers.gold_current(*silver, "SRC"))
    # Another kind of view over the same inputs, and back.
    assert update.refresh_gold(spark, replace(layout, gold="current"))
    assert rows(spark.table(table)) == rows(layers.gold_current(*silver, "SRC"))
    assert update.refresh_gold(spark, layout)
    assert rows(spark.table(table).drop("period")) == rows(layers.gold_current(*silver, "SRC"))


def test_new_observations_leave_the_descriptions(spark, files, layout, rows):
    """Without a new batch of the dimension its snapshot is neither written again nor compared."""
    from dataclasses import replace

    layout = replace(layout, gold="incremental")
    table, silver = (layout.table(name) for name in ("gold_observations", "silver_observations"))

    def refreshed():
        assert update.run_update(spark, layout)
        expected = layers.gold_current(spark.table(silver), spark.table(layout.table("silver_metadata")), "SRC")
        assert rows(spark.table(table).drop("period")) == rows(expected)
        return tables.table_properties(spark, table)["seriesflow.dimension"]

    files.land("a", "2024-12-10 08:00:00,DFF,N,2021-12-01,1", "2024-12-10 08:00:00,SOFR,N,2022-12-01,1")
    files.describe("a", {"series_id": "DFF"}, {"series_id": "SOFR", "title": None})
    first = refreshed()
    files.land("b", "2024-12-11 08:00:00,DFF,N,2022-12-01,7")
    assert refreshed() == first
    files.describe("c", {"series_id": "SOFR", "title": "Told"}, run="2024-12-12 08:00:00")
    second = refreshed()
    assert second != first
    # A batch that arrived need not be committed: its rows count all the same.
    assert update.refresh_gold(spark, layout, arrived=True)
    assert tables.table_properties(spark, table)["seriesflow.dimension"] == first


def test_changed_series(spark, rows):
    old = spark.createDataFrame([("A", "x"), ("B", None), ("C", "z"), ("D", "d")], "series_id string, title string")
    new = spark.createDataFrame([("A", "x"), ("B", "y"), ("C", None), ("E", "e")], "series_id string, title string")
    assert set(rows(update._changed_series(new, old))) == {("B",), ("C",), ("D",), ("E",)}


def test_one_year_is_cut_into_several_files(spark, tmp_path):
    """A year far below the advisory size is not the work of one task, in the upsert and in the view."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("date")
    rows = [F.sha2(F.col("id").cast("string"), 256).alias("series_id"), day, "id", F.lit("r1").alias("run_timestamp")]
    upsert.upserter(f"{tmp_path}/target", f"{tmp_path}/staged")(spark.range(400_000).select(*rows), 0)
    target = tmp_path / "target"
    assert [p.name for p in target.glob("_year=*")] == ["_year=2024"] and len(list(target.rglob("*.parquet"))) > 1
    assert spark.read.parquet(str(target)).agg(F.count_distinct("id")).first()[0] == 400_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "128MB"


def test_partitions_without_rows_go(spark, tmp_path, rows):
    table = f"parts_{uuid.uuid4().hex}"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    tables.refresh_partitions(first, table, f"{tmp_path}/t", "p", ["a", "b"])
    tables.refresh_partitions(first.where("p = 'a'").withColumn("x", F.lit(5)), table, f"{tmp_path}/t", "p", ["a", "b"])
    assert rows(spark.table(table)) == [(5, "a")]
    tables.refresh_partitions(first, table, f"{tmp_path}/t", "p", ["b"])
    assert rows(spark.table(table)) == [(2, "b"), (5, "a")]
    spark.sql(f"DROP TABLE {table}")


def test_rejected_rows_are_kept(spark, files, layout, rows):
    from dataclasses import replace

    layout = replace(layout, keep_rejected=True)
    assert not spark.catalog.databaseExists(layout.database)
    update.run_update(spark, layout)  # nothing has landed
    _first_run(files)
    assert update.run_update(spark, layout)
    read = spark.table(layout.table("bronze_observations")).count()
    kept = spark.table(layout.table("silver_observations"))
    rejected = spark.table(layout.table("silver_observations_rejected"))
    assert kept.columns == layers.TABLES["silver_observations"].schema.names
    assert kept.count() + rejected.count() == read and rejected.count() > 0
    named = rejected.select(F.explode("failed_rules").alias("rule")).groupBy("rule").count()
    counted = {(f, r): n for f, r, n, _ in rows(metrics.read_metrics(spark, layout.metrics))}
    assert {(r["rule"], r["count"]) for r in named.collect()} == {
        (r, n) for (f, r), n in counted.items() if f == "silver_observations" and n
    }
    assert not update.run_update(spark, layout)
    assert spark.table(layout.table("silver_observations_rejected")).count() == rejected.count()
    dropped = replace(layout, keep_rejected=False, root=f"{layout.root}2", database=layout.database + "2")
    update.run_update(spark, dropped)
    gold = [rows(spark.table(x.table("gold_observations"))) for x in (layout, dropped)]
    spark.sql(f"DROP DATABASE {dropped.database} CASCADE")
    assert gold[0] == gold[1]


def test_batch_and_stream_agree(spark, files, layout, rows):
    _first_run(files)
    update.run_update(spark, layout)
    landed = landing.read_csv_runs(spark, [str(files.observations)], LANDING_OBSERVATIONS)
    batch = layers.silver_observations(layers.bronze_observations(landed))
    columns = [c for c in batch.columns if c != "updated_at"]
    assert rows(batch, *columns) == rows(spark.table(layout.table("silver_observations")), *columns)


def test_warn_mode_keeps_failed_rows(spark, files, layout):
    from dataclasses import replace

    _first_run(files)
    update.run_update(spark, replace(layout, mode="warn"))
    assert spark.table(layout.table("silver_observations")).count() == 6


def test_update_in_fail_mode(spark, files, layout):
    from dataclasses import replace

    _first_run(files)
    with pytest.raises(PySparkException, match="expectation failed"):
        update.run_update(spark, replace(layout, mode="fail"))
    assert not spark.catalog.tableExists(layout.table("gold_observations"))


def test_update_without_files(spark, layout):
    update.run_update(spark, layout)
    assert spark.table(layout.table("gold_observations")).count() == 0


def test_streamed_tables_are_not_compacted_in_place(spark, files, layout, tmp_path):
    _first_run(files)
    update.run_update(spark, layout)
    with pytest.raises(ValueError):
        tables.compact(spark, layout.table("silver_observations"), f"{tmp_path}/c")
    tables.compact(spark, layout.table("gold_observations"), f"{tmp_path}/c", ["series_id", "date"])
    assert spark.table(layout.table("gold_observations")).count() == 2


@pytest.mark.parametrize("gold", ["current", "upserted"])
def test_continuous_mode(spark, files, layout, rows, gold):
    from dataclasses import replace

    layout = replace(layout, gold=gold)
    table = layout.table("gold_observations")

    def values():
        if not spark.catalog.tableExists(table):
            return []
        spark.catalog.refreshTable(table)
        return rows(spark.table(table), "series_id", "value", "title")

    def wait_for(wanted):
        deadline = time.time() + 90
        while time.time() < deadline and values() != wanted:
            assert all(q.exception() is None for q in queries)
            time.sleep(1)
        assert values() == wanted

    _first_run(files)
    queries = update.start_continuous(spark, layout, "1 second")
    try:
        wait_for([("DFF", 4.5, "T"), ("DGS10", 3.9, "T")])
        files.land("run2", "2024-12-10 12:00:00,DFF,Fed,2024-12-01,4.55")
        wait_for([("DFF", 4.55, "T"), ("DGS10", 3.9, "T")])
        files.describe("run2", {"series_id": "DFF", "title": "New"}, run="2024-12-10 12:00:00")
        wait_for([("DFF", 4.55, "New"), ("DGS10", 3.9, "T")])
    finally:
        for query in queries:
            query.stop()


def test_validation_statements_run_on_the_tables(spark, files, layout, rows):
    """What a user asks in SQL gives the same answers as the reports."""
    _first_run(files)
    files.describe("unused", {"series_id": "SOFR", "friendly_name": "S", "frequency": "Daily"})
    update.run_update(spark, layout)
    spark.sql(f"USE {layout.database}")
    try:
        obs, meta, gold = (spark.table(t) for t in ("silver_observations", "silver_metadata", "gold_observations"))
        names = ("bronze_observations", "bronze_metadata", "silver_observations", "silver_metadata", "gold_observations")
        counts = " UNION ALL ".join(f"SELECT '{n}' AS layer_table, COUNT(*) AS rows FROM {n}" for n in names)
        assert rows(spark.sql(counts)) == rows(checks.layer_counts({n: spark.table(n) for n in names}))
        coverage = spark.sql("""
            SELECT s.series_id, s.friendly_name, s.frequency, COUNT(o.date), MIN(o.date), MAX(o.date)
            FROM silver_metadata s LEFT JOIN silver_observations o USING (series_id) GROUP BY 1, 2, 3""")
        assert rows(coverage) == rows(checks.coverage(meta, obs))
        latest = spark.sql("""
            SELECT g.series_id, g.friendly_name, g.date, g.value, g.units FROM gold_observations g
            WHERE g.date = (SELECT MAX(h.date) FROM gold_observations h WHERE h.series_id = g.series_id)""")
        assert rows(latest) == rows(checks.latest_values(gold))
        fresh = spark.sql("SELECT series_id, MAX(date), DATEDIFF(CURRENT_DATE, MAX(date)) FROM silver_observations GROUP BY 1")
        assert rows(fresh) == rows(checks.freshness(obs))
        orphans = spark.sql("""
            SELECT 'Orphaned observations (no metadata)', COUNT(*) FROM silver_observations o
            LEFT JOIN silver_metadata s ON o.series_id = s.series_id WHERE s.series_id IS NULL""")
        assert rows(orphans) == rows(checks.orphan_count(obs, meta)) == [("Orphaned observations (no metadata)", 1)]
        nulls = spark.sql("SELECT COUNT(*) FROM silver_observations WHERE series_id IS NULL OR date IS NULL OR value IS NULL")
        assert nulls.first()[0] == checks.null_violations(obs, ["series_id", "date", "value"]).count() == 0
        assert {c.name: c.description for c in spark.catalog.listColumns("gold_observations")}["source"] == "data provider"
    finally:
        spark.sql("USE default")
