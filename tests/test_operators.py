"""Revisions, resampling, rules and checks on small literals."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from seriesflow.operators import checks, joins, quality, resample, revisions
from seriesflow.operators.quality import ExpectationError, Expectations
from seriesflow.plans import layers
from seriesflow.sources import catalog

REVISIONS = "series_id string, date string, value double, run_timestamp string"


def test_latest_run_wins(spark, rows):
    one = [("DFF", "2024-12-01", 4.50, "2024-12-10 08:00:00"), ("DFF", "2024-12-01", 4.55, "2024-12-10 12:00:00")]
    two = [("DGS10", "2024-12-01", 3.90, "2024-12-10 08:00:00"), ("DGS10", "2024-12-01", 3.95, "2024-12-10 12:00:00")]
    for data, wanted in ((one, [("DFF", 4.55)]), (one + two, [("DFF", 4.55), ("DGS10", 3.95)])):
        assert rows(revisions.latest_wins(spark.createDataFrame(data, REVISIONS)), "series_id", "value") == wanted


@pytest.mark.parametrize("seed", range(3))
def test_aggregate_and_ranking_agree_in_any_order(spark, rows, seed):
    chance = random.Random(seed)
    data = [
        (f"S{chance.randint(0, 3)}", f"2024-01-0{chance.randint(1, 3)}", chance.choice([1.0, 2.0, None]), f"2024-02-0{chance.randint(1, 4)}")
        for _ in range(80)
    ]
    shuffled = chance.sample(data, len(data))
    wanted = {}
    for row in data:
        order = (row[3], row[2] is not None, row[2] or 0.0)
        if row[:2] not in wanted or order > wanted[row[:2]][0]:
            wanted[row[:2]] = (order, row)
    expected = sorted((r for _, r in wanted.values()), key=repr)
    assert rows(revisions.latest_wins(spark.createDataFrame(data, REVISIONS))) == expected
    assert rows(revisions.latest_wins(spark.createDataFrame(shuffled, REVISIONS))) == expected
    assert rows(revisions.latest_wins_ranked(spark.createDataFrame(shuffled, REVISIONS))) == expected


def test_keep_first(spark, rows):
    data = [("DFF", "2024-12-01", 4.50, "b"), ("DFF", "2024-12-01", 4.50, "a"), ("DFF", "2024-12-02", 4.55, "c")]
    kept = revisions.keep_first(spark.createDataFrame(data, REVISIONS))
    assert rows(kept, "date", "run_timestamp") == [("2024-12-01", "a"), ("2024-12-02", "c")]


def test_latest_only_takes_one_row_and_latest_date_keeps_ties(spark, rows):
    data = [("A", "2024-01-01", 1.0, "a"), ("A", "2024-01-02", 2.0, "a"), ("A", "2024-01-02", 3.0, "b"), ("B", "2024-01-01", 4.0, "a")]
    df = spark.createDataFrame(data, REVISIONS)
    assert rows(revisions.latest_only(df), "series_id", "value") == [("A", 3.0), ("B", 4.0)]
    assert rows(revisions.at_latest_date(df), "series_id", "value") == [("A", 2.0), ("A", 3.0), ("B", 4.0)]


def _daily(spark, values):
    data = [("A", dt.date.fromisoformat(d), v) for d, v in values]
    return spark.createDataFrame(data, "series_id string, date date, value double")


@pytest.mark.parametrize(
    "frequency, periods",
    [
        ("d", ["2024-01-31", "2024-02-01", "2024-04-01", "2025-01-01"]),
        ("w", ["2024-01-29", "2024-04-01", "2024-12-30"]),
        ("m", ["2024-01-01", "2024-02-01", "2024-04-01", "2025-01-01"]),
        ("q", ["2024-01-01", "2024-04-01", "2025-01-01"]),
        ("a", ["2024-01-01", "2025-01-01"]),
    ],
)
def test_resample_periods(spark, rows, frequency, periods):
    df = _daily(spark, [("2024-01-31", 1.0), ("2024-02-01", 2.0), ("2024-04-01", 3.0), ("2025-01-01", 4.0)])
    found = rows(resample.resample(df, frequency), "period")
    assert sorted(f[0].isoformat() for f in found) == periods


def test_resample_methods(spark):
    df = _daily(spark, [("2024-01-01", 4.0), ("2024-01-02", 2.0), ("2024-01-03", None)])
    found = resample.resample(df, "m", total="sum", low="min", high="max", n="count", final="last").first()
    assert (found.value, found.total, found.low, found.high, found.n, found.final) == (3.0, 6.0, 2.0, 4.0, 2, 2.0)


def test_resample_rejects_unknown_frequency(spark):
    with pytest.raises(KeyError):
        resample.resample(_daily(spark, [("2024-01-01", 1.0)]), "x")


def test_calendar(spark, rows):
    days = resample.calendar(spark, "2024-02-28", "2024-03-01")
    assert days.count() == 3
    df = _daily(spark, [("2024-02-28", 1.0), ("2024-02-29", 1.0), ("2024-03-02", 1.0), ("2024-03-02", 1.0)])
    assert rows(resample.dates_outside_calendar(df, days)) == [(dt.date(2024, 3, 2),)]


RULED = "series_id string, value double"
RULES = {"id_not_null": "series_id IS NOT NULL", "in_range": "value BETWEEN -5 AND 25"}
DATA = [("A", 1.0), (None, 1.0), ("B", 99.0), ("C", None), (None, None)]


def test_drop_mode_counts_null_as_failed(spark, rows):
    assert rows(Expectations(RULES).enforce(spark.createDataFrame(DATA, RULED))) == [("A", 1.0)]


def test_warn_mode_keeps_rows(spark):
    assert Expectations(RULES, "warn").enforce(spark.createDataFrame(DATA, RULED)).count() == 5


def test_fail_mode(spark):
    rules = Expectations(RULES, "fail")
    assert rules.enforce(spark.createDataFrame([("A", 1.0)], RULED)).count() == 1
    with pytest.raises(PySparkException, match="in_range"):
        rules.enforce(spark.createDataFrame(DATA[2:4], RULED)).collect()
    with pytest.raises(PySparkException, match="expectation failed"):
        rules.enforce(spark.createDataFrame(DATA, RULED)).count()


def test_no_filter_gets_behind_the_check(spark, tmp_path):
    spark.range(1000).selectExpr("id AS value").write.parquet(f"{tmp_path}/t")
    rules = Expectations({"small": "value < 900"}, "fail")
    for late in ("value < 10", "value IS NULL"):
        with pytest.raises(PySparkException, match="expectation failed: small"):
            rules.enforce(spark.read.parquet(f"{tmp_path}/t")).filter(late).collect()
    assert rules.enforce(spark.range(900).selectExpr("id AS value")).filter("value < 10").count() == 10


def test_gate(spark):
    df = spark.range(1000).selectExpr("id AS value")
    rules = {"small": "value < 900", "any": "value IS NOT NULL"}
    with pytest.raises(ExpectationError) as error:
        Expectations(rules, "fail").gate(df)
    assert error.value.broken == {"small": 100}
    assert Expectations(rules, "fail").gate(df.where("value < 900")).count() == 900
    assert Expectations(rules, "drop").gate(df).count() == 900
    assert Expectations(rules, "warn").gate(df).count() == 1000
    assert Expectations({}, "fail").gate(df).count() == 1000


def test_a_row_without_a_run_is_not_the_first(spark, rows):
    df = spark.createDataFrame([("A", 1, None, 3.0), ("A", 1, 5, 2.0), ("B", 1, None, 1.0)], "series_id string, date int, run_timestamp int, value double")
    assert rows(revisions.keep_first(df)) == [("A", 1, 5, 2.0), ("B", 1, None, 1.0)]


def test_unknown_mode():
    with pytest.raises(ValueError):
        Expectations({}, "ignore")


def test_metrics_and_quarantine(spark, rows):
    df = spark.createDataFrame(DATA, RULED)
    assert rows(Expectations(RULES).metrics(df)) == [("id_not_null", 2, 3), ("in_range", 3, 2)]
    held = Expectations(RULES).quarantine(df)
    found = sorted(tuple(r) for r in held.select(F.array_join("failed_rules", ",")).collect())
    assert found == [("id_not_null",), ("id_not_null,in_range",), ("in_range",), ("in_range",)]
    assert held.count() + Expectations(RULES).enforce(df).count() == df.count()


def test_failures_are_counted_while_rows_pass(spark):
    seen = Observation("rules")
    kept = Expectations(RULES).enforce(Expectations(RULES).observe(spark.createDataFrame(DATA, RULED), seen))
    assert kept.count() == 1
    assert seen.get == {"rows": 5, "failed_id_not_null": 2, "failed_in_range": 3}


def test_rules_reach_the_scan(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame(DATA, RULED).write.parquet(path)
    plan = Expectations(RULES).enforce(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,-5.0)" in plan and "IsNotNull(series_id)" in plan


def test_field_rules(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 2.5, 5.0, 10.0, 15.0, -5.0, 25.0)], "value double")
    assert df.filter(~quality.in_range()).count() == 0
    days = spark.createDataFrame([(dt.date(2024, 12, 15),), (dt.date(2024, 12, 16),), (dt.date(2024, 12, 17),)], "date date")
    assert days.filter(quality.not_in_future(as_of="2024-12-15")).count() == 2
    assert spark.createDataFrame([(dt.date(2024, 12, 15),)], "date date").filter(quality.not_in_future()).count() == 1
    ids = spark.createDataFrame([(i,) for i in ("DFF", "DGS10", "MORTGAGE30US", "BAMLC0A0CM", "A_1", "dff", "A-1", "")], "series_id string")
    assert [r[0] for r in ids.select(quality.valid_id()).collect()] == [True] * 5 + [False] * 3
    assert [r[0] for r in ids.select(quality.is_upper()).collect()] == [True] * 5 + [False, True, True]


def test_primary_key(spark, rows):
    df = spark.createDataFrame([("A",), ("A",), ("B",), (None,), (None,)], "series_id string")
    assert rows(quality.primary_key_violations(df, ["series_id"])) == [(2, 1)]
    assert rows(quality.key_duplicates(df.filter("series_id IS NOT NULL"), ["series_id"])) == [("A", 2)]


@pytest.fixture
def facts(spark):
    data = [("A", "2024-01-01"), ("A", "2024-01-02"), ("X", "2024-01-01"), (None, "2024-01-01"), ("B", None)]
    return spark.createDataFrame([(s, d and dt.date.fromisoformat(d)) for s, d in data], "series_id string, date date")


@pytest.fixture
def dimension(spark):
    data = [("A", "a", "Daily"), ("A", "a", "Daily"), ("B", "b", "Weekly"), ("C", "c", "Daily")]
    return spark.createDataFrame(data, "series_id string, friendly_name string, frequency string")


def test_coverage_is_the_plain_outer_join(spark, rows, facts, dimension):
    facts.createOrReplaceTempView("facts")
    dimension.createOrReplaceTempView("dimension")
    plain = spark.sql("""
        SELECT m.series_id, m.friendly_name, m.frequency, count(r.date), min(r.date), max(r.date)
        FROM dimension m LEFT JOIN facts r ON m.series_id = r.series_id GROUP BY 1, 2, 3""")
    assert rows(checks.coverage(dimension, facts)) == rows(plain)
    assert rows(checks.coverage(dimension, facts), "series_id", "observation_count") == [("A", 4), ("B", 0), ("C", 0)]


def test_orphans(rows, facts, dimension):
    assert rows(checks.orphan_count(facts, dimension)) == [("Orphaned observations (no metadata)", 2)]
    assert rows(checks.orphans_by_series(facts, dimension)) == [("X", 1), (None, 1)]
    assert rows(joins.keep_referenced(facts, dimension), "series_id") == [("A",), ("A",), ("B",)]
    assert rows(joins.drop_referenced(facts, dimension), "series_id") == [("X",), (None,)]
    assert rows(checks.without_facts(dimension, facts), "series_id") == [("C",)]
    assert rows(checks.orphan_count(dimension, dimension), "count") == [(0,)]


def test_freshness(rows, facts):
    found = rows(checks.freshness(facts.filter("date IS NOT NULL"), "2024-01-05"), "series_id", "days_since_update")
    assert found == [("A", 3), ("X", 4), (None, 4)]


def test_null_checks(rows, facts):
    assert rows(checks.null_counts(facts, {"ids": "series_id", "dates": "date"})) == [(1, 1)]
    assert checks.null_violations(facts, ["series_id", "date"]).count() == 2


def test_counts(rows, facts):
    assert rows(checks.latest_and_count(facts)) == [(dt.date(2024, 1, 2), 5)]
    assert rows(checks.distinct_series(facts)) == rows(checks.distinct_series(facts, approximate=True)) == [(3,)]
    assert rows(checks.layer_counts({"a": facts, "b": facts.limit(0)})) == [("a", 5), ("b", 0)]


def test_empty_concat_keeps_columns(spark, facts):
    both = checks.concat([facts.limit(0), spark.createDataFrame([], "series_id string, value double")])
    assert both.columns == ["series_id", "date", "value"] and both.count() == 0


def test_sort_order(facts):
    days = [r.date for r in checks.by_date(facts.filter("date IS NOT NULL"), "desc").collect()]
    assert days == sorted(days, reverse=True)
    assert [r.date for r in checks.by_date(facts.filter("date IS NOT NULL")).collect()] == sorted(days)


def test_report(spark, rows):
    obs = spark.createDataFrame(
        [("DFF", dt.date(2024, 1, 1), 99.0), ("x!", dt.date(2030, 1, 1), None), (None, None, 1.0)],
        "series_id string, date date, value double",
    )
    meta = spark.createDataFrame([("DFF",), ("DFF",)], "series_id string")
    assert dict(rows(checks.report(obs, meta, as_of="2024-01-01"))) == {
        "Null series_id": 1,
        "Null date": 1,
        "Null value": 1,
        "Value out of range": 1,
        "Date in the future": 1,
        "Malformed series_id": 1,
        "Orphaned observations (no metadata)": 2,
        "Duplicate series_id in metadata": 1,
    }


def test_gold_fan_out(spark):
    """After two runs of the same files the plain join holds four copies, the current view one."""
    data = [("A", dt.date(2024, 1, 1), 1.0, dt.datetime(2024, 2, run)) for run in (1, 2)]
    obs = spark.createDataFrame(data, "series_id string, date date, value double, run_timestamp timestamp")
    meta = spark.createDataFrame(
        [("A", f"title {run}", "a", "%", dt.datetime(2024, 2, run)) for run in (1, 2)],
        "series_id string, title string, friendly_name string, units string, run_timestamp timestamp",
    )
    assert layers.gold_join(obs, meta, "SRC").count() == 4
    assert [r.title for r in layers.gold_current(obs, meta, "SRC").collect()] == ["title 2"]


def test_catalog(spark, rows):
    df = catalog.catalog(spark)
    assert df.count() == 15
    assert df.filter(~quality.is_upper()).count() == df.filter(~quality.valid_id()).count() == 0
    for group in (catalog.TREASURY_SERIES, catalog.MORTGAGE_SERIES, catalog.INFLATION_SERIES):
        assert df.filter(F.col("series_id").isin(*group)).count() == len(group)
    seen = spark.createDataFrame([(s,) for s in catalog.RATE_SERIES if s != "DFF"], "series_id string")
    assert rows(checks.missing_members(seen, df)) == [("DFF",)]
    found = seen.limit(1).select(catalog.friendly_name(F.lit("DFF")), catalog.friendly_name(F.lit("?"))).first()
    assert tuple(found) == ("Federal Funds Effective Rate", None)
