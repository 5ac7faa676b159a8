"""Dirty text to typed columns: bad input is NULL and never an error (ANSI mode is on)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from seriesflow.functions import parsing as P
from seriesflow.schemas import BRONZE_OBSERVATIONS


@pytest.fixture
def parse(spark):
    def run(texts, function):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]

    return run


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_dates(parse):
    texts = ["2024-12-15", "2024-01-01", "2024-12-31", "2020-02-29", "2024-02-30", "", "None", None]
    days = [dt.date(2024, 12, 15), dt.date(2024, 1, 1), dt.date(2024, 12, 31), dt.date(2020, 2, 29)]
    assert parse(texts, P.parse_date) == days + [None] * 4


def test_a_time_of_day_is_no_run(parse):
    def typed(column):
        return P.typed(column, StringType(), TimestampType())

    assert parse(["12:30", "T12:30", " 08:00:00 ", "2024-12-10 08:00:00", " 2024-12-10"], typed) == [
        None, None, None, dt.datetime(2024, 12, 10, 8), dt.datetime(2024, 12, 10)
    ]


def test_values(parse):
    assert parse(["4.75", "0.0", "-1.5", "100.12345", "1e3", " 7 ", "5."], P.parse_double) == [
        4.75,
        0.0,
        -1.5,
        100.12345,
        1000.0,
        7.0,
        5.0,
    ]


def test_values_that_are_none(parse):
    texts = [".", "NaN", "nan", "", "None", "4.5d", "4.5f", "0x10", "1,5", "-", None]
    assert parse(texts, P.parse_double) == [None] * len(texts)


def test_infinite_values_stay(parse):
    assert parse(["inf", "-Infinity"], P.parse_double) == [float("inf"), float("-inf")]


@pytest.mark.parametrize("values, kept", [(["4.50", ".", "4.55"], 2), ([".", "."], 0)])
def test_missing_marker(spark, values, kept):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert df.filter(P.parse_double("value").isNotNull()).count() == kept


def test_nan_becomes_null_before_the_null_check(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "value double")
    assert df.filter("value IS NOT NULL").count() == 2
    assert df.filter(P.nan_to_null("value").isNotNull()).count() == 1


def test_integers(parse):
    assert parse(["86", "86.0", "", "None", "x", None], P.parse_int) == [86, None, None, None, None, None]


def test_run_timestamps(parse):
    found = parse(["2024-12-10 08:00:00", "2024-12-10 12:00:00", "2024-12-10 08:00:00.5", "x"], P.parse_timestamp)
    assert found[:2] == [dt.datetime(2024, 12, 10, 8), dt.datetime(2024, 12, 10, 12)]
    assert found[0] < found[1]
    assert found[2:] == [None, None]


def test_offset_timestamps(parse):
    texts = ["2024-12-10 08:00:00-06:00", "2024-12-10 08:00:00-06", "2024-12-10 08:00:00Z", "2024-12-10", None]
    found = parse(texts, P.parse_offset_timestamp)
    assert found == [dt.datetime(2024, 12, 10, 14)] * 2 + [dt.datetime(2024, 12, 10, 8), None, None]


def test_formats(parse):
    assert parse(["2024-12-10 08:05:09"], lambda c: P.format_timestamp(P.parse_timestamp(c), P.FILE_STAMP_FORMAT)) == [
        "20241210_080509"
    ]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("a\r\nb", "a b"),
        ("a\nb\rc", "a b c"),
        ("a\n\n\nb", "a b"),
        ("  a   b  ", "a b"),
        ("\ta\tb\t", "a\tb"),
        ("\xa0a　", "a"),
        ("", ""),
        (" \r\n ", ""),
        (None, None),
    ],
)
def test_clean_text(parse, text, cleaned):
    assert parse([text], P.clean_text) == [cleaned]


def test_clean_text_takes_long_runs_of_blanks(parse):
    run = "\t" * 200_000
    assert parse([f"a{run}b{run}"], P.clean_text) == [f"a{run}b"]


def test_or_empty(parse):
    assert parse([None, "x"], P.or_empty) == ["", "x"]


def test_projection_keeps_the_contract(spark):
    landed = spark.createDataFrame([("1", "2024-01-02", "x", "4.5")], "series_id string, date string, extra string, value string")
    typed = P.project(landed, BRONZE_OBSERVATIONS)
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in BRONZE_OBSERVATIONS]
    assert typed.select("series_id", "date", "value", "series_name").first() == ("1", dt.date(2024, 1, 2), 4.5, None)


def test_projection_from_other_types(spark):
    schema = StructType([StructField("n", IntegerType()), StructField("s", StringType())])
    df = spark.createDataFrame([(3_000_000_000, 5), (7, 6)], "n bigint, s int")
    assert [tuple(r) for r in P.project(df, schema).collect()] == [(None, "5"), (7, "6")]


def test_stamps(spark):
    df = spark.range(3).select(P.stamp().alias("now"), P.stamp("2024-01-02 03:04:05").alias("fixed"), P.today("2024-01-02").alias("day"))
    assert df.select("now").distinct().count() == 1
    assert df.select("fixed", "day").first() == (dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2))
