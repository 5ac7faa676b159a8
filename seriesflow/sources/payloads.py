"""Provider responses, stored as JSON files, to rows.

One pass of one Spark job over all response files replaces a request loop over the series. A response is
one bounded page of JSON; it is parsed where it lies, exploded, and never gathered by series.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from seriesflow.functions.parsing import clean_text, or_empty, parse_date, parse_double
from seriesflow.operators.joins import keep_referenced
from seriesflow.operators.resample import resample
from seriesflow.operators.revisions import latest_only
from seriesflow.schemas import LANDING_METADATA, LANDING_OBSERVATIONS
from seriesflow.sources.catalog import RATE_SERIES, catalog, with_friendly_name
from seriesflow.sources.landing import between_dates

# The response fields.
_ATTRIBUTES = (
    "title",
    "frequency",
    "frequency_short",
    "units",
    "units_short",
    "seasonal_adjustment",
    "seasonal_adjustment_short",
    "observation_start",
    "observation_end",
    "last_updated",
    "popularity",
)


#: A literal of the program, or a table (series_id, friendly_name) of any size.
Catalog = Mapping[str, str] | DataFrame


def _text_struct(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


OBSERVATIONS_PAYLOAD = StructType([StructField("observations", ArrayType(_text_struct("date", "value")))])
SERIES_PAYLOAD = StructType([StructField("seriess", ArrayType(_text_struct("id", *_ATTRIBUTES, "notes")))])


# A series id, then the number of a page, if any.
_SERIES_OF_FILE = r"^(.+?)(?:-[0-9]+)?(?:\.json.*)?$"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(series_id, payload) of response files named ``<series_id>.json`` or ``<series_id>-<page>.json``.

    A page is a number; ids may hold ``-`` and ``.``.
    """
    name = F.col("_metadata.file_name")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(
        F.regexp_extract(name, _SERIES_OF_FILE, 1).alias("series_id"), F.col("value").alias("payload")
    )


RECORD = _text_struct("date", "value")

#: What stands between two records of a compact response.
RECORD_BORDER = "},{"


def read_records(spark: SparkSession, path: str, border: str = RECORD_BORDER) -> DataFrame:
    """``(series_id, date, value, broken)`` of response files of any size: the scan cuts them at record borders.

    So a file is as many tasks as its size asks for, and no task holds more than a record, where ``read_payloads``
    takes a file as one text. ``border`` is the text between two records as the provider writes them; a response
    without it is still read, as one piece. Values stay text. ``broken`` has a piece that is no record, as a failed
    response leaves it; an empty list has no rows.
    """
    name = F.col("_metadata.file_name")
    pieces = spark.read.text(path, lineSep=border, recursiveFileLookup=True).select(
        F.regexp_extract(name, _SERIES_OF_FILE, 1).alias("series_id"), "value"
    )
    # The first piece begins with the response's own fields and the last one ends with them.
    inner = F.regexp_replace("value", r'(?s)^.*"observations"\s*:\s*\[\s*\{', "")
    inner = F.regexp_replace(inner, r"(?s)\}\s*\]\s*(,[^\]]*)?\}\s*$", "")
    one = F.from_json(F.concat(F.lit("{"), inner, F.lit("}")), RECORD)
    whole = F.from_json("value", OBSERVATIONS_PAYLOAD)["observations"]
    # A record holds no other object, so what still has a brace is a response in one piece.
    found = F.when(one["date"].isNotNull() & ~inner.contains("{"), F.array(one)).otherwise(whole)
    rows = pieces.where(F.trim("value") != "").select("series_id", "value", found.alias("found"))
    return rows.select(
        "series_id", F.when(F.col("found").isNull(), F.col("value")).alias("broken"), F.explode_outer("found").alias("o")
    ).where("o IS NOT NULL OR broken IS NOT NULL").select("series_id", "o.date", "o.value", "broken")


def fetch_records(
    records: DataFrame,
    run_timestamp: str | Column,
    series: Catalog = RATE_SERIES,
    observation_start: str | None = None,
    observation_end: str | None = None,
) -> DataFrame:
    """Landing rows of the records of all catalogued series, as :func:`fetch_observations` has them."""
    good = _wanted(records, series).where(F.col("broken").isNull())
    rows = good.select("series_id", parse_date("date").alias("date"), parse_double("value").alias("value"))
    rows = between_dates(rows, observation_start, observation_end)
    stamped = _catalogued(rows, series).withColumns(
        {"run_timestamp": _literal(run_timestamp), "series_name": F.col("friendly_name")}
    )
    return stamped.select(*LANDING_OBSERVATIONS.names)


def observations_of(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One typed (series_id, date, value) row for each observation; none for an empty list."""
    parsed = F.from_json(payload, OBSERVATIONS_PAYLOAD)["observations"]
    rows = payloads.select("series_id", F.explode(parsed).alias("o"))
    return rows.select("series_id", parse_date("o.date").alias("date"), parse_double("o.value").alias("value"))


def series_of(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The first series of each response as text columns; none for an empty response."""
    first = F.get(F.from_json(payload, SERIES_PAYLOAD)["seriess"], F.lit(0))
    return payloads.select("series_id", first.alias("s")).filter(F.col("s").isNotNull()).select("series_id", "s.*")


def payload_status(
    payloads: DataFrame, series: Mapping[str, str] = RATE_SERIES, payload: str = "payload"
) -> DataFrame:
    """(series_id, status, responses) for each catalog entry: ok, empty, failed or missing.

    A response that cannot be read skips its series, it does not end the run.
    """
    found = F.from_json(payload, OBSERVATIONS_PAYLOAD)["observations"]
    status = F.when(found.isNull(), "failed").when(F.size(found) == 0, "empty").otherwise("ok")
    counted = _wanted(payloads, series).select("series_id", status.alias("status")).groupBy("series_id", "status")
    counted = counted.agg(F.count(F.lit(1)).alias("responses"))
    wanted = catalog(payloads.sparkSession, series).select("series_id")
    return wanted.join(counted, "series_id", "left").select(
        "series_id",
        F.coalesce("status", F.lit("missing")).alias("status"),
        F.coalesce("responses", F.lit(0)).cast("bigint").alias("responses"),
    )


def _wanted(payloads: DataFrame, series: Catalog) -> DataFrame:
    """Responses of catalogued series, so that no other is parsed."""
    if isinstance(series, DataFrame):
        return keep_referenced(payloads, series)
    return payloads.filter(F.col("series_id").isin(list(series)))


def _catalogued(df: DataFrame, series: Catalog) -> DataFrame:
    """Rows of the catalogued series, with their names."""
    if isinstance(series, DataFrame):
        return with_friendly_name(df, series).where(F.col("friendly_name").isNotNull())
    # A literal's size is bounded, so it may be broadcast.
    return df.join(F.broadcast(catalog(df.sparkSession, series)), "series_id")


def fetch_observations(
    payloads: DataFrame,
    run_timestamp: str | Column,
    series: Catalog = RATE_SERIES,
    observation_start: str | None = None,
    observation_end: str | None = None,
    frequency: str | None = None,
    method: str = "avg",
    last_row_only: bool = False,
) -> DataFrame:
    """Landing rows of all catalogued series, stamped with one run timestamp.

    ``frequency`` (d, w, m, q, a) resamples them, dated by the start of the period. Empty and failed responses
    leave no rows; without any response the result is empty but typed.
    """
    rows = between_dates(observations_of(_wanted(payloads, series)), observation_start, observation_end)
    if frequency is not None:
        rows = resample(rows, frequency, method).withColumnRenamed("period", "date")
    if last_row_only:
        rows = latest_only(rows, order_by=("date",))
    stamped = _catalogued(rows, series).withColumns(
        {"run_timestamp": _literal(run_timestamp), "series_name": F.col("friendly_name")}
    )
    return stamped.select(*LANDING_OBSERVATIONS.names)


def fetch_metadata(
    payloads: DataFrame, run_timestamp: str | Column, series: Catalog = RATE_SERIES
) -> DataFrame:
    """Landing metadata of all catalogued series: text only, absent attributes empty, notes cleaned."""
    rows = _catalogued(series_of(_wanted(payloads, series)), series)
    columns = {
        "run_timestamp": _literal(run_timestamp),
        "series_id": F.coalesce("id", "series_id"),
        "friendly_name": F.col("friendly_name"),
        "notes": clean_text(or_empty("notes")),
    }
    return rows.select(*(columns.get(n, or_empty(n)).alias(n) for n in LANDING_METADATA.names))


def _literal(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value
