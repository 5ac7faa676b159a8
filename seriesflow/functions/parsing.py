"""Dirty text to typed columns. Bad input becomes NULL, never an error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructType,
    TimestampType,
)

# The provider's marker for a missing observation and the text formats of landing files.
MISSING_MARKER = "."
RUN_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FILE_STAMP_FORMAT = "yyyyMMdd_HHmmss"
LAST_UPDATED_FORMATS = ("yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssX")

# A JVM double literal also allows suffixes (4.5d) and hexadecimal floats, which are not numbers in the files.
_NUMBER = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"

# A cast also reads a bare time of day.
_DATED = r"^\s*[0-9]{4,}-"

# Unicode white space, as stripped from both ends of free text.
_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def missing_to_null(column: Column | str, marker: str = MISSING_MARKER) -> Column:
    """Trimmed text, NULL where it is the missing marker."""
    return F.nullif(F.trim(_col(column)), F.lit(marker))


def nan_to_null(column: Column | str) -> Column:
    """NaN passes IS NOT NULL, so it has to become NULL before any null check."""
    value = _col(column)
    return F.when(~F.isnan(value), value)


def parse_double(column: Column | str, marker: str = MISSING_MARKER) -> Column:
    """Text to double; the missing marker, NaN and anything that is not a number become NULL."""
    text = missing_to_null(column, marker)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_int(column: Column | str) -> Column:
    return _col(column).try_cast("int")


def parse_date(column: Column | str) -> Column:
    return F.try_to_date(_col(column))


def parse_timestamp(column: Column | str, pattern: str = RUN_TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(_col(column), F.lit(pattern))


def parse_offset_timestamp(column: Column | str) -> Column:
    """Text with a zone offset; ``-06:00`` and the short ``-06`` are both read."""
    return F.coalesce(*(parse_timestamp(column, pattern) for pattern in LAST_UPDATED_FORMATS))


def format_timestamp(column: Column | str, pattern: str = RUN_TIMESTAMP_FORMAT) -> Column:
    return F.date_format(_col(column), pattern)


def clean_text(column: Column | str) -> Column:
    """Line breaks to blanks, runs of blanks to one, ends stripped; NULL stays NULL, empty stays empty."""
    # Turning breaks into blanks and then collapsing blanks is one pass over runs of both.
    return F.trim(F.regexp_replace(_col(column), r"[ \r\n]+", " "), F.lit(_WHITESPACE))


def or_empty(column: Column | str) -> Column:
    """The default of an absent attribute."""
    return F.coalesce(_col(column), F.lit(""))


def typed(column: Column, source: DataType, target: DataType) -> Column:
    """``column`` as ``target``; text goes through the tolerant parsers."""
    if isinstance(target, DoubleType):
        return parse_double(column) if isinstance(source, StringType) else nan_to_null(column.try_cast(target))
    if isinstance(source, StringType) and isinstance(target, DateType):
        return parse_date(column)
    if isinstance(source, StringType) and isinstance(target, IntegerType):
        return parse_int(F.trim(column))
    if isinstance(source, StringType) and isinstance(target, TimestampType):
        # A time without a date would become that time of the current day.
        return F.when(column.rlike(_DATED), column.try_cast("timestamp"))
    return column.try_cast(target)


def project(df: DataFrame, schema: StructType, **computed: Column) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types.

    A column given in ``computed`` is taken as it is, a column that ``df`` lacks is NULL and extra columns go.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for target in schema.fields:
        if target.name in computed:
            column = computed[target.name]
        elif target.name in present:
            column = typed(F.col(target.name), present[target.name], target.dataType)
        else:
            column = F.lit(None).cast(target.dataType)
        columns.append(column.alias(target.name))
    return df.select(*columns)


def stamp(as_of: str | None = None) -> Column:
    """The audit time: one value for each query or micro-batch, or the given literal."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def today(as_of: str | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")
