"""Time expressions.  Timestamps are naive UTC (``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
ISO_DATE = r"^\s*[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}([ T].*)?)?)?\s*$"


def parse_utc(col: Column, formats: tuple[str, ...] = ()) -> Column:
    """Lenient parse: ISO-8601 first, then each extra format; text that fits none becomes null.

    An explicit zone offset is converted to UTC.  Needs the session zone set to UTC.  ISO text starts with a
    four-digit year, so text that holds only a time never takes the day of the run.
    """
    attempts = [F.when(col.cast("string").rlike(ISO_DATE), col.try_cast("timestamp"))]
    attempts += [F.try_to_timestamp(col.cast("string"), F.lit(fmt)) for fmt in formats]
    return F.coalesce(*attempts).cast("timestamp_ntz")


def utc_column(df: DataFrame, name: str, formats: tuple[str, ...] = ()) -> Column:
    """The column as naive UTC; text is parsed, a column that has the type already costs nothing."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.col(name)
    return parse_utc(F.col(name), formats)


def micros(col: Column) -> Column:
    """Microseconds since 1970 in UTC."""
    return F.unix_micros(col.cast("timestamp"))


def midnight(col: Column) -> Column:
    return F.to_date(col).cast("timestamp_ntz")


def month_key(col: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(F.to_date(col), "yyyy-MM")


def month_start(col: Column) -> Column:
    """First day of the month as a date: the cheap grouping key behind :func:`month_key`."""
    return F.trunc(F.to_date(col), "MM")


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def whole_days_between(start: Column, end: Column) -> Column:
    """Elapsed days rounded down, so one hour before ``start`` is day -1."""
    elapsed, day = micros(end) - micros(start), F.lit(MICROS_PER_DAY)
    return ((elapsed - F.pmod(elapsed, day)) / day).cast("bigint")
