"""Scalar column helpers. All of them are built-in expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the topics, and the 365-day year used for ages.
DAY_TEXT = "yyyyMMdd"
SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"
BIRTHDAY_TEXT = "yyyy-MM-dd"
YEAR_MILLIS = 365 * 24 * 60 * 60 * 1000


def is_blank(text: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(text, F.lit("")) == ""


def event_time(ts: Column) -> Column:
    """Epoch milliseconds as a timestamp."""
    return F.timestamp_millis(ts)


def day_text(ts: Column) -> Column:
    """Epoch milliseconds as ``yyyyMMdd`` in the session time zone."""
    return F.date_format(event_time(ts), DAY_TEXT)


def second_text(time: Column) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(time, SECOND_TEXT)


def second_millis(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` as epoch milliseconds; null when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(SECOND_TEXT)))


def day_millis(text: Column) -> Column:
    """``yyyy-MM-dd`` as epoch milliseconds of its midnight; null when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(BIRTHDAY_TEXT)))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def age_years(birthday: Column, as_of: Column | None = None) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and ``as_of`` (default: now).

    Years of 365 days are part of the meaning, so this is not calendar age. Division
    truncates towards zero: a birthday less than a year ahead gives 0.
    """
    moment = F.current_timestamp() if as_of is None else as_of
    millis = F.unix_millis(moment) - day_millis(birthday)
    return F.call_function("div", millis, F.lit(YEAR_MILLIS)).cast("int")


def first_non_null(*columns: Column) -> Column:
    return F.coalesce(*columns)
