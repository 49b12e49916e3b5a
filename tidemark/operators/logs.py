"""Log lines: parsing, and the split into start, page and display records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators.records import (
    as_long,
    is_filled_object,
    json_null_free,
    parse_json,
    text_variant,
    with_entry,
)
from tidemark.schemas import LOG, LOG_FLAGS, QUARANTINE_TOPIC, Topic

OBJECT = "map<string,variant>"


def parse_log(raw: DataFrame) -> DataFrame:
    """Typed log rows from records ``(id, value)``; ``value`` is kept.

    ``is_start`` tells logs with a non-empty ``start`` object, ``has_page`` those with a page
    object; ``displays`` stays text. Unusable rows stay in, see :func:`is_usable`.
    """
    ts = as_long(F.col("ts"))
    return parse_json(raw.select("id", "value"), LOG).select(
        "id",
        "value",
        "common.*",
        "page.page_id",
        "page.last_page_id",
        as_long(F.col("page.during_time")).alias("during_time"),
        ts.alias("ts"),
        is_filled_object(F.col("start")).alias("is_start"),
        F.col("page").isNotNull().alias("has_page"),
        F.lit(True).alias("whole"),
        "displays",
        F.to_date(event_time(ts)).alias("day"),
    )


def parse_flags(raw: DataFrame) -> DataFrame:
    """Only ``(mid, is_new, day)`` of log records: a cheaper parse for a first look."""
    day = F.to_date(event_time(as_long(F.col("ts"))))
    return parse_json(raw.select("value"), LOG_FLAGS).select("common.*", day.alias("day"))


def is_usable(listed: Column | None = None) -> Column:
    """A log needs a device and a time, and a page unless it is a start log.

    A log whose displays cannot be read (one has a member twice), or whose flag had to be
    repaired and could not be (``whole``), is not usable either: none of it may get lost. ``listed`` are the
    displays, where they are parsed already.
    """
    return (
        F.col("whole")
        & _displays_readable(_displays() if listed is None else listed)
        & F.col("mid").isNotNull()
        & F.col("ts").isNotNull()
        & (F.col("is_start") | F.col("has_page"))
    )


def _displays() -> Column:
    return F.from_json("displays", "array<variant>")


def _displays_readable(listed: Column) -> Column:
    """True unless ``displays`` begins like an array and is none."""
    array = F.coalesce(F.col("displays").startswith("["), F.lit(False))
    return F.when(array, listed.isNotNull()).otherwise(True)


def page_logs(logs: DataFrame) -> DataFrame:
    """Page views: usable logs that are not start logs."""
    return logs.filter(is_usable() & ~F.col("is_start"))


def display_values(listed: Column) -> Column:
    """The parsed displays of a page log as JSON texts, each with the page id set on it.

    Elements that are not objects are no displays.
    """
    displays = F.transform(listed, lambda d: F.try_variant_get(d, "$", OBJECT))

    def render(display: Column) -> Column:
        tagged = with_entry(display, "page_id", text_variant(F.col("page_id")))
        return F.to_json(json_null_free(tagged))

    present = F.filter(displays, lambda d: d.isNotNull())
    return F.coalesce(F.transform(present, render), F.array().cast("array<string>"))


def split_log(logs: DataFrame, numbered: bool = False) -> DataFrame:
    """Fan every log out to records ``(topic, id, value)`` in one pass, ``numbered`` with their ``part`` in the log.

    A start log gives one start record and no displays. Any other log gives one page record and one
    display record per display. Unusable logs go to the quarantine topic.
    """

    def record(topic: str, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), value.alias("value"))

    # parsed once, behind a generator
    logs = logs.select("*", F.inline(F.array(F.struct(_displays().alias("_listed")))))
    listed = F.col("_listed")
    value = F.col("value")
    page = F.array(record(Topic.PAGE, value))
    displays = F.transform(display_values(listed), lambda text: record(Topic.DISPLAY, text))
    outputs = (
        F.when(~is_usable(listed), F.array(record(QUARANTINE_TOPIC, value)))
        .when(F.col("is_start"), F.array(record(Topic.START, value)))
        .when(F.col("displays").isNull(), page)
        .otherwise(F.concat(page, displays))
    )
    if numbered:
        return logs.select("id", F.posexplode(outputs).alias("part", "out")).select("out.topic", "id", "out.value", "part")
    return logs.select("id", F.explode(outputs).alias("out")).select(
        "out.topic", "id", "out.value"
    )
