"""Daily unique visits of an unbounded page stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.functions import day_text
from tidemark.operators.visitors import entry_pages

TTL_MS = 24 * 60 * 60 * 1000
VISIT = "mid string, day string, ts bigint, id bigint"


def _keep_first():
    """Per device and day, the first row of each Arrow batch."""

    def keep(batches):
        for rows in batches:
            yield rows.sort_values(["ts", "id"]).drop_duplicates(["mid", "day"])

    return keep


def _visit(ttl_ms: int):
    """Per device: the first row of every day, but the first of them if its day was the last one seen."""

    def visit(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        import pandas as pd

        rows = pd.concat(batches, ignore_index=True).sort_values(["ts", "id"]).drop_duplicates("day")
        now = state.getCurrentProcessingTimeMs()
        last, expires = state.get if state.exists else (None, 0)
        # the days differ from each other, so only the first can be the one already open
        opened = rows.iloc[1:] if expires > now and rows["day"].iloc[0] == last else rows
        if len(opened):
            expires = now + ttl_ms
            state.update((opened["day"].iloc[-1], expires))
        state.setTimeoutDuration(int(expires - now))
        yield opened[["id"]]

    return visit


def opening_ids(pages: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """The ``id`` of each page that opens a device's day.

    A page opens a day when the day differs from that of the last opening page of the
    device. Within a micro-batch pages count in the order of ``(ts, id)``, across batches in
    order of arrival. A device is forgotten ``ttl_ms`` of processing time after its last
    opening. State is the device and its last day; no text comes near it or Python.

    Before the shuffle each task keeps one row per device and day of every Arrow batch,
    so a hot device does not send its rows to one task.
    """
    visits = entry_pages(pages).select("mid", day_text(F.col("ts")).alias("day"), "ts", "id")
    first = visits.mapInPandas(_keep_first(), VISIT)
    return first.groupBy("mid").applyInPandasWithState(
        _visit(ttl_ms),
        "id bigint",
        "day string, expires bigint",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def with_openings(records: DataFrame, pages: DataFrame, ttl_ms: int = TTL_MS) -> DataFrame:
    """Records ``(id, value)`` of a page topic, and among them the openings, whose ``opens`` is true and value null."""
    opened = opening_ids(pages, ttl_ms)
    return records.select("id", "value", F.lit(False).alias("opens")).unionByName(
        opened.select("id", F.lit(None).cast("string").alias("value"), F.lit(True).alias("opens"))
    )


def opened(rows: DataFrame, openings: DataFrame) -> DataFrame:
    """The records of a micro-batch of :func:`with_openings` that open a day, each once.

    There are few openings, so it is they that are sent to the records when they fit; a text is shuffled only
    once it is known to open a day.
    """
    texts = rows.filter(~F.col("opens")).select("id", "value")
    return texts.join(openings, "id", "left_semi").dropDuplicates(["id"])
