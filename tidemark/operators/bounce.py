"""Bounces: entry pages not followed by another page of the device in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators.visitors import is_entry

WITHIN_MS = 10_000
WATERMARK_MS = 0


def bounces(
    pages: DataFrame,
    within_ms: int = WITHIN_MS,
    first: Column | None = None,
    watermark_ms: int = WATERMARK_MS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Pages meeting ``first`` whose next page of the same device is not within ``within_ms``.

    Pages of a device are ordered by ``(ts, id)``. Works on tables and on streams.

    Time is cut into cells of ``within_ms``. All but the last page of a device in a cell
    are followed in time; the last one is decided by the first page of the next cell, and
    by nothing later. So each page is put into its own cell as a candidate and into the cell
    before as a follower, and the rest is a single aggregate per device and cell: it
    combines before the shuffle, and a task sends at most one row per device and cell,
    however hot the device. On a stream a cell is final when the watermark has passed the
    cell after it. ``columns`` names the columns to give back, which are what the shuffle
    carries (default: all).
    """
    start_of = is_entry() if first is None else first
    ts = F.col("ts")
    given = pages.columns if columns is None else columns
    own = F.struct(
        ts.alias("at_ts"),
        F.when(start_of, F.struct(*given)).alias("page"),
        F.struct("ts", "id").alias("at"),
        F.lit(None).cast("bigint").alias("next_ts"),
    )
    follower = F.struct(
        (ts - within_ms).alias("at_ts"),
        F.lit(None).alias("page"),
        F.lit(None).alias("at"),
        ts.alias("next_ts"),
    )
    marked = pages.select("mid", F.inline(F.array(own, follower)))
    if pages.isStreaming:
        marked = marked.withColumn("et", event_time(F.col("at_ts")))
        marked = marked.withWatermark("et", f"{watermark_ms + within_ms} milliseconds")
        cell = F.window("et", f"{within_ms} milliseconds")
    else:
        # A number instead of a window, and as the first key, makes the sorts cheaper.
        cell = F.col("at_ts") - F.pmod(F.col("at_ts"), F.lit(within_ms))
    decided = marked.groupBy(cell.alias("cell"), "mid").agg(
        F.max_by("page", "at").alias("page"),
        F.max("at").alias("at"),
        F.min("next_ts").alias("next_ts"),
    )
    unfollowed = F.col("next_ts").isNull() | (F.col("next_ts") - F.col("at.ts") >= within_ms)
    return decided.filter(F.col("page").isNotNull() & unfollowed).select("page.*")
