"""Visitor measures and their roll-up into tumbling event-time windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import event_time, now_millis, second_text
from tidemark.operators.visitors import is_entry
from tidemark.schemas import VISITOR_STATS_COLUMNS

WINDOW = "10 seconds"
WATERMARK = "3 seconds"
DIMENSIONS = ["ar", "ch", "vc", "is_new"]
MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _measures(rows: DataFrame, **values) -> DataFrame:
    columns = [F.coalesce(values.get(m, F.lit(0)), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    return rows.select(*DIMENSIONS, "ts", *columns)


def page_view_measures(pages: DataFrame) -> DataFrame:
    return _measures(pages, pv_ct=F.lit(1), dur_sum=F.col("during_time"))


def session_measures(pages: DataFrame) -> DataFrame:
    return _measures(pages.filter(is_entry()), sv_ct=F.lit(1))


def page_measures(pages: DataFrame) -> DataFrame:
    """Page views and sessions in one row per page: one read, and the same sums."""
    return _measures(
        pages, pv_ct=F.lit(1), sv_ct=is_entry().cast("bigint"), dur_sum=F.col("during_time")
    )


def unique_visit_measures(visits: DataFrame) -> DataFrame:
    return _measures(visits, uv_ct=F.lit(1))


def bounce_measures(jumps: DataFrame) -> DataFrame:
    return _measures(jumps, uj_ct=F.lit(1))


def union_measures(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def with_watermark(measures: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Add the event time ``et``, on a stream with a watermark.

    Set it on each source before the union. Spark then goes by the slowest source, so windows
    stay open until visits and bounces, which are known later than their pages, have come too; one
    watermark over the union would go by the fastest and drop them. A source that falls silent holds
    all windows open: send it a record of a later time now and then, or leave it out of the union.
    """
    timed = measures.withColumn("et", event_time(F.col("ts")))
    return timed.withWatermark("et", watermark) if measures.isStreaming else timed


def visitor_stats(
    measures: DataFrame, window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Sums per window and ``(ar, ch, vc, is_new)``.

    ``measures`` may have its event time already, see :func:`with_watermark`; a union of streams should.
    """
    timed = measures if "et" in measures.columns else with_watermark(measures, watermark)
    sums = timed.groupBy(F.window("et", window).alias("span"), *DIMENSIONS).agg(
        *[F.sum(m).alias(m) for m in MEASURES]
    )
    return sums.withColumns(
        {
            "stt": second_text(F.col("span.start")),
            "edt": second_text(F.col("span.end")),
            "ts": now_millis(),
        }
    ).select(*VISITOR_STATS_COLUMNS)
