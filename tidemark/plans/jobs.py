"""The warehouse's jobs over tables. Each maps DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import bounce, cdc, logs, orders, stats, visitors
from tidemark.operators.dims import Dimension
from tidemark.operators.stats import DIMENSIONS


def repaired_logs(raw: DataFrame) -> DataFrame:
    """Raw log records to typed logs with the new-visitor flag repaired."""
    return visitors.repair_new_visitor(logs.parse_log(raw), flags=logs.parse_flags(raw))


def log_outputs(raw: DataFrame) -> DataFrame:
    """Raw log records to records ``(topic, id, value)`` for start, page and display topics."""
    return logs.split_log(repaired_logs(raw))


def page_table(raw: DataFrame) -> DataFrame:
    """The page views of raw log records, in the narrow typed form the later jobs read."""
    return logs.page_logs(repaired_logs(raw)).select(
        "id", "mid", "day", *DIMENSIONS, "page_id", "last_page_id", "during_time", "ts"
    )


def measures(pages: DataFrame, within_ms: int = bounce.WITHIN_MS) -> DataFrame:
    """Page view, session, unique visit and bounce measures of page views."""
    narrow = pages.select("id", "mid", "day", *DIMENSIONS, "last_page_id", "ts")
    return stats.union_measures(
        stats.page_measures(pages),
        stats.unique_visit_measures(visitors.unique_visits(narrow)),
        stats.bounce_measures(bounce.bounces(narrow, within_ms, columns=[*DIMENSIONS, "ts"])),
    )


def visitor_stats(
    pages: DataFrame, window: str = stats.WINDOW, within_ms: int = bounce.WITHIN_MS
) -> DataFrame:
    return stats.visitor_stats(measures(pages, within_ms), window)


def order_wide(
    order_records: DataFrame,
    detail_records: DataFrame,
    lower_ms: int = orders.LOWER_MS,
    upper_ms: int = orders.UPPER_MS,
) -> DataFrame:
    """Order and detail records to wide rows, before any dimension."""
    pairs = orders.interval_join(
        orders.parse_orders(order_records), orders.parse_details(detail_records), lower_ms, upper_ms
    )
    return orders.order_wide(pairs)


def order_wide_user(
    order_records: DataFrame,
    detail_records: DataFrame,
    users: DataFrame | Dimension,
    as_of: Column | None = None,
    lower_ms: int = orders.LOWER_MS,
    upper_ms: int = orders.UPPER_MS,
) -> DataFrame:
    """The wide-order job: join, then user age and gender."""
    wide = order_wide(order_records, detail_records, lower_ms, upper_ms)
    return orders.with_user(wide, users, as_of)


def order_wide_dims(
    wide: DataFrame,
    provinces: DataFrame | Dimension,
    skus: DataFrame | Dimension,
    spus: DataFrame | Dimension,
    trademarks: DataFrame | Dimension,
    categories3: DataFrame | Dimension,
    unique: bool = False,
    rows_per_task: int | None = None,
    details: DataFrame | None = None,
) -> DataFrame:
    """Fill the remaining dimension columns of wide rows by two lookups.

    Spu, trademark and category hang on the sku and are joined to it first, so the wide rows
    themselves are shuffled twice at most. ``unique`` says that no dimension has a key twice. A stream whose dimensions
    do not change gives their ``details``, :func:`tidemark.operators.orders.sku_details` of the same tables, made once.
    """
    located = orders.with_province(wide, provinces, unique, rows_per_task)
    if details is None:
        details = orders.sku_details(skus, spus, trademarks, categories3, unique)
    return orders.with_sku_details(located, details, unique, rows_per_task)


def routed_changes(raw: DataFrame, rules: DataFrame) -> DataFrame:
    """Change records, cleaned and routed by the rules."""
    return cdc.route_cdc(cdc.clean_cdc(cdc.parse_cdc(raw)), rules)


def change_records(routed: DataFrame, sink_type: str) -> DataFrame:
    """The routed changes of one sink kind as records ``(topic, id, key, value)``."""
    return routed.filter(F.col("sink_type") == sink_type).select(
        F.col("sink_table").alias("topic"), "id", "key", "value"
    )
