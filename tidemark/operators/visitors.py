"""New-visitor repair and daily unique visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import is_blank
from tidemark.operators.records import text_variant, with_entry
from tidemark.operators.skew import ROWS_PER_TASK, hot_keys, join_table
from tidemark.sources.staging import stage

OBJECT = "map<string,variant>"

NEW = "1"
OLD = "0"


def is_entry() -> Column:
    """A page not reached from another page."""
    return is_blank(F.col("last_page_id"))


def entry_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(is_entry())


def first_new_days(logs: DataFrame) -> DataFrame:
    """``(mid, first_day, flagged)`` of the devices flagged new on two or more days.

    Only their logs can need a repair; ``flagged`` counts them. A narrow aggregate with
    map-side combining.
    """
    rows = logs.filter((F.col("is_new") == NEW) & F.col("mid").isNotNull())
    days = rows.groupBy("mid").agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("flagged"),
    )
    return days.filter(F.col("last_day") > F.col("first_day")).drop("last_day")


def repair_new_visitor(
    logs: DataFrame, flags: DataFrame | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Clear the new-visitor flag of flagged logs that fall on another than the first day.

    The first day of a device is the day of its earliest flagged log. Logs not flagged
    neither count nor change. ``flags`` holds ``(mid, is_new, day)`` of the same logs, where
    that is cheaper to read than the logs. The first days are written out before use, so
    that their true size decides how they are joined, and the logs themselves are shuffled
    only when it is too large to send to them.
    """
    days = stage(first_new_days(logs if flags is None else flags), "first-days")
    hot = hot_keys(days, ["mid"], rows_per_task, rows=F.col("flagged"))
    return apply_first_days(logs, days, hot)


def apply_first_days(logs: DataFrame, first_days: DataFrame, hot: DataFrame) -> DataFrame:
    """Repair logs by a table of ``(mid, first_day)``, in ``is_new`` and in the text.

    A text that cannot be rewritten is kept as it is and its log is no longer ``whole``.
    ``hot`` holds the devices with many flagged logs, see ``hot_keys``.
    """
    flagged = F.when(F.col("is_new") == NEW, F.col("mid"))
    joined = join_table(
        logs.withColumn("_flagged", flagged),
        first_days.select(F.col("mid").alias("_flagged"), "first_day"),
        ["_flagged"],
        hot=hot.withColumnRenamed("mid", "_flagged"),
    )
    wrong = F.coalesce(F.col("day") != F.col("first_day"), F.lit(False))
    # The text is parsed for logs to repair alone, and once: behind a generator the optimizer does not copy the
    # parse. It is null for a text that does not bear rewriting (a member twice); that stays as it is, and is marked.
    parsed = F.inline(F.array(F.struct(F.when(wrong, F.try_parse_json("value")).alias("_doc"))))
    checked = joined.select("*", parsed)
    whole = F.try_variant_get("_doc", "$.common", OBJECT).isNotNull()
    repaired = {
        "is_new": F.when(wrong, F.lit(OLD)).otherwise(F.col("is_new")),
        "value": F.when(wrong & whole, _with_flag(F.col("_doc"), OLD)).otherwise(F.col("value")),
        "whole": F.col("whole") & (~wrong | whole),
    }
    return checked.withColumns(repaired).select(*logs.columns)


def _with_flag(doc: Column, flag: str) -> Column:
    """The text of a parsed log with ``common.is_new`` set; texts that need no change are not rewritten."""
    common = F.try_variant_get(doc, "$.common", OBJECT)
    flagged = F.to_variant_object(with_entry(common, "is_new", text_variant(F.lit(flag))))
    return F.to_json(with_entry(F.try_variant_get(doc, "$", OBJECT), "common", flagged))


def unique_visits(pages: DataFrame) -> DataFrame:
    """The first entry page of each device on each day.

    The row-number limit is applied before the shuffle as well as after it, so each task
    sends at most one row per device and day, however hot the device.
    """
    order = W.partitionBy("mid", "day").orderBy("ts", "id")
    ranked = entry_pages(pages).withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank")
