"""Places of rows inside ordered groups, where one group may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.staging import stage


def in_order(rows: DataFrame, keys: list[Column | str], name: str) -> DataFrame:
    """``rows`` as a staged table with ``_id``, a number that ascends with ``keys``.

    The sort is by ranges over all tasks, so no group has to fit into one. Rows equal in all keys
    are told apart by their place in the input, and so are spread as well. ``rows`` should come
    from files: then their places are the same when a lost task runs again.
    """
    placed = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*keys, "_tie"]
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return stage(ordered.withColumn("_id", F.monotonically_increasing_id()), name)


def part() -> Column:
    """The sorted part a row of :func:`in_order` is in, as it is written in its number."""
    return F.shiftrightunsigned("_id", 33).cast("int")


def pieces(ordered: DataFrame, group: str) -> DataFrame:
    """Of each group and part: the first ``_id`` there, the group's rows ``_before`` it and in ``_all``.

    A group lies in consecutive parts, so this holds at most one row a group and one a part.
    """
    counts = ordered.groupBy(group, part().alias("_part")).agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        group, "_part", "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("_all"),
    )


def place() -> Column:
    """The place of a row in its group, from 0, once :func:`pieces` are joined on group and part."""
    return F.col("_before") + F.col("_id") - F.col("_first")
