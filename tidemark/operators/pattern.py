"""Two-step patterns: an event, and what the very next event of its key is and when.

A pattern is a condition on the first event, one on the next event, and a time bound. Contiguity is
strict: only the next event counts, ordered by ``(ts, id)``. A first event whose next one comes within
the bound and meets its condition is a match; one with no next event in time is a timeout; one whose
next event comes in time and does not meet the condition is neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import event_time

MATCH = "match"
TIMEOUT = "timeout"


def two_step(
    events: DataFrame,
    first: Column,
    then: Column,
    within_ms: int,
    key: str = "mid",
    columns: list[str] | None = None,
    then_columns: list[str] | None = None,
    watermark_ms: int = 0,
) -> DataFrame:
    """``columns`` of the first events that match or time out, ``outcome``, and the next event as ``next``.

    ``events`` have ``id`` and ``ts`` in milliseconds; works on tables and on streams. ``next`` is a struct of
    ``then_columns``, null for timeouts. Conditions that are null do not hold. Events without key or time are left out.

    Time is cut into cells of the bound, so what decides a first event lies in its own cell or the next
    one. Every event is put into its own cell and, as one that may follow, into the cell before, and is then
    compared with its neighbour in the cell. A hot key is spread over its cells: no task sees its whole history.
    On a table the rows of a cell are sorted and read in turn, never held at once. On a stream a cell is kept
    until the watermark has passed the cell after it.
    """
    given = events.columns if columns is None else columns
    told = ["id", "ts"] if then_columns is None else then_columns
    ts = F.col("ts")
    holds, follows = (F.coalesce(condition, F.lit(False)) for condition in (first, then))
    then_row = F.when(follows, F.struct(*told))
    own = F.struct(
        ts.alias("cell_ts"), ts.alias("at"), F.col("id").alias("of"), F.lit(True).alias("own"),
        F.when(holds, F.struct(*given)).alias("first"), then_row.alias("then"),
    )
    follower = F.struct(
        (ts - within_ms).alias("cell_ts"), ts.alias("at"), F.col("id").alias("of"), F.lit(False).alias("own"),
        F.lit(None).alias("first"), then_row.alias("then"),
    )
    keyed = events.filter(F.col(key).isNotNull() & ts.isNotNull())
    placed = keyed.select(F.col(key).alias("key"), F.inline(F.array(own, follower)))
    if events.isStreaming:
        return _on_stream(placed, within_ms, watermark_ms)
    cell = F.col("cell_ts") - F.pmod(F.col("cell_ts"), F.lit(within_ms))
    order = W.partitionBy("cell", "key").orderBy("at", "of", F.desc("own"))
    pairs = placed.withColumn("cell", cell)
    after = F.struct("at", "then", F.lit(True).alias("there"))
    pairs = pairs.withColumn("after", F.lead(after).over(order)).filter("own and first is not null")
    return _decided(pairs, within_ms)


def _on_stream(placed: DataFrame, within_ms: int, watermark_ms: int) -> DataFrame:
    timed = placed.withColumn("et", event_time(F.col("cell_ts")))
    timed = timed.withWatermark("et", f"{watermark_ms + within_ms} milliseconds")
    row = F.struct("at", "of", (~F.col("own")).alias("later"), "first", "then")
    cells = timed.groupBy(F.window("et", f"{within_ms} milliseconds").alias("cell"), "key")
    rows = cells.agg(F.sort_array(F.collect_list(row)).alias("rows"))
    neighbours = F.arrays_zip(F.col("rows").alias("a"), F.slice("rows", 2, F.size("rows")).alias("b"))
    pairs = rows.select("key", F.inline(neighbours)).filter("not a.later and a.first is not null")
    after = F.when(F.col("b").isNotNull(), F.struct("b.at", "b.then", F.lit(True).alias("there")))
    return _decided(pairs.select("a.at", "a.first", after.alias("after")), within_ms)


def _decided(pairs: DataFrame, within_ms: int) -> DataFrame:
    in_time = F.coalesce(F.col("after.at") - F.col("at") < within_ms, F.lit(False))
    outcome = F.when(~in_time, F.lit(TIMEOUT)).when(F.col("after.then").isNotNull(), F.lit(MATCH))
    following = F.when(in_time, F.col("after.then"))
    found = pairs.select("first", outcome.alias("outcome"), following.alias("next"))
    return found.filter(F.col("outcome").isNotNull()).select("first.*", "outcome", "next")


def matches(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == MATCH)


def timeouts(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == TIMEOUT)
