"""Exactly-once topics: producers stamp their records, readers drop those that come again.

Writing to a topic is at least once: a micro-batch that failed half way is sent again, whole. Each
record therefore bears, as headers, the query it comes from, the micro-batch, and its position there.
A batch sent again has the same stamps, so a reader that has seen a stamp drops the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The names of the headers.
QUERY, BATCH, POSITION = "query", "batch", "position"

HEADERS = "array<struct<key:string,value:binary>>"

# How long after a record its repetition may still come.
DELAY = "1 hour"


def numbered(records: DataFrame) -> DataFrame:
    """Records with ``part``: the number of each among the records of its topic and ``id``.

    It depends on nothing but the records, so an attempt that gets them in another order gives the same
    numbers; records equal in all are interchangeable. Where a job numbers what it makes of a record
    (``split_log(numbered=True)``), this shuffle is not needed.
    """
    order = W.partitionBy("topic", "id").orderBy(*(["key"] if "key" in records.columns else []), "value")
    return records.withColumn("part", F.row_number().over(order))


def stamped(records: DataFrame, query: str, batch_id: int) -> DataFrame:
    """Records with ``headers``. ``query`` must stay the same over restarts and be used by no other query.

    The position is ``id`` and ``part``; records without ``part`` are numbered first.
    """
    if "part" not in records.columns:
        records = numbered(records)

    def header(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").cast("binary").alias("value"))

    position = F.concat_ws(".", F.col("id").cast("string"), F.col("part").cast("string"))
    stamps = (header(QUERY, F.lit(query)), header(BATCH, F.lit(batch_id)), header(POSITION, position))
    return records.withColumn("headers", F.array(*stamps).cast(HEADERS)).drop("part")


def stamp(headers: Column) -> Column:
    """The stamp in the headers as one text; null when a part of it is missing. Other headers do no harm."""

    def value(key: str) -> Column:
        found = F.filter(headers, lambda h: h["key"] == key)
        return F.get(found, F.lit(0))["value"].cast("string")

    parts = [value(name) for name in (QUERY, BATCH, POSITION)]
    # lengths in front, so that no two stamps make one text
    texts = [F.concat(F.octet_length(part), F.lit(":"), part) for part in parts]
    return F.concat(*texts)


def unrepeated(rows: DataFrame, arrival: str = "id", time: str = "timestamp", delay: str = DELAY) -> DataFrame:
    """Rows with ``headers`` without those whose stamp has come before.

    A stream forgets a stamp when the watermark of ``time`` (when the row was written) has passed it by
    ``delay``; a table looks at all its rows and keeps the first arrived. Rows without a stamp all stay.
    Only stamps are kept in state. ``arrival`` names a column that tells all rows apart.
    """
    own = F.concat(F.lit("-"), F.col(arrival).cast("string"))
    marked = rows.withColumn("_stamp", F.coalesce(stamp(F.col("headers")), own))
    if rows.isStreaming:
        return marked.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_stamp"]).drop("_stamp")
    first = W.partitionBy("_stamp").orderBy(arrival)
    return marked.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank", "_stamp")
