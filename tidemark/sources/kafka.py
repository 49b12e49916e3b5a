"""Kafka topics as sources and sinks.

Reading keeps the offsets in the query's checkpoint; a new query starts at the newest
offsets. Writing is at least once; with stamps on the records (a query name for the sink) and readers
that drop repetitions (``deduplicate``) a topic is read exactly once. Needs the Spark Kafka package on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.typed import rows, typed
from tidemark.schemas import Topic
from tidemark.sources.stamps import HEADERS, stamped, unrepeated

# Fixed value: how long a broker waits for a transaction, in milliseconds.
TRANSACTION_TIMEOUT_MS = 15 * 60 * 1000


def source_options(
    servers: str, topic: str, group_id: str, starting: str = "latest", max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options. ``max_offsets`` bounds a micro-batch, and with it any task's share of it."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group_id,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def with_headers(options: dict[str, str]) -> dict[str, str]:
    """The same reader options, and the headers of the records."""
    return {**options, "includeHeaders": "true"}


def sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options; without a topic each row goes where its ``topic`` column says."""
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.transaction.timeout.ms": str(TRANSACTION_TIMEOUT_MS),
    }
    if topic is not None:
        options["topic"] = topic
    return options


def arrival_id(df: DataFrame, *more: str) -> DataFrame:
    """Kafka rows as records ``(id, value)`` and ``more`` columns; ``id`` orders a partition by offset."""
    position = F.shiftleft(F.col("partition").cast("bigint"), 44).bitwiseOR(F.col("offset"))
    return df.select(position.alias("id"), F.col("value").cast("string").alias("value"), *more)


def read_topic(
    spark: SparkSession, servers: str, topic: str, group_id: str, deduplicate: str | None = None, **options
) -> DataFrame:
    """A topic as a stream of records ``(id, value)``.

    ``deduplicate`` is how long after a record its repetition may come (``"1 hour"``); records that come
    again within that time are dropped by their stamps.
    """
    settings = source_options(servers, topic, group_id, **options)
    if deduplicate is None:
        return arrival_id(spark.readStream.format("kafka").options(**settings).load())
    return once(spark.readStream.format("kafka").options(**with_headers(settings)).load(), deduplicate)


def once(arrived: DataFrame, delay: str) -> DataFrame:
    """Kafka rows with headers as records ``(id, value)``, each stamp once."""
    records = arrival_id(arrived, "headers", "timestamp")
    return unrepeated(records, delay=delay).select("id", "value")


def read_table(
    spark: SparkSession, servers: str, topic: str, group_id: str, schema: str, **options
) -> DataFrame:
    """A topic of JSON texts as a stream of typed rows, from the newest offset on.

    Records that cannot be read as ``schema`` are left out; ``streaming.jobs.start_table`` keeps them.
    """
    return rows(typed(read_topic(spark, servers, topic, group_id, **options), schema))


def outgoing(records: DataFrame) -> DataFrame:
    """Records as Kafka rows ``(topic, key, value)``, with their headers if they have some.

    Rows without a topic get the fallback.
    """
    key = F.col("key") if "key" in records.columns else F.lit(None)
    return records.select(
        F.coalesce("topic", F.lit(Topic.FALLBACK)).alias("topic"),
        key.cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *([F.col("headers").cast(HEADERS).alias("headers")] if "headers" in records.columns else []),
    )


def topic_sink(servers: str, query: str | None = None) -> Callable[[DataFrame, int], None]:
    """A micro-batch sink sending each record to the topic it names.

    With a ``query`` name the records are stamped, so that readers can drop what a retried batch sends again.
    """

    def send(records: DataFrame, batch_id: int) -> None:
        sent = records if query is None else stamped(records, query, batch_id)
        outgoing(sent).write.format("kafka").options(**sink_options(servers)).save()

    return send
