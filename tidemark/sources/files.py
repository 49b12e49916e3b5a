"""Topics and tables kept as parquet folders.

A micro-batch is written to folders named by its id, replacing what an earlier attempt of
the same batch wrote, so every row arrives exactly once however often a batch is tried.
Give every query its own root.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RECORD, Topic
from tidemark.sources.stamps import HEADERS, stamped, unrepeated

# A record as an appending topic keeps it.
STAMPED = f"{RECORD}, headers {HEADERS}, timestamp timestamp, arrival string"

Sink = Callable[[DataFrame, int], None]


def topic_sink(root: str) -> Sink:
    """Records ``(topic, id, value)`` into one folder per topic and batch."""

    def write(records: DataFrame, batch_id: int) -> None:
        topic = F.coalesce("topic", F.lit(Topic.FALLBACK))
        rows = records.withColumns({"topic": topic, "batch_id": F.lit(batch_id)})
        replace = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replace.partitionBy("topic", "batch_id").parquet(root)

    return write


def appending_topic_sink(root: str, query: str | None = None) -> Sink:
    """Records into folders that are only appended to, as in a log that knows no batches: at least once.

    With a ``query`` name the records are stamped for :func:`stream_once`. ``arrival`` tells all rows apart.
    """

    def append(records: DataFrame, batch_id: int) -> None:
        rows = records if query is None else stamped(records, query, batch_id)
        kept = {
            "topic": F.coalesce("topic", F.lit(Topic.FALLBACK)),
            "headers": F.col("headers") if "headers" in rows.columns else F.lit(None).cast(HEADERS),
            "timestamp": F.current_timestamp(),
            "arrival": F.uuid(),
        }
        rows = rows.withColumns(kept).select("topic", "id", "value", "headers", "timestamp", "arrival")
        rows.write.mode("append").partitionBy("topic").parquet(root)

    return append


def stream_once(
    spark: SparkSession, root: str, topic: str, delay: str, files_per_trigger: int | None = None
) -> DataFrame:
    """An appending topic as a stream of records; a stamped record that comes again within ``delay`` is dropped."""
    reader = spark.readStream.schema(STAMPED)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(f"{root}/topic={topic}")
    return unrepeated(rows, arrival="arrival", delay=delay).select("id", "value")


def table_sink(root: str) -> Sink:
    """Rows of any kind into one folder per batch."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(f"{root}/topic={topic}/*")


def stream_topic(
    spark: SparkSession, root: str, topic: str, files_per_trigger: int | None = None
) -> DataFrame:
    """A topic as a stream of records; it may still be empty."""
    reader = spark.readStream.schema(RECORD)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{root}/topic={topic}/*")


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """How many files a folder holds, at any depth, and when the newest was written: it changes with the table."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(hadoop, True)
    count = newest = 0
    while files.hasNext():
        count, newest = count + 1, max(newest, files.next().getModificationTime())
    return count, newest


def read_table(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/*")


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text files of one record per line as ``(id, value)``.

    Lines have no arrival order, so the id is a hash: it only breaks ties, always the same way.
    """
    lines = (spark.readStream if streaming else spark.read).text(path)
    return lines.select(F.xxhash64("value").alias("id"), "value")


def console_sink(prefix: str) -> Sink:
    """Print every row of each batch as JSON, on the executor that holds it."""

    def show(df: DataFrame, batch_id: int) -> None:
        lines = df.select(F.to_json(F.struct("*")).alias("line"))
        lines.foreach(lambda row: print(f"{prefix} batch {batch_id} {row.line}"))

    return show
