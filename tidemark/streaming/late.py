"""Rows that come behind the watermark: Spark drops them from windows unseen, here they are kept.

The measures of a micro-batch run beside the sums in one query, and those whose window was closed are
told apart by the same watermark that Spark goes by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import QUARANTINE_TOPIC


def late_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark, in milliseconds, behind which the rows of a micro-batch are late; 0 without any.

    It is the one of the batch before, as the query's checkpoint reports it, and so the same in another try.
    """
    if batch_id == 0:
        return 0
    lines = spark.read.text(f"{checkpoint}/offsets/{batch_id - 1}")
    mark = F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")
    return lines.select(F.max(mark)).first()[0] or 0


def beside(sums: DataFrame, measures: DataFrame, window: str) -> DataFrame:
    """Windowed sums of a stream, and the measures (with ``et``) they come from as texts.

    Rows of sums have no ``value``, rows of measures no ``sums``; ``closes`` is when a measure's window ends.
    """
    columns = [c for c in measures.columns if c != "et"]
    closes = F.unix_millis(F.window("et", window)["end"])
    texts = measures.select(
        F.lit(None).cast(sums.select(F.struct("*")).schema[0].dataType).alias("sums"),
        F.to_json(F.struct(*columns)).alias("value"),
        closes.alias("closes"),
    )
    nothing = F.lit(None)
    own = sums.select(F.struct("*").alias("sums"), nothing.cast("string").alias("value"), nothing.cast("bigint").alias("closes"))
    return own.unionByName(texts)


def late_records(rows: DataFrame, watermark_ms: int) -> DataFrame:
    """The measures of a micro-batch of :func:`beside` that are in no sum, as quarantine records."""
    late = rows.filter(F.col("closes") <= watermark_ms)
    return late.select(F.lit(QUARANTINE_TOPIC).alias("topic"), F.lit(None).cast("bigint").alias("id"), "value")


def in_time(rows: DataFrame) -> DataFrame:
    """The sums of a micro-batch of :func:`beside`."""
    return rows.filter(F.col("sums").isNotNull()).select("sums.*")
