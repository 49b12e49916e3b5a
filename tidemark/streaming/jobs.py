"""The warehouse's jobs over streams.

Every job is a query of its own with its own checkpoint; topics join them. A sink is a
function of a micro-batch and its id, see :mod:`tidemark.sources`. Queries with state run without
adaptive execution, so lookups in a micro-batch salt its hot keys themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators import bounce, cdc, logs, orders, pattern, stats, typed
from tidemark.operators.dims import Dimension
from tidemark.operators.skew import ROWS_PER_TASK, hot_keys
from tidemark.operators.visitors import NEW, apply_first_days
from tidemark.plans import jobs
from tidemark.schemas import SinkType, Topic
from tidemark.streaming.late import beside, in_time, late_records, late_watermark
from tidemark.streaming.open_rows import OpenRows
from tidemark.streaming.visits import TTL_MS, opened, with_openings

Sink = Callable[[DataFrame, int], None]

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start(
    rows: DataFrame, sink: Sink, checkpoint: str, mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Run a stream into a sink; ``trigger`` defaults to all that is there, then stop."""
    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(sink).trigger(**(trigger or {"availableNow": True})).start()


def to_topic(sink: Sink, topic: str) -> Sink:
    """A sink for records ``(id, value)`` that all go to one topic."""

    def send(records: DataFrame, batch_id: int) -> None:
        sink(records.select(F.lit(topic).alias("topic"), "id", "value"), batch_id)

    return send


# Log job: raw logs to start, page, display and quarantine topics


def with_first_days(raw: DataFrame) -> DataFrame:
    """Raw log records, and the first flagged day of every device flagged among them.

    The first day is that of the earliest flagged log of the first micro-batch in which the
    device was flagged. It is an aggregate in update mode, so each micro-batch brings the
    devices it touches, combined before the shuffle and kept in the state store, while the
    logs themselves pass by it.
    """
    flags = logs.parse_flags(raw).withColumn("arrived", F.current_timestamp())
    flagged = flags.filter(
        (F.col("is_new") == NEW) & F.col("mid").isNotNull() & F.col("day").isNotNull()
    )
    first = flagged.groupBy("mid").agg(F.min(F.struct("arrived", "day")).alias("first"))
    nothing = F.lit(None)
    return raw.select(
        F.lit(True).alias("is_log"),
        "id",
        "value",
        nothing.cast("string").alias("mid"),
        nothing.cast("date").alias("first_day"),
    ).unionByName(
        first.select(
            F.lit(False).alias("is_log"),
            nothing.cast("bigint").alias("id"),
            nothing.cast("string").alias("value"),
            "mid",
            F.col("first.day").alias("first_day"),
        )
    )


def start_logs(raw: DataFrame, sink: Sink, checkpoint: str, numbered: bool = False, **options) -> StreamingQuery:
    """Repair the new-visitor flag and split the logs; one write fans out to all topics.

    ``numbered`` is for sinks that stamp the records: they come with their ``part`` and need no shuffle for it.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        days = rows.filter(~F.col("is_log")).select("mid", "first_day").persist()
        try:
            days.count()  # makes the size of the cached days known to the join
            records = rows.filter("is_log").select("id", "value")
            flagged = logs.parse_flags(records).filter(F.col("is_new") == NEW)
            hot = hot_keys(flagged.select("mid"), ["mid"])
            repaired = apply_first_days(logs.parse_log(records), days, hot)
            sink(logs.split_log(repaired, numbered), batch_id)
        finally:
            days.unpersist()
            rows.unpersist()

    return start(with_first_days(raw), batch, checkpoint, "update", **options)


# Visitor jobs


def parse_pages(records: DataFrame) -> DataFrame:
    """Page topic records as typed page views."""
    return logs.page_logs(logs.parse_log(records))


def start_unique_visits(
    page_records: DataFrame, sink: Sink, checkpoint: str, ttl_ms: int = TTL_MS, **options
) -> StreamingQuery:
    """Page records that open a day of their device, as they came.

    The state decides by ids alone (:func:`tidemark.streaming.visits.opening_ids`), and the records are looked up by
    them within the micro-batch. A query with timeouts always asks for another batch, so with the trigger that ends when
    all is read it would never end. Batches without data are switched off for it; a device
    that is due is then forgotten with the next data, or when it is next seen."""
    rows = with_openings(page_records.select("id", "value"), parse_pages(page_records), ttl_ms)
    send = to_topic(sink, Topic.UNIQUE_VISIT)

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        openings = rows.filter("opens").select("id").persist()
        try:
            openings.count()  # makes their size known to the join
            send(opened(rows, openings), batch_id)
        finally:
            openings.unpersist()
            rows.unpersist()

    conf = page_records.sparkSession.conf
    before = conf.get(NO_DATA_BATCHES)
    conf.set(NO_DATA_BATCHES, "false")
    try:
        return start(rows, batch, checkpoint, **options)
    finally:
        conf.set(NO_DATA_BATCHES, before)


def bounce_records(
    page_records: DataFrame,
    within_ms: int = bounce.WITHIN_MS,
    watermark_ms: int = bounce.WATERMARK_MS,
) -> DataFrame:
    pages = parse_pages(page_records)
    return bounce.bounces(
        pages, within_ms, watermark_ms=watermark_ms, columns=["id", "value"]
    )


def start_bounces(
    page_records: DataFrame,
    sink: Sink,
    checkpoint: str,
    within_ms: int = bounce.WITHIN_MS,
    watermark_ms: int = bounce.WATERMARK_MS,
    **options,
) -> StreamingQuery:
    jumps = bounce_records(page_records, within_ms, watermark_ms)
    return start(jumps, to_topic(sink, Topic.BOUNCE), checkpoint, **options)


def start_pattern(
    page_records: DataFrame,
    first: Column,
    then: Column,
    within_ms: int,
    sink: Sink,
    checkpoint: str,
    match_topic: str,
    timeout_topic: str,
    watermark_ms: int = bounce.WATERMARK_MS,
    **options,
) -> StreamingQuery:
    """Page views by a two-step pattern: matches to one topic, timeouts to another.

    A timeout is the text of its page log; a match is ``{"first": text, "next": {"id", "ts"}}``.
    """
    pages = parse_pages(page_records)
    columns = ["id", "value"]
    found = pattern.two_step(pages, first, then, within_ms, columns=columns, watermark_ms=watermark_ms)
    matched = F.col("outcome") == pattern.MATCH
    pair = F.to_json(F.struct(F.col("value").alias("first"), "next"))
    records = found.select(
        F.when(matched, match_topic).otherwise(timeout_topic).alias("topic"),
        "id",
        F.when(matched, pair).otherwise(F.col("value")).alias("value"),
    )
    return start(records, sink, checkpoint, **options)


def visitor_measures(
    page_records: DataFrame, visit_records: DataFrame, bounce_records: DataFrame, watermark: str = stats.WATERMARK
) -> DataFrame:
    """The measures of the three topics, each with a watermark of its own."""
    parts = (
        stats.page_measures(parse_pages(page_records)),
        stats.unique_visit_measures(parse_pages(visit_records)),
        stats.bounce_measures(parse_pages(bounce_records)),
    )
    return stats.union_measures(*(stats.with_watermark(part, watermark) for part in parts))


def start_visitor_stats(
    page_records: DataFrame,
    visit_records: DataFrame,
    bounce_records: DataFrame,
    sink: Sink,
    checkpoint: str,
    window: str = stats.WINDOW,
    watermark: str = stats.WATERMARK,
    late: Sink | None = None,
    **options,
) -> StreamingQuery:
    """Windowed visitor statistics.

    ``late`` gets, as quarantine records, the measures that came behind the watermark and are in no sum; the
    topics are read twice for it. Without it such rows are dropped unseen.
    """
    measures = visitor_measures(page_records, visit_records, bounce_records, watermark)
    sums = stats.visitor_stats(measures, window, watermark)
    if late is None:
        return start(sums, sink, checkpoint, **options)

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()  # a second look would run the windows again
        try:
            sink(in_time(rows), batch_id)
            late(late_records(rows, late_watermark(rows.sparkSession, checkpoint, batch_id)), batch_id)
        finally:
            rows.unpersist()

    return start(beside(sums, measures, window), batch, checkpoint, **options)


# Order job


def start_order_wide(
    order_records: DataFrame,
    detail_records: DataFrame,
    users: DataFrame | Dimension,
    sink: Sink,
    checkpoint: str,
    as_of: Column | None = None,
    lower_ms: int = orders.LOWER_MS,
    upper_ms: int = orders.UPPER_MS,
    watermark: str = orders.WATERMARK,
    more: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> StreamingQuery:
    """Join order and detail topics and add the user dimension, as fresh as it asks to be.

    ``more`` adds further dimensions to the wide rows of a micro-batch, such as
    ``plans.jobs.order_wide_dims``. Records that cannot be read or have no time are left out here; run
    :func:`start_quarantine` over the same topics to keep them.
    """
    left, right = orders.timed_sides(orders.parse_orders(order_records), orders.parse_details(detail_records), watermark)
    both = left.withColumn("left", F.lit(True)).unionByName(right.withColumn("left", F.lit(False)), allowMissingColumns=True)
    open_rows = OpenRows(f"{checkpoint.rstrip('/')}/open-rows", ("o_create_ts", "d_create_ts"), lower_ms, upper_ms)

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark, late_ms = rows.sparkSession, late_watermark(rows.sparkSession, checkpoint, batch_id)
        sides = open_rows.meet(rows, batch_id, late_ms)
        own = [side.select(*[c for c in side.columns if c.startswith(p)], F.col("_fresh").alias(f"{p}fresh")) for side, p in zip(sides, ("o_", "d_"))]
        pairs = orders.joined_sides(*own, lower_ms, upper_ms).where("o_fresh or d_fresh")
        wide = orders.order_wide(pairs).persist()  # a large dimension makes the join count the rows first
        try:
            filled = orders.with_user(wide, users, as_of, rows_per_task=ROWS_PER_TASK)
            filled = more(filled) if more else filled
            to_topic(sink, Topic.ORDER_WIDE)(orders.order_wide_values(filled), batch_id)
        finally:
            wide.unpersist()
        open_rows.vacuum(spark, rows.schema, batch_id, late_ms)

    return start(both, batch, checkpoint, **options)


def start_quarantine(
    records: DataFrame, kind: str, sink: Sink, checkpoint: str, **options
) -> StreamingQuery:
    """Send the order or detail records that the order job leaves out to the quarantine topic."""
    return start(orders.unusable(records, kind), sink, checkpoint, **options)


def start_table(
    records: DataFrame, schema: str, sink: Sink, bad: Sink, checkpoint: str, **options
) -> StreamingQuery:
    """A JSON topic as a typed table: rows to ``sink``, records that are no such rows to the quarantine of ``bad``."""

    def batch(parsed: DataFrame, batch_id: int) -> None:
        parsed = parsed.persist()
        try:
            sink(typed.rows(parsed), batch_id)
            bad(typed.unreadable(parsed), batch_id)
        finally:
            parsed.unpersist()

    return start(typed.typed(records, schema), batch, checkpoint, **options)


# Change record job


def start_changes(
    raw: DataFrame,
    rules: DataFrame | Dimension,
    fact_sink: Sink,
    checkpoint: str,
    table_sinks: dict[str, Sink] | None = None,
    **options,
) -> StreamingQuery:
    """Clean change records and route them: facts to topics, others to the sink of their kind.

    ``table_sinks`` maps a sink kind of the rules to a sink for ``(topic, id, key, value)``.
    Rules naming a kind without a sink stop the query rather than lose changes. Texts that are no
    change records go to the quarantine topic of ``fact_sink``. A micro-batch is read and parsed once.
    """
    if not isinstance(rules, Dimension):
        # cached and counted: only then is their size known, and they are sent to the changes
        rules = rules.persist()
        rules.count()
    sinks = {SinkType.KAFKA: fact_sink, **(table_sinks or {})}

    def batch(changes: DataFrame, batch_id: int) -> None:
        table = rules.frame() if isinstance(rules, Dimension) else rules
        kinds = {row[0] for row in table.select("sink_type").distinct().collect()}
        if kinds - sinks.keys():
            raise ValueError(f"no sink for {sorted(kinds - sinks.keys())}")
        changes = changes.persist()
        try:
            routed = cdc.route_cdc(cdc.clean_cdc(changes), table, rows_per_task=ROWS_PER_TASK)
            for kind, sink in sinks.items():
                records = jobs.change_records(routed, kind)
                if kind == SinkType.KAFKA:
                    bad = cdc.quarantined_cdc(changes).withColumn("key", F.lit(None).cast("string"))
                    records = records.unionByName(bad)
                sink(records, batch_id)
        finally:
            changes.unpersist()

    return start(cdc.parse_cdc(raw), batch, checkpoint, **options)
