"""The streaming jobs run over the sample tables, as queries.

Each one replays tables as streams through the jobs and the topics between them until all
rows are used up, and gives what arrived.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.catalog import DAY_MS, SIX_HOURS_MS, Query, as_of, deeper_page, in_utc
from tidemark.operators.orders import sku_details
from tidemark.operators.pattern import MATCH, TIMEOUT
from tidemark.operators.visitors import is_entry
from tidemark.plans.jobs import order_wide_dims
from tidemark.schemas import QUARANTINE_TOPIC, RECORD, SinkType, Topic
from tidemark.sources import files, sample_tables as sample
from tidemark.sources.sample_tables import table
from tidemark.sources.staging import move, new_path, stage
from tidemark.sources.upserts import KeyedTable
from tidemark.streaming import jobs
from tidemark.streaming.session import streaming_session


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


# Parts a table of events is replayed in, and those of orders.
STEPS = 4
ORDER_STEPS = 8

Parts = Sequence[Callable[[], None] | None]


class Replay:
    """Topics and checkpoints of one replay, in a new folder each time."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.home = new_path(spark, "replay")
        self.spark = spark
        self.session = streaming_session(spark, spark.sparkContext.defaultParallelism)
        self.sf_dir = sf_dir

    def root(self, job: str) -> str:
        return f"{self.home}/{job}"

    def run(self, job: str, begin, *sources: DataFrame, parts: Parts = (None,), **options) -> None:
        """Run a job until its sources are used up.

        With ``parts``, each of which adds to the sources, it is started again from its checkpoint after each: a part is one
        micro-batch that all tasks read, however many files it has.
        """
        sink = files.topic_sink(self.root(job))
        for add in parts:
            if add:
                add()
            begin(*sources, sink=sink, checkpoint=f"{self.home}/check-{job}", **options).awaitTermination()

    def stream(self, job: str, topic: str) -> DataFrame:
        return files.stream_topic(self.session, self.root(job), topic)

    def arrived(self, job: str, topic: str) -> DataFrame:
        return files.read_topic(self.spark, self.root(job), topic)

    def logs(self, then: Callable[[], None] | None = None) -> None:
        """The log job over ``events`` in time order, in ``STEPS`` micro-batches, and
        over the closing records. ``then`` runs what reads its topics, after each of them."""
        parts, last = self.steps(sample.log_records)
        parts.append(self.part("raw", STEPS, lambda: sample.closing_records(self.spark, last)))
        for part in parts:
            self.run("logs", jobs.start_logs, self.raw(), parts=[part])
            if then:
                then()

    def part(self, source: str, step: int, rows: Callable[[], DataFrame]) -> Callable[[], None]:
        return lambda: rows().write.parquet(f"{self.root(source)}/step={step}")

    def steps(self, records) -> tuple[list[Callable[[], None]], int]:
        """``events`` as raw records in ``STEPS`` parts, in time order; and the last time."""
        events = table(self.spark, self.sf_dir, "events").withColumn("at", F.unix_millis(F.col("ts").cast("timestamp")))
        edges = events.approxQuantile("at", [i / STEPS for i in range(1, STEPS)], 0.05)
        last = events.agg(F.max("at")).first()[0] or 0
        parts = []
        for step, (low, high) in enumerate(zip([0, *edges], [*edges, last + 1])):
            # dealt anew, as a table in time order has each part in few of its blocks
            some = events.where((F.col("at") >= low) & (F.col("at") < high)).repartition(self.spark.sparkContext.defaultParallelism)
            parts.append(self.part("raw", step, lambda some=some: records(some)))
        return parts, last

    def raw(self) -> DataFrame:
        """The parts as a stream."""
        return self.session.readStream.schema(RECORD).parquet(f"{self.root('raw')}/*")

    def details(self) -> DataFrame:
        """``lineitem``, numbered as a table, as a stream of detail records."""
        lines = sample.numbered(table(self.spark, self.sf_dir, "lineitem"))
        sample.detail_records(lines).write.parquet(f"{self.root('details')}/part")
        return self.session.readStream.schema(RECORD).parquet(f"{self.root('details')}/*")

    def timed_orders(self) -> tuple[DataFrame, DataFrame, list[Callable[[], None]]]:
        """Orders and details as streams of records, and their ``ORDER_STEPS`` parts, cut at the same times.

        So the watermark moves on with the parts, and the join keeps those rows alone that it still needs.
        """
        lines = table(self.spark, self.sf_dir, "lineitem")
        sources = {"orders": (table(self.spark, self.sf_dir, "orders"), "o_orderdate"), "lines": (lines, "l_shipdate")}
        at = {name: F.unix_millis(F.col(c).cast("timestamp")) for name, (_, c) in sources.items()}
        times = [rows.select(at[name].alias("at")) for name, (rows, _) in sources.items()]
        edges = times[0].unionByName(times[1]).approxQuantile("at", [i / ORDER_STEPS for i in range(1, ORDER_STEPS)], 0.01)
        sources["lines"] = (sample.numbered(lines), "l_shipdate")
        for name, (rows, _) in sources.items():
            step = reduce(lambda part, edge: part + F.coalesce((at[name] >= edge).cast("int"), F.lit(0)), edges, F.lit(0))
            # all parts at once: cut one by one the table would be read once for each
            rows.withColumn("step", step).write.partitionBy("step").parquet(self.root(f"{name}-parts"))

        def add(step: int) -> None:
            for name in sources:
                move(self.spark, f"{self.root(f'{name}-parts')}/step={step}", f"{self.root(name)}/step={step}")

        streams = [self.session.readStream.schema(rows.schema).parquet(f"{self.root(name)}/*") for name, (rows, _) in sources.items()]
        parts = [partial(add, step) for step in range(ORDER_STEPS)]
        return sample.order_records(streams[0]), sample.detail_records(streams[1]), parts

    def visits(self) -> None:
        self.run("visits", jobs.start_unique_visits, self.stream("logs", Topic.PAGE))

    def bounces(self) -> None:
        pages = self.stream("logs", Topic.PAGE)
        self.run("bounces", jobs.start_bounces, pages, within_ms=SIX_HOURS_MS)


def stream_log_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    events = stream_table(replay.session, sf_dir, "events")
    replay.run("logs", jobs.start_logs, sample.damaged_log_records(events))
    return _split({t: replay.arrived("logs", t) for t in LOG_TOPICS})


LOG_TOPICS = (Topic.START, Topic.PAGE, Topic.DISPLAY, QUARANTINE_TOPIC)


def _split(arrived: dict[str, DataFrame]) -> DataFrame:
    """The records of the log topics, with the flag of those whose text is a whole log."""
    parts = []
    for topic, records in arrived.items():
        flag = F.get_json_object("value", "$.common.is_new") if topic in (Topic.START, Topic.PAGE) else F.lit(None).cast("string")
        parts.append(records.select(F.lit(topic).alias("topic"), "id", flag.alias("is_new")))
    return reduce(DataFrame.unionByName, parts)


def stream_dedup_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log job into topics that are only appended to, where every batch is sent twice; read exactly once."""
    replay = Replay(spark, sf_dir)
    parts, _ = replay.steps(sample.damaged_log_records)
    root = replay.root("appended")
    append = files.appending_topic_sink(root, query="logs")

    def twice(records: DataFrame, batch_id: int) -> None:
        # as after a failure between the write and its commit
        append(records, batch_id)
        append(records, batch_id)

    for add in parts:
        add()
        jobs.start_logs(replay.raw(), twice, f"{replay.home}/check-logs", numbered=True).awaitTermination()
    arrived = {}
    for topic in LOG_TOPICS:
        records = files.stream_once(replay.session, root, topic, delay="1 hour")
        sink = jobs.to_topic(files.topic_sink(replay.root("once")), topic)
        jobs.start(records, sink, f"{replay.home}/check-{topic}").awaitTermination()
        arrived[topic] = replay.arrived("once", topic)
    return _split(arrived)


def _pages(records: DataFrame) -> DataFrame:
    real = F.col("mid") != sample.CLOSING
    return jobs.parse_pages(records).where(real).select("id", "mid", "is_new", "ts")


def stream_unique_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    replay.logs()
    replay.visits()
    return _pages(replay.arrived("visits", Topic.UNIQUE_VISIT))


def stream_bounces_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    replay.logs()
    replay.bounces()
    return _pages(replay.arrived("bounces", Topic.BOUNCE))


def stream_page_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of the pattern job: entry pages with their next page, and entry pages that timed out."""
    replay = Replay(spark, sf_dir)
    pages = replay.stream("logs", Topic.PAGE)
    options = {"within_ms": SIX_HOURS_MS, "match_topic": MATCH, "timeout_topic": TIMEOUT}
    # after each part of the logs, so that the state holds the cells that are still open, not all of them
    replay.logs(then=lambda: replay.run("pattern", jobs.start_pattern, pages, is_entry(), deeper_page(), **options))
    pair = F.from_json("value", "first string, next struct<id:bigint,ts:bigint>").alias("pair")
    pairs = replay.arrived("pattern", MATCH).select("id", pair)
    matched = _pages(pairs.select("id", F.col("pair.first").alias("value"))).join(pairs.select("id", "pair.next"), "id")
    late = _pages(replay.arrived("pattern", TIMEOUT)).withColumn("next", F.lit(None).cast("struct<id:bigint,ts:bigint>"))
    rows = [part.select("id", "mid", "ts", F.lit(name).alias("outcome"), "next.*") for part, name in ((matched, MATCH), (late, TIMEOUT))]
    columns = ["id", "mid", "ts", "outcome", "next_id", "next_ts"]
    return rows[0].toDF(*columns).unionByName(rows[1].toDF(*columns))


def stream_visitor_stats_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    replay.logs()
    replay.visits()
    replay.bounces()
    sums = replay.root("stats")
    query = jobs.start_visitor_stats(
        replay.stream("logs", Topic.PAGE),
        replay.stream("visits", Topic.UNIQUE_VISIT),
        replay.stream("bounces", Topic.BOUNCE),
        sink=files.table_sink(sums),
        checkpoint=f"{replay.home}/check-stats",
        window="1 day",
    )
    query.awaitTermination()
    schema = (
        "stt string, edt string, vc string, ch string, ar string, is_new string, uv_ct bigint, "
        "pv_ct bigint, sv_ct bigint, uj_ct bigint, dur_sum bigint"
    )
    return files.read_table(spark, sums, schema).where(F.col("ar") != sample.CLOSING)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of a day, and the measures of every tenth page, which comes when all windows are closed.

    The same pages stand for all three topics.
    """
    replay = Replay(spark, sf_dir)
    held_back = F.col("event_id") % 10 == 7

    def pages(events: DataFrame) -> DataFrame:
        return sample.log_records(events.where(F.col("event_type") != "signup"))

    parts, last = replay.steps(lambda events: pages(events.where(~held_back)))
    # the watermark of a batch is that of the rows before it, and rows are late by the one before that
    for step, closing in enumerate((0, 30, None, 60), STEPS):
        closes = partial(sample.closing_records, spark, last + (closing or 0) * DAY_MS)
        late_pages = lambda: pages(table(spark, sf_dir, "events").where(held_back))
        parts.append(replay.part("raw", step, late_pages if closing is None else closes))

    def begin(raw: DataFrame, sink, checkpoint: str) -> StreamingQuery:
        return jobs.start_visitor_stats(
            raw, raw, raw,
            sink=files.table_sink(replay.root("sums")),
            checkpoint=checkpoint,
            window="1 day",
            late=sink,
        )

    replay.run("late", begin, replay.raw(), parts=parts)
    sums = files.read_table(spark, replay.root("sums"), f"stt string, {STATS}").select(F.lit("sum").alias("kind"), "stt", F.lit(None).cast("bigint").alias("ts"), *STATS_COLUMNS)
    late = replay.arrived("late", QUARANTINE_TOPIC).select(F.from_json("value", f"ts bigint, {STATS}").alias("row"))
    late = late.select(F.lit("late").alias("kind"), F.lit(None).cast("string").alias("stt"), "row.ts", *[f"row.{c}" for c in STATS_COLUMNS])
    return sums.unionByName(late).where(F.col("ar") != sample.CLOSING)


STATS_COLUMNS = ("vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")
STATS = ", ".join(f"{c} {'bigint' if c.endswith(('_ct', '_sum')) else 'string'}" for c in STATS_COLUMNS)


def stream_order_wide_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    order_records, detail_records, parts = replay.timed_orders()
    replay.run(
        "wide",
        jobs.start_order_wide,
        order_records,
        detail_records,
        parts=parts,
        users=sample.users(table(spark, sf_dir, "customer")),
        as_of=as_of(),
        lower_ms=-5 * DAY_MS,
        upper_ms=5 * DAY_MS,
    )
    schema = (
        "order_id bigint, sku_id bigint, total_amount decimal(18,2), user_id bigint, "
        "user_age int, user_gender string"
    )
    arrived = replay.arrived("wide", Topic.ORDER_WIDE)
    return arrived.select(F.from_json("value", schema).alias("row")).select("row.*")


def stream_order_wide_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    part, nation = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    tables = (
        sample.provinces(nation),
        sample.skus(part),
        sample.spus(part),
        sample.trademarks(table(spark, sf_dir, "supplier")),
        sample.categories3(nation),
    )
    # the tables stay as they are, so the skus get their names once and not in each micro-batch
    details = stage(sku_details(*tables[1:], unique=True), "sku-details")
    order_records, detail_records, parts = replay.timed_orders()
    replay.run(
        "wide",
        jobs.start_order_wide,
        order_records,
        detail_records,
        parts=parts,
        users=sample.users(table(spark, sf_dir, "customer")),
        as_of=as_of(),
        lower_ms=-5 * DAY_MS,
        upper_ms=5 * DAY_MS,
        more=lambda wide: order_wide_dims(wide, *tables, unique=True, details=details),
    )
    names = ("province_name", "spu_name", "tm_name", "category3_name")
    schema = "detail_id bigint, order_id bigint, user_age int, " + ", ".join(f"{n} string" for n in names)
    arrived = replay.arrived("wide", Topic.ORDER_WIDE)
    return arrived.select(F.from_json("value", schema).alias("row")).select("row.*")


def stream_order_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    order_records = sample.order_records(stream_table(replay.session, sf_dir, "orders"))
    parts = []
    for kind, records in (("order", order_records), ("detail", replay.details())):
        replay.run(kind, jobs.start_quarantine, sample.damaged_records(records), kind=kind)
        arrived = replay.arrived(kind, QUARANTINE_TOPIC)
        parts.append(arrived.select(F.lit(kind).alias("kind"), "id"))
    return parts[0].unionByName(parts[1])


def stream_table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a typed table read from a topic of texts, some of them damaged; and the records that are no rows."""
    replay = Replay(spark, sf_dir)
    records = sample.damaged_records(sample.order_records(stream_table(replay.session, sf_dir, "orders")))
    turn = F.col("id") % 7
    worded = F.regexp_replace("value", '"total_amount":[0-9.]+', '"total_amount":"much"')
    behind = F.concat(F.col("value"), F.lit(" []"))
    value = F.when(turn == 4, worded).when(turn == 5, behind).otherwise(F.col("value"))
    schema = "id bigint, user_id bigint, total_amount decimal(18,2), order_status string"
    query = jobs.start_table(
        records.withColumn("value", value), schema,
        sink=files.table_sink(replay.root("rows")),
        bad=files.topic_sink(replay.root("bad")),
        checkpoint=f"{replay.home}/check",
    )
    query.awaitTermination()
    arrived = files.read_table(spark, replay.root("rows"), schema).withColumn("record", F.lit(None).cast("bigint"))
    bad = replay.arrived("bad", QUARANTINE_TOPIC).select(F.col("id").alias("record"))
    return arrived.unionByName(bad, allowMissingColumns=True)


def stream_cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    raw = sample.order_changes(stream_table(replay.session, sf_dir, "orders")).unionByName(
        sample.user_changes(stream_table(replay.session, sf_dir, "customer"))
    )
    replay.run("changes", _start_changes(replay), sample.damaged_changes(raw), rules=sample.routing_rules(spark))
    return replay.arrived("changes", QUARANTINE_TOPIC).select("id")


def stream_cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = Replay(spark, sf_dir)
    raw = sample.order_changes(stream_table(replay.session, sf_dir, "orders")).unionByName(
        sample.user_changes(stream_table(replay.session, sf_dir, "customer"))
    )
    replay.run("changes", _start_changes(replay), raw, rules=sample.routing_rules(spark))
    facts = [("changes", "dwd_order_info"), ("changes", "dwd_order_info_update")]
    parts = [
        replay.arrived(job, topic).select(F.lit(topic).alias("sink_table"), "id")
        for job, topic in [*facts, ("tables", "dim_user_info")]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# The rows of a dimension table: the topic of the table, the key, and the newest change of it.
DIM_ROWS = "topic string, key string, id bigint, value string"


def stream_dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User changes, in several micro-batches, into a table that holds the newest row of each user."""
    replay = Replay(spark, sf_dir)
    raw = sample.user_changes(table(spark, sf_dir, "customer")).unionByName(
        sample.later_user_changes(table(spark, sf_dir, "orders"))
    )
    # dealt without regard to order, so that older changes come after newer ones
    step = F.pmod(F.xxhash64("id"), F.lit(STEPS))
    parts = [replay.part("raw", k, partial(raw.where, step == k)) for k in range(STEPS)]
    dimension = KeyedTable(replay.root("dimension"), DIM_ROWS, ["topic", "key"], ["id"])

    def begin(raw: DataFrame, sink, checkpoint: str) -> StreamingQuery:
        rules = sample.routing_rules(spark)
        return jobs.start_changes(raw, rules, sink, checkpoint, table_sinks={SinkType.HBASE: dimension.sink()})

    replay.run("changes", begin, replay.raw(), parts=parts)
    gender = F.get_json_object("value", "$.gender").alias("gender")
    return dimension.read(spark).select(F.col("key").alias("user_id"), F.col("id").alias("change_id"), gender)


def _start_changes(replay: Replay):
    def begin(raw: DataFrame, sink, checkpoint: str, rules: DataFrame):
        tables = {SinkType.HBASE: files.topic_sink(replay.root("tables"))}
        return jobs.start_changes(raw, rules, sink, checkpoint, table_sinks=tables)

    return begin


STREAM_QUERIES: dict[str, Query] = {
    query.__name__: in_utc(query)
    for query in (
        stream_log_split,
        stream_dedup_on_read,
        stream_unique_visits,
        stream_bounces_6h,
        stream_page_pattern,
        stream_visitor_stats_1d,
        stream_late_rows,
        stream_order_wide_user,
        stream_order_wide_dims,
        stream_order_quarantine,
        stream_cdc_route,
        stream_table_source,
        stream_dim_upsert,
        stream_cdc_quarantine,
    )
}
