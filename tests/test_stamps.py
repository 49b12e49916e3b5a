from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import files, kafka, stamps
from tidemark.streaming import jobs
from tidemark.streaming.session import streaming_session

RECORDS = [("t", 1, "a"), ("t", 1, "b"), ("t", 1, "b"), ("t", 2, "a"), ("u", 1, "a"), ("t", None, None), (None, 3, "x")]
SCHEMA = "topic string, id bigint, value string"


@pytest.fixture
def home():
    return tempfile.mkdtemp(prefix="run-stamps-")


def read_once(spark, home, topic, query):
    """What a reader gets of batches 0 and 1, the second of which was sent twice in another order."""
    root, out = f"{home}/topics", f"{home}/out"
    sink = files.appending_topic_sink(root, query)
    records = spark.createDataFrame(RECORDS, SCHEMA)
    sink(records, 0)
    sink(records.repartition(3, "value"), 1)
    session = streaming_session(spark, 2)

    def read():
        rows = files.stream_once(session, root, topic, "1 hour", files_per_trigger=2)
        jobs.start(rows, jobs.to_topic(files.topic_sink(out), topic), f"{home}/check").awaitTermination()
        return sorted(tuple(r) for r in files.read_topic(spark, out, topic).fillna({"id": -1, "value": ""}).collect())

    first = read()
    sink(records.orderBy(F.desc("value")), 1)  # the retry arrives after the reader was restarted
    again = read()
    assert (again == first) == (query is not None)
    return again


def test_a_batch_sent_twice_is_read_once(spark, home):
    batch = sorted((-1 if i is None else i, v or "") for t, i, v in RECORDS if t == "t")
    assert read_once(spark, home, "t", "job") == sorted(batch * 2)


def test_without_stamps_it_is_read_twice(spark, home):
    batch = sorted((-1 if i is None else i, v or "") for t, i, v in RECORDS if t == "t")
    assert read_once(spark, home, "t", None) == sorted(batch * 3)


def test_stamps_do_not_depend_on_the_order_of_rows(spark):
    records = spark.createDataFrame(RECORDS, SCHEMA)
    seen = []
    for rows in (records, records.repartition(5), records.orderBy(F.desc("value"))):
        marked = stamps.stamped(rows, "job", 7).select("topic", "value", stamps.stamp(F.col("headers")).alias("stamp"))
        seen.append(sorted(map(tuple, marked.collect()), key=repr))
    assert seen[0] == seen[1] == seen[2]
    assert len({r for r in seen[0] if r[0] == "t"}) == 5  # those equal in all are told apart by number


def test_stamps_of_other_queries_and_batches_differ(spark):
    records = spark.createDataFrame([("t", 1, "a")], SCHEMA)
    made = [("a", 1), ("a", 2), ("b", 1), ("a1", 1), ("a", 11)]
    found = {stamps.stamped(records, q, b).select(stamps.stamp(F.col("headers"))).first()[0] for q, b in made}
    assert len(found) == len(made)


def test_rows_without_a_whole_stamp_stay(spark):
    rows = spark.sql(
        "select id, array(named_struct('key', 'query', 'value', cast('q' as binary))) as headers, current_timestamp() as timestamp from range(3)"
        " union all select 9, null, current_timestamp() union all select 10, null, current_timestamp()"
    )
    assert stamps.unrepeated(rows).count() == 5


def test_kafka_rows(spark):
    """The layout of rows to and from a broker, without one."""
    records = spark.createDataFrame(RECORDS[:4], SCHEMA)
    sent = kafka.outgoing(stamps.stamped(records, "job", 3))
    assert dict(sent.dtypes) == {"topic": "string", "key": "string", "value": "string", "headers": stamps.HEADERS}
    assert "headers" not in kafka.outgoing(records).columns
    arrived = sent.unionByName(sent).select(
        F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.col("value").cast("binary").alias("value"),
        "headers", F.current_timestamp().alias("timestamp"),
    )
    assert sorted(r.value for r in kafka.once(arrived, "1 hour").collect()) == ["a", "a", "b", "b"]
    assert kafka.with_headers(kafka.source_options("s", "t", "g"))["includeHeaders"] == "true"


def test_numbers_of_the_log_split_equal_themselves(spark):
    """Records that come numbered keep their numbers as position."""
    numbered = spark.createDataFrame([("t", 1, "x", 4)], f"{SCHEMA}, part int")
    assert stamps.stamped(numbered, "j", 0).select(stamps.stamp(F.col("headers"))).first()[0].endswith("3:1.4")
