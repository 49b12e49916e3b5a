from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import RECORD, VISITOR_STATS_COLUMNS
from tidemark.sources import files, jdbc, kafka, staging


def test_kafka_options():
    options = kafka.source_options("a:1,b:2", "topic", "group", max_offsets=10)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "topic",
        "kafka.group.id": "group",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
    assert kafka.sink_options("a:1", "t")["topic"] == "t"
    assert "topic" not in kafka.sink_options("a:1")
    assert kafka.sink_options("a:1")["kafka.transaction.timeout.ms"] == "900000"


def test_kafka_rows_become_ordered_records(rows):
    data = [(0, 5, b"x"), (0, 6, b"y"), (1, 0, b"z")]
    df = kafka.arrival_id(rows(data, "partition int, offset bigint, value binary"))
    got = rows(df)
    assert [v for _, v in sorted(got)] == ["x", "y", "z"]
    assert len({i for i, _ in got}) == 3


def test_outgoing_records_name_their_topic(rows):
    df = rows([("t", "k", "v"), (None, None, "w")], "topic string, key string, value string")
    assert rows(kafka.outgoing(df)) == sorted([("t", "k", "v"), ("DEFAULT_DATA", None, "w")], key=repr)
    plain = rows([("t", 1, "v")], "topic string, id bigint, value string")
    assert rows(kafka.outgoing(plain)) == [("t", None, "v")]


def test_jdbc_options():
    scan = jdbc.scan_options("jdbc:x", "d", query="select 1")
    assert scan == {"url": "jdbc:x", "driver": "d", "query": "select 1"}
    parts = jdbc.scan_options("jdbc:x", "d", query="select 1", split=("id", 0, 100, 8))
    assert parts["dbtable"] == "(select 1) scan"
    assert (parts["partitionColumn"], parts["upperBound"], parts["numPartitions"]) == ("id", "100", "8")
    with pytest.raises(ValueError, match="either"):
        jdbc.scan_options("jdbc:x", "d")
    insert = jdbc.insert_options("jdbc:x", "d", "stats", batch_size=5, user="default")
    assert insert == {"url": "jdbc:x", "driver": "d", "dbtable": "stats", "batchsize": "5", "user": "default"}


def test_insert_leaves_excluded_columns_out(rows):
    df = rows([(1, 2, 3)], "a int, b int, c int")
    assert jdbc.insert_columns(df, ["b"]).columns == ["a", "c"]
    assert jdbc.insert_columns(df).columns == ["a", "b", "c"]
    assert len(VISITOR_STATS_COLUMNS) == 12


def test_a_retried_batch_replaces_itself(spark, rows):
    root = tempfile.mkdtemp(prefix="run-sink-")
    sink = files.topic_sink(root)
    batch = rows([("a", 1, "x"), (None, 2, "y")], "topic string, id bigint, value string")
    sink(batch, 0)
    sink(batch, 0)
    sink(batch.withColumn("id", F.col("id") + 10), 1)
    assert rows(files.read_topic(spark, root, "a")) == [(1, "x"), (11, "x")]
    assert rows(files.read_topic(spark, root, "DEFAULT_DATA")) == sorted([(2, "y"), (12, "y")], key=repr)
    table = files.table_sink(f"{root}-table")
    table(batch, 3)
    table(batch, 3)
    assert files.read_table(spark, f"{root}-table", RECORD).count() == 2


def test_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text('{"a":1}\n{"a":1}\n{"a":2}\n')
    lines = files.read_lines(spark, str(tmp_path))
    assert lines.count() == 3
    assert lines.select("id").distinct().count() == 2


def test_staged_tables_are_columnar_and_in_the_shared_folder(spark, rows):
    staged = staging.stage(rows([(1, "a")], "id bigint, v string"), "t")
    assert rows(staged) == [(1, "a")]
    assert staged.inputFiles()[0].startswith(f"file://{staging.shared_dir(spark)}")
    assert staging.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_tables_can_be_released(spark, rows):
    staged = staging.stage(rows([(1, "a")], "id bigint, v string"), "t")
    folder = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    staging.release(spark)
    assert not os.path.exists(folder)


def test_a_local_session_without_a_folder_gets_one():
    class Session:
        conf = {}
        sparkContext = type("Context", (), {"master": "local[2]"})

    first = staging.shared_dir(Session)
    assert os.path.isdir(first) and staging.shared_dir(Session) == first
    Session.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError):
        staging.shared_dir(Session)
