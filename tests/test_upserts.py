from __future__ import annotations

import os
import random
import tempfile

import pytest

from tidemark.sources.upserts import KeyedTable

SCHEMA = "topic string, key string, id bigint, value string"


@pytest.fixture
def table():
    return KeyedTable(tempfile.mkdtemp(prefix="run-upserts-") + "/t", SCHEMA, ["topic", "key"], ["id"], buckets=8)


def held(spark, table):
    return {(r.topic, r.key): (r.id, r.value) for r in table.read(spark).collect()}


def files_of(table, bucket):
    return sorted(p for p, _, names in os.walk(table.root) if f"bucket={bucket}" in p for n in names if n.endswith(".parquet"))


def test_newest_row_of_each_key_over_batches(spark, table):
    rng, truth = random.Random(1), {}
    assert held(spark, table) == {} and table.version(spark) == -1
    for batch in range(5):
        rows = [("t" if i % 3 else "u", f"k{rng.randrange(40)}", rng.randrange(10**6), f"v{batch}.{i}") for i in range(60)]
        rows += [("t", None, 1, "no key"), (None, "k", 1, "no topic"), ("t", "once", batch, "same")]
        for topic, key, i, value in rows:
            if topic and key and truth.get((topic, key), (-1,))[0] < i:
                truth[topic, key] = (i, value)
        table.sink()(spark.createDataFrame(rows, SCHEMA).repartition(4), batch)
        assert held(spark, table) == truth
    assert table.version(spark) == 4


def test_a_batch_tried_again_gives_the_same_table(spark, table):
    first = [("t", f"k{i}", i, "a") for i in range(20)]
    second = [("t", f"k{i}", 100 + i, "b") for i in range(10)]
    sink = table.sink()
    sink(spark.createDataFrame(first, SCHEMA), 0)
    sink(spark.createDataFrame(second, SCHEMA), 1)
    once = held(spark, table)
    sink(spark.createDataFrame(second[::-1], SCHEMA), 1)
    assert held(spark, table) == once and len(once) == 20


def test_only_touched_buckets_are_written(spark, table):
    table.upsert(spark.createDataFrame([("t", f"k{i}", 1, "a") for i in range(200)], SCHEMA), 0)
    before = {b: files_of(table, b) for b in range(8)}
    assert all(before.values())
    touched = table.upsert(spark.createDataFrame([("t", "k1", 2, "b"), ("t", "k1", 3, "c")], SCHEMA), 1)
    assert len(touched) == 1
    after = {b: files_of(table, b) for b in range(8)}
    assert [b for b in range(8) if after[b] != before[b]] == touched
    assert held(spark, table)["t", "k1"] == (3, "c")
    rows = held(spark, table)
    assert len(rows) == 200 and table.vacuum(spark, 1) == 0  # both versions are needed if batch 1 runs again
    table.sink()(spark.createDataFrame([("t", "k1", 9, "d")], SCHEMA), 2)
    assert len(files_of(table, touched[0])) == 2 and held(spark, table)["t", "k1"] == (9, "d")


def test_an_unfinished_batch_is_not_seen(spark, table):
    table.upsert(spark.createDataFrame([("t", "k", 1, "a")], SCHEMA), 0)
    table.upsert(spark.createDataFrame([("t", "k", 2, "b")], SCHEMA), 1)
    os.remove(f"{table.root}/batch=1/_SUCCESS")
    assert held(spark, table) == {("t", "k"): (1, "a")}


def test_empty_batches(spark, table):
    table.sink()(spark.createDataFrame([], SCHEMA), 0)
    table.sink()(spark.createDataFrame([("t", "k", 1, "a")], SCHEMA), 1)
    table.sink()(spark.createDataFrame([], SCHEMA), 2)
    assert held(spark, table) == {("t", "k"): (1, "a")}
