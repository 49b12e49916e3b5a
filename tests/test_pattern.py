from __future__ import annotations

import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bounce, pattern
from tidemark.schemas import RECORD, Topic
from tidemark.sources import files
from tidemark.streaming import jobs
from tidemark.streaming.session import streaming_session

EVENT = "id long, mid string, ts long, kind string"


def first():
    return F.col("kind") == "a"


def then():
    return F.col("kind").isin("b", "a")


def brute(events, within):
    out = []
    by_key = {}
    for e in events:
        if e[1] is not None and e[2] is not None:
            by_key.setdefault(e[1], []).append(e)
    for rows in by_key.values():
        rows.sort(key=lambda e: (e[2], e[0]))
        for e, after in zip(rows, rows[1:] + [None]):
            if e[3] == "a":
                if after is None or after[2] - e[2] >= within:
                    out.append((e[0], "timeout", None))
                elif after[3] in ("a", "b"):
                    out.append((e[0], "match", after[0]))
    return sorted(out, key=repr)


def found(df):
    return sorted([(r.id, r.outcome, r.next and r.next.id) for r in df.collect()], key=repr)


def made(rng, n=400):
    out, ts = [], 0
    for i in range(n):
        ts += rng.choice([0, 1, 3, 9, 10, 11, 25, 100])
        out.append((i, rng.choice(["x", "y", "hot", "hot"]), ts, rng.choice(["a", "b", "c", None])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("within", [1, 10, 1000, 10**7])
def test_table_like_brute_force(spark, within):
    events = made(random.Random(within)) + [(9001, None, 5, "a"), (9002, "x", None, "a")]
    df = spark.createDataFrame(events, EVENT).repartition(4)
    assert found(pattern.two_step(df, first(), then(), within)) == brute(events, within)


def test_negative_times_ties_and_repeated_rows(spark):
    events = [(1, "x", -15, "a"), (2, "x", -6, "b"), (3, "x", -6, "a"), (3, "x", -6, "a"), (4, "x", 3, "c"), (5, "x", 3, "a")]
    got = found(pattern.two_step(spark.createDataFrame(events, EVENT), first(), then(), 10))
    assert got == brute(events, 10)


def test_no_events(spark):
    out = pattern.two_step(spark.createDataFrame([], EVENT), first(), then(), 10)
    assert out.count() == 0 and out.columns == ["id", "mid", "ts", "kind", "outcome", "next"]


def test_two_outputs_and_chosen_columns(spark):
    events = [(1, "x", 0, "a"), (2, "x", 1, "b"), (3, "x", 2, "a"), (4, "y", 0, "a"), (5, "y", 1, "c")]
    out = pattern.two_step(spark.createDataFrame(events, EVENT), first(), then(), 10, columns=["id"], then_columns=["kind"])
    assert [tuple(r) for r in pattern.matches(out).select("id", "next.kind").collect()] == [(1, "b")]
    assert [r.id for r in pattern.timeouts(out).collect()] == [3]


def test_timeouts_of_any_page_are_bounces(spark):
    events = [(i, m, ts, "a" if k == "a" else "") for i, m, ts, k in made(random.Random(3))]
    pages = spark.createDataFrame(events, EVENT).withColumn("last_page_id", F.when(F.col("kind") == "", F.lit("home")))
    out = pattern.timeouts(pattern.two_step(pages, F.col("last_page_id").isNull(), F.lit(True), 10))
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in bounce.bounces(pages, 10).collect())


def test_hot_key_is_spread_over_its_cells(spark):
    """No window of one key's whole history: the cell is the first key of the exchange."""
    out = pattern.two_step(spark.createDataFrame(made(random.Random(5)), EVENT), first(), then(), 10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cell" in plan and plan.count("Exchange") == 1


def test_stream_in_batches_out_of_order(spark):
    home = tempfile.mkdtemp(prefix="run-pattern-")
    session = streaming_session(spark, 2)
    rng = random.Random(8)
    base = 1_704_067_200_000
    events = sorted(((i, m, base + ts, k) for i, m, ts, k in made(rng, 300)), key=lambda e: e[2])
    text = lambda e: json.dumps({"common": {"mid": e[1], "is_new": "0"}, "page": {"page_id": e[3], "last_page_id": "h"}, "ts": e[2]})
    for b in range(3):
        part = events[100 * b : 100 * b + 100]
        rng.shuffle(part)
        rows = spark.createDataFrame([(e[0], text(e)) for e in part], RECORD).withColumn("topic", F.lit("p")).coalesce(1)
        files.topic_sink(f"{home}/pages")(rows, b)
    end = spark.createDataFrame([(9999, text((9999, "end", base + 10**6, "c")))], RECORD).withColumn("topic", F.lit("p"))
    files.topic_sink(f"{home}/pages")(end, 3)
    query = jobs.start_pattern(
        files.stream_topic(session, f"{home}/pages", "p", 1), F.col("page_id") == "a", F.col("page_id").isin("a", "b"), 10,
        files.topic_sink(f"{home}/out"), f"{home}/check", "matched", "timed_out",
    )
    query.awaitTermination()
    matched = [tuple(r) for r in files.read_topic(spark, f"{home}/out", "matched").select("id", F.get_json_object("value", "$.next.id").cast("long")).collect()]
    late = [r.id for r in files.read_topic(spark, f"{home}/out", "timed_out").collect()]
    expected = brute(events, 10)
    assert sorted(matched) == sorted((i, n) for i, o, n in expected if o == "match")
    assert sorted(late) == sorted(i for i, o, _ in expected if o == "timeout")
