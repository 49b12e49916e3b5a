from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import logs, visitors
from tidemark.operators.records import parse_json
from tidemark.operators.skew import hot_keys, salted_join, split_join
from tidemark.plans import jobs
from tidemark.schemas import QUARANTINE_TOPIC, RECORD, Topic

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def log(mid="a", is_new="1", ts=T0, **members):
    common = {k: v for k, v in {"mid": mid, "is_new": is_new}.items() if v is not None}
    return json.dumps({"common": common, "ts": ts, **members})


def split(rows, *texts):
    records = rows([(i, t) for i, t in enumerate(texts)], RECORD)
    out = {}
    for topic, key, value in rows(jobs.log_outputs(records).select("topic", "id", "value")):
        out.setdefault(topic, []).append((key, value))
    return out


def test_start_logs_need_a_filled_object(rows):
    page = {"page_id": "p"}
    out = split(
        rows,
        log(page=page),
        log(page=page, start=None),
        log(page=page, start={}),
        log(start={"entry": "icon"}, displays=[{"item": "1"}]),
        '{"common": {"mid": "a"}, "ts": 1, "page": {}, "start": { } }',
    )
    assert [k for k, _ in out[Topic.PAGE]] == [0, 1, 2, 4]
    assert [k for k, _ in out[Topic.START]] == [3]
    assert Topic.DISPLAY not in out  # displays of a start log are not emitted
    assert QUARANTINE_TOPIC not in out


def test_displays_carry_the_page_id(rows):
    displays = [{"item": 7, "rate": 1.5, "page_id": "old", "gone": None}, {"item": "8"}, None, 3]
    out = split(rows, log(page={"page_id": "p"}, displays=displays), log(page={}, displays=[{"a": 1, "page_id": "x"}]))
    shown = [(key, sorted(json.loads(v).items())) for key, v in out[Topic.DISPLAY]]
    shown.sort(key=repr)
    assert shown == [
        (0, [("item", "8"), ("page_id", "p")]),
        (0, [("item", 7), ("page_id", "p"), ("rate", 1.5)]),
        (1, [("a", 1)]),  # a page without an id takes the old one away
    ]


def test_unusable_logs_are_kept_apart(rows):
    bad = [
        "{cut",
        "",
        None,
        "[1]",
        '"text"',
        json.dumps({"page": {}, "ts": T0}),
        log(mid=None, page={}),
        log(ts=None, page={}),
        log(ts="soon", page={}),
        log(),
    ]
    out = split(rows, *bad, log(page={}))
    assert [k for k, _ in out[QUARANTINE_TOPIC]] == list(range(len(bad)))
    assert [k for k, _ in out[Topic.PAGE]] == [len(bad)]


def test_quoted_numbers_and_numeric_texts(rows):
    text = json.dumps({"common": {"mid": 7, "is_new": 1}, "page": {"during_time": "12"}, "ts": str(T0)})
    parsed = logs.parse_log(rows([(1, text)], RECORD))
    assert rows(parsed.select("mid", "is_new", "during_time", "ts")) == [("7", "1", 12, T0)]


def test_repair_keeps_unknown_members_and_untouched_texts(rows):
    first = log(page={"page_id": "p"}, err=[1, {"x": 1.5}])
    later = json.dumps({"common": {"mid": "a", "is_new": "1", "os": 9}, "page": {}, "ts": T0 + DAY, "more": {"k": [True]}})
    out = split(rows, first, later)
    values = dict(out[Topic.PAGE])
    assert values[0] == first
    expected = json.loads(later)
    expected["common"]["is_new"] = "0"
    assert json.loads(values[1]) == expected


def repaired(rows, *logs_in, **options):
    raw = rows([(i, log(mid, flag, ts, page={})) for i, (mid, flag, ts) in enumerate(logs_in)], RECORD)
    fixed = visitors.repair_new_visitor(logs.parse_log(raw), **options)
    return [flag for _, flag in rows(fixed.select("id", "is_new"))]


def test_repair_counts_flagged_logs_only(rows):
    got = repaired(
        rows,
        ("a", "0", T0),  # not flagged: neither sets nor changes anything
        ("a", "1", T0 + DAY),
        ("a", "1", T0 + DAY + 5),
        ("a", "1", T0 + 2 * DAY),
        ("b", "1", T0),
        ("b", None, T0 + DAY),
    )
    assert got == ["0", "1", "1", "0", "1", None]


def test_repair_by_shuffle_with_hot_devices(spark, rows):
    many = [("hot", "1", T0 + i * DAY // 40) for i in range(120)] + [("cold", "1", T0), ("cold", "1", T0 + DAY)]
    expected = repaired(rows, *many)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert repaired(rows, *many, rows_per_task=10) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert expected.count("1") == 41


def test_salted_join_spreads_a_hot_key(spark, rows):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k")
    )
    table = spark.createDataFrame([("hot", 1), ("4", 2), ("absent", 3)], "k string, v int")
    hot = hot_keys(facts, ["k"], 100)
    assert rows(hot) == [("hot", 10)]
    joined = salted_join(facts, table, ["k"], "left", hot)
    assert joined.columns == ["k", "id", "v"]
    counts = dict(rows(joined.groupBy("v").count()))
    assert counts == {None: 3000 - 1001, 1: 1000, 2: 1}
    inner = salted_join(facts, table, ["k"], "inner", hot)
    assert inner.count() == 1001


def test_salted_join_on_two_keys(spark, rows):
    facts = spark.range(1000).select("id", F.lit("x").alias("a"), (F.col("id") % 2).alias("b"))
    facts = facts.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    table = spark.createDataFrame([("x", 0, "even")], "a string, b bigint, v string")
    joined = salted_join(facts, table, ["a", "b"], "left", hot_keys(facts, ["a", "b"], 50))
    assert joined.count() == 1000
    assert joined.filter("v = 'even'").count() == 400


def test_split_join_lets_adaptive_execution_split_hot_and_keyless_rows(spark, rows, small_partitions):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))
    facts = spark.range(0, 90_000, 1, 12).select("id", key.alias("k"))
    table = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = split_join(facts, table, ["k"], "left")
    counts = dict(rows(joined.groupBy(F.col("v").isNotNull()).count()))
    assert counts == {True: 30_000 + 33, False: 60_000 - 33}
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fixed_partitions(spark):
    """Shuffles into 20 partitions that stay as they are, and no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows_by_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_without_a_key_are_dealt_over_all_tasks(spark, fixed_partitions):
    facts = spark.range(20_000).select("id", F.when(F.col("id") < 0, F.col("id")).alias("k"))
    table = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    for joined in (split_join(facts, table, ["k"], "left"), salted_join(facts, table, ["k"], "left", hot_keys(facts, ["k"], 10))):
        counts = rows_by_task(joined)
        assert sum(counts) == 20_000
        assert len(counts) == 20 and max(counts) < 2_000


def test_equal_facts_of_a_hot_key_use_all_salts(spark, fixed_partitions):
    facts = spark.range(1000).select(F.lit("x").alias("k"))
    table = spark.createDataFrame([("x", 1)], "k string, v int")
    joined = salted_join(facts, table, ["k"], "left", hot_keys(facts, ["k"], 100))
    counts = rows_by_task(joined.where("v = 1"))
    assert sum(counts) == 1000
    assert max(counts) < 500


def test_text_behind_an_object_is_no_record(spark):
    texts = ['{"a":1}', ' {"a":1} ', '{"a":1} x', '{"a":1}]', '{"a":1}]{}', '{"a":1},{"a":2}', '[{"a":1}]', '{"a":', "", None, "5"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    read = parse_json(df, "a bigint, b struct<c:array<string>>")
    assert read.columns == ["value", "a", "b"]
    assert [r.a for r in read.collect()] == [1, 1, *[None] * 9]
    assert str(read.where("a = 1")._jdf.queryExecution().executedPlan()).count("from_json") == 1


def test_logs_that_cannot_be_repaired_or_read_whole_are_quarantined(spark):
    def log(extra="", displays="", is_new="1", ts=T0):
        common = f'{{"mid":"m",{extra}"is_new":"{is_new}"}}'
        return f'{{"common":{common},"page":{{"page_id":"p"}},{displays}"ts":{ts}}}'

    twice = '"os":1,"os":2,'
    shown = '"displays":[{"item":"1"},{"item":"2","item":"3"}],'
    values = [log(), log(twice), log(twice, ts=T0 + DAY), log(ts=T0 + DAY), log(displays=shown), log(displays='"displays":"none",')]
    raw = spark.createDataFrame(list(enumerate(values)), "id bigint, value string")
    out = sorted((r.id, r.topic, r.value == values[r.id]) for r in jobs.log_outputs(raw).collect())
    page, bad = "dwd_page_log", "quarantine"
    assert out == [(0, page, True), (1, page, True), (2, bad, True), (3, page, False), (4, bad, True), (5, page, True)]


def test_page_jobs_rewrite_no_text_and_parse_it_once(rows):
    """The plan of the page table: the log, the flags, and one look at logs to repair; nothing is written back."""
    from tidemark.plans import jobs

    raw = rows([(1, '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"p"},"ts":1}')], "id long, value string")
    plan = jobs.page_table(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan
    assert plan.lower().count("parsejson(") == 1
    split = jobs.log_outputs(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert split.lower().count("parsejson(") == 1
