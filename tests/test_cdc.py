from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.operators.cdc import clean_cdc, parse_cdc, route_cdc
from tidemark.schemas import RECORD, ROUTING

RULES = [
    ("order_info", "insert", "kafka", "dwd_order", "id, amount", "id", None),
    ("user_info", "insert", "hbase", "dim_user", None, "id", None),
]


def change(rows, *texts):
    raw = rows([(i, t if isinstance(t, str) or t is None else json.dumps(t)) for i, t in enumerate(texts)], RECORD)
    return cdc.clean_cdc(cdc.parse_cdc(raw))


def test_cleaning(rows):
    cleaned = change(
        rows,
        {"table": "t", "data": {"a": 1}},
        {"table": None, "data": {"a": 1}},
        {"data": {"a": 1}},
        {"table": "t"},
        {"table": "t", "data": {}},
        {"table": "t", "data": {"a": None, "b": None}},
        {"table": "t", "data": {"a": None, "b": {}}},
        {"table": "t", "data": "text"},
        {"table": "t", "data": '{"a": 1}'},
        {"table": "t", "data": [1]},
        "{cut",
        None,
    )
    assert [r[0] for r in rows(cleaned.select("id"))] == [0, 6, 8]


def test_routing(rows):
    cleaned = change(
        rows,
        {"table": "order_info", "type": "insert", "data": {"id": 1, "amount": 2.5, "note": "x", "gone": None}},
        {"table": "order_info", "type": "delete", "data": {"id": 2}},
        {"table": "user_info", "type": "insert", "data": {"id": "u1", "nested": {"a": [1]}, "gone": None}},
        {"table": "user_info", "data": {"id": "u2"}},
    )
    routed = cdc.route_cdc(cleaned, rows(RULES, ROUTING))
    got = [(*r[:5], json.loads(r[5])) for r in rows(routed)]
    assert got == [
        ("hbase", "dim_user", "id", "u1", 2, {"id": "u1", "nested": {"a": [1]}}),
        ("kafka", "dwd_order", "id", "1", 0, {"id": 1, "amount": 2.5}),
    ]


def test_routing_by_shuffle(spark, rows):
    texts = [{"table": "order_info", "type": "insert", "data": {"id": i}} for i in range(60)]
    texts.append({"table": "user_info", "type": "insert", "data": {"id": 1}})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows_per_task in (None, 7):
            routed = cdc.route_cdc(change(rows, *texts), rows(RULES, ROUTING), rows_per_task)
            assert dict(rows(routed.groupBy("sink_table").count())) == {"dwd_order": 60, "dim_user": 1}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_small_rules_are_sent_to_the_changes_which_are_read_once(spark, tmp_path):
    raw = spark.range(1000).select("id", F.format_string('{"table":"t","type":"insert","data":{"id":%s}}', "id").alias("value"))
    raw.write.parquet(f"{tmp_path}/raw")
    rules = spark.createDataFrame([("t", "insert", "kafka", "topic", "id", "id", None)], ROUTING).persist()
    rules.count()
    parsed = parse_cdc(spark.read.parquet(f"{tmp_path}/raw"))
    routed = route_cdc(clean_cdc(parsed), rules, rows_per_task=10)
    assert routed.count() == 1000
    plan = routed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "BuildRight" in plan
    assert plan.count("FileScan parquet") == 1
    assert plan.count("from_json") == 2
