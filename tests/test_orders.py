from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import age_years
from tidemark.operators import dims, orders
from tidemark.operators.skew import plan_bytes
from tidemark.plans import jobs
from tidemark.schemas import ORDER_WIDE_FIELDS, RECORD

S0 = "2024-01-01 10:00:00"
T0 = 1_704_103_200_000


def order_records(rows, *records):
    return rows([(i, json.dumps(r)) for i, r in enumerate(records)], RECORD)


def test_orders_are_parsed(rows):
    raw = order_records(
        rows,
        {"id": "1", "user_id": 5, "total_amount": "12.30", "create_time": S0},
        {"id": 2, "total_amount": 1234567890123456.78, "create_time": S0, "create_hour": "xx"},
        {"id": 3, "create_time": "yesterday"},
    )
    got = orders.parse_orders(raw).select("id", "user_id", "total_amount", "create_date", "create_hour", "create_ts")
    assert rows(got) == [
        (1, 5, Decimal("12.30"), "2024-01-01", "10", T0),
        (2, None, Decimal("1234567890123456.80"), "2024-01-01", "xx", T0),
        (3, None, None, None, None, None),
    ]


def test_amounts_keep_their_digits(rows):
    raw = rows([(1, '{"id":1,"total_amount":1234567890123456.78}')], RECORD)
    assert rows(orders.parse_orders(raw).select("total_amount")) == [(Decimal("1234567890123456.78"),)]


def pairs(rows, order_ts, detail_ts, **bounds):
    left = rows(list(order_ts), "id bigint, create_ts bigint")
    right = rows(list(detail_ts), "id bigint, order_id bigint, create_ts bigint")
    joined = orders.interval_join(left, right, **bounds)
    return rows(joined.select("o_id", "d_id"))


def test_interval_ends_are_included(rows):
    details = [(i, 1, T0 + gap) for i, gap in enumerate((-6, -5, 0, 5, 6))]
    assert pairs(rows, [(1, T0)], details) == [(1, 1), (1, 2), (1, 3)]


def test_interval_may_be_lopsided_and_wide(rows):
    details = [(i, 1, T0 + gap) for i, gap in enumerate((-1, 0, 999, 5_000, 5_001))]
    assert pairs(rows, [(1, T0)], details, lower_ms=0, upper_ms=5_000) == [(1, 1), (1, 2), (1, 3)]
    assert pairs(rows, [(1, T0)], details, lower_ms=999, upper_ms=999) == [(1, 2)]


def test_all_pairs_of_an_id_within_the_interval(rows):
    many_orders = [(1, T0 + 700 * i) for i in range(20)] + [(None, T0)]
    many_details = [(i, 1, T0 + 300 * i) for i in range(50)] + [(99, None, T0), (98, 1, None)]
    got = pairs(rows, many_orders, many_details, lower_ms=-1_000, upper_ms=1_500)
    expected = [
        (1, d)
        for _, o_ts in many_orders[:-1]
        for d, _, d_ts in many_details[:-2]
        if o_ts - 1_000 <= d_ts <= o_ts + 1_500
    ]
    assert sorted(got) == sorted(expected)


def test_a_hot_order_is_split(spark, rows, small_partitions):
    """A third of the details are of one order, in one cell and over many."""
    at = F.lit(T0) + F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    owner = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    details = spark.range(0, 60_000, 1, 12).select("id", owner.alias("order_id"), at.alias("create_ts"))
    left = spark.range(0, 60_000, 1, 4).select("id", F.lit(T0).alias("create_ts"))
    joined = orders.interval_join(left, details)
    got = joined.filter("o_id = 1").count()
    assert got == 10_000 + 2 and joined.select("d_id").distinct().count() == joined.count()
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def wide_rows(rows, *partial):
    names = ["detail_id", "order_id", "sku_id", "user_id", "user_age", "user_gender"]
    return rows(list(partial), "detail_id bigint, order_id bigint, sku_id bigint, user_id bigint, user_age int, user_gender string").select(*names)


def users(rows):
    return rows(
        [("1", "2000-01-01", "F"), ("2", "2030-01-01", "M"), ("3", "no date", "X"), ("4", "1990-01-01", "M"), ("4", "1980-01-01", "F"), (None, "1990-01-01", "?")],
        "id string, birthday string, gender string",
    )


def test_user_dimension(rows):
    facts = wide_rows(rows, *[(i, 0, 0, user, None, "kept") for i, user in enumerate((1, 2, 3, 4, 9, None))])
    as_of = F.lit("2024-01-01").cast("timestamp")
    got = rows(orders.with_user(facts, users(rows), as_of).select("detail_id", "user_age", "user_gender"))
    assert got == [
        (0, 24, "F"),
        (1, -6, "M"),  # birthday to come
        (2, None, "X"),  # birthday not a date
        (3, 44, "F"),  # two rows for the key: the first in order
        (4, None, "kept"),  # no such user
        (5, None, "kept"),  # no key
    ]


def test_age_has_years_of_365_days(rows):
    df = rows([("2000-01-01",), ("2023-01-01",), ("2024-06-01",)], "birthday string")
    as_of = F.lit("2023-12-27").cast("timestamp")
    assert [r[0] for r in df.select(age_years(F.col("birthday"), as_of)).collect()] == [24, 0, 0]


def test_composite_keys_do_not_mix_columns(rows):
    facts = rows([(1, "10", "zz"), (2, "zz", "10")], "f bigint, k1 string, k2 string")
    dim = rows([(10, "zz", "hit")], "a int, b string, v string")
    got = dims.enrich(facts, dim, {"k1": "a", "k2": "b"}, {"v": "v"})
    assert rows(got.select("f", "v")) == [(1, "hit"), (2, None)]


def test_enrich_by_shuffle_with_hot_keys(spark, rows):
    facts = spark.range(900).select("id", F.when(F.col("id") % 3 > 0, F.lit(1)).alias("k"))
    dim = rows([(1, "one"), (2, "two")], "id bigint, v string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows_per_task in (None, 50):
            got = dims.enrich(facts, dim, {"k": "id"}, {"v": "v"}, rows_per_task=rows_per_task)
            assert dict(rows(got.groupBy("v").count())) == {"one": 600, None: 300}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_dimension_freshness(rows):
    reads = []

    def reader():
        reads.append(1)
        return rows([(1, f"v{len(reads)}")], "id bigint, v string")

    facts = rows([(1,)], "k bigint")

    def look(dim):
        return rows(dims.get_dim(facts, dim, "k", {"v": "v"}))[0][1]

    fresh = dims.Dimension(reader)
    assert [look(fresh), look(fresh)] == ["v1", "v2"]
    kept = dims.Dimension(reader, refresh="cached")
    assert [look(kept), look(kept)] == ["v3", "v3"]
    kept.invalidate()
    assert look(kept) == "v4"
    short = dims.Dimension(reader, refresh="cached", ttl_seconds=0)
    assert [look(short), look(short)] == ["v5", "v6"]


def test_wide_rows_have_every_column(rows):
    raw_orders = order_records(rows, {"id": 1, "create_time": S0, "province_id": 3})
    raw_details = order_records(rows, {"id": 7, "order_id": 1, "create_time": S0, "sku_num": 2})
    wide = jobs.order_wide(raw_orders, raw_details)
    assert wide.dtypes == list(ORDER_WIDE_FIELDS.items())
    assert rows(wide.select("detail_id", "order_id", "province_id", "sku_num", "spu_name")) == [(7, 1, 3, 2, None)]
    value = json.loads(rows(orders.order_wide_values(wide).select("value"))[0][0])
    assert "spu_name" not in value and value["detail_id"] == 7


def test_merge_takes_the_first_value(rows):
    schema = "detail_id bigint, order_id bigint, order_status string, sku_id bigint, split_total_amount bigint"
    one = rows([(1, None, None, 5, None), (2, 1, "A", None, 1), (None, 8, "n", 1, 1)], schema)
    other = rows([(1, 9, "B", 6, 7), (3, 4, "C", 1, 1), (None, 9, "m", 1, 1)], schema)
    assert rows(orders.merge_order_wide(one, other)) == sorted(
        [
            (1, None, "B", 5, 7),  # order_id is not merged
            (2, 1, "A", None, 1),
            (3, 4, "C", 1, 1),
            (None, 8, "n", 1, 1),
            (None, 9, "m", 1, 1),
        ],
        key=repr,
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_are_not_sent_through_the_driver(rows):
    left = rows([(1, T0), (2, T0)], "id bigint, create_ts bigint")
    right = rows([(10, 1, T0), (20, 2, T0 + 6)], "id bigint, order_id bigint, create_ts bigint")
    joined = orders.interval_join(left, right)
    assert "BroadcastHashJoin" not in plan_of(joined)
    assert rows(joined.select("o_id", "d_id")) == [(1, 10)]


def test_a_dimension_larger_in_memory_than_the_limit_is_not_broadcast(spark, rows, tmp_path):
    spark.range(2000).selectExpr("string(id) as id", "concat('n', id) as name").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts = rows([(1, "5"), (2, "nobody"), (3, None)], "fact bigint, of string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 * plan_bytes(dim)))
    try:
        filled = dims.enrich(facts, dim, {"of": "id"}, {"name": "name"}, unique=True)
        assert "BroadcastHashJoin" not in plan_of(filled)
        assert rows(filled) == [(1, "5", "n5"), (2, "nobody", None), (3, None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
