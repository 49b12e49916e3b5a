"""Adapters that give the sample tables the shape of the warehouse's topics.

Each one is a projection of one table (no shuffle), so the records grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import second_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log_records(events: DataFrame) -> DataFrame:
    """``events`` as log lines ``(id, value)``."""
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k").cast("bigint")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    common = F.struct(
        text("mid_", F.col("user_id")).alias("mid"),
        text("ar", F.col("user_id") % 4).alias("ar"),
        text("ch", F.col("user_id") % 3).alias("ch"),
        text("v", F.col("event_id") % 2).alias("vc"),
        F.when(F.col("event_id") % 4 == 0, "0").otherwise("1").alias("is_new"),
    )
    start = F.when(
        kind == "signup",
        F.struct(F.lit("icon").alias("entry"), (F.col("event_id") % 100).alias("loading_time")),
    )
    last_page = F.when(kind == "error", "").when(kind == "click", "home")
    page = F.when(
        kind != "signup",
        F.struct(
            kind.alias("page_id"),
            last_page.alias("last_page_id"),
            F.floor(F.col("value") * 1000).alias("during_time"),
        ),
    )
    shown = F.filter(F.sequence(F.lit(0), F.lit(1)), lambda i: i < number % 3)
    displays = F.when(
        kind == "click",
        F.transform(
            shown,
            lambda i: F.struct(
                F.col("event_id").cast("string").alias("item"), i.cast("string").alias("order")
            ),
        ),
    )
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    log = F.struct(
        common.alias("common"),
        start.alias("start"),
        page.alias("page"),
        displays.alias("displays"),
        ts.alias("ts"),
    )
    return events.select(F.col("event_id").alias("id"), F.to_json(log).alias("value"))


# The device of the closing records, and what stands for its other members.
CLOSING = "closing"


def closing_records(spark: SparkSession, last_ms: int) -> DataFrame:
    """Two page views of no real device, 10 and 20 days after ``last_ms``, with negative ids.

    At the end of a finite replay they move every watermark past the last real window.
    """
    times = spark.createDataFrame([(-1, last_ms + 10 * 86_400_000), (-2, last_ms + 20 * 86_400_000)], "id long, ts long")
    common = F.struct(*(F.lit(CLOSING).alias(c) for c in ("mid", "ar", "ch", "vc")), F.lit("0").alias("is_new"))
    page = F.struct(F.lit(CLOSING).alias("page_id"), F.lit(0).alias("during_time"))
    log = F.struct(common.alias("common"), page.alias("page"), "ts")
    return times.select("id", F.to_json(log).alias("value"))


def damaged_log_records(events: DataFrame) -> DataFrame:
    """Log lines of which some, chosen by id, are cut short or lack a needed member."""
    logs = log_records(events)
    turn = F.col("id") % 10
    value = F.col("value")
    broken = (
        F.when(turn == 0, F.expr("left(value, length(value) div 2)"))
        .when(turn == 1, F.regexp_replace(value, '"mid":', '"device":'))
        .when(turn == 2, F.regexp_replace(value, '"ts":', '"at":'))
        .when(turn == 3, F.regexp_replace(value, '"page":', '"screen":'))
        .when(turn == 4, _twisted(value))
        .otherwise(value)
    )
    return logs.withColumn("value", broken)


def _twisted(value: Column) -> Column:
    """Members that come twice, text behind the object, and a page held as text."""
    way = F.floor(F.col("id") / 10) % 5
    page = F.regexp_extract(value, r'"page":(\{[^}]*\})', 1)
    return (
        F.when(way == 0, F.regexp_replace(value, r"\}$", ',"extra":1,"extra":2}'))
        .when(way == 1, F.regexp_replace(value, r'"vc":', '"os":"a","os":"b","vc":'))
        .when(way == 2, F.regexp_replace(value, r'"order":"1"', '"order":"0","order":"1"'))
        .when(way == 3, F.concat(value, F.lit(" {}")))
        .otherwise(
            F.replace(value, page, F.concat(F.lit('"'), F.replace(page, F.lit('"'), F.lit('\\"')), F.lit('"')))
        )
    )


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def order_records(orders: DataFrame) -> DataFrame:
    """``orders`` as order records ``(id, value)``."""
    order = F.struct(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        second_text(F.col("o_orderdate").cast("timestamp")).alias("create_time"),
    )
    return orders.select(F.col("o_orderkey").alias("id"), F.to_json(order).alias("value"))


def numbered(lineitem: DataFrame) -> DataFrame:
    """Lines with a ``detail_id``: their number within the order, below the number of the order.

    Unique for up to a million lines an order, and fits a long for 9e12 orders.
    """
    lines = W.partitionBy("l_orderkey").orderBy(*(c for c in lineitem.columns if c != "l_orderkey"))
    number = F.row_number().over(lines).cast("bigint")
    return lineitem.withColumn("detail_id", F.col("l_orderkey") * 1_000_000 + number)


def detail_records(lines: DataFrame) -> DataFrame:
    """Numbered lines as order detail records ``(id, value)``."""
    detail = F.struct(
        F.col("detail_id").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku_"), F.col("l_partkey").cast("string")).alias("sku_name"),
        second_text(F.col("l_shipdate").cast("timestamp")).alias("create_time"),
        _money("l_extendedprice").alias("split_total_amount"),
    )
    return lines.select(F.col("detail_id").alias("id"), F.to_json(detail).alias("value"))


def damaged_records(records: DataFrame) -> DataFrame:
    """Records of which some, chosen by id, are cut short, have no id or no time of day."""
    turn = F.col("id") % 7
    value = F.col("value")
    broken = (
        F.when(turn == 0, F.expr("left(value, length(value) div 2)"))
        .when(turn == 1, F.regexp_replace(value, r'("create_time":"[0-9-]+) [0-9:]+"', '$1"'))
        .when(turn == 2, F.regexp_replace(value, r'^\{"id":', '{"number":'))
        .when(turn == 3, F.regexp_replace(value, r'"order_id":', '"of":'))
        .otherwise(value)
    )
    return records.withColumn("value", broken)


def damaged_changes(changes: DataFrame) -> DataFrame:
    """Change records of which every thirteenth is cut short and every other thirteenth is no object."""
    turn = F.col("id") % 13
    short = F.expr("left(value, length(value) div 2)")
    return changes.withColumn("value", F.when(turn == 0, short).when(turn == 1, "[]").otherwise(F.col("value")))


def users(customer: DataFrame, all_of_them: bool = False) -> DataFrame:
    """``customer`` as the user dimension; every tenth customer is missing unless all are asked for."""
    known = F.lit(all_of_them) | (F.col("c_custkey") % 10 != 0)
    born = F.date_add(F.lit("1960-01-01").cast("date"), ((F.col("c_custkey") * 7) % 16000).cast("int"))
    return customer.filter(known).select(
        F.col("c_custkey").cast("string").alias("id"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        F.col("c_mktsegment").alias("gender"),
    )


def provinces(nation: DataFrame) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return nation.select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("0"), F.col("n_regionkey").cast("string")).alias("area_code"),
        F.concat(F.lit("CN-"), key).alias("iso_code"),
        F.concat(F.lit("CN-X"), key).alias("iso_3166_2"),
    )


def skus(part: DataFrame) -> DataFrame:
    """``part`` as the sku dimension; every seventh part is missing from it."""
    return part.filter(F.col("p_partkey") % 7 != 0).select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("spu_id"),
        (F.col("p_partkey") % 10).alias("tm_id"),
        F.col("p_size").cast("bigint").alias("category3_id"),
    )


def spus(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("spu_name"))


def trademarks(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("tm_name"))


def categories3(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def order_changes(orders: DataFrame) -> DataFrame:
    """``orders`` as change records ``(id, value)``, with unusable ones among them."""
    data = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        _money("o_totalprice").alias("total_amount"),
    )
    kind = F.when(F.col("o_orderkey") % 3 == 0, "update").otherwise("insert")
    return _changes(orders, F.col("o_orderkey"), "order_info", kind, data)


def user_changes(customer: DataFrame) -> DataFrame:
    """``customer`` as change records ``(id, value)``, with unusable ones among them."""
    data = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("gender"),
    )
    return _changes(customer, F.col("c_custkey"), "user_info", F.lit("insert"), data)


def later_user_changes(orders: DataFrame) -> DataFrame:
    """A change of its user for each order, with ids above those of :func:`user_changes`."""
    data = F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("gender"))
    record = F.struct(F.lit("user_info").alias("table"), F.lit("insert").alias("type"), data.alias("data"))
    return orders.select((F.col("o_orderkey") + 1_000_000_000_000).alias("id"), F.to_json(record).alias("value"))


def _changes(df: DataFrame, key: Column, name: str, kind: Column, data: Column) -> DataFrame:
    turn = key % 11
    body = (
        F.when(turn == 1, F.lit(None).cast("string"))
        .when(turn == 2, "{}")
        .when(turn == 3, '{"id":null,"name":null}')
        .otherwise(F.to_json(data))
    )
    parts = F.concat_ws(
        ",",
        F.when(turn == 0, '"table":null').otherwise(f'"table":"{name}"'),
        F.concat(F.lit('"type":"'), kind, F.lit('"')),
        F.concat(F.lit('"data":'), body),
    )
    return df.select(key.alias("id"), F.concat(F.lit("{"), parts, F.lit("}")).alias("value"))


def routing_rules(spark: SparkSession) -> DataFrame:
    """Three rules: new orders and changed orders to topics, new users to a table."""
    from tidemark.schemas import ROUTING, SinkType

    rows = [
        ("order_info", "insert", SinkType.KAFKA, "dwd_order_info", "id,user_id,total_amount", "id", None),
        ("order_info", "update", SinkType.KAFKA, "dwd_order_info_update", "id,order_status", "id", None),
        ("user_info", "insert", SinkType.HBASE, "dim_user_info", "id,gender", "id", None),
    ]
    return spark.createDataFrame(rows, ROUTING)
