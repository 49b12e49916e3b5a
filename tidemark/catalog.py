"""Queries over the sample tables, one or more for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import age_years
from tidemark.operators import bounce, cdc, dims, logs, orders, pattern, stats, visitors
from tidemark.plans import jobs
from tidemark.schemas import QUARANTINE_TOPIC, Topic
from tidemark.sources import sample_tables as sample
from tidemark.sources.sample_tables import table
from tidemark.sources.staging import stage

Query = Callable[[SparkSession, str], DataFrame]

DAY_MS = 86_400_000
SIX_HOURS_MS = 21_600_000
DIMENSIONS = stats.DIMENSIONS
MEASURES = stats.MEASURES


def in_utc(query: Query) -> Query:
    """Days and texts are those of the session's time zone; the queries use UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def as_of() -> Column:
    return F.lit("2024-01-01").cast("timestamp")


def outputs(raw: DataFrame, topic: str, schema: str) -> DataFrame:
    """The records the log job sends to a topic, read back from their JSON text."""
    sent = jobs.log_outputs(raw).filter(F.col("topic") == topic)
    return sent.select("id", F.from_json("value", schema).alias("out"))


# Logs


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.log_records(table(spark, sf_dir, "events"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.page_table(raw_logs(spark, sf_dir))


def log_repair_new_visitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.repaired_logs(raw_logs(spark, sf_dir)).select("id", "mid", "ts", "is_new")


def log_split_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = (
        "common struct<mid:string,is_new:string>, "
        "start struct<entry:string,loading_time:bigint>, ts bigint"
    )
    sent = outputs(raw_logs(spark, sf_dir), Topic.START, schema)
    return sent.select("id", "out.common.*", "out.start.*", "out.ts")


def log_split_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = (
        "common struct<mid:string,ar:string,ch:string,vc:string,is_new:string>, "
        "page struct<page_id:string,last_page_id:string,during_time:bigint>, ts bigint"
    )
    sent = outputs(raw_logs(spark, sf_dir), Topic.PAGE, schema)
    return sent.select("id", "out.common.*", "out.page.*", "out.ts")


def log_split_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "item string, order string, page_id string"
    sent = outputs(raw_logs(spark, sf_dir), Topic.DISPLAY, schema)
    return sent.select("id", "out.item", F.col("out.order").alias("display_order"), "out.page_id")


def damaged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.damaged_log_records(table(spark, sf_dir, "events"))


def log_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.log_outputs(damaged_logs(spark, sf_dir)).filter(F.col("topic") == QUARANTINE_TOPIC).select("id")


def log_split_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each log, and what is in the texts sent on; quarantined texts are not read."""
    sent = jobs.log_outputs(damaged_logs(spark, sf_dir))
    kept = F.when(F.col("topic") != QUARANTINE_TOPIC, F.col("value"))
    schema = "common struct<mid:string,is_new:string>, page struct<page_id:string>, page_id string, ts bigint"
    read = sent.withColumn("out", F.from_json(kept, schema))
    return read.select(
        "topic", "id", "out.common.mid", "out.ts", "out.common.is_new",
        F.coalesce("out.page.page_id", "out.page_id").alias("page_id"), F.col("value").isNotNull().alias("filled"),
    )


def entry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visitors.entry_pages(pages(spark, sf_dir)).select("id", "mid", "page_id", "ts")


def unique_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = visitors.unique_visits(pages(spark, sf_dir))
    return visits.select("id", "mid", F.date_format("day", "yyyyMMdd").alias("day"), "is_new", "ts")


def bounces_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounce.bounces(pages(spark, sf_dir)).select("id", "mid", "is_new", "page_id", "ts")


def bounces_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    jumps = bounce.bounces(pages(spark, sf_dir), SIX_HOURS_MS)
    return jumps.select("id", "mid", "is_new", "page_id", "ts")


def deeper_page() -> Column:
    """A page reached from another one; an entry page after an entry page is none."""
    return ~visitors.is_entry()


def page_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry pages and whether the device's next page, within six hours, was reached from another one."""
    found = pattern.two_step(
        pages(spark, sf_dir), visitors.is_entry(), deeper_page(), SIX_HOURS_MS, columns=["id", "mid", "ts"], then_columns=["id", "ts", "page_id"]
    )
    return found.select(
        "id", "mid", "ts", "outcome", F.col("next.id").alias("next_id"), F.col("next.ts").alias("next_ts"), F.col("next.page_id").alias("next_page")
    )


def page_view_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.page_view_measures(pages(spark, sf_dir))


def session_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.session_measures(pages(spark, sf_dir))


def pv_uv_sv_uj_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.measures(stage(pages(spark, sf_dir), "pages"), SIX_HOURS_MS)


def visitor_stats_10s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.visitor_stats(stage(pages(spark, sf_dir), "pages")).drop("ts")


def visitor_stats_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_views = stage(pages(spark, sf_dir), "pages")
    return jobs.visitor_stats(page_views, "1 day", SIX_HOURS_MS).drop("ts")


# Orders


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.order_records(table(spark, sf_dir, "orders"))


def detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.detail_records(sample.numbered(table(spark, sf_dir, "lineitem")))


def wide(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    return jobs.order_wide(
        order_records(spark, sf_dir), detail_records(spark, sf_dir), -days * DAY_MS, days * DAY_MS
    )


def order_create_date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = orders.parse_orders(order_records(spark, sf_dir))
    return parsed.select(
        "id", "province_id", "order_status", "user_id", "total_amount",
        "create_time", "create_date", "create_hour", "create_ts",
    )


def order_detail_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = orders.parse_details(detail_records(spark, sf_dir))
    return parsed.select(
        "id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
        "create_time", "split_total_amount", "create_ts",
    )


def _pairs(spark: SparkSession, sf_dir: str, **bounds) -> DataFrame:
    pairs = orders.interval_join(
        orders.parse_orders(order_records(spark, sf_dir)),
        orders.parse_details(detail_records(spark, sf_dir)),
        **bounds,
    )
    return pairs.select(
        F.col("o_id").alias("order_id"),
        F.col("d_id").alias("detail_id"),
        F.col("o_create_ts").alias("order_ts"),
        F.col("d_create_ts").alias("detail_ts"),
    )


def order_interval_join_5ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


def order_interval_join_5d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, lower_ms=-5 * DAY_MS, upper_ms=5 * DAY_MS)


def order_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(spark, sf_dir, 365)


def order_wide_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = sample.users(table(spark, sf_dir, "customer"))
    joined = orders.with_user(wide(spark, sf_dir, 5), users, as_of())
    return joined.select("order_id", "sku_id", "total_amount", "user_id", "user_age", "user_gender")


def order_wide_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")
    filled = jobs.order_wide_dims(
        wide(spark, sf_dir, 365),
        sample.provinces(nation),
        sample.skus(part),
        sample.spus(part),
        sample.trademarks(table(spark, sf_dir, "supplier")),
        sample.categories3(nation),
        unique=True,
    )
    return filled.select(
        "detail_id", "order_id", "province_name", "province_area_code", "province_iso_code",
        "province_3166_2_code", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name",
        "category3_name",
    )


def user_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = sample.users(table(spark, sf_dir, "customer"), all_of_them=True)
    return users.select("id", age_years(F.col("birthday"), as_of()).alias("age"))


def dim_lookup_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    users = sample.users(table(spark, sf_dir, "customer"))
    return dims.get_dim(facts, users, "o_custkey", {"birthday": "birthday", "gender": "gender"})


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.users(table(spark, sf_dir, "customer"))


def dim_lookup_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup in a dimension that is read once and kept."""
    users = dims.Dimension(lambda: _users(spark, sf_dir), refresh="cached", ttl_seconds=60)
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dims.get_dim(facts, users, "o_custkey", {"birthday": "birthday", "gender": "gender"})


def dim_lookup_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup in the newest state of a dimension that is kept as a topic of its changes."""
    rows = dim_latest(spark, sf_dir)
    users = dims.Dimension(lambda: rows.withColumnRenamed("user_id", "id"), refresh="batch")
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dims.get_dim(facts, users, "o_custkey", {"gender": "gender"})


def dim_lookup_invalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup in a kept dimension of which some keys were changed and some deleted; the rest is not read again."""
    users = dims.Dimension(lambda: _users(spark, sf_dir), refresh="cached")
    users.frame()
    customers = table(spark, sf_dir, "customer").withColumn("turn", F.col("c_custkey") % 5)
    keys = customers.filter("turn in (1, 2)").select(F.col("c_custkey").cast("string").alias("id"))
    changed = sample.users(customers.filter("turn = 1"), all_of_them=True).withColumn("gender", F.lit("changed"))
    users.replace(keys, changed)
    # a key may change again
    again = sample.users(customers.filter("c_custkey % 10 = 6"), all_of_them=True).withColumn("gender", F.lit("again"))
    users.replace(again.select("id"), again)
    facts = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dims.get_dim(facts, users, "o_custkey", {"birthday": "birthday", "gender": "gender"})


def dim_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.user_changes(table(spark, sf_dir, "customer")).unionByName(
        sample.later_user_changes(table(spark, sf_dir, "orders"))
    )
    newest = cdc.latest_rows(jobs.routed_changes(raw, sample.routing_rules(spark)))
    gender = F.get_json_object("value", "$.gender")
    return newest.select(F.col("key").alias("user_id"), F.col("id").alias("change_id"), gender.alias("gender"))


def dim_lookup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several customers share a nation and segment; the one with the lowest key counts."""
    segment = F.element_at(
        F.array(*[F.lit(s) for s in ("BUILDING", "MACHINERY", "NONE", "FURNITURE")]),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 30).cast("string").alias("nation"),
        segment.alias("segment"),
    )
    return dims.enrich(
        facts,
        table(spark, sf_dir, "customer"),
        on={"nation": "c_nationkey", "segment": "c_mktsegment"},
        columns={"c_custkey": "c_custkey", "c_name": "c_name"},
        order_by=["c_custkey"],
    )


def order_wide_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial rows of the same lines: each side lacks some lines and some values."""
    lines = sample.numbered(table(spark, sf_dir, "lineitem"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    one = lines.filter("l_linenumber <> 5").select(
        "detail_id",
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_linenumber") % 2 == 0, price).alias("order_price"),
        F.lit(None).cast("string").alias("order_status"),
        F.col("l_partkey").alias("sku_id"),
        F.when(F.col("l_linenumber") == 1, price).alias("split_total_amount"),
    )
    other = lines.filter("l_linenumber <> 3").select(
        "detail_id",
        (F.col("l_orderkey") + 1).alias("order_id"),
        F.col("l_quantity").cast("decimal(18,2)").alias("order_price"),
        F.col("l_linestatus").alias("order_status"),
        (F.col("l_partkey") + 1).alias("sku_id"),
        price.alias("split_total_amount"),
    )
    return orders.merge_order_wide(one, other)


def order_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad_orders = orders.unusable(sample.damaged_records(order_records(spark, sf_dir)), "order")
    bad_details = orders.unusable(sample.damaged_records(detail_records(spark, sf_dir)), "detail")
    kind = lambda df, name: df.select(F.lit(name).alias("kind"), "id")
    return kind(bad_orders, "order").unionByName(kind(bad_details, "detail"))


# Change records


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.order_changes(table(spark, sf_dir, "orders")).unionByName(
        sample.user_changes(table(spark, sf_dir, "customer"))
    )


def cdc_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cdc.clean_cdc(cdc.parse_cdc(changes(spark, sf_dir)))
    return cleaned.select(F.col("table").alias("source_table"), "type", "id")


def cdc_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = cdc.quarantined_cdc(cdc.parse_cdc(sample.damaged_changes(changes(spark, sf_dir))))
    return bad.select("id")


def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = jobs.routed_changes(changes(spark, sf_dir), sample.routing_rules(spark))
    schema = (
        "id string, user_id string, total_amount decimal(18,2), order_status string, "
        "name string, gender string"
    )
    sent = routed.withColumn("out", F.from_json("value", schema))
    return sent.select(
        "sink_type", "sink_table", "sink_pk", F.col("key").alias("record_key"), "out.*"
    )


BATCH_QUERIES: dict[str, Query] = {
    query.__name__: in_utc(query)
    for query in (
        log_repair_new_visitor,
        log_split_start,
        log_split_page,
        log_split_display,
        log_quarantine,
        log_split_damaged,
        entry_pages,
        unique_visits,
        bounces_10s,
        bounces_6h,
        page_pattern,
        page_view_measures,
        session_measures,
        pv_uv_sv_uj_union,
        visitor_stats_10s,
        visitor_stats_1d,
        order_create_date_hour,
        order_detail_parse,
        order_interval_join_5ms,
        order_interval_join_5d,
        order_wide,
        order_wide_user,
        order_wide_dims,
        user_age,
        dim_lookup_id,
        dim_lookup_cached,
        dim_lookup_fresh,
        dim_lookup_invalidated,
        dim_latest,
        dim_lookup_composite,
        order_wide_merge,
        order_quarantine,
        cdc_clean,
        cdc_quarantine,
        cdc_route,
    )
}
