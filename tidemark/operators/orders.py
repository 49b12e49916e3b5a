"""Orders and their details: parsing, interval join, wide rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import age_years, event_time, first_non_null, second_millis
from tidemark.operators.dims import Dimension, enrich
from tidemark.operators.records import parse_fields
from tidemark.schemas import DETAIL_FIELDS, ORDER_FIELDS, ORDER_WIDE_FIELDS, QUARANTINE_TOPIC

LOWER_MS = -5
UPPER_MS = 5
WATERMARK = "3 seconds"

# Columns a wide row takes from its order and from its detail: wide column -> source column.
FROM_ORDER = {
    "order_id": "id",
    "order_status": "order_status",
    "create_time": "create_time",
    "create_date": "create_date",
    "create_hour": "create_hour",
    "activity_reduce_amount": "activity_reduce_amount",
    "coupon_reduce_amount": "coupon_reduce_amount",
    "original_total_amount": "original_total_amount",
    "feight_fee": "feight_fee",
    "total_amount": "total_amount",
    "province_id": "province_id",
    "user_id": "user_id",
    "expire_time": "expire_time",
    "operate_time": "operate_time",
}
FROM_DETAIL = {
    "detail_id": "id",
    "sku_id": "sku_id",
    "sku_name": "sku_name",
    "order_price": "order_price",
    "sku_num": "sku_num",
    "split_activity_amount": "split_activity_amount",
    "split_coupon_amount": "split_coupon_amount",
    "split_total_amount": "split_total_amount",
}

# Columns for which the merge of two partial wide rows takes the first non-null value.
MERGED = [
    "order_status",
    "create_time",
    "create_date",
    "coupon_reduce_amount",
    "activity_reduce_amount",
    "original_total_amount",
    "feight_fee",
    "total_amount",
    "user_id",
    "sku_id",
    "sku_name",
    "order_price",
    "sku_num",
    "split_activity_amount",
    "split_coupon_amount",
    "split_total_amount",
]


def parse_orders(raw: DataFrame) -> DataFrame:
    """Orders from records ``(…, value)``, with ``create_ts``, ``create_date``, ``create_hour``.

    Date and hour are taken from ``create_time`` unless the record has them.
    """
    orders = parse_fields(raw.select("value"), ORDER_FIELDS).drop("value")
    created = event_time(F.col("create_ts"))
    return orders.withColumn("create_ts", second_millis(F.col("create_time"))).withColumns(
        {
            "create_date": F.coalesce("create_date", F.date_format(created, "yyyy-MM-dd")),
            "create_hour": F.coalesce("create_hour", F.date_format(created, "HH")),
        }
    )


def parse_details(raw: DataFrame) -> DataFrame:
    """Order details from records ``(…, value)``, with ``create_ts``."""
    details = parse_fields(raw.select("value"), DETAIL_FIELDS).drop("value")
    return details.withColumn("create_ts", second_millis(F.col("create_time")))


def unusable(raw: DataFrame, kind: str) -> DataFrame:
    """The records ``(topic, id, value)`` that no order or detail can be made of, for quarantine.

    ``kind`` is ``order`` or ``detail``. An order needs its id, a detail its order's, and both a
    ``create_time`` in seconds; the join leaves out all others.
    """
    parse, key = {"order": (ORDER_FIELDS, "id"), "detail": (DETAIL_FIELDS, "order_id")}[kind]
    needed = {key: parse[key], "create_time": parse["create_time"]}
    renamed = raw.select(F.col("id").alias("record_id"), "value")
    read = parse_fields(renamed, needed)
    bad = F.col(key).isNull() | second_millis(F.col("create_time")).isNull()
    return read.filter(bad).select(F.lit(QUARANTINE_TOPIC).alias("topic"), F.col("record_id").alias("id"), "value")


def interval_join(
    orders: DataFrame,
    details: DataFrame,
    lower_ms: int = LOWER_MS,
    upper_ms: int = UPPER_MS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """All pairs of order and detail with ``detail.create_ts`` in the order's interval.

    The interval is ``[order.create_ts + lower_ms, order.create_ts + upper_ms]``, both ends
    included. Columns come back as ``o_*`` and ``d_*``. Works on tables and on streams.

    Besides the order id the join has a time cell as key: a detail is in one cell, an order
    in the one or two cells its interval touches. So a pair meets once, an id holding a large
    part of the rows is spread over its cells, and pairs far apart in time are never formed.

    Tables are joined by a shuffle: the optimizer's estimate of parsed records is far below their size, and
    by it all orders would be sent through the driver.
    """
    return joined_sides(*timed_sides(orders, details, watermark), lower_ms, upper_ms)


def timed_sides(orders: DataFrame, details: DataFrame, watermark: str = WATERMARK) -> tuple[DataFrame, DataFrame]:
    """The orders as ``o_*`` and the details as ``d_*`` that an interval join takes, with their times ``et``; streams with a watermark."""

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        timed = df.filter(F.col("create_ts").isNotNull()).withColumn(
            "et", event_time(F.col("create_ts"))
        )
        if df.isStreaming:
            timed = timed.withWatermark("et", watermark)
        return timed.select(*[F.col(c).alias(f"{prefix}{c}") for c in timed.columns])

    left = prefixed(orders.filter(F.col("id").isNotNull()), "o_")
    return left, prefixed(details.filter(F.col("order_id").isNotNull()), "d_")


def joined_sides(left: DataFrame, right: DataFrame, lower_ms: int, upper_ms: int) -> DataFrame:
    """The pairs of :func:`interval_join` of two sides, which may have columns of their own besides."""
    cell = max(2 * (upper_ms - lower_ms), 1000)

    def cell_of(ts: Column) -> Column:
        # Cells start at half seconds, so short intervals around whole seconds are in one.
        shifted = ts + cell // 2
        return shifted - F.pmod(shifted, F.lit(cell))

    first = cell_of(F.col("o_create_ts") + lower_ms)
    last = cell_of(F.col("o_create_ts") + upper_ms)
    left = left.withColumn("o_cell", F.explode(F.sequence(first, last, F.lit(cell).cast("bigint"))))
    right = right.withColumn("d_cell", cell_of(F.col("d_create_ts")))
    if not (left.isStreaming or right.isStreaming):
        left = left.hint("merge")

    return left.join(
        right,
        (F.col("o_id") == F.col("d_order_id"))
        & (F.col("o_cell") == F.col("d_cell"))
        & (F.col("d_et") >= F.col("o_et") + F.expr(f"interval {lower_ms} milliseconds"))
        & (F.col("d_et") <= F.col("o_et") + F.expr(f"interval {upper_ms} milliseconds")),
    ).drop("o_cell", "d_cell")


def order_wide(pairs: DataFrame) -> DataFrame:
    """Wide rows of joined pairs, in table layout; what no side fills is a typed null."""
    filled = {w: F.col(f"o_{c}") for w, c in FROM_ORDER.items()}
    filled |= {w: F.col(f"d_{c}") for w, c in FROM_DETAIL.items()}
    return pairs.select(
        *[
            filled.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in ORDER_WIDE_FIELDS.items()
        ]
    )


def order_wide_values(wide: DataFrame) -> DataFrame:
    """Wide rows as records ``(id, value)``."""
    return wide.select(F.col("detail_id").alias("id"), F.to_json(F.struct("*")).alias("value"))


def with_user(
    wide: DataFrame,
    users: DataFrame | Dimension,
    as_of: Column | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Fill age and gender from the user dimension ``(id, birthday, gender)``."""
    return enrich(
        wide,
        users,
        on={"user_id": "id"},
        columns={
            "user_age": lambda d: age_years(d("birthday"), as_of),
            "user_gender": lambda d: d("gender"),
        },
        rows_per_task=rows_per_task,
    )


def with_province(
    wide: DataFrame,
    provinces: DataFrame | Dimension,
    unique: bool = False,
    rows_per_task: int | None = None,
) -> DataFrame:
    return enrich(
        wide,
        provinces,
        on={"province_id": "id"},
        columns={
            "province_name": "name",
            "province_area_code": "area_code",
            "province_iso_code": "iso_code",
            "province_3166_2_code": "iso_3166_2",
        },
        unique=unique,
        rows_per_task=rows_per_task,
    )


def with_sku(wide: DataFrame, skus: DataFrame | Dimension) -> DataFrame:
    return enrich(
        wide,
        skus,
        on={"sku_id": "id"},
        columns={"spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id"},
    )


def with_spu(wide: DataFrame, spus: DataFrame | Dimension) -> DataFrame:
    return enrich(wide, spus, on={"spu_id": "id"}, columns={"spu_name": "spu_name"})


def with_trademark(wide: DataFrame, trademarks: DataFrame | Dimension) -> DataFrame:
    return enrich(wide, trademarks, on={"tm_id": "id"}, columns={"tm_name": "tm_name"})


def with_category3(wide: DataFrame, categories: DataFrame | Dimension) -> DataFrame:
    return enrich(wide, categories, on={"category3_id": "id"}, columns={"category3_name": "name"})


def sku_details(
    skus: DataFrame | Dimension,
    spus: DataFrame | Dimension,
    trademarks: DataFrame | Dimension,
    categories3: DataFrame | Dimension,
    unique: bool = False,
) -> DataFrame:
    """The sku dimension with the names of its spu, trademark and category, joined on the small side."""
    base = skus.frame() if isinstance(skus, Dimension) else skus
    names = {c: F.lit(None).cast("string") for c in ("spu_name", "tm_name", "category3_name")}
    table = base.select("id", "spu_id", "tm_id", "category3_id").withColumns(names)
    table = enrich(table, spus, {"spu_id": "id"}, {"spu_name": "spu_name"}, unique=unique)
    table = enrich(table, trademarks, {"tm_id": "id"}, {"tm_name": "tm_name"}, unique=unique)
    return enrich(table, categories3, {"category3_id": "id"}, {"category3_name": "name"}, unique=unique)


SKU_COLUMNS = ["spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]


def with_sku_details(
    wide: DataFrame, details: DataFrame, unique: bool = False, rows_per_task: int | None = None
) -> DataFrame:
    """Fill all columns that hang on the sku by one lookup, see :func:`sku_details`."""
    columns = {c: c for c in SKU_COLUMNS}
    return enrich(wide, details, {"sku_id": "id"}, columns, unique=unique, rows_per_task=rows_per_task)


def merge_order_wide(one: DataFrame, other: DataFrame) -> DataFrame:
    """Merge partial wide rows of the same detail: first non-null value of the ``MERGED`` columns.

    A row found on one side only is kept; the other columns stay those of ``one``. ``detail_id`` is the primary key of both sides.
    Rows without one match nothing and are spread over the tasks by their content.
    """
    theirs = [c for c in other.columns if c != "detail_id"]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        content = F.xxhash64(*[c for c in df.columns if c != "detail_id"])
        spread = F.when(F.col("detail_id").isNull(), content).otherwise(F.lit(0))
        return df.select(
            F.col("detail_id"),
            spread.alias("_spread"),
            F.lit(True).alias(f"{prefix}found"),
            *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c != "detail_id"],
        )

    def merged(name: str) -> Column:
        if name == "detail_id":
            return F.col(name)
        mine, their = F.col(f"a_{name}"), F.col(f"b_{name}")
        if name not in theirs:
            return mine.alias(name)
        if name in MERGED:
            return first_non_null(mine, their).alias(name)
        return F.when(F.col("a_found"), mine).otherwise(their).alias(name)

    joined = side(one, "a_").join(side(other, "b_"), ["detail_id", "_spread"], "full")
    return joined.select(*[merged(name) for name in one.columns])
