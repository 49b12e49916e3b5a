"""Database change records: cleaning and rule-driven routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.records import json_null_free, parse_json
from tidemark.operators.skew import hot_keys, join_table
from tidemark.schemas import QUARANTINE_TOPIC

OBJECT = "map<string,variant>"

# The members of a change record; ``data`` is read as text.
CHANGE = "table string, type string, data string"


def parse_cdc(raw: DataFrame) -> DataFrame:
    """Change records from ``(id, value)``: ``table``, ``type``, and ``data`` by member.

    ``data`` may be an object, or a text holding one.
    """
    parsed = parse_json(raw.select("id", "value"), CHANGE)
    # behind a generator too, else the filters parse the data again
    data = F.inline(F.array(F.struct(F.from_json("data", OBJECT).alias("data"))))
    return parsed.select(*(c for c in parsed.columns if c != "data"), data)


def latest_rows(routed: DataFrame) -> DataFrame:
    """The newest row of each key of each sink table: ``(sink_table, key, id, value)``.

    Changes are ordered by ``id``. The state of a dimension whose changes were only appended; one aggregate
    that combines before the shuffle. Changes without a key have no row.
    """
    newest = F.max(F.struct("id", "value")).alias("newest")
    rows = routed.filter(F.col("key").isNotNull()).groupBy("sink_table", "key").agg(newest)
    return rows.select("sink_table", "key", "newest.*")


def quarantined_cdc(changes: DataFrame) -> DataFrame:
    """The texts ``(topic, id, value)`` that are no change records at all.

    A record without table or data is left out by :func:`clean_cdc` on purpose and is none of these.
    """
    nothing = F.col("table").isNull() & F.col("type").isNull() & F.col("data").isNull()
    return changes.filter(nothing).select(F.lit(QUARANTINE_TOPIC).alias("topic"), "id", "value")


def clean_cdc(changes: DataFrame) -> DataFrame:
    """Keep changes that name a table and have at least one non-null data member."""
    members = F.coalesce(F.size(json_null_free(F.col("data"))), F.lit(0))
    return changes.filter(F.col("table").isNotNull() & (members > 0))


def route_cdc(
    changes: DataFrame, rules: DataFrame, rows_per_task: int | None = None
) -> DataFrame:
    """Send each cleaned change where the rule for its table and operation says.

    Gives ``(sink_type, sink_table, sink_pk, key, id, value)``: ``value`` is the JSON text
    of the members named in ``sink_columns`` (all members when none are named), ``key`` the
    text of the ``sink_pk`` member. Changes without a rule are dropped. ``rules`` has one
    row per table and operation. Rules too many to send to the changes are joined as in
    ``join_table``, with ``rows_per_task`` by counting the changes and salting.
    """
    table = rules.select(
        F.col("source_table").alias("table"),
        F.col("operate_type").alias("type"),
        "sink_type",
        "sink_table",
        "sink_pk",
        F.transform(F.split("sink_columns", ","), lambda c: F.trim(c)).alias("_wanted"),
    )
    on = ["table", "type"]
    hot = None if rows_per_task is None else hot_keys(changes, on, rows_per_task)
    joined = join_table(changes, table, on, "inner", hot)
    kept = F.map_filter(
        json_null_free(F.col("data")),
        lambda k, v: F.col("_wanted").isNull() | F.array_contains(F.col("_wanted"), k),
    )
    key = F.try_variant_get(F.try_element_at("data", F.col("sink_pk")), "$", "string")
    return joined.select(
        "sink_type", "sink_table", "sink_pk", key.alias("key"), "id", F.to_json(kept).alias("value")
    )
