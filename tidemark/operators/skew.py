"""Joins to a table with one row per key, safe for large tables and hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage

# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 1_000_000

# How many times its files a dimension takes in memory, as rows in a hash table. Measured: 5 MB gave 200 MB and
# more on the driver, of which 34 MB are there for any table.
FILE_EXPANSION = 16

# Rows without a key match nothing; they are spread over this many salts.
UNKEYED_SALTS = 65_536


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate. It is exact for tables read from files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast limit in bytes."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame, expansion: int = 1) -> bool:
    """Whether a table is within the broadcast limit when its rows take ``expansion`` times the estimate."""
    return plan_bytes(df) * expansion <= broadcast_limit(df)


def hot_keys(
    facts: DataFrame,
    on: list[str],
    rows_per_task: int = ROWS_PER_TASK,
    rows: Column | None = None,
) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the number of salts each gets.

    Holds at most ``rows / rows_per_task`` keys, whatever the distribution. ``rows`` gives
    the rows a fact stands for, when the facts are counted already.
    """
    present = facts.dropna("any", subset=on)
    total = F.sum(F.lit(1) if rows is None else rows).alias("_rows")
    counts = present.groupBy(*on).agg(total).filter(F.col("_rows") > rows_per_task)
    return counts.select(*on, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_salts"))


def join_table(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    expansion: int = 1,
) -> DataFrame:
    """Join facts to a table holding at most one row per key of ``on``.

    A table within the session's broadcast limit is left to the optimizer, which sends it
    to the facts. A larger one is joined by a shuffle in which no key is too much for a
    task: with ``hot`` (see :func:`hot_keys`) by salting, otherwise by adaptive execution,
    which splits oversized partitions of the facts. Facts with a null key are spread over
    all tasks. ``expansion`` is how many times the optimizer's estimate the table takes in memory. Facts that are a stream are joined as they come: what a task gets is bounded by the
    micro-batch.
    """
    if facts.isStreaming or fits_broadcast(table, expansion):
        return facts.join(table, on, how)
    if hot is not None:
        return salted_join(facts, table, on, how, hot)
    return split_join(facts, table, on, how)


def salted_join(facts: DataFrame, table: DataFrame, on: list[str], how: str, hot: DataFrame) -> DataFrame:
    """Shuffle join with the facts of a hot key spread over its salts.

    The table row of a hot key is repeated once per salt, all others stay single. The hot keys
    are written out; the optimizer sends them to the facts when their size allows it.
    """
    hot = stage(hot, "hot-keys")
    salts = F.when(_keyless(on), F.lit(UNKEYED_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = facts.join(hot, on, "left").withColumn("_salt", F.pmod(_row_hash(), salts).cast("int")).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = table.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def split_join(facts: DataFrame, table: DataFrame, on: list[str], how: str) -> DataFrame:
    """Shuffle join that adaptive execution can split.

    It splits a partition of the facts only when both sides come straight from a shuffle,
    so a table that is the result of grouping or ranking is written out first.
    """
    unkeyed = F.pmod(_row_hash(), F.lit(UNKEYED_SALTS)).cast("int")
    left = facts.withColumn("_salt", F.when(_keyless(on), unkeyed).otherwise(F.lit(0)))
    # always 0, but no constant: a constant would drop out of the join keys, and the salts with it
    zero = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    right = stage(table, "lookup").withColumn("_salt", zero)
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _keyless(on: list[str]) -> Column:
    missing = F.col(on[0]).isNull()
    for name in on[1:]:
        missing = missing | F.col(name).isNull()
    return missing


def _row_hash() -> Column:
    """A hash of the place of a row in its input, which tells equal rows apart too."""
    return F.xxhash64(F.monotonically_increasing_id())
