"""Databases: query scans and batch inserts by column name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BATCH_SIZE = 1000


def scan_options(
    url: str,
    driver: str,
    query: str | None = None,
    table: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    **more: str,
) -> dict[str, str]:
    """Reader options for a query or a table.

    ``split`` is ``(column, lower, upper, parts)`` and makes the scan of a table parallel;
    without it one task reads everything, so give it for any table that is not small.
    """
    if (query is None) == (table is None):
        raise ValueError("name either a query or a table")
    options = {"url": url, "driver": driver, **more}
    if query is not None and split is None:
        options["query"] = query
    else:
        options["dbtable"] = table if table is not None else f"({query}) scan"
    if split is not None:
        column, lower, upper, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options


def scan(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """Rows of a query or table, typed by the database; filters and columns are pushed to it."""
    return spark.read.format("jdbc").options(**scan_options(*args, **kwargs)).load()


def insert_options(
    url: str, driver: str, table: str, batch_size: int = BATCH_SIZE, **more: str
) -> dict[str, str]:
    return {"url": url, "driver": driver, "dbtable": table, "batchsize": str(batch_size), **more}


def insert_columns(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """The columns to insert: all but the excluded ones, matched to the table by name."""
    return df.drop(*(exclude or []))


def table_sink(
    url: str,
    driver: str,
    table: str,
    exclude: list[str] | None = None,
    batch_size: int = BATCH_SIZE,
    **more: str,
) -> Callable[[DataFrame, int], None]:
    """A micro-batch sink appending to a table. A retried batch is appended again."""
    options = insert_options(url, driver, table, batch_size, **more)

    def insert(df: DataFrame, batch_id: int) -> None:
        rows = insert_columns(df, exclude)
        rows.write.format("jdbc").options(**options).mode("append").save()

    return insert
