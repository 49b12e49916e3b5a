"""Parallel scans of a database table without bounds given by hand.

The store itself counts rows by ranges of a column, coarsely first, and again inside ranges that hold too
many, so parts come out about equal also where values are skewed. What travels is counts, never rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import jdbc

# Ranges asked for at once, and how often a range may be cut again.
RANGES = 64
ROUNDS = 8

ROWS_PER_PART = 1_000_000

# Counts of rows by range: given (low, high, width), rows (range number, count); low and high belong to them.
Counts = Callable[[int, int, int], list[tuple[int, int]]]


def range_query(table: str, column: str, low: int, high: int, width: int) -> str:
    """How many rows of ``low <= column <= high`` fall into each range of ``width`` values."""
    number = f"floor(({column} - ({low})) / {width})"
    return (
        f"select {number} as part, count(*) as n from {table} "
        f"where {column} >= {low} and {column} <= {high} group by {number}"
    )


def edge_query(table: str, column: str) -> str:
    """The ends of the column, to the whole number."""
    return f"select floor(min({column})) as low, ceil(max({column})) as high from {table}"


def _cut(counts: Counts, low: int, high: int, rows_per_part: int, rounds: int) -> list[tuple[int, int, int]]:
    """Consecutive ranges ``(low, high, rows)``, ends included, that hold no more rows than asked for.

    A single value with more rows is a range of its own.
    """
    width = max(1, -(-(high - low + 1) // RANGES))
    out: list[tuple[int, int, int]] = []
    for number, n in sorted((int(number), int(n)) for number, n in counts(low, high, width)):
        begin = low + number * width
        end = min(high, begin + width - 1)
        if n > rows_per_part and width > 1 and rounds > 1:
            out += _cut(counts, begin, end, rows_per_part, rounds - 1)
        else:
            out.append((begin, end, n))
    return out


def starts(counts: Counts, low: int, high: int, rows_per_part: int = ROWS_PER_PART) -> list[int]:
    """The first values of all parts but the first: neighbouring ranges together hold about ``rows_per_part``."""
    out: list[int] = []
    held = 0
    before: int | None = None
    for begin, end, n in _cut(counts, low, high, rows_per_part, ROUNDS):
        if before is not None and held + n > rows_per_part:
            out.append(begin)
            held = 0
        # what comes behind a value that fills a part alone begins a part too
        held, before = held + n, end
    return out


def predicates(column: str, firsts: list[int]) -> list[str]:
    """One condition a part. Together they hold every row once: nulls in the first, and both ends are open,
    so rows that come while the scan is prepared are read as well."""
    if not firsts:
        return [f"{column} is null or {column} is not null"]
    out = [f"{column} < {firsts[0]} or {column} is null"]
    out += [f"{column} >= {low} and {column} < {high}" for low, high in zip(firsts, firsts[1:])]
    return [*out, f"{column} >= {firsts[-1]}"]


def plan_parts(
    edges: tuple[int | None, int | None], counts: Counts, column: str, rows_per_part: int = ROWS_PER_PART
) -> list[str]:
    """The predicates of a scan, from the ends the store reports; an empty table or one of nulls is one part."""
    low, high = edges
    if low is None or high is None:
        return predicates(column, [])
    return predicates(column, starts(counts, int(low), int(high), rows_per_part))


def scan(
    spark: SparkSession, url: str, driver: str, table: str, column: str, rows_per_part: int = ROWS_PER_PART, **more: str
) -> DataFrame:
    """A whole table in parallel, by ranges of a numeric column that need not be unique, dense or even."""

    def ask(query: str) -> list[tuple]:
        return [tuple(row) for row in jdbc.scan(spark, url, driver, query=query, **more).collect()]

    # one row, and at most RANGES rows for each range with too many
    edges = ask(edge_query(table, column))[0]
    parts = plan_parts(edges, lambda *bounds: ask(range_query(table, column, *bounds)), column, rows_per_part)
    return spark.read.jdbc(url, table, predicates=parts, properties={"driver": driver, **more})
