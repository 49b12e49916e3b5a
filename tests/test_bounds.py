from __future__ import annotations

import math
import random
from collections import Counter

import duckdb
import pytest

from tidemark.sources import bounds


def store(values):
    """A store that answers the very queries a scan asks, without a server."""
    con = duckdb.connect()
    con.execute("create table t (v double)")
    if values:
        con.executemany("insert into t values (?)", [(v,) for v in values])
    asked = []

    def counts(*args):
        asked.append(args)
        return con.execute(bounds.range_query("t", "v", *args)).fetchall()

    return con, counts, asked


def parts_of(values, rows_per_part):
    con, counts, asked = store(values)
    edges = con.execute(bounds.edge_query("t", "v")).fetchone()
    conditions = bounds.plan_parts(edges, counts, "v", rows_per_part)
    sizes = [con.execute(f"select count(*) from t where {c}").fetchone()[0] for c in conditions]
    assert sum(sizes) == len(values)
    once = " + ".join(f"coalesce(({c})::int, 0)" for c in conditions)
    assert con.execute(f"select count(*) from t where {once} <> 1").fetchone()[0] == 0
    return conditions, sizes, asked, con


@pytest.mark.parametrize("seed", range(6))
def test_every_row_is_in_one_part_and_no_part_is_large(seed):
    rng = random.Random(seed)
    spread = [rng.randrange(-(10**12), 10**12), 1.5, 10**15]
    values = [int(rng.lognormvariate(10, 3)) for _ in range(800)] + [rng.choice(spread) for _ in range(40)]
    values += [5] * 500 + [None] * 30
    conditions, sizes, asked, _ = parts_of(values, 100)
    most = Counter(v if v is None else math.floor(v) for v in values)
    # a part is larger only by the nulls, or by one value that is
    assert all(n <= 130 for n in sizes if n < 500)
    assert sum(n > 130 for n in sizes) <= 1 and max(sizes) <= most[5] + 130
    assert len(conditions) <= 2 * len(values) / 100 + 3
    assert all(high >= low and width >= 1 for low, high, width in asked)


def test_rows_outside_the_reported_ends_are_read():
    """Rows written between the two questions and the scan."""
    conditions, _, _, con = parts_of(list(range(100)), 10)
    con.execute("insert into t values (-50), (1000), (null), (1e18)")
    assert sum(con.execute(f"select count(*) from t where {c}").fetchone()[0] for c in conditions) == 104


@pytest.mark.parametrize("values", [[], [None, None], [7], [7] * 50, [-3, -3, -2]])
def test_small_tables(values):
    conditions, sizes, _, _ = parts_of(values, 10)
    assert len(conditions) <= 2


def test_even_tables_ask_once():
    conditions, sizes, asked, _ = parts_of(list(range(6400)), 640)
    assert len(asked) == 1 and 9 <= len(conditions) <= 12
