"""Run every query and its SQL side by side: ``python tests/check_oracle.py SF_DIR [name…]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(round(value, 6))
    return value


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    rows = con.execute(sql).fetchall()
    return [c[0] for c in con.description], rows


def compare(spark, sf_dir: str, query, sql: str) -> tuple[int, str]:
    """Row count and a text that is empty when both sides hold the same rows."""
    df = query(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    names, expected = oracle_rows(sf_dir, sql)
    if sorted(df.columns) != sorted(names):
        return len(rows), f"columns {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = multiset(df.columns, rows), multiset(names, expected)
    if mine != theirs:
        return len(rows), (
            f"{len(rows)} rows against {len(expected)}; "
            f"only here {list((mine - theirs).items())[:2]}; "
            f"only there {list((theirs - mine).items())[:2]}"
        )
    return len(rows), ""


def main() -> None:
    import __spark_entry__ as contract
    from bench import session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = session(8)
    spark.sparkContext.setLogLevel("ERROR")
    oracle = contract.oracle_sql()
    bad = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            if name in oracle:
                count, problem = compare(spark, sf_dir, query, oracle[name])
            else:
                count, problem = query(spark, sf_dir).count(), ""
        except Exception as error:  # a broken query must not hide the others
            count, problem = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        state = "ok " if not problem else "BAD"
        print(f"{state} {name} rows={count} {time.time() - begun:.1f}s {problem}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
