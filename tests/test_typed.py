from __future__ import annotations

from decimal import Decimal

from tidemark.operators import typed

SCHEMA = "a bigint, `b c` decimal(5,2), t timestamp, ok boolean, s struct<x:int>, l array<string>"

GOOD = [
    ('{"a":1,"b c":2.5,"t":"2024-01-01 00:00:01","ok":true,"s":{"x":3},"l":["q"]}', 1),
    ('{"a":"7","b c":"1","ok":"false"}', 7),
    ('{"a":1.9}', 1),
    ("{}", None),
    (' {"z":{"a":5}} ', None),
    ('{"a":null,"s":null}', None),
]
BAD = {
    '{"a":"x"}': ["a"],
    '{"a":{"k":1},"b c":12345.6}': ["a", "b c"],
    '{"t":"soon","ok":"maybe"}': ["t", "ok"],
    '{"s":[1],"l":{"x":1}}': ["s", "l"],
    '{"a":1} {"a":2}': [],
    '{"a":1': [],
    "[]": [],
    "null": [],
    '"text"': [],
    "": [],
    None: [],
}


def parsed(spark):
    texts = [t for t, _ in GOOD] + list(BAD)
    return typed.typed(spark.createDataFrame(list(enumerate(texts)), "id long, value string"), SCHEMA)


def test_rows(spark):
    rows = typed.rows(parsed(spark))
    assert rows.columns == ["a", "b c", "t", "ok", "s", "l"]
    got = rows.collect()
    assert sorted(str(r.a) for r in got) == sorted(str(a) for _, a in GOOD)
    [full] = [r for r in got if r.l]
    assert (full["b c"], full.ok, full.s.x, full.l) == (Decimal("2.50"), True, 3, ["q"])


def test_unreadable_records_are_kept_whole(spark):
    bad = typed.unreadable(parsed(spark)).collect()
    assert sorted((r.value or "") for r in bad) == sorted(t or "" for t in BAD)
    assert {r.topic for r in bad} == {"quarantine"}
    named = {r.value: list(r.bad) for r in parsed(spark).collect() if r.value in BAD}
    assert named == BAD


def test_texts_are_parsed_once(spark):
    plan = typed.rows(parsed(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat([, value") == 1
