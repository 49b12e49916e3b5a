from __future__ import annotations

import tempfile

import pytest

from tidemark.operators.dims import Dimension, get_dim
from tidemark.sources import files
from tidemark.sources.upserts import KeyedTable

USER = "id string, name string"


@pytest.fixture
def source(spark):
    class Source:
        reads = 0
        rows = [(str(i), f"n{i}") for i in range(10)]

        def read(self):
            self.reads += 1
            return spark.createDataFrame(self.rows, USER)

    return Source()


def names(dim):
    return {r.id: r.name for r in dim.frame().collect()}


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_single_keys_are_replaced_without_reading_the_source(spark, source):
    dim = Dimension(source.read, refresh="cached")
    assert names(dim)["3"] == "n3"
    source.rows = []
    dim.replace(keys(spark, "3", "4", "new", None), spark.createDataFrame([("3", "x"), ("new", "y"), ("5", "not asked")], USER))
    expected = {str(i): f"n{i}" for i in range(10) if i not in (3, 4)} | {"3": "x", "new": "y"}
    assert names(dim) == expected
    dim.replace(keys(spark, "new", "4"), spark.createDataFrame([("4", "back")], USER))
    del expected["new"]
    assert names(dim) == expected | {"4": "back"}
    assert source.reads == 1
    dim.invalidate()
    assert names(dim) == {} and source.reads == 2


def test_overlay_is_merged_at_its_bound(spark, source):
    dim = Dimension(source.read, refresh="cached", overlay_rows=3)
    names(dim)
    for i in range(6):
        dim.replace(keys(spark, str(i)), spark.createDataFrame([(str(i), "new")], USER))
        assert dim._keys is None or dim._keys.count() <= 3
    assert names(dim) == {str(i): "new" if i < 6 else f"n{i}" for i in range(10)}
    assert source.reads == 1


def test_replacing_before_the_first_use_does_nothing(spark, source):
    dim = Dimension(source.read, refresh="cached")
    dim.replace(keys(spark, "1"), spark.createDataFrame([], USER))
    assert len(names(dim)) == 10


def test_an_unchanged_source_is_never_read_again(spark, source):
    version = [1]
    dim = Dimension(source.read, refresh="version", version=lambda: version[0], ttl_seconds=0)
    facts = spark.createDataFrame([("1",), ("x",)], "user string")
    for _ in range(4):  # as in four micro-batches
        assert sorted(r.name or "" for r in get_dim(facts, dim, "user", {"name": "name"}).collect()) == ["", "n1"]
    assert source.reads == 1
    source.rows, version[0] = [("x", "nx")], 2
    for _ in range(3):
        assert names(dim) == {"x": "nx"}
    assert source.reads == 2


def test_versions_of_tables(spark):
    root = tempfile.mkdtemp(prefix="run-versions-")
    table = KeyedTable(f"{root}/t", "key string, id long", ["key"], ["id"])
    reads = []

    def read():
        reads.append(1)
        return table.read(spark).withColumnRenamed("key", "name")

    dim = Dimension(read, refresh="version", version=lambda: table.version(spark), key="name")
    table.sink()(spark.createDataFrame([("a", 1)], "key string, id long"), 0)
    assert [r.id for r in dim.frame().collect()] == [1]
    dim.frame().collect()
    assert len(reads) == 1
    table.sink()(spark.createDataFrame([("a", 2)], "key string, id long"), 1)
    assert [r.id for r in dim.frame().collect()] == [2] and len(reads) == 2
    before = files.version(spark, root)
    assert files.version(spark, root) == before
    table.sink()(spark.createDataFrame([("b", 2)], "key string, id long"), 2)
    assert files.version(spark, root) != before


def test_settings_are_checked(source):
    with pytest.raises(ValueError):
        Dimension(source.read, refresh="sometimes")
    with pytest.raises(ValueError):
        Dimension(source.read, refresh="version")
