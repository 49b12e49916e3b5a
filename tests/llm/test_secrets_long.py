from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import secrets


@pytest.mark.parametrize("size", [0, 1, 255, 256, 257, 512, 513, 70_000])
def test_running_sums(spark, size):
    rows = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(70_000)), lambda x: (x % 7).cast("long")).alias("all"))
    out = rows.select(secrets._running(F.slice("all", F.lit(1), F.lit(size))).alias("s")).first().s
    total, expected = 0, []
    for x in range(1, size + 1):
        total += x % 7
        expected.append(total)
    assert list(out) == expected


def test_many_matches_in_one_text(spark):
    """The time must not grow with the square of the matches."""
    docs = spark.createDataFrame([(1, "password=abcdef1 é " * 200_000), (2, "nothing here")], "doc_id long, text string")
    begun = time.time()
    found, _ = secrets.scan(docs)
    row = found.where("doc_id = 1").select(F.size("found").alias("n"), F.element_at("found", -1).alias("last")).first()
    assert (row.n, row.last.kind, row.last.start, row.last.stop) == (200_000, "assign", 199_999 * 19, 199_999 * 19 + 16)
    assert time.time() - begun < 60
