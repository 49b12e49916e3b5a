from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    said = {conv: [t[3] for t in sorted(turns)] for conv, turns in said.items()}
    nodes = {}
    for conv, own in said.items():
        h = zlib.crc32(str(conv).encode()) % 9
        first = conv - (abs(conv) % 5) * (1 if conv > 0 else -1)
        path = tuple(said.get(first, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append((conv, len(path) == d))
    out = {}
    for node in sorted(nodes, key=len, reverse=True):
        convs = sorted(nodes[node])
        ends = ",".join(str(c) for c, ended in convs if ended)
        own = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        row = out.setdefault(node, [None, None, None, 0, 0, 0, 0, None])
        row[0], row[1], row[3] = convs[0][0], len(node), len(convs)
        row[2] = min(nodes[node[:-1]])[0] if node else None
        row[5] += not row[4]
        row[6] += own
        row[7] = hashlib.sha256(ends.encode()).hexdigest()
        if node:
            up = out.setdefault(node[:-1], [None, None, None, 0, 0, 0, 0, None])
            up[4] += 1
            up[5] += row[5]
            up[6] += row[6]
    return sorted(map(tuple, out.values()), key=repr)


def found(spark, rows, parts=4):
    return sorted(map(tuple, prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()), key=repr)


def conversations(rng, n, turns, words=2, first=0):
    """Few different texts, so that many prefixes are shared."""
    out = []
    for conv in range(first, first + n):
        for turn in range(rng.randint(1, turns)):
            out.append((conv, turn, rng.choice(["user", "assistant"]), f"é{rng.randrange(words)}"))
    rng.shuffle(out)
    return out


def test_like_brute_force(spark):
    rows = conversations(random.Random(1), 120, 14)
    assert found(spark, rows) == brute(rows)


def test_shards_and_segments(spark, monkeypatch):
    """Prefixes over many shards; conversations over several segments that share them in part."""
    monkeypatch.setattr(prefix_trie, "SHARD_BITS", 2)
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    rng = random.Random(2)
    rows = conversations(rng, 60, 14, words=1)
    for conv in (61, 70, 75, 83, 90):
        rows += [(conv, t, "user", "same") for t in range(rng.choice([6, 7, 20, 21, 24]))]
    rows += [(91, t, "user", "same" if t < 17 else "other") for t in range(30)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (1, None, None, None), (1, 0, "", ""), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
        (None, 1, "user", "lost"), (5, 1, "user", "a"), (7, None, "user", "x"), (12, 3, "user", "no first"),
        (-1, 0, "user", "a"), (-5, 0, "user", "a"), (-7, 0, "user", "a"), (-5, 1, "user", "b"), (0, 0, "user", "a"),
        (2**63 - 1, 0, "user", "a"), (2**63 - 3, 0, "user", "b"), (-(2**63), 0, "user", "c"),
    ]
    assert found(spark, rows) == brute(rows)
    more = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("node", "at", "first", "shard", "p", "length")})
    assert sorted(map(tuple, prefix_trie.trie(more).collect()), key=repr) == brute(rows)


def test_no_conversations(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("copies", [700])
def test_copies_and_long_texts(spark, monkeypatch, copies):
    """One conversation as the most of all rows, over many shards, and a text of a megabyte."""
    monkeypatch.setattr(prefix_trie, "SHARD_BITS", 4)
    rows = [(c * 5, t, "user", f"turn {t}") for c in range(copies) for t in range(3)]
    rows += [(4001, 0, "user", "x" * 1_000_000), (4006, 0, "user", "x" * 1_000_000 + "y")]
    rows += [(4011, t, "user", "again") for t in range(1500)]
    assert found(spark, rows) == brute(rows)


def test_end_lists_are_read_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_BITS", 1)
    rows = [(c * 5 - 500, 0, "user", "hello") for c in range(300)]
    out = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(7))
    [leaf] = [r for r in out.collect() if r.depth == 1]
    assert leaf.n_convs == len({c for c, *_ in rows if zlib.crc32(str(c).encode()) % 9 or True})
    assert found(spark, rows) == brute(rows)
