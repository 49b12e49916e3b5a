from __future__ import annotations

import hashlib
import zlib

import pytest

from tidemark.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc, text):
    doc_id, _, lang, source, n_chars = doc
    return h(*map(field, (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """All levels of a tree, by the plainest way."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def siblings(levels, at):
    """For each level: the others of the run, in two halves."""
    out = []
    for level in levels[:-1]:
        first = at // 8 * 8
        out.append((level[first:at], level[at + 1 : first + 8]))
        at //= 8
    return out


def brute(docs):
    trees = {}
    for doc in docs:
        trees.setdefault(doc[2], []).append((doc[0] is not None, doc[0] or 0, leaf_of(doc, doc[1]), doc))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    lows = {lang: climb([row[2] for row in sorted(trees[lang], key=lambda r: r[:3])]) for lang in names}
    high = climb([lows[lang][-1][0] for lang in names])
    root, out = high[-1][0], []
    for n, lang in enumerate(names):
        for at, (_, _, leaf, doc) in enumerate(sorted(trees[lang], key=lambda r: r[:3])):
            path = siblings(lows[lang], at) + siblings(high, n)
            node = leaf
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 3 == 0 and doc[1] is not None:
                small = "".join(c.lower() if "A" <= c <= "Z" else c for c in doc[1])
                node = leaf_of(doc, small)
            for before, behind in path:
                node = h(*before, node, *behind)
            proof = h(*[d for before, behind in path for d in before + behind])
            out.append((doc[0], leaf, lows[lang][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r)[:7] for r in df.collect()], key=repr)


def as_docs(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_like_brute_force(documents):
    assert found(merkle.manifest(documents)) == brute(as_docs(documents))


def test_odd_rows(odd_documents):
    rows = found(merkle.manifest(odd_documents))
    assert rows == brute(as_docs(odd_documents))
    assert len(rows) == odd_documents.count()


def test_no_documents(no_documents):
    assert merkle.manifest(no_documents).count() == 0


@pytest.mark.parametrize("depth", [1, 2])
def test_several_superblocks(spark, monkeypatch, depth):
    """More levels than a superblock has, last runs of one, trees of one leaf, and many trees."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "WIDTH", 8**depth)
    docs = [(i, f"Text {i} É", "en", "s", i) for i in range(8**3 + 1)]
    docs += [(i, "A", f"lang{i % 70}", None, 1) for i in range(600, 750)] + [(9000, "Z", None, "s", None)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(merkle.manifest(rows.repartition(5))) == brute(docs)


def test_one_document(spark):
    docs = [(3, "One", "en", "s", 3)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    [row] = merkle.manifest(rows).collect()
    assert row.leaf == row.subroot == row.root
    assert row.proof_sha256 == h("")
    assert found(merkle.manifest(rows)) == brute(docs)


def test_long_text(spark):
    docs = [(0, "A" * 2_000_000, "en", "s", 1), (1, "é" * 300_000, "en", "s", 1), (6, "ABC" * 500_000, "de", "s", 1)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    assert found(merkle.manifest(rows)) == brute(docs)


def test_one_row_repeated_is_spread(spark, monkeypatch):
    """Equal rows differ in nothing the sort could use, and still do not go to one task."""
    from tidemark.llm.ranks import in_order, part

    rows = spark.range(4000).selectExpr("1L as doc_id", "'x' as digest").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = in_order(rows, ["doc_id", "digest"], "test")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = [r["count"] for r in ordered.groupBy(part()).count().collect()]
    assert len(counts) == 4 and max(counts) < 2000


def test_fold_rejects_other_proofs():
    levels = climb([h(str(i)) for i in range(20)])
    paths, shapes = merkle.proofs(levels, "", "")
    assert all(merkle.fold(n, p, s) == levels[-1][0] for n, p, s in zip(levels[0], paths, shapes))
    assert merkle.fold(levels[0][0], paths[1], shapes[1]) != levels[-1][0]
