"""Manifest of a table as a Merkle tree: roots, proofs, and what a changed row folds to.

Rows are leaves. Each language has a tree of its own, the roots of these trees are the leaves of the
top tree. A tree is cut into superblocks of ``WIDTH`` consecutive leaves, which is ``DEPTH`` levels.
On the way up each superblock is reduced to its node alone, and the nodes are the leaves of the next,
``WIDTH`` times smaller table, until every tree is one node. On the way down the nodes of a superblock
meet, by cogroup, the one outer row that leads from it to the root; there its inner levels are made
again, joined with the outer proof, and the leaves are folded. Only digests travel, never texts.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import in_order, part, pieces, place
from tidemark.operators.skew import join_table
from tidemark.sources.staging import stage

ARITY = 8
DEPTH = 4
WIDTH = ARITY**DEPTH

_DIGEST = 64  # hex digits
_TOP = ""  # the key of the top tree; those of the languages are never empty

_NODES = "tree string, idx long, total long, digest string"
_OUTER = "tree string, idx long, proof string, shape string, subroot string, root string"
_PROVEN = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
    "verified boolean, proof_nodes int"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value behind its length, so that no two rows are the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def tampered() -> Column:
    """Whether the check changes the row: a third of the documents, never those without a number."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """A-Z made small, and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def inner_levels(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of one superblock of a tree with ``total`` nodes, from ``nodes`` to what is sent up.

    A tree of several superblocks has the full number of levels in each, also in a last one with few nodes.
    """
    levels = [nodes]
    while len(levels) <= DEPTH and (total > WIDTH or len(levels[-1]) > 1):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return levels


def proofs(levels: list[list[str]], proof: str, shape: str) -> tuple[list[str], list[str]]:
    """Proof and shape of each node of the lowest level, given those of the superblock's node.

    A proof is the siblings in a row, level by level. Its shape has two digits a level: how many
    siblings stand before the node, and how many in all.
    """
    paths, shapes = [proof] * len(levels[-1]), [shape] * len(levels[-1])
    for level in levels[-2::-1]:
        up, up_shapes, paths, shapes = paths, shapes, [], []
        for first in range(0, len(level), ARITY):
            run = level[first : first + ARITY]
            for at in range(len(run)):
                paths.append("".join(run[:at] + run[at + 1 :]) + up[first // ARITY])
                shapes.append(f"{at}{len(run) - 1}{up_shapes[first // ARITY]}")
    return paths, shapes


def fold(node: str, proof: str, shape: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for level in range(0, len(shape), 2):
        middle = at + _DIGEST * int(shape[level])
        end = at + _DIGEST * int(shape[level + 1])
        node = digest(proof[at:middle] + node + proof[middle:end])
        at = end
    return node


def _send_up(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("idx")
    total = int(nodes["total"].iloc[0])
    top = inner_levels(nodes["digest"].tolist(), total)[-1]
    return pd.DataFrame({"tree": [key[0]], "idx": [key[1]], "total": [-(-total // WIDTH)], "digest": top})


def _send_down(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes, outer = nodes.sort_values("idx"), outer.iloc[0]
    levels = inner_levels(nodes["digest"].tolist(), int(nodes["total"].iloc[0]))
    paths, shapes = proofs(levels, outer["proof"], outer["shape"])
    return pd.DataFrame({
        "tree": key[0], "idx": nodes["idx"].to_numpy(), "proof": paths, "shape": shapes,
        "subroot": outer["subroot"], "root": outer["root"],
    })


def _prove(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    leaves, outer = leaves.sort_values("idx"), outer.iloc[0]
    originals = leaves["digest"].tolist()
    levels = inner_levels(originals, int(leaves["total"].iloc[0]))
    paths, shapes = proofs(levels, outer["proof"], outer["shape"])
    folded = [fold(node, path, shape) for node, path, shape in zip(leaves["changed"], paths, shapes)]
    return pd.DataFrame({
        "doc_id": leaves["doc_id"].astype("Int64").to_numpy(), "leaf": originals,
        "subroot": outer["subroot"], "root": outer["root"],
        "proof_sha256": [digest(path) for path in paths], "folded_root": folded,
        "verified": np.array(folded, object) == outer["root"],
        "proof_nodes": [len(path) // _DIGEST for path in paths],
    })


def _superblock() -> Column:
    return F.floor(F.col("idx") / WIDTH).alias("block")


def _up(nodes: DataFrame) -> list[DataFrame]:
    """The tables of nodes on the way up, the given one first, the one with a node a tree last."""
    levels = [nodes]
    while True:
        most = levels[-1].agg(F.max("total")).first()[0]
        if most is None or most <= 1:
            return levels
        narrow = levels[-1].select("tree", "idx", "total", "digest")
        levels.append(stage(narrow.groupBy("tree", _superblock()).applyInPandas(_send_up, _NODES), "merkle-nodes"))


def _down(tables: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Outer rows of the nodes of the last table, from those of the nodes above the first."""
    for nodes in tables:
        narrow = nodes.select("tree", "idx", "total", "digest")
        outer = _exchange(narrow, outer, _send_down, _OUTER)
    return outer


def _exchange(nodes: DataFrame, outer: DataFrame, function, schema: str) -> DataFrame:
    """Each superblock of nodes with the outer row of its own node."""
    blocks = outer.groupBy("tree", F.col("idx").alias("block"))
    return nodes.groupBy("tree", _superblock()).cogroup(blocks).applyInPandas(function, schema)


def _ordered(rows: DataFrame, tree: str, keys: list[Column]) -> DataFrame:
    """Rows with ``idx`` and ``total`` of their tree."""
    ordered = in_order(rows, keys, "merkle-leaves")
    found = join_table(ordered.withColumn("_part", part()), stage(pieces(ordered, tree), "merkle-pieces"), [tree, "_part"], "inner")
    return found.withColumn("idx", place()).withColumn("total", F.col("_all")).drop("_id", "_part", "_first", "_before", "_all")


def leaves(docs: DataFrame) -> DataFrame:
    """One narrow row a document: its tree, its digest, and the digest of what the check makes of it.

    The tree of a null language sorts before all others.
    """
    text = F.col("text").cast("string")
    own = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(text).alias("digest"),
        F.when(tampered(), leaf(lowered(text))).alias("changed"),
    )
    return own.withColumn("changed", F.coalesce("changed", "digest"))


def manifest(docs: DataFrame) -> DataFrame:
    """Of each document: ``leaf``, ``subroot`` of its language, ``root``, digest of its proof, and the check.

    Leaves of a language ascend by ``doc_id``, null first; rows of one id by their digest. Equal rows are
    leaves of their own, each with its proof. Null fields are leaves' text too (see :func:`field`), a null
    language is a tree. An empty table gives no rows. ``verified`` is false exactly where the check
    changed the text.
    """
    narrow = stage(leaves(docs), "merkle-rows")
    low = _up(stage(_ordered(narrow, "tree", [F.asc("tree"), F.asc_nulls_first("doc_id"), F.asc("digest")]), "merkle-level"))
    roots = low[-1].select(F.col("tree").alias("lang_tree"), F.lit(_TOP).alias("tree"), "digest")
    high = _up(stage(_ordered(roots, "tree", [F.asc("lang_tree")]), "merkle-level"))

    empty = [F.lit("").alias(name) for name in ("proof", "shape", "subroot")]
    root = high[-1].select("tree", "idx", *empty, F.col("digest").alias("root"))
    tops = _down(high[-2::-1], root)
    names = high[0].select("idx", "lang_tree", "digest")
    outer = tops.join(names, "idx").select(
        F.col("lang_tree").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", "shape",
        F.col("digest").alias("subroot"), "root",
    )
    outer = _down(low[-2:0:-1], stage(outer, "merkle-outer"))
    rows = low[0].select("tree", "idx", "total", "digest", "doc_id", "changed")
    return _exchange(rows, outer, _prove, _PROVEN)
