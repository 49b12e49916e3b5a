"""The trie of conversation prefixes, from vertical bitmaps.

A node is a sequence of turns that at least one conversation starts with. Turns travel as digests and
lengths only. Conversations are dealt to shards by ranges of ``conv_id``, and a very long one over
segments of ``SEGMENT`` turns, so that no shard grows with a hot turn, a hot prefix or a long
conversation. A shard indexes (position, turn) to bitsets of its conversations and walks the trie depth
first: the members of a child are the parent's bitset and a posting. What shards find is summed by node.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.ranks import in_order, part, pieces, place
from tidemark.operators.skew import join_table
from tidemark.sources.staging import stage

# Conversations start with turns of the first conversation of their family.
FAMILY = 5
# A shard covers 2 ** SHARD_BITS conversation ids, a segment holds SEGMENT turns: together they bound
# the rows of a task's group.
SHARD_BITS = 10
SEGMENT = 128

ROOT = bytes(16)

_PARTIAL = (
    "shard long, segment long, node binary, parent binary, depth long, n_convs long, conv_id long, "
    "n_bytes long, inner boolean, outer boolean, ends string"
)
_SUMS = "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def borrowed(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return (F.crc32(conv.cast("string").cast("binary")) % 9).cast("long")


def _first_of_family(conv: Column) -> Column:
    return conv - conv % FAMILY


def _shard() -> Column:
    return F.shiftright("conv_id", SHARD_BITS).alias("shard")


def turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``(conv_id, length, at, turn, n_bytes)``, ``at`` from 0, and ``(conv_id, length)`` of every conversation.

    Turns are ordered by ``turn``, null first, those of one number by the digest of role and text.
    Repeated rows are turns of their own. Rows without ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    narrow = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    keys = ["conv_id", F.asc_nulls_first("turn"), F.asc("digest")]
    ordered = in_order(stage(narrow, "trie-turns"), keys, "trie-ordered")
    found = stage(pieces(ordered, "conv_id"), "trie-pieces")
    # one row a conversation: its own turns, and those of the first of its family
    own = found.groupBy("conv_id").agg(F.max("_all").alias("n"))
    first = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("first"), F.col("n").alias("n_first"))
    h = borrowed(F.col("conv_id"))
    convs = own.withColumn("first", _first_of_family(F.col("conv_id"))).join(first, "first", "left").select(
        "conv_id", F.least(h, F.coalesce("n_first", F.lit(0))).alias("n_taken"), F.greatest(F.col("n") - h, F.lit(0)).alias("n_own")
    )
    convs = stage(convs.withColumn("length", F.col("n_taken") + F.col("n_own")).drop("n_own"), "trie-convs")
    spots = stage(found.join(convs, "conv_id"), "trie-pieces")
    placed = join_table(ordered.withColumn("_part", part()), spots, ["conv_id", "_part"], "inner")
    placed = placed.select("conv_id", "n_taken", "length", place().alias("p"), F.unhex("digest").alias("turn"), "n_bytes")
    placed = stage(placed, "trie-placed")
    own_turns = placed.where(F.col("p") >= h).withColumn("at", F.col("n_taken") + F.col("p") - h)
    # no more than the first eight turns of a first conversation are ever taken
    near = F.array(*[F.try_add("conv_id", F.lit(d)) for d in range(1 - FAMILY, FAMILY)])
    taken = (
        placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("p") < 8))
        .select(F.col("conv_id").alias("first"), F.explode(near).alias("conv_id"), F.col("p").alias("at"), "turn", "n_bytes")
        .where((_first_of_family(F.col("conv_id")) == F.col("first")) & (F.col("at") < h))
        .join(convs.select("conv_id", "length"), "conv_id")
    )
    columns = ["conv_id", "length", "at", "turn", "n_bytes"]
    return own_turns.select(columns).unionByName(taken.select(columns)), convs.select("conv_id", "length")


def _chain(link: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(link + turn).digest()[:16]


def _key(start: bytes, link: bytes) -> bytes:
    """The node that a chain of turns leads to from the node its segment starts at."""
    return hashlib.sha256(start + link).digest()[:16]


def _segment_link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The chain over all turns of each conversation's segment."""
    links = defaultdict(lambda: ROOT)
    for conv, turn in rows.sort_values(["conv_id", "at"])[["conv_id", "turn"]].itertuples(index=False):
        links[conv] = _chain(links[conv], turn)
    return pd.DataFrame({"conv_id": list(links), "segment": key[1], "link": list(links.values())})


def _starts_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes at which the second and later segments of one conversation start."""
    rows, start, starts = rows.sort_values("segment"), ROOT, []
    for link in rows["link"]:
        start = _key(start, link)
        starts.append(start)
    return pd.DataFrame({"conv_id": key[0], "segment": rows["segment"] + 1, "start": starts})


def starts(rebuilt: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(shard, segment, conv_id, length, start)`` of every segment of every conversation.

    A conversation whose last segment is full has no empty one behind it.
    """
    head = lengths.select(_shard(), F.lit(0).cast("long").alias("segment"), "conv_id", "length", F.lit(ROOT).alias("start"))
    segment = F.floor(F.col("at") / SEGMENT)
    full = rebuilt.where(segment < F.floor((F.col("length") - 1) / SEGMENT)).select("conv_id", "at", "turn")
    links = full.groupBy(_shard(), segment.alias("segment")).applyInPandas(_segment_link, "conv_id long, segment long, link binary")
    # one row for each SEGMENT turns of one conversation
    later = links.groupBy("conv_id").applyInPandas(_starts_of, "conv_id long, segment long, start binary")
    later = later.join(lengths, "conv_id").select(_shard(), "segment", "conv_id", "length", "start")
    return head.unionByName(later)


class Bitmaps:
    """The turns of a shard's segment: postings of (position, turn), and where conversations end."""

    def __init__(self, rows: pd.DataFrame, begun: pd.DataFrame, offset: int):
        self.convs = sorted(begun["conv_id"].tolist())
        number = {conv: i for i, conv in enumerate(self.convs)}
        self.starts: dict[bytes, int] = defaultdict(int)
        self.ended: dict[int, int] = defaultdict(int)
        for conv, length, start in begun[["conv_id", "length", "start"]].itertuples(index=False):
            self.starts[start] |= 1 << number[conv]
            if length <= offset + SEGMENT:
                self.ended[length - offset] |= 1 << number[conv]
        self.postings: dict[tuple[int, bytes], int] = defaultdict(int)
        self.turn: dict[tuple[int, int], tuple[bytes, int]] = {}
        for conv, at, turn, n_bytes in rows[["conv_id", "at", "turn", "n_bytes"]].itertuples(index=False):
            i = number[conv]
            self.postings[at - offset, turn] |= 1 << i
            self.turn[at - offset, i] = turn, n_bytes

    def children(self, members: int, depth: int):
        """The distinct next turns of ``members``, each with its length and its share of the members."""
        rest = members & ~self.ended[depth] if depth < SEGMENT else 0
        while rest:
            turn, n_bytes = self.turn[depth, (rest & -rest).bit_length() - 1]
            share = rest & self.postings[depth, turn]
            yield turn, n_bytes, share
            rest &= ~share

    def ids(self, members: int) -> list[int]:
        out = []
        while members:
            out.append(self.convs[(members & -members).bit_length() - 1])
            members &= members - 1
        return out


def _walk(key: tuple, rows: pd.DataFrame, begun: pd.DataFrame) -> pd.DataFrame:
    """Nodes of one shard and segment, depth first, parents before children.

    The node a later segment starts at belongs to the segment before: it comes as an ``outer`` row.
    """
    shard, segment = key
    offset = segment * SEGMENT
    maps = Bitmaps(rows, begun, offset)
    out = []
    for start, convs in maps.starts.items():
        # (link, node, parent, depth in the segment, bytes of the last turn, members)
        stack = [(ROOT, start, None, 0, 0, convs)]
        while stack:
            link, node, parent, depth, n_bytes, members = stack.pop()
            ended = members & maps.ended[depth]
            outer = depth == 0 and segment > 0
            out.append((
                shard, segment, node, parent, offset + depth, 0 if outer else members.bit_count(),
                maps.convs[(members & -members).bit_length() - 1], n_bytes, members != ended, outer,
                ",".join(map(str, maps.ids(ended))) if ended and not outer else None,
            ))
            for turn, size, share in maps.children(members, depth):
                onward = _chain(link, turn)
                stack.append((onward, _key(start, onward), node, depth + 1, size, share))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _PARTIAL.split(", ")])


def _sum_up(key: tuple, nodes: pd.DataFrame, beyond: pd.DataFrame) -> pd.DataFrame:
    """What one shard and segment adds to its nodes: children, leaves and savings below them.

    Every node is counted where its smallest member is; ``beyond`` is what that finds in later segments.
    """
    nodes = nodes.sort_values("depth")
    shard, _ = key
    names = nodes["node"].tolist()
    place = {name: i for i, name in enumerate(names)}
    up = [place.get(parent) for parent in nodes["parent"]]
    mine = ((nodes["least"].to_numpy() >> SHARD_BITS == shard) & ~nodes["outer"].to_numpy()).tolist()
    least, n_convs, outer = nodes["least"].tolist(), nodes["n_convs"].tolist(), nodes["outer"].tolist()
    children, leaves, saved = [0] * len(names), [0] * len(names), [0] * len(names)
    for name, leaf, save in beyond[["node", "n_leaves", "saved"]].itertuples(index=False):
        leaves[place[name]] += leaf
        saved[place[name]] += save
    for i, leaf in enumerate(nodes["leaf"].tolist()):
        if mine[i]:
            leaves[i] += leaf
    for i, n_bytes in enumerate(nodes["n_bytes"].tolist()):
        if mine[i]:
            saved[i] += (n_convs[i] - 1) * n_bytes
    for i in range(len(names) - 1, -1, -1):
        if up[i] is not None:
            children[up[i]] += mine[i]
            if not outer[up[i]]:
                leaves[up[i]] += leaves[i]
                saved[up[i]] += saved[i]
    return pd.DataFrame({
        "node": names,
        "conv_id": pd.array([v if m else None for v, m in zip(least, mine)], "Int64"),
        "depth": pd.array([v if m else None for v, m in zip(nodes["depth"].tolist(), mine)], "Int64"),
        "parent_conv_id": pd.array([least[u] if m and u is not None else None for u, m in zip(up, mine)], "Int64"),
        "n_convs": pd.array([v if m else None for v, m in zip(n_convs, mine)], "Int64"),
        "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
    })


def _end_digests(partial: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending and joined by commas.

    Shards are ranges of ids, so their lists follow each other. A task reads them in that order and
    keeps the digest so far alone, whatever the number of conversations of a node.
    """

    def run(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == node:
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256(ids.encode())
            yield _named(done)
        if node is not None:
            yield _named([(node, state.hexdigest())])

    ends = partial.where("ends is not null").select("node", "ends", "shard")
    ordered = ends.repartition("node").sortWithinPartitions("node", "shard").select("node", "ends")
    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def _named(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row a node: its smallest member ``conv_id``, ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Null roles and texts are empty. An empty table has no node, not even a root.
    """
    rebuilt, lengths = turns(conversations)
    rebuilt, lengths = stage(rebuilt, "trie-rebuilt"), stage(lengths, "trie-lengths")
    begun = stage(starts(rebuilt, lengths), "trie-starts")
    grouped = rebuilt.select("conv_id", "at", "turn", "n_bytes").groupBy(_shard(), F.floor(F.col("at") / SEGMENT).alias("segment"))
    partial = stage(grouped.cogroup(begun.groupBy("shard", "segment")).applyInPandas(_walk, _PARTIAL), "trie-partial")
    merged = partial.groupBy("node").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("least"), F.max("inner").alias("inner")
    )
    nodes = stage(
        partial.select("shard", "segment", "node", "parent", "depth", "n_bytes", "outer")
        .join(merged, "node")
        .withColumn("leaf", (~F.col("inner")).cast("int")),
        "trie-nodes",
    )
    beyond = _beyond(nodes, begun)
    sums = (
        nodes.groupBy("shard", "segment")
        .cogroup(beyond.groupBy("shard", "segment"))
        .applyInPandas(_sum_up, _SUMS)
        .withColumn("ends_sha256", F.lit(None).cast("string"))
    )
    names = [c for c in sums.columns if c != "node"]
    ends = _end_digests(partial)
    ends = ends.select("node", *[F.lit(None).cast("long").alias(n) for n in names[:-1]], "ends_sha256")
    whole = sums.unionByName(ends).groupBy("node").agg(
        *[F.max(n).alias(n) for n in ("conv_id", "depth", "parent_conv_id", "n_convs")],
        *[F.sum(n).alias(n) for n in ("n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
    return whole.drop("node")


def _beyond(nodes: DataFrame, begun: DataFrame) -> DataFrame:
    """What later segments add to the node at which an earlier one goes over into them.

    A node counts with its smallest member, whose path leads through one such node of every segment before.
    """
    own = nodes.where((F.col("segment") > 0) & ~F.col("outer") & (F.shiftright("least", SHARD_BITS) == F.col("shard")))
    found = own.groupBy(F.col("least").alias("conv_id"), "segment").agg(
        F.sum("leaf").alias("n_leaves"), F.sum((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")
    )
    # every later segment of a conversation, also those it is the smallest member of no node in
    every = begun.where("segment > 0").select("shard", "segment", "conv_id", "start").join(found, ["conv_id", "segment"], "left")
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment"))
    summed = every.select(
        "shard", (F.col("segment") - 1).alias("segment"), F.col("start").alias("node"),
        F.coalesce(F.sum("n_leaves").over(after), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum("saved").over(after), F.lit(0)).alias("saved"),
    )
    return summed.groupBy("shard", "segment", "node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
