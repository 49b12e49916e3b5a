"""SimHash near-duplicates: links between fingerprints that differ in few bits.

Two fingerprints within four bits agree wholly in at least three of seven bit blocks, so they
meet under one of the 35 keys made of three blocks. Among fingerprints under one key, a table of
Hamming distances to reference fingerprints (the pivots) discards pairs: by the triangle
inequality the coordinates of a link differ by no more than the link itself. What is left is
verified bit by bit. Pivot distances alone cannot serve as keys: for random fingerprints they
all lie near 32, and a cell of a coordinate holds most of the table.

A key may hold very many fingerprints (a template with small changes). Keys above
``MAX_GROUP`` are not compared pair by pair: two fingerprints are within four bits exactly when
some 64-bit number is within two bits of both, and all fingerprints around one number are
linked with each other anyway, so each fingerprint names its 2,081 neighbours and the smallest
document around each neighbour gets one link from the others. That is linear in their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.texts import blocks, word_spans
from tidemark.sources.staging import stage

SHINGLE = 4
MAX_BITS = 4
HASH_SEED = 42
# Fingerprints under one key compared pair by pair; larger groups go through shared neighbours.
MAX_GROUP = 2048
PIVOTS = 16

_BLOCKS = 7
_AGREE = 3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _joined(data, start, end, doc):
    """The words joined by one space each, per document, and their new starts and ends."""
    length = end - start
    last = np.empty(len(doc), bool)
    if len(doc):
        last[:-1], last[-1] = doc[1:] != doc[:-1], True
    step = length + ~last
    to = np.cumsum(step) - step
    keep = np.zeros(len(data) + 1, bool)
    edge = np.zeros(len(data) + 1, np.int8)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    keep[:] = np.cumsum(edge) > 0
    keep[end[~last]] = True
    out = _LOWER[data[keep[:-1]]] if len(data) else data
    gaps = (to + length)[~last]
    out[gaps] = 0x20
    return out.tobytes(), to, to + length


def shingle_spans(block, shingle: int):
    """The words in lower case joined by one space, byte starts and ends of all shingles, the document and number of them."""
    start, end, doc = word_spans(block.data, block.offsets)
    text, start, end = _joined(block.data, start, end, doc)
    words = np.bincount(doc, minlength=block.size)
    first = np.cumsum(words) - words
    count = np.where(words == 0, 0, np.maximum(words - shingle + 1, 1))
    at = np.cumsum(count) - count
    owner = np.repeat(np.arange(block.size), count)
    begin = first[owner] + np.arange(len(owner)) - at[owner]
    stop = np.minimum(begin + shingle, (first + words)[owner]) - 1
    return text, start[begin], end[stop], owner, count


def _fingerprints(block, shingle: int) -> np.ndarray:
    text, begin, end, owner, count = shingle_spans(block, shingle)
    at = np.cumsum(count) - count
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], HASH_SEED) for a, b in zip(begin.tolist(), end.tolist())),
        np.uint64,
        len(owner),
    )
    out = np.zeros(block.size, np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, at[full], axis=0, dtype=np.int32)
        major = (2 * sums > count[full, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed 64-bit ``fp`` of each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. A bit is set when more than half of the
    shingles (repeats included) have it set. A shorter text is one shingle; without a word
    the fingerprint is zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                found = pa.array(_fingerprints(block, shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), found], ["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _keys(fp: Column) -> Column:
    """One key for each choice of three blocks; its number stands in the six top bits."""
    bounds = [64 * i // _BLOCKS for i in range(_BLOCKS + 1)]
    block = [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(bounds, bounds[1:])
    ]
    out = []
    for number, chosen in enumerate(combinations(range(_BLOCKS), _AGREE)):
        key = F.lit(number).cast("long")
        for b in chosen:
            key = F.shiftleft(key, bounds[b + 1] - bounds[b]).bitwiseOR(block[b])
        out.append(key)
    return F.array(*out)


def _pivots(count: int) -> np.ndarray:
    """Reference fingerprints: fixed random ones, about 32 bits apart."""
    return np.random.default_rng(11).integers(0, 1 << 64, count, dtype=np.uint64)


def _pairs(key, fp, table, max_bits):
    """Index pairs of linked rows under equal keys; rows come sorted by key, then first pivot."""
    at = np.arange(len(key) - 1)
    lag = 1
    while len(at):
        other = at + lag
        same = key[at] == key[other]
        near = same & (table[other, 0] - table[at, 0] <= max_bits)
        at, other = at[near], other[near]
        hit = np.abs(table[at].astype(np.int8) - table[other]).max(axis=1, initial=0) <= max_bits
        a, b = at[hit], other[hit]
        hit = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        yield a[hit], b[hit]
        lag += 1
        at = at[at + lag < len(key)]


def _forest(node, pairs):
    """Links that join the same rows as ``pairs`` with at most one link for a row."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    left, right = [], []
    for a, b in pairs:
        for x, y in zip(node[a].tolist(), node[b].tolist()):
            x, y = root(x), root(y)
            if x != y:
                x, y = min(x, y), max(x, y)
                parent[y] = x
                left.append(x)
                right.append(y)
    return left, right


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _close_pairs(groups: DataFrame, max_bits: int, pivots: int) -> DataFrame:
    """Links inside the groups of equal ``key``."""

    def linked(key, fp, node):
        reference = _pivots(pivots)
        table = np.bitwise_count(fp[:, None] ^ reference).astype(np.int8)
        order = np.lexsort((table[:, 0], key))
        key, fp, node, table = key[order], fp[order], node[order], table[order]
        left, right = _forest(node, _pairs(key, fp, table, max_bits))
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=_LINKS)

    def run(batches):
        rest = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            now = now if rest is None else [np.concatenate(x) for x in zip(rest, now)]
            # the last key may go on in the next batch
            cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
            rest = [x[cut:] for x in now]
            if cut:
                yield linked(now[0][:cut], now[1][:cut].view(np.uint64), now[2][:cut])
        if rest is not None and len(rest[0]):
            yield linked(rest[0], rest[1].view(np.uint64), rest[2])

    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.select("key", "fp", "node").repartition(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long")


def _neighbour_links(fps: DataFrame) -> DataFrame:
    """Links through the numbers within two bits of each fingerprint."""
    one = [1 << i for i in range(64)]
    flips = np.array([0, *one, *(x | y for x, y in combinations(one, 2))], np.uint64)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            node = batch.column(1).to_numpy()
            for i in range(0, len(fp), 256):
                around = (fp[i : i + 256, None] ^ flips).ravel()
                owner = np.repeat(node[i : i + 256], len(flips))
                # one row for each number: its smallest document here; the others are linked to it
                order = np.lexsort((owner, around))
                around, owner = around[order], owner[order]
                new = np.concatenate([[True], around[1:] != around[:-1]])
                least = owner[new][np.cumsum(new) - 1]
                pairs = np.unique(np.stack([least, owner], 1)[least != owner], axis=0)
                n, k = int(new.sum()), len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([around[new].view(np.int64), np.zeros(k, np.int64)])),
                        pa.array(np.concatenate([owner[new], pairs[:, 0]])),
                        pa.array(np.concatenate([owner[new], pairs[:, 1]])),
                    ],
                    ["z", "a", "b"],
                )

    rows = stage(fps.select("fp", "node").mapInArrow(run, "z long, a long, b long"), "neighbours")
    own = rows.where("a < b").select("a", "b")
    met = rows.where("a = b").select("z", "a")
    least = met.groupBy("z").agg(F.min("a").alias("least"), F.count("*").alias("n")).where("n > 1")
    across = met.join(least, "z").where("least < a").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return own.union(across).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, pivots: int = PIVOTS,
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    Fingerprints link when they differ in at most ``max_bits`` (up to four) bits; the component
    is the smallest ``doc_id`` reachable over links, the row's own included, and null where
    ``doc_id`` is null. Equal fingerprints are one node from the start, so copies are never paired.
    """
    if not 0 <= max_bits <= _BLOCKS - _AGREE:
        raise ValueError("max_bits must be from 0 to 4")
    found = stage(fingerprints(docs, shingle), "fingerprints")
    known = found.where("doc_id is not null")
    nodes = stage(known.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    keyed = nodes.select(F.explode(_keys(F.col("fp"))).alias("key"), "fp", "node")
    # written out, so that adaptive execution can split the rows of a hot key in the join
    sizes = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    met = stage(keyed.join(sizes, "key"), "keyed")
    links = _close_pairs(met.where(F.col("n") <= max_group), max_bits, pivots)
    large = met.where(F.col("n") > max_group).select("fp", "node").distinct()
    if max_bits == MAX_BITS:
        links = links.union(_neighbour_links(large))
    else:
        links = links.union(_close_pairs(met.where(F.col("n") > max_group), max_bits, pivots))
    labels = components(links)
    named = nodes.join(labels, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return found.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id")
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component.

    Rows without ``doc_id`` stay. Of repeated rows with one ``doc_id`` all stay.
    """
    found = near_duplicates(docs, **options)
    later = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)
