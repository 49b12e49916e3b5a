"""Parts shared by the operators that find strings repeated across documents.

Strings meet under a hash in a shuffle. Of each string a batch of documents sends only the
places in its smallest document there: all larger ones are decided on the spot, as a smaller document
has been seen. So a string adds no more rows to a group than there are batches, however many
documents hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import blocks, sliding

# A place in a text: its position, and above it some bits of the text's hash, which tell
# texts under one doc_id apart.
POSITION_BITS = 40
TAG_MASK = (1 << 22) - 1


def anchors(hashes: np.ndarray, doc: np.ndarray, length: int, width: int, least: np.ndarray | None = None) -> np.ndarray:
    """Positions of sampled windows of ``width`` symbols, by content alone.

    Each window of ``length`` symbols inside a document holds at least one of them, the one of the
    smallest hash (all of them where equal ones repeat), so windows of equal content have equal anchors.
    ``hashes`` are those of the windows of ``width``, ``doc`` is the document of each symbol, ``least`` the smallest hash
    in each window of ``length`` where that is known.
    """
    n = len(doc) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    span = length - width + 1
    least = np.where(doc[:n] == doc[length - 1 :], sliding(hashes, span) if least is None else least, np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), span, np.maximum)
    return np.flatnonzero((most == hashes) & (most != 0))


def gathered(parts: Iterable[list], size: Callable, least: int = 1 << 18) -> Iterator[list]:
    """Join lists until their elements have ``least`` rows; more rows decide more on the spot."""
    held, total = [], 0
    for part in parts:
        held += part
        total += sum(map(size, part))
        if total >= least:
            yield held
            held, total = [], 0
    if held:
        yield held


def first_here(keys: list[np.ndarray], doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the smallest document of their key, whether the key has others, and the rows in others."""
    order = np.lexsort((doc_id, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    group = np.cumsum(new) - 1
    least = doc_id[order][new]
    later = doc_id[order] > least[group] if len(order) else new
    shared = np.zeros(len(least), bool)
    shared[group[later]] = True
    return order[~later], shared[group[~later]], order[later]


def tags(text_hash: np.ndarray) -> np.ndarray:
    return (text_hash & TAG_MASK) << POSITION_BITS


def spans_of(mask: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of maximal runs of true values that stay within an owner."""
    on = np.flatnonzero(mask)
    if not len(on):
        return on, on
    breaks = np.flatnonzero((np.diff(on) > 1) | (owner[on[1:]] != owner[on[:-1]])) + 1
    start = on[np.concatenate([[0], breaks])]
    return start, np.diff(np.concatenate([[0], breaks, [len(on)]]))


def covered(starts: np.ndarray, length: np.ndarray | int, size: int) -> np.ndarray:
    """Which of ``size`` symbols lie in a span."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``pack``, the UTF-8 bytes of the text packed for shuffles (null as empty)."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for block in blocks(batch):
                raw = block.data.tobytes()
                ends = block.offsets.tolist()
                found = [pack(raw[a:b]) for a, b in zip(ends, ends[1:])]
                columns = [block.column("doc_id"), block.column("text_hash"), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "pack"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, pack binary")


def with_places(
    docs: DataFrame, places: DataFrame, run: Callable, schema: str, more: tuple[str, ...] = (), how: str = "left"
) -> DataFrame:
    """Texts joined with the places found in them, given to ``run(data, offsets, ids, hashes, places)``.

    ``places`` has ``doc_id``, ``place``, ``size`` and the columns ``more``. ``run`` gets some texts end to end and,
    for each, an array of positions and arrays of the other columns; it returns a record batch of ``schema``.
    """
    fields = ("place", "size", *more)
    lists = places.groupBy("doc_id").agg(F.collect_list(F.struct(*fields)).alias("found"))
    both = packed(docs).join(lists.withColumnRenamed("doc_id", "_doc"), F.col("doc_id") == F.col("_doc"), how)

    def go(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, first, total = [], at, 0
                while at < batch.num_rows and total < (1 << 20):
                    texts.append(unpack(batch.column(2)[at].as_py()))
                    total += len(texts[-1])
                    at += 1
                part = batch.slice(first, at - first)
                lists = part.column(3).fill_null([]) if part.column(3).null_count else part.column(3)
                flat = lists.flatten()
                columns = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(len(fields))]
                edges = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                hashes = part.column(1).to_numpy(zero_copy_only=False)
                own = []
                for i, tag in enumerate(tags(hashes).tolist()):
                    mine = slice(int(edges[i]), int(edges[i + 1]))
                    place = columns[0][mine]
                    good = (place >> POSITION_BITS << POSITION_BITS) == tag
                    own.append((place[good] - tag, *(c[mine][good] for c in columns[1:])))
                data = np.frombuffer(b"".join(texts), np.uint8)
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                yield run(data, offsets, part.column(0), hashes, own)

    return both.select("doc_id", "text_hash", "pack", "found").mapInArrow(go, schema)
