"""Substring dedup by level-wise doubling over word windows.

A window can only be repeated if all its parts are. So windows of half the length come first, and
only sampled ones: by content, so that each window of the full length holds at least one
sampled half (see :func:`repeats.anchors`). Halves that occur in one document alone are dropped;
what is left is extended to twice the length, at every position, and windows of the full length are
compared under 128-bit hashes. ``levels`` halvings stand before the full length; a level without
survivors ends the search.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.repeats import anchors, covered, first_here, gathered, spans_of, tags, with_places
from tidemark.llm.texts import Rolling, blocks, word_spans
from tidemark.sources.staging import stage

LENGTH = 50

_SEEDS = (21, 22)


class _Words:
    """Hashes of the words and of windows of words."""

    def __init__(self):
        self.bytes = [Rolling(seed) for seed in _SEEDS]
        self.words = [Rolling(seed + 10) for seed in _SEEDS]

    def windows(self, data, start, end, length: int, which: int) -> np.ndarray:
        words = self.bytes[which].hashes(self.bytes[which].sums(data), start, end)
        return self.words[which].windows(self.words[which].sums(words), length)


_ROWS = "h long, g long, doc_id long, place long, size int, shared boolean"


def _rows(h, g, doc_id, place, size, shared):
    names = ["h", "g", "doc_id", "place", "size", "shared"]
    kinds = [np.int64, np.int64, np.int64, np.int64, np.int32, bool]
    arrays = [pa.array(np.asarray(x).astype(k, copy=False)) for x, k in zip((h, g, doc_id, place, size, shared), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _sampled(docs: DataFrame, length: int, width: int) -> DataFrame:
    """Anchors of ``width``: those of the smallest document of a batch, and with ``size`` 1 those decided here."""

    def sampled(batches):
        hashing = _Words()
        for batch in batches:
            found = []
            for block in blocks(batch):
                start, end, doc = word_spans(block.data, block.offsets)
                hashes = hashing.windows(block.data, start, end, width, 0)
                at = anchors(hashes, doc, length, width)
                owner = doc[at]
                ids = block.column("doc_id").to_numpy(zero_copy_only=False)[owner]
                text = block.column("text_hash").to_numpy(zero_copy_only=False)[owner]
                words = np.bincount(doc, minlength=block.size)
                position = at - (np.cumsum(words) - words)[owner]
                found.append((hashes[at].view(np.int64), ids, tags(text) | position))
            yield found

    def run(batches):
        for found in gathered(sampled(batches), lambda x: len(x[0])):
            h, ids, place = map(np.concatenate, zip(*found))
            first, shared, later = first_here([h], ids)
            yield _rows(h[first], np.zeros(len(first)), ids[first], place[first], np.zeros(len(first)), shared)
            # decided rows are dealt by place
            yield _rows(place[later], ids[later], ids[later], place[later], np.ones(len(later)), np.ones(len(later)))

    return docs.mapInArrow(run, _ROWS)


def _repeated(rows: DataFrame) -> DataFrame:
    """Places of the rows whose key more than one document has."""
    same = Window.partitionBy("h", "g")
    judged = rows.withColumns(
        {"least": F.min("doc_id").over(same), "most": F.max("doc_id").over(same), "any": F.max("shared").over(same)}
    )
    return judged.where("size > 0 or any or least < most").select(
        "doc_id", "place", F.greatest("size", F.lit(1)).alias("size")
    )


def _windows(docs: DataFrame, halves: DataFrame, length: int, reach: int) -> DataFrame:
    """Hashes of the windows of ``length`` around the places in ``halves``, and spans decided in a batch."""
    hashing = _Words()

    def run(data, offsets, doc_ids, text_hashes, places):
        start, end, doc = word_spans(data, offsets)
        words = np.bincount(doc, minlength=len(places))
        first = np.cumsum(words) - words
        at = np.concatenate([p + f for (p, _), f in zip(places, first)])
        size = np.concatenate([s for _, s in places])
        n = max(0, len(doc) - length + 1)
        wanted = np.zeros(len(doc) + 1, np.int32)
        np.add.at(wanted, np.maximum(at - reach, 0), 1)
        np.add.at(wanted, at + size, -1)
        inside = doc[:n] == doc[length - 1 :] if n else np.zeros(0, bool)
        at = np.flatnonzero((np.cumsum(wanted)[:n] > 0) & inside)
        h = hashing.windows(data, start, end, length, 0)[at].view(np.int64)
        g = hashing.windows(data, start, end, length, 1)[at].view(np.int64)
        owner = doc[at]
        ids = doc_ids.to_numpy(zero_copy_only=False)
        place = tags(text_hashes)[owner] | (at - first[owner])
        least, shared, later = first_here([h, g], ids[owner])
        # windows of later documents are removed whatever other batches hold; runs of them travel as one row
        mask = np.zeros(n, bool)
        mask[at[later]] = True
        begin, run_length = spans_of(mask, doc[:n]) if n else (at[:0], at[:0])
        run_doc = doc[begin]
        run_place = tags(text_hashes)[run_doc] | (begin - first[run_doc])
        n_first, n_runs = len(least), len(begin)
        return _rows(
            np.concatenate([h[least], run_place]),
            np.concatenate([g[least], ids[run_doc]]),
            np.concatenate([ids[owner[least]], ids[run_doc]]),
            np.concatenate([place[least], run_place]),
            np.concatenate([np.zeros(n_first, np.int64), run_length]),
            np.concatenate([shared, np.ones(n_runs, bool)]),
        )

    return with_places(docs, halves, run, _ROWS)


def _later(rows: DataFrame) -> DataFrame:
    """Spans of window starts that a smaller document has too."""
    least = F.min("doc_id").over(Window.partitionBy("h", "g"))
    judged = rows.withColumn("least", least)
    return judged.where("size > 0 or least < doc_id").select(
        "doc_id", "place", F.greatest("size", F.lit(1)).alias("size")
    )


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def repeated_windows(docs: DataFrame, length: int = LENGTH, levels: int = 1) -> DataFrame:
    """``doc_id``, ``place`` and ``size``: runs of starts of windows that a document with a smaller id has."""
    known = _narrow(docs).where("doc_id is not null")
    width = length >> levels
    places = stage(_repeated(_sampled(known, length, width)), f"windows_{width}")
    while not places.isEmpty():
        reach, width = width, length if 4 * width > length else 2 * width
        rows = _windows(known, places, width, length - reach)
        if width == length:
            return stage(_later(rows), f"windows_{width}")
        places = stage(_repeated(rows), f"windows_{width}")
    return places


def remove_repeats(docs: DataFrame, length: int = LENGTH, levels: int = 1) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_words``, ``n_removed`` and the ``kept`` words of each row, joined by one space.

    A word goes when a window of ``length`` words over it also starts in a document with a smaller
    ``doc_id``, judged on the input. Null texts have no words; rows without ``doc_id`` lose none.
    """
    found = repeated_windows(docs, length, levels)

    def run(data, offsets, doc_ids, text_hashes, places):
        start, end, doc = word_spans(data, offsets)
        words = np.bincount(doc, minlength=len(places))
        first = np.cumsum(words) - words
        at = np.concatenate([p + f for (p, _), f in zip(places, first)])
        size = np.concatenate([s for _, s in places]) + length - 1
        gone = covered(at, size, len(doc))
        raw = data.tobytes()
        kept, removed = [], np.bincount(doc[gone], minlength=len(places))
        spans = list(zip(start.tolist(), end.tolist()))
        for i in range(len(places)):
            mine = slice(first[i], first[i] + words[i])
            kept.append(b" ".join(raw[a:b] for (a, b), out in zip(spans[mine], gone[mine].tolist()) if not out))
        columns = [doc_ids, pa.array(text_hashes), pa.array(words), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "n_removed", "kept"])

    schema = "doc_id long, text_hash long, n_words long, n_removed long, kept string"
    return with_places(_narrow(docs), found, run, schema)
