"""Line dedup: documents that share lines are aligned, and common blocks leave the later one.

Documents meet under keys: each long line, each two filled lines in a row of which one is long, each
run of short lines from one long line (or border of the document) to the next, and all filled lines of
the document (which need no long line among them, if they have its bytes together). Under each key, however many documents have it, a document is paired with the first one
that has it, never with all of them, so a key adds at most one pair a document; the keys of several
lines lead to a document that holds the lines in that order where the first holder of a line does not.
A pair is aligned by patience diff over line hashes: lines that occur once in both anchor the alignment,
and grow into blocks of equal lines.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import Rolling, blocks, mixed
from tidemark.sources.staging import stage

# Bytes a line needs to pair documents, and at least one line of a block to be deleted.
MIN_LINE_BYTES = 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _lines(block, rolling: Rolling, least: int):
    """Hash of each line of a block, and the number of lines of each document.

    The hash of a blank line is 0; the lowest bit of the others tells whether the line is long.
    """
    data, offsets = block.data, block.offsets
    newline = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    ends = np.sort(np.concatenate([newline, offsets[1:]]), kind="stable")
    filled = np.concatenate([[0], np.cumsum(~_BLANK[data])])
    hashes = rolling.hashes(rolling.sums(data), starts, ends)
    hashes = (hashes & ~np.uint64(1)) | (ends - starts >= least)
    hashes[filled[ends] == filled[starts]] = 0
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A)])
    return hashes.view(np.int64), breaks[offsets[1:]] - breaks[offsets[:-1]] + 1


def line_hashes(docs: DataFrame, least: int = MIN_LINE_BYTES) -> DataFrame:
    """``doc_id``, ``text_hash``, the hashes of the ``lines`` of each distinct document, and whether it has ``least`` bytes."""

    def run(batches):
        rolling = Rolling(3)
        for batch in batches:
            for block in blocks(batch):
                hashes, count = _lines(block, rolling, least)
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes))
                filled = np.concatenate([[0], np.cumsum(~_BLANK[block.data])])[block.offsets]
                columns = [block.column("doc_id"), block.column("text_hash"), lists, pa.array(np.diff(filled) >= least)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "lines", "wide"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, lines array<long>, wide boolean")


def _runs(line: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Hashes of runs of filled lines, told apart from those of lines."""
    sums = rolling.sums(mixed(line.view(np.uint64)))
    return mixed(rolling.hashes(sums, low, high) + np.uint64(1)).view(np.int64)


def _keys(lines: DataFrame) -> DataFrame:
    """The distinct keys of each document; ``single`` are those of one long line."""

    def run(batches):
        rolling = Rolling(4)
        for batch in batches:
            lists = batch.column(2)
            count = lists.value_lengths().to_numpy(zero_copy_only=False)
            line = lists.flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(count)), count)
            full = line != 0
            line, doc = line[full], doc[full]
            long = (line & 1) == 1
            at = np.flatnonzero(long)
            # two lines in a row
            two = np.flatnonzero((doc[1:] == doc[:-1]) & (long[1:] | long[:-1]))
            # from a long line or the border of the document to the next, over two short lines or more
            border = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else at
            end = np.append(border[1:], len(doc)) if len(doc) else at
            # (even numbers are long lines, odd ones the borders before a line)
            edge = np.unique(np.concatenate([2 * at, 2 * border - 1, 2 * end - 1]))
            low, high = (edge[:-1] + 1) // 2, edge[1:] // 2 + 1
            marks = (edge[:-1] % 2 == 0).astype(np.int64) + (edge[1:] % 2 == 0)
            far = (marks > 0) & (high - low - marks >= 2)
            low, high = low[far], high[far]
            # all lines of a document
            whole = batch.column(3).to_numpy(zero_copy_only=False)[doc[border]]
            whole |= np.add.reduceat(long.astype(np.int64), border) > 0 if len(doc) else whole
            low, high = np.concatenate([two, low, border[whole]]), np.concatenate([two + 2, high, end[whole]])
            key = np.concatenate([line[at], _runs(line, doc, low, high, rolling)])
            owner = np.concatenate([doc[at], doc[low]])
            single = np.arange(len(key)) < len(at)
            order = np.lexsort((key, owner))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
            order = order[new]
            take = pa.array(owner[order])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(key[order]), pa.array(single[order])],
                ["doc_id", "text_hash", "key", "single"],
            )

    return lines.mapInArrow(run, "doc_id long, text_hash long, key long, single boolean")


def partners(lines: DataFrame, rare: int | None = None) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``first``, an earlier document it overlaps with; distinct.

    With ``rare``, lines of more documents are no keys on their own.
    """
    rows = _keys(lines)
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    # written out, so that adaptive execution can split the rows of a hot key in the join
    met = rows.join(stage(shared.where("first < last").drop("last"), "shared"), "key")
    if rare is not None:
        met = met.where(~F.col("single") | (F.col("n") <= rare))
    return met.where("first < doc_id").select("doc_id", "text_hash", "first").distinct()


def _longest_rise(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _once(lines: list[int], low: int, high: int) -> dict[int, int]:
    """Places of the lines that occur once in a range; blank lines never count."""
    seen: dict[int, int] = {}
    for i in range(low, high):
        seen[lines[i]] = -1 if lines[i] in seen else i
    return {line: i for line, i in seen.items() if i >= 0 and line}


def patience(earlier: list[int], later: list[int]) -> list[tuple[int, int]]:
    """Aligned places of equal lines, in order."""
    out = []
    todo = [(0, len(earlier), 0, len(later))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and earlier[a] == later[b]:
            out.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and earlier[a_end - 1] == later[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            out.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        left = _once(earlier, a, a_end)
        both = [(i, left[line]) for line, i in _once(later, b, b_end).items() if line in left]
        both.sort()
        rise = [both[k] for k in _longest_rise([j for _, j in both])]
        for (i, j), (i_next, j_next) in zip(rise, [*rise[1:], (b_end, a_end)]):
            todo.append((j, j_next, i, i_next))
        if rise:
            todo.append((a, rise[0][1], b, rise[0][0]))
    return sorted(out)


def common_blocks(earlier: list[int], later: list[int], wide: bool = False) -> list[int]:
    """Lines of ``later`` in aligned blocks that hold a long line; with ``wide``, also in one of all its filled lines."""
    out: list[int] = []
    filled = sum(line != 0 for line in later)
    block: list[int] = []
    before = (-2, -2)
    for a, b in [*patience(earlier, later), (-9, -9)]:
        if (a - 1, b - 1) != before:
            if any(later[i] & 1 for i in block) or (wide and sum(later[i] != 0 for i in block) == filled):
                out += block
            block = []
        block.append(b)
        before = (a, b)
    return out


def deletions(docs: DataFrame, least: int = MIN_LINE_BYTES, rare: int | None = None) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``deleted``, the places of lines to delete; only documents with any."""
    lines = stage(line_hashes(docs.where("doc_id is not null"), least), "lines")
    pairs = partners(lines, rare)
    mine = lines.dropDuplicates(["doc_id", "text_hash"])
    theirs = mine.select(F.col("doc_id").alias("first"), F.col("lines").alias("theirs"))
    both = pairs.join(mine, ["doc_id", "text_hash"]).join(theirs, "first")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [common_blocks(a, b, wide) for b, a, wide in zip(*(rows.column(k).to_pylist() for k in (2, 3, 4)))]
                columns = [rows.column(0), rows.column(1), pa.array(found, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "deleted"])

    aligned = both.select("doc_id", "text_hash", "lines", "theirs", "wide").mapInArrow(
        run, "doc_id long, text_hash long, deleted array<int>"
    )
    found = aligned.where(F.size("deleted") > 0).groupBy("doc_id", "text_hash")
    return found.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("deleted")))).alias("deleted"))


def remove_common(docs: DataFrame, least: int = MIN_LINE_BYTES, rare: int | None = None) -> DataFrame:
    """``docs`` with the aligned common blocks cut from ``text``, and ``n_lines`` and ``n_deleted``.

    ``n_lines`` and ``n_deleted`` take the place of columns of these names. Lines end at ``\\n``; a null
    text has none and stays null, an empty one has one blank line. A block needs a line of ``least`` bytes, but for copies
    of whole texts, which need as many together. Rows without ``doc_id`` stay as they are. Documents are judged on the input, not on what is left.
    """
    keyed = docs.withColumn("__tidemark_text", F.xxhash64("text"))
    narrow = keyed.select(
        F.col("doc_id").cast("long"), F.col("__tidemark_text").alias("text_hash"), F.col("text").cast("string")
    )
    found = deletions(narrow, least, rare).select(
        F.col("doc_id").alias("__tidemark_doc"), F.col("text_hash").alias("__tidemark_hash"), F.col("deleted").alias("__tidemark_deleted")
    )
    joined = keyed.join(found, (F.col("doc_id") == F.col("__tidemark_doc")) & (F.col("__tidemark_text") == F.col("__tidemark_hash")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("__tidemark_deleted", i))
    text = F.when(F.col("__tidemark_deleted").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumns(
        {
            "text": text,
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
            "n_deleted": F.when(F.col("__tidemark_deleted").isNull(), 0).otherwise(F.size("__tidemark_deleted")).cast("long"),
        }
    ).select(*(c for c in docs.columns if c not in ("n_lines", "n_deleted")), "n_lines", "n_deleted")
