"""Benchmark decontamination: every training passage is a query to an index of the test items.

Documents are cut into overlapping passages, twice as long as the longest item and half
overlapping, so that each copy of an item lies whole inside one. BM25 weights are divided by
the score an item gets from its own text, so scores run from 0 to 1 whatever the length of the
item. Postings are kept in blocks of items with the largest weight of each block: a passage first
sums these largest weights, and only blocks that can reach the threshold are scored (block-max
WAND, for all passages of a block of text at a time). Every item at or above the threshold is
retrieved, none is cut off by rank, and verified by the share of its question and of its answer
that runs of words of the passage cover.

The index goes to all tasks. Its size is bounded: items are dealt into indexes of about
``ITEMS_PER_INDEX``, which are asked one after the other; document frequencies and lengths are
those of all items. Words are runs of letters, digits, ``_`` and non-ASCII characters, A-Z in lower case.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import Rolling, blocks, word_spans

K1 = 1.2
B = 0.75
# Share of an item's own score from which a passage is verified.
MIN_SCORE = 0.5
# Share of the words of the question, and of the answer, that must be covered.
MIN_OVERLAP = 0.8
RUN = 5
MIN_PASSAGE = 128
BLOCK_ITEMS = 8
ITEMS_PER_INDEX = 20_000

_NO_WORD = np.ones(256, bool)
_NO_WORD[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz")] = False
_NO_WORD[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_UPPER_TEXT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _expand(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes ``start .. start + count`` of each row, and the row of each."""
    row = np.repeat(np.arange(len(count)), count)
    return np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + start[row], row


def _runs(words: np.ndarray, rolling: Rolling, length: int) -> np.ndarray:
    return rolling.windows(rolling.sums(words), length)


class Index:
    """Postings of some items: by term the blocks with their largest weight, by term and block the items."""

    def __init__(self, rows: list, n_items: int, mean_length: float):
        self.rolling = Rolling(7)
        self.ids = [r["item_id"] for r in rows]
        self.words: list[np.ndarray] = []
        self.answer: list[int] = []
        term, item, weight = [], [], []
        for number, row in enumerate(rows):
            text = np.frombuffer(" ".join(row["words"]).encode(), np.uint8)
            start, end, _ = word_spans(text, np.array([0, len(text)]), _NO_WORD)
            hashes = self.rolling.hashes(self.rolling.sums(text), start, end)
            self.words.append(hashes)
            self.answer.append(row["answer"])
            known, first, tf = np.unique(hashes, return_index=True, return_counts=True)
            df = np.array([row["df"][row["words"][i]] for i in first], float)
            idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
            found = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / mean_length))
            term.append(known)
            item.append(np.full(len(known), number))
            weight.append(found / found.sum())
        term, item, weight = map(np.concatenate, (term, item, weight))
        self.terms, term = np.unique(term, return_inverse=True)
        self.n_blocks = -(-len(rows) // BLOCK_ITEMS)
        order = np.lexsort((item, term))
        term, self.item, self.weight = term[order], item[order], weight[order]
        cell = term * self.n_blocks + self.item // BLOCK_ITEMS
        cells, at = np.unique(cell, return_index=True)
        self.cell_max = np.maximum.reduceat(self.weight, at)
        self.cell_block = cells % self.n_blocks
        self.cell_start, self.cell_count = at, np.diff(np.append(at, len(cell)))
        self.term_start = np.searchsorted(cells // self.n_blocks, np.arange(len(self.terms)))
        self.term_count = np.diff(np.append(self.term_start, len(cells)))
        self.passage = 2 * max(MIN_PASSAGE // 2, max(map(len, self.words)))
        self.items = len(rows)

    def _grouped(self, key, value):
        key, at = np.unique(key, return_inverse=True)
        return key, np.bincount(at, value, minlength=len(key))

    def retrieve(self, passage: np.ndarray, term: np.ndarray, least: float):
        """Passage, item and score of all that reach ``least``; pairs of passage and term come distinct."""
        cell, pair = _expand(self.term_start[term], self.term_count[term])
        bound_key = passage[pair] * self.n_blocks + self.cell_block[cell]
        key, bound = self._grouped(bound_key, self.cell_max[cell])
        able = key[bound >= least - 1e-9]
        kept = np.isin(bound_key, able)
        posting, row = _expand(self.cell_start[cell[kept]], self.cell_count[cell[kept]])
        owner = passage[pair[kept]][row]
        key, score = self._grouped(owner * self.items + self.item[posting], self.weight[posting])
        reached = score >= least - 1e-9
        return key[reached] // self.items, key[reached] % self.items, np.minimum(score[reached], 1.0)

    def overlap(self, item: int, words: np.ndarray) -> tuple[float, float]:
        """Shares of the item's question and answer words covered by runs that ``words`` hold too."""
        own = self.words[item]
        length = min(RUN, len(own))
        found = np.isin(_runs(own, self.rolling, length), _runs(words, self.rolling, length))
        edge = np.zeros(len(own) + 1, int)
        at = np.flatnonzero(found)
        edge[at] += 1
        edge[at + length] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        cut = self.answer[item]
        return tuple(float(part.mean()) if len(part) else 1.0 for part in (covered[:cut], covered[cut:]))

    def hits(self, block, least: float):
        """Document, item, score, overlaps and place of the best passage for each pair retrieved."""
        data, size = block.data, block.size
        start, end, doc = word_spans(data, block.offsets, _NO_WORD)
        words = self.rolling.hashes(self.rolling.sums(_LOWER[data]), start, end)
        count = np.bincount(doc, minlength=size)
        first = np.cumsum(count) - count
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == words)
        # a word lies in the passage that starts in its own half-length step and in the one before
        step = self.passage // 2
        piece = (known - first[doc[known]]) // step
        base = np.concatenate([[0], np.cumsum(-(-count // step))])
        own = base[doc[known]] + piece
        earlier = piece > 0
        passage = np.concatenate([own, own[earlier] - 1])
        term = np.concatenate([at[known], at[known[earlier]]])
        pairs = np.unique(passage * len(self.terms) + term)
        passage, item, score = self.retrieve(pairs // len(self.terms), pairs % len(self.terms), least)
        owner = np.searchsorted(base, passage, side="right") - 1
        best: dict[tuple[int, int], tuple] = {}
        for p, i, s, d in zip(passage.tolist(), item.tolist(), score.tolist(), owner.tolist()):
            begin = (p - base[d]) * step
            held = words[first[d] + begin : first[d] + min(begin + self.passage, count[d])]
            question, answer = self.overlap(i, held)
            found = (min(question, answer), s, question, answer, int(begin))
            if (d, i) not in best or found > best[d, i]:
                best[d, i] = found
        return best


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``words``, ``answer`` (the number of words before the answer) and ``df`` by word.

    The answer is the last sentence of an item; an item of one sentence is all question. Items
    without a word are left out.
    """
    lower = F.translate(F.col("text").cast("string"), _UPPER_TEXT, _UPPER_TEXT.lower())
    pattern = F.lit("[0-9a-z_\\x{80}-\\x{10ffff}]+")
    last = F.regexp_extract(lower, r"^([\s\S]*[.!?\n])\s*[^.!?\n]*[0-9a-z_\x{80}-\x{10ffff}][^.!?\n]*[.!?\s]*$", 1)
    items = benchmark.select(
        "item_id",
        F.regexp_extract_all(lower, pattern, F.lit(0)).alias("words"),
        F.size(F.regexp_extract_all(last, pattern, F.lit(0))).alias("before"),
    ).where(F.size("words") > 0)
    return items.withColumn("answer", F.when(F.col("before") > 0, F.col("before")).otherwise(F.size("words")))


def indexes(benchmark: DataFrame) -> list[Index]:
    """Indexes over all items, each of about ``ITEMS_PER_INDEX``."""
    items = _items(benchmark)
    total = items.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean")).first()
    if not total["n"]:
        return []
    words = items.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    parts = math.ceil(total["n"] / ITEMS_PER_INDEX)
    numbered = items.withColumn("key", F.xxhash64("item_id", "words"))
    with_df = (
        numbered.select("key", F.explode(F.array_distinct("words")).alias("word"))
        .join(words, "word")
        .groupBy("key")
        .agg(F.map_from_entries(F.collect_set(F.struct("word", "df"))).alias("df"))
    )
    table = numbered.join(with_df, "key").withColumn("part", F.pmod("key", F.lit(parts)))
    out = []
    for part in range(parts):
        rows = table.where(F.col("part") == part).sort("item_id", "key").collect()
        if rows:
            out.append(Index(rows, total["n"], total["mean"]))
    return out


_HIT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long, leaked boolean"


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE, overlap: float = MIN_OVERLAP) -> DataFrame:
    """One row for each document and item that some passage retrieves.

    ``leaked`` tells whether question and answer are both covered to ``overlap``; of several
    passages the one with the best cover counts. Null and empty texts and items give no row.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    held = indexes(benchmark)

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                names = block.column("doc_id").to_pylist()
                rows = [
                    (names[d], index.ids[i], s, q, a, w, low >= overlap)
                    for index in held
                    for (d, i), (low, s, q, a, w) in index.hits(block, least).items()
                ]
                kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.int64(), pa.bool_())
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                fields = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word", "leaked"]
                yield pa.RecordBatch.from_arrays(columns, fields)

    return docs.mapInArrow(run, _HIT)


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = MIN_SCORE, overlap: float = MIN_OVERLAP) -> DataFrame:
    """The rows of ``docs`` in which no item is leaked, with all columns; nothing is shuffled."""
    held = indexes(benchmark)

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                clean = np.ones(block.size, bool)
                for index in held:
                    found = index.hits(block, least)
                    clean[[d for (d, _), best in found.items() if best[0] >= overlap]] = False
                yield batch.slice(block.first, block.size).filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
