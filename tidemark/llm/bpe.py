"""BPE token ids through a table of distinct words, and text back from ids.

Merges never reach across words, so a word has the same ids wherever it stands. Spark counts
the words of the whole corpus, each word common enough for the shared table is encoded once,
and the table, whose size is bounded by ``table_words``, goes to all tasks. Each task splits
its texts, joins the ids of the words back by position, and encodes the rarer words it meets once
in a table of its own. (Joining all words of all texts by a shuffle instead would move several times
the corpus.) Decoding joins each id to its piece; the vocabulary bounds that table.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import blocks
from tidemark.sources.staging import stage

# Words in the shared table; about 200 bytes each in the memory of a task.
TABLE_WORDS = 1 << 16
# Words a task keeps beside the shared table, or counts, before it starts anew.
OWN_WORDS = 1 << 16
# Rows decoded at once.
DECODE_ROWS = 256

# Characters that normalization only lowers, to others of these, and that all Unicode versions
# class alike.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ȹȻ-Ƚȿ-ɏ]*")


def _of_class(kind: str) -> str:
    chars = (chr(c) for c in [*range(0x21, 0x7F), *range(0xA1, 0x250)])
    return "".join(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind)


_L, _N = _of_class("L"), _of_class("N")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r {_L}{_N}]+")


class Splitter:
    """The words of a text as the tokenizer's normalizer and splitter make them."""

    def __init__(self, path: str):
        # a task has one core; threads of the library would each keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        # words come normalized to encode_batch, and normalizing twice can reorder marks
        self.normalizer = self.tokenizer.normalizer
        self.tokenizer.normalizer = normalizers.Sequence([])
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: i for i, token in added.items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """Words in order; the strings of special tokens stand for themselves."""
        if self._cut is None or not self._cut.search(text):
            return self._plain(text)
        out: list[str] = []
        for part in self._cut.split(text):
            out += [part] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text):
            return _SPLIT.findall(text.lower())
        text = self.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, words: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [[self.special[w]] if w in self.special else e.ids for w, e in zip(words, found)]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, list[str]]]:
    """Identifiers and texts, a block of documents at a time."""
    for block in blocks(batch):
        yield block.column("doc_id"), [t or "" for t in block.column("text").to_pylist()]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """``word`` and ``n``, over all texts."""

    def table(counts):
        columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches):
        splitter = Splitter(path)
        for batch in batches:
            counts: Counter[str] = Counter()
            for _, texts in _texts(batch):
                for text in texts:
                    counts.update(splitter.words(text))
                if len(counts) > OWN_WORDS:
                    yield table(counts)
                    counts = Counter()
            yield table(counts)

    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(counts: DataFrame, most: int) -> DataFrame:
    """The words of at least that count which at most ``most`` words reach."""
    size = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.min("n").alias("n"))
    least, total = None, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["size"]):  # at most 8 rows a power of two
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return counts.where(F.col("n") >= least) if least else counts.where("false")


def word_table(docs: DataFrame, path: str, most: int = TABLE_WORDS) -> DataFrame:
    """``word`` and ``ids`` of the most frequent words, each encoded once."""

    def run(batches):
        splitter = Splitter(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(splitter.ids(words), pa.list_(pa.int32()))], ["word", "ids"]
            )

    counts = stage(word_counts(docs, path), "words")
    return _common(counts, most).select("word").mapInArrow(run, "word string, ids array<int>")


class _Table:
    """Ids of words: the shared table, then the words met here."""

    def __init__(self, words: list[str], ids: np.ndarray, length: np.ndarray, splitter: Splitter):
        self.splitter = splitter
        self.shared = len(words)
        self.index = {w: i for i, w in enumerate(words)}
        self.base = (ids, length)
        self.ids, self.length = [ids], [length]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each."""
        words, count = [], []
        for text in texts:
            found = self.splitter.words(text)
            words += found
            count.append(len(found))
        if len(self.index) > self.shared + OWN_WORDS:
            for word in list(self.index)[self.shared :]:
                del self.index[word]
            self.ids, self.length = [self.base[0]], [self.base[1]]
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            found = self.splitter.ids(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.length.append(np.fromiter(map(len, found), np.int64, len(found)))
            self.ids.append(np.fromiter((i for x in found for i in x), np.uint32))
        if len(self.ids) > 1:
            self.ids, self.length = [np.concatenate(self.ids)], [np.concatenate(self.length)]
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        length = self.length[0][at]
        start = (np.cumsum(self.length[0]) - self.length[0])[at]
        ends = np.cumsum(length)
        out = self.ids[0][np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + length, length)]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)]).astype(np.int64)]
        return out, edges


class _Pieces:
    """Text of ids, each joined to its piece."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        names = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        self.pieces = np.full(max(names.values()) + 1, "", object)
        self.pieces[list(names.values())] = list(names)

    def texts(self, raw: list[bytes]) -> list[str]:
        return [" ".join(self.pieces[np.frombuffer(ids, "<u4")].tolist()) for ids in raw]


def encode(docs: DataFrame, path: str, most: int = TABLE_WORDS, decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids``, little-endian unsigned 32-bit numbers in a binary, for each row.

    The ids are those of the tokenizer in the file ``path`` without added special tokens; the
    strings of special tokens in a text give their ids. Null and empty texts have no ids. With
    ``decoded`` the same tasks add ``text``, that of :func:`decode`.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = word_table(docs, path, most).toArrow()
    words = rows.column("word").to_pylist()
    lists = rows.column("ids").combine_chunks()
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast((words, ids, length))

    def run(batches):
        table = pieces = None
        for batch in batches:
            for doc_id, texts in _texts(batch):
                table = table or _Table(*shared.value, Splitter(path))
                found, edges = table.encode(texts)
                raw = found.astype("<u4", copy=False).tobytes()
                each = [raw[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns = [doc_id, pa.array(each, pa.binary())]
                if decoded:
                    pieces = pieces or _Pieces(path)
                    columns.append(pa.array(pieces.texts(each), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][: len(columns)])

    return docs.mapInArrow(run, "doc_id long, ids binary" + ", text string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` of the ids: their pieces joined by one space.

    Only for vocabularies without a decoder of their own. Null ids are empty.
    """

    def run(batches):
        pieces = None
        for batch in batches:
            pieces = pieces or _Pieces(path)
            for first in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(first, DECODE_ROWS)
                texts = pieces.texts([raw or b"" for raw in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
