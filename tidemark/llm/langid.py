"""Language identification: multinomial naive Bayes over hashed character n-grams.

Tasks count the n-grams of labelled texts by language, Spark sums the counts, and the matrix of log
probabilities, of a fixed width for each language, goes to all tasks, which score blocks of texts
with it. All labelled documents outside the held-out quarter count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import blocks, mixed

MAX_N = 3
BUCKETS = 1 << 15
SMOOTHING = 0.5
# Languages a model may have; with BUCKETS this bounds the matrix to 64 MB.
MAX_LANGUAGES = 256


def held_out(doc_id: Column) -> Column:
    """A fixed quarter of the documents, by a checksum of the identifier; never null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Grams:
    """Hashed n-grams of the letters of texts; runs of other characters count as one space."""

    def __init__(self):
        chars = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x10000)]
        lower = [c.lower() for c in chars]
        self.code = np.array([ord(low if len(low) == 1 else c) if c.isalpha() else 0 for c, low in zip(chars, lower)], np.uint32)

    def _codes(self, points: np.ndarray) -> np.ndarray:
        out = self.code[np.minimum(points, 0xFFFF)]
        for point in np.unique(points[points > 0xFFFF]).tolist():
            char = chr(point)
            out[points == point] = ord(char.lower()) if char.isalpha() else 0
        return out

    def of(self, block) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and document of each n-gram, by document; nothing for texts without a letter."""
        raw = block.data.tobytes()
        points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        inner = (block.data & 0xC0) == 0x80
        edges = np.concatenate([[0], np.cumsum(~inner)])[block.offsets]
        # each text gets a space in front, and one behind from the text that follows
        size = block.size
        owner = np.repeat(np.arange(size), np.diff(edges) + 1)
        codes = np.zeros(len(owner) + 1, np.uint32)
        codes[np.arange(len(points)) + np.repeat(np.arange(1, size + 1), np.diff(edges))] = self._codes(points)
        owner = np.append(owner, size - 1)
        first = np.ones(len(codes), bool)
        first[1:] = owner[1:] != owner[:-1]
        keep = (codes != 0) | first | np.append(False, codes[:-1] != 0)
        codes, owner = codes[keep].astype(np.uint64), owner[keep]
        buckets, docs = [], []
        gram = np.zeros(len(codes), np.uint64)
        for n in range(1, MAX_N + 1):
            if len(codes) < n:
                break
            gram = gram[: len(codes) - n + 1] * np.uint64(0x110001) + codes[n - 1 :]
            inside = owner[: len(gram)] == owner[n - 1 :]
            inside &= (codes[: len(gram)] != 0) | (codes[n - 1 :] != 0)
            buckets.append((mixed(gram + np.uint64(n << 60)) % np.uint64(BUCKETS)).astype(np.int32)[inside])
            docs.append(owner[: len(gram)][inside])
        return np.concatenate(buckets), np.concatenate(docs)


class Model:
    """Languages, sorted, and the log probabilities of buckets in each."""

    def __init__(self, languages: list[str], log: np.ndarray, prior: np.ndarray):
        self.languages, self.log, self.prior = languages, log, prior

    def predict(self, buckets: np.ndarray, docs: np.ndarray, size: int) -> tuple[list[str], np.ndarray]:
        lettered = np.bincount(docs, minlength=size) > 0
        scores = np.stack([np.bincount(docs, row[buckets], minlength=size) for row in self.log], 1) + self.prior
        best = scores.argmax(1)
        scores -= scores.max(1, keepdims=True)
        score = 1 / np.exp(scores).sum(1)
        names = [self.languages[b] if found else "und" for b, found in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, score, 0.0)


def fit(docs: DataFrame) -> Model | None:
    """A model of the non-null ``lang`` values of ``docs``; ``None`` without any.

    Texts that are null or without a letter add nothing. More than ``MAX_LANGUAGES`` languages are an
    error: the matrix that is sent to all tasks would have no bound.
    """

    def run(batches):
        grams = Grams()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for block in blocks(batch):
                langs = np.array(block.column("lang").to_pylist(), object)
                buckets, docs = grams.of(block)
                filled = np.bincount(docs, minlength=block.size) > 0
                for lang in set(langs[filled].tolist()):
                    mine = filled & (langs == lang)
                    counts = np.bincount(buckets[mine[docs]], minlength=BUCKETS + 1)
                    counts[BUCKETS] = mine.sum()  # the documents themselves
                    sums[lang] = sums.get(lang, 0) + counts
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            columns = [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    labelled = docs.where("lang is not null and text is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = labelled.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.limit(MAX_LANGUAGES * (BUCKETS + 1) + 1).toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    table = np.zeros((len(languages), BUCKETS + 1))
    number = {lang: i for i, lang in enumerate(languages)}
    line = np.array([number[lang] for lang in rows.column("lang").to_pylist()])
    table[line, rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    share, documents = table[:, :BUCKETS] + SMOOTHING, table[:, BUCKETS]
    return Model(languages, np.log(share / share.sum(1, keepdims=True)), np.log(documents / documents.sum()))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (the posterior probability) of each row, from its text alone.

    Null texts and texts without a letter, and all texts without a model, are ``und`` with score 0.
    """
    parts = (model.languages, model.log, model.prior) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        grams = Grams()
        held = Model(*shared.value) if shared.value else None
        for batch in batches:
            for block in blocks(batch):
                if held is None:
                    names, scores = ["und"] * block.size, np.zeros(block.size)
                else:
                    names, scores = held.predict(*grams.of(block), block.size)
                columns = [block.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all; adds ``held_out``.

    A row without ``doc_id`` is neither held out nor learned from.
    """
    learned = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return predict(docs, learned).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
