"""Quality rules: simple counts, and the distance of a document's histograms to those of a language.

A histogram of character classes and one of common words are compared with those of each
language by the Jensen-Shannon distance, and the nearest language counts. The references are
summed over all documents that pass the base rules and have few symbols. Short texts have noisy histograms, so each
comparison has a minimum length, below which it does not reject.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import Rolling, blocks, word_spans
from tidemark.sources.staging import stage

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Largest distances (square roots of divergences in bits) of a kept document, and the lengths
# from which each is held against it.
MAX_CLASS_DISTANCE = 0.19
MIN_CLASS_CHARS = 200
MAX_COMMON_DISTANCE = 0.42
MIN_COMMON_WORDS = 100
# Percent of symbols among the characters of words up to which a document counts for a reference.
MAX_REFERENCE_SYMBOLS = 2
# A language becomes a reference with one in so many of all documents that count, which bounds the references by this number.
# Documents of a language without one have no distance.
REFERENCE_SHARE = 1000

# Frequent function words of four languages.
COMMON_WORDS = """
the of and to in a is that it for was on as with be by at are this from or an have not they
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus
de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont
el que y en un ser se no haber por con su para como estar tener los las una del al lo es más
""".split()

_WINDOW = 5
_SYMBOLS = b"#*$%&|<>"
_CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "wide")


def _class_of_bytes() -> np.ndarray:
    """Class of the character a byte begins; the inner bytes of a character have none (7)."""
    out = np.full(256, 5, np.uint8)
    for number, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r", b".,;:!?'\"()-")):
        out[list(chars)] = number
    out[0x80:0xC0] = 7
    out[0xC0:] = 6
    return out


_CLASS = _class_of_bytes()
_IS_SYMBOL = np.isin(np.arange(256), list(_SYMBOLS))
_NO_LETTER = ~np.isin(_CLASS, (0, 1, 6, 7))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _per_document(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated_lines(block) -> list[int]:
    out = []
    raw = block.data.tobytes()
    for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist()):
        lines = [line for line in raw[a:b].split(b"\n") if line.strip(b" \t\v\f\r")]
        out.append(len(lines) - len(set(lines)))
    return out


class Measures:
    """Base counts and histograms of the documents of a block."""

    def __init__(self):
        self.rolling = Rolling(5)
        words = list(dict.fromkeys(COMMON_WORDS))
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w.encode()) for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        hashes = self.rolling.hashes(self.rolling.sums(data), starts, ends)
        self.order = np.argsort(hashes)
        self.common = hashes[self.order]

    def base(self, block) -> dict[str, np.ndarray]:
        data, offsets, size = block.data, block.offsets, block.size
        start, end, doc = word_spans(data, offsets)
        n_words = np.bincount(doc, minlength=size)
        inner = _CLASS[data] == 7
        points = np.concatenate([[0], np.cumsum(~inner, dtype=np.int64)])
        chars = np.bincount(doc, points[end] - points[start], minlength=size).astype(np.int64)
        words = self.rolling.hashes(self.rolling.sums(data), start, end)
        windows = self.rolling.windows(self.rolling.sums(words), _WINDOW)
        n = len(windows)
        inside = np.flatnonzero(doc[:n] == doc[_WINDOW - 1 :]) if n else np.zeros(0, np.int64)
        order = np.lexsort((windows[inside], doc[inside]))
        value, owner = windows[inside][order], doc[inside][order]
        same = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        edge = np.zeros(len(doc) + 1, np.int32)
        at = inside[order[twice]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + _WINDOW, -1)
        repeated = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=size) if len(doc) else np.zeros(size)
        return {
            "n_words": n_words.astype(np.int64),
            "word_chars": chars,
            "n_symbols": _per_document(_IS_SYMBOL[data], offsets),
            "n_dup_lines": np.array(_repeated_lines(block), np.int64),
            "n_repeat_words": repeated.astype(np.int64),
        }

    def histograms(self, block) -> tuple[np.ndarray, np.ndarray]:
        """Counts of character classes, and of the common words and all other words, per document.

        A word with a digit (a number, a key, an address) counts as one digit, whatever its length.
        """
        data, offsets, size = block.data, block.offsets, block.size
        owner = np.repeat(np.arange(size), np.diff(offsets))
        kinds = _CLASS[data]
        start, end, doc = word_spans(data, offsets)
        digits = np.concatenate([[0], np.cumsum(kinds == 2)])
        number = digits[end] > digits[start]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[start[number]] += 1
        edge[end[number]] -= 1
        kinds[np.cumsum(edge[:-1]) > 0] = 7
        classes = np.bincount(owner * 8 + kinds, minlength=size * 8).reshape(size, 8)[:, :7]
        classes[:, 2] = np.bincount(doc[number], minlength=size)
        start, end, doc = word_spans(data, offsets, _NO_LETTER)
        hashes = self.rolling.hashes(self.rolling.sums(_LOWER[data]), start, end)
        at = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
        kind = np.where(self.common[at] == hashes, self.order[at], len(self.common))
        width = len(self.common) + 1
        return classes, np.bincount(doc * width + kind, minlength=size * width).reshape(size, width)


def _failed(base: dict[str, np.ndarray], min_words: int, percent: int) -> np.ndarray:
    return (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > percent * base["n_words"])


def _distance(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Smallest Jensen-Shannon distance of each row to a reference; 0 for rows without a count."""
    p = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    best = np.full(len(p), 1.0 if len(references) else 0.0)
    for q in references:
        m = (p + q) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            left = np.where(p > 0, p * np.log2(p / m), 0).sum(1)
            right = np.where(q > 0, q * np.log2(q / m), 0).sum(1)
        best = np.minimum(best, np.sqrt(np.maximum((left + right) / 2, 0)))
    return np.where(counts.sum(1) > 0, best, 0.0)


def references(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = MAX_REPEAT_PERCENT) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names of the languages, and their class and common-word shares, a row each.

    Sums run over all documents that pass the base rules and have few symbols; documents without ``lang`` count as
    one language more. What comes to the driver has at most ``REFERENCE_SHARE`` times 110 numbers.
    """

    def run(batches):
        measures = Measures()
        for batch in batches:
            sums: dict = {}
            for block in blocks(batch):
                base = measures.base(block)
                good = ~_failed(base, min_words, percent)
                good &= 100 * base["n_symbols"] <= MAX_REFERENCE_SYMBOLS * base["word_chars"]
                counts = np.concatenate([good[:, None], *measures.histograms(block)], axis=1)[good]
                langs = np.array(block.column("lang").fill_null("").to_pylist(), object)[good]
                for lang in set(langs.tolist()):
                    sums[lang] = sums.get(lang, 0) + counts[langs == lang].sum(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                ["lang", "counts"],
            )

    parts = docs.mapInArrow(run, "lang string, counts array<long>")
    width = len(_CLASSES) + len(set(COMMON_WORDS)) + 2
    sums = parts.groupBy("lang").agg(*(F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(width)))
    sums = stage(sums, "references")
    total = sums.agg(F.coalesce(F.sum("c0"), F.lit(0))).first()[0]
    rows = sums.where((F.col("c0") > 0) & (REFERENCE_SHARE * F.col("c0") >= total)).orderBy("lang").collect()
    counts = np.array([tuple(r)[2:] for r in rows], float).reshape(len(rows), width - 1)
    split = len(_CLASSES)
    shares = [x / np.maximum(x.sum(1, keepdims=True), 1) for x in (counts[:, :split], counts[:, split:])]
    return [r[0] for r in rows], *shares


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Rules:
    """The limits, and the references they hold a document against."""

    def __init__(self, found: tuple[list[str], np.ndarray, np.ndarray], min_words: int, percent: int, max_class: float, max_common: float):
        self.langs, *self.found = found
        self.limits = (min_words, percent)
        self.distances = (max_class, max_common)
        self.measures = Measures()

    def verdicts(self, block) -> dict[str, np.ndarray]:
        out = self.measures.base(block)
        classes, common = self.measures.histograms(block)
        failed = _failed(out, *self.limits)
        out["base_failed"] = failed
        judged = pc.is_in(block.column("lang").cast(pa.string()).fill_null(""), pa.array(self.langs, pa.string()))
        judged = judged.to_numpy(zero_copy_only=False)
        # no number compares as far
        out["class_distance"] = np.where(judged, _distance(classes, self.found[0]), np.nan)
        out["common_distance"] = np.where(judged, _distance(common, self.found[1]), np.nan)
        far = (out["class_distance"] > self.distances[0]) & (classes.sum(1) >= MIN_CLASS_CHARS)
        far |= (out["common_distance"] > self.distances[1]) & (common.sum(1) >= MIN_COMMON_WORDS)
        out["kept"] = ~failed & ~far
        return out


def rules(
    docs: DataFrame, min_words: int = MIN_WORDS, percent: int = MAX_REPEAT_PERCENT,
    max_class: float = MAX_CLASS_DISTANCE, max_common: float = MAX_COMMON_DISTANCE,
) -> Rules:
    """The rules with references of ``docs`` (columns ``text`` and ``lang``).

    A document is held against the nearest reference, unless its own language has none: then, as in a table without
    any document that can count for one, its distances are null and not judged.
    """
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    return Rules(references(texts, min_words, percent), min_words, percent, max_class, max_common)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_VERDICT = ", ".join(f"{c} long" for c in _COUNTS) + (
    ", base_failed boolean, class_distance double, common_distance double, kept boolean"
)


def judge(docs: DataFrame, **options) -> DataFrame:
    """One row per row: ``doc_id``, the base counts, ``base_failed``, both distances and ``kept``.

    Null and empty texts have no words, hence fail.
    """
    held = rules(docs, **options)

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                found = held.verdicts(block)
                columns = [block.column("doc_id"), *(pa.array(x, from_pandas=True) for x in found.values())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *found])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return narrow.mapInArrow(run, f"doc_id long, {_VERDICT}")


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all columns; nothing is shuffled."""
    held = rules(docs, **options)

    def run(batches):
        for batch in batches:
            for block in blocks(batch):
                rows = batch.slice(block.first, block.size)
                yield rows.filter(pa.array(held.verdicts(block)["kept"]))

    return docs.mapInArrow(run, docs.schema)
