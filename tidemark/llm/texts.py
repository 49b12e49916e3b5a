"""Words and hashes of whole texts, computed for a block of documents at once.

A block is a run of documents laid end to end as UTF-8 bytes. All arrays here are over the bytes
or the words of such a block, and nothing ever reaches across the border of a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Bytes of text handled at once; a longer document forms a block of its own.
BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MASK = (1 << 64) - 1


# Rows of an Arrow batch. Texts are long: Spark's 10,000 rows would hold 100 MB and more, in the
# executor and in Python.
BATCH_ROWS = 500
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Set the rows of Arrow batches for this session, unless its configuration names a number."""
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


class Block:
    """Some documents of an Arrow batch: ``data`` holds the bytes, ``offsets`` the borders."""

    def __init__(self, batch: pa.RecordBatch, first: int, data: np.ndarray, offsets: np.ndarray):
        self.batch = batch
        self.first = first
        self.data = data
        self.offsets = offsets

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name)).slice(self.first, self.size)


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a batch into blocks of about ``limit`` bytes; null texts are empty."""
    column = batch.column(batch.schema.get_field_index(text))
    column = column.fill_null("").cast(pa.large_binary())
    if not len(column):
        return
    _, ends, values = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(
            batch, first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        )
        first = last


def word_spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the document of each.

    Words are ``[^\\x20\\x09-\\x0D]+``, or runs of other bytes than those ``between`` is true for.
    """
    inside = ~between[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, inside
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    start = np.flatnonzero(inside & (~before[:-1] | border[:-1]))
    after = np.empty(len(data), bool)
    if len(data):
        after[:-1], after[-1] = inside[1:], False
    end = np.flatnonzero(inside & (~after | border[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# Sums are modulo this prime. Modulo a power of two, strings of a regular build (Thue-Morse words) would have
# equal sums whatever the base.
PRIME = np.uint64((1 << 61) - 1)
_P = int(PRIME)
_ONE, _SHIFT30, _SHIFT31, _SHIFT61 = (np.uint64(n) for n in (1, 30, 31, 61))
_LOW30, _LOW31 = (np.uint64((1 << n) - 1) for n in (30, 31))


# Places handled at once, so that intermediate results stay in the processor's cache.
_PIECE = 1 << 14
# Codes of bytes have as many bits, which makes their products cheaper.
_CODE_BITS = 30


def _reduced(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo the prime."""
    x = (x & PRIME) + (x >> _SHIFT61)
    return np.minimum(x, x - PRIME)  # the difference wraps round to a large number where it is negative


def _times31(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 times 2^31, modulo the prime but not fully reduced: below 2^61 + 2^33."""
    return (x >> _SHIFT30) + ((x & _LOW30) << _SHIFT31)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, from halves of 31 bits."""
    high_a, low_a, high_b, low_b = a >> _SHIFT31, a & _LOW31, b >> _SHIFT31, b & _LOW31
    # below 2^61 + (2^61 + 2^33) + 2^62
    return _reduced(((high_a * high_b) << _ONE) + _times31(high_a * low_b + low_a * high_b) + low_a * low_b)


def _coded(codes: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Products of codes of few bits with numbers below the prime."""
    return _reduced(_times31((powers >> _SHIFT31) * codes) + (powers & _LOW31) * codes)


class Rolling:
    """Hashes of any substring of a sequence of symbols, from one running sum.

    The sum of ``code(symbol) * base ** position`` modulo a prime gives a substring's hash by one
    subtraction; the power of its start is divided out, so that equal strings hash alike
    wherever they stand. Two different strings of ``n`` symbols have equal hashes for at most ``n`` of the
    2^61 bases. ``seed`` picks the base and the codes of bytes.
    """

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.codes = rng.choice(1 << _CODE_BITS, 256, replace=False).astype(np.uint64)
        self.base = int(rng.integers(1 << 32, _P, dtype=np.uint64))
        self._powers = np.ones(1, np.uint64)
        self._inverse = np.ones(1, np.uint64)

    def _upto(self, n: int) -> None:
        for name, base in (("_powers", self.base), ("_inverse", pow(self.base, -1, _P))):
            powers = getattr(self, name)
            while len(powers) < n:
                step = np.full(1, pow(base, len(powers), _P), np.uint64)
                powers = np.concatenate([powers, _product(powers, step)])
            setattr(self, name, powers)

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        """Running sums over bytes, or over 64-bit symbols that are well spread already."""
        self._upto(len(symbols) + 1)
        out = np.zeros(len(symbols) + 1, np.uint64)
        for begin in range(0, len(symbols), _PIECE):
            some = symbols[begin : begin + _PIECE]
            powers = self._powers[begin : begin + len(some)]
            terms = _coded(self.codes[some], powers) if some.dtype == np.uint8 else _product(_reduced(some), powers)
            # halves are summed on their own, so that nothing wraps round
            high, low = np.cumsum(terms >> _SHIFT31), np.cumsum(terms & _LOW31)
            out[begin + 1 : begin + 1 + len(some)] = _reduced(_times31(high) + low + out[begin])
        return out

    def _differences(self, above: np.ndarray, below: np.ndarray, power: np.ndarray, length) -> np.ndarray:
        """Hashes from the sums at the ends of strings, with the power of their start divided out."""
        apart = above - below
        return mixed(_product(np.minimum(apart, apart + PRIME), power) + length)

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        for begin in range(0, len(start), _PIECE):
            part = slice(begin, begin + _PIECE)
            low, high = start[part], end[part]
            out[part] = self._differences(sums[high], sums[low], self._inverse[low], (high - low).astype(np.uint64))
        return out

    def windows(self, sums: np.ndarray, length: int) -> np.ndarray:
        """Hash of the window of ``length`` symbols at each position it fits."""
        n = max(0, len(sums) - length)
        out = np.empty(n, np.uint64)
        for begin in range(0, n, _PIECE):
            end = min(n, begin + _PIECE)
            below, above = sums[begin:end], sums[begin + length : end + length]
            out[begin:end] = self._differences(above, below, self._inverse[begin:end], np.uint64(0))
        return out


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """Minimum (or maximum) over each window of ``width`` values."""
    if len(values) < width:
        return values[:0]
    span, out = 1, values
    while 2 * span <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - span : width - span + n]) if span < width else out
