"""Strings made to collide modulo powers of two must not collide, here or in any operator."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import decontaminate, line_dedup, quality, shingle_sets, substring_dedup, suffix_dedup
from tidemark.llm.texts import PRIME, Rolling, _product

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def morse(n=1024, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


WORD, OTHER = morse(), morse(letters="ba")


def test_products_are_exact():
    rng = random.Random(1)
    p = int(PRIME)
    edge = [0, 1, 2, (1 << 31) - 1, 1 << 31, (1 << 30) - 1, p - 1, p - 2]
    a = edge * len(edge) + [rng.randrange(p) for _ in range(500)]
    b = [e for e in edge for _ in edge] + [rng.randrange(p) for _ in range(500)]
    found = _product(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert found == [x * y % p for x, y in zip(a, b)]


@pytest.mark.parametrize("seed", [1, 3, 5, 7, 31])
def test_hash_is_the_polynomial(seed):
    rolling = Rolling(seed)
    raw = random.Random(seed).randbytes(700)
    sums = rolling.sums(np.frombuffer(raw, np.uint8))
    value, codes = 0, rolling.codes.tolist()
    for i, byte in enumerate(raw):
        value = (value + codes[byte] * pow(rolling.base, i, int(PRIME))) % int(PRIME)
        assert int(sums[i + 1]) == value
    again = np.frombuffer(raw + raw, np.uint8)
    twice = rolling.windows(rolling.sums(again), 50)
    assert (twice[:651] == twice[700:1351]).all() and len(set(twice[:700].tolist())) == 700


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 7, 11, 21, 22, 31, 32])
@pytest.mark.parametrize("letters", ["ab", "\x00\xff", "01"])
def test_thue_morse_words(seed, letters):
    rolling = Rolling(seed)
    text = (morse(letters=letters) + morse(letters=letters[::-1])).encode("latin-1")
    at = np.array([0, 1024])
    one, two = rolling.hashes(rolling.sums(np.frombuffer(text, np.uint8)), at, at + 1024)
    assert one != two
    symbols = np.array([5, 9], np.uint64)[[i.bit_count() % 2 for i in range(1024)]]
    one, two = (rolling.windows(rolling.sums(s), 1024)[0] for s in (symbols, np.uint64(14) - symbols))
    assert one != two


@pytest.fixture
def pair(spark):
    """Two documents of 60 equal words and one such word each, inside a line of its own."""

    def make(one, two):
        return spark.createDataFrame([(1, one, "en", "s", 1), (2, two, "en", "s", 1)], DOCUMENT)

    return make


def test_line_dedup(pair):
    own = "this line is long enough and shared by both of them"
    rows = {r.doc_id: r for r in line_dedup.remove_common(pair(f"{own}\n{WORD} x", f"{own}\n{OTHER} x")).collect()}
    assert rows[2].text.strip() == f"{OTHER} x"


def test_quality(pair):
    words = " ".join(f"w{i}" for i in range(4))
    rows = quality.judge(pair(f"{words} {WORD} {words} {OTHER} end of it", "a")).collect()
    assert {r.doc_id: r.n_repeat_words for r in rows}[1] == 0


def test_substrings(pair):
    words = [f"w{i}" for i in range(60)]
    one, two = (" ".join([*words[:30], w, *words[30:]]) for w in (WORD, OTHER))
    rows = {r.doc_id: r for r in substring_dedup.remove_repeats(pair(one, two)).collect()}
    assert rows[2].n_removed == 0


def test_suffixes(pair):
    """The words share strings of 50 bytes; what no smaller document has must stay."""
    first, second = f"{WORD}", f"{OTHER}"
    gone = {i for i in range(975) if second[i : i + 50] in first for i in range(i, i + 50)}
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(pair(first, second)).collect()}
    assert rows[2].n_removed == len(gone)


def test_shingle_sets(pair):
    words = [f"w{i}" for i in range(9)]
    one, two = (" ".join([*words[:5], w, *words[5:]]) for w in (WORD, OTHER))
    assert shingle_sets.one_of_each(pair(one, two), shingle=5).count() == 2


def test_decontamination(spark, pair):
    item = " ".join([f"question{i}" for i in range(6)] + [WORD] + [f"answer{i}" for i in range(6)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.leaks(pair(item, item.replace(WORD, OTHER)), benchmark).collect()
    assert 1 in {r.doc_id for r in found}
    rolling = Rolling(7)
    text = f"{WORD} {OTHER}".encode()
    a, b = rolling.hashes(rolling.sums(np.frombuffer(text, np.uint8)), np.array([0, 1025]), np.array([1024, 2049]))
    assert a != b
