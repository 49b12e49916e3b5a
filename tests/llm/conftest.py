from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, letters="abcdeéü"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages and lines, nulls, empty and odd texts."""
    rng = random.Random(7)
    passage = prose(rng, 40)
    line = "this line stands in very many of the documents"
    texts = []
    for i in range(70):
        lines = [prose(rng, rng.randint(3, 14)) for _ in range(rng.randint(1, 5))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), line)
        if i % 5 == 0:
            lines.append(passage)
        texts.append("\n".join(lines))
    for i in range(20):
        words = texts[i].split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [texts[3]] * 12 + [None, "", " \n\t\n", "one", "a b c", "same same same same same same same same"]
    texts += ["x" * 3000, "é" * 700, "\n".join(["a line that comes again and again"] * 30), "\x00\x1c \x85 odd"]
    return list(enumerate(texts, 1))


@pytest.fixture
def documents(spark, corpus):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in corpus], DOCUMENT)


@pytest.fixture
def odd_documents(spark, corpus):
    """Rows without identifier or language, repeated rows, one identifier for two texts, clashing columns."""
    rows = [(i, t, None if i % 2 else "en", None, None) for i, t in corpus[:40]]
    rows += [rows[5], rows[5], (6, "another text under the same number", None, None, 1), (None, corpus[3][1], None, None, 0)]
    rows += [(None, None, None, None, None), (90, None, None, None, None)]
    extra = "doc found place size key h fp node kept n_words found _doc text_hash template words ids token".split()
    return spark.createDataFrame(rows, DOCUMENT).withColumns({c: F.lit(c) for c in dict.fromkeys(extra)})


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)
