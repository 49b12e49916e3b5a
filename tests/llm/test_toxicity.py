from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity

BAD = ["grobian", "lump", "schuft"]


def texts(rng, n):
    """Invented words; every third text has some bad ones, whole or as beginnings of longer words."""
    out = []
    for i in range(n):
        words = ["".join(rng.choice(["an", "to", "be", "re", "è", "ou", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 200))]
        if i % 3 == 0:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(BAD) + rng.choice(["", "", "anto"]))
        out.append((i, " ".join(words), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def network():
    rows = texts(random.Random(1), 400)
    return toxicity.train([t for _, t, _ in rows], np.array([y for *_, y in rows]))


def accuracy(scores, rows):
    return np.mean([(s >= 0.5) == bool(y) for s, (*_, y) in zip(scores, rows)])


def test_learns(network):
    rows = texts(random.Random(2), 300)
    assert accuracy(toxicity.Scorer(network).scores([t for _, t, _ in rows]), rows) > 0.97


def test_gradients():
    """Every gradient against differences of the loss."""
    net = toxicity.Network(seed=3)
    net.p = {n: (v * (30 if n in ("word", "gram") else 1)).astype(np.float64) for n, v in net.p.items()}
    word, grams, begins = toxicity.features([" ", "one", "two", "three", "one-two"])
    tokens, lengths = np.array([[1, 2, 3, 1], [4, 3, 0, 0], [0, 0, 0, 0]]), np.array([4, 2, 0])
    slope = np.array([0.3, -0.7, 0.2])

    def loss():
        return net.logits(net.project(net.vectors(word, grams, begins)), tokens, lengths) @ slope

    traces = {}
    vectors = net.vectors(word, grams, begins)
    net.logits(net.project(vectors), tokens, lengths, traces)
    found = net.gradients(slope, traces, vectors, word, grams, begins)
    rng = np.random.default_rng(0)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        at = np.flatnonzero(found[name].reshape(-1)) if name in ("word", "gram") else np.arange(len(flat))
        for i in rng.choice(at, min(5, len(at)), False):
            kept = flat[i]
            flat[i] = kept + 1e-2
            up = loss()
            flat[i] = kept - 1e-2
            down = loss()
            flat[i] = kept
            assert found[name].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=2e-4), name


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 112, 113, 1000])
def test_windows_overlap_and_cover(size):
    doc, first, length = toxicity.windows(np.array([5, size, 70]))
    mine = doc == 1
    first, last = first[mine] - 5, first[mine] - 5 + length[mine]
    assert first[0] == 0 and last[-1] == size and length.max() <= toxicity.WINDOW
    assert all(b == a + toxicity.STRIDE for a, b in zip(first, first[1:]))
    assert all(f < e for f, e in zip(first[1:], last))
    assert (doc == 0).sum() == 1 and (doc == 2).sum() == 2


def test_score_is_that_of_the_worst_window(network, monkeypatch):
    clean = " ".join(["anto", "best", "reou"] * 3000)
    plain, late = toxicity.Scorer(network).scores([clean, clean + " lump schuft grobian"])
    assert plain < 0.5 < late
    monkeypatch.setattr(toxicity, "_LONG", 1000)  # a text in slices has the same words
    assert toxicity.Scorer(network).scores([clean, clean + " lump schuft grobian"]) == pytest.approx([plain, late], abs=1e-5)


def test_words_do_not_depend_on_those_kept(network, monkeypatch):
    rows = [t for _, t, _ in texts(random.Random(4), 60)] + [None, "", "123 !", "x" * 5000]
    whole = toxicity.Scorer(network).scores(rows)
    monkeypatch.setattr(toxicity, "_KEPT_WORDS", 50)
    monkeypatch.setattr(toxicity, "_TOKENS", 300)
    assert toxicity.Scorer(network).scores(rows) == pytest.approx(whole, abs=1e-5)
    again = toxicity.Network.load(network.dump())
    assert toxicity.Scorer(again).scores(rows) == pytest.approx(whole, abs=1e-5)


def test_query_learns_only_from_what_is_not_held_out(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 150)
    rows = texts(random.Random(5), 300)
    odd = [(None, "lump schuft", None), (900, None, 1), (901, "", 0), (902, "lump schuft grobian " * 9, None), (0, rows[0][1], None)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + odd], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit("x") for c in ("label", "network", "score", "toxic", "lang")})
    learned = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5]
    # wrong labels of held-out documents, double, null and unknown ones must do no harm
    lies = [(i, 1 - y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    labels = spark.createDataFrame(learned * 2 + lies + [(None, 1), (902, None), (5000, 1)], "doc_id long, toxic int")
    out = toxicity.classify(docs, labels).collect()
    assert len(out) == len(rows) + len(odd)
    truth = {i: y for i, _, y in rows}
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert len({r.score for r in out if r.doc_id == 0}) == 1
    sample = toxicity.sample(docs, labels).collect()
    assert sorted(r.doc_id for r in sample) == sorted(i for i, _ in learned)


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 10)
    docs = spark.range(300).selectExpr("id % 150 as doc_id", "concat('text ', id) as text")
    labels = spark.range(150).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    rows = toxicity.sample(docs, labels).collect()
    assert len(rows) == 20 and sum(r.toxic for r in rows) == 10
    assert all(r.text == min(f"text {r.doc_id}", f"text {r.doc_id + 150}") for r in rows)


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "lump"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in toxicity.classify(docs, labels).collect()] == [(0.0, 0)] * 2
    assert toxicity.classify(docs.limit(0), labels).count() == 0
