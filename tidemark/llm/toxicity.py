"""Toxicity of texts by a recurrent network over words and their characters.

Each word enters as a hashed word vector and the sum of hashed vectors of its character n-grams. Gated
recurrent units read a window of words in both directions, attention pools what they say of each word,
and the pooled vector gives the window's logit. A text is as toxic as its most toxic window; windows
overlap and cover the whole text. The network is trained in numpy, in one task, on a bounded sample of
labelled documents (``SAMPLE_DOCS`` of each label, none longer than ``SAMPLE_CHARS``), and learns from
labels of documents alone: of a toxic one the window it finds most toxic is taken for the toxic one.
"""

from __future__ import annotations

import io
import re
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import mixed
from tidemark.sources.staging import stage

WINDOW = 64
STRIDE = 48

WORD_BUCKETS, WORD_SIZE = 1 << 14, 8
GRAM_BUCKETS, GRAM_SIZE = 1 << 15, 12
GRAMS = (3, 4, 5)
HIDDEN = 12
ATTENTION = 12

# Bounds of the sample the network is fitted on: documents of each label, and characters of one.
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 20_000
# Passes over the sample, or more until so many steps are made.
EPOCHS, STEPS = 5, 400
DOCS_A_STEP = 32
RATE = 0.01
# How much more a clean document counts than a toxic one, as they are far more frequent than in the sample.
CLEAN_WEIGHT = 2.0

# Longer runs of letters are cut, so that no word is without bound.
_WORD = re.compile(r"[^\W\d_]{1,64}")
# Characters of a text, or else words, split at once; tokens scored together; distinct words a task keeps.
_LONG, _TOKENS, _KEPT_WORDS = 1 << 18, 1 << 17, 1 << 17
_WINDOWS = 512


def held_out(doc_id: Column) -> Column:
    """A fixed fifth of the documents, by a checksum of the identifier; never null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Words(dict):
    """Numbers of words, from 1, in the order they were first met; 0 stands behind the end of a text."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) + 1
        return number

    def of(self, text: str | None) -> np.ndarray:
        text = (text or "").lower()
        if len(text) <= _LONG:
            return self._numbers(_WORD.findall(text))
        found = (m.group() for m in _WORD.finditer(text))
        return np.concatenate([self._numbers(s) for s in iter(lambda: list(islice(found, _LONG)), [])] or [np.zeros(0, np.int32)])

    def _numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word; buckets of all character n-grams, by word, and where each word's begin.

    A word is framed by spaces, so beginnings and ends have n-grams of their own.
    """
    codes = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # characters up to the end of the frame
    owner = np.repeat(np.arange(len(words)), sizes)
    powers = np.full(int(sizes.max()), 0x100000001B3, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.add.reduceat(codes * powers[np.arange(len(codes)) - np.repeat(ends - sizes, sizes)], ends - sizes)
    word = (mixed(sums + np.uint64(1)) % np.uint64(WORD_BUCKETS)).astype(np.int32)
    grams, owners, gram = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(codes) < n:
            break
        gram = gram[: len(codes) - n + 1] * np.uint64(0x110001) + codes[n - 1 :]
        if n in GRAMS:
            whole = left[: len(gram)] >= n
            grams.append((mixed(gram[whole] + np.uint64(n << 60)) % np.uint64(GRAM_BUCKETS)).astype(np.int32))
            owners.append(owner[: len(gram)][whole])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return word, grams[order], np.searchsorted(owners[order], np.arange(len(words)))


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and length of all windows of texts laid end to end; an empty text has an empty one."""
    counts = 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(sizes)), counts)
    first = (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    length = np.minimum(WINDOW, sizes[doc] - first)
    return doc, first + np.repeat(np.cumsum(sizes) - sizes, counts), length


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name, in ``p``; directions 0 (forward) and 1 (backward) have weights of their own."""

    def __init__(self, parameters: dict[str, np.ndarray] | None = None, seed: int = 0):
        if parameters is not None:
            self.p = parameters
            return
        rng = np.random.default_rng(seed)
        size = WORD_SIZE + GRAM_SIZE

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        # vectors begin near zero, so that words never learned say next to nothing
        self.p = {"word": normal(WORD_BUCKETS, WORD_SIZE, scale=0.01), "gram": normal(GRAM_BUCKETS, GRAM_SIZE, scale=0.01)}
        for d in "01":
            self.p["in" + d] = normal(size, 3 * HIDDEN, scale=size**-0.5)
            self.p["bias" + d] = np.zeros(3 * HIDDEN, np.float32)
            self.p["state" + d] = normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5)
        self.p["look"] = normal(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5)
        self.p["look_bias"] = np.zeros(ATTENTION, np.float32)
        self.p["weigh"] = normal(ATTENTION, scale=ATTENTION**-0.5)
        self.p["out"] = normal(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5)
        self.p["out_bias"] = np.full(1, -2, np.float32)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as parts:
            return cls({name: parts[name] for name in parts.files})

    def vectors(self, word: np.ndarray, grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Input vector of each word: its own, and the sum of its n-grams over the root of their number."""
        counts = np.diff(np.append(begins, len(grams)))
        chars = np.add.reduceat(self.p["gram"][grams], begins) / np.sqrt(counts, dtype=np.float32)[:, None]
        return np.concatenate([self.p["word"][word], chars], 1)

    def project(self, vectors: np.ndarray) -> list[np.ndarray]:
        """What each word adds to the gates, by direction."""
        return [vectors @ self.p["in" + d] + self.p["bias" + d] for d in "01"]

    def _read(self, projected: np.ndarray, tokens: np.ndarray, inside: np.ndarray, d: str, trace: list | None) -> np.ndarray:
        """States (step, window, unit) of one direction; places outside a text leave the state as it is."""
        state = self.p["state" + d]
        steps = range(tokens.shape[1]) if d == "0" else range(tokens.shape[1] - 1, -1, -1)
        h = np.zeros((len(tokens), HIDDEN), np.float32)
        out = np.empty((tokens.shape[1], len(tokens), HIDDEN), np.float32)
        for t in steps:
            x, s = projected[tokens[:, t]], h @ state
            gates = _sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            z, r, inner = gates[:, :HIDDEN], gates[:, HIDDEN:], s[:, 2 * HIDDEN :]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * inner)
            keep = inside[:, t, None]
            if trace is not None:
                trace.append((t, h, z, r, n, inner, keep))
            h = h + keep * (1 - z) * (n - h)
            out[t] = h
        return out

    def logits(self, projected: list[np.ndarray], tokens: np.ndarray, lengths: np.ndarray, traces: dict | None = None) -> np.ndarray:
        """Logit of each window of word numbers; with ``traces`` all that :meth:`gradients` needs is kept there."""
        inside = (np.arange(tokens.shape[1]) < lengths[:, None]).astype(np.float32)
        traced = {d: [] if traces is not None else None for d in "01"}
        states = np.concatenate([self._read(projected[int(d)], tokens, inside, d, traced[d]) for d in "01"], 2)
        seen = np.tanh(states @ self.p["look"] + self.p["look_bias"])
        marks = np.where(inside.T > 0, seen @ self.p["weigh"], -1e9)
        weights = np.exp(marks - marks.max(0, initial=-1e9)) * inside.T
        weights = (weights / np.maximum(weights.sum(0), 1e-9)).astype(np.float32)
        pooled = np.einsum("tb,tbh->bh", weights, states)
        if traces is not None:
            traces.update(traced, states=states, seen=seen, weights=weights, pooled=pooled, tokens=tokens)
        return pooled @ self.p["out"] + self.p["out_bias"][0]

    def gradients(self, slope: np.ndarray, traces: dict, vectors: np.ndarray, word: np.ndarray, grams: np.ndarray, begins: np.ndarray) -> dict:
        """Gradients of all parameters, given the loss's ``slope`` in each logit."""
        g: dict[str, np.ndarray] = {}
        slope = slope.astype(np.float32)
        states, seen, weights, tokens = (traces[n] for n in ("states", "seen", "weights", "tokens"))
        g["out"], g["out_bias"] = traces["pooled"].T @ slope, slope.sum(keepdims=True)
        d_pooled = slope[:, None] * self.p["out"]
        d_weights = np.einsum("bh,tbh->tb", d_pooled, states)
        d_marks = weights * (d_weights - (weights * d_weights).sum(0))
        d_seen = d_marks[:, :, None] * self.p["weigh"] * (1 - seen**2)
        g["weigh"] = np.einsum("tb,tbk->k", d_marks, seen)
        g["look"] = np.einsum("tbh,tbk->hk", states, d_seen)
        g["look_bias"] = d_seen.sum((0, 1))
        d_states = weights[:, :, None] * d_pooled + d_seen @ self.p["look"].T
        d_vectors = np.zeros_like(vectors)
        for d in "01":
            own = d_states[:, :, HIDDEN * int(d) : HIDDEN * (int(d) + 1)]
            state = self.p["state" + d]
            g["state" + d], d_projected = np.zeros_like(state), np.zeros((len(vectors), 3 * HIDDEN), np.float32)
            d_h = np.zeros((tokens.shape[0], HIDDEN), np.float32)
            for t, h, z, r, n, inner, keep in reversed(traces[d]):
                d_h = d_h + own[t]
                d_new = d_h * keep
                d_n = d_new * (1 - z) * (1 - n**2)
                d_gates = np.concatenate([d_new * (h - n) * z * (1 - z), d_n * inner * r * (1 - r)], 1)
                d_inner = np.concatenate([d_gates, d_n * r], 1)
                g["state" + d] += h.T @ d_inner
                np.add.at(d_projected, tokens[:, t], np.concatenate([d_gates, d_n], 1))
                d_h = d_h - d_new * (1 - z) + d_inner @ state.T
            g["in" + d], g["bias" + d] = vectors.T @ d_projected, d_projected.sum(0)
            d_vectors += d_projected @ self.p["in" + d].T
        counts = np.diff(np.append(begins, len(grams)))
        d_chars = d_vectors[:, WORD_SIZE:] / np.sqrt(counts, dtype=np.float32)[:, None]
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        np.add.at(g["word"], word, d_vectors[:, :WORD_SIZE])
        np.add.at(g["gram"], grams, np.repeat(d_chars, counts, 0))
        return g


class _Adam:
    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p, self.steps = parameters, 0
        self.mean = {n: np.zeros_like(v) for n, v in parameters.items()}
        self.square = {n: np.zeros_like(v) for n, v in parameters.items()}

    def step(self, gradients: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients.values()))
        for n, g in gradients.items():
            g = g / max(1.0, norm)
            self.mean[n] += 0.1 * (g - self.mean[n])
            self.square[n] += 0.01 * (g**2 - self.square[n])
            corrected = self.mean[n] / (1 - 0.9**self.steps)
            self.p[n] -= rate * corrected / (np.sqrt(self.square[n] / (1 - 0.99**self.steps)) + 1e-8)


def _matrix(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Word numbers of windows, one a row, as wide as the longest."""
    at = np.arange(max(1, int(length.max())))
    places = np.minimum(first[:, None] + at, max(len(ids) - 1, 0))
    return np.where(at < length[:, None], ids[places], 0) if len(ids) else np.zeros((len(first), len(at)), np.int32)


def _all_logits(network: Network, projected: list[np.ndarray], ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logits of any number of windows, longest first, some hundreds at once."""
    out = np.empty(len(first), np.float32)
    order = np.argsort(-length, kind="stable")
    for part in np.split(order, range(_WINDOWS, len(order), _WINDOWS)):
        out[part] = network.logits(projected, _matrix(ids, first[part], length[part]), length[part])
    return out


def train(texts: list[str], toxic: np.ndarray, seed: int = 0) -> Network:
    """A network fitted to whole texts and their labels.

    In the first pass all windows of a toxic text count as toxic, later only its most toxic one. Of a clean text
    the most toxic window counts, as it decides, and in the first pass all.
    """
    rng, network, words = np.random.default_rng(seed), Network(seed=seed), Words()
    ids = [words.of(text) for text in texts]
    sizes = np.array([len(i) for i in ids])
    ids = np.concatenate(ids)
    # number 0 needs a row too; it is never inside a window
    word, grams, begins = features([" ", *words])
    doc, first, length = windows(sizes)
    by_doc = np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1)
    steps = -(-len(texts) // DOCS_A_STEP)
    epochs = max(EPOCHS, -(-STEPS // steps))
    adam, done = _Adam(network.p), 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        if epoch:
            scores = _all_logits(network, network.project(network.vectors(word, grams, begins)), ids, first, length)
        for begin in range(0, len(order), DOCS_A_STEP):
            some = order[begin : begin + DOCS_A_STEP]
            if epoch:
                picked = np.array([by_doc[i][scores[by_doc[i]].argmax()] for i in some])
            else:
                picked = np.concatenate([by_doc[i] if len(by_doc[i]) <= 4 else rng.choice(by_doc[i], 4, False) for i in some])
            tokens = _matrix(ids, first[picked], length[picked])
            used, local = np.unique(tokens, return_inverse=True)
            w, g, b = word[used], *_gather(grams, begins, used)
            vectors, traces = network.vectors(w, g, b), {}
            logit = network.logits(network.project(vectors), local.reshape(tokens.shape), length[picked], traces)
            label = toxic[doc[picked]]
            slope = (_sigmoid(logit) - label) * np.where(label > 0, 1, CLEAN_WEIGHT) / len(picked)
            adam.step(network.gradients(slope, traces, vectors, w, g, b), RATE * (1 - done / (epochs * steps)))
            done += 1
    return network


def _gather(grams: np.ndarray, begins: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some words, and where each word's begin."""
    counts = np.diff(np.append(begins, len(grams)))[some]
    starts = np.cumsum(counts) - counts
    return grams[np.arange(counts.sum()) - np.repeat(starts, counts) + np.repeat(begins[some], counts)], starts


class Scorer:
    """A network with the gate inputs of the words met so far."""

    def __init__(self, network: Network):
        self.network = network
        self._clear()

    def _clear(self) -> None:
        self.words = Words()
        self.projected = [np.zeros((1, 3 * HIDDEN), np.float32) for _ in "01"]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, begin, ids, size = np.empty(len(texts)), 0, [], 0
        for i, text in enumerate(texts):
            ids.append(self.words.of(text))
            size += len(ids[-1])
            if size >= _TOKENS or i == len(texts) - 1:
                out[begin : i + 1] = self._scores(ids)
                begin, ids, size = i + 1, [], 0
        return out

    def _scores(self, ids: list[np.ndarray]) -> np.ndarray:
        fresh = list(islice(self.words, len(self.projected[0]) - 1, None))
        if fresh:
            new = self.network.project(self.network.vectors(*features(fresh)))
            self.projected = [np.concatenate(pair) for pair in zip(self.projected, new)]
        doc, first, length = windows(np.array([len(i) for i in ids]))
        logit = _all_logits(self.network, self.projected, np.concatenate(ids), first, length)
        most = np.maximum.reduceat(logit, np.flatnonzero(np.diff(doc, prepend=-1)))
        if len(self.words) > _KEPT_WORDS:
            self._clear()
        return np.round(_sigmoid(most.astype(float)), 6)


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)`` of at most ``SAMPLE_DOCS`` labelled documents of each label, none held out.

    They are chosen by a hash of the identifier. A document with both labels counts as toxic; of several texts
    under one identifier the least counts. Null texts, longer texts and null labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id").cast("long")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic").cast("int") > 0).cast("int").alias("toxic"))
    known = stage(known, "toxic-labels")
    chosen = [known.where(f"toxic = {label}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS) for label in (0, 1)]
    # the chosen are 2 * SAMPLE_DOCS rows of two numbers at most
    chosen = F.broadcast(stage(chosen[0].unionByName(chosen[1]), "toxic-sample"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.char_length("text") <= SAMPLE_CHARS).join(chosen, "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """A network fitted in one task on :func:`sample`; none without a labelled text."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        return pd.DataFrame({"network": [train(rows["text"].tolist(), rows["toxic"].to_numpy()).dump()]})

    fitted = stage(sample(docs, labels).groupBy(F.lit("all")).applyInPandas(run, "network binary"), "toxic-network").first()
    return Network.load(bytes(fitted.network)) if fitted else None


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of each row, from its text alone; null texts are empty. Without a network all are 0.

    A text without a word has one empty window and so a score as well.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network.p if network else None)

    def run(batches):
        scorer = Scorer(Network(shared.value)) if shared.value else None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, score all; adds ``held_out`` and ``predicted``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
