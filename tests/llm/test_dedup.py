from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidemark.llm import line_dedup, simhash, substring_dedup, suffix_dedup
from tidemark.llm.components import components

WORD = r"[^\x20\x09-\x0D]+"


def least_holder(docs, parts):
    out = {}
    for i, text in docs:
        for part in parts(text or ""):
            out[part] = min(out.get(part, i), i)
    return out


def windows(sequence, length):
    return [sequence[i : i + length] for i in range(len(sequence) - length + 1)]


def gone(sequence, length, doc_id, first):
    out = set()
    for i, window in enumerate(windows(sequence, length)):
        if first[window] < doc_id:
            out.update(range(i, i + length))
    return out


def words(text):
    return tuple(re.findall(WORD, text or ""))


def removed_words(docs, length):
    docs = [d for d in docs if d[0] is not None]
    first = least_holder(docs, lambda t: windows(words(t), length))
    out = []
    for i, text in docs:
        cut = gone(words(text), length, i, first)
        out.append((i, len(words(text)), len(cut), " ".join(w for k, w in enumerate(words(text)) if k not in cut)))
    return sorted(out)


def removed_bytes(docs, length):
    docs = [(i, (t or "").encode()) for i, t in docs if i is not None]
    first = least_holder(docs, lambda t: windows(t or b"", length))
    out = []
    for i, raw in docs:
        cut = gone(raw, length, i, first)
        spans = sum(k - 1 not in cut for k in cut)
        out.append((i, len(raw), len(cut), spans, bytes(b for k, b in enumerate(raw) if k not in cut)))
    return sorted(out)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def without_null(rows):
    return sorted(r for r in rows if r[0] is not None)


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("levels", [1, 2])
def test_word_windows_equal_brute_force(request, table, levels):
    docs = request.getfixturevalue(table)
    out = substring_dedup.remove_repeats(docs, 8, levels).select("doc_id", "n_words", "n_removed", "kept")
    assert without_null(map(tuple, out.collect())) == removed_words(texts_of(docs), 8)


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("group", [1000, 2])
def test_suffix_arrays_equal_brute_force(request, monkeypatch, table, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "GROUP_SHARE", 0)
    docs = request.getfixturevalue(table)
    out = suffix_dedup.remove_repeats(docs, 30, 10).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert without_null((*r[:4], bytes(r[4])) for r in out.collect()) == removed_bytes(texts_of(docs), 30)


def fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = words(lower)
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + 4]), 42) for i in range(max(len(own) - 3, 1 if own else 0))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_classes(docs, bits):
    prints = [(i, fingerprint(t)) for i, t in docs]
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= bits and root(i) != root(j):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted({(i, f"{p:016x}", root(i)) for i, p in prints})


@pytest.mark.parametrize("table", ["documents", "odd_documents", "no_documents"])
@pytest.mark.parametrize("group", [2048, 2])
def test_simhash_equals_brute_force(request, table, group):
    docs = request.getfixturevalue(table)
    out = simhash.near_duplicates(docs, max_group=group).collect()
    assert len(out) == docs.count()
    assert all(r.component_id is None for r in out if r.doc_id is None)
    known = [d for d in texts_of(docs) if d[0] is not None]
    assert sorted({tuple(r) for r in out if r.doc_id is not None}) == linked_classes(known, 4)


def test_one_document_of_each_group_stays(documents):
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(documents).collect()}
    kept = simhash.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    out = components(spark.createDataFrame([*path, *star, (3, 3), (160, 100)], "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}}


def aligned_by_hand(docs, rare):
    """Lines to delete by the rules in the module's text, over all pairs of documents and lines."""

    def filled(text):
        return [x for x in text.split("\n") if x.strip(" \t\v\f\r")]

    long = lambda x: len(x.encode()) >= line_dedup.MIN_LINE_BYTES
    texts = {i: t for i, t in docs if t is not None}
    holders, seeds = defaultdict(set), defaultdict(dict)
    for i, text in texts.items():
        lines = filled(text)
        for k, x in enumerate(lines):
            if long(x):
                holders[x].add(i)
                after = lines[k + 1] if k + 1 < len(lines) else "" if len(lines) == 1 else None
                if seeds[i].get(x) is None:
                    seeds[i][x] = after
    pairs = defaultdict(set)
    for i, own in seeds.items():
        for x, after in own.items():
            if len(holders[x]) > rare and after is not None:
                pairs[x, after].add(i)
    number = {}
    coded = {i: [0 if not x.strip(" \t\v\f\r") else 2 * number.setdefault(x, len(number) + 1) + long(x) for x in t.split("\n")] for i, t in texts.items()}
    out = {}
    for i, own in seeds.items():
        partners = {min(holders[x]) for x in own if 1 < len(holders[x]) <= rare}
        partners |= {min(pairs[x, a]) for x, a in own.items() if len(pairs.get((x, a), ())) > 1}
        out[i] = sorted({k for p in partners if p < i for k in line_dedup.common_blocks(coded[p], coded[i])})
    return out


@pytest.mark.parametrize("rare", [100, 2])
def test_line_dedup_equals_brute_force(documents, rare):
    found = aligned_by_hand(texts_of(documents), rare)
    assert any(found.values())
    for r in line_dedup.remove_common(documents, rare=rare).collect():
        assert r.n_deleted == len(found.get(r.doc_id, ()))
    texts = dict(texts_of(documents))
    for r in line_dedup.remove_common(documents, rare=rare).select("doc_id", "text").collect():
        cut = found.get(r.doc_id, ())
        before = texts[r.doc_id]
        assert r.text == (None if before is None else "\n".join(x for k, x in enumerate(before.split("\n")) if k not in cut))


def left_by_line_dedup(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in line_dedup.remove_common(docs).orderBy("doc_id").collect()]


A, B, C = ("this is the long line of the letter " + x for x in "ABC")


def test_copies_leave_where_the_first_holder_has_the_lines_elsewhere(spark):
    assert left_by_line_dedup(spark, [f"{A}\n{B}", f"{B}\n{A}", f"{B}\n{A}"])[2] == ""
    assert left_by_line_dedup(spark, [A, B, f"{A}\ns\n{B}", f"{A}\ns\n{B}"])[3] == ""
    assert left_by_line_dedup(spark, [f"{A}\n{C}", f"s\n{A}", f"s\n{A}"])[2] == ""
    assert left_by_line_dedup(spark, [A, B, f"{A}\ns\nt\nu\n{B}", f"t\n{A}\ns\nt\nu\n{B}\nv"])[3] == "t\nv"


def test_a_line_of_many_documents_leaves_all_but_the_first(spark):
    texts = [f"own line number {i} of this document\n{A}\nnext line number {i} of this document" for i in range(150)]
    left = left_by_line_dedup(spark, texts)
    assert left == [texts[0], *(t.replace(A + "\n", "") for t in texts[1:])]


def test_line_dedup_of_odd_tables(odd_documents, no_documents):
    out = line_dedup.remove_common(odd_documents)
    assert out.count() == odd_documents.count()
    assert set(odd_documents.columns) <= set(out.columns)
    assert all(r.n_deleted == 0 for r in out.where("doc_id is null").collect())
    assert line_dedup.remove_common(no_documents).collect() == []


def test_patience_keeps_order_and_grows_blocks():
    assert line_dedup.patience([3, 5, 7, 9], [1, 5, 7, 2]) == [(1, 1), (2, 2)]
    assert line_dedup.patience([3, 5, 3], [3, 3]) == [(0, 0), (2, 1)]
    assert line_dedup.patience([], [3]) == []
    # a block of short lines (even numbers) stays
    assert line_dedup.common_blocks([4, 6, 9], [4, 6, 11]) == []
    assert line_dedup.common_blocks([4, 7, 9], [4, 7, 11]) == [0, 1]


def test_copies_of_texts_of_short_lines(spark):
    short = "\n".join(f"line {i}" + "\n" * (i % 7 == 0) for i in range(40))
    rows = [(1, short), (2, short), (3, short + "\nline 40"), (4, "yes"), (5, "yes"), (6, "\n" + short + "\n")]
    out = {r.doc_id: r for r in line_dedup.remove_common(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.text for i, r in out.items() if i not in (2, 6)} == {i: t for i, t in rows if i not in (2, 6)}
    assert out[2].text == "" and out[2].n_deleted == out[2].n_lines
    # blank lines around the copy belong to no block
    assert not out[6].text.strip() and out[6].n_deleted == out[2].n_deleted


@pytest.mark.parametrize("letters", [2, 90, 256])
@pytest.mark.parametrize("length", [3, 16, 50])
def test_ranks_follow_the_bytes(letters, length):
    rng = np.random.default_rng(letters + length)
    data = rng.integers(256 - letters, 256, 4000).astype(np.uint8)
    data[2000:] = data[:2000]
    at = np.flatnonzero(rng.random(len(data) - length + 1) < 0.6)
    parts = [data[i : i + length].tobytes() for i in at.tolist()]
    number = {p: i for i, p in enumerate(sorted(set(parts)))}
    assert suffix_dedup.suffix_ranks(data, at, length).tolist() == [number[p] for p in parts]


def test_ranks_of_numbers_without_room_for_places():
    values = np.array([1 << 63, 5, (1 << 64) - 1, 5, 1 << 63], np.uint64)
    assert suffix_dedup._ranked(values).tolist() == [1, 0, 2, 0, 1]


def test_prefixes_are_ranked_only_where_windows_need_them(monkeypatch):
    seen = []
    ranked = suffix_dedup._ranked
    monkeypatch.setattr(suffix_dedup, "_ranked", lambda values: seen.append(len(values)) or ranked(values))
    data = np.random.default_rng(3).integers(97, 123, 50 * 400).astype(np.uint8)
    suffix_dedup.suffix_ranks(data, np.arange(0, len(data), 50), 50)
    # single windows: one rank of 50 bytes, made of two, four and eight shorter ones; all 50 suffixes took 200
    assert sum(seen) <= 16 * 400


@pytest.mark.parametrize("table", ["documents", "odd_documents"])
def test_arrays_end_with_a_key(request, monkeypatch, table):
    monkeypatch.setattr(suffix_dedup, "_ARRAY_BYTES", 1)
    docs = request.getfixturevalue(table)
    out = suffix_dedup.remove_repeats(docs, 30, 10).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert without_null((*r[:4], bytes(r[4])) for r in out.collect()) == removed_bytes(texts_of(docs), 30)
