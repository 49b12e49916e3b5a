"""Suffix-array dedup of bytes: later copies of strings of 50 bytes go, the first stays.

Longest previous factors need equal strings in one place. Windows of the full length are dealt by
their anchor, the 16-byte string of smallest hash in them, so equal windows meet; neighbouring windows
with one anchor travel as one string. Most strings need no suffix array: a string that a smaller
document has whole goes, and a string whose anchor no other string has stays. This first pass sends
hashes alone, packed by column. The strings left, whose anchor stands in several strings, go
as bytes to suffix arrays, built by prefix doubling over many anchors at once; in suffix order the
previous and the next position of a smaller document tell whether an earlier match is long enough.

Anchors with very many strings (the borders of a passage in many documents) would meet in one task.
Their strings are cut into single windows and dealt by content instead, where equal ones combine
before the shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.repeats import POSITION_BITS, anchors, covered, first_here, gathered, spans_of, tags, with_places
from tidemark.llm.texts import Rolling, blocks, mixed, sliding
from tidemark.sources.staging import stage

LENGTH = 50
ANCHOR = 16
# Strings of one anchor that go to one suffix array: this many, or this share of all.
GROUP = 1000
GROUP_SHARE = 1e-4

_CONTENT_BITS = 40
_ALONE, _MANY, _NOTE, _DECIDED = 0, 1, 2, 3
# Bytes in one suffix array: its numbers stay in the processor's cache.
_ARRAY_BYTES = 1 << 16


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(8, n).T.copy().view("<u8").ravel()


def _pack(rows: dict[str, np.ndarray]) -> bytes:
    """Rows sorted by ``h``, as byte planes of differences and of indexes into the documents of the rows."""
    n = len(rows["h"])
    order = np.lexsort((rows["tag"], rows["doc_id"]))
    doc_id, tag = rows["doc_id"][order], rows["tag"][order]
    new = np.append(True, (doc_id[1:] != doc_id[:-1]) | (tag[1:] != tag[:-1]))[:n]
    at = np.empty(n, np.int64)
    at[order] = np.cumsum(new) - 1
    known = doc_id[new]
    parts = [np.diff(rows["h"], prepend=np.uint64(0)), rows["c"], at, rows["position"], rows["size"], rows["flag"]]
    ids = [np.diff(known, prepend=0), tag[new] >> POSITION_BITS]
    raw = b"".join(map(_planes, parts)) + b"".join(_planes(x.astype(np.int64).view(np.uint64)) for x in ids)
    return np.array([n, len(known)], "<i8").tobytes() + zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    n, m = np.frombuffer(blob[:16], "<i8").tolist()
    raw = zstandard.ZstdDecompressor().decompress(blob[16:])
    h, c, at, position, size, flag = (_from_planes(raw[8 * n * i : 8 * n * (i + 1)], n) for i in range(6))
    ids, tag = (_from_planes(raw[48 * n + 8 * m * i : 48 * n + 8 * m * (i + 1)], m).view(np.int64) for i in range(2))
    return {
        "h": np.cumsum(h), "c": c, "doc_id": np.cumsum(ids)[at], "tag": tag[at] << POSITION_BITS,
        "position": position.view(np.int64), "size": size.view(np.int64), "flag": flag,
    }


def _strings(block, rolling: Rolling, length: int, width: int) -> dict[str, np.ndarray]:
    """Strings of neighbouring windows with one anchor: hash of the anchor, of the string, first window, windows."""
    data, offsets = block.data, block.offsets
    doc = np.repeat(np.arange(block.size), np.diff(offsets))
    sums = rolling.sums(data)
    hashes = rolling.windows(sums, width)
    least = sliding(hashes, length - width + 1)
    at = anchors(hashes, doc, length, width, least)
    n = max(0, len(doc) - length + 1)
    window = np.flatnonzero(doc[:n] == doc[length - 1 :]) if n else np.zeros(0, np.int64)
    if not len(window):
        return {}
    least = least[window]
    # the first anchor at or behind a window, then the next ones
    before = np.zeros(len(doc) + 1, np.int64)
    before[at + 1] = 1
    own = np.cumsum(before, out=before)[window]
    anchor = hashes[at]
    wrong = np.flatnonzero(anchor[own] != least)
    while len(wrong):
        own[wrong] += 1
        wrong = wrong[anchor[own[wrong]] != least[wrong]]
    new = np.ones(len(window), bool)
    new[1:] = (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    start = window[first]
    size = np.diff(np.append(first, len(window)))
    content = rolling.hashes(sums, start, start + size + length - 1) >> np.uint64(64 - _CONTENT_BITS)
    owner = doc[start]
    return {
        "h": anchor[own[first]], "c": content, "position": start - offsets[owner], "size": size, "start": start,
        "doc_id": block.column("doc_id").to_numpy(zero_copy_only=False)[owner],
        "tag": tags(block.column("text_hash").to_numpy(zero_copy_only=False))[owner],
    }


def _screen(docs: DataFrame, length: int, width: int) -> DataFrame:
    """Strings that a smaller document has whole (``key`` null), and those for a suffix array (``key`` their anchor)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 8 * parts

    def send(batches):
        rolling = Rolling(31)
        strings = ([x for block in blocks(batch) if (x := _strings(block, rolling, length, width))] for batch in batches)
        for found in gathered(strings, lambda x: len(x["h"])):
            rows = {k: np.concatenate([x[k] for x in found]) for k in found[0] if k != "start"}
            first, _, later = first_here([rows["c"], rows["h"]], rows["doc_id"])
            # neighbouring strings decided here travel as one
            place = rows["tag"][later] | rows["position"][later]
            order = np.lexsort((place, rows["doc_id"][later]))
            at, place = later[order], place[order]
            joined = np.zeros(len(at), bool)
            joined[1:] = (place[1:] == place[:-1] + rows["size"][at[:-1]]) & (rows["doc_id"][at][1:] == rows["doc_id"][at][:-1])
            head = np.flatnonzero(~joined)
            runs = {k: v[at[head]] for k, v in rows.items()}
            if len(head):
                runs["size"] = np.add.reduceat(rows["size"][at], head)
            runs["h"] = mixed(place[head].view(np.uint64) ^ runs["h"])
            runs["flag"] = np.full(len(head), _DECIDED)
            rows = {k: v[first] for k, v in rows.items()}
            order = np.lexsort((rows["c"], rows["h"]))
            rows = {k: v[order] for k, v in rows.items()}
            h, c = rows["h"], rows["c"]
            group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
            change = np.zeros(len(h), bool)
            change[1:] = (h[1:] == h[:-1]) & (c[1:] != c[:-1])
            many = (np.bincount(group, change) > 0)[group]
            rows["flag"] = np.where(many, _MANY, _ALONE)
            notes = {k: v[many & np.append(True, h[1:] != h[:-1])] for k, v in rows.items()}
            notes["flag"] = np.full(len(notes["h"]), _NOTE)
            rows = {k: np.concatenate([rows[k], notes[k], runs[k]]) for k in rows}
            dealt = np.where(rows["flag"] == _MANY, mixed(rows["h"] ^ mixed(rows["c"])), rows["h"])
            bucket = (dealt >> np.uint64(20)) % np.uint64(buckets)
            order = np.lexsort((rows["h"], bucket))
            rows = {k: v[order] for k, v in rows.items()}
            bucket = bucket[order]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(cuts[1:], len(bucket))
            packs = [_pack({k: v[a:b] for k, v in rows.items()}) for a, b in zip(cuts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cuts].astype(np.int32)), pa.array(packs, pa.binary())], ["bucket", "pack"])

    def decide(batches):
        held, at = [], None
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if held and bucket != at:
                    yield decided_bucket(held)
                    held = []
                held.append(_unpack(blob.as_py()))
                at = bucket
        if held:
            yield decided_bucket(held)

    def decided_bucket(found):
        rows = {k: np.concatenate([x[k] for x in found]) for k in found[0]}
        note, decided = rows["flag"] == _NOTE, rows["flag"] == _DECIDED
        real = ~note & ~decided
        order = np.flatnonzero(real)
        order = order[np.lexsort((rows["doc_id"][order], rows["c"][order], rows["h"][order]))]
        h, c, ids = rows["h"][order], rows["c"][order], rows["doc_id"][order]
        new_h = np.append(True, h[1:] != h[:-1])[: len(h)]
        new_c = new_h | np.append(True, c[1:] != c[:-1])[: len(h)]
        later = ids > ids[new_c][np.cumsum(new_c) - 1]
        several = (np.bincount(np.cumsum(new_h) - 1, new_c) > 1)[np.cumsum(new_h) - 1]
        several |= (rows["flag"][order] == _MANY) | np.isin(h, rows["h"][note])
        at = np.concatenate([np.flatnonzero(decided), order[later], order[several & ~later]])
        open_ = np.zeros(len(at), bool)
        open_[len(at) - int((several & ~later).sum()) :] = True
        place = rows["tag"][at] | rows["position"][at]
        columns = [
            pa.array(rows["doc_id"][at]), pa.array(place), pa.array(rows["size"][at].astype(np.int32)),
            pa.array(rows["h"][at].view(np.int64), mask=~open_),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "size", "key"])

    sent = docs.mapInArrow(send, "bucket int, pack binary").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return sent.mapInArrow(decide, "doc_id long, place long, size int, key long")


def _ranked(values: np.ndarray) -> np.ndarray:
    """Ranks of numbers, from 0; equal numbers share one."""
    bits = max(len(values) - 1, 0).bit_length()
    if int(values.max()).bit_length() + bits > 64:
        return np.unique(values, return_inverse=True)[1].astype(np.uint64)
    # numbers with their places in the low bits: a plain sort takes less than half the time of an indirect one
    both = (values << np.uint64(bits)) | np.arange(len(values), dtype=np.uint64)
    both.sort()
    place = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    both >>= np.uint64(bits)
    new = np.zeros(len(both), np.uint64)
    new[1:] = both[1:] != both[:-1]
    out = np.empty(len(both), np.uint64)
    out[place] = np.cumsum(new)
    return out


def suffix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at the ascending places ``at`` by their first ``length`` bytes, by prefix doubling.

    All of them have as many bytes. Shorter prefixes are ranked only where a longer one is made of them, so the
    bytes behind the first ``length`` of a string add little.
    """
    if not len(at):
        return np.zeros(0, np.uint64)
    known = np.zeros(256, bool)
    known[data] = True
    codes = (np.cumsum(known) - 1).astype(np.uint64)[data]
    base, bits = max(int(known.sum()), 2), len(data).bit_length()
    # as many bytes at once as leave room for a place
    have = 1
    while have < length and (base ** (have + 1) - 1).bit_length() + bits <= 64:
        have += 1
    steps, long = [], have
    while long < length:
        steps.append(min(long, length - long))
        long += steps[-1]
    needed = np.zeros(len(data), bool)
    needed[at] = True
    places = [at]
    for step in reversed(steps):
        needed[step:] |= needed[:-step].copy()
        places.append(np.flatnonzero(needed))
    here = places.pop()
    number = codes[here]
    for step in range(1, have):
        number = number * np.uint64(base) + codes[here + step]
    rank = _ranked(number)
    whole = np.empty(len(data), np.uint64)
    for step in steps:
        whole[here] = rank
        here = places.pop()
        rank = _ranked(whole[here] * (rank.max() + np.uint64(1)) + whole[here + step])
    return rank


def earlier_match(ranks: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which windows have their longest previous factor in a smaller document at full length.

    In suffix order the longest match with a smaller document is at a nearest position that belongs to
    one. The match has the full length when that position shares the rank, so the smallest
    document of each rank tells.
    """
    least = np.full(int(ranks.max()) + 1 if len(ranks) else 0, np.iinfo(np.int64).max)
    run = ranks.astype(np.int64)
    np.minimum.at(least, run, docs)
    return docs > least[run]


_STRINGS = "key long, doc_id long, place long, text binary"


def _texts_of(docs: DataFrame, rows: DataFrame, hot: set[int], length: int) -> DataFrame:
    """The bytes of the strings in ``rows``; of the anchors in ``hot`` single windows under their own hash."""
    rolling = Rolling(32)
    hot_keys = np.array(sorted(hot), np.int64)

    def run(data, offsets, doc_ids, text_hashes, places):
        owner = np.repeat(np.arange(len(places)), [len(p[0]) for p in places])
        position = np.concatenate([p[0] for p in places])
        size = np.concatenate([p[1] for p in places]).astype(np.int64)
        key = np.concatenate([p[2] for p in places])
        start = position + offsets[owner]
        cut = np.isin(key, hot_keys)
        piece = np.repeat(np.flatnonzero(cut), size[cut])
        single = start[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(size[cut]) - size[cut], size[cut])
        ids = doc_ids.to_numpy(zero_copy_only=False)
        h = rolling.hashes(rolling.sums(data), single, single + length).view(np.int64)
        first, _, later = first_here([h], ids[owner[piece]])
        owner = np.concatenate([owner[~cut], owner[piece]])
        at = np.concatenate([start[~cut], single])
        stop = np.concatenate([start[~cut] + size[~cut] + length - 1, single + length])
        key = np.concatenate([key[~cut], h])
        n = int((~cut).sum())
        raw = data.tobytes()
        send = np.concatenate([np.arange(n), n + first])
        texts = [raw[a:b] for a, b in zip(at[send].tolist(), stop[send].tolist())] + [None] * len(later)
        take = np.concatenate([send, n + later])
        place = tags(text_hashes)[owner[take]] | (at[take] - offsets[owner[take]])
        # windows decided here are dealt by place
        key = np.where(np.arange(len(take)) < len(send), key[take], place)
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(ids[owner[take]]), pa.array(place), pa.array(texts, pa.binary())],
            ["key", "doc_id", "place", "text"],
        )

    return with_places(docs, rows, run, _STRINGS, ("key",), "inner")


def _previous_factors(strings: DataFrame, length: int) -> DataFrame:
    """Runs of windows with an earlier match, by suffix arrays over the strings of many keys each."""

    def batch_of(ids, place, count):
        columns = [pa.array(ids, pa.int64()), pa.array(place, pa.int64()), pa.array(count.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "size"])

    def solve(held):
        whole = pa.Table.from_batches(held).combine_chunks()
        doc_id, place = (whole.column(i).to_numpy() for i in (1, 2))
        texts = pa.concat_arrays(whole.column(3).cast(pa.large_binary()).chunks)
        _, ends, values = texts.buffers()
        edges = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        size = np.diff(edges)
        string = np.repeat(np.arange(len(size)), size)
        full = np.flatnonzero(np.arange(len(data)) + length <= edges[1:][string])
        # equal windows under different keys cannot be: the anchor is part of the window
        found = np.zeros(len(data), bool)
        found[full] = earlier_match(suffix_ranks(data, full, length), doc_id[string[full]])
        begin, count = spans_of(found, string)
        own = string[begin]
        return batch_of(doc_id[own], place[own] + begin - edges[own], count)

    def run(batches):
        held, total = [], 0
        for batch in batches:
            decided = batch.column(3).is_null()
            done = batch.filter(decided)
            if done.num_rows:
                yield batch_of(done.column(1), done.column(2), np.ones(done.num_rows, np.int64))
                batch = batch.filter(pc.invert(decided))
            if not batch.num_rows:
                continue
            total += batch.column(3).nbytes
            if total >= _ARRAY_BYTES:
                # an array ends with the last string of a key
                key = batch.column(0).to_numpy()
                last = int(np.searchsorted(key, key[-1]))
                if last:
                    held.append(batch.slice(0, last))
                    batch = batch.slice(last)
                if held and held[-1].column(0)[-1].as_py() != key[-1]:
                    yield solve(held)
                    held, total = [], batch.column(3).nbytes
            held.append(batch)
        if held:
            yield solve(held)

    parts = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = strings.repartition(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc_id long, place long, size int")


def repeated_strings(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``place`` and ``size``: runs of byte windows that also start in a smaller document.

    ``docs`` has ``doc_id`` (not null), ``text_hash`` and ``text``.
    """
    screened = stage(_screen(docs, length, width), "strings")
    open_ = screened.where("key is not null")
    most = max(GROUP, int(open_.count() * GROUP_SHARE))
    # at most 1 / GROUP_SHARE keys
    hot = {r["key"] for r in open_.groupBy("key").count().where(F.col("count") > most).select("key").collect()}
    matched = _previous_factors(_texts_of(docs, open_, hot, length), length)
    return stage(screened.where("key is null").select("doc_id", "place", "size").union(matched), "repeats")


def remove_repeats(docs: DataFrame, length: int = LENGTH, width: int = ANCHOR) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes of each row.

    A byte goes when a string of ``length`` bytes over it also starts in a document with a smaller
    ``doc_id``, judged on the input. A null text is empty; rows without ``doc_id`` lose nothing.
    """
    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = repeated_strings(narrow.where("doc_id is not null"), length, width)

    def run(data, offsets, doc_ids, text_hashes, places):
        at = np.concatenate([p[0] + o for p, o in zip(places, offsets)])
        size = np.concatenate([p[1] for p in places]).astype(np.int64) + length - 1
        gone = covered(at, size, len(data))
        doc = np.repeat(np.arange(len(places)), np.diff(offsets))
        removed = np.bincount(doc[gone], minlength=len(places))
        begin, _ = spans_of(gone, doc)
        spans = np.bincount(doc[begin], minlength=len(places))
        left = data[~gone].tobytes()
        ends = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)]).tolist()
        kept = [left[a:b] for a, b in zip(ends, ends[1:])]
        columns = [doc_ids, pa.array(text_hashes), *map(pa.array, (np.diff(offsets), removed, spans)), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary"
    return with_places(narrow, found, run, schema)
