"""HTML extraction by equivalence classes: the template of a host, and the text in its slots.

A token is a begin or end tag with its path of open elements, or a block of text under such a path. Tokens
whose occurrence vectors over the pages of a host are equal (so often on this page, so often on
that) form a class. Vectors are compared by sums of page hashes, which combine before the
shuffle, so no host's pages meet anywhere. A class counts when it has several tokens and stands
on most pages of the host, and it is valid when, on every page,

* its tokens come in one order, all of them once before any comes again. Tokens out of that order leave the
  class and may form one of their own;
* each other class lies beside it, or always in the same gap between two of its tokens. Of two classes that
  do not nest so, the one on fewer pages (then of fewer tokens) is dropped.

The valid classes tell the roles of all other tokens apart: a token in one gap of a class is another than
in the next gap. Classes are formed anew of these roles until they stay as they are. They are the template: tags
that frame the slots, and text that is the same everywhere.

On a page, the slots are what stands between template tags. Slots of menus, headers,
footers, sidebars, notices, adverts, forms, comments and code are left out by element or by a whole
class or id, but nothing that is or holds an article is left out by its class. If some element is marked as the article, its
slots are the text, whole, also where pages share sentences, unless the other slots that are not template text hold more;
without such a mark those other slots are the text.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage

# Pages of a host that must have a token, at least, and as a share of all.
MIN_PAGES = 3
MIN_SHARE = 0.5
# Tokens of a valid class.
MIN_TOKENS = 2
_PAGES_AT_ONCE = 64
# Tokens are below 2^62; this bit marks those that left a class for their order.
_APART = 1 << 62
_END_TAG = 0x2545F4914F6CDD1D
# Tokens of hosts' classes, and rows of counts, that a task keeps at once.
_KEPT = 500_000

# Elements without an end tag, raw text elements, elements that break a block, elements
# and words in class or id that never hold main text.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template iframe textarea svg math title".split())
_BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - {"br"}
_LEFT_OUT = set("head nav aside footer form button select option label input dialog menu object canvas audio video".split()) | _RAW
_LEFT_OUT_NAMES = set(
    "ad ads advert advertisement adverts sponsored sponsor banner promo nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar aside widget cookie cookies consent notice notices alert popup modal overlay "
    "comment comments respond replies disqus form login search subscribe newsletter share social related toolbar "
    "pagination pager skip copyright legal".split()
)
_MAIN = {"article", "main"}

# Classes that are parts of an article when they stand in one, such as its title.
_PARTS_OF_MAIN = set("header masthead legal search banner".split())
# What an article ends where it was left open.
_UNCLOSED = ("nav", "header", "footer", "aside", "head", "form")

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


def _left_out(tag: str, attributes: str, inside_main: bool) -> tuple[int, str]:
    """Why an element never holds main text (0 it may, 1 by element, 2 by name, 3 hidden or by role), and its class for the path."""
    if tag in _LEFT_OUT:
        return 1, ""
    found = {}
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            found[name.lower()] = value.strip("\"'").lower()
    names = found.get("class", "")
    if tag == "header":
        return int(not inside_main), names
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    hidden |= found.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog")
    if hidden:
        return 3, names
    words = {*names.split(), *found.get("id", "").split()} & _LEFT_OUT_NAMES
    if inside_main:
        words -= _PARTS_OF_MAIN
    return 2 * (bool(words) and tag not in _MAIN | {"html", "body"}), names


def _token(path: int, kind: str) -> int:
    return xxhash.xxh64_intdigest(f"{path:x}{kind}", 9) >> 2


class Page:
    """The tokens and text blocks of a page, in order, in time linear in its length.

    ``tokens`` are all of them, ``block_at`` the places of blocks there. ``blocks`` have the token of their text, the
    text, whether it is left out, and whether it lies in an article. An element that is never closed ends where
    one around it does. An attribute's quote that never closes ends with its tag, at the next ``>``;
    a tag that never ends is text.
    """

    def __init__(self, text: str):
        self.tokens: list[int] = []
        self.block_at: list[int] = []
        self.blocks: list[tuple[int, str, bool, bool]] = []
        self._parts: list[str] = []
        # tag, path, left out (as in _left_out), in an article
        self._stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
        self._open: Counter[str] = Counter()
        self._html = text
        self._last = {c: text.rfind(c) for c in ">\"'"}
        at = 0
        while at < len(text):
            found = text.find("<", at)
            if found < 0:
                break
            name = _NAME.match(text, found + 1)
            end = self._tag_end(name.end()) if name else self._comment_end(found)
            if end is None:  # no tag: the sign is text
                self._text(text[at : found + 1])
                at = found + 1
                continue
            self._text(text[at:found])
            at = end
            if not name:
                continue
            tag, attributes = name[1].lower(), text[name.end() : end - 1]
            if text[found + 1] == "/":
                self._end(tag)
                continue
            self._start(tag, attributes)
            if tag in _RAW and not attributes.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?![^\s/>])", re.I).search(text, at)
                shut = text.find(">", close.end()) if close else -1
                at = shut + 1 if shut >= 0 else len(text)
                self._end(tag)
        self._text(text[at:])
        self._flush()
        self._cut(1)

    @property
    def tags(self) -> list[int]:
        """The tokens of tags."""
        blocks = set(self.block_at)
        return [token for at, token in enumerate(self.tokens) if at not in blocks]

    def take_roles(self, rounds: Iterable[Round]) -> None:
        """Give the blocks the roles of their tokens."""
        roles = reduce(lambda tokens, found: found.roles(tokens), rounds, self.tokens)
        self.blocks = [(roles[at], *block[1:]) for at, block in zip(self.block_at, self.blocks)]

    def _comment_end(self, at: int) -> int | None:
        """Where a comment or declaration that begins here ends; none begins with another sign."""
        if self._html.startswith("<!--", at):
            end = self._html.find("-->", at + 4)
            return end + 3 if end >= 0 else len(self._html)
        if self._html.startswith(("<!", "<?"), at):
            end = self._html.find(">", at)
            return end + 1 if end >= 0 else len(self._html)
        return None

    def _tag_end(self, at: int) -> int | None:
        """The end of a tag whose name ends here: the first ``>`` outside quotes. Quotes follow an equals sign."""
        text, begin = self._html, at
        while at <= self._last[">"]:
            stop = _STOP.search(text, at)
            if stop[0] == ">":
                return stop.end()
            before = stop.start() - 1
            while before >= begin and text[before].isspace():
                before -= 1
            at = stop.end()
            if before >= begin and text[before] == "=" and self._last[stop[0]] > stop.start():
                begin = at = text.find(stop[0], at) + 1
        return None

    def _text(self, raw: str) -> None:
        if raw:
            self._parts.append(html.unescape(raw) if "&" in raw else raw)

    def _flush(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                _, path, out, main = self._stack[-1]
                self.blocks.append((_token(path, "#" + text), text, out > 0, main))
                self.block_at.append(len(self.tokens))
                self.tokens.append(self.blocks[-1][0])
            self._parts = []

    def _start(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK or tag in _LEFT_OUT:
            self._flush()
        if tag in _CLOSES_P:
            self._close("p", _BLOCK - {"p"})
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self._close(tag, {"ul", "ol", "dl", "table", "select"})
        if tag in _MAIN:
            # an article ends menus and the like that were never closed
            while self._stack[-1][2] == 1 and any(self._open[name] for name in _UNCLOSED):
                self._cut(len(self._stack) - 1)
        _, path, out, main = self._stack[-1]
        if tag in _MAIN and out == 2:
            out = 0
        mine, names = _left_out(tag, attributes, main)
        token = _token(path, f"/{tag}.{names}")
        self.tokens.append(token)
        if tag not in _VOID:
            now = out or mine
            self._stack.append((tag, token, now, (main or tag in _MAIN) and not now))
            self._open[tag] += 1

    def _cut(self, height: int) -> None:
        """Close all elements above a height of the stack."""
        while len(self._stack) > height:
            tag, token, _, _ = self._stack.pop()
            self._open[tag] -= 1
            self.tokens.append(token ^ _END_TAG)

    def _close(self, tag: str, fence: set[str]) -> None:
        if self._open[tag]:
            for i in range(len(self._stack) - 1, 0, -1):
                if self._stack[i][0] == tag:
                    return self._cut(i)
                if self._stack[i][0] in fence:
                    return None

    def _end(self, tag: str) -> None:
        if tag in _BLOCK or tag in _LEFT_OUT:
            self._flush()
        if self._open[tag]:
            while self._stack[-1][0] != tag:
                self._cut(len(self._stack) - 1)
            self._cut(len(self._stack) - 1)


def main_text(page: Page, template: set[int]) -> str:
    """The blocks of the main slots, joined by one space.

    The slots are those of marked articles, unless the others that are no template have more text: then the
    articles are teasers beside it.
    """
    free = [b for b in page.blocks if not b[2]]
    marked = [b[1] for b in free if b[3]]
    others = [text for token, text, _, main in free if not main and token not in template]
    return " ".join(max(marked, others, key=lambda slots: sum(map(len, slots))))


def host(url: Column) -> Column:
    """The host of an address in lower case, empty without one."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


class Round:
    """Classes of a host, each in its order, and the tokens that left one for theirs."""

    def __init__(self, classes: list[list[int]], apart: Iterable[int] = ()):
        self.classes = classes
        self.apart = set(apart)
        # class, place in it, whether it is the last there
        self._place = {t: (n, i, i == len(c) - 1) for n, c in enumerate(classes) for i, t in enumerate(c)}

    def roles(self, tokens: list[int]) -> list[int]:
        """The tokens of a page, those of no class told apart by the gap of the innermost class they stand in.

        The classes are valid.
        """
        out, open_ = [], []
        for token in tokens:
            known = self._place.get(token)
            if known is None:
                mark = token & _APART or _APART * (token in self.apart)
                if open_:
                    n, gap = open_[-1]
                    token = xxhash.xxh64_intdigest(f"{token & ~_APART:x}:{self.classes[n][0]:x}:{gap}", 9) >> 2
                out.append(token | mark)
                continue
            n, i, last = known
            out.append(token)
            if i == 0:
                open_.append((n, 0))
                continue
            while open_ and open_[-1][0] != n:
                open_.pop()
            if open_:
                open_.pop()
                if not last:
                    open_.append((n, i))
        return out

    def out_of_order(self, tokens: list[int]) -> set[int]:
        """Tokens to leave out of their class, so that the others come in its order on this page."""
        seen: Counter[int] = Counter()
        found: dict[int, list[int]] = {}
        for token in tokens:
            known = self._place.get(token)
            if known:
                n, i, _ = known
                found.setdefault(n, []).append(seen[token] * len(self.classes[n]) + i)
                seen[token] += 1
        out = set()
        for n, values in found.items():
            if values != list(range(len(values))):
                members = self.classes[n]
                out |= {members[v % len(members)] for v in set(values) - set(_longest_rise(values))}
        return out

    def relations(self, tokens: list[int], count: Counter[tuple[int, int, int]]) -> None:
        """Count how often a class begins on this page, as (-1, class, 0), and how often it does so in a gap of another,
        as (other, class, gap). A class not ended at the next token of one that it began in counts as gap -1.

        The classes are in order.
        """
        open_: list[tuple[int, int]] = []
        for token in tokens:
            known = self._place.get(token)
            if known is None:
                continue
            n, i, last = known
            if i == 0:
                count[-1, n, 0] += 1
                for outer, gap in open_:
                    count[outer, n, gap] += 1
                open_.append((n, 0))
                continue
            at = len(open_) - 1
            while open_[at][0] != n:
                count[n, open_[at][0], -1] += 1
                at -= 1
            open_[at : at + 1] = [] if last else [(n, i)]


def _longest_rise(values: list[int]) -> list[int]:
    """A longest rising subsequence of different numbers."""
    ends: list[int] = []
    end_at: list[int] = []
    before = []
    for at, value in enumerate(values):
        n = bisect_left(ends, value)
        before.append(end_at[n - 1] if n else -1)
        ends[n : n + 1], end_at[n : n + 1] = [value], [at]
    out, at = [], end_at[-1] if end_at else -1
    while at >= 0:
        out.append(values[at])
        at = before[at]
    return out[::-1]


_CLASSES = "array<array<long>>"
_ROUNDS = f"array<struct<classes: {_CLASSES}, apart: array<long>>>"


class _Hosts:
    """The rounds of the hosts met last, from the columns that every page of a host has."""

    def __init__(self):
        self._known: dict[str, object] = {}
        self._size = 0

    def get(self, host: str, make: Callable[[], tuple[object, int]]) -> object:
        if host not in self._known:
            value, size = make()
            if self._size + size > _KEPT:
                self._known, self._size = {}, 0
            self._known[host] = value
            self._size += size
        return self._known[host]


def _rounds(value: list[dict]) -> list[Round]:
    return [Round(r["classes"], r["apart"]) for r in value]


def _size(rounds: list[Round]) -> int:
    return sum(len(r._place) + len(r.apart) for r in rounds)


def _pages_of(sequences: DataFrame, hosts: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` on the pages of ``hosts``; it gets pages as key, roles and the classes to try, by host, some at once."""
    mine = hosts.select(F.col("host").alias("_host"), "rounds", "classes")
    joined = sequences.join(mine, F.col("host") == F.col("_host")).drop("_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = _Hosts()

        def pages(part):
            names, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
            for i, (name, key) in enumerate(zip(names, keys)):

                def make():
                    rounds = _rounds(part.column(3)[i].as_py())
                    tried = Round(part.column(4)[i].as_py())
                    return (rounds, tried), _size([*rounds, tried])

                rounds, tried = hosts.get(name, make)
                tokens = np.frombuffer(part.column(2)[i].as_py(), "<i8").tolist()
                yield name, key, reduce(lambda tokens, found: found.roles(tokens), rounds, tokens), tried

        for batch in batches:
            for first in range(0, batch.num_rows, _PAGES_AT_ONCE):
                yield from work(pages(batch.slice(first, _PAGES_AT_ONCE)))

    return joined.select("host", "page_key", "tokens", "rounds", "classes").mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, names)


def _candidates(sequences: DataFrame, hosts: DataFrame, min_pages: int, share: float) -> DataFrame:
    """``host`` and ``found``: the classes of roles of equal vectors on most pages, the strongest first.

    Members are in the order in which they first come on one page, that of the smallest key.
    """
    names = ["host", "token", "a", "b", "n", "key", "at"]

    def vectors(pages):
        sums: dict[tuple[str, int], list[int]] = {}
        for name, key, roles, _ in pages:
            places: dict[int, int] = {-1: 0}
            for at, token in enumerate(roles):
                places.setdefault(token, at)
            counts = Counter(roles)
            counts[-1] = 1
            marks: dict[int, int] = {}
            for token, n in counts.items():
                mark = marks.get(n)
                if mark is None:
                    mark = marks[n] = xxhash.xxh64_intdigest(f"{key}:{n}", 4)
                row = sums.setdefault((name, token), [0, 0, 0, key, places[token]])
                row[0] += mark >> 33
                row[1] += mark & 0x7FFFFFFF
                row[2] += 1
                if key < row[3]:
                    row[3:] = key, places[token]
        if sums:
            yield _batch([(*k, *row) for k, row in sums.items()], names)

    seen = _pages_of(sequences, hosts, vectors, "host string, token long, a long, b long, n long, key long, at long")
    sums = [F.sum(c).alias(c) for c in ("a", "b", "n")]
    tokens = seen.groupBy("host", "token").agg(*sums, F.min(F.struct("key", "at"))["at"].alias("at"))
    tokens = stage(tokens.where(F.col("n") >= min_pages), "tokens")
    size = tokens.where("token = -1").select("host", F.col("n").alias("pages"))
    common = tokens.where("token >= 0").join(size, "host").where(F.col("n") >= share * F.col("pages"))
    apart = F.col("token").bitwiseAND(F.lit(_APART)).alias("apart")
    members = common.groupBy("host", "a", "b", "n", apart).agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("m"))
    members = members.where(F.size("m") >= MIN_TOKENS)
    strong = F.sort_array(F.collect_list(F.struct(-F.col("n"), -F.size("m"), "m")))
    return members.groupBy("host").agg(F.transform(strong, lambda c: c["m"]["token"]).alias("found"))


def _ordered(sequences: DataFrame, hosts: DataFrame) -> DataFrame:
    """The hosts with ``classes`` of tokens in one order on all pages, and ``apart``, tokens that left for the first time."""

    def work(pages):
        out = {(name, token) for name, _, roles, tried in pages for token in tried.out_of_order(roles)}
        if out:
            yield _batch(list(out), ["host", "token"])

    found = _pages_of(sequences, hosts, work, "host string, token long")
    left = found.groupBy("host").agg(F.collect_set("token").alias("left"))
    rows = hosts.join(left, "host", "left").withColumn("left", F.coalesce("left", F.array().cast("array<long>")))
    kept = F.filter(F.transform("classes", lambda c: F.array_except(c, F.col("left"))), lambda c: F.size(c) >= MIN_TOKENS)
    apart = F.filter("left", lambda t: t < F.lit(_APART))
    return stage(rows.withColumns({"classes": kept, "apart": apart}).drop("left"), "ordered")


def _nested(sequences: DataFrame, hosts: DataFrame) -> DataFrame:
    """The hosts with those ``classes`` that nest with each other on all pages."""
    names = ["host", "outer", "inner", "gap", "n"]

    def work(pages):
        counts: dict[str, Counter] = {}
        for name, _, roles, tried in pages:
            tried.relations(roles, counts.setdefault(name, Counter()))
            if sum(map(len, counts.values())) > _KEPT:
                yield _batch([(k, *pair, n) for k, found in counts.items() for pair, n in found.items()], names)
                counts = {}
        if any(counts.values()):
            yield _batch([(k, *pair, n) for k, found in counts.items() for pair, n in found.items()], names)

    found = _pages_of(sequences, hosts, work, "host string, outer long, inner long, gap long, n long")
    found = stage(found.groupBy("host", "outer", "inner", "gap").agg(F.sum("n").alias("n")), "relations")
    begun = found.where("outer < 0").select("host", "inner", F.col("n").alias("begun"))
    pairs = found.where("outer >= 0").groupBy("host", "outer", "inner").agg(
        F.count("*").alias("gaps"), F.min("gap").alias("gap"), F.sum("n").alias("n")
    )
    wrong = pairs.join(begun, ["host", "inner"]).where("gaps > 1 or gap < 0 or n < begun")
    both = F.struct(F.least("outer", "inner").alias("strong"), F.greatest("outer", "inner").alias("weak"))
    # from the strongest on, so that a class that is dropped drops no other
    dropped = F.aggregate(
        F.sort_array(F.collect_set(both)),
        F.array().cast("array<long>"),
        lambda gone, p: F.when(F.array_contains(gone, p["strong"]), gone).otherwise(F.array_union(gone, F.array(p["weak"]))),
    )
    rows = hosts.join(wrong.groupBy("host").agg(dropped.alias("dropped")), "host", "left")
    dropped = F.coalesce("dropped", F.array().cast("array<long>"))
    kept = F.filter("classes", lambda c, i: ~F.array_contains(dropped, i.cast("long")))
    return rows.withColumn("classes", kept).drop("dropped")


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = MIN_SHARE) -> DataFrame:
    """``host``, ``template``, the roles in its valid classes, and ``rounds``, by which a page's tokens get their
    roles; hosts without any class are left out.

    ``pages`` has ``host``, ``page_key`` (a hash that tells contents apart) and ``html``. A template has at most as
    many tokens as two average pages of its host. Pages of a host under one ``page_key`` count once.
    """
    keys = ["host", "page_key"]
    # only the pages that are there more than once are shuffled
    again = stage(pages.groupBy(keys).count().where("count > 1").select(keys), "again")
    pages = pages.select(*keys, "html")
    pages = pages.join(again, keys, "left_anti").union(pages.join(again, keys).dropDuplicates(keys))

    def parse(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, _PAGES_AT_ONCE):
                part = batch.slice(first, _PAGES_AT_ONCE)
                tokens = [np.array(Page(text or "").tokens, "<i8").tobytes() for text in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.binary())], [*keys, "tokens"])

    sequences = stage(pages.select(*keys, "html").mapInArrow(parse, "host string, page_key long, tokens binary"), "sequences")
    none = F.array().cast(_CLASSES)
    # classes: those of the last round of the host, then those to try
    open_ = sequences.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).drop("n")
    open_ = open_.withColumns({"rounds": F.array().cast(_ROUNDS), "classes": none})
    settled = []
    same = F.sort_array("classes") == F.sort_array("before")
    while True:
        found = open_.withColumnRenamed("classes", "before").join(
            _candidates(sequences, open_, min_pages, share).withColumnRenamed("found", "classes"), "host"
        )
        found = stage(found, "classes")
        settled.append(found.where(same).select("host", "rounds", "before"))
        ordered = _ordered(sequences, found.where(~same))
        nested = stage(_nested(sequences, ordered), "nested")
        still = same & (F.size("apart") == 0)
        settled.append(nested.where(still).select("host", "rounds", "before"))
        last = F.array(F.struct("classes", "apart"))
        open_ = nested.where(~still).select("host", F.concat("rounds", last).cast(_ROUNDS).alias("rounds"), "classes")
        if open_.isEmpty():
            break
    rows = reduce(DataFrame.union, settled).where(F.size("before") > 0)
    return rows.select("host", F.flatten("before").alias("template"), "rounds")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = MIN_SHARE) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of each row of ``pages``.

    A null ``html`` is empty and gives an empty text. Pages without a host in their ``url`` count as one
    host; equal pages of a host count as one for its template.
    """
    known = pages.select("page_id", "url", F.col("html").cast("string"), host(F.col("url")).alias("host"))
    keyed = known.withColumn("page_key", F.xxhash64("html"))
    # written out, so that adaptive execution can split the pages of a large host in the join
    found = stage(templates(keyed, min_pages, share), "templates").withColumnRenamed("host", "_host")
    joined = known.join(found, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "host", "template", "rounds")

    def run(batches):
        hosts = _Hosts()

        def text_of(part, i, name, text):
            def make():
                # the last round told no more classes apart
                rounds = _rounds(part.column(5)[i].as_py() or [])[:-1]
                template = set(part.column(4)[i].as_py() or ())
                return (rounds, template), _size(rounds) + len(template)

            rounds, template = hosts.get(name, make)
            page = Page(text or "")
            if rounds:
                page.take_roles(rounds)
            return main_text(page, template)

        for batch in batches:
            for first in range(0, batch.num_rows, _PAGES_AT_ONCE):
                part = batch.slice(first, _PAGES_AT_ONCE)
                names, htmls = part.column(3).to_pylist(), part.column(2).to_pylist()
                texts = [text_of(part, i, name, text) for i, (name, text) in enumerate(zip(names, htmls))]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    kinds = dict(known.dtypes)
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
