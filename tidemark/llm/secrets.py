"""Secret scans with a ledger: each content is scanned once for each version of a rule.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds a row for each
content and rule version that was scanned, found something or not. A scan takes the pairs the ledger
lacks, scans one text for each such content, and joins all findings back to every document with
that content. Only DataFrame functions run; regular expressions find the matches, and the pieces
between the matches give their places.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage


# Matches of a text whose places are summed together.
_BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` from the left, without overlap, whose ``group`` has ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0


# Runs shorter than the least length never hold a longer match, so the pattern may ask for the length.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = (*BASE_RULES, *MORE_RULES)

LEDGER = "blob binary, kind string, version int, spans array<struct<start:long,stop:long>>"


def _spans(text: Column, rule: Rule) -> Column:
    """Start and end (exclusive) of the matches, in code points."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    steps = F.zip_with(
        F.zip_with(
            F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole)),
            whole,
            lambda gap, match: F.struct(
                F.char_length(gap).cast("long").alias("gap"), F.char_length(match).cast("long").alias("match")
            ),
        ),
        judged,
        lambda step, part: F.struct(
            step["gap"].alias("gap"), step["match"].alias("match"), (F.char_length(part) >= rule.least).alias("good")
        ),
    )
    nothing = F.array().cast("array<struct<start:long,stop:long>>")

    def placed(steps: Column) -> Column:
        lengths = F.transform(steps, lambda step: step["gap"] + step["match"])
        ends = F.zip_with(steps, _running(lengths), lambda step, stop: F.struct(step["good"], step["match"], stop.alias("stop")))
        good = F.filter(ends, lambda end: end["good"])
        return F.transform(good, lambda end: F.struct((end["stop"] - end["match"]).alias("start"), end["stop"].alias("stop")))

    return F.when(text.rlike(rule.pattern), _bound(steps, placed)).otherwise(nothing)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where ``use`` names it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sums(lengths: Column) -> Column:
    """Running sums of a short array: each step copies those before."""
    none = F.array().cast("array<long>")
    last = lambda done: F.coalesce(F.get(done, F.size(done) - 1), F.lit(0))
    return F.aggregate(lengths, none, lambda done, x: F.concat(done, F.array(last(done) + x)))


def _running(lengths: Column) -> Column:
    """Running sums of a long array, from those of its blocks and of the blocks' own sums."""

    def of(lengths: Column) -> Column:
        count = F.ceil(F.size(lengths) / _BLOCK).cast("int")
        numbers = F.filter(F.sequence(F.lit(0), count), lambda b: b < count)
        blocks = F.transform(numbers, lambda b: _sums(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))
        return _bound(blocks, joined)

    def joined(blocks: Column) -> Column:
        ends = _sums(F.transform(blocks, lambda block: F.element_at(block, -1)))
        before = F.concat(F.array(F.lit(0).cast("long")), ends)
        # one element more than blocks: the last pairs with null and is cut off
        return F.flatten(
            F.slice(
                F.zip_with(blocks, before, lambda block, low: F.transform(block, lambda x: x + low)), F.lit(1), F.size(blocks)
            )
        )

    return _bound(lengths, of)


def blobs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the address ``blob`` of its text; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long"), F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("blob")
    )


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: findings of each content and rule version of ``docs`` that ``ledger`` lacks."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    addressed = blobs(docs.select("doc_id", "text")).groupBy("blob").agg(F.min("doc_id").alias("holder"))
    asked = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    if ledger is None:
        todo = addressed.withColumn("kinds", asked["kind"])
    else:
        pairs = addressed.select("*", F.inline(asked))
        unseen = pairs.join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        todo = unseen.groupBy("blob", "holder").agg(F.collect_set("kind").alias("kinds"))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("address")
    )
    same = (F.col("blob") == F.col("address")) & F.col("holder").eqNullSafe(F.col("doc_id"))
    scanned = texts.join(todo, same).select(
        "blob",
        F.inline(
            F.filter(
                F.array(
                    *(
                        F.struct(
                            F.lit(r.kind).alias("kind"),
                            F.lit(r.version).alias("version"),
                            F.when(F.array_contains("kinds", r.kind), _spans(F.col("text"), r)).alias("spans"),
                        )
                        for r in rules
                    )
                ),
                lambda row: row["spans"].isNotNull(),
            )
        ),
    )
    # repeated rows of the holder give the same findings again
    return scanned.groupBy("blob", "kind", "version").agg(F.first("spans").alias("spans"))


def findings(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``found`` (``start``, ``kind_order``, ``kind``, ``stop``), sorted, for each row of ``docs``."""
    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    current = F.lit(False)
    for r in rules:
        current |= (F.col("kind") == r.kind) & (F.col("version") == r.version)
    placed = ledger.where(current).select(
        "blob",
        F.transform(
            "spans",
            lambda s: F.struct(
                s["start"].alias("start"), order[F.col("kind")].alias("kind_order"), F.col("kind").alias("kind"),
                s["stop"].alias("stop"),
            ),
        ).alias("spans"),
    )
    by_blob = placed.where(F.size("spans") > 0).groupBy("blob")
    found = by_blob.agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"))
    none = F.array().cast("array<struct<start:long,kind_order:int,kind:string,stop:long>>")
    # written out, so that adaptive execution can split the documents of a hot content in the join
    return blobs(docs).join(stage(found, "findings"), "blob", "left").select("doc_id", F.coalesce("found", none).alias("found"))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of all rows of ``docs``, and the new ledger rows, written to the shared folder.

    Append the new rows to the ledger and pass it on to the next scan: contents and rule versions it
    holds are not scanned again.
    """
    new = stage(scan_unseen(docs, ledger, rules), "ledger")
    known = new if ledger is None else new.unionByName(ledger.select(*new.columns))
    return findings(docs, known, rules), new


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text, for each row."""
    kinds = [r.kind for r in base]

    def text(spans: Column) -> Column:
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    def of(kind: str) -> Column:
        return F.filter("found", lambda s: s["kind"] == kind)

    own = F.filter("found", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(text(own), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
