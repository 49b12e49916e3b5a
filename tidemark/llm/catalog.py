"""The queries of the operators in this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, html_text, langid, line_dedup, merkle, prefix_trie, quality, secrets, simhash, substring_dedup, suffix_dedup, toxicity
from tidemark.llm.texts import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op5_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.scan(_table(spark, sf_dir, "documents"))
    return secrets.digest(found)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), word_bpe(), decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_common(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_suffix_array": op3_suffix_array,
    "op4_html": op4_html,
    "op5_bm25": op5_bm25,
    "op6_secrets": op6_secrets,
    "op7_langid": op7_langid,
    "op8_simhash": op8_simhash,
    "op9_substrings": op9_substrings,
    "op10_bpe": op10_bpe,
    "op11_toxicity": op11_toxicity,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle": op13_merkle,
}

def _repeats(symbols: str, length: int) -> str:
    """Runs ``(doc_id, low, high)`` of symbols, counted from 1, under windows a smaller document has too.

    ``symbols`` selects ``doc_id``, the number ``n`` of symbols and ``window``, the text of the window at ``p``.
    """
    return f"""
        windows as ({symbols}),
        later as (
          select doc_id, p from (select doc_id, p, min(doc_id) over (partition by w) as least from windows)
          where least < doc_id),
        marked as (
          select doc_id, p, p - lag(p) over (partition by doc_id order by p) > {length} as apart from later),
        numbered as (
          select doc_id, p, count(*) filter (where apart) over (partition by doc_id order by p) as run from marked),
        runs as (
          select doc_id, run, min(p) as low, max(p) + {length} - 1 as high from numbered group by doc_id, run)"""



def _crc32(text: str) -> str:
    """The CRC-32 of a text of ASCII characters, bit by bit."""
    bit = "xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {byte}), 4294967295)"


def _tree(name: str, levels: int) -> str:
    """Levels ``name0`` to ``name{levels}`` of all trees, and what stands before and behind a node in its run.

    ``name0`` has ``tree, idx, n, digest``. A tree of one node passes as it is.
    """
    out = []
    for level in range(levels):
        run = "partition by tree, idx // 8 order by idx rows between"
        out.append(f"""
        {name}_side{level} as (
          select tree, idx, n,
            coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as before,
            coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as behind
          from {name}{level}),
        {name}{level + 1} as (
          select tree, idx // 8 as idx, (any_value(n) + 7) // 8 as n,
            case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by idx)) end as digest
          from {name}{level} group by tree, idx // 8)""")
    return ",".join(out)


def _folds(name: str, levels: int, start: str, tree: str, idx: str) -> str:
    """``name_fold``: rows of ``start`` with proof and node taken through the levels of a tree."""
    out, source = [], start
    for level in range(levels):
        target = f"{name}_fold{level}" if level < levels - 1 else f"{name}_fold"
        out.append(f"""
        {target} as (
          select p.* exclude (proof, node), proof || before || behind as proof,
            case when n = 1 then node else sha256(before || node || behind) end as node
          from {source} p join {name}_side{level} s on s.tree = p.{tree} and s.idx = p.{idx} // {8 ** level})""")
        source = target
    return ",".join(out)


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}::varchar) || ':' || {f}, '-')" for f in fields) + ")"


_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op12_prefix_trie": f"""
        with said as (
          select conv_id, turn, strlen(coalesce(text, '')) as n_bytes,
            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest
          from conversations where conv_id is not null),
        turns as (
          select *, row_number() over (partition by conv_id order by turn nulls first, digest) as p from said),
        convs as (
          select conv_id, {_crc32("conv_id::varchar")} % 9 as h, conv_id - conv_id % 5 as first
          from (select distinct conv_id from said)),
        rebuilt as (
          select c.conv_id, 0 as own, p, digest, n_bytes from convs c join turns t on t.conv_id = c.first and p <= h
          union all
          select c.conv_id, 1, p, digest, n_bytes from convs c join turns t on t.conv_id = c.conv_id and p > h),
        paths as (
          select conv_id, coalesce(list(digest order by own, p) filter (digest is not null), []) as path,
            list(n_bytes order by own, p) as sizes
          from convs left join rebuilt using (conv_id) group by conv_id),
        members as (
          select conv_id, path[1:d] as node, d, len(path) as length, case when d > 0 then sizes[d] else 0 end as n_bytes
          from (select *, unnest(range(0, len(path) + 1)) as d from paths)),
        nodes as (
          select node, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
            (count(*) - 1) * any_value(n_bytes) as saved, not bool_or(length > d) as leaf,
            string_agg(conv_id::varchar, ',' order by conv_id) filter (length = d) as ends
          from members group by node),
        below as (
          select node[1:k] as node, sum(leaf::bigint)::bigint as n_leaves, sum(saved)::bigint as saved_tokens,
            count(*) filter (k = depth - 1) as n_children
          from (select *, unnest(range(0, depth + 1)) as k from nodes) group by 1)
        select n.conv_id, n.depth, up.conv_id as parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens,
          sha256(coalesce(n.ends, '')) as ends_sha256
        from nodes n join below using (node)
        left join nodes up on n.depth > 0 and up.node = n.node[1:n.depth - 1]""",
    "op13_merkle": f"""
        with leaves as (
          select doc_id, coalesce('=' || lang, '-') as lang_tree, {_leaf("text")} as leaf,
            case when {_crc32("doc_id::varchar")} % 3 = 0 then {_leaf(_SMALL)} else {_leaf("text")} end as node
          from documents),
        placed as (
          select *, '' as proof, count(*) over (partition by lang_tree) as size,
            row_number() over (partition by lang_tree order by doc_id nulls first, leaf) - 1 as i from leaves),
        low0 as (select lang_tree as tree, i as idx, size as n, leaf as digest from placed),
        {_tree("low", 8)},
        high0 as (
          select '' as tree, row_number() over (order by encode(tree)) - 1 as idx, count(*) over () as n,
            digest, tree as lang_tree from low8),
        {_tree("high", 4)},
        {_folds("low", 8, "placed", "lang_tree", "i")},
        langs as (
          select doc_id, leaf, proof, node, h.digest as subroot, h.idx as lang_idx, h.tree as top
          from low_fold join high0 h using (lang_tree)),
        {_folds("high", 4, "langs", "top", "lang_idx")}
        select doc_id, leaf, subroot, high4.digest as root, sha256(proof) as proof_sha256, node as folded_root,
          node = high4.digest as verified, strlen(proof)::int // 64 as proof_nodes
        from high_fold, high4""",
    "op9_substrings": f"""
        with texts as (
          select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as words from documents),
        {_repeats(
            "select doc_id, p, array_to_string(words[p:p + 49], ' ') as w from "
            "(select doc_id, words, unnest(range(1, len(words) - 48)) as p from texts)", 50
        )},
        gone as (select doc_id, unnest(range(low, high + 1)) as i from runs),
        kept as (
          select doc_id, string_agg(word, ' ' order by i) as text
          from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from texts)
          anti join gone using (doc_id, i) group by doc_id),
        removed as (select doc_id, count(*) as n from gone group by doc_id)
        select doc_id, len(words) as n_words, coalesce(n, 0) as n_removed,
          sha256(coalesce(kept.text, '')) as kept_sha256
        from texts left join kept using (doc_id) left join removed using (doc_id)""",
    "op3_suffix_array": f"""
        with texts as (select doc_id, hex(encode(coalesce(text, ''))) as raw from documents),
        {_repeats(
            "select doc_id, p, substr(raw, 2 * p - 1, 100) as w from "
            "(select doc_id, raw, unnest(range(1, len(raw) // 2 - 48)) as p from texts)", 50
        )},
        edges as (
          select doc_id, low, high, lag(high, 1, 0) over (partition by doc_id order by low) as before from runs
          union all
          select doc_id, len(raw) // 2 + 1, null, coalesce((select max(high) from runs r where r.doc_id = t.doc_id), 0)
          from texts t),
        kept as (
          select doc_id, string_agg(substr(raw, 2 * before + 1, 2 * (low - before - 1)), '' order by low) as raw,
            coalesce(sum(high - low + 1), 0) as n_removed, count(high) as n_spans
          from edges join texts using (doc_id) group by doc_id)
        select doc_id, len(texts.raw) // 2 as n_bytes, n_removed::bigint as n_removed, n_spans,
          sha256(unhex(kept.raw)) as kept_sha256
        from texts join kept using (doc_id)""",
}
