"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    link_graph,
    merkle,
    minhash,
    packing,
    perm_index,
    pfor,
    radix_dedup,
    suffix_repeats,
    tool_links,
    toxicity,
    whitening,
    wordpiece,
)
from tidemark.sources.tables import table

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return perm_index.search(vectors, vectors.filter("vec_id % 20 = 0"))


def op2_pfor_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of ``documents`` written as PFOR shards and read back."""
    return pfor.encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op3_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 4,096 by first-fit decreasing."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_link_graph_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, or else by its host's trust and distrust."""
    return link_graph.judge(table(spark, sf_dir, "pages"))


def op5_fm_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a factorization machine."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_numpy_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` encoded by batched merge rounds and decoded again; digests of both."""
    made = bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return made.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op7_radix_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal ``documents`` by MSD radix partitioning."""
    return radix_dedup.radix_dedup(table(spark, sf_dir, "documents"))


def op8_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as calls of the assistant: linked, ordered, checked, serialised."""
    calls, results = tool_links.reply_calls(table(spark, sf_dir, "conversations"))
    return tool_links.link(calls, results, {"reply": tool_links.REPLY_SCHEMA})


def op9_longest_match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every whole document."""
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of ``documents`` on two-word shingles at 0.8."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op11_weighted_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` whitened on their first 8 components; a deviation beyond 64 bits is null."""
    made = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_bitmap_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of ``documents``; where 3 divides the id's crc32 the proof meets a tampered text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    made = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents"), claims={"text": text}))
    return made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op13_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the bytes of 50-byte strings that a smaller document has too."""
    cut = suffix_repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", *suffix_repeats.digests(cut))


QUERIES = {
    f.__name__: f
    for f in (
        op1_permutation_index,
        op2_pfor_blocks,
        op3_ffd_packing,
        op4_link_graph_filter,
        op5_fm_toxicity,
        op6_numpy_bpe,
        op7_radix_exact_dedup,
        op8_tool_call_links,
        op9_longest_match_counts,
        op10_minhash_near_dedup,
        op11_weighted_whitening,
        op12_bitmap_merkle,
        op13_suffix_repeats,
    )
}

ORACLE_SQL = {
    # Every 50-byte string as 100 hex digits; runs of removed bytes as islands of starts at most 50 apart.
    "op13_suffix_repeats": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), w AS (
            SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM d WHERE n >= 50)
        ), m AS (
            SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)
        ), c AS (
            SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS q FROM w JOIN m ON w.s = m.s WHERE m.least < w.doc_id
        ), i AS (
            SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p - q > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM c
        ), r AS (
            SELECT doc_id, run, min(p) AS b, max(p) + 50 AS e FROM i GROUP BY doc_id, run
        ), k AS (
            SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS f FROM r
        ), g AS (
            SELECT k.doc_id, count(*) AS n_spans, sum(e - b) AS n_removed,
                   string_agg(substr(d.h, 2 * f + 1, 2 * (b - f)), '' ORDER BY b) || substr(any_value(d.h), 2 * max(e) + 1) AS kept
            FROM k JOIN d ON k.doc_id = d.doc_id GROUP BY k.doc_id
        )
        SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(g.kept, d.h))) AS kept_sha256
        FROM d LEFT JOIN g ON d.doc_id = g.doc_id
    """,
    "op4_link_graph_filter": link_graph.judge_sql(),
    "op12_bitmap_merkle": merkle.manifest_sql(),
    "op7_radix_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        ), g AS (
            SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
        )
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g ON n.t = g.t
    """,
}
