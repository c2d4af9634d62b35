"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm import (
    ann, byte_bpe, exact_dedup, html_main, language_id, license_scan, lm_score, packing, prefix_trie, ranked_search,
    simhash, token_files, url_filter,
)
from feedmill.llm.frames import remainder
from feedmill.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language_id.detect_languages(docs.select("doc_id", "text"), docs.where(~held_out))
    return found.select("doc.doc_id", "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return lm_score.score(docs, remainder(F.col("doc_id"), 10) == 0)


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge_urls(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("doc.page_id", "host", "path", "rule", "verdict")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return found.select(
        "doc.doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_dedup(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc.doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, from flat token files that are written for it first."""
    path = scratch_path(spark, "token-files")
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    token_files.write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.count_tokens(spark, path).select(F.col("key").alias("doc_id"), "n_tokens")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_main.extract_main_text(_table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.select("doc.page_id", "doc.url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan_licenses(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    return ranked_search.ranked_search(_table(spark, sf_dir, "documents", "doc_id", "text"), items)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.conversations_of(turns)))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_lm_score": op2_lm_score,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_url_filter": op4_url_filter,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_main_text": op10_main_text,
    "op11_license_scan": op11_license_scan,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}

EXACT_SQL = """
with folded as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
    from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
    doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from folded window w as (partition by t)
"""

ORACLE = {
    "op4_url_filter": url_filter.oracle_sql(),
    "op7_exact_dedup": EXACT_SQL,
    "op11_license_scan": license_scan.oracle_sql(),
    "op12_ranked_search": ranked_search.oracle_sql(),
    "op13_prefix_trie": prefix_trie.oracle_sql(),
}
