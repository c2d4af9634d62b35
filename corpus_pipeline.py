"""From raw documents to packed training sequences, in stages that each write what the next one reads."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm.exact_dedup import exact_dedup
from feedmill.llm.frames import DOC, unpacked
from feedmill.llm.language_id import UNKNOWN, detect_languages
from feedmill.llm.packing import digest, pack
from feedmill.llm.simhash import simhash_dedup
from feedmill.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
#: SQL has neither trained profiles nor the hash and tokenizer that the stages use.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; profiles are learnt from the labelled ones among them.

    Rejected are null and empty texts and those without a letter. A table without any labelled text teaches no
    profile: what cannot be judged stays, so again only texts without a letter go.
    """
    found = detect_languages(docs, docs)
    keep = F.col("lang_pred") != UNKNOWN
    if docs.where("text is not null and lang is not null").isEmpty():
        keep = F.coalesce(F.col(DOC).getField("text").rlike(r"\p{L}"), F.lit(False))
    return unpacked(found.where(keep), docs.schema)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest id, a null id being smallest.

    A null text counts as an empty one; of rows repeated with one id exactly one stays.
    """
    return unpacked(exact_dedup(docs).where("kept"), docs.schema)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash prints (3 words, at most 2 of 64 bits) one with the smallest id.

    Null and empty texts have one print, so they are one group; a null id stays only where its group has no other.
    """
    return unpacked(simhash_dedup(docs).where("kept"), docs.schema)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2,048 tokens; a null text is an empty one, of one token."""
    return digest(pack(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to shared scratch and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
