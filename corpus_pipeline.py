"""The corpus pipeline: stages over documents, each calling one operator of tidegrid.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm import bpe, decontam, neardup, pii, quality
from tidegrid.llm.common import stored, table

#: Documents below this score are rejected.
LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject. The model learns from labels of the documents outside its held-out fold."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, out="_tg_score")
    return scored.where(F.col("_tg_score") >= LEAST_QUALITY).drop("_tg_score")


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.deduplicate(docs, width=5, similar=0.8)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.find(docs, pii.train(docs), redact=True, into="_tg_redacted")
    new = {"text": F.col("_tg_redacted"), "n_chars": F.char_length("_tg_redacted").cast("bigint")}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    keep = [c for c in docs.columns if c != "text"]
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids="token_ids", digests=True, keep=keep)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("pii", redact_personal),
    ("bpe", encode_tokens),
]
#: No SQL scores a document, draws a signature or merges bytes; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
