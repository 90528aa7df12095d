"""Registered queries of the operators that relate documents to each other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import neardup, passages
from tidegrid.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents: five-word shingles, similarity of 0.8 or more."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=5, similar=0.8)


QUERIES["op4_near_duplicates"] = op4_near_duplicates


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that other documents repeat, at a similarity of 0.8 or more."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"), least_words=50, similar=0.8)


QUERIES["op9_repeated_passages"] = op9_repeated_passages
