"""All queries of this package and their SQL."""

from __future__ import annotations

from tidegrid.llm import queries_pairs, queries_spans, queries_text

QUERIES = {**queries_text.QUERIES, **queries_pairs.QUERIES, **queries_spans.QUERIES}
ORACLE = {**queries_text.ORACLE, **queries_spans.ORACLE}
