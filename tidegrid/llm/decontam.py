"""Benchmark decontamination with a stored positional inverted index.

The index is split by documents: a segment is a bounded run of documents with, for each of its terms, the sorted list of
its positions. No posting is ever shuffled, so a term that fills a third of the corpus is as harmless as a rare one.
A search goes over all segments with the benchmark in blocks of bounded size. A phrase is found by taking the list of its
rarest term, adjusted by the term's offset, and intersecting it with the lists of the other terms, rarest first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.common import chunks, map_batches, ramps, stored, without, words

WINDOW = 10
#: Words of benchmark text that are sent to the tasks at a time.
BLOCK_WORDS = 1_000_000
INDEX = (
    "segment long, doc_ids array<bigint>, n_words array<bigint>, terms binary, counts binary, positions binary"
)
HITS = "segment long, ordinal int, item_id bigint, starts array<int>, ends array<int>"
NEAR = "segment long, ordinal int, item_id bigint, position int"


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Positional postings of whole texts, stored in the shared folder: one row per segment.

    Null texts have no words; null and repeated ids are kept as they are, one entry per row. Only ``id`` and ``text`` are read.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in chunks(batches, "text", 2_000_000):
            found = [words(t) for t in batch.column("text").to_pylist()]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            flat = pa.array((w for ws in found for w in ws), pa.binary(), size=int(counts.sum())).dictionary_encode()
            # One position stays free between two documents, so no phrase runs over their border.
            at = np.arange(len(flat)) + np.repeat(np.arange(len(found)), counts)
            term = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(term, kind="stable")
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([part << 32 | number], pa.int64()),
                    "doc_ids": pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
                    "n_words": pa.array([counts], pa.list_(pa.int64())),
                    "terms": pa.array([b" ".join(flat.dictionary.to_pylist())], pa.binary()),
                    "counts": pa.array([np.bincount(term, minlength=len(flat.dictionary)).astype("<i4").tobytes()], pa.binary()),
                    "positions": pa.array([at[order].astype("<i4").tobytes()], pa.binary()),
                }
            )
            number += 1

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return stored(map_batches(rows, segments, INDEX))


class Segment:
    """The postings of one segment, for the terms that a block of queries has."""

    def __init__(self, row: dict, vocabulary: dict[bytes, int]):
        counts = np.frombuffer(row["counts"], "<i4").astype(np.int64)
        positions = np.frombuffer(row["positions"], "<i4")
        known = np.fromiter((vocabulary.get(t, -1) for t in row["terms"].split(b" ")), np.int64, len(counts)) if len(counts) else counts
        at = np.flatnonzero(known >= 0)
        at = at[np.argsort(known[at])]
        n = counts[at]
        take = np.repeat(np.cumsum(counts)[at] - n, n) + ramps(n)
        self.count = np.zeros(len(vocabulary), np.int64)
        self.count[known[at]] = n
        self.start = np.cumsum(self.count) - self.count
        self.position = positions[take].astype(np.int64)
        #: Term and position in one number: all lists behind each other, still sorted.
        self.key = np.repeat(known[at], n) << 32 | self.position
        lengths = np.asarray(row["n_words"], np.int64)
        self.bounds = np.cumsum(lengths + 1) - lengths - 1  # first position of each document
        self.lengths = lengths

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        wanted = term << 32 | np.maximum(position, 0)
        at = np.searchsorted(self.key, wanted)
        return (position >= 0) & (at < len(self.key)) & (self.key[np.minimum(at, max(len(self.key) - 1, 0))] == wanted) if len(self.key) else np.zeros(len(wanted), bool)

    def phrases(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All places where a row of ``terms`` (phrases of one length) stands: row and position."""
        n = self.count[terms]
        row = np.flatnonzero((n > 0).all(axis=1))
        order = np.argsort(n[row], axis=1, kind="stable")
        rare = terms[row, order[:, 0]] if len(row) else np.zeros(0, np.int64)
        many = self.count[rare]
        start = self.position[np.repeat(self.start[rare], many) + ramps(many)] - np.repeat(order[:, 0], many)
        which = np.repeat(np.arange(len(row)), many)
        for k in range(1, terms.shape[1]):  # next rarer term: keep the starts that its adjusted list has too
            offset = order[which, k]
            on = self.has(terms[row[which], offset], start + offset)
            which, start = which[on], start[on]
        return row[which], start

    def near(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``terms`` and places of their rarest term with every other term at most ``slop`` words off, in one document."""
        n = self.count[terms]
        row = np.flatnonzero((n > 0).all(axis=1))
        order = np.argsort(n[row], axis=1, kind="stable")
        rare = terms[row, order[:, 0]] if len(row) else np.zeros(0, np.int64)
        many = self.count[rare]
        centre = self.position[np.repeat(self.start[rare], many) + ramps(many)]
        which = np.repeat(np.arange(len(row)), many)
        for k in range(1, terms.shape[1]):
            term = terms[row[which], order[which, k]]
            doc = self.document(centre)
            low = np.maximum(centre - slop, self.bounds[doc])
            high = np.minimum(centre + slop, self.bounds[doc] + self.lengths[doc] - 1)
            on = np.searchsorted(self.key, term << 32 | low) < np.searchsorted(self.key, term << 32 | high, side="right")
            which, centre = which[on], centre[on]
        return row[which], centre

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, position, side="right") - 1


def query_blocks(items: DataFrame, id: str, text: str, window: int) -> Iterator[tuple[dict, list[tuple[np.ndarray, np.ndarray]]]]:
    """The benchmark in blocks: a vocabulary, and per phrase length the distinct phrases with their item ids."""
    block: list[tuple[int, list[bytes]]] = []
    size = 0
    for row in items.select(F.col(id).cast("bigint"), text).where(F.col(id).isNotNull()).toLocalIterator():
        found = words(row[1])
        if found:
            block.append((row[0], found))
            size += len(found)
        if size >= BLOCK_WORDS:
            yield prepared(block, window)
            block, size = [], 0
    if block:
        yield prepared(block, window)


def prepared(block: list[tuple[int, list[bytes]]], window: int) -> tuple[dict, list[tuple[np.ndarray, np.ndarray]]]:
    vocabulary: dict[bytes, int] = {}
    by_length: dict[int, set[tuple[int, ...]]] = {}
    for item, found in block:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in found]
        width = min(window, len(ids))
        by_length.setdefault(width, set()).update((item, *ids[k : k + width]) for k in range(len(ids) - width + 1))
    tables = [np.array(sorted(rows), np.int64) for _, rows in sorted(by_length.items())]
    return vocabulary, [(t[:, 1:], t[:, 0]) for t in tables]


def search(index: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Exact phrase matches: per document and item the stretches of words that its windows cover.

    A window is ``window`` consecutive words of an item; a shorter item is one window. Items without words or without an id
    match nothing. Repeated item rows count once.
    """
    spark, found = index.sparkSession, None
    for vocabulary, tables in query_blocks(items, id, text, window):
        sent = spark.sparkContext.broadcast((vocabulary, tables))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            vocabulary, tables = sent.value
            for batch in batches:
                for row in batch.to_pylist():
                    part = Segment(row, vocabulary)
                    hits = [(ids[r], s, s + terms.shape[1]) for terms, ids in tables for r, s in [part.phrases(terms)]]
                    item, start, end = (np.concatenate(x) for x in zip(*hits, strict=True))
                    if len(item):
                        yield spans(row["segment"], part, item, start, end)

        got = stored(map_batches(index, scan, HITS))
        sent.unpersist()
        found = got if found is None else found.unionByName(got)
    return found if found is not None else spark.createDataFrame([], HITS)


def spans(segment: int, part: Segment, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """One row per document and item, overlapping stretches joined, positions counted from the document's first word."""
    doc = part.document(start)
    keep = end <= part.bounds[doc] + part.lengths[doc]
    frame = pd.DataFrame({"doc": doc, "item": item, "start": start - part.bounds[doc], "end": end - part.bounds[doc]})[keep]
    frame = frame.sort_values(["doc", "item", "start", "end"])
    reach = frame.groupby(["doc", "item"])["end"].cummax()
    fresh = (frame["start"] > reach.shift()) | (frame["doc"] != frame["doc"].shift()) | (frame["item"] != frame["item"].shift())
    runs = frame.assign(reach=reach).groupby(["doc", "item", fresh.cumsum()]).agg(start=("start", "first"), end=("reach", "last"))
    rows = runs.groupby(level=["doc", "item"]).agg(list).reset_index()
    return pa.RecordBatch.from_pydict(
        {
            "segment": pa.array([segment] * len(rows), pa.int64()),
            "ordinal": pa.array(rows["doc"], pa.int32()),
            "item_id": pa.array(rows["item"], pa.int64()),
            "starts": pa.array(rows["start"].tolist(), pa.list_(pa.int32())),
            "ends": pa.array(rows["end"].tolist(), pa.list_(pa.int32())),
        }
    )


def search_near(
    index: DataFrame, items: DataFrame, slop: int, id: str = "item_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Proximity matches: windows whose terms, in any order, all stand within ``slop`` words of their rarest term."""
    spark, found = index.sparkSession, None
    for vocabulary, tables in query_blocks(items, id, text, window):
        sent = spark.sparkContext.broadcast((vocabulary, tables))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            vocabulary, tables = sent.value
            for batch in batches:
                for row in batch.to_pylist():
                    part = Segment(row, vocabulary)
                    hits = [(ids[r], c) for terms, ids in tables for r, c in [part.near(terms, slop)]]
                    item, centre = (np.concatenate(x) for x in zip(*hits, strict=True))
                    doc = part.document(centre) if len(centre) else centre
                    frame = pd.DataFrame({"o": doc, "i": item, "p": centre - (part.bounds[doc] if len(doc) else 0)}).drop_duplicates()
                    yield pa.RecordBatch.from_pydict(
                        {
                            "segment": pa.array([row["segment"]] * len(frame), pa.int64()),
                            "ordinal": pa.array(frame["o"], pa.int32()),
                            "item_id": pa.array(frame["i"], pa.int64()),
                            "position": pa.array(frame["p"], pa.int32()),
                        }
                    )

        got = stored(map_batches(index, scan, NEAR))
        sent.unpersist()
        found = got if found is None else found.unionByName(got)
    return found if found is not None else spark.createDataFrame([], NEAR)


def entries(index: DataFrame) -> DataFrame:
    """One row per indexed document: ``segment``, ``ordinal``, ``doc_id``, ``n_words``."""
    pairs = F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "entry")
    return index.select("segment", pairs).select("segment", "ordinal", "entry.doc_ids", "entry.n_words").toDF(
        "segment", "ordinal", "doc_id", "n_words"
    )


def contamination(index: DataFrame, hits: DataFrame) -> DataFrame:
    """Per indexed document: ``doc_id``, ``n_words``, ``n_hit`` and the sorted ``items`` whose windows occur in it."""
    stretch = F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(x["starts"].alias("a"), x["ends"].alias("b")))
    per_doc = hits.groupBy("segment", "ordinal").agg(
        F.array_sort(F.flatten(F.collect_list(stretch))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    # Stretches of several items overlap: each adds what lies beyond the furthest end so far.
    covered = F.aggregate(
        "spans",
        F.expr("struct(0 AS n, 0 AS till)"),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["till"], s["a"]))).alias("n"),
            F.greatest(acc["till"], s["b"]).alias("till"),
        ),
    )["n"].cast("bigint")
    found = per_doc.select("segment", "ordinal", covered.alias("n_hit"), "items")
    joined = entries(index).join(found, ["segment", "ordinal"], "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def decontaminate(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Contamination of whole ``docs`` by ``items`` (columns ``item_id`` and ``text``): one row per row of ``docs``."""
    index = build_index(docs, id, text)
    return contamination(index, search(index, items, window=window))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of ``items``. Texts, not ids, tell rows apart; all columns stay."""
    keyed = docs.withColumn("_tg_text", F.xxhash64(F.col(f"`{text}`")))
    index = build_index(keyed, "_tg_text", text)
    hits = search(index, items, window=window).select("segment", "ordinal").distinct()
    bad = stored(entries(index).join(hits, ["segment", "ordinal"], "left_semi").select(F.col("doc_id").alias("_tg_text")).distinct())
    return without(keyed, bad, "_tg_text").select(*[F.col(f"`{c}`") for c in docs.columns])
