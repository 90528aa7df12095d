"""Homomorphic multiset hashes of documents: sums of wide vectors hashed from paragraphs, lane by lane modulo a power of two.

A paragraph is a line. Its vector has two parts: lanes of 32 bits from a digest of the whole line, which make the sum a
fingerprint of the multiset of lines, and lanes of 16 bits in which each run of three words of the line adds 1 or -1 to one
lane. Sums of vectors do not depend on the order of lines, and a line is put in or taken out by adding or subtracting its
vector. The second part is linear in the runs, so the squared distance of two sums estimates how much of the texts differs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidegrid.llm.common import chunks, map_batches, mix, shingle_hashes, word_hashes, words

WIDE = 16  # lanes of 32 bits
LANES = 256  # lanes of 16 bits
RUN = 3


class Vectors:
    """A row of lanes per text; rows add and subtract lane by lane."""

    def __init__(self, wide: np.ndarray, lanes: np.ndarray):
        self.wide, self.lanes = wide, lanes

    def __add__(self, other: Vectors) -> Vectors:
        return Vectors(self.wide + other.wide, self.lanes + other.lanes)

    def __sub__(self, other: Vectors) -> Vectors:
        return Vectors(self.wide - other.wide, self.lanes - other.lanes)

    def texts(self) -> list[str]:
        rows = np.hstack([self.wide.astype("<u4").view(np.uint8).reshape(len(self.wide), -1), self.lanes.astype("<u2").view(np.uint8).reshape(len(self.lanes), -1)])
        return [base64.b64encode(r.tobytes()).decode() for r in rows]

    @classmethod
    def parse(cls, texts: list[str]) -> Vectors:
        raw = np.frombuffer(b"".join(map(base64.b64decode, texts)), np.uint8).reshape(len(texts), 4 * WIDE + 2 * LANES)
        wide = np.ascontiguousarray(raw[:, : 4 * WIDE]).view("<u4")
        return cls(wide.astype(np.uint32), np.ascontiguousarray(raw[:, 4 * WIDE :]).view("<u2").astype(np.uint16))

    def likeness(self, other: Vectors) -> np.ndarray:
        """0 to 1 by row: 1 for equal vectors, else one less the share of the runs in which they differ, as estimated."""
        a, b = self.lanes.view(np.int16).astype(np.float64), other.lanes.view(np.int16).astype(np.float64)
        off = (self.lanes - other.lanes).view(np.int16).astype(np.float64)
        both = (a * a).sum(axis=1) + (b * b).sum(axis=1)
        near = np.clip(1 - (off * off).sum(axis=1) / np.maximum(both, 1), 0, 1)
        same = (self.wide == other.wide).all(axis=1) & (self.lanes == other.lanes).all(axis=1)
        return np.where(same, 1.0, np.where(both > 0, near, 0.0))


def vectors(texts: list[str]) -> Vectors:
    """Vectors of texts: the sum over their lines. An empty text has no line; its vector is zero."""
    lines = [t.split("\n") if t else [] for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, len(lines))
    flat = [x for own in lines for x in own]
    digests = b"".join(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=4 * WIDE).digest() for x in flat)
    wide = segment_sums(np.frombuffer(digests, "<u4").reshape(len(flat), WIDE).astype(np.uint32), n_lines)
    hashes, counts = word_hashes([words(x) for x in flat])
    runs, n_runs = shingle_hashes(hashes, counts, RUN)
    runs = mix(runs, 7)
    text_of = np.repeat(np.arange(len(texts)), n_lines)
    cell = np.repeat(text_of, n_runs) * LANES + (runs % np.uint64(LANES)).astype(np.int64)
    sign = 1.0 - 2.0 * ((runs >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    sums = np.bincount(cell, weights=sign, minlength=len(texts) * LANES).astype(np.int64)
    return Vectors(wide, sums.reshape(len(texts), LANES).astype(np.uint16))


def segment_sums(rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows, modulo the type's power."""
    sums = np.zeros((len(rows) + 1, rows.shape[1]), rows.dtype)
    np.cumsum(rows, axis=0, dtype=rows.dtype, out=sums[1:])
    ends = np.cumsum(n)
    return sums[ends] - sums[ends - n]


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text. A null text counts as empty; equal texts have equal fingerprints."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            made = vectors([t or "" for t in batch.column("text").to_pylist()]).texts()
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "fingerprint": pa.array(made, pa.string())})

    made = map_batches(rows, run, StructType([rows.schema["row"]]).add("fingerprint", "string"))
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != out], F.col("fingerprint").alias(out))


EDITED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in runs (``run``) of falling ids, each run followed by the first row of the next one (``extra``); the last by the first.

    Only the ids are gathered first, to find quantiles and the first row of each run; each text moves once. Equal ids stay
    in one run, in falling order of text; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    runs = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    low = F.lit(-(2**63)).cast("bigint")
    key = F.coalesce("doc_id", low)
    cuts = rows.select(F.percentile_approx(key, [k / runs for k in range(1, runs)], 10000).alias("q")).first()["q"] or []
    cuts = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(cuts, ids, side="right")).astype("int32")

    tops = sorted((r.run, r.top) for r in rows.select(run_of(key).alias("run"), key.alias("key")).groupBy("run").agg(F.max("key").alias("top")).collect())
    if not tops:
        return rows.select(F.lit(0).alias("run"), F.lit(False).alias("extra"), "doc_id", "text")
    # One row per run, so its size is that of the plan, not of the table.
    copies = [(top, tops[k - 1][0]) for k, (_, top) in enumerate(tops)]
    before = spark.createDataFrame(copies, "_tg_top bigint, _tg_run int")
    rows = rows.join(F.broadcast(before), key == F.col("_tg_top"), "left")
    also = F.col("_tg_run")
    own = F.struct(run_of(key).alias("run"), F.lit(False).alias("extra"))
    copy = F.struct(also.alias("run"), F.lit(True).alias("extra"))
    spread = F.explode(F.when(also.isNull(), F.array(own)).otherwise(F.array(own, copy)))
    return rows.select(spread.alias("at"), "doc_id", "text").select("at.run", "at.extra", "doc_id", "text")


def edit_study(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside an edited copy and beside the next one, in descending order of id, after the last the first.

    The edit replaces the last third (rounded down) of the code points by as many from the start of the next text, or all it
    has. Null texts are empty; of repeated ids the next row is the next in order of text. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, int, str]] = []
        for batch in chunks(batches, "text", 4_000_000):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("run", "extra", "doc_id", "text"))))
            held = held + rows
            yield from compared(held)
            held = held[-1:]

    order = [F.col("run"), F.col("extra"), F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    return map_batches(with_next(docs, id, text).repartition("run").sortWithinPartitions(*order), run, EDITED)


def compared(rows: list[tuple[int, bool, int, str]]) -> Iterator[pa.RecordBatch]:
    """Results for every row that a row of its run follows; a run ends with the first row of the next."""
    pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
    if not pairs:
        return
    texts = [a[3] for a, _ in pairs]
    follow = [b[3] for _, b in pairs]
    cut = [len(t) // 3 for t in texts]
    edited = [t[: len(t) - c] + f[:c] for t, f, c in zip(texts, follow, cut)]
    own, other = vectors(texts), vectors(edited)
    # Mostly the next text is the next row's own, so its vector is there already.
    lone = [k for k in range(len(pairs)) if k + 1 == len(pairs) or pairs[k][1] is not pairs[k + 1][0]]
    place = np.arange(1, len(pairs) + 1)
    place[lone] = len(pairs) + np.arange(len(lone))
    rest = vectors([follow[k] for k in lone])
    after = Vectors(np.vstack([own.wide, rest.wide])[place], np.vstack([own.lanes, rest.lanes])[place])
    yield pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([a[2] for a, _ in pairs], pa.int64()),
            "n_chars": pa.array(list(map(len, texts)), pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
            "fingerprint": pa.array(own.texts(), pa.string()),
            "edited_fingerprint": pa.array(other.texts(), pa.string()),
            "near_edited": pa.array(own.likeness(other), pa.float64()),
            "near_next": pa.array(own.likeness(after), pa.float64()),
        }
    )
