"""Shared helpers: stored stages, bounded Arrow chunks, words, hashes and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.session import scratch_path

#: A key is heavy when it holds more than one in HEAVY of all rows, so there are at most HEAVY of them.
HEAVY = 1000
#: Keys that may be broadcast.
FEW = 1_000_000
#: Characters of text that one task works on at a time; a longer text is a chunk of its own.
CHUNK_CHARS = 8_000_000

# Bytes of words are digits, lower-case ASCII letters (upper case is folded) and all bytes from 0x80.
WORD_BYTES = bytes(
    c if chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else c + 32 if chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 32
    for c in range(256)
)



def stored(df: DataFrame) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read back: later passes survive lost executors.

    Packed by zstd: its buffers are on the heap, where the many small files of a stage leave none behind.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*frames: DataFrame) -> None:
    """Delete the files of stored stages. Only for stages whose readers have all been stored themselves."""
    for df in frames:
        for path in {name.rsplit("/", 1)[0] for name in df.inputFiles()[:1]}:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


#: Bytes of one Arrow batch between the JVM and Python; a longer row is a batch of its own.
BATCH_BYTES = 8_000_000


def map_batches(rows: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over batches that are bounded in bytes, so long texts cannot fill a worker."""
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of each hold at most ``most`` bytes, or are one text."""
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8 bytes; null and empty texts have none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def word_hashes(words_of: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words of each text. Equal words have equal hashes everywhere."""
    counts = np.fromiter(map(len, words_of), dtype=np.int64, count=len(words_of))
    flat = pa.array((w for ws in words_of for w in ws), type=pa.binary(), size=int(counts.sum())).dictionary_encode()
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    kinds = pd.util.hash_array(flat.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return kinds[flat.indices.to_numpy()], counts


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words, and their number per text.

    A text with fewer words, but not none, is one shingle of all its words.
    """
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.cumsum(counts)
    first = np.repeat(ends - counts, n) + ramps(n)
    last = np.minimum(first + width, np.repeat(ends, n))
    total = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):
            at = first + j
            inside = at < last
            total = total * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, hashes[np.minimum(at, max(len(hashes) - 1, 0))], np.uint64(j)) if len(hashes) else total
    return mix(total), n


def ramps(n: np.ndarray) -> np.ndarray:
    """0 .. n[0]-1, 0 .. n[1]-1, and so on."""
    total = int(n.sum())
    return np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)


def having(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is among the stored, distinct ``keys``. Keys are broadcast up to a counted FEW, else both sides shuffled."""
    return rows.join(F.broadcast(keys) if keys.count() <= FEW else keys.hint("merge"), key, "left_semi")


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is not among the stored, distinct ``keys``; rows with a null key stay."""
    return rows.join(F.broadcast(keys) if keys.count() <= FEW else keys.hint("merge"), key, "left_anti")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``groups``, one row per key that also tells how many rows have it.

    Heavy keys are at most HEAVY by their share of all rows, so only they are broadcast; all others are shuffled, in
    partitions that no key can fill. Both inputs are read twice and should be stored. Keys are not null.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    heavy = F.col(size) * HEAVY > F.lit(total)
    few = groups.where(heavy)
    flags = few.select(key).withColumn("_tg_heavy", F.lit(True))
    marked = rows.join(F.broadcast(flags), key, "left")
    hot = marked.where("_tg_heavy").drop("_tg_heavy").join(F.broadcast(few), key, "inner")
    rest = marked.where("_tg_heavy IS NULL").drop("_tg_heavy").join(groups.where(~heavy), key, how)
    return hot.unionByName(rest)
