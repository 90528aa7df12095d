"""Periodic runs of words, found by block convolution.

At each dyadic scale a text is cut into blocks of B words. A run of period q repeats its first words q places later, so for
2B - 1 <= q <= 4B - 2 some block inside it recurs at distance q. The sum of squared differences between a block and every
place of its window is a convolution of integers, computed exactly modulo a prime by a number-theoretic transform; places
with the sum zero are seeds. Seeds of neighbouring blocks at one distance are a chain, and a chain is extended word by word
to the full run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tidegrid.llm.common import chunks, map_batches, ramps

LEAST = 12
PRIME = np.uint64(3 * 2**30 + 1)  # products of residues fit 64 bits; transforms of up to 2^30 places
ROOT = 5
#: Numbers in one transform, or one block's transform if that is longer.
SLICE = 2**20
RUNS = ArrayType(StructType().add("start", LongType()).add("length", LongType()).add("period", LongType()))


@lru_cache(maxsize=64)
def powers(size: int, inverse: bool) -> np.ndarray:
    """The first size / 2 powers of a root of unity of that order."""
    p = int(PRIME)
    root = pow(ROOT, (p - 1) // size, p)
    root = pow(root, -1, p) if inverse else root
    out = np.ones(1, np.uint64)
    while len(out) < size // 2:
        out = np.concatenate([out, out * np.uint64(pow(root, len(out), p)) % PRIME])
    return out[: max(1, size // 2)]


def forward(x: np.ndarray) -> np.ndarray:
    """Transforms of the rows; their places come out in bit-reversed order."""
    rows, size = x.shape
    half = size // 2
    while half:
        x = x.reshape(rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1]
        x = np.stack([(u + v) % PRIME, (u + PRIME - v) % PRIME * powers(2 * half, False) % PRIME], axis=2)
        half //= 2
    return x.reshape(rows, size)


def backward(x: np.ndarray) -> np.ndarray:
    """Rows whose transforms, in bit-reversed order, are ``x``."""
    rows, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(rows, -1, 2, half)
        u, v = x[:, :, 0], x[:, :, 1] * powers(2 * half, True) % PRIME
        x = np.stack([(u + v) % PRIME, (u + PRIME - v) % PRIME], axis=2)
        half *= 2
    return x.reshape(rows, size) * np.uint64(pow(size, -1, int(PRIME))) % PRIME


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of each block and every place of its window; numbers below the prime."""
    count, b = blocks.shape
    places = windows.shape[1] - b + 1
    size = 1 << (windows.shape[1] - 1).bit_length()
    pattern, text = np.zeros((count, size), np.uint64), np.zeros((count, size), np.uint64)
    pattern[:, (-np.arange(b)) % size] = blocks
    text[:, : windows.shape[1]] = windows
    cross = backward(forward(pattern) * forward(text) % PRIME)[:, :places]
    own = (blocks * blocks % PRIME).sum(axis=1, dtype=np.uint64) % PRIME
    squares = np.concatenate([np.zeros((count, 1), np.uint64), np.cumsum(windows * windows % PRIME, axis=1, dtype=np.uint64)], axis=1)
    there = (squares[:, b:] - squares[:, : places]) % PRIME
    return (own[:, None] + there + (PRIME - cross) * np.uint64(2)) % PRIME


def implied(at: np.ndarray, distance: np.ndarray, b: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Seeds inside a known run whose period divides their distance: they belong to that run. ``at`` is in order."""
    out = np.zeros(len(at), bool)
    low, high = (np.searchsorted(at, x) for x in runs[:2])
    for k in np.flatnonzero(high > low).tolist():
        own = slice(low[k], high[k])
        out[own] |= (at[own] + b + distance[own] <= runs[1][k]) & (distance[own] % runs[2][k] == 0)
    return out


def seeds(w: np.ndarray, b: int, blocks: np.ndarray, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First word and distance of the occurrences of these blocks (by number) in their windows that no known run implies."""
    low, high = (1, 6) if b == 2 else (2 * b - 1, 4 * b - 2)
    found_at, found_far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, SLICE // (4 * b))
    for k in range(0, len(blocks), step):
        at = blocks[k : k + step] * b
        here = w[at[:, None] + np.arange(b)]
        windows = w[at[:, None] + np.arange(low, high + b)]
        row, place = np.nonzero(squared_differences(here, windows) == 0)
        first, far = at[row], place + low
        new = ~implied(first, far, b, runs)
        first, far = first[new], far[new]
        # The words themselves decide, whatever the sums are modulo the prime.
        same = np.ones(len(first), bool)
        for j in range(0, len(first), max(1, SLICE // b)):
            part = slice(j, j + max(1, SLICE // b))
            spot = first[part, None] + np.arange(b)
            same[part] = (w[spot] == w[spot + far[part, None]]).all(axis=1)
        found_at.append(first[same])
        found_far.append(far[same])
    return np.concatenate(found_at), np.concatenate(found_far)


def matching(w: np.ndarray, at: np.ndarray, distance: np.ndarray, sign: int, b: int) -> np.ndarray:
    """How many words from ``at`` on (``sign`` 1: onward, -1: backward) equal those ``distance`` words later."""
    n = np.zeros(len(at), np.int64)
    going = np.arange(len(at))
    while len(going):
        step = max(1, SLICE // b)
        counts = []
        for k in range(0, len(going), step):
            own = going[k : k + step]
            spot = (at[own] + sign * n[own])[:, None] + sign * np.arange(b)
            inside = (spot >= 0) & (spot + distance[own][:, None] < len(w))
            same = inside & (w[np.where(inside, spot, 0)] == w[np.where(inside, spot + distance[own][:, None], 0)])
            same = np.concatenate([same, np.zeros((len(own), 1), bool)], axis=1)
            counts.append(np.argmin(same, axis=1))
        gained = np.concatenate(counts)
        n[going] += gained
        going = going[gained == b]
    return n


def runs_of(words: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run in texts that lie behind each other as numbers of words.

    A run repeats its smallest period at least twice, is at least ``least`` (12 or more) words long, and does not reach
    beyond a text. In order of start, then period.
    """
    if least < 12:
        raise ValueError("blocks of two words need runs of 12 or more words")
    ends = np.cumsum(lengths)
    longest = int(lengths.max(initial=0))
    # A number of its own stands behind each text, so no two places on either side of it are the same.
    kinds = int(words.max(initial=0)) + 1
    w = np.insert(words.astype(np.int64), ends, kinds + np.arange(len(ends)))
    order = np.argsort(w, kind="stable")
    later = np.full(len(w), 2**40, np.int64)
    same = w[order[1:]] == w[order[:-1]]
    later[order[:-1][same]] = np.diff(order)[same]
    top = 2
    while 2 * top - 1 <= longest // 2:
        top *= 2
    # Room behind the last word for the widest window; these places hold numbers that never recur.
    pad = 6 * top + top - len(w) % top
    w = np.concatenate([w, w.max(initial=0) + 1 + np.arange(pad)]).astype(np.uint64)
    need = np.concatenate([later, np.full(pad, 2**40)])
    found = tuple(np.zeros(0, np.int64) for _ in range(3))
    b = 1
    while True:
        b *= 2
        if 2 * b - 1 > max(6, longest // 2) or (b == 2 and longest < least):
            break
        need = need[: len(need) // 2 * 2].reshape(-1, 2).max(axis=1)
        # All words of a block that recurs in its window recur there; few blocks of ordinary text do.
        blocks = np.flatnonzero(need <= 4 * b - 2)
        if len(found[0]) and len(blocks):
            # In a window inside a run of period up to B the block occurs at multiples of that period alone.
            short = found[2] <= b
            reach = np.maximum.accumulate(np.append(0, found[1][short]))
            blocks = blocks[reach[np.searchsorted(found[0][short], blocks * b, side="right")] < blocks * b + 5 * b - 2]
        if not len(blocks):
            continue
        at, far = seeds(w, b, blocks, found)
        if not len(at):
            continue
        order = np.lexsort((at, far))
        at, far = at[order], far[order]
        opens = np.ones(len(at), bool)
        opens[1:] = (far[1:] != far[:-1]) | (at[1:] != at[:-1] + b)
        first, q = at[opens], far[opens]
        last = at[np.append(np.flatnonzero(opens)[1:], len(at)) - 1] + b
        start = first - matching(w, first - 1, q, -1, b)
        end = last + matching(w, last, q, 1, b) + q
        whole = end - start >= np.maximum(least, 2 * q)
        fresh = tuple(np.concatenate(x) for x in zip(found, (start[whole], end[whole], q[whole])))
        order = np.lexsort((fresh[2], fresh[1], fresh[0]))
        fresh = tuple(x[order] for x in fresh)
        alone = np.ones(len(order), bool)  # of one stretch the smallest period counts
        alone[1:] = (fresh[0][1:] != fresh[0][:-1]) | (fresh[1][1:] != fresh[1][:-1])
        found = tuple(x[alone] for x in fresh)
    text = np.searchsorted(ends + np.arange(len(ends)), found[0], side="left")
    start, end = found[0] - text, found[1] - text
    order = np.lexsort((found[2], start))
    return start[order], end[order], found[2][order]


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, keep: list[str] | None = None, runs: str = "runs", collapsed: str = "collapsed"
) -> DataFrame:
    """``docs`` with the periodic ``runs`` of the words of each whole text, and the text without their repetitions.

    Words are what stands between ASCII white space. A run is a stretch of words with smallest period q, at least
    ``max(least, 2 q)`` words long, that no neighbouring word extends; ``start`` counts from 0 in words. ``collapsed``
    has the words, joined by one space, that no run contains after its first q words. Null and empty texts have no runs and an
    empty collapsed text. Rows stay one by one, repeated or not, with the columns ``keep`` (default: all); a kept column
    named like a result is replaced. An empty table stays empty.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in (runs, collapsed)]
    rows = docs.select(F.struct(F.lit(0).alias("_tg"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = StructType().add(rows.schema["row"]).add("runs", RUNS).add("collapsed", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 4_000_000):
            split = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in batch.column("text").to_pylist()]
            n = np.fromiter(map(len, split), np.int64, len(split))
            flat = pa.array((x for ws in split for x in ws), type=pa.binary(), size=int(n.sum())).dictionary_encode()
            start, end, q = runs_of(flat.indices.to_numpy(), n, least)
            ends = np.cumsum(n)
            text_of = np.searchsorted(ends, start, side="right")
            marks = np.zeros(len(flat) + 1, np.int64)
            np.add.at(marks, start + q, 1)
            np.add.at(marks, end, -1)
            kept = np.cumsum(marks[:-1]) == 0
            some = set(text_of.tolist())
            base = ends - n
            joined = [b" ".join(compress(ws, kept[base[k] : ends[k]].tolist()) if k in some else ws) for k, ws in enumerate(split)]
            columns = (start - base[text_of], end - start, q)
            structs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
            offsets = np.append(0, np.cumsum(np.bincount(text_of, minlength=len(split))))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "runs": lists, "collapsed": pa.array(joined, pa.binary()).cast(pa.string())})

    made = map_batches(rows, run, schema)
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("runs").alias(runs), F.col("collapsed").alias(collapsed))
