"""Byte-level BPE by replaying the merges over all distinct pieces of a block of text at once.

All pieces of a block lie behind each other as one array of token ids. An inverted index from merge rank to the places of
its pairs is kept in a heap; each step takes the lowest rank, merges its leftmost pair in every piece that has one, and
looks up the two new neighbour pairs of each merge, nothing else. Long pieces have a heap of their own.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from tidegrid.llm.common import chunks, map_batches
from tidegrid.llm.pieces import Pieces, Ragged

#: Bytes of text whose new pieces are merged together.
BLOCK_BYTES = 4_000_000
#: Distinct pieces that a worker remembers, also from task to task; beyond that it starts again.
REMEMBERED = 200_000
NONE = np.int32(-1)


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The vocabulary: lines of base64 token and rank. Its size is that of a tokenizer, whatever the corpus."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, file.read().splitlines()))}


class Merges:
    """Ranks of pairs of tokens: every way to cut a token into two tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {
            ranks[t[:k]] * self.size + ranks[t[k:]]: rank
            for t, rank in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        }
        self.pair = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[p] for p in self.pair.tolist()], np.int32)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        return np.where(self.pair[at] == wanted, self.rank[at], NONE)


def replay_block(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The same for pieces of bounded length, all at once."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(raw)
    token = np.append(merges.of_byte[raw], NONE)  # the last place stands for "beyond"
    owner = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
    place = np.arange(n, dtype=np.int32)
    edge = np.zeros(n + 1, bool)
    edge[np.cumsum(lengths)[lengths > 0]] = True
    edge[0] = True
    after = np.where(edge[1:], np.int32(n), place + 1).astype(np.int32)
    before = np.where(edge[:-1], np.int32(n), place - 1).astype(np.int32)
    after, before = np.append(after, np.int32(n)), np.append(before, np.int32(n))
    entered = np.full(n + 1, NONE)  # rank of the pair that begins at each place now
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def note(at: np.ndarray) -> None:
        """Enter the pairs that begin at these places into the index."""
        entered[at] = NONE
        at = at[after[at] < n]
        rank = merges.look_up(token[at], token[after[at]])
        entered[at] = rank
        known = rank >= 0
        at, rank = at[known], rank[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(part)

    note(place)
    while heap:
        r = heapq.heappop(heap)
        noted = index.pop(r)
        at = np.sort(np.concatenate(noted)) if len(noted) > 1 else np.sort(noted[0])
        # Places merged away or changed since they were entered no longer hold this pair.
        live = entered[at] == r
        live[1:] &= at[1:] != at[:-1]
        at = at[live]
        nxt = after[at]
        if not len(at):
            continue
        first = np.ones(len(at), bool)
        first[1:] = owner[at[1:]] != owner[at[:-1]]
        later = at[~first]
        at, nxt = at[first], nxt[first]
        token[at] = r
        token[nxt] = NONE
        entered[nxt] = NONE
        beyond = after[nxt]
        after[at] = beyond
        inner = beyond < n
        before[beyond[inner]] = at[inner]
        left = before[at]
        note(np.concatenate([at, left[left < n]]))
        if len(later):  # after any lower rank that the merges have made
            if r not in index:
                index[r] = []
                heapq.heappush(heap, r)
            index[r].append(later)
    left = token[:n] >= 0
    return token[:n][left], np.bincount(owner[left], minlength=len(pieces)).astype(np.int64)


#: Pieces of more bytes than this are merged one by one, by a heap of their own pairs.
LONG = 256


def replay_long(piece: bytes, merges: Merges) -> list[int]:
    """Token ids of one long piece: its pairs in a heap by rank and place, linked neighbours, n log n steps."""
    token = merges.of_byte[np.frombuffer(piece, np.uint8)].tolist()
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    known: dict[tuple[int, int], int] = {}

    def rank(left: int, right: int) -> int:
        """Rank of a pair, or -1; a piece has few different pairs."""
        if (left, right) not in known:
            known[left, right] = int(merges.look_up(np.array([left]), np.array([right]))[0])
        return known[left, right]

    heap = [(r, k) for k in range(n - 1) if (r := rank(token[k], token[k + 1])) >= 0]
    heapq.heapify(heap)
    while heap:
        r, k = heapq.heappop(heap)
        nxt = after[k]
        # A pair that was changed or merged away since it was entered is stale.
        if token[k] < 0 or nxt >= n or rank(token[k], token[nxt]) != r:
            continue
        token[k], token[nxt] = r, -1
        beyond = after[nxt]
        after[k] = beyond
        if beyond < n:
            before[beyond] = k
            if (right := rank(r, token[beyond])) >= 0:
                heapq.heappush(heap, (right, k))
        left = before[k]
        if left >= 0 and (own := rank(token[left], r)) >= 0:
            heapq.heappush(heap, (own, left))
    return [t for t in token if t >= 0]


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces behind each other, and the number of ids of each piece."""
    long = [k for k, p in enumerate(pieces) if len(p) > LONG]
    if not long:
        return replay_block(pieces, merges)
    # A step of the block merges one place in each piece, which would take a long run of one character a step for each.
    flat, n = replay_block([b"" if len(p) > LONG else p for p in pieces], merges)
    own = {k: replay_long(pieces[k], merges) for k in long}
    starts = np.cumsum(n) - n
    parts, at = [], 0
    for k in long:
        parts += [flat[at : starts[k]], np.array(own[k], flat.dtype)]
        at = starts[k]
        n[k] = len(own[k])
    return np.concatenate([*parts, flat[at:]]), n


@lru_cache(maxsize=1)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


class Coder:
    """Encodes blocks of texts; remembers the ids of pieces that it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.pattern = Merges(ranks), pattern
        self.clear()

    def clear(self) -> None:
        self.cuts, self.words, self.ids = Pieces(), {}, Ragged(np.int32)
        self.words_of = Ragged(np.int32)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.cuts) > REMEMBERED:
            self.clear()
        cuts, n_cuts = self.cuts.of_block(texts)
        find, words = _compiled(self.pattern).findall, self.words
        found = [find(p) for p in self.cuts.texts[len(self.words_of.length) :]]
        known = len(words)
        flat = np.fromiter((words.setdefault(w, len(words)) for ws in found for w in ws), np.int32)
        self.words_of.extend(flat, np.fromiter(map(len, found), np.int64, len(found)))
        fresh = [w.encode("utf-8", "surrogatepass") for w in list(words)[known:]]
        self.ids.extend(*replay(fresh, self.merges))
        word, n_words = self.words_of.take(cuts)
        ids, n_ids = self.ids.take(word)
        per_cut = np.concatenate([[0], np.cumsum(n_words)])[np.concatenate([[0], np.cumsum(n_cuts)])]
        ends = np.concatenate([[0], np.cumsum(n_ids)])[per_cut]
        return ids, np.diff(ends)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.merges.tokens.__getitem__, ids))


_CODERS: dict[tuple[str, str], Coder] = {}


def coder_of(ranks: str, pattern: str, vocabulary: dict[bytes, int]) -> Coder:
    """One coder for all tasks that a worker runs."""
    if (ranks, pattern) not in _CODERS:
        _CODERS.clear()
        _CODERS[ranks, pattern] = Coder(vocabulary, pattern)
    return _CODERS[ranks, pattern]


def encode(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str | None = "token_ids", digests: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with the token ids of each whole text in column ``ids``.

    Every match of ``pattern`` is encoded by itself, without special tokens; the pattern must begin a new match at a space
    behind a visible character. Null and empty texts have no ids. Rows stay one by one, repeated or not, and keep the
    columns ``keep`` (default: all), whatever their names; one named like a result is replaced. With ``digests`` the ids are
    decoded again, and the digests of the decimal ids and of the decoded bytes stand beside their number; ``ids`` None
    leaves the ids out. An empty table stays empty.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_ranks(spark, ranks))
    made = ["n_tokens"] + [ids] * (ids is not None) + ["ids_sha256", "decoded_sha256"] * digests
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.struct(F.lit(0).alias("_tg"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = StructType().add("row", rows.schema["row"].dataType).add("n_tokens", LongType())
    if ids is not None:
        schema = schema.add("ids", ArrayType(IntegerType()))
    if digests:
        schema = schema.add("ids_sha256", StringType()).add("decoded_sha256", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks, pattern, vocabulary.value)
        names = [str(n).encode() for n in range(coder.merges.size)]
        for batch in chunks(batches, "text", BLOCK_BYTES):
            flat, n = coder.encode(batch.column("text").to_pylist())
            columns = {"row": batch.column("row"), "n_tokens": pa.array(n, pa.int64())}
            if ids is not None:
                offsets = pa.array(np.append(0, np.cumsum(n)), pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
            if digests:
                ends, listed, coded = np.cumsum(n), [], []
                for a, b in zip((ends - n).tolist(), ends.tolist()):
                    own = flat[a:b].tolist()
                    listed.append(hashlib.sha256(b",".join(map(names.__getitem__, own))).hexdigest())
                    coded.append(hashlib.sha256(coder.decode(own)).hexdigest())
                columns |= {"ids_sha256": pa.array(listed, pa.string()), "decoded_sha256": pa.array(coded, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    coded = map_batches(rows, run, schema)
    own = [F.col(f"row.`{c}`").alias(c) for c in keep]
    return coded.select(*own, "n_tokens", *[F.col("ids").alias(c) if c == ids else F.col(c) for c in made[1:]])


def decode(coded: DataFrame, ranks: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text of column ``ids`` beside it (a column of that name is replaced).

    A null list stays null, an empty one is an empty text; an id that is not in the vocabulary stops the query, bytes that are
    not UTF-8 become the replacement character. Rows stay one by one, an empty table stays empty.
    """
    vocabulary = coded.sparkSession.sparkContext.broadcast(load_ranks(coded.sparkSession, ranks))

    @F.pandas_udf("string")
    def texts(lists: pd.Series) -> pd.Series:
        tokens = {r: t for t, r in vocabulary.value.items()}
        join = lambda own: None if own is None else b"".join(tokens[i] for i in own).decode("utf-8", "replace")
        return lists.map(join)

    return coded.withColumn(text, texts(F.col(f"`{ids}`")))
