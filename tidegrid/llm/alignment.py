"""Alignment of two tokenizers, and how often their ids meet over a corpus, by external spill counting.

The bytes of a text are cut where tokens of both tokenizers end; all tokens within a cut are linked. Encoding tasks write what
they have linked as runs: pairs of ids in order, with the documents that hold them, packed by zstd and dealt into radix
partitions of the first tokenizer's ids. A k-way heap merge walks the runs of one partition id by id, counts each pair over all
documents, and, as all pairs of an id pass together, knows the id's highest count at once; the counts go back to each run in
its own order, and from there to the documents. More runs than one merge takes are merged into wider runs first, and the counts
come down again the same way.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructType

from tidegrid.llm.common import chunks, map_batches, ramps, stored
from tidegrid.llm.pieces import Pieces, Ragged

#: Radix partitions of the first tokenizer's ids.
PARTS = 256
#: Runs that one merge takes.
FAN = 128
#: Distinct pieces of text that a worker remembers, also from task to task; beyond that it starts again.
REMEMBERED = 300_000
#: Pieces given to the tokenizers at a time.
ASKED = 20_000
#: Groups with more links than this are counted by distinct ids.
WIDE = 1_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def byte_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest follows U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def groups_of(a: list[int], a_bytes: list[int], b: list[int], b_bytes: list[int]) -> Iterator[tuple[list[int], list[int]]]:
    """Tokens of both sides between places where both end; the bytes of both sides are the same."""
    i = j = first_a = first_b = 0
    at_a = at_b = 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a += a_bytes[i]
            i += 1
        else:
            at_b += b_bytes[j]
            j += 1
        if at_a == at_b:
            yield a[first_a:i], b[first_b:j]
            first_a, first_b = i, j


def counted(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and all numbers behind each other."""
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return n, np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum()))


def byte_table(tokens: list[bytes]) -> Ragged:
    table = Ragged(np.uint8)
    table.extend(np.frombuffer(b"".join(tokens), np.uint8), np.fromiter(map(len, tokens), np.int64, len(tokens)))
    return table


class Aligner:
    """Both tokenizers, and the alignment of every piece of text met so far.

    A piece begins at a space behind a visible character; both tokenizers begin a new token there, so the alignment of a text
    is that of its pieces in order.
    """

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        of_char = byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = bytes(map(of_char.__getitem__, token))
        self.width = self.b.get_piece_size()
        names = [self.b.id_to_piece(k) for k in range(self.width)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        if any("▁" in p.lstrip("▁") for p in names):
            raise ValueError("tokens of the second tokenizer must not go on over a space")
        self.space = self.b.piece_to_id("▁")
        self.a_table, self.b_table = (byte_table(t) for t in (self.a_bytes, self.b_bytes))
        # Every id with the mark behind it: a comma, or what ends its side of a group.
        self.marks = [f"{k}{m}" for k in range(len(self.a_bytes)) for m in ",|"] + [f"{k}{m}" for k in range(self.width) for m in ",;"]
        self.mark_size = np.fromiter(map(len, self.marks), np.int64)
        self.clear()

    def clear(self) -> None:
        self.pieces, self.groups, self.sound = Pieces(), [], []
        self.counts = np.zeros((0, len(COUNTS)), np.int64)
        self.keys, self.times = Ragged(np.int64), Ragged(np.int64)

    def learn(self) -> None:
        """Align the pieces that are new."""
        fresh = self.pieces.texts[len(self.groups) :]
        for k in range(0, len(fresh), ASKED):
            self._learn(fresh[k : k + ASKED])

    def _learn(self, fresh: list[str]) -> None:
        listed = [e.ids for e in self.a.encode_batch_fast(fresh, add_special_tokens=False)]
        n_a, a = counted(listed)
        # The second tokenizer puts the space before a text itself; for a space alone it puts nothing.
        listed = [[self.space] if p == " " else ids for p, ids in zip(fresh, self.b.encode([p[1:] for p in fresh], num_threads=1))]
        n_b, b = counted(listed)
        raw = [p.encode("utf-8", "surrogatepass") for p in fresh]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        text = np.frombuffer(b"".join(raw), np.uint8)
        sound = np.ones(len(fresh), bool)
        for ids, n, table in ((a, n_a, self.a_table), (b, n_b, self.b_table)):
            sound &= np.bincount(np.repeat(np.arange(len(n)), n), table.length[ids], len(n)) == size
        for ids, n, table in ((a, n_a, self.a_table), (b, n_b, self.b_table)):
            made, _ = table.take(ids[np.repeat(sound, n)])
            owner = np.repeat(np.flatnonzero(sound), size[sound])
            sound[owner[made != text[np.repeat(sound, size)]]] = False
        a, b = a[np.repeat(sound, n_a)], b[np.repeat(sound, n_b)]
        n_a, n_b = np.where(sound, n_a, 0), np.where(sound, n_b, 0)
        a_end, b_end = np.cumsum(self.a_table.length[a]), np.cumsum(self.b_table.length[b])
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        own, other = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        own_start, other_start = np.cumsum(own) - own, np.cumsum(other) - other
        piece_a = np.repeat(np.arange(len(fresh)), n_a)
        piece = piece_a[own_start]  # of each group
        # Text: tokens of a group, first side first, each with the mark behind it.
        marked = np.zeros(len(a) + len(b), np.int64)
        marked[np.arange(len(a)) + other_start[group_a]] = a * 2 + np.isin(np.arange(len(a)), own_start + own - 1)
        marked[np.arange(len(b)) + (own_start + own)[group_b]] = 2 * len(self.a_bytes) + b * 2 + np.isin(np.arange(len(b)), other_start + other - 1)
        written = "".join(map(self.marks.__getitem__, marked.tolist()))
        stops = np.cumsum(np.append(0, self.mark_size[marked]))[np.cumsum(n_a + n_b)].tolist()
        self.groups += [written[x : max(x, y - 1)] for x, y in zip([0, *stops], stops)]
        self.sound += sound.tolist()
        links = own * other
        per_piece = lambda x: np.bincount(piece, x, len(fresh)).astype(np.int64)
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, per_piece(np.ones(len(cuts))), per_piece(links)], axis=1)])
        # Pairs: every link, but for wide groups each pair once with its number.
        wide = links > WIDE
        spread = np.where(wide, 0, links)
        at = np.repeat(np.arange(len(cuts)), spread)
        step = ramps(spread)
        keys = a[own_start[at] + step // other[at]] * self.width + b[other_start[at] + step % other[at]]
        times, owner = np.ones(len(keys), np.int64), piece[at]
        for g in np.flatnonzero(wide).tolist():
            x, n = np.unique(a[own_start[g] : own_start[g] + own[g]], return_counts=True)
            y, m = np.unique(b[other_start[g] : other_start[g] + other[g]], return_counts=True)
            keys = np.append(keys, (x[:, None] * self.width + y).ravel())
            times = np.append(times, (n[:, None] * m).ravel())
            owner = np.append(owner, np.full(len(x) * len(y), piece[g]))
        order = np.argsort(owner, kind="stable")
        n = np.bincount(owner, minlength=len(fresh))
        self.keys.extend(keys[order], n)
        self.times.extend(times[order], n)

    def aligned(self, a: list[int], b: list[int]) -> tuple[list[str], Counter, int]:
        """Groups as text, how often each pair (``a * width + b``) is linked, and the number of links."""
        made, linked, links = [], Counter(), 0
        size_a, size_b = ([len(t[k]) for k in ids] for t, ids in ((self.a_bytes, a), (self.b_bytes, b)))
        for own, other in groups_of(a, size_a, b, size_b):
            made.append(f"{','.join(map(str, own))}|{','.join(map(str, other))}")
            links += len(own) * len(other)
            if len(own) == len(other) == 1:
                linked[own[0] * self.width + other[0]] += 1
                continue
            many = Counter(other)
            for x, n in Counter(own).items():
                for y, m in many.items():
                    linked[x * self.width + y] += n * m
        return made, linked, links

    def whole(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text by either tokenizer, asked for the whole of it; none if their bytes are not those of the text."""
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        wanted = (" " + text).encode("utf-8", "surrogatepass")
        same = b"".join(map(self.a_bytes.__getitem__, a)) == wanted == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if same else None

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Counts and groups of each text; and the pairs of all texts: id of the pair, number of the text, times linked, in order."""
        if len(self.groups) > REMEMBERED:
            self.clear()
        rows = [self.pieces.numbers(" " + t) if t else [] for t in texts]
        self.learn()
        groups, extra = [""] * len(texts), {}
        for k, row in enumerate(rows):
            if all(map(self.sound.__getitem__, row)):
                groups[k] = ";".join(filter(None, map(self.groups.__getitem__, row)))
                continue
            rows[k] = []
            if found := self.whole(texts[k]):
                made, linked, links = self.aligned(*found)
                groups[k] = ";".join(made)
                extra[k] = (len(found[0]), len(found[1]), len(made), links), linked
        n = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter(chain.from_iterable(rows), np.int64, int(n.sum()))
        text_of = np.repeat(np.arange(len(rows)), n)
        counts = np.zeros((len(texts), len(COUNTS)), np.int64)
        for c in range(len(COUNTS)):
            counts[:, c] = np.bincount(text_of, self.counts[flat, c], len(texts)) if len(flat) else 0
        keys, per = self.keys.take(flat)
        times, _ = self.times.take(flat)
        owner = np.repeat(text_of, per)
        for k, (own, linked) in extra.items():
            counts[k] = own
            keys = np.append(keys, np.fromiter(linked, np.int64, len(linked)))
            times = np.append(times, np.fromiter(linked.values(), np.int64, len(linked)))
            owner = np.append(owner, np.full(len(linked), k))
        both, place = np.unique(keys * max(1, len(texts)) + owner, return_inverse=True)
        times = np.bincount(place, times, len(both)).astype(np.int64)
        return counts, groups, both // max(1, len(texts)), both % max(1, len(texts)), times


@lru_cache(maxsize=1)
def aligner_of(a_file: str, b_file: str) -> Aligner:
    """One aligner for all tasks that a worker runs."""
    return Aligner(a_file, b_file)


def pack(x: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers as bytes of one significance behind each other, by zstd; those in order as differences."""
    x = np.diff(x, prepend=0) if ordered else x
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes, ordered: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    x = np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel()
    return np.cumsum(x) if ordered else x


def runs_of(keys: np.ndarray, docs: np.ndarray, times: np.ndarray, width: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """The runs of a block of documents, one for each radix partition that it has: keys, their documents' number, and those documents."""
    part = keys // width % PARTS
    order = np.argsort(part, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
        opens = np.flatnonzero(np.diff(keys[own], prepend=-1))
        holders = np.diff(np.append(opens, len(own)))
        yield int(part[own[0]]), pack(keys[own][opens], ordered=True), pack(holders), pack(np.concatenate([docs[own], times[own]]))


def merge(runs: list[tuple[np.ndarray, np.ndarray]], width: int) -> Iterator[tuple[list[tuple[int, slice]], np.ndarray, np.ndarray, np.ndarray]]:
    """K-way heap merge of runs (keys in order, counts), id by id of the first tokenizer.

    Yields the runs that hold the id and where, the distinct keys, which of these each of the runs' places has, and their sums.
    """
    cuts = []
    for keys, _ in runs:
        side = keys // width
        starts = np.flatnonzero(np.diff(side, prepend=-1))
        cuts.append((side[starts].tolist(), [*starts.tolist(), len(keys)]))
    heap = [(ids[0], k, 0) for k, (ids, _) in enumerate(cuts) if ids]
    heapq.heapify(heap)
    while heap:
        side, places = heap[0][0], []
        while heap and heap[0][0] == side:
            _, k, step = heap[0]
            ids, starts = cuts[k]
            places.append((k, slice(starts[step], starts[step + 1])))
            if step + 1 < len(ids):
                heapq.heapreplace(heap, (ids[step + 1], k, step + 1))
            else:
                heapq.heappop(heap)
        keys, which = np.unique(np.concatenate([runs[k][0][at] for k, at in places]), return_inverse=True)
        sums = np.bincount(which, np.concatenate([runs[k][1][at] for k, at in places])).astype(np.int64)
        yield places, keys, which, sums


WIDER = "run bigint, part int, keys binary, holders binary"
COUNTED = "run bigint, part int, counts binary"


def opened(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(unpack(k, ordered=True), unpack(h)) for k, h in zip(table.column("keys").to_pylist(), table.column("holders").to_pylist())]


def count_runs(runs: DataFrame, width: int, fan: int = FAN) -> DataFrame:
    """For each run and partition the corpus-wide count of each of its keys, negative if no key of the same first id has more."""

    def final(table: pa.Table) -> pa.Table:
        own = opened(table)
        out = [np.zeros(len(keys), np.int64) for keys, _ in own]
        for places, _, which, sums in merge(own, width):
            marked = np.where(sums == sums.max(), -sums, sums)[which]
            at = 0
            for k, place in places:
                out[k][place] = marked[at : at + place.stop - place.start]
                at += place.stop - place.start
        return pa.table({"run": table.column("run"), "part": table.column("part"), "counts": pa.array(map(pack, out), pa.binary())})

    total = runs.select("run").distinct().count()
    if total <= fan:
        return runs.groupBy("part").applyInArrow(final, COUNTED)

    def wider(table: pa.Table) -> pa.Table:
        keys, sums = zip(*((k, s) for _, k, _, s in merge(opened(table), width)))
        columns = {"run": table.column("wide")[:1], "part": table.column("part")[:1]}
        return pa.table(columns | {"keys": [pack(np.concatenate(keys), ordered=True)], "holders": [pack(np.concatenate(sums))]})

    def down(table: pa.Table, above: pa.Table) -> pa.Table:
        keys, counts = unpack(above.column("keys")[0].as_py(), ordered=True), unpack(above.column("counts")[0].as_py())
        out = [pack(counts[np.searchsorted(keys, unpack(k, ordered=True))]) for k in table.column("keys").to_pylist()]
        return pa.table({"run": table.column("run"), "part": table.column("part"), "counts": pa.array(out, pa.binary())})

    wide = F.pmod(F.xxhash64("run"), F.lit(math.ceil(total / fan))).alias("wide")
    placed = runs.select("run", "part", "keys", "holders", wide)
    merged = stored(placed.groupBy("part", "wide").applyInArrow(wider, WIDER))
    above = merged.join(count_runs(merged, width, fan), ["run", "part"]).select("part", F.col("run").alias("wide"), "keys", "counts")
    return placed.select("run", "part", "keys", "wide").groupBy("part", "wide").cogroup(above.groupBy("part", "wide")).applyInArrow(down, COUNTED)


def align(
    docs: DataFrame, a_file: str, b_file: str, text: str = "text", keep: list[str] | None = None, groups: bool = True, digests: bool = False, fan: int = FAN
) -> DataFrame:
    """``docs`` aligned by a byte-level tokenizer (a file of the tokenizers library) and a sentencepiece model.

    The first encodes the text behind a space, the second puts that space itself; special tokens are never made. Per row:
    ``n_a``, ``n_b`` tokens, ``n_groups`` between common ends, ``n_links`` pairs of token occurrences in a common group,
    ``n_best`` of them whose pair of ids as many documents of the whole table hold as any pair with that first id,
    ``count_sum`` the sum of these numbers over the links; ``groups`` as text, ``a1,a2|b1;a3|b2,b3``, and with ``digests``
    the sha256 of it.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and ''.
    Repeated rows count as documents of their own. Kept columns (default: all) named like a result are replaced. An empty
    table stays empty. No row leaves its partition but as counts; runs, not documents or pairs, are shuffled.
    """
    made = [*COUNTS, "n_best", "count_sum"] + ["groups"] * groups + ["groups_sha256"] * digests
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    rows = docs.select(F.struct(F.lit(0).alias("_tg"), *[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = StructType().add("row", rows.schema["row"].dataType).add("run", LongType()).add("doc", IntegerType())
    for c in COUNTS:
        schema = schema.add(c, LongType())
    schema = schema.add("groups", StringType()).add("groups_sha256", StringType()).add("part", IntegerType())
    schema = schema.add("keys", BinaryType()).add("holders", BinaryType()).add("documents", BinaryType())

    def filled(columns: dict[str, pa.Array], row: pa.DataType) -> pa.RecordBatch:
        """A batch of all columns; those that are not given are null."""
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
        size = len(columns["run"])
        kind = lambda f: row if f.name == "row" else kinds[f.dataType.simpleString()]
        return pa.RecordBatch.from_pydict({f.name: columns.get(f.name, pa.nulls(size, kind(f))) for f in schema.fields})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, first, number = aligner_of(a_file, b_file), TaskContext.get().partitionId() << 32, 0
        for batch in chunks(batches, "text"):
            counts, listed, keys, owner, times = aligner.align(batch.column("text").to_pylist())
            n, run = batch.num_rows, first + number
            number += 1
            hashed = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in listed] if digests else [None] * n
            columns = {"row": batch.column("row"), "run": pa.array([run] * n), "doc": pa.array(range(n), pa.int32())}
            columns |= {c: pa.array(counts[:, k]) for k, c in enumerate(COUNTS)}
            columns |= {"groups": pa.array(listed if groups else [None] * n, pa.string()), "groups_sha256": pa.array(hashed, pa.string())}
            yield filled(columns, batch.schema.field("row").type)
            for part, *packed in runs_of(keys, owner, times, aligner.width):
                own = {c: pa.array([x], pa.binary()) for c, x in zip(("keys", "holders", "documents"), packed)}
                yield filled({"run": pa.array([run]), "part": pa.array([part], pa.int32())} | own, batch.schema.field("row").type)

    def back(key, table: pa.Table, counted: pa.Table) -> pa.Table:
        known = dict(zip(counted.column("part").to_pylist(), counted.column("counts").to_pylist()))
        best, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part, holders, data in zip(*(table.column(c).to_pylist() for c in ("part", "holders", "documents"))):
            each, n = unpack(known[part]), unpack(holders)
            doc, times = np.split(unpack(data), 2)
            each = np.repeat(each, n)
            top = int(doc.max()) + 1
            if top > len(best):
                best, total = (np.concatenate([x, np.zeros(top - len(x), np.int64)]) for x in (best, total))
            np.add.at(best, doc, times * (each < 0))
            np.add.at(total, doc, times * np.abs(each))
        return pa.table({"run": pa.array([key[0].as_py()] * len(best), pa.int64()), "doc": pa.array(np.arange(len(best)), pa.int32()), "n_best": best, "count_sum": total})

    found = stored(map_batches(rows, encode, schema))
    runs = found.where("part IS NOT NULL")
    width = aligner_width(b_file)
    counted = stored(count_runs(runs.select("run", "part", "keys", "holders"), width, fan))
    mine = runs.select("run", "part", "holders", "documents").groupBy("run").cogroup(counted.groupBy("run"))
    sums = mine.applyInArrow(back, "run bigint, doc int, n_best bigint, count_sum bigint")
    out = found.where("part IS NULL").drop("part", "keys", "holders", "documents").join(sums, ["run", "doc"], "left")
    results = [F.coalesce(c, F.lit(0)).alias(c) if c in ("n_best", "count_sum") else F.col(c) for c in made]
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], *results)


def aligner_width(b_file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
