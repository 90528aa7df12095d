"""Token ids of a corpus as binary files: concatenated ids, document borders in Elias-Fano code.

A file pair ``shard-N.ids`` / ``shard-N.idx`` holds a range of document ids. ``.ids`` is 16 bits an id, or 32 where an id
needs it; ``.idx`` a mark, the bytes an id takes, the number of documents without an id, and two Elias-Fano blocks: the
document ids and the end of each document within the shard. Shards follow each other in ascending order of document id.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidegrid.llm.common import chunks, map_batches, ramps, stored
from tidegrid.llm.eliasfano import EliasFano
from tidegrid.llm.pieces import Pieces, Ragged
from tidegrid.llm.warc import filesystem

HEAD = "<4sBQ"
MARK = b"TGI1"
MANIFEST = "shard int, n_docs bigint, n_tokens bigint"
#: Distinct pieces that a worker remembers, also from task to task; beyond that it starts again.
REMEMBERED = 500_000
#: Pieces given to the library as one text, and such texts at a time.
JOINED, ASKED = 100, 200
READ = 4_000_000


class Encoder:
    """Ids by the tokenizers library, asked once for each distinct piece."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(tokenizer)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.model.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # a character of a token stands for one byte
            self.bytes_of[number] = len(token)
        self.clear()

    def clear(self) -> None:
        self.pieces, self.ids = Pieces(), Ragged(np.uint32)

    def library(self, texts: list[str]) -> list[list[int]]:
        steps = range(0, len(texts), ASKED)
        return [e.ids for k in steps for e in self.model.encode_batch_fast(texts[k : k + ASKED], add_special_tokens=False)]

    def ask(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces behind each other, and their number for each.

        Pieces of a space and a word, with no white space at their end, are given to the library as one text: it begins a
        new word at each such space. Ids stand for known numbers of bytes, which tell where each piece ends.
        """
        chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bare = np.fromiter(map(len, map(str.strip, pieces)), np.int64, len(pieces))
        spaced = np.fromiter(map(str.startswith, pieces, repeat(" ")), bool, len(pieces)) & (chars > 1) & (bare == chars - 1)
        plain, odd = np.flatnonzero(spaced), np.flatnonzero(~spaced)
        words = list(compress(pieces, spaced.tolist()))
        ids = np.fromiter(chain.from_iterable(self.library(["".join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)])), np.int64)
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, words)), np.int64, len(words)))
        ends = np.cumsum(self.bytes_of[ids])
        upto = np.searchsorted(ends, stops)
        if len(words) and (len(ids) != upto[-1] + 1 or (ends[upto] != stops).any()):
            raise ValueError("the tokenizer does not begin a new word at a space")
        alone = self.library([pieces[k] for k in odd.tolist()])
        n = np.zeros(len(pieces), np.int64)
        n[plain] = np.diff(upto + 1, prepend=0)
        n[odd] = np.fromiter(map(len, alone), np.int64, len(alone))
        flat, starts = np.zeros(n.sum(), np.uint32), np.cumsum(n) - n
        flat[np.repeat(starts[plain], n[plain]) + ramps(n[plain])] = ids
        flat[np.repeat(starts[odd], n[odd]) + ramps(n[odd])] = np.fromiter(chain.from_iterable(alone), np.uint32)
        return flat, n

    def encode(self, texts: list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts behind each other, ``end`` after each, and the number of ids of each with it."""
        if len(self.pieces) > REMEMBERED:
            self.clear()
        numbers, n_pieces = self.pieces.of_block(texts)
        fresh = self.pieces.texts[len(self.ids.length) :]
        if fresh:
            self.ids.extend(*self.ask(fresh))
        ids, n = self.ids.take(numbers)
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(n_pieces)]
        return np.insert(ids, ends, end), np.diff(ends, prepend=0) + 1


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str) -> Encoder:
    """One encoder for all tasks that a worker runs."""
    return Encoder(tokenizer)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end: int = 0, id: str = "doc_id", text: str = "text", shards: int | None = None
) -> DataFrame:
    """Write the files below ``path``; the result lists the shards.

    Rows are ranged and sorted by ``id`` (nulls first; rows that repeat an id follow each other, by text). A null text is
    empty and has the end id alone. Other columns are ignored. An empty table gives no shard.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if _largest(tokenizer, end) < 2**16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder = TaskContext.get().partitionId(), encoder_of(tokenizer)
        fs, root = filesystem(path)
        own, doc_ids, lengths, out = uuid.uuid4().hex, [], [], None
        for batch in chunks(batches, "text", 4_000_000):
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/_{own}.ids")
            ids, n = encoder.encode(batch.column("text").to_pylist(), end)
            out.write(ids.astype(f"<u{width}").tobytes())
            lengths.append(n)
            doc_ids.extend(batch.column("id").to_pylist())
        if out is None:
            return
        out.close()
        n = np.concatenate(lengths)
        known = np.array([d for d in doc_ids if d is not None], np.int64)
        index = struct.pack(HEAD, MARK, width, len(doc_ids) - len(known))
        index += EliasFano.encode(known).to_bytes() + EliasFano.encode(np.cumsum(n)).to_bytes()
        with fs.open_output_stream(f"{root}/_{own}.idx") as file:
            file.write(index)
        for kind in ("ids", "idx"):  # a repeated attempt puts equal files in the same place
            fs.move(f"{root}/_{own}.{kind}", f"{root}/shard-{shard:06d}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "n_docs": pa.array([len(n)], pa.int64()), "n_tokens": pa.array([int(n.sum())], pa.int64())}
        )

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    ranged = rows.repartitionByRange(shards, "id").sortWithinPartitions("id", "text")
    return stored(map_batches(ranged, write, MANIFEST))


def _largest(tokenizer: str, end: int) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer).get_vocab_size(), end)


def read_token_files(manifest: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``.

    ``start`` counts the ids of all documents before it, over all shards: the few totals of the shards are summed first.
    """
    spark = manifest.sparkSession
    totals = sorted((r.shard, r.n_tokens) for r in manifest.collect())  # one row per shard
    starts = np.cumsum([0, *(n for _, n in totals)])
    listed = [(shard, int(at)) for (shard, _), at in zip(totals, starts)]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(path)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/shard-{row['shard']:06d}.idx") as file:
                    doc_ids, ends, width = parse_index(file.read())
                with fs.open_input_file(f"{root}/shard-{row['shard']:06d}.ids") as file:
                    yield from documents(file, doc_ids, ends, width, row["start"], with_ids)

    parts = max(1, len(listed))
    found = spark.createDataFrame(listed, "shard int, start bigint").repartition(parts, "shard")
    return map_batches(found, read, schema)


def parse_index(data: bytes) -> tuple[list, np.ndarray, int]:
    mark, width, nameless = struct.unpack_from(HEAD, data)
    if mark != MARK:
        raise ValueError("not an index of token files")
    known, at = EliasFano.from_bytes(data, struct.calcsize(HEAD))
    ends, _ = EliasFano.from_bytes(data, at)
    return [None] * nameless + known.decode().tolist(), ends.decode(), width


def documents(file, doc_ids: list, ends: np.ndarray, width: int, base: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Batches of whole documents, some READ ids at a time."""
    k = 0
    while k < len(ends):
        first = int(ends[k - 1]) if k else 0
        stop = max(k + 1, int(np.searchsorted(ends, first + READ, side="right")))
        ids = np.frombuffer(file.read((int(ends[stop - 1]) - first) * width), f"<u{width}").astype("<u4")
        cuts = ends[k:stop] - first
        starts = np.concatenate([[0], cuts[:-1]])
        columns = {
            "doc_id": pa.array(doc_ids[k:stop], pa.int64()),
            "start": pa.array(base + first + starts, pa.int64()),
            "n_tokens": pa.array(cuts - starts, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(starts, cuts)], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts, cuts)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(columns)
        k = stop
