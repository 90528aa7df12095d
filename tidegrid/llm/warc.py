"""WARC files as a Spark data source: one compressed record per page, with skip lengths so that payloads can be passed over.

``spark.read.format("warc")`` plans whole files, packed into partitions by size. Filters on header columns are checked on
the parsed headers; of a record that fails, or when no payload is asked for, nothing beyond the headers is inflated.
``df.write.format("warc")`` writes files of bounded size to a staging folder and moves them when the job commits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from tidegrid.llm.common import join_groups, stored

SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
# Header names of the format, by column.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EXTRA = struct.Struct("<2sHQQ")  # gzip extra field "sl": compressed and full length of the record
HEAD = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", EXTRA.size)
BUNDLE = 64 * 2**20


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def line(value: str) -> str:
    """A header value on one line."""
    return value.replace("\\", "%5C").replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One record, compressed by itself. A revisit keeps the HTTP headers and leaves the payload out."""
    payload = row["payload"] or b""
    kept = row["record_type"] == "response"
    length = len(payload) if kept else row["payload_bytes"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block += payload if kept else b""
    named = {**row, "payload_digest": "sha1:" + (row["payload_digest"] or digest(payload))}
    fields = [f"{HEADERS[c]}: {line(named[c])}\r\n" for c in HEADERS if named.get(c) is not None]
    if not kept:
        fields.append(f"WARC-Profile: {PROFILE}\r\n")
    kind = "Content-Type: application/http; msgtype=response\r\n"
    head = "WARC/1.1\r\n" + "".join(fields) + kind + f"Content-Length: {len(block)}\r\n\r\n"
    plain = head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = packer.compress(plain) + packer.flush()
    size = len(HEAD) + EXTRA.size + len(body) + 8
    return HEAD + EXTRA.pack(b"sl", 16, size, len(plain)) + body + struct.pack("<II", zlib.crc32(plain), len(plain) % 2**32)


def headers_of(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, verify: bool):
        self.path, self.columns, self.verify = path, schema.fieldNames(), verify
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.filters.append((name, "in", [f.value]))
            elif name in HEADERS and isinstance(f, In):
                self.filters.append((name, "in", list(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.filters.append((name, "starts", f.value))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.filters.append((name, "known", None))
            else:
                yield f

    def partitions(self):
        fs, root = filesystem(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=False))
        files = sorted((i.path, i.size) for i in found if i.is_file and i.path.endswith(".warc.gz"))
        packs: list[list[str]] = []
        room = 0
        for path, size in files:
            if not packs or room < size:
                packs.append([])
                room = BUNDLE
            packs[-1].append(path)
            room -= size
        return [Files(p) for p in packs] or [Files([])]

    def keeps(self, values: dict) -> bool:
        for name, kind, wanted in self.filters:
            value = values[name]
            if value is None or kind == "in" and value not in wanted or kind == "starts" and not value.startswith(wanted):
                return False
        return True

    def read(self, partition):
        fs, _ = filesystem(self.path)
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                for row in self.records(file):
                    yield tuple(row[c] for c in self.columns)

    def records(self, file) -> Iterator[dict]:
        wants = "payload" in self.columns or self.verify
        at, end, prefix = 0, file.size(), len(HEAD) + EXTRA.size
        while at < end:
            file.seek(at)
            lead = file.read(prefix)
            mark, _, size, _ = EXTRA.unpack(lead[len(HEAD) :])
            if lead[:4] != HEAD[:4] or mark != b"sl":
                raise ValueError(f"no record with a skip length at byte {at}")
            inflate, seen = zlib.decompressobj(-15), b""
            while seen.count(b"\r\n\r\n") < 2:  # the record's own headers and those of the response
                more = file.read(min(2048, at + size - 8 - file.tell()))
                if not more:
                    break
                seen += inflate.decompress(more)
            head, _, block = seen.partition(b"\r\n\r\n")
            values = self.values(headers_of(head))
            if self.keeps(values):
                http, _, payload = block.partition(b"\r\n\r\n")
                values["payload_bytes"] = int(headers_of(http)["content-length"])
                if wants and values["record_type"] == "response":
                    payload += inflate.decompress(file.read(at + size - 8 - file.tell()))
                    values["payload"] = payload[: values["payload_bytes"]]
                    if self.verify and (digest(values["payload"]) != values["payload_digest"]):
                        raise ValueError(f"{values['record_id']}: the payload does not fit its digest")
                yield values
            at += size

    @staticmethod
    def values(found: dict[str, str]) -> dict:
        row = {c: found.get(h.lower()) for c, h in HEADERS.items()}
        row = {c: v and v.replace("%0A", "\n").replace("%0D", "\r").replace("%5C", "\\") for c, v in row.items()}
        row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
        return row | {"payload_bytes": None, "payload": None}


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, most: int):
        self.path, self.most, self.job = path, most, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.path)
        staging, names, out, size = f"{root}/_staging-{self.job}", [], None, 0
        fs.create_dir(staging, recursive=True)
        for batch in iterator:
            for k in range(batch.num_rows):
                if out is None or size >= self.most:
                    if out is not None:
                        out.close()
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(f"{staging}/{names[-1]}", compression=None), 0
                data = record({c: batch.column(c)[k].as_py() for c in batch.schema.names})
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return Written(names)

    def commit(self, messages) -> None:
        """Only files of tasks that counted are moved; what lost attempts left behind goes with the staging folder."""
        fs, root = filesystem(self.path)
        for m in messages:
            for name in m.names if m else []:
                fs.move(f"{root}/_staging-{self.job}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        if fs.get_file_info(f"{root}/_staging-{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_staging-{self.job}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, self.options.get("verify", "false") == "true")

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("maxFileBytes", BUNDLE)))


def enable(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, verify: bool = False) -> DataFrame:
    """Records below ``path``. Without "payload" among ``columns`` no payload is decoded, unless ``verify`` checks digests."""
    enable(spark)
    schema = T.StructType([f for f in SCHEMA if columns is None or f.name in columns])
    return spark.read.format("warc").schema(schema).option("verify", str(verify).lower()).load(path)


def page_records(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    body: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Record columns for pages: of equal payloads of ``min_bytes`` or more the smallest id responds, the rest revisit it.

    A null body is an empty payload, a null url an absent header. Rows with a null id are responses of their own. Rows that
    repeat an id and payload are alike: all respond, or all revisit. Other columns are ignored.
    """
    rows = pages.select(
        F.col(id).cast("string").alias("_tg_id"),
        F.col(id).alias("_tg_order"),
        F.col(url).alias("target_uri"),
        F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("_tg_digest", F.sha1("payload"))
    known = rows.where(F.col("_tg_id").isNotNull() & (F.octet_length("payload") >= min_bytes))
    small = stored(known.select("_tg_id", "_tg_order", "_tg_digest"))
    groups = small.groupBy("_tg_digest").agg(F.min_by("_tg_id", "_tg_order").alias("_tg_first"), F.count("*").alias("_tg_n"))
    groups = stored(groups.where("_tg_n > 1"))
    again = join_groups(small, groups, "_tg_digest", "_tg_n", "inner").where("_tg_id != _tg_first")
    again = stored(again.select("_tg_id", "_tg_digest", "_tg_first").distinct())
    name = lambda c: F.concat(F.lit("<urn:page:"), c, F.lit(">"))
    joined = rows.join(again, ["_tg_id", "_tg_digest"], "left")
    first = F.col("_tg_first")
    return joined.select(
        name(F.coalesce("_tg_id", F.lit("-"))).alias("record_id"),
        F.when(first.isNull(), "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.lit(date).alias("date"),
        name(first).alias("refers_to"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.when(first.isNull(), F.col("payload")).alias("payload"),
        F.col("_tg_digest").alias("payload_sha1"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write record columns; the digest comes as hexadecimal ``payload_sha1``."""
    enable(records.sparkSession)
    b32 = _base32(F.col("payload_sha1"))
    records.withColumn("payload_digest", b32).drop("payload_sha1").write.format("warc").mode("append").save(path)


def _base32(hexed):
    """Eight groups of five hexadecimal digits, each four base32 digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = []
    for k in range(8):
        part = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32)
        groups.append(F.translate(F.lpad(part, 4, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", letters))
    return F.concat(*groups)


def page_id(name: str):
    return F.expr(f"try_cast(substring({name}, 11, length({name}) - 11) AS bigint)")
