"""Parquet footers as a table: rows and column bounds of every file, without reading a data page."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, file string, partition map<string,string>, rows bigint, bytes bigint, low map<string,string>, high map<string,string>, nulls map<string,bigint>"
#: Files that one task opens.
FILES = 256


class FilesOfTask(InputPartition):
    def __init__(self, files: list[tuple[str, int]]):
        super().__init__(None)
        self.files = files


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _partition(path: str) -> list[tuple[str, str]]:
    return [tuple(map(unquote, part.split("=", 1))) for part in path.split("/")[:-1] if "=" in part]


def _bounds(meta: pq.FileMetaData) -> tuple[dict, dict, dict]:
    """Least and greatest value and number of nulls of each column, as far as its row groups tell."""
    low: dict = {}
    high: dict = {}
    nulls: dict = {}
    unknown: set[str] = set()
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            name, found = column.path_in_schema, column.statistics
            if found is None or found.null_count is None:
                unknown.add(name)
                continue
            nulls[name] = nulls.get(name, 0) + found.null_count
            if found.has_min_max:
                low[name] = min(low.get(name, found.min), found.min)
                high[name] = max(high.get(name, found.max), found.max)
            elif found.null_count < group.num_rows:
                unknown.add(name)
    keep = lambda d: {k: v for k, v in d.items() if k not in unknown}
    text = lambda d: {k: str(v) for k, v in keep(d).items()}
    return text(low), text(high), keep(nulls)


class FooterReader(DataSourceReader):
    def __init__(self, root: str, schema):
        self.root, self.schema = root, schema

    def partitions(self) -> list[FilesOfTask]:
        """One listing of the folder; the files are dealt out in runs of FILES."""
        system, base = _filesystem(self.root)
        found = system.get_file_info(pafs.FileSelector(base, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.path.endswith(".parquet") and not any(p.startswith(("_", ".")) for p in f.path[len(base) :].split("/")))
        return [FilesOfTask(files[k : k + FILES]) for k in range(0, len(files), FILES)]

    def read(self, partition: FilesOfTask) -> Iterator[pa.RecordBatch]:
        system, base = _filesystem(self.root)
        rows: dict[str, list] = {name: [] for name in ("path", "file", "partition", "rows", "bytes", "low", "high", "nulls")}
        for path, size in partition.files:
            with system.open_input_file(path) as file:
                meta = pq.read_metadata(file)
            low, high, nulls = _bounds(meta)
            values = (path, path.rsplit("/", 1)[-1], _partition(path[len(base) :]), meta.num_rows, size, low, high, nulls)
            for column, value in zip(rows.values(), values):
                column.append(list(value.items()) if isinstance(value, dict) else value)
        texts = pa.map_(pa.string(), pa.string())
        kinds = (pa.string(), pa.string(), texts, pa.int64(), pa.int64(), texts, texts, pa.map_(pa.string(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))


class FooterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_footers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FooterReader:
        return FooterReader(self.options["path"], schema)


def read_footers(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet file below ``root``: its partition, rows, bytes, and per column least, greatest value and nulls.

    Values are text. A column that some row group keeps no statistics of is left out of the maps; a column of nulls alone has
    no bounds. A folder without files gives no rows.
    """
    spark.dataSource.register(FooterSource)
    return spark.read.format("parquet_footers").load(root)
