"""Arrow IPC files as a Spark data source that splits them.

The footer of a file says how many record batches it has and lets any of them be read
alone, so a large file is read by many tasks, a range of batches each.  A stream has no
footer and is read by one task, batch after batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

#: Bytes of a file that a task reads, about.
SPLIT_BYTES = 64 << 20


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; raises if Arrow does not know it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def files_of(path: str) -> list[tuple[str, int]]:
    """Data files at a path with their sizes; in a folder all but ``.csv`` and hidden ones."""
    system, at = place(path)
    info = system.get_file_info(at)
    if info.type == fs.FileType.File:
        return [(at, info.size)]
    found = system.get_file_info(fs.FileSelector(at)) if info.type == fs.FileType.Directory else []
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File
                  and not f.base_name.startswith((".", "_")) and f.extension != "csv")


def plain(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Dictionary-coded columns as their values, large strings as strings."""
    columns = []
    for column, f in zip(batch.columns, batch.schema):
        if pa.types.is_dictionary(f.type):
            column = column.dictionary_decode()
        if pa.types.is_large_string(column.type):
            column = column.cast(pa.string())
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def plain_schema(schema: pa.Schema) -> pa.Schema:
    empty = [pa.array([], type=f.type) for f in schema]
    return plain(pa.RecordBatch.from_arrays(empty, schema=schema)).schema


@dataclass
class Batches(InputPartition):
    """Batches of a file from ``first`` up to ``stop``; a stream has no ``stop``."""

    file: str
    first: int
    stop: int | None


class ArrowReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Batches]:
        system, _ = place(self.path)
        out = []
        for file, size in files_of(self.path):
            with system.open_input_file(file) as f:
                try:
                    n = pa.ipc.open_file(f).num_record_batches
                except pa.ArrowInvalid:
                    out.append(Batches(file, 0, None))
                    continue
            parts = max(1, min(n, -(-size // self.split)))
            edges = [n * i // parts for i in range(parts + 1)]
            out += [Batches(file, a, b) for a, b in zip(edges, edges[1:]) if b > a]
        return out

    def read(self, partition: Batches) -> Iterator[pa.RecordBatch]:
        system, _ = place(self.path)
        if partition.stop is None:
            with system.open_input_stream(partition.file) as f:
                for batch in pa.ipc.open_stream(f):
                    yield plain(batch)
            return
        with system.open_input_file(partition.file) as f:
            reader = pa.ipc.open_file(f)
            for i in range(partition.first, partition.stop):
                yield plain(reader.get_batch(i))


class ArrowSource(DataSource):
    """``spark.read.format("arrow_ipc").load(path)``; option ``splitbytes``."""

    @classmethod
    def name(cls) -> str:
        return "arrow_ipc"

    def schema(self):
        path = self.options["path"]
        system, _ = place(path)
        files = files_of(path)
        if not files:
            raise FileNotFoundError(path)
        with system.open_input_file(files[0][0]) as f:
            try:
                found = pa.ipc.open_file(f).schema
            except pa.ArrowInvalid:
                f.seek(0)
                found = pa.ipc.open_stream(f).schema
        return from_arrow_schema(plain_schema(found))

    def reader(self, schema) -> DataSourceReader:
        return ArrowReader(self.options["path"], int(self.options.get("splitbytes", SPLIT_BYTES)))
