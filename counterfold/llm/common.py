"""Helpers shared by the text operators: shared tables, texts of Arrow batches, row numbers."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfold.session import scratch_path

#: The white space that separates words, as the fixed word pattern has it.
SPACE = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the executors, once per application; returns the session.

    Also lets Arrow batches of the session hold 4 MB at most, so that rows of many kilobytes
    do not fill a worker's memory.
    """
    if spark.conf.get(BATCH_SETTING) == "67108864b":  # its default
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return spark


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEAN_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def lean(spark: SparkSession):
    """Shuffle files of queries that run inside are deleted when each has ended."""
    before = spark.conf.get(CLEAN_SETTING, "false")
    spark.conf.set(CLEAN_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SETTING, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to a new table in the shared folder and read from there.

    Later steps, and tasks that are repeated after an executor is lost, read the files
    instead of working the rows out again; what was shuffled for them is deleted.
    """
    path = scratch_path(df.sparkSession, name)
    with lean(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def byte_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch as UTF-8; null is empty."""
    values = batch.column(column).cast(pa.large_binary())
    return [v or b"" for v in values.to_pylist()]


def parts(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20):
    """Batches cut so that the texts of each hold about ``most`` bytes, one row at least.

    Rows are only regrouped, so memory follows the longest text and not the batch size.
    """
    for batch in batches:
        sizes = np.asarray(batch.column(column).cast(pa.large_binary()).fill_null(b"")
                           .cast(pa.large_binary()).buffers()[1], dtype=np.uint8)
        offsets = sizes.view(np.int64)[: batch.num_rows + 1] if len(sizes) else np.zeros(1)
        start = 0
        for row in range(batch.num_rows):
            if offsets[row + 1] - offsets[start] >= most or row + 1 == batch.num_rows:
                yield batch.slice(start, row + 1 - start)
                start = row + 1


def give_back() -> None:
    """Let Arrow and the allocator return what they hold unused, at the end of a task of a
    reused worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # an allocator without it
        pass


def unlike(names: list[str], *wanted: str) -> list[str]:
    """Column names made of ``wanted`` that no column has, whatever the case."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def filtered(docs: DataFrame, keep) -> DataFrame:
    """The rows whose texts pass, with all their columns; null is empty.  No shuffle.

    ``keep()`` is called once a task and gives a function from texts to a list of booleans.
    """

    def rows(batches):
        passes = keep()
        for batch in parts(batches, "text"):
            yield batch.filter(pa.array(passes(byte_texts(batch, "text")), pa.bool_()))
        del passes
        give_back()

    return docs.mapInArrow(rows, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept apart: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shuffle_width(df: DataFrame) -> int:
    """Tasks for a shuffle that carries whole texts: as many as the scan has, at least."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, df.rdd.getNumPartitions())
