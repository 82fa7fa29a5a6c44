"""Tables and configuration files."""

from __future__ import annotations

import json

import pyarrow as pa
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from counterfold.sources.arrow import SPLIT_BYTES, ArrowSource, files_of, place, plain
from counterfold.plans.estimands import Configuration, configuration_from_dict


def read_table(spark: SparkSession, source, schema: T.StructType | None = None) -> DataFrame:
    """A DataFrame is passed through; ``.csv`` has a header and typed columns;
    ``.parquet`` is the format for large tables; anything else is Arrow IPC."""
    if isinstance(source, DataFrame):
        return source
    path = str(source).rstrip("/")
    if path.endswith(".csv"):
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        return reader.csv(path)
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return read_arrow(spark, path, schema)


def _open(content: bytes):
    buf = pa.py_buffer(content)
    try:
        f = pa.ipc.open_file(buf)
        return f.schema, (f.get_batch(i) for i in range(f.num_record_batches))
    except pa.ArrowInvalid:
        s = pa.ipc.open_stream(buf)
        return s.schema, iter(s)


def read_arrow(
    spark: SparkSession, path: str, schema: T.StructType | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Arrow IPC files, split by ranges of record batches.  In a folder every file but ``.csv``
    is one, whatever its extension.  The schema comes from the first file unless it is given.
    Where only Spark can open the path, a task reads a file."""
    try:
        place(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return _read_whole_files(spark, path, schema)
    if not files_of(path):
        raise FileNotFoundError(path)
    spark.dataSource.register(ArrowSource)
    reader = spark.read.format(ArrowSource.name()).option("splitbytes", split_bytes)
    return (reader.schema(schema) if schema else reader).load(path)


def _read_whole_files(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Arrow IPC files through Spark's own file systems, one task per file."""
    files = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith(".csv"))
    if schema is None:

        def first_schema(batches):
            for b in batches:
                for content in b.column("content"):
                    found, inner = _open(content.as_buffer())
                    empty = pa.RecordBatch.from_arrays(
                        [pa.array([], type=f.type) for f in found], schema=found
                    )
                    text = plain(empty).schema.serialize().to_pybytes()
                    yield pa.RecordBatch.from_pydict({"s": [text]})
                    return

        row = files.limit(1).select("content").mapInArrow(first_schema, "s binary").first()
        if row is None:
            raise FileNotFoundError(path)
        schema = from_arrow_schema(pa.ipc.read_schema(pa.py_buffer(bytes(row["s"]))))

    def batches_of(batches):
        for b in batches:
            for content in b.column("content"):
                _, inner = _open(content.as_buffer())
                for batch in inner:
                    yield plain(batch)

    return files.select("content").mapInArrow(batches_of, schema)


def read_configuration(spark: SparkSession, source) -> Configuration:
    """Questions from a ``.json`` or ``.yaml`` file, or from objects."""
    if isinstance(source, Configuration):
        return source
    if isinstance(source, (list, tuple)):
        if all(isinstance(e, dict) for e in source):
            return configuration_from_dict(source)
        return Configuration(tuple(source))
    if isinstance(source, dict):
        return configuration_from_dict(source)
    path = str(source)
    if not path.endswith((".json", ".yaml", ".yml")):
        raise ValueError(f"cannot read {path}: supported file types are JSON, YAML and YML")
    text = spark.read.text(path, wholetext=True).first()[0]
    return configuration_from_dict(
        json.loads(text) if path.endswith(".json") else yaml.safe_load(text)
    )
