"""Token ids of documents as binary files, in document order, and back.

A folder of files holds *stripes*: runs of whole documents with about ``STRIPE`` ids.
A stripe keeps the ids and lengths of its documents and its coded blocks (``idcoder``):
each block starts from a fresh model and carries a crc32, so any stripe can be read alone
and damage is found.  Spark writes the files, so an executor that is lost leaves no part
files behind and any file system that Spark knows will do.

Documents are in ascending order of their ids over ``(part, stripe, place in stripe)``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm import bpe, idcoder
from counterfold.llm.common import byte_texts, give_back, parts, ship, shuffle_width

STRIPE = 1 << 20
# ids coded side by side in one call: the bound of a task's memory.  A step of the decoder
# has more calls, which wide arrays make up for; a block of 4,096 ids takes it some 90 kB
TOGETHER, DECODED = 10 << 20, 14 << 20
FEW = 100_000  # stripes, of 16 bytes each, that are sent to every executor


def _blocks(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i : i + idcoder.BLOCK] for i in range(0, len(ids), idcoder.BLOCK)]


def write_token_files(
    docs: DataFrame, path: str, target: str, *, id_column: str = "doc_id",
    text_column: str = "text", end: int = 1,
) -> str:
    """Encode whole texts with the tokenizers file ``path``, each ended by ``end``, into files.

    Ids must be below 65,536.  A null or empty text is its end id alone.  Null document ids
    come first, equal ids follow each other in the order of their texts, other columns are
    ignored; an empty table gives files without stripes.  Returns ``target``.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    if bpe.library(path).get_vocab_size() > idcoder.VOCABULARY:
        raise ValueError("token ids above 65,535 do not fit the file format")
    tail = np.array([end], "<u4").tobytes()

    def stripes(batches):
        part, made, held, docs_held, size = TaskContext.get().partitionId(), 0, [], [], 0
        kinds = None

        def flush(held):
            nonlocal made
            blocks = [_blocks(ids) for _, _, ids in held]
            coded = iter(idcoder.encode([b for bs in blocks for b in bs]))
            for (names, lengths, _), bs in zip(held, blocks):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([made], pa.int32()),
                        pa.array([sum(lengths)], pa.int64()),
                        pa.array([names], pa.list_(kinds)),
                        pa.array([lengths], pa.list_(pa.int64())),
                        pa.array([[next(coded) for _ in bs]], pa.list_(pa.binary())),
                    ],
                    ["part", "stripe", "n_ids", "doc_ids", "lengths", "blocks"],
                )
                made += 1

        def close(run):
            ids = np.frombuffer(b"".join(x for _, x in run), "<u4").astype(np.uint16)
            return [d for d, _ in run], [len(x) // 4 for _, x in run], ids

        for batch in parts(batches, "text"):
            kinds = batch.schema.field(0).type
            memory = bpe.id_memory(path, fold=True)
            texts = [b.decode("utf-8", "replace") for b in byte_texts(batch, "text")]
            for doc, ids in zip(batch.column(0).to_pylist(), memory.values(texts)):
                docs_held.append((doc, ids + tail))
                size += len(ids) // 4 + 1
                if size >= STRIPE:
                    held.append(close(docs_held))
                    docs_held, size = [], 0
                    if sum(len(h[2]) for h in held) >= TOGETHER:
                        yield from flush(held)
                        held = []
        if docs_held:
            held.append(close(docs_held))
        if held:
            yield from flush(held)
        del held
        give_back()

    (
        docs.selectExpr(f"`{id_column}` AS doc_id", f"CAST(`{text_column}` AS STRING) AS text")
        .repartitionByRange(shuffle_width(docs), F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(
            stripes, f"part int, stripe int, n_ids long, doc_ids array<{kind}>, "
            "lengths array<long>, blocks array<binary>")
        .write.option("compression", "none").parquet(target)
    )
    return target


def read_token_files(spark: SparkSession, target: str) -> DataFrame:
    """Per document: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit).

    ``start`` counts the ids of all documents before it.  A damaged block raises.
    """
    ship(spark)
    table = spark.read.parquet(target)
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()

    def plain(batches):
        held, kinds, size = [], None, 0
        for batch in batches:
            kinds = batch.schema.field(2).type.value_type
            for row in range(batch.num_rows):
                held.append([batch.column(c)[row].as_py() for c in range(5)])
                size += sum(held[-1][3])
                if size >= DECODED:
                    yield from decoded(held, kinds)
                    held, size = [], 0
        if held:
            yield from decoded(held, kinds)
        del held
        give_back()

    def decoded(held, kinds):
        blocks = iter(idcoder.decode([b for h in held for b in h[4]]))
        for part, stripe, names, lengths, coded in held:
            ids = np.concatenate([next(blocks) for _ in coded] or [np.zeros(0, np.uint16)])
            ids = ids.astype("<u4").tobytes()
            ends = np.cumsum(np.asarray(lengths, np.int64))
            starts = ends - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(names), pa.int32()),
                    pa.array([stripe] * len(names), pa.int32()),
                    pa.array(names, kinds), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([ids[4 * a : 4 * b] for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["part", "stripe", "doc_id", "within", "n_tokens", "ids"],
            )

    sizes = table.select("part", "stripe", "n_ids")
    # one row per part in the running sum over parts, one part per window in the other
    before = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("stripe")
    at = sizes.join(before, "part").select(
        "part", "stripe",
        (F.col("before") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("base"))
    stripes = at.count()
    tasks = max(spark.sparkContext.defaultParallelism, stripes * STRIPE // DECODED)
    rows = table.select("part", "stripe", "doc_ids", "lengths", "blocks").coalesce(tasks).mapInArrow(
        plain, f"part int, stripe int, doc_id {kind}, within long, n_tokens long, ids binary")
    return rows.join(F.broadcast(at) if stripes <= FEW else at, ["part", "stripe"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids")
