"""Documents packed into training sequences with little padding.

Bounded-space online packing: each partition keeps a fixed number of open windows.  A
piece goes to the open window that it fills best.  If none has room, the fullest one is
topped up with the head of the piece (unless its gap is tiny) and emitted.  What is
still open at the end of the partitions is merged: windows of many partitions are cut
and laid end to end, so only the last of each merge is short.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.llm import bpe
from counterfold.llm.common import byte_texts, give_back, parts, ship, stored

SCHEMA = (
    "doc_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long"
)
PART = 1 << 20  # bytes of text that are cut and placed together
KINDS = [None, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]


class Windows:
    """At most ``space`` open windows of ``size`` tokens; pieces are (doc, start, ids, total)."""

    def __init__(self, size: int, space: int, least_cut: int):
        self.size, self.space, self.least_cut = size, space, least_cut
        self.room: list[tuple[int, int]] = []  # (free tokens, window), sorted
        self.content: dict[int, list] = {}
        self.made = 0

    def add(self, doc, ids: bytes):
        """Yields (window, pieces) of what is emitted while the document is placed."""
        total, start = len(ids) // 4, 0
        while total - start >= self.size:  # full windows of their own
            yield self.made, [(doc, start, ids[4 * start : 4 * (start + self.size)], total)]
            self.made += 1
            start += self.size
        while start < total:
            need = total - start
            at = bisect.bisect_left(self.room, (need, -1))
            if at < len(self.room):
                self._put(at, (doc, start, ids[4 * start :], total), need)
                start = total
            elif len(self.room) < self.space:
                bisect.insort(self.room, (self.size, self.made))
                self.content[self.made] = []
                self.made += 1
            else:
                gap, window = self.room[0]  # the fullest
                if gap >= self.least_cut and need - gap >= self.least_cut:
                    piece = (doc, start, ids[4 * start : 4 * (start + gap)], total)
                    self.content[window].append(piece)
                    start += gap
                self.room.pop(0)
                yield window, self.content.pop(window)
            while self.room and self.room[0][0] == 0:
                yield self.room[0][1], self.content.pop(self.room.pop(0)[1])

    def _put(self, at: int, piece, need: int) -> None:
        room, window = self.room.pop(at)
        self.content[window].append(piece)
        bisect.insort(self.room, (room - need, window))


def _rows(part: int, window: int, pieces: list, is_open: bool):
    offset = 0
    for doc, start, ids, total in pieces:
        yield doc, start, ids, total, (part << 32) + window, offset, is_open
        offset += len(ids) // 4


def pack_documents(
    docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text",
    size: int = 1024, end: int = 0, space: int = 64, least_cut: int = 32, merge: int = 256,
    remembered: int = bpe.MEMORY,
) -> DataFrame:
    """Pieces with their ids: ``doc_id, start, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds little-endian unsigned 32-bit token ids of the tokenizers file ``path``;
    every document ends with ``end``.  ``start`` counts the document's ids before the piece,
    ``offset`` those before it in its sequence, gapless.  A sequence holds at most ``size``
    ids.  ``space`` windows are open in a partition; pieces shorter than ``least_cut`` are
    not cut off to fill a gap; leftovers of ``merge`` partitions are merged in one task, which
    holds ``merge * space * size`` ids at most, whatever the input.  A worker remembers the ids
    of ``remembered`` chunks of text, and so do workers that wait for their next task; fewer
    make them smaller and slower and change no result.

    A null or empty text is its end id alone.  Repeated rows are packed row by row, null ids
    are kept, other columns are ignored, an empty table gives an empty result.  Results
    are the same for the same input files and splits.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    tail = np.array([end], "<u4").tobytes()
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "is_open"]

    def packed(batches):
        part, windows = TaskContext.get().partitionId(), Windows(size, space, least_cut)
        types = None
        for batch in parts(batches, "text", PART):
            memory = bpe.id_memory(path, remembered)
            texts = [b.decode("utf-8", "replace") for b in byte_texts(batch, "text")]
            types = batch.schema.field(0).type
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), memory.values(texts)):
                for window, pieces in windows.add(doc, ids + tail):
                    out.extend(_rows(part, window, pieces, False))
            yield _batch(out, types)
        if types is not None:
            out = []
            for window, pieces in sorted(windows.content.items()):
                out.extend(_rows(part, window, pieces, True))
            yield _batch(out, types)
            give_back()

    def _batch(rows, types):
        columns = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [types, *KINDS[1:]])], names)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        base = (1 << 62) + (key[0].as_py() << 32)
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows, filled = [], 0
        for doc, start, ids, total in zip(*(table.column(c).to_pylist() for c in names[:4])):
            at, n = 0, len(ids) // 4
            while at < n:
                take = min(n - at, size - filled % size)
                rows.append((doc, start + at, ids[4 * at : 4 * (at + take)], total,
                             base + filled // size, filled % size))
                at += take
                filled += take
        types = [table.schema.field("doc_id").type, *KINDS[1:6]]
        columns = zip(*rows) if rows else [[]] * 6
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names[:6])

    table = stored(
        docs.selectExpr(f"`{id_column}` AS doc_id", f"CAST(`{text_column}` AS STRING) AS text")
        .mapInArrow(packed, SCHEMA.format(kind=kind) + ", is_open boolean"),
        "packed",
    )
    closed = table.where(~F.col("is_open")).drop("is_open")
    left = (
        table.where("is_open")
        .withColumn("merge", F.shiftright("sequence_id", 32) / merge)
        .withColumn("merge", F.floor("merge").cast("long"))
        .groupBy("merge")
        .applyInArrow(merged, SCHEMA.format(kind=kind))
    )
    return closed.unionByName(left)
