"""Repeated passages removed by a logarithmic family of suffix arrays.

A byte goes if it lies in a string of ``least`` bytes (a *window*) that also starts in a document
with a smaller id.  Documents come in batches of ascending ids.  Each batch gets a suffix array
and is merge-scanned against the levels before it and against itself for matches of at least
``least`` bytes; levels of equal size then merge, so n batches leave about log n levels, and a
string is merged log n times at most.

The suffix arrays are sparse.  Each window is anchored at its head of 16 bytes with the smallest
hash.  Neighbouring windows mostly have the same anchor: such a *run* is one string, kept with the
place of its anchor and sorted by the suffix that starts there.  Equal windows have equal
anchors, so a match lies between strings with a common prefix of 16 bytes in that order, and
comparing the windows of such neighbours finds every one of them.

Array pieces are dealt out by the hash of the head.  A head that very many documents have, with
ever other neighbours, would make one piece too large: its windows are dealt out one by one.  Runs
whose heads only one document has cannot match and are left out first, where all documents
are at hand; a family that goes on to take batches keeps them all.

Texts stay in chunks of some megabytes; only heads, runs and findings are shuffled by content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.llm.common import byte_texts, parts, ship, stored, text_or_empty

HEAD = 16
CHUNK = 4 << 20  # bytes of text in a chunk, or one longer text
HEADS = 1 << 20  # heads in a group, about
PIECE = 8 << 20  # bytes of text whose runs meet in a group, about
HOT = 20_000  # documents with a head, from which on its windows are dealt out singly
BOUNDARIES = 10_000  # ids that the borders of batches are chosen from


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _planes(values: np.ndarray) -> bytes:
    """Numbers with their bytes sorted by weight, compressed."""
    return _pack(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def _values(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(_unpack(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def head_hashes(body: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes that start at each place.  Results never depend on it: it
    only chooses anchors and groups."""
    n = len(body) - 7
    eight = np.empty(n, np.uint64)
    for at in range(min(8, n)):
        some = body[at : at + (len(body) - at) // 8 * 8].view("<u8")
        eight[at::8] = some[: len(eight[at::8])]
    left, right = eight[:-8], eight[8:]
    return _mixed(left * np.uint64(0xD6E8FEB86659FD93) + (right ^ (right >> np.uint64(31))))


@dataclass
class Runs:
    """Windows of a chunk with one anchor, by place: ``first`` and ``last`` start, group of
    the head (48 bits) and the place of the anchor."""

    first: np.ndarray
    last: np.ndarray
    group: np.ndarray
    anchor: np.ndarray


def find_runs(body: np.ndarray, ends: np.ndarray, least: int) -> Runs:
    """Runs of the texts that end at ``ends``; none reaches over an end."""
    n = len(body) - least + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(np.uint64), none)
    keys, width = head_hashes(body), least - HEAD + 1
    low, size = keys, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    if width > size:
        rest = width - size
        low = np.minimum(low[:-rest], low[rest:])
    valid = np.ones(n, bool)
    for end in ends[:-1]:
        valid[max(0, end - least + 1) : end] = False
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    stop = np.ones(n, bool)
    stop[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(stop & valid)
    views = np.lib.stride_tricks.sliding_window_view(keys, width)
    anchor = np.empty(len(first), np.int64)
    for i in range(0, len(first), 1 << 16):
        some = first[i : i + (1 << 16)]
        anchor[i : i + len(some)] = some + views[some].argmin(axis=1)
    return Runs(first, last, _mixed(low[first]) >> np.uint64(16), anchor)


def _chunk(batches):
    part, made = TaskContext.get().partitionId(), 0
    held, size, kind = [], 0, None

    def flush():
        nonlocal made
        made += 1
        lengths = [len(t) for _, t in held]
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + made], pa.int64()),
             pa.array([[d for d, _ in held]], pa.list_(kind)),
             pa.array([np.cumsum(lengths).tolist()], pa.list_(pa.int64())),
             pa.array([_pack(b"".join(t for _, t in held))], pa.binary())],
            ["chunk", "ids", "ends", "body"])

    for batch in batches:
        for rows in parts([batch], "text"):
            kind = rows.schema.field(0).type
            for doc, text in zip(rows.column(0).to_pylist(), byte_texts(rows, "text")):
                held.append((doc, text))
                size += len(text)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _opened(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``chunk, ids, ends, body`` and the further columns of each row."""
    for row in range(batch.num_rows):
        chunk, ids, ends, body, *more = (c[row].as_py() for c in batch.columns)
        yield chunk, ids, np.array(ends, np.int64), _unpack(body), *more


def _heads(least: int, groups: int):
    def rows(batches):
        for batch in batches:
            for chunk, _, ends, body in _opened(batch):
                runs = find_runs(np.frombuffer(body, np.uint8), ends, least)
                heads, times = _own_heads(runs, ends)
                at = _part(heads, groups)
                cuts = np.flatnonzero(np.diff(at)) + 1
                pieces = [x for x in zip(np.split(heads, cuts), np.split(times, cuts)) if len(x[0])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(_part(h[:1], groups)[0]) for h, _ in pieces], pa.int64()),
                     pa.array([chunk] * len(pieces), pa.int64()),
                     pa.array([_planes(np.diff(h, prepend=np.uint64(0))) for h, _ in pieces],
                              pa.binary()),
                     pa.array([_pack(t.tobytes()) for _, t in pieces], pa.binary())],
                    ["part", "chunk", "heads", "times"])

    return rows


def _own_heads(runs: Runs, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of a chunk in order, and how many of its texts have each (255 at most)."""
    text = np.searchsorted(ends, runs.first, "right").astype(np.uint64)
    both = np.unique(np.stack([runs.group, text], 1), axis=0) if len(text) else np.zeros((0, 2), np.uint64)
    heads, times = np.unique(both[:, 0], return_counts=True)
    return heads, np.minimum(times, 255).astype(np.uint8)


def _part(group: np.ndarray, groups: int) -> np.ndarray:
    """Ranges of groups, which are hashes of 48 bits."""
    return ((group >> np.uint64(16)) * np.uint64(groups)) >> np.uint64(32)


def _company(hot: int):
    """Per chunk: 0 for a head of one text, 1 of several, 2 of more than ``hot``."""

    def marked(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        heads = [np.cumsum(_values(h, "<u8")) for h in pdf.heads]
        times = [np.frombuffer(_unpack(t), np.uint8) for t in pdf.times]
        _, at = np.unique(np.concatenate(heads), return_inverse=True)
        texts = np.bincount(at, np.concatenate(times).astype(np.float64))
        marks = ((texts >= 2).astype(np.uint8) + (texts > hot))[at].astype(np.uint8)
        cuts = np.cumsum([len(h) for h in heads])[:-1]
        return pd.DataFrame({"chunk": pdf.chunk, "part": pdf.part, "marks": [
            _pack(m.tobytes()) for m in np.split(marks, cuts)]})

    return marked


def _after(doc) -> tuple:
    """Order of ids: null is after all others."""
    return doc is None, 0 if doc is None else doc


def _strings(least: int, groups: int, borders: list, kind: pa.DataType, whole: bool):
    """The suffix array of each chunk, in pieces, and what matches inside the chunk."""
    names = ["batch", "part", "chunk", "docs", "starts", "anchors", "sizes", "strings", "found"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), *[pa.binary()] * 5]

    def rows(batches):
        for batch in batches:
            for chunk, ids, ends, body, *marks in _opened(batch):
                runs = find_runs(np.frombuffer(body, np.uint8), ends, least)
                if whole:
                    mark = np.ones(len(runs.first), np.uint8)
                else:
                    heads, at = np.unique(runs.group, return_inverse=True)
                    parts_ = sorted((m["part"], m["marks"]) for m in marks[0] or [])
                    mark = np.frombuffer(b"".join(_unpack(m) for _, m in parts_), np.uint8)[
                        at] if len(heads) else np.zeros(0, np.uint8)
                out = list(_pieces(chunk, ids, ends, body, runs, mark))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else
                    [pa.array([], t) for t in types], names)

    def _pieces(chunk, ids, ends, body, runs, mark):
        text = np.searchsorted(ends, runs.first, "right")
        some = np.flatnonzero(mark)
        place = {t: i for i, t in enumerate(sorted(
            set(text[some].tolist()), key=lambda t: _after(ids[t])))}
        order = sorted(some.tolist(), key=lambda i: place[text[i]])
        owner: dict[bytes, object] = {}  # the first id with a string
        found, pieces = [], {}

        def put(string, part, doc, batch, start, anchor):
            if string not in owner:
                owner[string] = doc
            elif owner[string] != doc:  # a smaller id has it
                found.append((start, start + len(string) - least))
                return
            pieces.setdefault((batch, part), []).append(
                (string[anchor:], string[:anchor], doc, start))

        first, last = runs.first.tolist(), runs.last.tolist()
        anchor = runs.anchor.tolist()
        part = _part(runs.group, groups).tolist()
        kind_of = mark.tolist()
        for i in order:
            doc, a = ids[text[i]], first[i]
            batch = _batch(doc)
            string = body[a : last[i] + least]
            if kind_of[i] == 1:
                put(string, part[i], doc, batch, a, anchor[i] - a)
                continue
            if string in owner and owner[string] != doc:
                found.append((a, last[i]))
                continue
            owner.setdefault(string, doc)
            spot = np.frombuffer(string, np.uint8)
            views = np.lib.stride_tricks.sliding_window_view(head_hashes(spot), least - HEAD + 1)
            for j, at in enumerate(views.argmin(axis=1).tolist()):
                window = string[j : j + least]
                spread = int.from_bytes(hashlib.blake2b(window, digest_size=4).digest(), "little")
                put(window, spread * groups >> 32, doc, batch, a + j, at)
        for (batch, part_), entries in pieces.items():
            entries.sort(key=lambda e: e[:2])
            yield (batch, part_, chunk, [e[2] for e in entries],
                   _planes(np.array([e[3] for e in entries], "<i8")), *_array(entries), None)
        if found:
            yield -1, 0, chunk, None, None, None, None, None, _planes(
                np.array(found, "<i8").ravel())

    def _batch(doc) -> int:
        return len(borders) if doc is None else sum(b < doc for b in borders)

    return rows


def _array(entries: list) -> tuple[bytes, bytes, bytes]:
    """Anchors, sizes and strings of entries that begin with suffix and left side."""
    return (
        _pack(np.array([len(e[1]) for e in entries], "<u2").tobytes()),
        _planes(np.array([len(e[0]) + len(e[1]) for e in entries], "<i4")),
        _pack(b"".join(e[1] + e[0] for e in entries)),
    )


def _entries(anchors: bytes, sizes: bytes, strings: bytes) -> list[tuple[bytes, bytes]]:
    """Suffix and left side of each string of a stored array."""
    left = np.frombuffer(_unpack(anchors), "<u2")
    stop = np.cumsum(_values(sizes, "<i4").astype(np.int64))
    start = stop - _values(sizes, "<i4")
    text = _unpack(strings)
    return [(text[a + m : b], text[a : a + m]) for a, m, b in zip(
        start.tolist(), left.tolist(), stop.tolist())]


def _scan_group(group: list, least: int):
    """Matches of new strings whose suffixes share a head.

    Entries are ``suffix, left, doc, chunk, start, level``; ``level`` is None for new ones.
    Yields ``chunk, first, last`` of windows that are in a level or in a smaller id, and
    ``None, entry`` for new strings with a window that was not known.
    """
    known, seen, waiting = set(), set(), []  # strings; their windows; strings not yet cut
    fresh = []
    for e in group:
        if e[5] is None:
            fresh.append(e)
        elif e[:2] not in known:
            known.add(e[:2])
            waiting.append(e[1] + e[0])
    fresh.sort(key=lambda e: _after(e[2]))
    for _, block in groupby(fresh, key=lambda e: _after(e[2])):
        added = []
        for e in block:
            string = e[1] + e[0]
            n = len(string) - least + 1
            if e[:2] in known:
                yield e[3], e[4], e[4] + n - 1
                continue
            if known:
                for s in waiting:
                    seen.update(s[i : i + least] for i in range(len(s) - least + 1))
                waiting.clear()
                hits = [i for i in range(n) if string[i : i + least] in seen]
                for a, b in _stretches(hits):
                    yield e[3], e[4] + a, e[4] + b
                if len(hits) == n:
                    continue
            added.append(e)
        for e in added:
            if e[:2] not in known:
                known.add(e[:2])
                waiting.append(e[1] + e[0])
                yield None, e


def _stretches(hits: list[int]):
    """Runs of consecutive numbers."""
    i = 0
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        yield hits[i], hits[j]
        i = j + 1


def _scan(least: int, merging: int, keep: bool):
    """Merge-scan of a batch's pieces with those of all levels; levels from ``merging`` on
    become one level together with the batch."""
    names = ["chunk", "part", "anchors", "sizes", "strings", "found"]
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]

    def scanned(key: tuple, table: pa.Table) -> pa.Table:
        part, entries = key[0].as_py(), []
        for level, _, chunk, docs, starts, *array in zip(*(c.to_pylist() for c in table.columns)):
            strings = _entries(*array)
            if level >= 0:
                entries += [(*s, None, 0, 0, level) for s in strings]
            else:
                entries += [(*s, d, chunk, at, None) for s, d, at in zip(
                    strings, docs, _values(starts, "<i8").tolist())]
        entries.sort(key=lambda e: e[:2])  # sorted arrays: a merge
        found: dict[int, list] = {}
        merged = []
        for _, group in groupby(entries, key=lambda e: e[0][:HEAD]):
            group = list(group)
            kept = [e for e in group if e[5] is not None and e[5] >= merging] if keep else []
            for hit in _scan_group(group, least):
                if hit[0] is not None:
                    found.setdefault(hit[0], []).extend(hit[1:])
                elif keep:
                    kept.append(hit[1])
            kept.sort(key=lambda e: e[:2])
            merged += [e for i, e in enumerate(kept) if i == 0 or e[:2] != kept[i - 1][:2]]
        out = [(c, part, None, None, None, _planes(np.array(v, "<i8"))) for c, v in found.items()]
        if merged:
            out.append((-1, part, *_array(merged), None))
        columns = zip(*out) if out else [[]] * len(names)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return scanned


@dataclass
class Family:
    """Levels of suffix arrays: tables of pieces, oldest and largest first, with their sizes
    in batches.  ``groups`` is the number of pieces, fixed for all levels."""

    groups: int
    least: int = 50
    levels: list[tuple[int, DataFrame]] = field(default_factory=list)

    def take(self, pieces: DataFrame, *, keep: bool = True) -> DataFrame:
        """Scan a batch of pieces, add it to the levels, return ``chunk, found``."""
        size, merging = 1, len(self.levels)
        while merging and self.levels[merging - 1][0] == size:
            merging -= 1
            size *= 2
        rows = pieces.select(
            F.lit(-1).alias("level"), "part", "chunk", "docs", "starts", "anchors", "sizes",
            "strings")
        docs_kind = pieces.schema["docs"].dataType.simpleString()
        for at, (_, table) in enumerate(self.levels):
            rows = rows.unionByName(table.select(
                F.lit(at).alias("level"), "part", F.lit(0).cast("long").alias("chunk"),
                F.lit(None).cast(docs_kind).alias("docs"),
                F.lit(None).cast("binary").alias("starts"), "anchors", "sizes", "strings"))
        scanned = stored(rows.groupBy("part").applyInArrow(
            _scan(self.least, merging, keep),
            "chunk long, part long, anchors binary, sizes binary, strings binary, found binary"),
            "suffix-level")
        if keep:
            level = scanned.where("chunk < 0").select("part", "anchors", "sizes", "strings")
            self.levels[merging:] = [(size, level)]
        return scanned.where("chunk >= 0").select("chunk", "found")


def _borders(docs: DataFrame, batches: int) -> list:
    """Ids that end a batch, from a bounded sample of ids chosen by their hashes."""
    n = docs.count()
    step = -(-n // (BOUNDARIES // 2)) if n > BOUNDARIES // 2 else 1
    some = docs.where("doc_id IS NOT NULL").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("doc_id").limit(BOUNDARIES)
    found = sorted(r[0] for r in some.collect())
    return sorted({found[len(found) * i // batches] for i in range(1, batches)}) if found else []


def _cut(least: int, kind: pa.DataType):
    """Texts of chunks without the windows found."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def rows(batches):
        for batch in batches:
            for _, ids, ends, body, found in _opened(batch):
                edge = np.zeros(len(body) + 1, np.int32)
                for f in found or []:
                    windows = _values(f, "<i8").reshape(-1, 2)
                    np.add.at(edge, windows[:, 0], 1)
                    np.add.at(edge, windows[:, 1] + least, -1)
                gone = np.cumsum(edge[:-1]) > 0
                plain = np.frombuffer(body, np.uint8)
                spans, kept, start = [], [], 0
                for end in ends.tolist():
                    own = gone[start:end]
                    turns = np.flatnonzero(np.diff(own, prepend=False, append=False))
                    spans.append([{"start": int(a), "stop": int(b)}
                                  for a, b in turns.reshape(-1, 2)])
                    kept.append(plain[start:end][~own].tobytes() if len(turns)
                                else body[start:end])
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, kind), pa.array(np.diff(ends, prepend=0), pa.int64()),
                     pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return rows


def _arrow_kind(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _result(chunks: DataFrame, found: DataFrame, least: int) -> DataFrame:
    by_chunk = found.groupBy("chunk").agg(F.collect_list("found").alias("found"))
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    arrow = _arrow_kind(chunks.select(F.explode("ids").alias("i")), "i")
    return chunks.join(by_chunk, "chunk", "left").mapInArrow(
        _cut(least, arrow),
        f"doc_id {kind}, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")


def _chunks(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(rows.mapInArrow(
        _chunk, f"chunk long, ids array<{kind}>, ends array<long>, body binary"), "texts")


def _piece_schema(chunks: DataFrame) -> str:
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    return (f"batch int, part long, chunk long, docs array<{kind}>, starts binary, "
            "anchors binary, sizes binary, strings binary, found binary")


def _checked(least: int) -> None:
    if least < HEAD + 8:
        raise ValueError(f"least must be {HEAD + 8} bytes or more")


def remove_repeats(
    docs: DataFrame, *, least: int = 50, batches: int = 4, id_column: str = "doc_id",
    text_column: str = "text", hot: int = HOT,
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, spans, kept``, without what smaller ids already say.

    Texts are UTF-8 bytes.  ``spans`` are the byte ranges removed (maximal, ``stop`` behind the
    last byte); ``kept`` is the rest, joined; a cut may divide a character.  Whether a string
    repeats is judged on the input, not on what is left.

    A null text is empty; texts below ``least`` bytes are kept.  A null id is after all
    others, and rows with equal or null ids take nothing from each other.  Other columns are
    ignored, repeated rows give repeated results, an empty table gives an empty one.
    """
    _checked(least)
    chunks = _chunks(docs, id_column, text_column)
    total = chunks.agg(F.sum(F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0)))).first()[0] or 0
    groups = max(1, -(-int(total) * 2 // ((least - HEAD + 2) * HEADS)))
    heads = chunks.mapInArrow(
        _heads(least, groups), "part long, chunk long, heads binary, times binary")
    marks = stored(heads.groupBy("part").applyInPandas(
        _company(hot), "chunk long, part long, marks binary"), "suffix-heads")
    by_chunk = marks.groupBy("chunk").agg(F.collect_list(F.struct("part", "marks")).alias("marks"))
    family = Family(max(1, -(-int(total) // PIECE)), least)
    borders = _borders(docs.select(F.col(id_column).alias("doc_id")), batches)
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    arrow = _arrow_kind(chunks.select(F.explode("ids").alias("i")), "i")
    pieces = stored(chunks.join(by_chunk, "chunk", "left").mapInArrow(
        _strings(least, family.groups, borders, arrow, False), _piece_schema(chunks)),
        "suffix-pieces")
    found = pieces.where("batch < 0").select("chunk", "found")
    for batch in range(len(borders) + 1):
        found = found.unionByName(family.take(
            pieces.where(F.col("batch") == batch), keep=batch < len(borders)))
    return _result(chunks, found, least)


def add_batch(
    family: Family, docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """The rows of a new batch without what the family, or a smaller id of the batch, has.

    The batch then belongs to the family, and its ids count as larger than all before.  Result
    and odd cases are those of ``remove_repeats``.
    """
    _checked(family.least)
    chunks = _chunks(docs, id_column, text_column)
    arrow = _arrow_kind(chunks.select(F.explode("ids").alias("i")), "i")
    pieces = stored(chunks.mapInArrow(
        _strings(family.least, family.groups, [], arrow, True), _piece_schema(chunks)),
        "suffix-pieces")
    found = pieces.where("batch < 0").select("chunk", "found").unionByName(
        family.take(pieces.where("batch >= 0")))
    return _result(chunks, found, family.least)
