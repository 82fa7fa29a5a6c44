"""Token ids of whole texts, as the ``tokenizers`` library gives them, with a memory.

A text is cut at single spaces between two visible characters.  No pre-token of the
byte-level pattern, and none of the word pattern, reaches over such a space (it can
only begin with it), so the ids of a text are those of its chunks, one after the other.
The chunks repeat, so their values are remembered; only new ones go to the library.
Texts with characters outside a plain set, or with a special token's string, are
given to the library whole.

``IdMemory`` cuts the texts of a batch as one array: before any white space that stands
alone between two visible characters, and before a mark (no apostrophe) that follows a
letter, for no pre-token holds both.  It looks up each different chunk of the batch once.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: ASCII and the letters of Latin-1: composed, and lower-cased one by one.
PLAIN = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(192, 215), *range(216, 247),
                          *range(248, 256)])).encode("latin-1")
BESIDE = [a + b for a in " \t\n\r" for b in " \t\n\r" if " " in a + b]
MEMORY = 600_000  # chunks remembered by a worker; then only those met again are kept
IDS = 1_000_000  # chunks whose ids a worker remembers, of some 55 bytes each
LONG = 64  # characters of a chunk that is not remembered: this bounds the memory's bytes
TOGETHER = 512  # new chunks that the library is given as one text
BLANK, LETTER, MARK = 0, 1, 2  # kinds of plain characters; digits and apostrophes are none
KINDS = np.full(256, 3, np.uint8)
KINDS[[c for c in PLAIN if chr(c).isalpha()]] = LETTER
KINDS[[c for c in PLAIN if c < 127 and not chr(c).isalnum() and chr(c) != "'"]] = MARK
KINDS[[9, 10, 13, 32]] = BLANK


@functools.lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def special_strings(path: str) -> tuple[str, ...]:
    with open(path, encoding="utf-8") as f:
        return tuple(t["content"] for t in json.load(f)["added_tokens"])


class Chunks(dict):
    """Values of chunks; ``know`` works out many new ones at once.

    A word with a full stop or comma at its end is the word, then the mark: no pre-token
    holds both, so its value is made of theirs.
    """

    def __init__(self, learn: Callable[[list[str]], list], most: int = MEMORY):
        super().__init__()
        self.learn, self.most, self.again, self.long = learn, most, set(), []

    def know(self, chunks: set[str]) -> None:
        for c in self.long:
            self.pop(c, None)
        new = [c for c in chunks if c not in self]
        known = chunks.difference(new)
        if len(self) + len(new) > self.most:
            if len(self.again) > self.most // 2:
                self.again.clear()
            keep = {c: self[c] for c in self.again | known if c in self}
            self.clear()
            self.update(keep)
        self.again |= known
        plain, ended = [], []
        for c in new:
            if c[-1:] in (".", ",") and c[:-1].isalpha():
                ended.append(c)
            else:
                plain.append(c)
        plain += {w for w in [c[:-1] for c in ended] if w not in self}.difference(plain)
        self.update(zip(plain, self.learn(plain)))
        for c in ended:
            self[c] = self[c[:-1]] + self.marks[c[-1]]
        self.long = [c for c in plain if len(c) > LONG]

    @functools.cached_property
    def marks(self) -> dict:
        """Values of a mark that follows a letter (so without the space of a chunk)."""
        return dict(zip(".,", self.mark_values()))


class Memory:
    """Values of whole texts, joined from those of their chunks.

    ``learn`` gives the values of strings, ``join`` makes one of the values in order,
    ``whole`` is the value of a text that must not be cut.
    """

    def __init__(self, path: str, learn, join, whole, most: int = MEMORY):
        self.special = special_strings(path)
        self.first = Chunks(learn, most)
        self.later = Chunks(lambda chunks: learn([" " + c for c in chunks]), most)
        self.first.mark_values = self.later.mark_values = lambda: learn([".", ","])
        self.join, self.whole = join, whole

    def cut(self, text: str) -> list[str] | None:
        """The chunks of a text, or None if it must not be cut."""
        try:
            if text.encode("latin-1").translate(None, PLAIN):
                return None
        except UnicodeEncodeError:
            return None
        if any(s in text for s in self.special):
            return None
        pieces = text.split(" ")
        if text[:1] == " " or text[-1:] == " " or any(b in text for b in BESIDE):
            return _rejoined(pieces)
        return pieces

    def values(self, texts: list[str]) -> list:
        pieces = [self.cut(t) for t in texts]
        cut = [p for p in pieces if p]
        self.first.know({p[0] for p in cut})
        self.later.know(set().union(*cut))
        first, get, join = self.first, self.later.__getitem__, self.join
        return [
            self.whole(t) if p is None else join(first[p[0]], map(get, p[1:]))
            for t, p in zip(texts, pieces)
        ]


def _rejoined(pieces: list[str]) -> list[str]:
    """Pieces put together again where the space between them is not between visible ones."""
    out = [pieces[0]]
    for p in pieces[1:]:
        if p[:1].strip() and out[-1][-1:].strip():
            out.append(p)
        else:
            out[-1] += " " + p
    return out


def _token_bytes(tok, path: str) -> tuple[np.ndarray, bool] | None:
    """How many bytes of text each id stands for, and whether white space counts; None
    where that cannot be told."""
    with open(path, encoding="utf-8") as f:
        mark = json.load(f)["model"].get("end_of_word_suffix") or ""
    vocabulary = tok.get_vocab()
    sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, i in vocabulary.items():
        sizes[i] = len(token.removesuffix(mark) if mark else token)
    total = int(sizes[tok.encode(" a b", add_special_tokens=False).ids].sum())
    return (sizes, total == 4) if total in (2, 4) else None


LOWER = bytes(32 if KINDS[i] == BLANK else ord(chr(i).lower()) if i in PLAIN else i
              for i in range(256))


@functools.lru_cache(maxsize=2)
def _even(path: str):
    """The library without the file's normalizers, for plain text in lower case whose white
    space is all spaces; None where these do more than that or white space has ids."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    given = rules["normalizer"] or {}
    steps = given.get("normalizers", [given])
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    if not all(x == spaces or x.get("type") in ("NFC", "Lowercase") for x in steps):
        return None
    known = _token_bytes(library(path), path)
    if {"type": "Lowercase"} not in steps or not known or known[1]:
        return None
    rules["normalizer"] = None
    return Tokenizer.from_str(json.dumps(rules))


def _slices(data: bytes, ends: list[int]) -> list[bytes]:
    return [data[a:b] for a, b in zip(ends, ends[1:])]


class Recent:
    """Ids of chunks (in Latin-1), at most ``most`` of them and what the last batch had.

    Chunks and ids are two Arrow arrays, found by sorted hashes and then compared, which
    takes a quarter of the memory of Python objects.  When it is full, chunks that were not
    met again go, then those that were met longest ago, until half is left.
    """

    def __init__(self, most: int):
        self.most, self.turn = most, 0
        self.keys = self.ids = pa.array([], pa.large_binary())
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.born, self.met = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.factors = np.random.default_rng(1).integers(0, 1 << 64, LONG, np.uint64)

    def __len__(self) -> int:
        return len(self.keys)

    def __iter__(self) -> Iterator[bytes]:
        return iter(self.keys.to_pylist())

    def values(
        self, chunks: pa.LargeBinaryArray, learn: Callable[[list[bytes]], list]
    ) -> pa.LargeBinaryArray:
        """The ids of different chunks, none empty; ``learn`` gives those that are not held."""
        _, starts, letters = chunks.buffers()
        starts = np.frombuffer(starts, np.int64)[: len(chunks) + 1]
        sizes = np.diff(starts)
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)
        data = np.frombuffer(letters, np.uint8)[: starts[-1]]
        hashes = np.add.reduceat(
            data * self.factors.take(place, mode="clip"), starts[:-1])
        if len(self) + len(chunks) > self.most:
            self._forget()
        self.turn += 1
        at, free = np.zeros(len(chunks), np.int64), np.ones(len(chunks), bool)
        known = np.zeros(len(chunks), bool)
        if len(self):
            rank = np.argsort(hashes)  # in order they are found faster
            found = np.empty(len(chunks), np.int64)
            found[rank] = np.searchsorted(self.hashes, hashes[rank])
            np.minimum(found, len(self) - 1, out=found)
            free = self.hashes[found] != hashes
            at = self.order[found]
            known = pc.equal(self.keys.take(pa.array(at)), chunks).to_numpy(zero_copy_only=False)
            self.met[at[known]] = self.turn
        new = np.flatnonzero(~known)
        texts, limits = letters.to_pybytes(), (starts[new].tolist(), starts[new + 1].tolist())
        learned = pa.array(
            learn([texts[a:b] for a, b in zip(*limits)]) if len(new) else [], pa.large_binary())
        at[new] = len(self) + np.arange(len(new))
        values = pa.concat_arrays([self.ids, learned]).take(pa.array(at))
        kept = np.flatnonzero(free[new] & (sizes[new] <= LONG))
        hashes, where = hashes[new[kept]], len(self) + np.arange(len(kept))
        self.keys = pa.concat_arrays([self.keys, chunks.take(pa.array(new[kept]))])
        self.ids = pa.concat_arrays([self.ids, learned.take(pa.array(kept))])
        turns = np.full(len(kept), self.turn, np.int32)
        self.born, self.met = np.append(self.born, turns), np.append(self.met, turns)
        rank = np.argsort(hashes)
        into = np.searchsorted(self.hashes, hashes[rank])
        self.hashes = np.insert(self.hashes, into, hashes[rank])
        self.order = np.insert(self.order, into, where[rank])
        return values

    def _forget(self) -> None:
        keep = self.met > self.born
        half = self.most // 2
        if np.count_nonzero(keep) > half:
            keep[np.argsort(np.where(keep, self.met, 0), kind="stable")[: len(keep) - half]] = False
        place, held = np.cumsum(keep) - 1, keep[self.order]
        self.hashes, self.order = self.hashes[held], place[self.order[held]]
        self.keys, self.ids = (x.filter(pa.array(keep)) for x in (self.keys, self.ids))
        self.born, self.met = self.born[keep], self.met[keep]


class IdMemory:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    ``fold``: where the file's normalizers lower-case, chunks that differ only in case or in
    the kind of white space are held as one, and the library gets them lower-cased.
    """

    def __init__(self, path: str, most: int, fold: bool = False):
        self.tok, self.special = library(path), special_strings(path)
        self.known = _token_bytes(self.tok, path)
        self.even = _even(path) if fold else None
        self.later = Recent(most)
        # bytes of UTF-8 that a character's ids stand for
        self.weight = np.where(np.arange(256) < 128, 1, 2)
        if self.known and not self.known[1]:
            self.weight[KINDS == BLANK] = 0

    def plain(self, text: str) -> bytes | None:
        """The text in Latin-1, or None if it must not be cut."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if data.translate(None, PLAIN) or any(s in text for s in self.special):
            return None
        return data

    def values(self, texts: list[str]) -> list[bytes]:
        plain = [self.plain(t) for t in texts]
        cut = [p for p in plain if p]
        own = iter(self._joined(cut) if cut else ())
        return [
            self._whole(t) if p is None else next(own) if p else b""
            for t, p in zip(texts, plain)
        ]

    def _joined(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that are not empty and may be cut."""
        data = b"".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        kinds = np.frombuffer(data.translate(KINDS.tobytes()), np.uint8)
        blank = kinds == BLANK
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-2] = blank[1:-1] & ~(blank[:-2] | blank[2:])
        cut[1:-1] |= (kinds[1:] == MARK) & (kinds[:-1] == LETTER)
        cut[ends[blank[ends - 1]] - 1] = False  # white space at the end of a text
        cut[0] = True
        cut[ends] = True
        at = np.flatnonzero(cut)
        if self.even:
            data = data.translate(LOWER)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]
        ).dictionary_encode()
        values = self.later.values(chunks.dictionary, self._learn)
        ids = values.take(chunks.indices)
        _, reached, data = ids.buffers()
        reached = np.frombuffer(reached, np.int64)[np.searchsorted(at, ends)].tolist()
        return _slices(data.to_pybytes() if data else b"", [0, *reached])

    def _whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks.  Those with white space before and none behind are put together to
        texts of many: a call for each costs more than its ids.  Where a chunk ends follows
        from the bytes its ids stand for."""
        out: list = [None] * len(chunks)
        open_ = [i for i, c in enumerate(chunks)
                 if self.known and c[0] in b" \t\n\r" and c[-1] not in b" \t\n\r"]
        for i in range(0, len(open_), TOGETHER):
            some = open_[i : i + TOGETHER]
            for k, ids in zip(some, self._together([chunks[k] for k in some])):
                out[k] = ids
        alone = [k for k, ids in enumerate(out) if ids is None]
        found = (self.even or self.tok).encode_batch_fast(
            [chunks[k].decode("latin-1") for k in alone], add_special_tokens=False)
        for k, e in zip(alone, found):
            out[k] = array("I", e.ids).tobytes()
        return out

    def _together(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that are one text; none if their ends are not ends of ids."""
        data = b"".join(chunks)
        ids = np.array((self.even or self.tok).encode_batch_fast(
            [data.decode("latin-1")], add_special_tokens=False)[0].ids, np.int64)
        ends = np.cumsum(self.weight[np.frombuffer(data, np.uint8)])[
            np.cumsum([len(c) for c in chunks]) - 1]
        reached = np.cumsum(self.known[0][ids])
        at = np.searchsorted(reached, ends)
        if not len(ids) or reached[-1] != ends[-1] or (reached[at] != ends).any():
            return []
        return _slices(ids.astype("<u4").tobytes(), [0, *(4 * (at + 1)).tolist()])


@functools.lru_cache(maxsize=2)
def id_memory(path: str, most: int = IDS, fold: bool = False) -> IdMemory:
    """Ids of texts as little-endian unsigned 32-bit integers; one memory per worker, of about
    ``most`` chunks.  Fewer take less memory and more time; the ids are the same."""
    return IdMemory(path, most, fold)
