"""Spelling variants of the words of a corpus, found by k-d trees over letter counts.

Words that differ by one edit have nearly the same letters: a replaced letter takes one away
and adds one, an inserted letter adds one.  So words are points, one dimension a letter, and
near words lie within an L1 distance of two.  For each word length there is a k-d tree.  Its
upper part, the *forest*, is fitted on a bounded sample and deals the words out to leaves: a
word is stored in one leaf and asks every leaf whose box it can reach with one letter
more and one less (own length), or with one letter more (length plus one).  In a leaf a tree of
its own goes on to buckets of some words, pruned by the same boxes.  What is left is compared by
a mask of its letters and then letter by letter, so every pair found is one edit apart, and none is
missed.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.llm.common import byte_texts, parts, ship, stored, text_or_empty

#: Latin-1 letters from U+00C0 on stay, A-Z lower-cased; every other character parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32
              for b in range(256))
#: The dimension of each letter; others do not occur in words.
LETTERS = [*range(97, 123), *range(192, 256)]
_PLACE = np.zeros(256, np.int64)
_PLACE[LETTERS] = np.arange(len(LETTERS))
#: Bits of a mask of 64, for a first comparison: a to z once, a to z twice, and the others,
#: which share 12.  A letter more or less changes one bit at most.
_ONCE, _TWICE = (np.uint64(1) << (np.arange(26, dtype=np.uint64) + np.uint64(i)) for i in (0, 26))
_ONCE = np.concatenate([_ONCE, np.uint64(1) << (
    np.uint64(52) + np.arange(len(LETTERS) - 26, dtype=np.uint64) % np.uint64(12))])

HELD = 1_000_000  # words a task counts before it passes them on
SAMPLE = 100_000  # words the forest is fitted on, at most
BUCKET = 24  # points of a lowest node
PAIRS = 1 << 21  # candidates looked at together


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def misspelled(doc_id: str, words: set[bytes], every: int) -> list[tuple[bytes, bytes]]:
    """Words of a text whose hash of id and word is a multiple of ``every``, each with what is
    left of it when it loses the letter that the hash names."""
    if not every:
        return []
    start, crc32 = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32
    hit = [(w, h) for w in words
           if not (h := crc32(w if w.isascii() else _utf8(w), start)) % every]
    return [(w, w[: h % len(w)] + w[h % len(w) + 1 :]) for w, h in hit]


def word_counts(
    docs: DataFrame, *, least_letters: int = 5, least_count: int = 3, every: int = 97
) -> DataFrame:
    """``word, n`` of words with enough letters and occurrences."""
    ship(docs.sparkSession)

    def counted(batches):
        held: Counter = Counter()

        def flush():
            words = [w for w, n in held.items() if n and len(w) >= least_letters]
            for i in range(0, len(words), 50_000):
                some = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_utf8(w) for w in some], pa.binary()).cast(pa.string()),
                     pa.array([held[w] for w in some], pa.int64())], ["word", "n"])
            held.clear()

        for batch in batches:
            for part in parts([batch], "text"):
                for name, text in zip(part.column(0).to_pylist(), byte_texts(part, "text")):
                    letters = text.decode("utf-8", "replace").encode("latin-1", "replace")
                    words = letters.translate(_FOLD).split()
                    held.update(words)
                    for word, left in misspelled(name, set(words), every):
                        n = words.count(word)
                        held[word] -= n
                        held[left] += n
                if len(held) >= HELD:
                    yield from flush()
        yield from flush()

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    found = docs.select(name, text_or_empty().alias("text")).mapInArrow(
        counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letters_of(words: list[bytes]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Letter counts, a row a word and a column a letter."""
    n = len(letters)
    at = _PLACE[letters] + (np.arange(n) * len(LETTERS))[:, None]
    found = np.bincount(at.ravel(), minlength=n * len(LETTERS)).reshape(n, -1)
    return found.astype(np.int16 if letters.shape[1] < 1 << 15 else np.int32)


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and bound that halve the points best (at most the bound; more); None if all
    are equal."""
    n, best = len(counts), None
    for bound in range(int(counts.max(initial=0))):
        left = (counts <= bound).sum(axis=0)
        skew = np.abs(2 * left - n)
        at = int(skew.argmin())
        if skew[at] < n and (best is None or skew[at] < best[0]):
            best = int(skew[at]), at, bound
        if best and (best[0] * 4 < n or bound >= 3):
            break
    return best and best[1:]


@dataclass
class Node:
    """A box of a k-d tree: least and most of the letters that were split on the way."""

    low: dict[int, int]
    high: dict[int, int]
    split: tuple[int, int] | None = None
    left: "Node | None" = None
    right: "Node | None" = None
    leaf: int = -1
    points: np.ndarray | None = None


def grow(counts: np.ndarray, most: int, low=None, high=None, rows=None) -> Node:
    """A k-d tree whose lowest boxes hold ``most`` rows, or equal ones."""
    rows = np.arange(len(counts)) if rows is None else rows
    node = Node(low or {}, high or {})
    node.split = best_split(counts[rows]) if len(rows) > most else None
    if node.split is None:
        node.points = rows
        return node
    letter, bound = node.split
    at_most = counts[rows, letter] <= bound
    node.left = grow(counts, most, node.low, {**node.high, letter: bound}, rows[at_most])
    node.right = grow(counts, most, {**node.low, letter: bound + 1}, node.high, rows[~at_most])
    return node


def visits(tree: Node, counts: np.ndarray, more: int, less: int):
    """The lowest boxes that rows reach with so many letters more and less, each with those rows.

    A row carries the letters that it lacks for the box, and those that it has too many; a
    split changes one bound, so it adds what its own letter is further out than before."""
    columns = np.ascontiguousarray(counts.T)
    none = np.zeros(len(counts), counts.dtype)
    stack = [(tree, np.arange(len(counts)), none, none)]
    while stack:
        node, rows, lack, over = stack.pop()
        if not len(rows):
            continue
        if node.split is None:
            yield node, rows
            continue
        letter, bound = node.split
        of = columns[letter][rows]
        gone = over + np.maximum(of - bound, 0)
        if letter in node.high:
            gone -= np.maximum(of - node.high[letter], 0)
        come = lack + np.maximum(bound + 1 - of, 0)
        if letter in node.low:
            come -= np.maximum(node.low[letter] - of, 0)
        left, right = np.flatnonzero(gone <= less), np.flatnonzero(come <= more)
        stack += [(node.left, rows[left], lack[left], gone[left]),
                  (node.right, rows[right], come[right], over[right])]


def home(tree: Node, counts: np.ndarray) -> np.ndarray:
    """The leaf that holds each row."""
    out = np.zeros(len(counts), np.int64)
    for node, rows in visits(tree, counts, 0, 0):
        out[rows] = node.leaf
    return out


def room(length: int) -> int:
    """Words of this length that a group holds: 16,384, or about 4 MB."""
    return max(BUCKET, min(1 << 14, (4 << 20) // length))


def fit_forest(words: DataFrame) -> dict[int, Node]:
    """A tree for each word length, from at most ``SAMPLE`` of ``word, n, length``.

    Words are chosen by their hash, so reruns agree.  A sample that misleads makes leaves
    uneven, which costs time and no pairs: leaves above their room are cut into blocks.
    """
    sizes = {r.length: r["count"] for r in words.groupBy("length").count().collect()}
    total, leaves, forest = sum(sizes.values()), 0, {}
    step = -(-total // (SAMPLE // 2)) if total > SAMPLE // 2 else 1
    bounded = F.substring("word", 1, 1 << 12)  # words of many kilobytes: their heads
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(step)) == 0).select(
        bounded.alias("word"), "length").limit(SAMPLE).collect() if total else []
    by_length: dict[int, list[bytes]] = {}
    for r in chosen:
        by_length.setdefault(r.length, []).append(r.word.encode("latin-1"))
    for length, n in sorted(sizes.items()):
        some = by_length.get(length, [])
        if some:
            counts = counts_of(letters_of(some))
            tree = grow(counts, max(BUCKET, room(length) * len(some) // n))
        else:
            tree = Node({}, {})
        stack = [tree]
        while stack:
            node = stack.pop()
            if node.split is None:
                node.leaf, node.points, leaves = leaves, None, leaves + 1
            else:
                stack += [node.left, node.right]
        forest[length] = tree
    return forest


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one edit; rows of ``b`` are as long or one longer."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def masks(counts: np.ndarray) -> np.ndarray:
    """A mask for each row of letter counts."""
    out = np.zeros(len(counts), np.uint64)
    for at, bit in enumerate(_ONCE):
        out |= np.where(counts[:, at] > 0, bit, np.uint64(0))
    for at, bit in enumerate(_TWICE):
        out |= np.where(counts[:, at] > 1, bit, np.uint64(0))
    return out


def near_pairs(queries: list[bytes], points: list[bytes], tree: Node | None = None):
    """Index pairs of queries and points that are one edit apart; queries have one length,
    points one length, the same or one more.  ``tree``: the points', if it is there already."""
    q, p = letters_of(queries), letters_of(points)
    more, less = 1, int(q.shape[1] == p.shape[1])
    qc, pc = counts_of(q), counts_of(p)
    qm, pm = masks(qc), masks(pc)
    found = [np.zeros((0, 2), np.int64)]
    step = max(1, PAIRS // max(q.shape[1], len(LETTERS)))
    for node, rows in visits(tree or grow(pc, BUCKET), qc, more, less):
        some = node.points
        for i in range(0, len(rows), max(1, PAIRS // len(some))):
            asked = rows[i : i + max(1, PAIRS // len(some))]
            close = np.bitwise_count(qm[asked][:, None] ^ pm[some][None, :]) <= more + less
            at, to = np.divmod(np.flatnonzero(close), len(some))
            for j in range(0, len(at), step):
                a, b = asked[at[j : j + step]], some[to[j : j + step]]
                if q.shape[1] > len(LETTERS):  # else the letters are less work than the counts
                    gap = pc[b] - qc[a]
                    ok = (np.maximum(gap, 0).sum(axis=1) <= more) & (
                        np.maximum(-gap, 0).sum(axis=1) <= less)
                    a, b = a[ok], b[ok]
                ok = one_edit(q[a], p[b])
                found.append(np.stack([a[ok], b[ok]], axis=1))
    return np.concatenate(found)


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n`` for every ordered pair of ``word, n`` that is one edit apart."""
    words = words.withColumn("length", F.char_length("word"))
    forest = fit_forest(words)

    def by_length(pdf):
        for length, rows in pdf.groupby("length", sort=False):
            found = rows.word.str.encode("latin-1").tolist()
            step = max(1, PAIRS // max(int(length), len(LETTERS)))
            for i in range(0, len(found), step):
                yield int(length), rows.iloc[i : i + step], counts_of(
                    letters_of(found[i : i + step]))

    def stand(frames):
        for pdf in frames:
            for length, rows, counts in by_length(pdf):
                yield rows.assign(leaf=home(forest[length], counts))[["leaf", "word", "n"]]

    def ask(frames):
        for pdf in frames:
            for length, rows, counts in by_length(pdf):
                for other, less in ((length, 1), (length + 1, 0)):
                    if other in forest:
                        for node, at in visits(forest[other], counts, 1, less):
                            yield rows.iloc[at].assign(leaf=node.leaf)[["leaf", "word", "n"]]

    schema = "leaf long, word string, n long"
    points = stored(words.mapInPandas(stand, schema), "points")
    asking = stored(words.mapInPandas(ask, schema), "asking")
    # a leaf above its room is cut into blocks of points, and so are those that ask it
    held = F.expr(f"greatest({BUCKET}, least({1 << 14}, {4 << 20} div max(char_length(word))))")
    n_of = lambda df, name: df.groupBy("leaf").agg(
        F.ceil(F.count("*") / held).cast("int").alias(name))
    cuts = n_of(points, "blocks").join(n_of(asking, "shares"), "leaf")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    stood = points.join(cuts, "leaf").withColumn("block", one("blocks")).withColumn(
        "share", every("shares"))
    asked = asking.join(cuts, "leaf").withColumn("share", one("shares")).withColumn(
        "block", every("blocks"))
    key = ["leaf", "block", "share"]
    columns = [*key, "word", "n"]

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            target = left.word.str.encode("latin-1").tolist()
            tree = grow(counts_of(letters_of(target)), BUCKET)
            for length, rows in right.groupby(right.word.str.len()):
                pairs = near_pairs(rows.word.str.encode("latin-1").tolist(), target, tree)
                a, b = rows.iloc[pairs[:, 0]], left.iloc[pairs[:, 1]]
                out.append(pd.DataFrame({
                    "word": a.word.values, "near": b.word.values, "near_n": b.n.values}))
                if length < len(target[0]):  # the other way, which no query asks
                    out.append(pd.DataFrame({
                        "word": b.word.values, "near": a.word.values, "near_n": a.n.values}))
        return pd.concat(out) if out else pd.DataFrame({"word": [], "near": [], "near_n": []})

    return (
        stood.select(columns).groupBy(*key).cogroup(asked.select(columns).groupBy(*key))
        .applyInPandas(compare, "word string, near string, near_n long"))


def roots(edges: DataFrame) -> DataFrame:
    """``word, root``: where following ``word, form`` ends.  Each round doubles the steps
    taken; forms at least double in count, so some six rounds reach the end."""
    at = edges.select("word", F.col("form").alias("root"))
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stored(at.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def spelling_variants(
    docs: DataFrame, *, least_letters: int = 5, least_count: int = 3, every: int = 97,
    ratio: int = 2,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with enough letters and counts.

    Words are runs of ASCII and Latin-1 letters, A-Z lower-cased.  With ``every``, a word of
    a document is misspelled (one letter deleted) where the crc32 of ``<doc_id>:<word>`` is a
    multiple of it; 0 leaves words as they are.  Near words are one insertion, deletion or
    replacement apart.  A word's form is its near word with the largest count, the first by
    code points of equal ones, if that count is ``ratio`` (2 at least) times its own; its root
    is the end of the chain of forms.

    A null or empty text has no words; a null id counts as an empty one; repeated rows count
    each time; other columns are ignored; an empty table gives an empty result.  Texts are read
    whole; words of many kilobytes are words like others.
    """
    if ratio < 2:
        raise ValueError("forms could go round in circles: ratio must be 2 or more")
    words = stored(word_counts(
        docs, least_letters=least_letters, least_count=least_count, every=every), "words")
    pairs = near_words(words)
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    takes = -F.col("best.m") >= ratio * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", F.when(takes, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(takes, -F.col("best.m")).alias("form_n")), "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
