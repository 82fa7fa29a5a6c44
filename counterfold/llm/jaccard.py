"""Exact n-gram Jaccard join with a token-group matrix.

Tokens are 48-bit hashes of word shingles, so that two sets of a thousand tokens each
have a chance below one in a hundred million to share one by accident.

1. Every document becomes its sorted set of tokens.  Equal sets are one *set* from then on.
2. Similar sets are partitioned into *groups*: sets with the same two least tokens (under
   two orders) are cut into chunks by hash, and each chunk is compared within itself
   and with a few *centres* that all chunks of the key share.  Sets that links join form
   a group, linked as a whole, named by its centre, so it may have many chunks.  Sets of a
   chunk that link nothing there but are similar to others of it form a *loose* group.  All
   other sets are groups of one.
3. The matrix has a row (token, chunk) for each token of the union of a chunk's prefixes.  A
   prefix is so long that two sets that link must share a token in both prefixes, under any
   order of tokens that is the same for all.  The order puts tokens of many documents last,
   so common passages hardly ever stand in a prefix.
4. A set that meets a chunk of a larger group in the matrix is a query.  Its overlap with
   the union of all the chunk's tokens bounds that with each member; only chunks whose
   bound allows a link are opened and compared member by member, exactly.  A coarser bound
   goes first, as it needs few bytes: tokens are counted in ``CELLS`` cells (a chunk has the
   most of its members), and an overlap is at most the sum of the lesser counts.
5. Links between groups, and inside them, make the components.

Nothing is collected but one number per power of two and a bitmap of fixed size.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import (
    byte_texts, give_back, parts, ship, shuffle_width, stored, unlike)

BITS = 23  # of the bitmaps that tell common tokens, and wanted sets: one megabyte
CHUNK = 256  # sets compared with each other at once, and the queries a chunk gets at once
CHUNK_TOKENS = 400_000  # of a chunk, where it has two sets or more
CENTRES = 16
CELLS = 512
SEED = 20_011


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.atleast_1d(x)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _constants():
    rng = np.random.default_rng(SEED)
    full = lambda n: rng.integers(1, 2**64, n, dtype=np.uint64) | np.uint64(1)
    base = int(full(1)[0])
    powers = np.full(1 << 16, base, np.uint64)
    powers[0] = 1
    return full(256), base, np.multiply.accumulate(powers), full(64)


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text (A-Z already lower-cased)."""
    table, base, powers, _ = _constants()
    if not text:
        return np.zeros(0, np.uint64)
    b = np.frombuffer(text, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    first, end = edge[::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.uint64)
    # sum of table[byte] * base**(place in text), per word, then divided by base**first
    if len(b) > len(powers):
        far = np.full(len(b), base, np.uint64)
        far[0] = 1
        powers = np.multiply.accumulate(far)
    value = np.where(space, np.uint64(0), table[b] * powers[: len(b)])
    sums = np.add.reduceat(value, first)
    inverse = np.uint64(pow(base, -1, 1 << 64))
    back = _powers(int(inverse), int(first[-1]) + 1)
    return _mix(sums * back[first] + (end - first).astype(np.uint64))


_back: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _back.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if len(held) <= 1 << 21:
            _back[base] = held
    return held


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct tokens: ``size`` words each, or all words if there are fewer."""
    words = word_hashes(text.lower())
    if not len(words):
        return words
    odd = _constants()[3]
    n = min(size, len(words))
    token = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        token = token * odd[i] + words[i : len(words) - n + 1 + i]
    return np.unique(_mix(token) >> np.uint64(16))


def packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _need(n, percent: int):
    """The least overlap of a set of ``n`` tokens with any set it links to."""
    return -(-n * percent // 100)


def _met(tokens: np.ndarray, union: np.ndarray) -> int:
    """How many of the tokens are in the sorted union."""
    at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
    return int((union[at] == tokens).sum())


def cells(tokens: np.ndarray) -> bytes:
    """Tokens counted by cell; 255 stands for any higher count."""
    at = (tokens >> np.uint64(8)).astype(np.int64) % CELLS
    return np.minimum(np.bincount(at, minlength=CELLS), 255).astype(np.uint8).tobytes()


def may_link(n: int, mine: bytes, most: bytes, percent: int) -> bool:
    """Whether a set of ``n`` tokens may link to one whose cells are ``most`` at most."""
    a, b = np.frombuffer(mine, np.uint8), np.frombuffer(most, np.uint8)
    both = np.minimum(a, b).astype(np.int64)
    both[(a == 255) & (b == 255)] = n
    return bool(both.sum() >= _need(n, percent))


def overlaps(a: list[np.ndarray], b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` with sets ``b``, by products of blocks."""
    if len(a) == len(b) == 1:
        return np.array([[len(np.intersect1d(a[0], b[0], assume_unique=True))]])

    def places(sets, among):
        tokens = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(t) for t in sets])
        at = np.minimum(np.searchsorted(among, tokens), max(len(among) - 1, 0))
        hit = among[at] == tokens if len(among) else np.zeros(len(tokens), bool)
        order = np.argsort(at[hit], kind="stable")
        return row[hit][order], at[hit][order]

    if a is b:  # a token of one set alone adds nothing but to the diagonal
        token, count = np.unique(np.concatenate(a), return_counts=True)
        among = token[count > 1]
    else:
        among = np.intersect1d(np.concatenate(a), np.concatenate(b))
    (row_a, at_a), (row_b, at_b) = places(a, among), places(b, among)
    both = np.zeros((len(a), len(b)))
    for start in range(0, len(among), width):
        blocks = []
        for size, row, at in ((len(a), row_a, at_a), (len(b), row_b, at_b)):
            lo, hi = np.searchsorted(at, [start, start + width])
            block = np.zeros((size, min(width, len(among) - start)), np.float32)
            block[row[lo:hi], at[lo:hi] - start] = 1
            blocks.append(block)
        both += blocks[0] @ blocks[1].T
    return both.astype(np.int64)


def cluster(names: list[bytes], sets: list[np.ndarray], is_centre: list[bool], percent: int):
    """For sets of one chunk, each in one place: the root of its links, and whether it is loose.

    The root is the least centre that links reach inside the chunk, or else the least name.
    """
    n = np.array([len(t) for t in sets])
    both = overlaps(sets, sets)
    union = n[:, None] + n[None, :] - both
    np.fill_diagonal(both, 0)
    joined = 100 * both >= percent * union
    label = np.arange(len(sets))
    while True:  # labels go to neighbours, then to the label's own label
        near = np.where(joined, label[None, :], len(sets)).min(1, initial=len(sets))
        step = np.minimum(label, near)
        step = step[step]
        if (step == label).all():
            break
        label = step
    best: dict[int, tuple] = {}
    for i, of in enumerate(label):
        mine = (not is_centre[i], names[i])
        best[of] = min(best.get(of, mine), mine)
    alone = ~joined.any(1)
    loose = alone & (200 * both >= percent * union).any(1)
    return [best[of][1] for of in label], loose


def token_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, set_id, group_key, tokens`` per document; ``tokens``: see ``packed``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        other = np.uint64(0x9E3779B97F4A7C15)
        for batch in parts(batches, "text"):
            n, name, key, blob = [], [], [], []
            for text in byte_texts(batch, "text"):
                t = shingles(text, size)
                raw = packed(t)
                n.append(len(t))
                name.append(hashlib.blake2b(raw, digest_size=16).digest() if len(t) else None)
                key.append(int(_mix(t[:1] ^ _mix((t * other).min()))[0].astype(np.int64))
                           if len(t) else None)
                blob.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(name, pa.binary()),
                 pa.array(key, pa.int64()), pa.array(blob, pa.binary())],
                ["doc_id", "n", "set_id", "group_key", "tokens"])
        give_back()

    return docs.selectExpr("doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        rows, f"doc_id {kind}, n long, set_id binary, group_key long, tokens binary")


def common_tokens(sets: DataFrame, least: int) -> np.ndarray:
    """Bitmap of 2**BITS bits: those of tokens in ``least`` documents or more are set.

    Counts cover all documents, by the upper half of each token.  Tasks send sorted distinct
    tokens and their counts in ranges, so a token of all documents is one entry a task.  If
    more than a quarter of the bits were set, ``least`` is doubled until they are not.
    The bitmap only ranks tokens: the result of the join does not depend on it.
    """
    width = 4 * shuffle_width(sets)

    def ranges(batches):
        held, size = [], 0

        def send():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(token, (np.arange(1, width) << 32) // width)
            some = [(i, t, c) for i, (t, c) in enumerate(zip(
                np.split(token, cut), np.split(count.astype(np.uint32), cut))) if len(t)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in some], pa.int32()),
                    pa.array([_squeezed(t) for _, t, _ in some], pa.binary()),
                    # most counts are 1: only the others are sent
                    pa.array([np.flatnonzero(c > 1).astype(np.uint32).tobytes()
                              for _, _, c in some], pa.binary()),
                    pa.array([c[c > 1].tobytes() for _, _, c in some], pa.binary()),
                ], ["range", "token", "place", "count"])

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                t = (unpacked(raw) >> np.uint64(16)).astype(np.uint32)
                held.append(t)
                size += len(t)
                if size > 4_000_000:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()
        give_back()

    def often(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tokens = [_widened(t) for t in pdf["token"]]
        counts = []
        for t, p, c in zip(tokens, pdf["place"], pdf["count"]):
            n = np.ones(len(t), np.int64)
            n[np.frombuffer(p, np.uint32)] = np.frombuffer(c, np.uint32)
            counts.append(n)
        token, at = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        hot = total >= least
        return pd.DataFrame({"token": token[hot].astype(np.int64), "n": total[hot]})

    found = stored(
        sets.select("tokens").mapInArrow(
            ranges, "range int, token binary, place binary, count binary")
        .groupBy("range").applyInPandas(often, "token long, n long"), "common-tokens")
    by_size = found.groupBy(F.floor(F.log2(F.col("n") / least)).cast("int").alias("e")).count()
    sizes = {r["e"]: r["count"] for r in by_size.collect()}  # one row per power of two
    cut, total = 0, sum(sizes.values())
    while total > 1 << (BITS - 2):
        total -= sizes.get(cut, 0)
        cut += 1
    kept = found.where(F.col("n") >= least * 2**cut)
    return bitmap(kept.select(F.shiftright("token", 32 - BITS).alias("bit")))


def bitmap(bits: DataFrame) -> np.ndarray:
    """2**BITS bits as 32-bit words, those of the column ``bit`` set."""
    words = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 31 AS INT))")).alias("bits")).toPandas()
    found = np.zeros(1 << (BITS - 5), np.uint32)  # as many rows at most
    found[words.word.to_numpy(np.int64)] = words.bits.to_numpy(np.int64).astype(np.uint32)
    return found


def _bit(column: str):
    return F.pmod(F.xxhash64(column), F.lit(1 << BITS)).alias("bit")


def of_wanted(sets: DataFrame, wanted: DataFrame, any_row: bool = False) -> DataFrame:
    """Rows of ``sets`` whose ``doc_id`` may be a ``rep`` of ``wanted``: all that are, few more.

    A bitmap of fixed size thins out the rows before they are shuffled for an exact join.
    ``any_row``: one row of a set is enough, whichever; so a batch keeps one of each.
    """
    held = sets.sparkSession.sparkContext.broadcast(bitmap(wanted.select(_bit("rep"))))

    def thin(batches):
        for batch in batches:
            bit = np.asarray(batch.column(batch.num_columns - 1))
            hit = (held.value[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1
            batch = batch.filter(pa.array(hit == 1))
            if any_row:
                seen = set()
                batch = batch.filter(pa.array(
                    [not (x in seen or seen.add(x)) for x in batch.column("set_id").to_pylist()],
                    pa.bool_()))
            yield batch
        give_back()

    rows = sets.where("n > 0").withColumn("bit", _bit("doc_id"))
    return rows.mapInArrow(thin, rows.schema).drop("bit")


def _squeezed(t: np.ndarray) -> bytes:
    """Sorted distinct 32-bit numbers as compressed byte planes of their differences."""
    planes = np.diff(t, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def _widened(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u4").ravel(), dtype=np.uint32)


def _is_common(tokens: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bit = (tokens >> np.uint64(48 - BITS)).astype(np.int64)
    return (bits[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1


def prefix(tokens: np.ndarray, bits: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens, rare ones first: linked sets share one of them."""
    n = len(tokens)
    size = n - int(_need(n, percent)) + 1
    last = _is_common(tokens, bits)
    rare = tokens[~last]
    return rare[:size] if len(rare) >= size else np.concatenate(
        [rare, tokens[last][: size - len(rare)]])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: the least node that links reach, for every node of an edge.

    Labels are passed on to neighbours and then followed to the label's own label, so the
    number of rounds grows with the logarithm of the longest path in practice.
    """
    pairs = edges.select("a", "b").where("a <> b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "links")
    label = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed(
        "a", "node")
    for _ in range(rounds):
        label = stored(label, "labels")
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("root").alias("seen"))
        step = label.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.least("root", "seen").alias("next"), "root")
        step = stored(step, "step")
        up = step.select(F.col("node").alias("at"), F.col("next").alias("further"))
        jumped = stored(step.join(up, F.col("next") == F.col("at"), "left").select(
            "node", F.least("next", F.coalesce("further", "next")).alias("root"),
            F.col("root").alias("old")), "jumped")
        label = jumped.select("node", "root")
        if not jumped.where("root <> old").limit(1).count():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return label


def jaccard_components(
    docs: DataFrame, *, size: int = 5, percent: int = 80, common: int = 24
) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a document's set holds its distinct
    shingles of ``size`` words, or all its words as one if it has fewer.  Documents link when
    100 * intersection >= percent * union; ``component_id`` is the least ``doc_id`` that
    links reach.  ``common``: from so many documents on, a token is ranked last.

    A null or empty text, or one without words, has no shingles and no links.  Repeated rows are
    kept; rows with a null id link nothing but get the component of their text (null if
    it has none).  Other columns are ignored; an empty table gives an empty result.
    """
    spark = ship(docs.sparkSession)
    sets = stored(token_sets(docs, size), "token-sets")
    ranked = spark.sparkContext.broadcast(common_tokens(sets, common))  # one megabyte

    # 1. equal sets are one set, named by the least id; it is known by half its hash where a
    # chance match only adds a candidate
    short = F.conv(F.hex(F.substring("set_id", 1, 8)), 16, -10).cast("long")
    small = stored(
        sets.where("n > 0").groupBy("set_id", "group_key", "n").agg(F.min("doc_id").alias("rep"))
        .withColumn("short", short), "sets")

    # 2. sets of a key are compared inside chunks, and with the centres of the key
    centres_of = small.groupBy(
        "group_key", F.pmod(F.xxhash64("set_id"), F.lit(CENTRES)).alias("bin")).agg(
        F.count("*").alias("sets"), F.sum("n").alias("tokens"), F.min("set_id").alias("centre"))
    twins = stored(
        centres_of.groupBy("group_key").agg(
            F.sum("sets").alias("sets"), F.sum("tokens").alias("tokens"),
            F.sort_array(F.collect_list("centre")).alias("centres"))  # CENTRES at most
        .where("sets > 1")
        .withColumn("chunks", F.ceil(F.greatest(
            F.col("sets") / CHUNK, F.col("tokens") / CHUNK_TOKENS)).cast("int"))
        .withColumn("centres", F.expr(
            "slice(centres, 1, greatest(1, CAST(sets / chunks / 4 AS INT)))")), "twins")
    large = twins.where("chunks > 1").select("group_key", "chunks", "centres")
    keyed = of_wanted(
        sets.select("doc_id", "n", "set_id", "group_key", "tokens"),
        small.join(twins, "group_key", "left_semi"), any_row=True)
    few = large.count() <= 20_000  # of some 300 bytes each
    own = F.pmod(F.xxhash64("set_id"), F.coalesce("chunks", F.lit(1))).cast("int")
    spread = F.when(F.array_contains("centres", F.col("set_id")),
                    F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))
    dealt = keyed.join(F.broadcast(large) if few else large, "group_key", "left").withColumn(
        "own", own).select(
        "group_key", "set_id", "tokens", "own",
        F.coalesce(F.array_contains("centres", F.col("set_id")), F.lit(False)).alias("is_centre"),
        F.explode(spread).alias("chunk"))

    def clustered(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("set_id").sort_values("set_id")
        root, loose = cluster(
            list(pdf["set_id"]), [unpacked(t) for t in pdf["tokens"]],
            list(pdf["is_centre"]), percent)
        return pd.DataFrame({
            "set_id": pdf["set_id"], "root": root, "loose": loose,
            "is_own": pdf["own"] == pdf["chunk"], "group_key": pdf["group_key"],
            "chunk": pdf["chunk"]})

    placed = stored(
        dealt.groupBy("group_key", "chunk").applyInPandas(
            clustered, "set_id binary, root binary, loose boolean, is_own boolean, "
            "group_key long, chunk int").where("root <> set_id OR is_own"), "groups")
    inside = placed.where("root <> set_id").select("set_id", F.col("root").alias("centre"))
    g = F.when(F.col("loose"), F.xxhash64("group_key", "chunk", F.lit("loose"))).otherwise(
        F.xxhash64("root"))
    groups = placed.where("is_own").select(
        "set_id", g.alias("g"), "loose",
        F.when(F.col("loose"), 0).otherwise(F.col("chunk")).alias("chunk"))
    members = groups.groupBy("g").count().withColumnRenamed("count", "members")
    named = stored(
        small.join(groups.join(members, "g"), "set_id", "left")
        .select("set_id", "rep", "short", "n", F.coalesce("g", F.xxhash64("set_id")).alias("g"),
                F.coalesce("chunk", F.lit(0)).alias("chunk"),
                F.coalesce("members", F.lit(1)).alias("members"),
                F.coalesce("loose", F.lit(False)).alias("loose")), "named-sets")

    # 3. the matrix, from the prefixes of all sets
    def prefixes(batches):
        for batch in batches:
            seen, names, tokens = set(), [], []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name in seen:
                    continue
                seen.add(name)
                found = prefix(unpacked(raw), ranked.value, percent)
                tokens.append(found)
                names.append(np.full(len(found), int.from_bytes(name[:8], "big", signed=True)))
            token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
            name = np.concatenate(names) if names else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(name), pa.array(token.view(np.int64))], ["short", "token"])

    posted = sets.where("n > 0").select("set_id", "tokens").mapInArrow(
        prefixes, "short long, token long")
    # only tokens of two sets, and then of two groups, can join anything
    ordered = Window.partitionBy("token").orderBy("short")
    every = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    met = posted.select(
        "token", "short", F.lag("short").over(ordered).alias("before"),
        F.first("short").over(every).alias("lo"), F.last("short").over(every).alias("hi")
    ).where("lo <> hi AND (before IS NULL OR before <> short)").select("token", "short")
    rows = stored(met.join(named.select("short", "g", "chunk", "members", "n"), "short"), "prefixes")
    across = rows.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where(
        "lo <> hi").select("token")
    rows = stored(rows.join(across, "token", "left_semi"), "matrix-rows")
    matrix = rows.groupBy("token", "g", "chunk", "members").agg(
        F.min("n").alias("least"), F.max("n").alias("most"))
    q, m = rows.alias("q"), matrix.alias("m")
    fits = (F.col("q.n") * 100 >= F.col("m.least") * percent) & (
        F.col("m.most") * 100 >= F.col("q.n") * percent)
    # each pair of groups meets once: the sets of the smaller group ask
    smaller = (F.col("q.members") < F.col("m.members")) | (
        (F.col("q.members") == F.col("m.members")) & (F.col("q.g") < F.col("m.g")))
    asked = stored(
        q.join(m, (F.col("q.token") == F.col("m.token")) & smaller & fits)
        .select(F.col("q.short").alias("short"), F.col("m.g").alias("g"),
                F.col("m.chunk").alias("chunk")).distinct(), "candidates")

    # 4. bound by cells, then bound by tokens and open
    def in_play(asked):
        chunks = asked.select("g", "chunk").distinct()
        found = named.join(asked.select("short").distinct(), "short", "left_semi").unionByName(
            named.join(chunks, ["g", "chunk"], "left_semi"))
        return stored(found.distinct().select("rep", "set_id", "short", "n", "g", "chunk", "loose"),
                      "in-play")

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([cells(unpacked(t)) for t in batch.column(2).to_pylist()], pa.binary())],
                ["doc_id", "set_id", "cells"])

    def most(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(pdf["cells"]), np.uint8).reshape(-1, CELLS).max(0)
        return pd.DataFrame({"g": [key[0]], "chunk": [key[1]], "most": [found.tobytes()]})

    def within_bound(batches):
        for batch in batches:
            n, mine, of_chunk = (batch.column(c).to_pylist() for c in (3, 4, 5))
            stay = [may_link(*x, percent) for x in zip(n, mine, of_chunk)]
            yield batch.select(["short", "g", "chunk", "n"]).filter(pa.array(stay, pa.bool_()))

    kind = sets.schema["doc_id"].dataType.simpleString()
    players = in_play(asked)
    sketch = of_wanted(sets.select("doc_id", "set_id", "n", "tokens"), players).select(
        "doc_id", "set_id", "tokens").mapInArrow(
        counted, f"doc_id {kind}, set_id binary, cells binary")
    sketch = stored(sketch.join(players, "set_id").where("doc_id = rep").select(
        "short", "set_id", "n", "g", "chunk", "cells").dropDuplicates(["set_id"]), "cells")
    met = sketch.join(asked.select("g", "chunk").distinct(), ["g", "chunk"], "left_semi")
    alone = met.groupBy("g", "chunk").agg(F.count("*").alias("sets"), F.max("cells").alias("most"))
    of_chunk = alone.where("sets = 1").select("g", "chunk", "most").unionByName(
        met.join(alone.where("sets > 1"), ["g", "chunk"], "left_semi")
        .select("g", "chunk", "cells").groupBy("g", "chunk")  # about CHUNK at most
        .applyInPandas(most, "g long, chunk int, most binary"))
    asked = stored(
        asked.join(sketch.select("short", "n", F.col("cells").alias("mine")), "short")
        .join(of_chunk, ["g", "chunk"]).select("short", "g", "chunk", "n", "mine", "most")
        .mapInArrow(within_bound, "short long, g long, chunk int, n long").distinct(), "bounded")

    players = in_play(asked)
    held = of_wanted(sets.select("doc_id", "n", "set_id", "tokens"), players).drop("n")
    # the queries of a chunk come in blocks that are bounded as the chunks are
    sizes = asked.groupBy("g", "chunk").agg(F.ceil(F.greatest(
        F.count("*") / CHUNK, F.sum("n") / CHUNK_TOKENS)).cast("int").alias("blocks"))
    asked = asked.join(sizes, ["g", "chunk"]).select(
        "short", "g", "chunk", F.pmod(F.xxhash64("short"), F.col("blocks")).alias("block"))
    askers = players.select("set_id", "rep", "short").join(asked, "short")
    # dealt as the chunks are, so that neither the blocks nor the join move the tokens again
    queries = held.join(askers, "set_id").where("doc_id = rep").select(
        "g", "chunk", "block", "set_id", "tokens").repartition("g", "chunk").groupBy(
        "g", "chunk", "block").agg(
        F.collect_list(F.struct("set_id", "tokens")).alias("queries"))
    packs = held.join(
        players.join(asked.select("g", "chunk").distinct(), ["g", "chunk"], "left_semi"), "set_id"
    ).where("doc_id = rep").dropDuplicates(["set_id"]).groupBy("g", "chunk").agg(
        F.collect_list(F.struct("set_id", "tokens")).alias("members"),
        F.first("loose").alias("loose"))
    cases = queries.join(packs, ["g", "chunk"]).select("queries", "members", "loose")

    def open_groups(batches):
        for batch in batches:
            a, b = [], []
            for row in range(batch.num_rows):
                asks, chunk = (  # a repeated row gives its set twice
                    [(x, unpacked(t)) for x, t in
                     {m["set_id"]: m["tokens"] for m in batch.column(c)[row].as_py()}.items()]
                    for c in (0, 1))
                union = chunk[0][1] if len(chunk) == 1 else np.unique(
                    np.concatenate([t for _, t in chunk]))
                asks = [(name, t) for name, t in asks
                        if _met(t, union) >= _need(len(t), percent)]
                if not asks:
                    continue
                both = overlaps([t for _, t in asks], [t for _, t in chunk])
                n, m = (np.array([len(t) for _, t in x]) for x in (asks, chunk))
                hit = 100 * both >= percent * (n[:, None] + m[None, :] - both)
                if not batch.column(2)[row].as_py():  # members are linked: one link does
                    hit &= np.cumsum(hit, axis=1) == 1
                for i, j in zip(*np.nonzero(hit)):
                    a.append(asks[i][0])
                    b.append(chunk[j][0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
        give_back()

    found = stored(
        cases.mapInArrow(open_groups, "a binary, b binary").distinct(), "links-of-sets")

    # 5. components of sets, then the least id of each
    edges = found.union(inside)
    root = components(edges)
    of_set = named.select("set_id", "rep").join(root, F.col("set_id") == F.col("node"), "left"
                                                  ).select(
        "set_id", "rep", F.coalesce("root", "set_id").alias("root"))
    best = of_set.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_set = of_set.join(best, "root").select("set_id", "component_id")
    return sets.select("doc_id", "n", "set_id").join(of_set, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"))


def _row_key():
    """16 bytes that stand for an id and a text together."""
    name, text = F.col("doc_id").cast("string"), F.col("text").cast("string")
    return F.unhex(F.md5(F.concat(
        F.coalesce(F.length(name), F.lit(-1)).cast("string"), F.lit(":"),
        F.coalesce(name, F.lit("")), F.when(text.isNull(), "-").otherwise("+"),
        F.coalesce(text, F.lit(""))).cast("binary")))


def keep_first(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component that links make: that of its least ``doc_id``, null last.

    Of several rows with that id the one with the least text stays.  A row is linked by its
    own text, whatever its id: rows that share an id, or have none, are told apart by their
    texts.  Rows without shingles link nothing and stay, one for each id (null is one).  Columns
    of any name are kept; an empty table gives an empty result.
    """
    key, = unlike(docs.columns, "row_key")
    once = docs.withColumn(key, _row_key()).dropDuplicates([key])
    keyed = docs.select(_row_key().alias("__key"), "doc_id", "text")
    found = jaccard_components(
        keyed.select(F.col("__key").alias("doc_id"), "text"), size=size, percent=percent)
    linked = F.col("n_shingles") > 0
    of_key = found.select(
        F.col("doc_id").alias("__key"), linked.alias("linked"),
        F.when(linked, F.col("component_id")).alias("component")).distinct()
    rows = stored(
        keyed.select("__key", "doc_id").distinct().join(of_key, "__key").select(
            "__key", "component", F.when(~F.col("linked"), F.col("doc_id")).alias("alone"),
            "doc_id"), "rows-of-components")
    least = stored(
        rows.groupBy("component", "alone", "doc_id").agg(
            F.min("__key").alias("lo"), F.max("__key").alias("hi"))
        .groupBy("component", "alone").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "lo", "hi")).alias("of"))
        .select("component", "alone", "of.doc_id", "of.lo", "of.hi"), "least-ids")
    kept = least.where("lo = hi").select(F.col("lo").alias("__key"))
    # the texts of one id are looked at only where a component has several
    tied = least.where("lo <> hi")
    if tied.limit(1).count():
        t = tied.select(*[F.col(c).alias(f"t_{c}") for c in ("component", "alone", "doc_id")])
        same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("component", "alone", "doc_id")]
        asked = rows.join(t, same[0] & same[1] & same[2], "left_semi").select(
            "__key", "component", "alone")
        first = keyed.select("__key", F.col("text").cast("string").alias("text")).join(
            asked, "__key").groupBy("component", "alone").agg(
            F.min(F.struct("text", "__key")).alias("first"))
        kept = kept.unionByName(first.select("first.__key"))
    # equal rows are reduced to one where they are read, and the join keeps to the same key
    return once.join(kept.select(F.col("__key").alias(key)), key, "left_semi").drop(key)
