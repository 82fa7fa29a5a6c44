"""How far apart the sources of a language are, by the words they use.

A term row is a term's counts in the sources of a language.  Every pair of sources is
compared over all kept terms, but nothing is done per pair and term.  The value of a pair is
that of a term nobody has, times the number of terms, plus *corrections*: one for what a
source's own count changes, and one for what two counts of the same term change together.
The latter come from a frequent-pattern tree.  A term row, its nonzero counts in the order of
the sources, is a path from the root; rows with the same counts share nodes, and a node holds
the number of its rows.  Each node corrects each of its ancestors once, times that number.

The tree is never built whole.  Equal rows are counted first, then sorted by path over the
partitions: in sorted order the rows of a node follow each other, so a batch of rows is a part
of the tree.  A node cut by the border of a batch appears in both parts, each with its own rows,
so sums stay exact and a hot path is split like any other.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import byte_texts, parts, ship, stored

#: Shares are whole numbers in units of one in SCALE.
SCALE = 1_000_000_000
WIDE = "decimal(38,0)"
#: Entries a task holds before it passes its counts on.
HELD = 1_000_000
#: Node-ancestor combinations worked on together: bounds a task's memory.
TOGETHER = 1 << 20
FEW_GROUPS = 20_000

#: Letters stay, A-Z lower-cased, with every byte of characters outside ASCII; the rest parts.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counted(batches):
    """``lang, source, term, n, docs``: occurrences, and documents of the language with it."""
    held = defaultdict(lambda: (Counter(), Counter()))
    size = 0

    def flush():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 50_000):
                some = terms[i : i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(some), pa.string()),
                        pa.array([source] * len(some), pa.string()),
                        pa.array(some, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in some], pa.int64()),
                        pa.array([docs[t] for t in some], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    for batch in batches:
        for part in parts([batch], "text"):
            groups = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            for group, text in zip(groups, byte_texts(part, "text")):
                n, docs = held[group]
                before = len(n)
                words = text.translate(_FOLD).split()
                n.update(words)
                docs.update(set(words))
                size += len(n) - before
            if size >= HELD:
                yield from flush()
                size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs`` per term that occurs; null text, lang and source are ''.

    Counts are made where the texts are read; only sums are shuffled.
    """
    ship(docs.sparkSession)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    counted = docs.select(empty("lang"), empty("source"), empty("text")).mapInArrow(
        _counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """One plus the whole part of SCALE times the share of ``n``, each count raised by one."""
    wide = (n.cast(WIDE) + 1).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", wide.cast(WIDE), (total + terms).cast("decimal(27,0)"))


def distance(p: Column, q: Column) -> Column:
    """The whole part of (p - q)^2 / q; below 2^63 as shares are at most SCALE + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def _path_corrections(batches):
    """``lang, item, other, value`` of every node and ancestor of rows sorted by path.

    Input rows are ``lang, sources, shares, zeros, n``: a path's sources, their shares of the
    term and of a term they have not, and how many terms have the path.
    """
    for batch in batches:
        langs = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist(), len(langs)]
        for start, stop in zip(cuts, cuts[1:]):
            if stop > start:
                yield from _corrections(batch.slice(start, stop - start))


def _nodes(first: np.ndarray, size: np.ndarray, same: np.ndarray, n: np.ndarray):
    """Nodes of the tree of sorted paths: place of the node's item, its depth, its rows.

    ``first`` and ``size`` say where the items of a path lie, ``same`` how many it has in
    common with the path before.  A node is made where its path leaves the one before, and
    its rows end where a later path has no more in common than its depth.
    """
    rows = np.concatenate([[0], np.cumsum(n)])
    found = []
    for depth in range(int(size.max())):
        leaves = np.flatnonzero(same <= depth)
        made = leaves[size[leaves] > depth]
        ends = np.append(leaves, len(size))[np.searchsorted(leaves, made, "right")]
        found.append((first[made] + depth, np.full(len(made), depth), rows[ends] - rows[made]))
    return [np.concatenate(c) for c in zip(*found)]


def _corrections(batch: pa.RecordBatch):
    """Corrections of the paths of one language.

    Paths that go on in the next batch have their nodes again there, for its rows only."""
    lists = [batch.column(i) for i in (1, 2, 3)]
    place, p, zero = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in lists)
    stop = np.cumsum(np.diff(lists[0].offsets.to_numpy()))
    size = np.diff(stop, prepend=0)
    first = stop - size
    n = batch.column(4).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(place)) - first[row]
    # the first item that differs from the one at the same place of the path before
    before = first[np.maximum(row - 1, 0)] + at
    differs = (row == 0) | (at >= size[np.maximum(row - 1, 0)])
    before[differs] = 0
    differs |= (place[before] != place) | (p[before] != p)
    same = size.copy()
    np.minimum.at(same, row[differs], at[differs])
    node, depth, times = _nodes(first, size, same, n)
    node, depth, times = node[depth > 0], depth[depth > 0], times[depth > 0]

    def f(a, b):
        return (a - b) * (a - b) // b

    ends = np.cumsum(depth)
    start = 0
    while start < len(node):
        stop_ = max(start + 1, int(np.searchsorted(
            ends, (ends[start - 1] if start else 0) + TOGETHER, "right")))
        i, d = node[start:stop_], depth[start:stop_]
        below = np.repeat(i, d)
        over = below - np.repeat(d, d) + (np.arange(d.sum()) - np.repeat(np.cumsum(d) - d, d))
        key = (place[below] << 32) | place[over]
        order = np.argsort(key, kind="stable")
        key, below, over = key[order], below[order], over[order]
        times_ = np.repeat(times[start:stop_], d)[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        a, za, b, zb = p[below], zero[below], p[over], zero[over]
        there = np.add.reduceat(times_ * (f(a, b) - f(a, zb) - f(za, b) + f(za, zb)), new)
        back = np.add.reduceat(times_ * (f(b, a) - f(b, za) - f(zb, a) + f(zb, za)), new)
        item, other = key[new] >> 32, key[new] & 0xFFFFFFFF
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch.column(0)[0].as_py()] * (2 * len(new)), pa.string()),
             pa.array(np.concatenate([item, other])), pa.array(np.concatenate([other, item])),
             pa.array(np.concatenate([there, back]))],
            ["lang", "item", "other", "value"])
        start = stop_


def _by_lang(left: DataFrame, groups: DataFrame, few: bool) -> DataFrame:
    """``left`` joined with the groups of its language; sent to all only if counted as few."""
    return left.join(F.broadcast(groups) if few else groups, "lang")


def source_divergence(docs: DataFrame, *, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: how a source differs, and by which terms.

    Terms are runs of ASCII letters and characters outside ASCII, A-Z lower-cased; a language
    keeps those in ``least_docs`` of its documents.  Each (lang, source) and each language gives
    a kept term the share ``1 + SCALE * (count + 1) // (N + V)``, with N its count of all kept
    terms and V their number.  ``part`` "pair": the sum over kept terms of (p - q)^2 // q, with p
    of the source and q of the item, another source of the language; every rank.  ``part``
    "term": that value for a term the source has, of which its share is above the language's;
    ``ranks`` ranks.  Ranks fall with the value, equal values are in the order of items.

    Null text, language and source are '', which is a language and a source like others; a
    language without kept terms has pairs of value 0.  Repeated rows count each time, ids and other
    columns are ignored, an empty table gives an empty result.  All values are whole numbers and
    exact while a language keeps fewer than 10^8 terms.  A language's sources are compared with
    each other, so the result, and a term row, grow with their number.
    """
    counts = stored(term_counts(docs), "term-counts")
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    occurring = docs.groupBy(empty("lang"), empty("source")).agg(F.lit(1).alias("one"))

    rows = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"),
        F.collect_list(F.struct("source", "n")).alias("row"))
    kept = stored(rows.where(F.col("docs") >= least_docs).drop("docs"), "term-rows")
    lang = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("n").cast(WIDE).alias("lang_total"))
    flat = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("row"))
    used = flat.groupBy("lang", "source").agg(
        F.sum("n").cast(WIDE).alias("total"), F.count("*").alias("own"))
    zero = F.lit(0).cast("long")
    groups = (
        occurring.join(used, ["lang", "source"], "left").join(lang, "lang", "left")
        .select(
            "lang", "source", F.coalesce("own", zero).alias("own"),
            F.coalesce("terms", zero).alias("terms"),
            F.coalesce("total", zero.cast(WIDE)).alias("total"),
            F.coalesce("lang_total", zero.cast(WIDE)).alias("lang_total"))
        # the order of sources in paths: those with most terms first, so that paths share heads
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(
            F.col("own").desc(), "source")).cast("long"))
        .withColumn("zero", F.when(F.col("terms") > 0, share(
            zero, F.col("total"), F.col("terms"))))
    )
    groups = stored(groups, "term-groups")
    few = groups.count() <= FEW_GROUPS

    shared = flat.join(
        F.broadcast(groups) if few else groups, ["lang", "source"]).select(
        "lang", "term", "source", "place", "n", "lang_n", "terms", "lang_total",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "zero")

    # part "term"
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (
        shared.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                distance(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    )

    # part "pair": a term nobody has, own counts, counts together
    ours = groups.where("terms > 0").select("lang", F.col("place").alias("item"), F.col(
        "zero").alias("p"), "terms")
    theirs = groups.where("terms > 0").select(
        "lang", F.col("place").alias("other"), F.col("zero").alias("q"))
    nobody = _by_lang(ours, theirs, few).where("item <> other").select(
        "lang", "item", "other",
        (distance(F.col("p"), F.col("q")).cast(WIDE) * F.col("terms")).cast(WIDE).alias("value"))
    own = shared.groupBy("lang", "place", "p", "zero").count()
    own = _by_lang(own, theirs, few).where("place <> other")
    base, q, n = F.col("zero"), F.col("q"), F.col("count").cast(WIDE)
    there = (distance(F.col("p"), q) - distance(base, q)).cast(WIDE)
    back = (distance(q, F.col("p")) - distance(q, base)).cast(WIDE)
    own = own.select("lang", F.inline(F.array(
        F.struct(F.col("place").alias("item"), "other", (n * there).cast(WIDE).alias("value")),
        F.struct(F.col("other").alias("item"), F.col("place").alias("other"),
                 (n * back).cast(WIDE).alias("value")))))
    paths = (
        shared.groupBy("lang", "term").agg(F.array_sort(F.collect_list(
            F.struct("place", "p", "zero"))).alias("path"))
        .where(F.size("path") > 1).groupBy("lang", "path").agg(F.count("*").alias("n")))
    paths = stored(paths, "term-paths")
    together = (
        paths.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
        .select("lang", "path.place", F.col("path.p").alias("p"),
                F.col("path.zero").alias("zero"), "n")
        .mapInArrow(_path_corrections, "lang string, item long, other long, value long")
        .withColumn("value", F.col("value").cast(WIDE)))
    summed = nobody.unionByName(own).unionByName(together).groupBy(
        "lang", "item", "other").agg(F.sum("value").cast("long").alias("value"))
    at = lambda name, place: groups.select(
        "lang", F.col("place").alias(place), F.col("source").alias(name))
    everyone = _by_lang(at("source", "at"), at("item", "to"), few).where("at <> to")
    pairs = everyone.join(
        summed.select("lang", F.col("item").alias("at"), F.col("other").alias("to"), "value"),
        ["lang", "at", "to"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item",
        F.coalesce("value", zero).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    return pairs.unionByName(terms)


SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
said AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n
  FROM said GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n
  FROM said SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + s.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 1)) // (s.total + s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN size s USING (lang)
  LEFT JOIN total t USING (lang, source) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""
