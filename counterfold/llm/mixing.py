"""Mixing sources to target weights by balanced sampling (the cube method).

Every document of a source is wanted the same number of times: its source's target over
its size.  The whole part is taken at once; the fraction is a probability.  The cube
method turns the probabilities of a block of documents into decisions without moving two
totals, that of words and that of documents: it walks along directions that both
constraints leave free (their null space) until a probability is 0 or 1, and does so
again.  At most two documents of a block stay undecided.  Those of all blocks form new
blocks, until a source has one block; how many it has depends on its own size only.  A few
documents of all lengths are left out of the flights before, and the landing problem of these
and the undecided two is solved outright: of all decisions, the one whose words, then
documents, miss the totals least.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import WORD, ship, stored, unlike

BLOCK = 20_000
LANDING = 12


def _chance(seed: int, *names) -> float:
    text = repr((seed, names)).encode()
    return int.from_bytes(hashlib.blake2b(text, digest_size=7).digest(), "big") / 2**56


def flight(sizes: list[float], chances: list[float], draw) -> list[float]:
    """Chances moved to 0 or 1 with both totals kept; at most two stay in between.

    ``draw()`` gives random numbers in [0, 1).
    """
    done = list(chances)
    live: list[int] = []
    for i in range(len(done)):
        if 0.0 < done[i] < 1.0:
            live.append(i)
        if len(live) < 3:
            continue
        u = _free_direction(*(sizes[j] for j in live))
        up = min((1 - done[j]) / d if d > 0 else done[j] / -d for j, d in zip(live, u) if d)
        down = min(done[j] / d if d > 0 else (1 - done[j]) / -d for j, d in zip(live, u) if d)
        step = up if draw() * (up + down) < down else -down
        for j, d in zip(live, u):
            done[j] += step * d
        nearest = min(live, key=lambda j: min(done[j], 1 - done[j]))  # the one that landed
        for j in live:
            if j == nearest or done[j] < 1e-9 or done[j] > 1 - 1e-9:
                done[j] = float(round(done[j]))
        live = [j for j in live if 0.0 < done[j] < 1.0]
    return done


def _free_direction(a: float, b: float, c: float) -> tuple[float, float, float]:
    """A direction for three documents of these sizes that moves neither total."""
    if a == b:
        return 1.0, -1.0, 0.0
    if b == c:
        return 0.0, 1.0, -1.0
    if a == c:
        return 1.0, 0.0, -1.0
    top = max(a, b, c)
    return (b - c) / top, (c - a) / top, (a - b) / top


def spared(sizes: list[float], chances: list[float], draw, slots) -> list[float]:
    """``flight`` without the undecided documents at these of LANDING places by length."""
    done = list(chances)
    by_size = sorted((i for i, c in enumerate(done) if 0.0 < c < 1.0), key=lambda i: (sizes[i], i))
    if len(by_size) <= len(slots):
        return done
    steps = np.linspace(0, len(by_size) - 1, LANDING).astype(int)
    out = {by_size[steps[i]] for i in slots}
    flown = sorted(i for i in by_size if i not in out)
    for i, c in zip(flown, flight([sizes[i] for i in flown], [done[i] for i in flown], draw)):
        done[i] = c
    return done


def landing(sizes: list[float], chances: list[float], draw) -> list[float]:
    """All chances moved to 0 or 1, both totals nearly kept."""
    done = spared(sizes, chances, draw, range(LANDING))
    open_ = [i for i, c in enumerate(done) if 0.0 < c < 1.0]
    if open_:
        ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        miss = ways - np.array([done[i] for i in open_])
        words = np.abs(miss @ np.array([sizes[i] for i in open_]))
        best = np.lexsort((np.abs(miss.sum(1)), np.round(words, 6)))[0]
        for i, way in zip(open_, ways[best]):
            done[i] = float(way)
    return done


def source_targets(sized: DataFrame, *, most: float = 3.0) -> DataFrame:
    """``source, source_size, n_docs, target``; one row per source.

    Sources in order of code points, null last, weigh 1, 2, 3, repeating.  Targets share all
    words by weight, but none above ``most`` times its source's words; the excess goes to the
    others by weight: sorted by words over weight, the first sources reach their limits and
    the rest share what is left.
    """
    by_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    # these windows run over one row per source
    place = Window.orderBy(F.col("source").asc_nulls_last())
    limit = F.lit(float(most)) * F.col("source_size")
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight").over(after)
    return (
        by_source.withColumn("weight", (F.row_number().over(place) - 1) % 3 + 1.0)
        .withColumn("limit", limit)
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("level", level)
        # the share that holds is that of the first source whose limit is not reached
        .withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
        .withColumn("share", F.min(F.when(~F.col("full"), F.struct(
            F.col("limit") / F.col("weight"), "level"))).over(everything)["level"])
        .withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(
            F.col("share") * F.col("weight")))
        .select("source", "source_size", "n_docs", "target")
    )


def mix_sources(
    docs: DataFrame, *, most: float = 3.0, seed: int = 1, block: int = BLOCK, keyed: bool = False,
) -> DataFrame:
    """Per row: ``doc_id, size, source, source_size, target, taken`` and ``times``.

    ``size`` counts words, ``times`` how often the document is taken, ``taken`` is both
    multiplied.  The words taken of a source miss its target by less than one or two documents.
    A document is taken ``most`` times at most.  With ``keyed`` there is also ``row_key``, 16
    bytes that stand for id, source and text (see ``repeat_rows``).

    A null or empty text has no words; a null source is a source.  Equal rows are treated
    one by one; which of them is taken more often does not show.  Ids may be null, and long ones
    keep all their digits.  Other columns are ignored, an empty table gives an empty result.
    Results depend on the rows and the seed only, not on the order or the partitions: blocks are
    cut by hashes and sorted.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source_kind = docs.schema["source"].dataType.simpleString()
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    sized = stored(docs.select(
        "doc_id", "source", words.cast("long").alias("size"),
        (_row_key() if keyed else F.lit(None).cast("binary")).alias("row_key")), "sizes")
    targets = source_targets(sized, most=most)
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    s, t = sized.alias("s"), targets.alias("t")
    wanted = F.when(F.col("t.source_size") > 0, F.least(
        F.col("t.target") / F.col("t.source_size"), F.lit(float(most)))).otherwise(0.0)
    # ids as text: pandas would make numbers of a column with nulls doubles
    rows = s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("doc_id").cast("string").alias("doc_id"), "s.source", "size", "row_key",
        "source_size", "n_docs", "target",
        F.floor(wanted).cast("long").alias("times"), (wanted - F.floor(wanted)).alias("chance"))
    # equal rows are counted before they are dealt out, and go to different blocks
    rows = rows.groupBy(*rows.columns).count().withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int")))).drop("count")
    schema = (f"doc_id string, source {source_kind}, size long, row_key binary, source_size long, "
              "n_docs long, target double, times long, chance double, copy int")

    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (_, at, level, alone), n = key, int(pdf.n_docs.iloc[0])
        slots: range = range(0)
        if n <= most_docs(level + 1):  # the next level lands what this one spares
            slots = range(int(at), LANDING, math.ceil(n / most_docs(level)))
        pdf = pdf.assign(order=pdf.doc_id.astype(str), tie=pdf.row_key.map(
            lambda k: b"" if k is None else bytes(k))).sort_values(
            ["order", "size", "tie", "copy"], kind="stable")
        name = [str(k) for k in key]
        draws = iter(range(1 << 62))
        given = (pdf["size"].astype(float).tolist(), pdf["chance"].tolist(),
                 lambda: _chance(seed, *name, next(draws)))
        pdf["chance"] = landing(*given) if alone else spared(*given, slots)
        return pdf[[c.split()[0] for c in schema.split(", ")]]

    def most_docs(level: int) -> float:
        """Documents of a source that has one block at the level."""
        return float(block) * (block / 2) ** level

    decided, left, level = None, rows, 0
    while True:
        blocks = F.ceil(F.col("n_docs") / F.lit(most_docs(level)))
        at = F.pmod(F.xxhash64(F.col("doc_id").cast(kind), "size", "copy", F.lit(
            seed + level)), F.greatest(blocks, F.lit(1)))
        alone = F.col("n_docs") <= F.lit(most_docs(level))
        flown = stored(
            left.groupBy("source", at.alias("block"), F.lit(level).alias("level"),
                         alone.alias("last")).applyInPandas(fly, schema),
            f"flight-{level}")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        settled = flown.where(~open_)
        decided = settled if decided is None else decided.unionByName(settled)
        if largest <= most_docs(level):
            break
        left, level = flown.where(open_), level + 1
    times = F.col("times") + F.col("chance").cast("long")
    return decided.select(
        F.col("doc_id").cast(kind).alias("doc_id"), "size", "source", "source_size", "target",
        (times * F.col("size")).alias("taken"), times.alias("times"),
        *(["row_key"] if keyed else []))


def _row_key() -> Column:
    """16 bytes that stand for an id, a source and a text together."""
    parts = [F.col(c).cast("string") for c in ("doc_id", "source", "text")]
    sizes = [F.coalesce(F.length(p), F.lit(-1)).cast("string") for p in parts]
    joined = F.concat_ws(":", *sizes, *[F.coalesce(p, F.lit("")) for p in parts])
    return F.unhex(F.md5(joined.cast("binary")))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as many times as ``mix_sources(docs, keyed=True)`` took it.

    Rows that agree in id, source and text are taken as often as all of them together are, as
    copies of one of them: which of their other columns is kept is not defined.  Null ids,
    sources and texts are values like others; columns of any name are kept; an empty table
    gives an empty result.  Equal rows are reduced to one before they are shuffled.
    """
    key, times, copy = unlike(docs.columns, "row_key", "times", "copy")
    taken = mixed.groupBy(F.col("row_key").alias(key)).agg(
        F.sum("times").cast("int").alias(times)).where(F.col(times) > 0)
    once = docs.withColumn(key, _row_key()).dropDuplicates([key])
    return once.join(taken, key).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
