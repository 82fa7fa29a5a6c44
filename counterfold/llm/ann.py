"""Approximate nearest neighbours with adaptive dimension scans.

Vectors are dealt to lists by their nearest centroid and rotated at random, so that the
distance over the first columns estimates the whole one.  A query probes its nearest
lists.  In a list the rotated vectors lie in blocks of columns: after each block, a test
of the hypothesis "closer than the tenth best so far" gives up the candidates whose
partial distance is too large for it, so most are read in few columns only.  What is left
is measured on the original vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import ship, stored

COLUMNS = 16  # of a block
CHUNK, QUERIES = 4096, 1024  # of a list in one task


@dataclass
class Index:
    """Bounded by ``most_lists`` centroids, whatever the number of vectors."""

    centroids: np.ndarray
    rotation: np.ndarray
    dimension: int
    probes: int = 1


def usable(vector: Column, dimension: int) -> Column:
    """Vectors of the dimension, with finite components that are not all zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(
        (F.size(x) == dimension) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def fit_index(
    vectors: DataFrame, *, sample_rows: int = 20_000, most_lists: int = 1024, rounds: int = 8,
    recall: float = 0.97, seed: int = 7,
) -> Index:
    """Centroids from a sample of about ``sample_rows`` vectors at most (documented bound).

    ``vectors`` has columns ``id`` and ``vector``.  The dimension is the one that most
    vectors have (the smaller of two); there are about as many lists as the square root of
    the number of vectors.  ``probes`` is how many lists hold the share ``recall`` of the ten
    nearest of 400 sampled vectors in the sample, where neighbours lie farther than among all.
    """
    ship(vectors.sparkSession)
    sizes = vectors.where("vector IS NOT NULL AND size(vector) > 0").groupBy(
        F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    d = int(sizes["d"]) if sizes else 0
    good = vectors.where(usable(F.col("vector"), d))
    n = good.count() if d else 0
    if not n:
        return Index(np.zeros((1, max(d, 1))), np.eye(max(d, 1)), d)
    share = min(1.0, min(sample_rows, (64 << 20) // (8 * d)) / n)
    some = good.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < max(1, int(1e6 * share)))
    rows = some.select("id", F.col("vector").cast("array<double>").alias("v")).toPandas()
    x = np.array(rows.sort_values("id").v.tolist() or [[0.0] * d], float)
    rng = np.random.default_rng(seed)
    k = int(np.clip(np.sqrt(n), 1, min(most_lists, len(x))))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        at = nearest(x, c, 1)[:, 0]
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        count = np.bincount(at, minlength=k)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    asked = x[rng.choice(len(x), min(400, len(x)), replace=False)]
    place = np.argsort(nearest(asked, c, k), 1)  # of each list in the order of each query
    wanted = nearest(asked, x, min(11, len(x)))
    at = np.take_along_axis(place, nearest(x, c, 1)[:, 0][wanted], 1)
    probes = int(np.quantile(at, recall)) + 1
    return Index(c, np.linalg.qr(rng.normal(size=(d, d)))[0], d, probes)


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest rows of ``c`` for each row of ``x``, nearest first."""
    out = []
    for i in range(0, len(x), 2048):
        apart = (c**2).sum(1) - 2 * x[i : i + 2048] @ c.T
        first = np.argpartition(apart, n - 1, axis=1)[:, :n] if n < len(c) else np.tile(
            np.arange(len(c)), (len(apart), 1))
        order = np.take_along_axis(apart, first, 1).argsort(1, kind="stable")
        out.append(np.take_along_axis(first, order, 1))
    return np.concatenate(out) if out else np.zeros((0, n), int)


def scan(ids, x, query_ids, q, rotation, k: int, doubt: float):
    """Rows (query, id, distance): the ``k`` nearest of each query among ``x``, itself left out.

    A candidate is given up after ``m`` of ``d`` columns if its partial distance, scaled by
    d/m, exceeds the k-th best by the factor ``(1 + doubt / sqrt(m))`` squared.
    """
    d = x.shape[1]
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    turned, turned_q = x @ rotation, q @ rotation
    blocks = [np.ascontiguousarray(turned[:, i : i + COLUMNS]) for i in range(0, d, COLUMNS)]
    out = []
    for name, plain, query in zip(query_ids, q, turned_q):
        head = np.flatnonzero(ids[: 4 * k + 1] != name)
        true = ((x[head] - plain) ** 2).sum(1)
        limit = np.sort(true)[k - 1] if len(true) >= k else np.inf
        left = np.arange(4 * k + 1, len(ids))
        left = left[ids[left] != name]
        partial = np.zeros(len(left))
        for b, block in enumerate(blocks):
            if not len(left):
                break
            at = block[left] - query[b * COLUMNS : (b + 1) * COLUMNS]
            partial += (at**2).sum(1)
            m = min((b + 1) * COLUMNS, d)
            if m == d:
                stay = partial <= limit * (1 + 1e-9)
            else:
                stay = partial * (d / m) <= limit * (1 + doubt / np.sqrt(m)) ** 2
            left, partial = left[stay], partial[stay]
        at = np.concatenate([head, left])
        true = ((x[at] - plain) ** 2).sum(1)
        best = np.lexsort((ids[at], true))[:k]
        out.extend((name, ids[at[i]], float(np.sqrt(true[i]))) for i in best)
    return out


def search(
    vectors: DataFrame, queries: Column, index: Index, *, k: int = 10,
    least: int = 400, doubt: float = 3.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query row.

    ``vectors`` has ``id`` (an integer) and ``vector``; ``queries`` is a condition on its rows.
    A query probes the index's number of lists, and more until they hold ``least`` vectors.
    ``score`` is the Euclidean distance of the original vectors in double precision; ties go
    to the smaller id; a row is no neighbour of its own id.

    Rows with a null id, and vectors that ``usable`` does not accept, take no part; without
    others a query has fewer rows, or none.  Of equal vectors those with the ``k + 1``
    smallest ids are kept before anything is compared, which changes no result and keeps
    a vector that is in a third of all rows from filling a list.  Lists are scanned in
    chunks of bounded size against blocks of queries.
    """
    spark = ship(vectors.sparkSession)
    shared = spark.sparkContext.broadcast(index)  # centroids, bounded
    good = vectors.where(F.col("id").isNotNull() & usable(F.col("vector"), index.dimension)
                         ).select(F.col("id").cast("long").alias("id"),
                                  F.col("vector").cast("array<double>").alias("vector"))
    same = Window.partitionBy("vector").orderBy("id")
    base = good.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1)

    def assign(batches):
        c = shared.value.centroids
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1)
            lists = nearest(x, c, 1)[:, 0] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lists, pa.int32())],
                ["id", "vector", "list"])

    base = stored(base.select("id", "vector").mapInArrow(
        assign, "id long, vector array<double>, list int"), "vector-lists")
    size = {r["list"]: r["count"] for r in base.groupBy("list").count().collect()}  # bounded

    def probe(batches):
        c = shared.value.centroids
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(batch.num_rows, -1)
            lists, rows = [], []
            for row, near in enumerate(nearest(x, c, len(c))):
                held = 0
                for tried, at in enumerate(near):
                    if tried >= shared.value.probes and held >= least:
                        break
                    if int(at) in size:
                        held += size[int(at)]
                        lists.append(int(at))
                        rows.append(row)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(lists, pa.int32())], ["query", "point", "list"])

    asked = good.where(queries).select(F.col("id").alias("query"), F.col("vector").alias("point"))
    asked = stored(asked.mapInArrow(
        probe, "query long, point array<double>, list int"), "probes")
    waiting = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}  # bounded
    # rows are dealt to the chunks of their list, and stand in each block of queries
    deal = spark.createDataFrame(
        [(n, -(-size[n] // CHUNK), -(-waiting[n] // QUERIES)) for n in size if n in waiting]
        or [(-1, 1, 1)], "list int, chunks int, blocks int")
    part = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = base.join(F.broadcast(deal), "list").withColumn("chunk", part("id", "chunks")
                                                           ).withColumn("block", every("blocks"))
    right = asked.join(F.broadcast(deal), "list").withColumn("block", part("query", "blocks")
                                                             ).withColumn("chunk", every("chunks"))

    def found(key: tuple, b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(b) and len(a):
            rows = scan(b["id"].to_numpy(), np.stack(b["vector"]), a["query"].to_numpy(),
                        np.stack(a["point"]), shared.value.rotation, k, doubt)
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    keys = ["list", "chunk", "block"]
    pairs = left.select(*keys, "id", "vector").groupBy(*keys).cogroup(
        right.select(*keys, "query", "point").groupBy(*keys)
    ).applyInPandas(found, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
