"""Document quality by pairwise ranking.

A Bradley-Terry model: the chance that document a is better than b is a logistic function
of the difference of their scores, and a score is linear in features of the text.  The
weights come from preference pairs (a label-1 against a label-0 document) by logistic
loss on feature differences.  A document is kept if its score lies above the quantile of
the training scores that the share of label 0 gives.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.llm.common import (
    SPACE,
    byte_texts,
    held_out,
    parts,
    ship,
    stored,
    text_or_empty,
)

SYMBOLS = b"#*$%&|<>"
NAMES = [
    "symbols", "pipes", "upper", "exclamation", "digits", "sentence_marks", "other_marks",
    "repeated_lines", "distinct_words", "word_length", "length", "line_length", "short_words",
    "no_text",
]


#: Ids that are broadcast; scores that are collected; texts of a bucket that is numbered.
FEW_IDS, FEW_VALUES, BUCKET = 500_000, 10_000, 4096


def _share(count: int, of: int) -> float:
    """Log of a share; a share far below a percent counts as none."""
    return math.log(count / of + 0.003) if of else math.log(0.003)


def features(text: bytes) -> list[float]:
    """Fixed features of one text (see ``NAMES``); an empty text has a feature of its own."""
    n = len(text)
    count = lambda chars: n - len(text.translate(None, chars))
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip(SPACE)]
    letters = count(bytes([*range(65, 91), *range(97, 123)]))
    n_words = len(words)
    return [
        _share(count(SYMBOLS), n), _share(text.count(b"|"), n),
        _share(count(bytes(range(65, 91))), letters), _share(text.count(b"!"), n),
        _share(count(b"0123456789"), n), _share(count(b".,"), n),
        _share(count(b";:?\"'()[]{}-_/\\~^=+`@"), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        # distinct words against what a text of this length usually has
        math.log(len(set(words)) / n_words**0.9) if n_words else 0.0,
        math.log((n - count(SPACE)) / n_words) if n_words else 0.0,
        math.log1p(n_words), math.log1p(n_words / len(lines)) if lines else 0.0,
        _share(sum(map(len, words)) and sum(len(w) <= 3 for w in words), n_words),
        float(not n_words),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float  # the quantile of training scores between label 0 and 1
    limit: float  # the probability that the threshold stands for

    def rank(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = math.log(self.limit / (1 - self.limit))
        z = np.clip(self.rank(x) - self.threshold + shift, -500, 500)
        return 1 / (1 + np.exp(-z))


def _with_features(batches):
    for batch in parts(batches, "text"):
        found = [features(t) for t in byte_texts(batch, "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))],
            ["doc_id", "h", "x"])


def training_rows(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``h, label, x``, stored: the features of all labelled training texts, each text once.

    Only ids and features are shuffled; the texts stay where they are read.
    """
    known = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    texts = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select(
        "doc_id", text_or_empty().alias("text"))
    if known.limit(FEW_IDS + 1).count() <= FEW_IDS:  # else features of all rows are worked out
        texts = texts.join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", F.md5("text").alias("h"), "text").mapInArrow(
        _with_features, f"doc_id {kind}, h string, x array<double>")
    once = found.join(known, "doc_id").groupBy("h").agg(
        F.max("label").alias("label"), F.first("x").alias("x"))
    return stored(once, "quality-rows")


def preference_pairs(rows: DataFrame, sizes: dict[int, int], pairs: int, seed: int) -> DataFrame:
    """``d``, stored: features of a better text less those of a worse one, every text in a pair.

    Both labels are numbered in an order given by a hash; each text of the larger label meets
    one of the smaller, in as many turns as give about ``pairs`` pairs, one at least.
    """
    buckets = max(1, sum(sizes.values()) // BUCKET)
    order = F.xxhash64("h", F.lit(seed))
    placed = rows.withColumns({"o": order, "b": F.pmod(F.xxhash64("h"), F.lit(buckets))})
    counts = placed.groupBy("label", "b").count()
    before = Window.partitionBy("label").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(  # a row for each thousands of texts
        "label", "b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("label", "b").orderBy("o", "h")
    numbered = placed.withColumn("i", F.row_number().over(inside) - 1).join(
        F.broadcast(starts), ["label", "b"]).select(
            "label", "x", (F.col("start") + F.col("i")).alias("i"))
    large = 1 if sizes[1] >= sizes[0] else 0
    n, few = sizes[large], sizes[1 - large]
    turns = max(1, -(-pairs // n))
    turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    many = numbered.where(F.col("label") == large).select(F.col("x").alias("x1"), "i", turn.alias("t")).select(
        "x1", F.pmod(F.col("i") + F.col("t"), F.lit(few)).alias("j"))
    rare = numbered.where(F.col("label") != large).select(F.col("x").alias("x0"), F.col("i").alias("j"))
    if few <= BUCKET:  # else there are many keys and none is large
        rare = F.broadcast(rare)
    sign = 1.0 if large == 1 else -1.0
    d = F.zip_with("x1", "x0", lambda a, b: (a - b) * F.lit(sign))
    return stored(many.join(rare, "j").select(d.alias("d")), "quality-pairs")


def _newton_sums(pairs: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss over all pairs."""
    k = len(w)

    def sums(batches):
        total = np.zeros(k + k * k)
        for batch in batches:
            d = batch.column(0).flatten().to_numpy().reshape(-1, k)
            p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
            total[:k] += d.T @ (1 - p)
            total[k:] += ((d * (p * (1 - p))[:, None]).T @ d).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["v"])

    got = pairs.mapInArrow(sums, "v array<double>").agg(
        Summarizer.sum(array_to_vector("v")).alias("v")).first()
    v = got.v.toArray()
    return v[:k], v[k:].reshape(k, k)


def bradley_terry(pairs: DataFrame, columns: int, *, ridge: float) -> np.ndarray:
    """Weights from all preference pairs, by Newton steps on the logistic loss."""
    w = np.zeros(columns)
    for _ in range(50):
        g, h = _newton_sums(pairs, w)
        step = np.linalg.solve(h + ridge * np.eye(columns), g - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def order_statistic(values: DataFrame, rank: int) -> float:
    """The value of column ``s`` at a place from 0 in ascending order, exactly: ranges that hold
    it are narrowed by counts until few values are left."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    rest = values
    while low < high:
        if rest.limit(FEW_VALUES + 1).count() <= FEW_VALUES:
            return sorted(r.s for r in rest.collect())[rank]
        bin_ = F.least(F.floor((F.col("s") - low) / ((high - low) / 1000)), F.lit(999))
        counts = rest.groupBy(bin_.alias("at")).agg(
            F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
        for r in counts.orderBy("at").collect():
            if rank < r.n:
                low, high = r.low, r.high
                break
            rank -= r.n
        rest = values.where(F.col("s").between(low, high))
    return low


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, column: str = "quality",
    pairs: int = 60_000, ridge: float = 5.0, limit: float = 0.3, seed: int = 17,
) -> QualityModel:
    """Fit on all labelled rows: means, pairs and threshold; ``pairs`` are the least number.

    Without labels of both kinds there are no pairs: all texts then get the same score,
    above the limit.  Null texts count as empty; rows without a label of 0 or 1, without an id or
    held out are not used; equal texts, and labels of one id, count once with the larger label.
    """
    ship(docs.sparkSession)
    k = len(NAMES)
    rows = training_rows(docs, labels, column)
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        flat = np.zeros(k)
        return QualityModel(flat, flat + 1, flat, -1.0, limit)
    mean, spread = rows.select(array_to_vector("x").alias("v")).agg(
        Summarizer.mean(F.col("v")), Summarizer.std(F.col("v"))).first()
    n = sum(sizes.values())
    model = QualityModel(
        mean.toArray(), spread.toArray() * math.sqrt((n - 1) / n) + 0.05, np.zeros(k), 0.0, limit)

    def scaled(batches):
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(-1, k)
            z = np.clip((x - model.mean) / model.spread, -8, 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(z), pa.list_(pa.float64()))],
                ["h", "label", "x"])

    z = rows.select("h", "label", "x").mapInArrow(scaled, "h string, label int, x array<double>")
    model.weights = bradley_terry(preference_pairs(z, sizes, pairs, seed), k, ridge=ridge)

    def ranked(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, k)
            yield pa.RecordBatch.from_arrays([pa.array(model.rank(x))], ["s"])

    ranks = stored(rows.select("x").mapInArrow(ranked, "s double"), "quality-ranks")
    cut = sizes[0]
    model.threshold = (order_statistic(ranks, cut - 1) + order_statistic(ranks, cut)) / 2
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Per row: ``doc_id, score`` (0 to 1) and ``predicted`` (score at or above the limit).

    Only the text is used.  A null text is empty; empty texts are scored like others.
    Repeated rows are scored row by row, null ids kept, other columns ignored; an empty
    table gives an empty result.  No shuffle.
    """
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # a few dozen numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        m = shared.value
        for batch in parts(batches, "text"):
            x = np.array([features(t) for t in byte_texts(batch, "text")], float)
            s = m.score(x.reshape(-1, len(NAMES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= m.limit).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    return docs.selectExpr("doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        rows, f"doc_id {kind}, score double, predicted int")
