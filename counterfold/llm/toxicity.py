"""Toxic passages: maximum-scoring segments of token log-odds.

1. On labelled documents (a bounded sample, each text once) count in how many toxic and
   clean ones a token occurs.  Tokens are words and the beginnings of words, so that
   inflected forms share evidence.
2. Log-odds with an informative Dirichlet prior; only significant ones are kept.
3. Every document is scanned once, in linear time, for all its maximal segments: a word
   adds its log-odds, or takes away ``drift`` if it has none.
4. Segment scores follow an extreme-value law in clean texts.  Its two constants give
   each segment the number of equally good ones to expect by chance; segments with few
   are the toxic passages.  The document's score is a logistic function of its best.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.llm.common import byte_texts, filtered, held_out, parts, ship, stored

EDGES = ".,;:!?\"'()[]{}<>#*$%&|-_/\\~^=+`@"
BEGINNINGS = (4, 5)
MEMORY = 600_000  # words a worker remembers
LONG = 64  # characters of a word that is not remembered: this bounds the memory's bytes


def tokens(word: str) -> list[str]:
    """The word without punctuation at its edges, and its beginnings (marked)."""
    w = word.strip(EDGES)
    return [w, *(w[:n] + "~" for n in BEGINNINGS if len(w) >= n)] if w else []


def segments(scores: list[float], at: list[int]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence, in linear time.

    ``scores`` holds alternately what lies between two positive words and their own, as
    prepared by ``scan``; ``at`` holds the position of each entry.
    """
    out: list[list] = []
    # [sum before, sum after, first, last, place of the last entry before that starts lower]
    stack: list[list] = []
    total = 0.0
    for s, p in zip(scores, at):
        if s <= 0:
            total += s
            continue
        new = [total, total + s, p, p, -1]
        total += s
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= new[0]:
                j = stack[j][4]  # those between start higher still
            if j < 0:  # no later one can reach back over this one
                out += stack
                stack.clear()
                break
            if stack[j][1] >= new[1]:
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
        new[4] = j
        stack.append(new)
    return [(int(f), int(l), after - before) for before, after, f, l, _ in out + stack]


@dataclass
class ToxicityModel:
    """Everything a scan needs; its size is bounded by the sample it was fitted on."""

    lexicon: dict[str, float]
    drift: float = 0.5
    rate: float = 1.0  # lambda of the extreme-value law
    scale: float = 0.01  # its K
    slope: float = 1.0
    base: float = -4.0
    significant: float = 0.01  # expected number by chance, at most

    def word_score(self, word: str) -> float:
        found = [self.lexicon[t] for t in tokens(word) if t in self.lexicon]
        return max(found) if found else -self.drift

    def chance(self, score: float, n_words: int) -> float:
        """How many segments this good a clean text of this length has, on average."""
        return self.scale * max(n_words, 1) * math.exp(-self.rate * score)

    def evidence(self, best: float, n_words: int) -> float:
        """Minus the log of the chance that a clean text has a segment this good."""
        if best <= 0:
            return 0.0
        e = self.chance(best, n_words)
        return -math.log(max(-math.expm1(-e), 1e-300))

    def probability(self, evidence: float) -> float:
        x = self.base + self.slope * min(evidence, 60.0)
        return 1.0 / (1.0 + math.exp(-max(min(x, 700.0), -700.0)))


class Scanner:
    """Scores words with a memory, and whole texts with one pass."""

    def __init__(self, model: ToxicityModel):
        self.model, self.memory, self.long = model, {}, []

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        words = text.lower().split()
        memory = self.memory
        if len(memory) > MEMORY:
            memory.clear()
        for w in self.long:
            memory.pop(w, None)
        fresh = set(words).difference(memory)
        for w in fresh:
            memory[w] = self.model.word_score(w)
        self.long = [w for w in fresh if len(w) > LONG]
        values = list(map(memory.__getitem__, words))
        drift, scores, at, last = self.model.drift, [], [], -1
        for i, v in enumerate(values):
            if v > 0:
                scores += [-drift * (i - last - 1), v]
                at += [i - 1, i]
                last = i
        return len(words), segments(scores, at)


def count_tokens_by_class(sample: DataFrame) -> DataFrame:
    """``token, toxic, clean``: the number of distinct texts of each class that have it."""

    def counts(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in parts(batches, "text"):
            labels = batch.column(1).to_pylist()
            for raw, label in zip(byte_texts(batch, "text"), labels):
                words = set(raw.decode("utf-8", "replace").lower().split())
                seen[label].update({t for w in words for t in tokens(w)})
        keys = list(seen[0].keys() | seen[1].keys())
        for i in range(0, len(keys), 50_000):
            some = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.string()),
                    pa.array([seen[1][k] for k in some], pa.int64()),
                    pa.array([seen[0][k] for k in some], pa.int64()),
                ],
                ["token", "toxic", "clean"],
            )

    return (
        sample.select("text", "label")
        .mapInArrow(counts, "token string, toxic long, clean long")
        .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def log_odds(
    counts: DataFrame, *, prior: float, significance: float, toxic_share: float
) -> DataFrame:
    """``token, log_odds`` of tokens that are significantly toxic.

    The Dirichlet prior gives a token half an occurrence, and ``prior`` times its share of
    all occurrences, in each class.  A token must be in so many toxic texts that less than
    one of the tokens tested would be in as many toxic ones, and no others, by chance; its
    log-odds must be ``significance * log(tokens tested)`` standard errors above zero.
    """
    tested = F.count(F.when(F.col("toxic") + F.col("clean") >= 3, 1))
    totals = counts.agg(F.sum("toxic"), F.sum("clean"), tested)
    n1, n0, tested = (float(x or 0) for x in totals.first())
    least = max(3, math.ceil(math.log(max(tested, 1)) / -math.log(min(toxic_share, 0.5))))
    a = 0.5 + prior * (F.col("toxic") + F.col("clean")) / F.lit(max(n1 + n0, 1.0))
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(y1 / (n1 + prior)) - F.log(y0 / (n0 + prior))
    return (
        counts.where(F.col("toxic") >= least)
        .withColumn("log_odds", delta)
        .where(F.col("log_odds") / F.sqrt(1 / y1 + 1 / y0)
               >= significance * math.log(max(tested, 2)))
        .select("token", "log_odds")
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, column: str, most: int, name: str
) -> DataFrame:
    """``text, label`` of training rows, stored: each text once, about ``most`` rows.

    Rows held out (see ``held_out``) and rows without a label are never used.  If there are
    more labelled rows than ``most``, a share of them is taken by a hash of the id.
    """
    known = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    n = known.count()
    if n > most:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < 1_000_000 * most // n)
    # at most about ``most`` ids, so the text stays where it is read
    joined = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias(
        "text")).join(F.broadcast(known), "doc_id")
    once = joined.groupBy(F.md5(F.col("text")).alias("h")).agg(
        F.first("text").alias("text"), F.max("label").alias("label"))
    return stored(once.select("text", "label"), name)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, column: str = "toxic", sample_rows: int = 16_000,
    prior: float = 1000.0, significance: float = 0.35, drift: float = 0.5,
) -> ToxicityModel:
    """Fit on about ``sample_rows`` labelled rows at most (documented bound).

    Without labelled rows of both classes the model finds nothing and scores below 0.5.  Null
    texts count as empty; rows without a label of 0 or 1, without an id or held out are not
    used; of equal texts, or labels of one id, the toxic label counts.  Empty tables give a model
    that finds nothing.
    """
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, column, sample_rows, "toxicity-sample")
    size = sample.groupBy("label").count().toPandas().set_index("label")["count"]
    if len(size) < 2:
        return ToxicityModel({}, drift)
    share = float(size[1] / size.sum())
    lexicon = dict(
        (r.token, r.log_odds)
        for r in log_odds(
            count_tokens_by_class(sample), prior=prior, significance=significance,
            toxic_share=share
        ).collect()  # bounded by the sample
    )
    model = ToxicityModel(lexicon, drift)
    seen = _segments_of(sample, model).toPandas()  # one row per sampled text
    clean = seen[seen.label == 0]
    model.rate, model.scale = extreme_values(
        clean.best.to_numpy(), clean.n_words.to_numpy(), drift)
    x = np.array([model.evidence(b, n) for b, n in zip(seen.best, seen.n_words)])
    model.slope, model.base = _logistic(np.minimum(x, 60.0), seen.label.to_numpy(float))
    return model


def extreme_values(best: np.ndarray, n_words: np.ndarray, drift: float) -> tuple[float, float]:
    """Constants of the law: chance segments above ``s`` in ``n`` words are ``K n exp(-l s)``.

    The rate is the inverse mean of the best scores above the drift, the scale follows from
    how many documents have one; both are smoothed by one expected document.
    """
    over = best[best > drift] - drift
    rate = (len(over) + 1) / (over.sum() + 1.0)
    rate = float(np.clip(rate, 0.2, 1.0))
    scale = (len(over) + 1) / max(float(n_words.sum()), 1.0) * math.exp(rate * drift)
    return rate, scale


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (not negative) and constant of a lightly ridged logistic regression."""
    a = np.column_stack([x, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (y - p) - 0.5 * w
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(2)
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def _segments_of(sample: DataFrame, model: ToxicityModel) -> DataFrame:
    def rows(batches):
        scanner = Scanner(model)
        for batch in parts(batches, "text"):
            n, best = [], []
            for raw in byte_texts(batch, "text"):
                words, found = scanner.scan(raw.decode("utf-8", "replace"))
                n.append(words)
                best.append(max((s for _, _, s in found), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(n, pa.int64()), pa.array(best, pa.float64())],
                ["label", "n_words", "best"])

    return sample.select("text", "label").mapInArrow(
        rows, "label int, n_words long, best double")


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, limit: float = 0.5) -> DataFrame:
    """Per row: ``doc_id, score, predicted, passages``.

    ``passages``: every significant passage as first and last word (from 0), its score and
    the number of equally good ones to expect by chance.  A null or empty text has no
    words, no passages and the lowest score.  Repeated rows are scored row by row, null ids
    are kept, other columns are ignored; an empty table gives an empty result.  No shuffle.
    """
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by the fitting sample
    kind = docs.schema["doc_id"].dataType.simpleString()
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()),
                         ("by_chance", pa.float64())])

    def rows(batches):
        m = shared.value
        scanner = Scanner(m)
        for batch in parts(batches, "text"):
            scores, passages = [], []
            for raw in byte_texts(batch, "text"):
                n, found = scanner.scan(raw.decode("utf-8", "replace"))
                best = max((s for _, _, s in found), default=0.0)
                scores.append(m.probability(m.evidence(best, n)))
                passages.append([
                    (f, l, s, m.chance(s, n)) for f, l, s in found
                    if m.chance(s, n) <= m.significant])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(scores, pa.float64()),
                    pa.array([int(s >= limit) for s in scores], pa.int32()),
                    pa.array([[dict(zip(("first", "last", "score", "by_chance"), p)) for p in ps]
                              for ps in passages], pa.list_(passage)),
                ],
                ["doc_id", "score", "predicted", "passages"],
            )

    return docs.selectExpr("doc_id", "CAST(text AS STRING) AS text").mapInArrow(
        rows, f"doc_id {kind}, score double, predicted int, "
        "passages array<struct<first:int,last:int,score:double,by_chance:double>>")


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that ``score_toxicity`` does not predict toxic.

    Null and empty texts stay, repeated rows are judged row by row, columns may have any name;
    an empty table gives an empty result."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def keep():
        m = shared.value
        scanner = Scanner(m)

        def passes(texts):
            for raw in texts:
                n, found = scanner.scan(raw.decode("utf-8", "replace"))
                best = max((s for _, _, s in found), default=0.0)
                yield m.probability(m.evidence(best, n)) < limit

        return lambda texts: list(passes(texts))

    return filtered(docs, keep)
