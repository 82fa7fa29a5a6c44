"""From predictions to estimates: sums over a frame of weighted rows.

A row stands for ``__n`` units with outcome mean ``y`` and squared spread ``v``
(sum of squared deviations); for plain rows n = 1 and v = 0.  With that, one set of
formulas serves single rows and compressed cells alike.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfold.models.base import WEIGHT
from counterfold.models.moments import gram

# Terms summed by one aggregation; more would outgrow compiled methods.
SUMS_PER_PASS = 48
PASSES_AT_ONCE = 4
# Outcome probabilities are kept this far from 0 and 1 before the logit.
PROBABILITY_EDGE = 1e-6
FLUCTUATION_PASSES = 15


def _num(x: float) -> str:
    return f"({float(x)!r}D)"


def _add(parts: Sequence[str]) -> str:
    return "(" + " + ".join(parts) + ")"


@dataclass
class Effect:
    """One (question, estimator) as SQL expressions over a predicted frame.

    Per signed treatment setting: its sign, the flag column of rows that have it, the
    column of the predicted outcome and the product of propensities.
    """

    signs: list[int]
    hits: list[str]
    q: list[str]
    g: list[str]
    y: str
    v: str
    lower: float
    kind: str  # tmle | ose
    weighted: bool
    binary: bool
    eps: float = 0.0
    shift: float = 0.0

    def _bounded(self) -> list[str]:
        return [f"greatest({g}, {_num(self.lower)})" for g in self.g]

    def plug_in(self) -> str:
        return _add([f"{_num(s)} * {q}" for s, q in zip(self.signs, self.q)])

    def _pick(self, values: Sequence[str]) -> str:
        whens = " ".join(f"WHEN {h} THEN {v}" for h, v in zip(self.hits, values))
        return f"(CASE {whens} ELSE 0.0D END)"

    def clever(self) -> str:
        """Signed inverse propensity of the setting a row has; 0 if it has none."""
        return self._pick([f"{_num(s)} / {g}" for s, g in zip(self.signs, self._bounded())])

    def observed(self) -> str:
        return self._pick(self.q)

    def covariate_and_weight(self) -> tuple[str, str]:
        if not self.weighted:
            return self.clever(), "1.0D"
        sign = self._pick([_num(s) for s in self.signs])
        return sign, self._pick([f"1.0D / {g}" for g in self._bounded()])

    def _moved(self, q: str, x: str) -> str:
        """Outcome prediction after the fluctuation."""
        if not self.binary:
            return f"({q} + {_num(self.eps)} * {x})"
        edge = f"least(greatest({q}, {_num(PROBABILITY_EDGE)}), {_num(1 - PROBABILITY_EDGE)})"
        return f"(1.0D / (1.0D + exp(-(ln({edge} / (1.0D - {edge})) + {_num(self.eps)} * {x}))))"

    def targeted_plug_in(self) -> str:
        if self.kind == "ose":
            return self.plug_in()
        parts = []
        for s, q, g in zip(self.signs, self.q, self._bounded()):
            x = _num(s) if self.weighted else f"({_num(s)} / {g})"
            parts.append(f"{_num(s)} * {self._moved(q, x)}")
        return _add(parts)

    def fitted(self) -> str:
        """Targeted prediction at the setting a row has."""
        if self.kind == "ose":
            return self.observed()
        x, _ = self.covariate_and_weight()
        return self._moved(self.observed(), x)

    def uncentred(self) -> str:
        """Influence value plus the estimate."""
        return f"({self.targeted_plug_in()} + {self.clever()} * ({self.y} - {self.fitted()}))"

    def holes(self) -> str:
        """1 where a needed prediction is missing."""
        tests = " OR ".join(f"{c} IS NULL OR isnan({c})" for c in [*self.q, *self.g])
        return f"(CASE WHEN {tests} THEN 1 ELSE 0 END)"

    def clipped(self) -> str:
        tests = " OR ".join(f"{g} < {_num(self.lower)}" for g in self.g)
        return f"(CASE WHEN {tests} THEN 1 ELSE 0 END)"

    def smallest_g(self) -> str:
        return f"least({', '.join(self.g)})" if len(self.g) > 1 else self.g[0]


@dataclass(frozen=True)
class Answer:
    estimate: float
    std: float
    n: int
    clipped: int
    min_g: float
    eps: float
    failed: str | None = None

    @property
    def se(self) -> float:
        return self.std / math.sqrt(self.n)


def sums(df: DataFrame, expressions: Sequence[str]) -> list:
    """Global sums in chunks.  The first chunk also fills the cache of the frame; the
    others then run side by side over it."""
    chunks = [
        expressions[i : i + SUMS_PER_PASS] for i in range(0, len(expressions), SUMS_PER_PASS)
    ]

    def one(part):
        return list(df.agg(*[F.expr(c).alias(f"s{i}") for i, c in enumerate(part)]).first())

    out = one(chunks[0])
    if len(chunks) > 1:
        with ThreadPoolExecutor(min(PASSES_AT_ONCE, len(chunks) - 1)) as pool:
            for got in pool.map(one, chunks[1:]):
                out += got
    return out


def estimate(
    df: DataFrame, effects: Sequence[Effect], joint: Sequence[Sequence[int]] = ()
) -> tuple[list[Answer], dict[tuple[int, int], float]]:
    """Estimates of all effects together, and covariances of the influence values of the
    index pairs inside each group of ``joint``: three passes, however many pairs there are."""
    if not effects:
        return [], {}
    n = WEIGHT
    first = [f"sum({n})"]
    for e in effects:
        x, w = e.covariate_and_weight()
        raw = f"({e.y} - {e.observed()})"
        first += [
            f"sum({n} * {e.holes()})",
            f"sum({n} * {e.clipped()})",
            f"min({e.smallest_g()})",
            f"sum({n} * ({e.plug_in()} + {e.clever()} * {raw}))",
        ]
        # Only a linear fluctuation is a ratio of two sums.
        linear = e.kind == "tmle" and not e.binary
        first += [
            f"sum({n} * {w} * {x} * {raw})" if linear else "0.0D",
            f"sum({n} * {w} * {x} * {x})" if linear else "0.0D",
        ]
    got = sums(df, first)
    total = got[0] or 0.0
    per = [got[1 + 6 * i : 7 + 6 * i] for i in range(len(effects))]
    problems: list[str | None] = []
    for e, (holes, _, _, ose, num, den) in zip(effects, per):
        if total < 2:
            problems.append("too few complete rows")
        elif holes:
            problems.append(
                f"{int(holes)} rows belong to cells where a treatment setting never occurs"
            )
        elif ose is None or not math.isfinite(ose):
            problems.append("the sums are not finite")
        else:
            problems.append(None)
            e.shift = ose / total
            if e.kind == "tmle" and not e.binary:
                e.eps = num / den if den else 0.0
    unfinished = _logistic_fluctuations(df, [
        e for e, p in zip(effects, problems) if p is None and e.kind == "tmle" and e.binary
    ])
    for i, e in enumerate(effects):
        if any(e is u for u in unfinished):
            problems[i] = "the fluctuation did not converge"
    live = [i for i, p in enumerate(problems) if p is None]
    second: list[str] = []
    for i in live:
        e = effects[i]
        u = f"({e.uncentred()} - {_num(e.shift)})"
        second += [
            f"sum({n} * {e.targeted_plug_in()})",
            f"sum({n} * {u})",
            f"sum({n} * {u} * {u})",
            f"sum({e.clever()} * {e.clever()} * {e.v})",
        ]
    got = sums(df, second) if second else []
    answers: list[Answer] = [
        Answer(math.nan, math.nan, int(total), 0, math.nan, 0.0, p or "failed") for p in problems
    ]
    offset: dict[int, float] = {}
    for at, i in enumerate(live):
        e = effects[i]
        plug, u, uu, spread = got[4 * at : 4 * at + 4]
        mean = u / total
        offset[i] = mean
        var = (uu + spread - total * mean * mean) / (total - 1)
        psi = plug / total if e.kind == "tmle" else e.shift + mean
        answers[i] = Answer(
            psi, math.sqrt(max(var, 0.0)), round(total), round(per[i][1]), per[i][2], e.eps
        )
    cov = {}
    for group in joint:
        own = [i for i in group if problems[i] is None]
        if len(own) > 1:
            cross = _cross_sums(df, [effects[i] for i in own])
            for x, i in enumerate(own):
                for y in range(x + 1, len(own)):
                    j = own[y]
                    cov[i, j] = float(cross[x, y] - total * offset[i] * offset[j]) / (total - 1)
    return answers, cov


def _cross_sums(df: DataFrame, effects: Sequence[Effect]) -> np.ndarray:
    """Sums of products of the centred influence values of all pairs, in one pass over the
    rows for any number of effects; cells add what varies inside them."""
    centred = [F.expr(f"({e.uncentred()} - {_num(e.shift)})") for e in effects]
    cross = gram(df, centred, F.expr(WEIGHT))
    inside = [F.expr(f"({e.clever()} * sqrt({e.v}))") for e in effects]
    within = gram(df, inside, F.lit(1.0))
    size = (len(effects), len(effects))
    return cross.get(0, np.zeros(size)) + within.get(0, np.zeros(size))


def _logistic_fluctuations(df: DataFrame, effects: Sequence[Effect]) -> list[Effect]:
    """One-coefficient logistic fits with an offset, all by Newton steps together.

    Returns the effects that still moved after the last pass.
    """
    live = list(effects)
    for _ in range(FLUCTUATION_PASSES):
        if not live:
            return []
        columns = []
        for e in live:
            x, w = e.covariate_and_weight()
            p = e.fitted()
            columns += [
                f"sum({WEIGHT} * {w} * {x} * ({e.y} - {p}))",
                f"sum({WEIGHT} * {w} * {x} * {x} * {p} * (1.0D - {p}))",
            ]
        got = sums(df, columns)
        still = []
        for i, e in enumerate(live):
            score, info = got[2 * i : 2 * i + 2]
            step = score / info if info else 0.0
            e.eps += max(min(step, 5.0), -5.0)
            if abs(step) > 1e-10 * (1.0 + abs(e.eps)):
                still.append(e)
        live = still
    return live
