"""Models that are group means: constants and saturated cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from counterfold.functions.scalar import quoted
from counterfold.models.base import (
    BROADCAST_CELLS,
    WEIGHT,
    CrossFit,
    ExpressionFit,
    FitFailed,
    Frame,
    Model,
    Request,
    join_cells,
    literal,
)


@dataclass(frozen=True)
class Constant(Model):
    """The mean of the target, or the share of each of its levels."""

    cells = True

    def fit(self, frame: Frame):
        return self._fits(frame, None)[None]

    def fit_cross(self, frame: Frame):
        return CrossFit(frame.folds[0], self._fits(frame, frame.folds[0]))

    def _fits(self, frame: Frame, fold: str | None) -> dict:
        """Sums per fold (K rows); a training set is the total less its fold."""
        shares = frame.levels or ()
        aggs = [
            F.sum(WEIGHT).alias("w"),
            F.sum(F.col(WEIGHT) * frame.y).alias("wy"),
            *[
                F.sum(F.when(quoted(frame.target) == literal(v, frame.kinds[frame.target]),
                             F.col(WEIGHT)).otherwise(0.0)).alias(f"l{i}")
                for i, v in enumerate(shares)
            ],
        ]
        names = ["w", "wy", *[f"l{i}" for i in range(len(shares))]]
        grouped = frame.df.groupBy(F.col(fold)) if fold else frame.df.groupBy()
        rows = [(r[fold] if fold else None, [r[c] or 0.0 for c in names])
                for r in grouped.agg(*aggs).collect()]
        total = [sum(v[i] for _, v in rows) for i in range(len(names))]
        out = {}
        for k in frame.fold_numbers() if fold else [None]:
            own = dict(rows).get(k, [0.0] * len(names)) if fold else [0.0] * len(names)
            left = [t - o for t, o in zip(total, own)]
            if left[0] <= 0:
                raise FitFailed(f"no rows to learn {frame.target}")
            probs = {v: s / left[0] for v, s in zip(shares, left[2:])}
            out[k] = ConstantFit(left[1] / left[0], probs)
        return out


@dataclass(frozen=True)
class ConstantFit(ExpressionFit):
    mean: float
    shares: dict

    def expression(self, r: Request) -> Column:
        return F.lit(float(self.mean if r.level is None else self.shares.get(r.level, 0.0)))


@dataclass(frozen=True)
class Saturated(Model):
    """One mean per cell of discrete parents.

    ``on`` keeps only some of the covariates in the cells (treatments that a request
    fixes always count).  Every estimator built on it is a few grouped sums.
    """

    on: tuple[str, ...] | None = None
    cells = True

    def _cells(self, frame: Frame) -> tuple[str, ...]:
        covariates = [p for p in frame.parents if p not in frame.treatments]
        if self.on is None:
            return tuple(covariates)
        unknown = [c for c in self.on if c not in covariates]
        if unknown:
            raise FitFailed(f"cells {unknown} are not covariates of {frame.target}")
        return tuple(self.on)

    def fit(self, frame: Frame):
        return SaturatedFit(frame, self._cells(frame), None)

    def fit_cross(self, frame: Frame):
        return SaturatedFit(frame, self._cells(frame), frame.folds[0])


class SaturatedFit:
    def __init__(self, frame: Frame, on: tuple[str, ...], fold: str | None):
        self.frame, self.on, self.fold = frame, on, fold
        self.tables: list[DataFrame] = []

    def release(self):
        for t in self.tables:
            t.unpersist()
        self.tables = []

    def _sums(self, r: Request) -> tuple[Column, Column]:
        """(weighted sum, weight) whose ratio is the prediction."""
        f = self.frame
        if r.level is not None:
            hit = quoted(f.target) == literal(r.level, f.kinds[f.target])
            return F.sum(F.when(hit, F.col(WEIGHT)).otherwise(0.0)), F.sum(WEIGHT)
        test = None
        for c in f.treatments:
            if c in r.override:
                t = quoted(c) == literal(r.override[c], f.kinds[c])
                test = t if test is None else test & t
        n, y = F.col(WEIGHT), F.col(WEIGHT) * f.y
        if test is not None:
            n, y = F.when(test, n), F.when(test, y)
        return F.sum(y), F.sum(n)

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        # A treatment that a request leaves as observed is one more cell column.
        groups: dict[tuple, list[Request]] = {}
        for r in requests:
            free = tuple(
                t for t in self.frame.treatments if r.level is None and t not in r.override
            )
            groups.setdefault(free, []).append(r)
        for free, part in groups.items():
            df = self._add(df, part, (*self.on, *free))
        return df

    def _add(self, df: DataFrame, requests: Sequence[Request], on: tuple) -> DataFrame:
        by = [*on, *([self.fold] if self.fold else [])]
        aggs = []
        for i, r in enumerate(requests):
            num, den = self._sums(r)
            aggs += [F.coalesce(num, F.lit(0.0)).alias(f"__a{i}"),
                     F.coalesce(den, F.lit(0.0)).alias(f"__d{i}")]
        table = self.frame.df.groupBy(*[quoted(c) for c in by]).agg(*aggs)
        if self.fold:
            # Training sums are those of the whole cell less those of the fold; a
            # window group has one row per fold.
            w = Window.partitionBy(*[quoted(c) for c in on])
            table = table.withColumns(
                {
                    c: F.sum(c).over(w) - F.col(c)
                    for i in range(len(requests))
                    for c in (f"__a{i}", f"__d{i}")
                }
            )
        outs = {
            r.out: F.when(F.col(f"__d{i}") > 0, F.col(f"__a{i}") / F.col(f"__d{i}"))
            for i, r in enumerate(requests)
        }
        table = table.select(*[quoted(c) for c in by], *[e.alias(n) for n, e in outs.items()])
        if not by:
            row = table.first()
            return df.withColumns({n: F.lit(row[n]).cast("double") for n in outs})
        bound = self.frame.n_folds if self.fold else 1
        for c in on:
            k = self.frame.kinds[c]
            bound *= len(k.levels) + 1 if k.levels is not None else BROADCAST_CELLS + 1
        joined, kept = join_cells(df, table, by, bound)
        if kept is not None:
            self.tables.append(kept)
        return joined
