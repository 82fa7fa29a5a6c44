"""Boosted trees as nuisance models: settings, fits of many at once, predictions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfold.functions.scalar import quoted
from counterfold.models.base import Design, FitFailed, Frame, Model, Request
from counterfold.models.boosting import Ensemble, Job, Task, boost, to_bins

#: Scores a task remembers per ensemble before it starts anew.
REMEMBERED = 1 << 16
LOSSES = {"regression": "squared", "binary": "logistic", "multi": "softmax"}


@dataclass(frozen=True)
class Trees(Model):
    """Gradient boosted trees on binned features (see ``boosting``)."""

    rounds: int = 100
    max_depth: int = 6
    eta: float = 0.3
    penalty: float = 1.0
    least_weight: float = 1.0
    max_bins: int = 256
    interactions: object = False

    def job(self, hidden: tuple[tuple[str, int], ...] = ()) -> Job:
        return Job(self.rounds, self.max_depth, self.eta, self.penalty, self.least_weight, hidden)

    def fit(self, frame: Frame):
        return fit_trees(frame, [(self, ())])[0]

    def fit_cross(self, frame: Frame):
        name = frame.folds[0]
        numbers = list(frame.fold_numbers())
        fits = fit_trees(frame, [(self, ((name, k),)) for k in numbers])
        return CrossTreeFit(name, dict(zip(numbers, fits)))


def _boosted(frame: Frame, models: Sequence[tuple[Trees, tuple]], keep: bool):
    """All models over the same design in one go."""
    first = models[0][0]
    design = Design(frame.parents, frame.kinds, frame.treatments, first.interactions)
    if frame.task == "multi":
        targets = [(quoted(frame.target) == F.lit(v)).cast("double") for v in frame.levels]
    else:
        targets = [frame.y]
    for m, _ in models:
        m.check(frame)
    try:
        cuts, fits = boost(
            frame.df, design.columns(), targets, frame.weight, LOSSES[frame.task],
            [m.job(hidden) for m, hidden in models], max_bins=first.max_bins, keep=keep)
    except ValueError as e:
        raise FitFailed(f"{frame.target}: {e}") from e
    return design, cuts, fits


def fit_trees(frame: Frame, models: Sequence[tuple[Trees, tuple]]) -> list[TreeFit]:
    """Fits of (trees, hidden folds); those with equal designs and bins grow together."""
    groups: dict = {}
    for at, (m, hidden) in enumerate(models):
        groups.setdefault((m.interactions, m.max_bins), []).append(at)
    out: list = [None] * len(models)
    for places in groups.values():
        design, cuts, fits = _boosted(frame, [models[i] for i in places], True)
        for i, (made, _, _) in zip(places, fits):
            out[i] = TreeFit(design, frame.task, cuts, made, frame.levels)
    return out


def held_out_losses(frame: Frame, models: Sequence[tuple[Trees, tuple]]) -> list[tuple[float, float]]:
    """Sum of losses and of weights of each model on the rows of its last hidden fold."""
    return [(loss, n) for _, loss, n in _boosted(frame, models, False)[2]]


def _scores(ensembles: dict[int, Ensemble], cuts: dict[int, list], task: str):
    """A function of feature columns, and of a fold column if there are several ensembles."""
    loss = LOSSES[task]

    # per ensemble: numbers of the bins met so far in ascending order, and their scores
    met: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def fresh(k, bins: np.ndarray) -> np.ndarray:
        made = ensembles[k]
        whole = Task(loss, len(made.base), (), 1.0, 1.0)
        return whole.chances(made.margins(bins))

    def one(k, columns: list[np.ndarray], n: int) -> np.ndarray:
        bins, widths = to_bins(columns, cuts[k], n), [len(c) + 1 for c in cuts[k]]
        if math.prod(widths) >= 1 << 62:
            return fresh(k, bins)
        # rows in the same bins have the same score: each is worked out once
        steps = [math.prod(widths[:i]) for i in range(len(widths))]
        codes, first, back = np.unique(
            bins.astype(np.int64) @ np.array(steps, np.int64), return_index=True, return_inverse=True)
        known, values = met.get(k, (codes[:0], np.zeros((0, len(ensembles[k].base)))))
        new = ~np.isin(codes, known)
        if new.any():
            if len(known) > REMEMBERED:
                known, values, new = known[:0], values[:0], np.ones(len(codes), bool)
            known = np.concatenate([known, codes[new]])
            values = np.concatenate([values, fresh(k, bins[first[new]])])
            order = np.argsort(known)
            met[k] = known, values = known[order], values[order]
        return values[np.searchsorted(known, codes)][back]

    def scores(fold: pd.Series, *columns: pd.Series) -> pd.Series:
        values = [c.to_numpy(dtype=float, na_value=np.nan) for c in columns]
        classes = len(next(iter(ensembles.values())).base)
        out = np.full((len(fold), classes), np.nan)
        for k in ensembles:
            rows = np.flatnonzero(fold.to_numpy() == k)
            p = len(cuts[k])
            out[rows] = one(k, [v[rows] for v in values[:p]], len(rows))
        return pd.Series(list(out))

    return scores


def _add(df: DataFrame, requests: Sequence[Request], design: Design, task: str, levels,
         fold: Column, ensembles: dict[int, Ensemble], cuts: dict[int, list]) -> DataFrame:
    udf = F.pandas_udf(_scores(ensembles, cuts, task), "array<double>")
    keep, made = [quoted(c) for c in df.columns], {}
    for r in requests:
        setting = tuple(sorted(r.override.items(), key=lambda kv: kv[0]))
        if setting not in made:
            columns = [c.cast("double") for c in design.columns(dict(setting))]
            made[setting] = udf(fold, *columns).alias(f"__tree{len(made)}")
    names = {s: f"__tree{i}" for i, s in enumerate(made)}
    out = df.select(*keep, *made.values())
    values = []
    for r in requests:
        scores = F.col(names[tuple(sorted(r.override.items(), key=lambda kv: kv[0]))])
        if task == "multi":
            value = F.get(scores, F.lit(levels.index(r.level)))
        else:
            value = F.get(scores, F.lit(0))
            if r.level is not None and r.level == levels[0]:
                value = F.lit(1.0) - value
        values.append(value.alias(r.out))
    return out.select(*keep, *values)


@dataclass(frozen=True)
class TreeFit:
    design: Design
    task: str
    cuts: list
    made: Ensemble
    levels: tuple | None

    def transforms(self) -> int:
        return 1

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        return _add(df, requests, self.design, self.task, self.levels, F.lit(0),
                    {0: self.made}, {0: self.cuts})


@dataclass(frozen=True)
class CrossTreeFit:
    """Each row is predicted by the trees that have not seen its fold, in one pass."""

    fold: str
    fitted: dict[int, TreeFit]

    def release(self) -> None:
        """Nothing is kept outside the driver."""

    def transforms(self) -> int:
        return 1

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        first = next(iter(self.fitted.values()))
        return _add(df, requests, first.design, first.task, first.levels, F.col(self.fold),
                    {k: f.made for k, f in self.fitted.items()},
                    {k: f.cuts for k, f in self.fitted.items()})
