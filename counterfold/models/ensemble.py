"""Stacks of models and models tuned over a grid."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.models.base import Frame, Model, Request, release, transforms
from counterfold.models.linear import Linear, Logistic
from counterfold.models.trees import CrossTreeFit, Trees, fit_trees, held_out_losses
from counterfold.operators.schema import ColumnProfile


@dataclass(frozen=True)
class Tuned(Model):
    """Boosted trees with the depth and leaf penalty of the smallest held-out loss (root mean
    square for numbers, log-loss for classes), refitted on all rows.  All settings and folds
    grow together; of equal losses the first setting wins."""

    model: Trees = Trees()
    max_depth: tuple[int, ...] = (3, 4, 5, 6, 7)
    penalty: tuple[float, ...] = (1e-5, 1e-3, 1e-1, 10.0)
    depth = 1

    def settings(self) -> list[Trees]:
        return [replace(self.model, max_depth=d, penalty=p)
                for d in self.max_depth for p in self.penalty]

    def best(self, frame: Frame, fold: str, outer: list[tuple]) -> list[Trees]:
        """The best setting for each of the outer hidden folds."""
        grid, numbers = self.settings(), list(frame.fold_numbers())
        asked = [(m, (*hidden, (fold, k))) for hidden in outer for m in grid for k in numbers]
        losses = iter(held_out_losses(frame, asked))
        chosen = []
        for _ in outer:
            found = [[next(losses) for _ in numbers] for _ in grid]
            means = [sum(x for x, _ in own) / max(sum(n for _, n in own), 1e-300) for own in found]
            chosen.append(grid[means.index(min(means))])
        return chosen

    def fit(self, frame: Frame):
        chosen = self.best(frame, frame.folds[0], [()])
        return fit_trees(frame, [(chosen[0], ())])[0]

    def fit_cross(self, frame: Frame):
        name, inner = frame.folds[0], frame.folds[1]
        numbers = list(frame.fold_numbers())
        outer = [((name, k),) for k in numbers]
        fits = fit_trees(frame, list(zip(self.best(frame, inner, outer), outer)))
        return CrossTreeFit(name, dict(zip(numbers, fits)))


@dataclass(frozen=True)
class Stack(Model):
    """Members predict the folds they have not seen; a model without intercept learns
    to combine those predictions; members are then refitted on all rows."""

    members: tuple[tuple[str, Model], ...]
    metalearner: Model | None = None

    @property
    def depth(self) -> int:
        return 1 + max(m.depth for _, m in self.members)

    @property
    def cells(self) -> bool:
        return all(m.cells for _, m in self.members)

    def _trees(self, frame: Frame) -> dict[int, tuple]:
        """Cross-fit and fit of each member that is plain trees, all grown together."""
        at = [i for i, (_, m) in enumerate(self.members) if isinstance(m, Trees)]
        if not at:
            return {}
        name, numbers = frame.folds[0], list(frame.fold_numbers())
        hidden = [*[((name, k),) for k in numbers], ()]
        fits = iter(fit_trees(frame, [(self.members[i][1], h) for i in at for h in hidden]))
        out = {}
        for i in at:
            own = [next(fits) for _ in hidden]
            out[i] = CrossTreeFit(name, dict(zip(numbers, own))), own[-1]
        return out

    def fit(self, frame: Frame):
        names = [f"__z{i}" for i in range(len(self.members))]
        df = frame.df
        scores = list(frame.levels) if frame.task == "multi" else [None]
        columns = [f"{z}_{j}" for z in names for j in range(len(scores))]
        crossed = []
        together = self._trees(frame)
        for at, ((_, m), z) in enumerate(zip(self.members, names)):
            c = together[at][0] if at in together else m.fit_cross(frame)
            df = c.add(df, [Request(f"{z}_{j}", level=v) for j, v in enumerate(scores)])
            crossed.append(c)
        kinds = dict(frame.kinds) | {c: _number(c) for c in columns}
        df = df.persist()
        try:
            meta = self.metalearner
            if meta is None:
                meta = (
                    Linear(intercept=False)
                    if frame.task == "regression"
                    else Logistic(intercept=False)
                )
            combined = meta.fit(
                replace(frame, df=df, parents=tuple(columns), kinds=kinds, folds=())
            )
        finally:
            df.unpersist()
            for c in crossed:
                release(c)
        # Same sequence of folds as the cross-fits had left.
        inner = replace(frame, folds=frame.folds[1:])
        fitted = frame.each(
            lambda at: together[at][1] if at in together else self.members[at][1].fit(inner),
            range(len(self.members)))
        return StackFit(tuple(n for n, _ in self.members), fitted, combined, scores, names)


def _number(name: str) -> ColumnProfile:
    return ColumnProfile(name, T.DoubleType(), 0, 0, 0, None, 0)


@dataclass(frozen=True)
class StackFit:
    labels: tuple[str, ...]
    fitted: list
    combined: object
    scores: list
    names: list[str]

    def release(self):
        for f in self.fitted:
            release(f)

    def transforms(self) -> int:
        return sum(transforms(f) for f in self.fitted)

    def weights(self) -> dict[str, float]:
        """Coefficient of each member (single-score targets)."""
        return dict(zip(self.labels, self.combined.coefs))

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        for r in requests:
            keep = df.columns
            for f, z in zip(self.fitted, self.names):
                asked = [
                    Request(f"{z}_{j}", r.override, v) for j, v in enumerate(self.scores)
                ]
                df = f.add(df, asked)
            df = self.combined.add(df, [Request(r.out, {}, r.level)])
            df = df.select(*[F.col(f"`{c}`") for c in keep], r.out)
        return df
