"""Linear and logistic models, plain or with a cross-validated elastic-net penalty.

All are column expressions once fitted, so a counterfactual is the same expression
with a literal in place of the treatment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfold.functions.scalar import expit, quoted
from counterfold.models.base import (
    WEIGHT,
    CrossFit,
    Design,
    ExpressionFit,
    FitFailed,
    Frame,
    Model,
    Request,
    linear_combination,
)
from counterfold.models.moments import (
    gram,
    logistic_path,
    means_and_spread,
    near,
    penalised_quadratic,
    penalty_path,
    solve_least_squares,
    solve_through_origin,
)

# Fixed values of the penalty path: number of penalties, smallest over largest.
PATH_LENGTH = 100
PATH_RATIO = 1e-4
# The path ends when a smaller penalty explains this little more, or
# when this share of the variance is explained.
PATH_STOP_GAIN = 1e-5
PATH_STOP_SHARE = 0.999
# Unpenalised and ridge softmax models above this number of coefficients go to Spark's own solver.
SOFTMAX_COEFFICIENTS = 300


@dataclass(frozen=True)
class LinearFit(ExpressionFit):
    design: Design
    intercept: float
    coefs: tuple[float, ...]
    link: str = "identity"  # or logit
    penalty: float | None = None
    levels: tuple | None = None

    def score(self, override=None) -> Column:
        return linear_combination(self.design.columns(override), self.coefs, self.intercept)

    def expression(self, r: Request) -> Column:
        s = self.score(r.override)
        if self.link == "identity":
            return s
        p = expit(s)
        # Two-level treatments: the second level is the one modelled.
        return F.lit(1.0) - p if r.level is not None and r.level == self.levels[0] else p

    def table(self, spark) -> DataFrame:
        rows = [("(intercept)", float(self.intercept))]
        rows += [(n, float(b)) for n, b in zip(self.design.names, self.coefs)]
        return spark.createDataFrame(rows, "term string, coefficient double")


@dataclass(frozen=True)
class SoftmaxFit(ExpressionFit):
    design: Design
    intercepts: tuple[float, ...]
    coefs: tuple[tuple[float, ...], ...]
    levels: tuple
    penalty: float | None = None

    def expression(self, r: Request) -> Column:
        columns = self.design.columns(r.override)
        scores = [linear_combination(columns, b, a) for a, b in zip(self.intercepts, self.coefs)]
        top = F.greatest(*scores)
        parts = [F.exp(s - top) for s in scores]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        if r.level not in self.levels:
            return F.lit(0.0)
        return parts[self.levels.index(r.level)] / total


def _fold_gram(df, columns, y, weight, fold):
    """Product sums of (1, x - m, y - m) per fold, and the shifts m."""
    shift = near(df, [*columns, y])
    z = [F.lit(1.0)] + [c - F.lit(float(m)) for c, m in zip([*columns, y], shift)]
    return gram(df, z, weight, fold), shift


@dataclass(frozen=True)
class Linear(Model):
    """Ordinary least squares from one pass of product sums."""

    intercept: bool = True
    interactions: object = False
    cells = True
    tasks = ("regression",)

    def fit(self, frame: Frame):
        return self._fits(frame, None)[0]

    def fit_cross(self, frame: Frame):
        fits = self._fits(frame, frame.folds[0])
        return CrossFit(frame.folds[0], {k: f for k, f in fits.items() if k})

    def _fits(self, frame: Frame, fold: str | None) -> dict[int, LinearFit]:
        self.check(frame)
        design = Design(frame.parents, frame.kinds, frame.treatments, self.interactions)
        columns = design.columns()
        sums, shift = _fold_gram(frame.df, columns, frame.y, frame.weight, fold)
        if not sums:
            raise FitFailed(f"no rows to learn {frame.target}")
        total = sum(sums.values())
        out = {}
        for k in [0, *(frame.fold_numbers() if fold else [])]:
            g = total - sums[k] if k and k in sums else total
            if not np.all(np.isfinite(g)) or g[0, 0] <= 0:
                raise FitFailed(f"no finite rows to learn {frame.target}")
            if self.intercept:
                b0, b = solve_least_squares(g, True)
                b0 = b0 + shift[-1] - float(b @ shift[:-1])
            else:
                b0, b = 0.0, solve_through_origin(g, shift)
            out[k] = LinearFit(design, b0, tuple(map(float, b)))
        return out


def _label(frame: Frame) -> Column:
    """Share of 1, or the number of the level."""
    if frame.task != "multi":
        return frame.y
    levels = F.array(*[F.lit(v) for v in frame.levels])
    return (F.array_position(levels, quoted(frame.target)) - 1).cast("double")


def _logistic_rows(frame: Frame, columns: Sequence[Column], means, sds, fold: str | None):
    scaled = [
        ((c - F.lit(float(m))) / F.lit(float(s if s > 0 else 1.0))).alias(f"x{i + 1}")
        for i, (c, m, s) in enumerate(zip(columns, means, sds))
    ]
    k = F.col(fold).cast("int") if fold else F.lit(0)
    return frame.df.select(
        frame.weight.alias("w"), _label(frame).alias("y"), k.alias("k"), F.lit(1.0).alias("x0"), *scaled
    )


def _equal_rows_once(rows: DataFrame) -> DataFrame:
    """Rows alike in all but their weight as one: losses and their slopes are sums over rows, so
    a path of many passes costs what the different rows cost."""
    alike = [c for c in rows.columns if c != "w"]
    return rows.groupBy(*alike).agg(F.sum("w").alias("w")).select(*rows.columns)


def _unscale(beta, means, sds) -> tuple[float, tuple[float, ...]]:
    b = np.where(sds > 0, beta[1:] / np.where(sds > 0, sds, 1.0), 0.0)
    return float(beta[0] - b @ means), tuple(map(float, b))


def _fitted(frame: Frame, design: Design, beta, means, sds, penalty=None):
    if frame.task != "multi":
        b0, b = _unscale(beta, means, sds)
        return LinearFit(design, b0, b, "logit", penalty, frame.levels)
    rows = [_unscale(b, means, sds) for b in beta.reshape(len(frame.levels), -1)]
    return SoftmaxFit(
        design, tuple(a for a, _ in rows), tuple(b for _, b in rows), frame.levels, penalty
    )


def _classes(frame: Frame, design: Design) -> int:
    """Rows of coefficients; 0 when the curvature would be too large to send around."""
    if frame.task != "multi":
        return 1
    k = len(frame.levels)
    return k if k * (len(design.names) + 1) <= SOFTMAX_COEFFICIENTS else 0


def _hits(frame: Frame) -> list[Column]:
    if frame.task != "multi":
        return [frame.y]
    return [(quoted(frame.target) == F.lit(v)).cast("double") for v in frame.levels]


def _scales(frame: Frame, columns: Sequence[Column]):
    """Means and spreads of the columns, and the shares of the target's levels."""
    hits = _hits(frame)
    means, sds = means_and_spread(frame.df, [*columns, *hits], frame.weight)
    shares = means[len(columns) :]
    if frame.task == "multi" and not all(shares > 0):
        raise FitFailed(f"{frame.target} lacks some of its levels")
    if not all((shares > 0) & (shares < 1)):
        raise FitFailed(f"{frame.target} has a single class")
    return means[: len(columns)], sds[: len(columns)], shares


@dataclass(frozen=True)
class Logistic(Model):
    """Logistic regression; ``penalty`` is a ridge weight on the coefficients of the
    mean loss.  More than two levels give a softmax model."""

    penalty: float = 0.0
    intercept: bool = True
    interactions: object = False
    cells = True
    tasks = ("binary", "multi")

    def fit(self, frame: Frame):
        return self._fits(frame, None)[0]

    def fit_cross(self, frame: Frame):
        fits = self._fits(frame, frame.folds[0])
        if 0 in fits and len(fits) == 1:
            return Model.fit_cross(self, frame)
        return CrossFit(frame.folds[0], {k: f for k, f in fits.items() if k})

    def _fits(self, frame: Frame, fold: str | None) -> dict:
        self.check(frame)
        design = Design(frame.parents, frame.kinds, frame.treatments, self.interactions)
        classes = _classes(frame, design)
        if not classes:
            if fold:
                return {0: None}
            return {
                0: _softmax(frame, design, self.penalty, self.intercept, not self.penalty)
            }
        columns = design.columns()
        means, sds, _ = _scales(frame, columns)
        if not self.intercept or self.penalty:
            means, sds = np.zeros(len(columns)), np.ones(len(columns))
        rows = _logistic_rows(frame, columns, means, sds, fold).persist()
        left_out = [-1, *(frame.fold_numbers() if fold else [])]
        try:
            betas, _, converged = logistic_path(
                rows, len(columns) + 1, [(k, 0.0, self.penalty) for k in left_out],
                self.intercept, classes,
            )
            if not all(converged):
                raise FitFailed(f"the logistic fit of {frame.target} did not converge")
        except ValueError as e:
            raise FitFailed(str(e)) from None
        finally:
            rows.unpersist()
        return {
            max(k, 0): _fitted(frame, design, beta, means, sds)
            for k, beta in zip(left_out, betas)
        }


@dataclass(frozen=True)
class ElasticNet(Model):
    """Elastic net whose penalty is chosen by cross-validation over the frame's folds.

    Continuous targets: per-fold product sums, then the whole path and its held-out
    error from those sums.  Classes: all penalties and folds move together, a few passes over
    the rows, however many columns and levels there are.
    """

    alpha: float = 1.0
    interactions: object = False
    penalties: int | None = None
    ratio: float = PATH_RATIO
    depth = 1
    cells = True

    def fit(self, frame: Frame):
        self.check(frame)
        design = Design(frame.parents, frame.kinds, frame.treatments, self.interactions)
        if not frame.folds:
            raise FitFailed("the elastic net needs a fold column")
        if frame.task == "regression":
            return self._squared(frame, design)
        return self._logistic(frame, design)

    def _squared(self, frame: Frame, design: Design) -> LinearFit:
        columns = design.columns()
        sums, shift = _fold_gram(frame.df, columns, frame.y, frame.weight, frame.folds[0])
        if not sums:
            raise FitFailed(f"no rows to learn {frame.target}")
        path = EnetPath(sums, self.alpha, self.penalties or PATH_LENGTH, self.ratio)
        b0, b = path.chosen()
        b0 = b0 + shift[-1] - float(b @ shift[:-1])
        return LinearFit(design, b0, tuple(map(float, b)), penalty=path.best_penalty)

    def _logistic(self, frame: Frame, design: Design):
        columns = design.columns()
        means, sds, shares = _scales(frame, columns)
        fold = frame.folds[0]
        rows = _equal_rows_once(_logistic_rows(frame, columns, means, sds, fold)).persist()
        left_out = [-1, *frame.fold_numbers()]
        try:
            top = self._largest_penalty(frame, columns, means, sds, shares)
            grid = np.geomspace(top, top * self.ratio, self.penalties or PATH_LENGTH)
            models = [
                (k, float(lam * self.alpha), float(lam * (1 - self.alpha)))
                for k in left_out
                for lam in grid
            ]
            classes = 1 if frame.task != "multi" else len(frame.levels)
            ends = partial(_path_end, shares=shares, task=frame.task)
            betas, held, done, losses = penalty_path(
                rows, len(columns) + 1, models, classes, end=ends)
        except ValueError as e:
            raise FitFailed(str(e)) from None
        finally:
            rows.unpersist()
        # Losses on the folds left out, weighted by the size of the fold.
        loss = np.zeros(len(grid))
        usable = np.ones(len(grid), dtype=bool)
        for i, (k, _, _) in enumerate(models):
            j = i % len(grid)
            if k >= 0:
                each, size = held.get(i, (np.nan, 1.0))
                if size:
                    usable[j] &= done[i] and np.isfinite(each)
                    loss[j] += size * each
        usable &= np.array(done[: len(grid)])
        usable[_path_end(losses[: len(grid)], shares, frame.task) :] = False
        if not usable.any():
            raise FitFailed("the mean loss is empty: no penalty converged in every fold")
        best = int(np.nanargmin(np.where(usable, loss, np.inf)))
        return _fitted(frame, design, betas[best], means, sds, float(grid[best]))

    def _largest_penalty(self, frame: Frame, columns, means, sds, shares) -> float:
        """The smallest penalty that leaves the intercepts alone."""
        hits = _hits(frame)
        terms = [
            frame.weight * (h - F.lit(float(p))) * (c - F.lit(float(m))) / F.lit(float(s or 1.0))
            for h, p in zip(hits, shares)
            for c, m, s in zip(columns, means, sds)
        ]
        total, *slopes = _sums(frame.df, [frame.weight, *terms])
        top = np.max(np.abs(slopes)) if terms else 1e-3
        return max(float(top) / total / max(self.alpha, 1e-3), 1e-9)


def _path_end(losses: np.ndarray, shares: np.ndarray, task: str) -> int:
    """How many penalties the path has: it ends where smaller ones explain no more."""
    p = shares if task == "multi" else np.array([shares[0], 1 - shares[0]])
    explained = 1 - losses / float(-(p * np.log(p)).sum())
    for i in range(6, len(losses)):
        gain = explained[i] - explained[i - 1]
        if gain < PATH_STOP_GAIN * explained[i] or explained[i] > PATH_STOP_SHARE:
            return i + 1
    return len(losses)


def _sums(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    out = []
    for start in range(0, len(columns), 60):
        part = columns[start : start + 60]
        row = df.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(part)]).first()
        out += [row[f"s{i}"] or 0.0 for i in range(len(part))]
    return np.array(out)


class EnetPath:
    """Penalty path and held-out squared error from per-fold product sums of
    (1, x, y)."""

    def __init__(
        self, sums: dict[int, np.ndarray], alpha: float, count: int, ratio: float, whole=False
    ):
        self.sums, self.alpha = sums, alpha
        total = sum(sums.values())
        if not np.all(np.isfinite(total)) or total[0, 0] <= 0:
            raise FitFailed("no finite rows")
        _, h, c, sy = self._scaled(total)
        top = float(np.max(np.abs(c))) / max(alpha, 1e-3) if len(c) else 1.0
        top = top or 1e-9
        rows = total[0, 0]
        if rows <= len(c):
            ratio = max(ratio, 1e-2)
        self.penalties = np.geomspace(top, top * ratio, count)
        self.path = self._fit(total, stop=not whole)
        self.penalties = self.penalties[: len(self.path)]
        errors = np.zeros(len(self.path))
        for k, own in sums.items():
            train = total - own
            if train[0, 0] <= 0:
                continue
            for i, (b0, b) in enumerate(self._fit(train)):
                v = np.concatenate([[-b0], -b, [1.0]])
                errors[i] += float(v @ own @ v)
        self.errors = errors / rows
        if not np.isfinite(self.errors).any():
            raise FitFailed("the mean loss is empty: no penalty converged in every fold")
        self.best = int(np.nanargmin(self.errors))
        self.best_penalty = float(self.penalties[self.best] * sy)

    def _scaled(self, g):
        """Standardised second moments: spread of x, correlations, spread of y."""
        n = g[0, 0]
        m = g[0, 1:] / n
        cov = g[1:, 1:] / n - np.outer(m, m)
        sd = np.sqrt(np.clip(np.diag(cov), 0, None))
        # A column without spread takes no part.
        flat = sd <= 1e-12 * (1.0 + np.abs(m))
        safe = np.where(flat, 1.0, sd)
        r = cov / np.outer(safe, safe)
        r[flat, :] = 0.0
        r[:, flat] = 0.0
        return (n, m, safe), r[:-1, :-1], r[:-1, -1], float(sd[-1])

    def _fit(self, g, stop: bool = False) -> list[tuple[float, np.ndarray]]:
        """One model per penalty; with ``stop`` until smaller ones explain no more."""
        (_, m, sd), h, c, _ = self._scaled(g)
        b = np.zeros(len(c))
        out, before = [], 0.0
        for lam in self.penalties:
            b = penalised_quadratic(
                h, c, b, np.full(len(c), lam * self.alpha), np.full(len(c), lam * (1 - self.alpha)),
                tol=1e-9,
            )
            raw = b * sd[-1] / sd[:-1]
            out.append((float(m[-1] - raw @ m[:-1]), raw))
            explained = float(2 * c @ b - b @ h @ b)
            small = explained - before < PATH_STOP_GAIN * explained
            if stop and len(out) > 5 and (small or explained > PATH_STOP_SHARE):
                break
            before = explained
        return out

    def chosen(self) -> tuple[float, np.ndarray]:
        return self.path[self.best]


def _softmax(frame, design, penalty, intercept, standardise) -> SoftmaxFit:
    """Multi-level logistic regression by Spark's solver."""
    levels = list(frame.levels)
    columns = design.columns() or [F.lit(0.0)]
    rows = frame.df.select(
        array_to_vector(F.array(*columns)).alias("features"),
        _label(frame).alias("label"), frame.weight.cast("double").alias("weight"),
    ).persist()
    try:
        fitted = LogisticRegression(
            family="multinomial", weightCol="weight", regParam=float(penalty), elasticNetParam=0.0,
            fitIntercept=intercept, standardization=standardise, maxIter=200, tol=1e-8,
        ).fit(rows)
    except Exception as e:
        raise FitFailed(f"{frame.target}: {e}") from e
    finally:
        rows.unpersist()
    matrix = fitted.coefficientMatrix.toArray()
    if matrix.shape[0] != len(levels):
        raise FitFailed(f"{frame.target} lacks some of its levels")
    b = tuple(tuple(map(float, r[: len(design.names)])) for r in matrix)
    return SoftmaxFit(
        design, tuple(map(float, fitted.interceptVector.toArray())), b, tuple(levels), float(penalty)
    )
