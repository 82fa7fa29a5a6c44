"""What nuisance models share: training frames, prediction requests, designs.

A model spec has ``fit(frame)`` and ``fit_cross(frame, fold)``; both give an object
with ``add(df, requests)`` that adds prediction columns.  A request sets some
parents to fixed levels (a counterfactual) and, for a multi-level target, names the
level whose probability is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.functions.scalar import quoted
from counterfold.operators.features import RestrictedInteractions
from counterfold.operators.schema import ColumnProfile, matching_columns

WEIGHT = "__n"
# A table of cells up to this many rows may be broadcast.
BROADCAST_CELLS = 200_000


class FitFailed(Exception):
    """A nuisance model could not be learned; the run goes on without it."""


@dataclass(frozen=True)
class Request:
    out: str
    override: Mapping = field(default_factory=dict)
    level: object = None


@dataclass(frozen=True)
class Frame:
    """Weighted training rows of one nuisance.

    ``y`` is the target as a double (for a two-level target 0/1 or, for rows that
    stand for several, the share of 1).  ``folds`` names columns with balanced
    fold numbers, one per nesting depth.
    """

    df: DataFrame
    target: str
    y: Column
    task: str  # regression | binary | multi
    parents: tuple[str, ...]
    kinds: Mapping[str, ColumnProfile]
    treatments: tuple[str, ...] = ()
    levels: tuple | None = None  # of a treatment that is the target
    folds: tuple[str, ...] = ()
    n_folds: int = 3
    seed: int = 123
    fits: Callable | None = None  # maps independent fits, perhaps side by side

    @property
    def weight(self) -> Column:
        return F.col(WEIGHT)

    def training(self, fold: int) -> Frame:
        """Rows outside the fold, with the inner fold columns left to the model."""
        return replace(
            self, df=self.df.where(F.col(self.folds[0]) != fold), folds=self.folds[1:]
        )

    def fold_numbers(self) -> range:
        return range(1, self.n_folds + 1)

    def each(self, fn, items) -> list:
        return list(self.fits(fn, items)) if self.fits else [fn(i) for i in items]


class Model:
    """Base of the specs.  ``depth``: fold columns it needs; ``cells``: may learn
    from rows that stand for several units (counts, mean and spread)."""

    depth = 0
    cells = False
    tasks = ("regression", "binary", "multi")

    def check(self, frame: Frame) -> None:
        if frame.task not in self.tasks:
            raise FitFailed(
                f"{type(self).__name__} cannot learn a {frame.task} target ({frame.target})"
            )

    def fit(self, frame: Frame):
        raise NotImplementedError

    def fit_cross(self, frame: Frame):
        """One fit per fold of ``frame.folds[0]``; rows are predicted by the model
        that has not seen their fold."""
        name = frame.folds[0]
        fitted = frame.each(lambda k: self.fit(frame.training(k)), frame.fold_numbers())
        return CrossFit(name, dict(zip(frame.fold_numbers(), fitted)))


class CrossFit:
    def __init__(self, fold: str, fitted: dict):
        self.fold, self.fitted = fold, fitted

    def release(self):
        for f in self.fitted.values():
            release(f)

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        if all(hasattr(f, "expression") for f in self.fitted.values()):
            columns = {}
            for r in requests:
                out = None
                for k, f in self.fitted.items():
                    test = F.col(self.fold) == k
                    e = f.expression(r)
                    out = F.when(test, e) if out is None else out.when(test, e)
                columns[r.out] = out
            return df.withColumns(columns)
        # Models that are not column expressions: each row passes its own model only.
        parts = [f.add(df.where(F.col(self.fold) == k), requests) for k, f in self.fitted.items()]
        return reduce(DataFrame.unionByName, parts)


class ExpressionFit:
    """A fit whose prediction is a column expression: no pass over the rows of its own."""

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        return df.withColumns({r.out: self.expression(r) for r in requests})


def release(fitted) -> None:
    if hasattr(fitted, "release"):
        fitted.release()


def transforms(fitted) -> int:
    """Steps one request adds to a plan; expressions and joins count for nothing."""
    if isinstance(fitted, CrossFit):
        return sum(transforms(f) for f in fitted.fitted.values())
    return fitted.transforms() if hasattr(fitted, "transforms") else 0


def literal(value, profile: ColumnProfile) -> Column:
    return F.lit(value).cast(profile.dtype)


# --- designs --------------------------------------------------------------------


@dataclass(frozen=True)
class Encoded:
    name: str
    source: str
    level: object = None  # of a one-hot column


class Design:
    """Parents as numeric columns: numbers as they are, ordered finite columns by the
    index of their level, text one-hot without the last level; then interactions,
    matched on the source column."""

    def __init__(self, parents, kinds, treatments=(), interactions=None):
        self.kinds = kinds
        self.encoded: list[Encoded] = []
        for c in parents:
            k = kinds[c]
            if isinstance(k.dtype, T.StringType):
                if k.levels is None:
                    raise FitFailed(f"column {c} is text with too many values")
                shown = k.levels[:-1]
                self.encoded += [Encoded(f"{c}={v}", c, v) for v in shown]
            else:
                self.encoded.append(Encoded(c, c))
        names = [e.name for e in self.encoded]
        self.terms: list[tuple[int, ...]] = [(i,) for i in range(len(names))]
        if interactions:
            spec = interactions
            if spec is True:
                spec = RestrictedInteractions(2, tuple(treatments))
            sources = {e.name: e.source for e in self.encoded}
            found = matching_columns(parents, spec.patterns) if spec.patterns else []
            first = {*spec.primary, *found}
            primary = tuple(n for n in names if sources[n] in first)
            plain = RestrictedInteractions(spec.order, primary, (), spec.everything)
            at = {n: i for i, n in enumerate(names)}
            for t in plain.terms(names):
                # Two levels of one text column are never both set.
                onehot = [sources[n] for n in t if self.encoded[at[n]].level is not None]
                if len(onehot) == len(set(onehot)):
                    self.terms.append(tuple(at[n] for n in t))
        self.names = ["_&_".join(names[i] for i in t) for t in self.terms]

    def _one(self, e: Encoded, override: Mapping) -> Column:
        k = self.kinds[e.source]
        fixed = e.source in override
        value = override.get(e.source)
        if e.level is not None:
            if fixed:
                return F.lit(1.0 if value == e.level else 0.0)
            return (quoted(e.source) == F.lit(e.level)).cast("double")
        if isinstance(k.dtype, T.BooleanType):
            return F.lit(float(bool(value))) if fixed else quoted(e.source).cast("double")
        if k.finite:
            levels = list(k.levels)
            if fixed:
                return F.lit(float(levels.index(value)) if value in levels else None).cast("double")
            index = F.array_position(F.array(*[F.lit(v) for v in levels]), quoted(e.source))
            plain = [float(v) for v in levels] == [float(i) for i in range(len(levels))]
            return quoted(e.source).cast("double") if plain else (index - 1).cast("double")
        return F.lit(float(value)) if fixed else quoted(e.source).cast("double")

    def columns(self, override: Mapping | None = None) -> list[Column]:
        base = [self._one(e, override or {}) for e in self.encoded]
        return [reduce(lambda a, b: a * b, [base[i] for i in t]) for t in self.terms]


def linear_combination(columns: Sequence[Column], coefs, intercept: float) -> Column:
    out = F.lit(float(intercept))
    for c, b in zip(columns, coefs):
        if b != 0.0:
            out = out + F.lit(float(b)) * c
    return out


def join_cells(
    df: DataFrame, table: DataFrame, on: Sequence[str], bound: int | None
) -> tuple[DataFrame, DataFrame | None]:
    """Add the columns of a cell table by equal ``on`` columns.

    The table is broadcast, so the rows stay where they are, when the levels of its
    columns prove it small (``bound``) or a count does; a larger one is joined by
    shuffle, where AQE splits hot cells.  Also returns what has to be unpersisted.
    """
    kept = None
    if bound is None or bound > BROADCAST_CELLS:
        kept = table = table.persist()
        small = table.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    else:
        small = True
    return df.join(F.broadcast(table) if small else table, on=list(on), how="left"), kept
