"""Answer many questions about one table.

Questions with the same variables share complete rows, nuisance fits and the passes
that sum up their estimates.  Each distinct nuisance is learned once and let go after
its last use.
"""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.functions.scalar import quoted, two_sided_p
from counterfold.models.base import WEIGHT, FitFailed, Frame, Request, literal, release, transforms
from counterfold.models.simple import Saturated
from counterfold.operators.folds import (
    Placed,
    Resampling,
    key_order,
    place,
    resampling_from,
    with_row_key,
)
from counterfold.operators.schema import MAX_FINITE_LEVELS, ColumnProfile, complete_cases, profile
from counterfold.plans.effects import Answer, Effect, estimate
from counterfold.plans.estimands import (
    Configuration,
    Estimand,
    JointEstimand,
    Nuisance,
    factorial_ate,
    proofread,
    treatments_of,
)
from counterfold.plans.registry import DEFAULT_ESTIMATORS, Estimator, resolve_estimators
from counterfold.session import cut_lineage
from counterfold.sinks import Outputs
from counterfold.sources.readers import read_configuration, read_table

log = logging.getLogger("counterfold")

# Messages of failed results, names and defaults of the run options.
PROPENSITY_MESSAGE = "Could not fit the following propensity score model: {}"
OUTCOME_MESSAGE = "Could not fit the following outcome mean model: {}"
SKIPPED_MESSAGE = "Skipped due to shared failed nuisance fit."
RELEASE_UNUSABLE = "release-unusable"
NO_CACHE = "no-cache"
FACTORIAL = "factorialATE"
DEFAULT_KEY = "SAMPLE_ID"
DEFAULT_BATCH = 100
# Columns in one word of a row's null mask.
MASK_BITS = 62

Z_95 = 1.959963984540054
# Cells instead of rows when their possible number is below this share of the rows.
CELL_SHARE = 0.5
# Model transforms after which predictions are written rather than planned on.
LONG_PLAN = 12

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.IntegerType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("estimator", T.StringType()),
        T.StructField("estimand", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("estimate", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("se", T.DoubleType()),
        T.StructField("ci_lo", T.DoubleType()),
        T.StructField("ci_hi", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("clipped", T.LongType()),
        T.StructField("min_propensity", T.DoubleType()),
        T.StructField("sample_set_id", T.LongType()),
        T.StructField(
            "parts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("estimand", T.StringType()),
                        T.StructField("estimate", T.DoubleType()),
                        T.StructField("std", T.DoubleType()),
                        T.StructField("se", T.DoubleType()),
                        T.StructField("z", T.DoubleType()),
                        T.StructField("p_value", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("cov", T.ArrayType(T.ArrayType(T.DoubleType()))),
    ]
)


def sample_set_id(variables: Iterable[str]) -> int:
    text = "\x1f".join(sorted(variables))
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big") >> 1


class NuisanceFits:
    """Fits by (nuisance, model, rows).  Counts come from the questions still to be
    answered, so skipped questions do not keep a fit alive."""

    def __init__(self, strategy: str | int):
        self.limit: int | None = None
        self.strategy = str(strategy)
        if self.strategy not in (RELEASE_UNUSABLE, NO_CACHE):
            try:
                self.limit = int(self.strategy)
            except ValueError:
                raise ValueError(
                    f"cache strategy {strategy!r} is neither a number, "
                    f"'{RELEASE_UNUSABLE}' nor '{NO_CACHE}'"
                ) from None
        self.kept: dict[tuple, object] = {}
        self.fitted = 0
        self._locks: dict[tuple, Lock] = {}
        self._lock = Lock()

    def get(self, key: tuple, make):
        """The fit, made once even if several groups ask for it at the same time."""
        with self._lock:
            own = self._locks.setdefault(key, Lock())
        with own:
            if key not in self.kept:
                self.kept[key] = make()
                self.fitted += 1
            return self.kept[key]

    def after(self, remaining: Iterable) -> None:
        """Let go of what the remaining questions cannot use."""
        if self.strategy == NO_CACHE:
            drop = list(self.kept)
        elif self.limit is not None:
            drop = list(self.kept)[: max(0, len(self.kept) - self.limit)]
        else:
            needed = {n for e in remaining for n in e.nuisances()}
            drop = [k for k in self.kept if k[0] not in needed or k[2] is not None]
        for k in drop:
            release(self.kept.pop(k))
            self._locks.pop(k, None)


@dataclass
class Group:
    """Questions over the same variables, hence the same complete rows."""

    variables: tuple[str, ...]
    outcomes: tuple[str, ...]
    members: list[tuple[int, object]] = field(default_factory=list)


@dataclass
class Prepared:
    """Rows of a group: ``cells`` for sums and fits, ``rows`` with the key."""

    frame: DataFrame
    rows: DataFrame
    compressed: bool
    folds: tuple[str, ...]
    y: dict[str, str]
    v: dict[str, str]
    n_folds: int = 1


@dataclass
class RunResult:
    results: DataFrame
    influence: DataFrame | None
    sample_sets: DataFrame | None


class Engine:
    def __init__(
        self,
        dataset,
        estimands=FACTORIAL,
        estimators=DEFAULT_ESTIMATORS,
        spark: SparkSession | None = None,
        key: str = DEFAULT_KEY,
        seed: int = 123,
        shuffle: bool = False,
        cache: str | int = RELEASE_UNUSABLE,
        save_sample_ids: bool = False,
        pvalue_threshold: float | None = None,
        outputs: Outputs | None = None,
        batch_size: int = DEFAULT_BATCH,
        sort_estimands: bool = False,
        parallelism: int = 4,
        run_id: str = "run",
        verbosity: int = 0,
        max_finite_levels: int = MAX_FINITE_LEVELS,
        resampling: Resampling | int | str | dict = Resampling(),
    ):
        self.resampling = resampling_from(resampling)
        spark = spark or (dataset.sparkSession if isinstance(dataset, DataFrame) else None)
        spark = spark or SparkSession.getActiveSession()
        self.spark = spark
        table = read_table(spark, dataset)
        if isinstance(estimands, str) and estimands == FACTORIAL:
            config = Configuration((factorial_ate(table, max_levels=max_finite_levels),))
        else:
            config = read_configuration(spark, estimands)
        self.estimands = proofread(config, table.schema)
        self.estimators = resolve_estimators(spark, estimators, treatments_of(self.estimands))
        self.order = list(range(len(self.estimands)))
        if sort_estimands:
            # Neighbours share nuisances; results keep the user's numbers.
            self.order.sort(key=lambda i: (
                sorted(str(n) for n in self.estimands[i].nuisances())[::-1], i))
        variables = sorted(set().union(*(e.variables() for e in self.estimands)))
        self.fits = NuisanceFits(cache)
        self.failed: dict[tuple, str] = {}
        self.told: set[tuple] = set()
        self.batch_size, self.outputs = batch_size, outputs or Outputs()
        self.threshold, self.save_ids = pvalue_threshold, save_sample_ids
        self.seed, self.parallelism, self.run_id = seed, max(1, parallelism), run_id
        self.verbosity = verbosity
        needs_key = (
            save_sample_ids
            or pvalue_threshold is not None
            or any(
                e.cross_fitted or any(m.depth for m in e.models.all())
                for e in self.estimators.values()
            )
        )
        self.key = key
        self.df = table
        if needs_key and key not in table.columns:
            self.key = "__row"
            self.df = with_row_key(table.select(*[quoted(v) for v in variables]), self.key)
        self.keyed = self.key in self.df.columns
        self.kinds: dict[str, ColumnProfile] = profile(
            self.df, variables, max_finite_levels)
        self._ordering = None
        self._ordering_lock = Lock()
        self._held: list[DataFrame] = []
        self._sets_written: set[int] = set()
        self._shuffle_seed = seed if shuffle else None

    # --- shared pieces -----------------------------------------------------------

    def _map(self, fn, items) -> list:
        items = list(items)
        if self.parallelism <= 1 or len(items) <= 1:
            return [fn(i) for i in items]
        with ThreadPoolExecutor(min(self.parallelism, len(items))) as pool:
            return list(pool.map(fn, items))

    def _placed(self, rows: DataFrame, stratum) -> Placed:
        with self._ordering_lock:
            if self._ordering is None:
                self._ordering = key_order(self.df, self.key, self._shuffle_seed)
        return place(rows, self.key, stratum, self._shuffle_seed, self._ordering)

    def _with_fold_columns(self, rows, features, outcome, depth) -> tuple[DataFrame, tuple, int]:
        """Folds by the run's strategy, one column per depth, and their number."""
        placed = self._placed(rows, self.resampling.stratum(rows, features, outcome, self.kinds))
        names = tuple(f"__f{i}" for i in range(depth))
        df, k = self.resampling.assign(placed, names)
        return df, names, k

    def _all_finite(self, columns: Iterable[str]) -> bool:
        return all(self.kinds[c].finite for c in columns)

    def _as_cells(self, rows, by: Sequence[str], y: str | None) -> DataFrame:
        aggs = [F.count(F.lit(1)).cast("double").alias(WEIGHT)]
        if y is not None:
            c = quoted(y).cast("double")
            aggs += [F.avg(c).alias("__y0"),
                     (F.var_pop(c) * F.count(F.lit(1))).alias("__v0")]
        return rows.groupBy(*[quoted(c) for c in by]).agg(*aggs)

    def _few_cells(self, columns: Iterable[str], folds: int, k: int) -> bool:
        size, rows = k**folds, 1
        for c in columns:
            size *= max(1, self.kinds[c].distinct)
            rows = self.kinds[c].rows
        return size <= CELL_SHARE * rows

    def _prepare(self, group: Group) -> Prepared:
        keep = [self.key] if self.keyed else []
        rows = complete_cases(
            self.df.select(*[quoted(c) for c in dict.fromkeys([*keep, *group.variables])]),
            group.variables,
        )
        models = self._models_of(group)
        crossed = any(e.cross_fitted for e in self.estimators.values())
        depth = max([m.depth for m in models], default=0) + (1 if crossed else 0)
        folds: tuple[str, ...] = ()
        k = self.resampling.folds or 1
        if depth:
            # of the whole run, not of the batch: folds do not depend on what is answered together
            features = sorted(treatments_of(self.estimands) & set(group.variables))
            outcome = group.outcomes[0] if len(group.outcomes) == 1 else None
            binary = outcome is not None and self.kinds[outcome].binary
            rows, folds, k = self._with_fold_columns(
                rows, features, outcome if binary else None, depth
            )
        covariates = [c for c in group.variables if c not in group.outcomes]
        # Cells are exact for models that learn from weighted means; a saturated model
        # needs them whatever its parents are.
        compress = (
            len(group.outcomes) == 1
            and all(m.cells for m in models)
            and (
                all(isinstance(m, Saturated) for m in models)
                or (self._all_finite(covariates) and self._few_cells(covariates, depth, k))
            )
        )
        if compress:
            if depth and self.threshold is not None:
                rows = rows.persist()  # read again for the influence values
            y = group.outcomes[0]
            frame = self._as_cells(rows, [*covariates, *folds], y)
            ys, vs = {y: "__y0"}, {y: "__v0"}
        else:
            ys = {o: f"__y{i}" for i, o in enumerate(group.outcomes)}
            vs = {o: f"__v{i}" for i, o in enumerate(group.outcomes)}
            frame = self._as_rows(rows, ys, vs)
        return Prepared(frame.persist(), rows, compress, folds, ys, vs, k)

    @staticmethod
    def _as_rows(rows: DataFrame, ys: dict, vs: dict) -> DataFrame:
        return rows.withColumns(
            {
                WEIGHT: F.lit(1.0),
                **{n: quoted(o).cast("double") for o, n in ys.items()},
                **{n: F.lit(0.0) for n in vs.values()},
            }
        )

    def _models_of(self, group: Group) -> list:
        out = []
        for e in self.estimators.values():
            for _, q in group.members:
                for p in q.parts:
                    out.append(e.models.outcome(p.outcome, self.kinds[p.outcome].binary))
                    out += [e.models.treatment(t) for t in p.names]
        return list(dict.fromkeys(out))

    # --- nuisances ---------------------------------------------------------------

    def _fit_key(self, nuisance: Nuisance, model, crossed: bool, group: Group, is_q: bool):
        rows = None
        if crossed or (is_q and not self._same_rows(nuisance, group)):
            rows = group.variables
        elif is_q and model.depth:
            rows = group.variables
        return (nuisance, model, rows)

    def _same_rows(self, nuisance: Nuisance, group: Group) -> bool:
        own = {nuisance.target, *nuisance.parents}
        return all(self.kinds[c].nulls == 0 for c in group.variables if c not in own)

    def _learn(self, nuisance, model, crossed, group, prepared: Prepared, part: Estimand):
        is_q = nuisance.target == part.outcome
        target = self.kinds[nuisance.target]
        treatments = part.names if is_q else ()
        common = {
            "target": nuisance.target,
            "parents": nuisance.parents,
            "kinds": self.kinds,
            "treatments": treatments,
            "seed": self.seed,
            "fits": self._map,
        }
        if is_q:
            task = "binary" if target.binary else "regression"
            levels = None
        else:
            if not target.finite or len(target.levels) < 2:
                raise FitFailed(f"{nuisance.target} is not a treatment with a few levels")
            levels = target.levels
            task = "binary" if len(levels) == 2 else "multi"
        shared = crossed or is_q or (model.depth == 0 and self._same_rows(nuisance, group))
        own_rows, k = None, prepared.n_folds
        if shared:
            df, folds = prepared.frame, prepared.folds
        else:
            # A propensity that other questions reuse: its own complete rows and folds.
            names = [nuisance.target, *nuisance.parents]
            df = complete_cases(
                self.df.select(*[quoted(c) for c in dict.fromkeys(
                    [*([self.key] if self.keyed else []), *names])]),
                names,
            )
            folds = ()
            if model.depth:
                df, folds, k = self._with_fold_columns(
                    df, [nuisance.target], None, model.depth)
            if model.cells and (
                isinstance(model, Saturated)
                or (self._all_finite(nuisance.parents)
                    and self._few_cells(names, model.depth, k))
            ):
                df = self._as_cells(df, [*names, *folds], None)
            else:
                df = df.withColumn(WEIGHT, F.lit(1.0))
            df = own_rows = df.persist()
        if is_q:
            y = F.col(prepared.y[nuisance.target])
        elif task == "binary":
            y = (quoted(nuisance.target) == literal(levels[1], target)).cast("double")
        else:
            y = F.lit(0.0)
        frame = Frame(df=df, y=y, task=task, levels=levels, folds=folds, n_folds=k, **common)
        try:
            fitted = model.fit_cross(frame) if crossed else model.fit(frame)
        except FitFailed:
            if own_rows is not None:
                own_rows.unpersist()
            raise
        # Saturated fits are read again from their rows; others are done with them.
        if own_rows is not None and not isinstance(model, Saturated):
            own_rows.unpersist()
        return fitted

    # --- one group ---------------------------------------------------------------

    def _answer(self, group: Group):
        """Results of every (question, estimator) of the group."""
        out: dict[tuple[int, str], tuple] = {}
        todo: list[tuple[int, object, str, Estimator]] = []
        prepared: Prepared | None = None
        requests: dict[tuple, dict[tuple, str]] = {}
        owners: dict[tuple, object] = {}
        for idx, question in group.members:
            for name, est in self.estimators.items():
                needed = [
                    (p, n, *self._choice(p, n, est)) for p in question.parts for n in p.nuisances()
                ]
                # Propensities first, then outcomes.
                needed.sort(key=lambda t: t[3])
                known = [(n, m) for _, n, m, _ in needed if (n, m) in self.failed]
                if known:
                    out[idx, name] = (None, known[0])
                    continue
                missing = self._missing_levels(question)
                if missing:
                    out[idx, name] = (None, missing)
                    continue
                if prepared is None:
                    prepared = self._prepare(group)
                try:
                    for p, n, m, is_q in needed:
                        key = self._fit_key(n, m, est.cross_fitted, group, is_q)
                        key = (*key, est.cross_fitted)
                        try:
                            owners[key] = self.fits.get(
                                key,
                                lambda n=n, m=m, p=p: self._learn(
                                    n, m, est.cross_fitted, group, prepared, p
                                ),
                            )
                        except FitFailed as e:
                            text = (OUTCOME_MESSAGE if is_q else PROPENSITY_MESSAGE).format(n)
                            log.warning("%s (%s)", text, e)
                            self.failed[(n, m)] = text
                            out[idx, name] = (None, (n, m))
                            raise
                except FitFailed:
                    continue
                todo.append((idx, question, name, est))
        if not todo:
            if prepared:
                prepared.frame.unpersist()
            return out, None
        # Columns wanted from each fit.
        effects: list[tuple[int, str, int]] = []
        plans = []
        for idx, question, name, est in todo:
            for j, p in enumerate(question.parts):
                plan = self._plan_part(p, est, group, requests)
                effects.append((idx, name, j))
                plans.append((p, est, plan))

        def predicted(frame: DataFrame) -> DataFrame:
            for key, wanted in requests.items():
                asked = [
                    Request(col, dict(setting), level) for (setting, level), col in wanted.items()
                ]
                frame = owners[key].add(frame, asked)
                # Many tree predictions make a long plan: write them and go on.
                if transforms(owners[key]) * len(asked) > LONG_PLAN:
                    frame = cut_lineage(frame)
            return frame.withColumns({c: self._flag(setting) for setting, c in hits.items()})

        hits: dict[tuple, str] = {}
        built = [self._effect(p, est, plan, prepared, hits) for p, est, plan in plans]
        frame = predicted(prepared.frame).persist()
        joint = [
            [i for i, (k, nm, _) in enumerate(effects) if (k, nm) == (idx, name)]
            for idx, question, name, _ in todo
            if isinstance(question, JointEstimand)
        ]
        answers, cov = estimate(frame, built, joint)
        for idx, question, name, _ in todo:
            at = [i for i, (k, nm, _) in enumerate(effects) if (k, nm) == (idx, name)]
            broken = [answers[i].failed for i in at if answers[i].failed]
            if broken:
                out[idx, name] = (None, broken[0])
            else:
                out[idx, name] = (self._collect(question, at, answers, cov), None)
        influence = None
        if self.threshold is not None and self.keyed:
            influence = self._influence(group, prepared, predicted, frame, effects, built, out)
        return out, (influence, [frame, prepared.frame, prepared.rows])

    def _choice(self, part: Estimand, nuisance: Nuisance, est: Estimator):
        if nuisance.target == part.outcome:
            return est.models.outcome(part.outcome, self.kinds[part.outcome].binary), True
        return est.models.treatment(nuisance.target), False

    def _missing_levels(self, question) -> str | None:
        for p in question.parts:
            for t, v in p.treatments:
                levels = self.kinds[t].levels
                for level in [v.case] + ([] if p.type == "CM" else [v.control]):
                    if levels is not None and level not in levels:
                        return f"level {level!r} of treatment {t} never occurs"
        return None

    def _plan_part(self, part: Estimand, est: Estimator, group, requests):
        q_nuisance, *g_nuisances = part.nuisances()

        def column(nuisance, is_q, setting, level):
            model, _ = self._choice(part, nuisance, est)
            key = (*self._fit_key(nuisance, model, est.cross_fitted, group, is_q),
                   est.cross_fitted)
            wanted = requests.setdefault(key, {})
            number = sum(len(w) for w in requests.values())
            return wanted.setdefault((setting, level), f"__p{number}")

        q_cols, g_cols = [], []
        for _, setting in part.terms():
            named = tuple(zip(part.names, setting))
            q_cols.append(column(q_nuisance, True, named, None))
            g_cols.append(
                [column(n, False, (), v) for n, v in zip(g_nuisances, setting)]
            )
        return q_cols, g_cols

    def _effect(self, part: Estimand, est: Estimator, plan, prepared: Prepared, hits) -> Effect:
        q_cols, g_cols = plan
        flags = [
            hits.setdefault(tuple(zip(part.names, setting)), f"__h{len(hits)}")
            for _, setting in part.terms()
        ]
        return Effect(
            signs=[s for s, _ in part.terms()],
            hits=flags,
            q=q_cols,
            g=["(" + " * ".join(cs) + ")" for cs in g_cols],
            y=prepared.y[part.outcome],
            v=prepared.v[part.outcome],
            lower=est.lower,
            kind=est.kind,
            weighted=est.weighted,
            binary=self.kinds[part.outcome].binary,
        )

    def _flag(self, setting) -> Column:
        """Whether a row has the treatment setting."""
        tests = [quoted(t) == literal(v, self.kinds[t]) for t, v in setting]
        return reduce(lambda a, b: a & b, tests)

    def _collect(self, question, at, answers: list[Answer], cov) -> dict:
        parts = [answers[i] for i in at]
        if not isinstance(question, JointEstimand):
            return {"answer": parts[0], "parts": None, "cov": None}
        matrix = [
            [a.std**2 if i == j else cov[min(at[i], at[j]), max(at[i], at[j])]
             for j, _ in enumerate(parts)]
            for i, a in enumerate(parts)
        ]
        return {"answer": None, "parts": parts, "cov": matrix}

    def _influence(self, group, prepared, predicted, frame, effects, built, out):
        """Long table of influence values of the effects below the threshold."""
        chosen = []
        for i, (idx, name, j) in enumerate(effects):
            got, _ = out[idx, name]
            if got is None:
                continue
            answers = got["parts"] or [got["answer"]]
            a = answers[j]
            if _p_value(a) < self.threshold:
                chosen.append((i, idx, name, j, a))
        if not chosen:
            return None
        if prepared.compressed:
            rows = predicted(self._as_rows(prepared.rows, prepared.y, prepared.v))
        else:
            rows = frame
        values = F.array(
            *[
                F.struct(
                    F.lit(idx).alias("idx"),
                    F.lit(name).alias("estimator"),
                    F.lit(j).alias("part"),
                    (F.expr(built[i].uncentred()) - F.lit(a.estimate)).alias("ic"),
                )
                for i, idx, name, j, a in chosen
            ]
        )
        return rows.select(
            F.lit(self.run_id).alias("run_id"), quoted(self.key).alias("SAMPLE_ID"),
            F.explode(values).alias("e"),
        ).select("run_id", "e.idx", "e.estimator", "e.part", "SAMPLE_ID", "e.ic")

    # --- the run -----------------------------------------------------------------

    def groups(self, indices: Sequence[int]) -> list[Group]:
        found: dict[tuple, Group] = {}
        for i in indices:
            e = self.estimands[i]
            variables = tuple(sorted(e.variables()))
            outcomes = tuple(sorted(e.outcomes()))
            g = found.setdefault((variables, outcomes), Group(variables, outcomes))
            g.members.append((i, e))
        return list(found.values())

    def run(self, indices: Sequence[int] | None = None, batch_id: int = 1) -> RunResult:
        """Answer the questions at ``indices`` (all by default) as one batch."""
        indices = list(self.order if indices is None else indices)
        todo = self.groups(indices)
        later = [self.estimands[i] for i in self.order if i not in set(indices)]
        rows: dict[tuple[int, str], tuple] = {}
        tables = []
        for start in range(0, len(todo), self.parallelism):
            # A few groups side by side: their jobs fill the gaps of one another.
            for out, extra in self._map(self._answer, todo[start : start + self.parallelism]):
                rows |= out
                if extra is None:
                    continue
                influence, frames = extra
                if influence is not None:
                    tables.append(influence)
                    self._held += frames
                else:
                    for f in frames:
                        f.unpersist()
            if self.verbosity:
                log.info("answered %d of %d groups", start + self.parallelism, len(todo))
            if not tables:
                rest = [e for g in todo[start + self.parallelism :] for _, e in g.members]
                self.fits.after(rest + later)
        self._tell_failures(indices, rows)
        results = self.spark.createDataFrame(
            [
                self._row(i, name, rows[i, name], batch_id)
                for i in sorted(indices)
                for name in self.estimators
            ],
            RESULT_SCHEMA,
        )
        influence = reduce(DataFrame.unionByName, tables) if tables else None
        ids = self.sample_sets(indices) if self.save_ids else None
        return RunResult(results, influence, ids)

    def _tell_failures(self, indices: Sequence[int], rows: dict) -> None:
        """The first question that needs a broken nuisance tells why; later ones are
        reported as skipped, in the order of the questions."""
        for i in indices:
            new = []
            for name in self.estimators:
                got, error = rows[i, name]
                if got is None and isinstance(error, tuple):
                    needed = [
                        (n, self._choice(p, n, self.estimators[name])[0])
                        for p in self.estimands[i].parts
                        for n in p.nuisances()
                    ]
                    if any(k in self.told for k in needed):
                        rows[i, name] = (None, SKIPPED_MESSAGE)
                    else:
                        rows[i, name] = (None, self.failed[error])
                        new.append(error)
            self.told.update(new)

    def _let_go(self) -> None:
        for f in self._held:
            f.unpersist()
        self._held = []
        self.fits.after([])

    def __call__(self, resume: bool = False) -> DataFrame | None:
        """Answer everything in batches, each appended to the outputs.  With ``resume``
        the batches that are already written are left as they are."""
        written = self.outputs.manifest(self.spark) if resume else []
        done = {r["batch_id"] for r in written}
        # a set of rows is written by the first batch that uses it
        self._sets_written = {s for r in written for s in r["sample_sets"] or []}
        if not resume:
            self.outputs.initialize(self.spark)
        collected = []
        for number, start in enumerate(range(0, len(self.order), self.batch_size), start=1):
            if number in done:
                continue
            got = self.run(self.order[start : start + self.batch_size], number)
            self.outputs.append(got, number)
            self._sets_written |= self._sets_of(self.order[start : start + self.batch_size])
            if not self.outputs.any:
                collected.append(got.results)
            self._let_go()
        if self.outputs.parquet:
            return self.spark.read.parquet(self.outputs.results_path)
        if collected:
            return reduce(DataFrame.unionByName, collected)
        return None

    def _sets_of(self, indices: Sequence[int]) -> set[int]:
        return {sample_set_id(self.estimands[i].variables()) for i in indices}

    def sample_sets(self, indices: Sequence[int]) -> DataFrame:
        """Rows used, once per distinct set of variables: one scan, however many sets."""
        sets = {tuple(sorted(self.estimands[i].variables())) for i in indices}
        sets = {vs for vs in sets if sample_set_id(vs) not in self._sets_written}
        names = sorted({v for vs in sets for v in vs})
        # which columns of a row are null, and which a set uses, as words of bits
        spots = [names[i : i + MASK_BITS] for i in range(0, len(names), MASK_BITS)]
        holes = [
            reduce(lambda a, b: a.bitwiseOR(b), [
                F.when(quoted(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                for i, c in enumerate(spot)])
            for spot in spots
        ]
        asked = F.array(*[
            F.struct(
                F.lit(sample_set_id(vs)).alias("id"),
                *[F.lit(sum(1 << i for i, c in enumerate(spot) if c in vs)).cast("long").alias(
                    f"m{w}") for w, spot in enumerate(spots)])
            for vs in sorted(sets)
        ])
        if not sets:
            asked, spots, holes = F.array().cast("array<struct<id: bigint>>"), [], []
        rows = self.df.select(
            quoted(self.key).alias("SAMPLE_ID"), *[h.alias(f"__hole{w}") for w, h in enumerate(holes)])

        def whole(s):
            return reduce(lambda a, b: a & b, [
                s[f"m{w}"].bitwiseAND(F.col(f"__hole{w}")) == 0 for w in range(len(spots))], F.lit(True))

        return rows.select("SAMPLE_ID", F.explode(F.filter(asked, whole)).alias("s")).select(
            F.col("s.id").alias("sample_set_id"), "SAMPLE_ID")

    def _row(self, idx: int, name: str, got: tuple, batch_id: int) -> tuple:
        question = self.estimands[idx]
        text = json.dumps(question.to_dict(), default=str)
        set_id = sample_set_id(question.variables())
        answer, error = got
        head = (self.run_id, batch_id, idx, name, text)
        if answer is None:
            return (*head, "failed", error, *[None] * 10, set_id, None, None)
        if answer["answer"] is not None:
            a = answer["answer"]
            return (
                *head, "ok", None, a.estimate, a.std, a.n, a.se,
                a.estimate - Z_95 * a.se, a.estimate + Z_95 * a.se, _z(a), _p_value(a),
                a.clipped, a.min_g, set_id, None, None,
            )
        parts = [
            (json.dumps(p.to_dict(), default=str), a.estimate, a.std, a.se, _z(a), _p_value(a))
            for p, a in zip(question.parts, answer["parts"])
        ]
        worst = min(a.min_g for a in answer["parts"])
        clipped = max(a.clipped for a in answer["parts"])
        return (
            *head, "ok", None, None, None, answer["parts"][0].n, None, None, None, None, None,
            clipped, worst, set_id, parts, answer["cov"],
        )


def _z(a: Answer) -> float | None:
    return a.estimate / a.se if a.se > 0 else None


def _p_value(a: Answer) -> float:
    z = _z(a)
    if z is None:
        return 0.0 if a.estimate else 1.0
    return two_sided_p(z)


def estimate_effects(dataset, estimands=FACTORIAL, estimators=DEFAULT_ESTIMATORS, **options):
    """Answer the questions and return the results as a table."""
    return Engine(dataset, estimands, estimators, **options)()
