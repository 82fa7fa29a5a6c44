"""Causal questions: counterfactual means, treatment effects, interactions.

A question is small; a table of questions (``estimand_table``) has one row each,
so that sets of many thousand can be identified and counted with joins.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from counterfold.functions.scalar import lossless_cast
from counterfold.operators.schema import MAX_FINITE_LEVELS

FACTORIAL_TREATMENT = "T"
FACTORIAL_OUTCOME = "Y"
FACTORIAL_CONFOUNDERS = "W"

ESTIMAND_SCHEMA = T.StructType(
    [
        T.StructField("idx", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField(
            "treatments",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("case", T.StringType()),
                        T.StructField("control", T.StringType()),
                        T.StructField("confounders", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
        T.StructField("extra", T.ArrayType(T.StringType())),
    ]
)


class EstimandError(ValueError):
    pass


@dataclass(frozen=True)
class Levels:
    case: object
    control: object = None


def _levels(value) -> Levels:
    if isinstance(value, Levels):
        return value
    if isinstance(value, Mapping):
        return Levels(value["case"], value["control"])
    return Levels(value)


@dataclass(frozen=True)
class Estimand:
    """One question about one outcome.  ``treatments`` keeps the order given."""

    type: str
    outcome: str
    treatments: tuple[tuple[str, Levels], ...]
    confounders: tuple[tuple[str, tuple[str, ...]], ...] = ()
    extra: tuple[str, ...] = ()

    @property
    def parts(self) -> tuple[Estimand, ...]:
        return (self,)

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.treatments)

    def parents_of(self, treatment: str) -> tuple[str, ...]:
        return dict(self.confounders).get(treatment, ())

    @property
    def all_confounders(self) -> tuple[str, ...]:
        return tuple(sorted({w for _, ws in self.confounders for w in ws}))

    def outcomes(self) -> set[str]:
        return {self.outcome}

    def variables(self) -> set[str]:
        return {self.outcome, *self.names, *self.extra, *self.all_confounders}

    def terms(self) -> list[tuple[int, tuple]]:
        """Signed treatment settings whose counterfactual means add up to the effect."""
        cases = tuple(v.case for _, v in self.treatments)
        controls = tuple(v.control for _, v in self.treatments)
        if self.type == "CM":
            return [(1, cases)]
        if self.type == "ATE":
            return [(1, cases), (-1, controls)]
        out = []
        for picks in itertools.product((1, 0), repeat=len(cases)):
            setting = tuple(c if p else o for p, c, o in zip(picks, cases, controls))
            out.append(((-1) ** (len(cases) - sum(picks)), setting))
        return out

    def nuisances(self) -> list[Nuisance]:
        return [
            Nuisance(self.outcome, tuple(sorted({*self.names, *self.all_confounders, *self.extra}))),
            *(Nuisance(t, tuple(sorted(self.parents_of(t)))) for t in self.names),
        ]

    def to_dict(self) -> dict:
        def val(v: Levels):
            if self.type == "CM":
                return v.case
            return {"case": v.case, "control": v.control}

        return {
            "type": self.type,
            "outcome": self.outcome,
            "treatment_values": {n: val(v) for n, v in self.treatments},
            "treatment_confounders": {n: list(ws) for n, ws in self.confounders},
            "outcome_extra_covariates": list(self.extra),
        }


@dataclass(frozen=True)
class JointEstimand:
    """Questions answered together, with the covariance of their estimates."""

    parts: tuple[Estimand, ...]

    def outcomes(self) -> set[str]:
        return set().union(*(p.outcomes() for p in self.parts))

    def variables(self) -> set[str]:
        return set().union(*(p.variables() for p in self.parts))

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(n for p in self.parts for n in p.names))

    def nuisances(self) -> list[Nuisance]:
        return list(dict.fromkeys(n for p in self.parts for n in p.nuisances()))

    def to_dict(self) -> dict:
        return {"type": "JointEstimand", "estimands": [p.to_dict() for p in self.parts]}


@dataclass(frozen=True)
class Nuisance:
    """A conditional distribution to learn: a target given its parents."""

    target: str
    parents: tuple[str, ...]

    def __str__(self) -> str:
        return f"P₀({self.target} | {', '.join(self.parents)})"


def _make(kind, outcome, treatment_values, treatment_confounders, outcome_extra_covariates):
    values = tuple((n, _levels(v)) for n, v in dict(treatment_values).items())
    confounders = dict(treatment_confounders or {})
    return Estimand(
        kind,
        str(outcome),
        values,
        tuple((n, tuple(confounders[n])) for n, _ in values if n in confounders),
        tuple(outcome_extra_covariates or ()),
    )


def CM(outcome, treatment_values, treatment_confounders=None, outcome_extra_covariates=()):
    """Counterfactual mean of the outcome under the treatment levels."""
    return _make("CM", outcome, treatment_values, treatment_confounders, outcome_extra_covariates)


def ATE(outcome, treatment_values, treatment_confounders=None, outcome_extra_covariates=()):
    """Effect of moving all treatments from control to case."""
    return _make("ATE", outcome, treatment_values, treatment_confounders, outcome_extra_covariates)


def AIE(outcome, treatment_values, treatment_confounders=None, outcome_extra_covariates=()):
    """Interaction effect of two or more treatments."""
    return _make("AIE", outcome, treatment_values, treatment_confounders, outcome_extra_covariates)


def Joint(*parts: Estimand) -> JointEstimand:
    return JointEstimand(tuple(parts))


@dataclass(frozen=True)
class Graph:
    """A static causal graph: every listed treatment has the listed confounders.

    ``edges`` may instead give the confounders of each treatment by itself.
    """

    outcomes: tuple[str, ...] = ()
    treatments: tuple[str, ...] = ()
    confounders: tuple[str, ...] = ()
    edges: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def parents_of(self, treatment: str) -> tuple[str, ...] | None:
        named = dict(self.edges)
        if treatment in named:
            return named[treatment]
        return self.confounders if treatment in self.treatments else None


@dataclass(frozen=True)
class Configuration:
    estimands: tuple
    graph: Graph | None = None
    adjustment: str = "backdoor"


def estimand_from_dict(d: Mapping):
    kind = str(d["type"])
    if kind in ("JointEstimand", "Joint"):
        return JointEstimand(
            tuple(estimand_from_dict(e) for e in d.get("estimands", d.get("args", ())))
        )
    kind = kind.rsplit(".", 1)[-1].removeprefix("Statistical").removeprefix("Causal")
    if kind not in ("CM", "ATE", "AIE"):
        raise EstimandError(f"unknown estimand type: {d['type']}")
    return _make(
        kind,
        d["outcome"],
        d["treatment_values"],
        d.get("treatment_confounders"),
        d.get("outcome_extra_covariates"),
    )


def configuration_from_dict(d) -> Configuration:
    if isinstance(d, Sequence) and not isinstance(d, str):
        d = {"estimands": d}
    scm = d.get("scm")
    graph = None
    if scm:
        graph = Graph(
            tuple(scm.get("outcomes", ())),
            tuple(scm.get("treatments", ())),
            tuple(scm.get("confounders", ())),
            tuple((k, tuple(v)) for k, v in dict(scm.get("edges", {})).items()),
        )
    return Configuration(
        tuple(estimand_from_dict(e) for e in d["estimands"]),
        graph,
        d.get("adjustment") or "backdoor",
    )


def identify(estimand, graph: Graph | None):
    """Fill in confounders from the graph; questions that have them stay as they are."""
    if isinstance(estimand, JointEstimand):
        return JointEstimand(tuple(identify(p, graph) for p in estimand.parts))
    if estimand.confounders:
        absent = [t for t in estimand.names if t not in dict(estimand.confounders)]
        if absent:
            raise EstimandError(f"no confounders given for treatments {absent}")
        return estimand
    if graph is None:
        raise EstimandError(
            "a causal graph is needed in the configuration to identify causal estimands"
        )
    found = []
    for t in estimand.names:
        parents = graph.parents_of(t)
        if parents is None:
            raise EstimandError(f"treatment {t} is not part of the causal graph")
        found.append((t, tuple(parents)))
    return replace(estimand, confounders=tuple(found))


def cast_levels(estimand, schema: T.StructType):
    """Treatment levels in the type of their column; all problems in one error."""
    if isinstance(estimand, JointEstimand):
        return JointEstimand(tuple(cast_levels(p, schema) for p in estimand.parts))
    types = {f.name: f.dataType for f in schema.fields}
    problems, new = [], []
    for name, levels in estimand.treatments:
        if name not in types:
            problems.append(f"no treatment column {name}")
            continue
        try:
            control = levels.control
            if estimand.type != "CM":
                control = lossless_cast(control, types[name])
            new.append((name, Levels(lossless_cast(levels.case, types[name]), control)))
        except ValueError as e:
            problems.append(f"treatment {name}: {e}")
    problems += [f"no column {v}" for v in sorted(estimand.variables()) if v not in types
                 and v not in estimand.names]
    if problems:
        raise EstimandError("; ".join(problems))
    return replace(estimand, treatments=tuple(new))


def proofread(config: Configuration, schema: T.StructType) -> list:
    """Identified questions with levels that fit the table."""
    if config.adjustment not in ("backdoor", "BackdoorAdjustment"):
        raise EstimandError(f"unknown adjustment: {config.adjustment}")
    out, problems = [], []
    for i, e in enumerate(config.estimands):
        try:
            out.append(cast_levels(identify(e, config.graph), schema))
        except EstimandError as err:
            problems.append(f"estimand {i}: {err}")
    if problems:
        raise EstimandError("\n".join(problems))
    return out


def treatments_of(estimands: Iterable) -> set[str]:
    return set().union(*(e.names for e in estimands)) if estimands else set()


# --- levels found in the data -------------------------------------------------


def consecutive_levels(df: DataFrame, treatments: Sequence[str]) -> DataFrame:
    """Per treatment its sorted levels as (control, case) neighbours: (0,1), (1,2)…

    Treatments are read in one scan; the window runs over distinct levels only.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("treatment"), F.col(f"`{t}`").cast("string").alias("level"))
            for t in treatments
        ]
    )
    # Numbers sort as numbers, text as text.
    numeric = [t for t in treatments if not isinstance(df.schema[t].dataType, T.StringType)]
    distinct = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("level").isNotNull())
        .distinct()
    )
    as_number = F.when(
        F.col("treatment").isin(numeric),
        F.when(F.col("level") == "true", 1.0)
        .when(F.col("level") == "false", 0.0)
        .otherwise(F.expr("try_cast(level AS double)")),
    ) if numeric else F.lit(None).cast("double")
    w = Window.partitionBy("treatment").orderBy(F.col("__n"), F.col("level"))
    return (
        distinct.withColumn("__n", as_number)
        .withColumn("control", F.lag("level").over(w))
        .where(F.col("control").isNotNull())
        .select("treatment", "control", F.col("level").alias("case"))
    )


def cast_level_table(levels: DataFrame, df: DataFrame) -> DataFrame:
    """Levels asked for as text ``(treatment, level)`` against the treatment columns.

    ``value`` is the level as the column holds it (1 becomes true in a boolean column),
    ``valid`` false when it would change, ``units`` the rows that have it.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = [r[0] for r in levels.select("treatment").distinct().collect()]
    unknown = sorted(set(names) - set(types))
    if unknown:
        raise EstimandError(f"no treatment columns {unknown}")
    number = F.expr("try_cast(level AS double)")
    value = F.lit(None).cast("string")
    for t in names:
        d = types[t]
        if isinstance(d, T.BooleanType):
            v = F.when(number == 1, "true").when(number == 0, "false").otherwise(
                F.when(F.lower("level").isin("true", "false"), F.lower("level"))
            )
        elif isinstance(d, T.IntegralType):
            v = F.when(number == F.floor(number), number.cast("bigint").cast("string"))
        elif isinstance(d, T.FractionalType):
            v = number.cast("string")
        else:
            v = F.col("level")
        value = F.when(F.col("treatment") == t, v).otherwise(value)
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("treatment"), F.col(f"`{t}`").cast("string").alias("value"))
            for t in names
        ]
    )
    seen = (
        df.select(F.explode(pairs).alias("p"))
        .groupBy("p.treatment", "p.value")
        .agg(F.count(F.lit(1)).alias("units"))
    )
    asked = levels.withColumn("value", value).withColumn("valid", F.col("value").isNotNull())
    return asked.join(seen, ["treatment", "value"], "left").select(
        "treatment", "level", "value", "valid", F.coalesce("units", F.lit(0)).alias("units")
    )


def factorial_ate(
    df: DataFrame,
    treatment: str = FACTORIAL_TREATMENT,
    outcome: str = FACTORIAL_OUTCOME,
    confounders: Sequence[str] | None = None,
    max_levels: int = MAX_FINITE_LEVELS,
) -> JointEstimand:
    """All effects between neighbouring levels of T, adjusted for every ``W…`` column."""
    if treatment not in df.columns:
        raise EstimandError(f"no column '{treatment}' in the table for the treatment")
    if outcome not in df.columns:
        raise EstimandError(f"no column '{outcome}' in the table for the outcome")
    if confounders is None:
        confounders = [c for c in df.columns if c.startswith(FACTORIAL_CONFOUNDERS)]
    if not confounders:
        raise EstimandError(
            f"no confounder in the table (a column that starts with '{FACTORIAL_CONFOUNDERS}')"
        )
    t = F.col(f"`{treatment}`")
    few = df.where(t.isNotNull()).select(t.alias("t")).distinct().limit(max_levels + 1)
    levels = sorted(r["t"] for r in few.collect())
    if len(levels) > max_levels:
        raise EstimandError(f"treatment '{treatment}' has over {max_levels} levels")
    if len(levels) < 2:
        raise EstimandError(f"treatment '{treatment}' needs at least two levels")
    return JointEstimand(
        tuple(
            ATE(outcome, {treatment: Levels(b, a)}, {treatment: tuple(confounders)})
            for a, b in zip(levels, levels[1:])
        )
    )


# --- tables of questions --------------------------------------------------------


def estimand_table(spark: SparkSession, estimands: Iterable) -> DataFrame:
    def text(v):
        if v is None:
            return None
        return str(v).lower() if isinstance(v, bool) else str(v)

    rows = [
        (
            i,
            j,
            p.type,
            p.outcome,
            [(n, text(v.case), text(v.control), list(p.parents_of(n)) or None)
             for n, v in p.treatments],
            list(p.extra),
        )
        for i, e in enumerate(estimands)
        for j, p in enumerate(e.parts)
    ]
    return spark.createDataFrame(rows, ESTIMAND_SCHEMA)


def identify_table(estimands: DataFrame, scm: DataFrame) -> DataFrame:
    """Join a table of questions to a graph table ``(treatment, confounder)``.

    ``estimands`` needs ``idx`` and ``treatments`` (array of structs with ``name``).
    Adds the confounders of each treatment; a treatment outside the graph makes
    ``identified`` false.
    """
    graph = scm.groupBy("treatment").agg(
        F.array_sort(F.collect_set("confounder")).alias("parents")
    )
    exploded = estimands.select("*", F.posexplode("treatments").alias("__k", "__t"))
    joined = exploded.join(graph, F.col("__t.name") == graph["treatment"], "left")
    merged = joined.withColumn(
        "__t",
        F.struct(
            F.col("__k").alias("k"),
            F.col("__t.name").alias("name"),
            F.coalesce("parents", "__t.confounders").alias("confounders"),
        ),
    )
    keep = [c for c in estimands.columns if c not in ("idx", "treatments")]
    return (
        merged.groupBy("idx")
        .agg(
            *[F.first(c).alias(c) for c in keep],
            F.array_sort(F.collect_list("__t")).alias("treatments"),
        )
        .withColumn(
            "all_confounders",
            F.array_sort(
                F.array_distinct(F.flatten(F.expr("transform(treatments, t -> coalesce(t.confounders, array()))")))
            ),
        )
        .withColumn("identified", F.expr("forall(treatments, t -> t.confounders IS NOT NULL)"))
    )


def nuisance_table(estimands: DataFrame) -> DataFrame:
    """One row per (question, nuisance): target and sorted parents.

    Parts of a joint question count each distinct nuisance once."""
    names = F.expr("transform(treatments, t -> t.name)")
    ws = F.flatten(F.expr("transform(treatments, t -> t.confounders)"))
    outcome = F.struct(
        F.col("outcome").alias("target"),
        F.array_sort(F.array_distinct(F.concat(names, ws, F.col("extra")))).alias("parents"),
    )
    propensity = F.expr(
        "transform(treatments, t -> struct(t.name AS target, array_sort(t.confounders) AS parents))"
    )
    return (
        estimands.select("idx", F.explode(F.concat(F.array(outcome), propensity)).alias("n"))
        .select("idx", "n.target", "n.parents")
        .distinct()
    )


def nuisance_counts(estimands: DataFrame) -> DataFrame:
    """How many questions use each nuisance."""
    return (
        nuisance_table(estimands).groupBy("target", "parents").agg(F.count(F.lit(1)).alias("uses"))
    )
