"""Estimators by short string, by preset name, or from a data file."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import yaml
from pyspark.sql import SparkSession

from counterfold.models.foreign import foreign_from_dict
from counterfold.models import (
    Constant,
    ElasticNet,
    Linear,
    Logistic,
    Saturated,
    Stack,
    Trees,
    Tuned,
)
from counterfold.models.base import Model
from counterfold.operators.features import RestrictedInteractions

# The default lower bound of a propensity score, the default
# estimators and model, and the member grid of the super learner.
PROPENSITY_BOUND = 1e-8
DEFAULT_ESTIMATORS = "wtmle-ose"
DEFAULT_MODEL = "GLMNET"
SL_DEPTHS = (2, 4, 6, 8)
SL_ETAS = (0.001, 0.01, 0.3)
SL_ROUNDS = 100
GENOTYPE_PATTERN = r"^rs[0-9]+"


@dataclass(frozen=True)
class Models:
    """Which model learns what; ``overrides`` names a target variable."""

    q_continuous: Model
    q_binary: Model
    g: Model
    overrides: tuple[tuple[str, Model], ...] = ()

    def outcome(self, name: str, binary: bool) -> Model:
        return dict(self.overrides).get(name, self.q_binary if binary else self.q_continuous)

    def treatment(self, name: str) -> Model:
        return dict(self.overrides).get(name, self.g)

    def all(self) -> list[Model]:
        return [self.q_continuous, self.q_binary, self.g, *(m for _, m in self.overrides)]


@dataclass(frozen=True)
class Estimator:
    kind: str  # tmle | ose
    models: Models
    weighted: bool = False
    cross_fitted: bool = False
    lower: float = PROPENSITY_BOUND


def TMLE(models: Models, weighted=False, cross_fitted=False, lower=PROPENSITY_BOUND) -> Estimator:
    return Estimator("tmle", models, weighted, cross_fitted, lower)


def OSE(models: Models, cross_fitted=False, lower=PROPENSITY_BOUND) -> Estimator:
    return Estimator("ose", models, False, cross_fitted, lower)


def same_model(model: Model, **overrides: Model) -> Models:
    return Models(model, model, model, tuple(overrides.items()))


# Short estimator names -> (kind, weighted, cross-fitted).
ESTIMATORS = {
    "TMLE": ("tmle", False, False),
    "WTMLE": ("tmle", True, False),
    "OSE": ("ose", False, False),
    "CVTMLE": ("tmle", False, True),
    "CVWTMLE": ("tmle", True, True),
    "CVOSE": ("ose", False, True),
}


def sl_members(glmnet: Model, glm: Model) -> tuple[tuple[str, Model], ...]:
    trees = [
        (f"trees_{i}", Trees(rounds=SL_ROUNDS, max_depth=d, eta=e))
        for i, (e, d) in enumerate(((e, d) for e in SL_ETAS for d in SL_DEPTHS), start=1)
    ]
    return (("glmnet", glmnet), ("lr", glm), *trees)


def model_named(name: str, task: str, treatments: Iterable[str], interactions: bool) -> Model:
    """``task`` is regression or classification."""
    inter = RestrictedInteractions(2, tuple(sorted(treatments))) if interactions else False
    glm = Linear(interactions=inter) if task == "regression" else Logistic(interactions=inter)
    glmnet = ElasticNet(interactions=inter)
    known = {
        "GLM": lambda: glm,
        "GLMNET": lambda: glmnet,
        "XGBOOST": lambda: Trees(),
        "TUNEDXGBOOST": lambda: Tuned(),
        "SL": lambda: Stack(sl_members(glmnet, glm)),
        "SATURATED": lambda: Saturated(),
        "CONSTANT": lambda: Constant(),
    }
    if name not in known:
        raise ValueError(f"unknown model: {name}")
    return known[name]()


def estimators_from_string(
    text: str = DEFAULT_ESTIMATORS, treatments: Iterable[str] = ()
) -> dict[str, Estimator]:
    """``EST[-EST…][--Q[--G]]``, any case; G defaults to Q, Q to the elastic net."""
    treatments = list(treatments)
    parts = text.upper().split("--")
    if len(parts) > 3:
        raise ValueError(f"too many parts in estimator string: {text}")
    q = parts[1] if len(parts) > 1 else DEFAULT_MODEL
    g = parts[2] if len(parts) > 2 else q
    models = Models(
        model_named(q, "regression", treatments, True),
        model_named(q, "classification", treatments, True),
        model_named(g, "classification", treatments, False),
    )
    out = {}
    for name in parts[0].split("-"):
        if name not in ESTIMATORS:
            raise ValueError(f"unknown estimator: {name}")
        kind, weighted, crossed = ESTIMATORS[name]
        out[f"{name}_{q}_{g}"] = Estimator(kind, models, weighted, crossed)
    return out


def _presets() -> dict[str, Models]:
    inter = RestrictedInteractions(2, patterns=(GENOTYPE_PATTERN,))

    def stack(task, i=False):
        glm = Linear(interactions=i) if task == "regression" else Logistic(interactions=i)
        return Stack((("glmnet", ElasticNet(interactions=i)), ("lr", glm), ("trees", Tuned())))

    sl_g = stack("classification")
    glm_q, glmnet_q = (Linear(), Logistic()), (ElasticNet(), ElasticNet())
    return {
        "glm": Models(*glm_q, Logistic()),
        "glmnet": Models(*glmnet_q, ElasticNet()),
        "glm-with-interactions-for-Q": Models(
            Linear(interactions=inter), Logistic(interactions=inter), Logistic()
        ),
        "glmnet-with-interactions-for-Q": Models(
            ElasticNet(interactions=inter), ElasticNet(interactions=inter), ElasticNet()
        ),
        "tuned-xgboost": same_model(Tuned()),
        "superlearning": Models(stack("regression"), sl_g, sl_g),
        "superlearning-with-interactions-for-Q": Models(
            stack("regression", inter), stack("classification", inter), sl_g
        ),
        "G-superlearning-Q-glm": Models(*glm_q, sl_g),
        "G-superlearning-Q-glmnet": Models(*glmnet_q, sl_g),
    }


PRESETS = _presets()


def preset(name: str) -> dict[str, Estimator]:
    """A weighted estimator on one of the named model sets."""
    if name not in PRESETS:
        raise ValueError(f"unknown preset: {name}")
    return {"TMLE": TMLE(PRESETS[name], weighted=True, lower=PROPENSITY_BOUND)}


# --- data files ------------------------------------------------------------------


def _interactions(spec):
    if not spec:
        return False
    if spec is True:
        return True
    if spec == "all":
        return RestrictedInteractions(2, everything=True)
    return RestrictedInteractions(
        int(spec.get("order", 2)),
        tuple(spec.get("primary", ())),
        tuple(spec.get("patterns", ())),
        bool(spec.get("all", False)),
    )


def model_from_dict(d) -> Model:
    """``{"model": "elastic_net", "alpha": 0.5, "interactions": {...}}``; members of a
    stack are a mapping name -> model."""
    if isinstance(d, Model):
        return d
    if isinstance(d, str):
        d = {"model": d}
    options = {k: v for k, v in d.items() if k != "model"}
    name = str(d["model"]).lower()
    if "interactions" in options:
        options["interactions"] = _interactions(options["interactions"])
    if name == "stack":
        meta = options.get("metalearner")
        members = tuple((n, model_from_dict(m)) for n, m in options["members"].items())
        return Stack(members, model_from_dict(meta) if meta else None)
    if name == "tuned":
        base = options.get("trees", {})
        return Tuned(
            Trees(**base),
            **{k: tuple(v) for k, v in options.items() if k in ("max_depth", "penalty")},
        )
    if name == "spark":
        return foreign_from_dict(options)
    if name == "saturated":
        on = options.get("on")
        return Saturated(tuple(on) if on is not None else None)
    known = {
        "linear": Linear,
        "logistic": Logistic,
        "elastic_net": ElasticNet,
        "trees": Trees,
        "constant": Constant,
    }
    if name not in known:
        raise ValueError(f"unknown model: {name}")
    return known[name](**options)


def estimators_from_dict(d: Mapping) -> dict[str, Estimator]:
    """``{name: {"type", "weighted", "cross_fitted", "lower", "models": {"Q_continuous",
    "Q_binary", "G", <variable>: …}}}``; an entry may instead name a preset."""
    out = {}
    for name, spec in dict(d.get("estimators", d)).items():
        if "preset" in spec:
            models = PRESETS[spec["preset"]]
        else:
            given = {k: model_from_dict(v) for k, v in spec["models"].items()}
            own = tuple((k, v) for k, v in given.items() if k not in ("Q_continuous", "Q_binary", "G"))
            models = Models(given["Q_continuous"], given["Q_binary"], given["G"], own)
        out[name] = Estimator(
            str(spec.get("type", "tmle")).lower(),
            models,
            bool(spec.get("weighted", False)),
            bool(spec.get("cross_fitted", False)),
            float(spec.get("lower", PROPENSITY_BOUND)),
        )
    return out


def resolve_estimators(spark: SparkSession, spec, treatments: Iterable[str]) -> dict[str, Estimator]:
    """From a mapping of ready estimators, a ``.json``/``.yaml`` file, a preset name or
    an estimator string.  Files hold data only; nothing in them is executed."""
    if isinstance(spec, Mapping):
        if all(isinstance(v, Estimator) for v in spec.values()):
            return dict(spec)
        return estimators_from_dict(spec)
    text = str(spec)
    if text.endswith((".json", ".yaml", ".yml")):
        body = spark.read.text(text, wholetext=True).first()[0]
        return estimators_from_dict(
            json.loads(body) if text.endswith(".json") else yaml.safe_load(body)
        )
    if text in PRESETS:
        return preset(text)
    return estimators_from_string(text, treatments)
