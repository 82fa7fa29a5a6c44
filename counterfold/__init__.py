"""Causal effects on large tables: targeted estimation as Spark jobs."""

from counterfold.models import (
    Constant,
    ElasticNet,
    FitFailed,
    Foreign,
    Linear,
    Logistic,
    Saturated,
    Stack,
    Trees,
    Tuned,
)
from counterfold.operators.features import GenotypeEncoder, RestrictedInteractions
from counterfold.operators.folds import Resampling, with_folds
from counterfold.plans.engine import Engine, estimate_effects
from counterfold.plans.estimands import (
    AIE,
    ATE,
    CM,
    Configuration,
    Graph,
    Joint,
    factorial_ate,
    identify,
)
from counterfold.plans.registry import (
    OSE,
    PRESETS,
    TMLE,
    Models,
    estimators_from_string,
    preset,
    same_model,
)
from counterfold.sinks import Outputs, merge_results

__all__ = [
    "AIE", "ATE", "CM", "Configuration", "Constant", "ElasticNet", "Engine", "FitFailed", "Foreign",
    "GenotypeEncoder", "Graph", "Joint", "Linear", "Logistic", "Models", "OSE", "Outputs",
    "PRESETS", "Resampling", "RestrictedInteractions", "Saturated", "Stack", "TMLE", "Trees", "Tuned",
    "estimate_effects", "estimators_from_string", "factorial_ate", "identify",
    "merge_results", "preset", "same_model", "with_folds",
]
