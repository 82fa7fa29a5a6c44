from counterfold.models.base import FitFailed, Frame, Request
from counterfold.models.ensemble import Stack, Tuned
from counterfold.models.foreign import Foreign
from counterfold.models.linear import ElasticNet, Linear, Logistic
from counterfold.models.simple import Constant, Saturated
from counterfold.models.trees import Trees

__all__ = [
    "Constant",
    "ElasticNet",
    "FitFailed",
    "Frame",
    "Linear",
    "Logistic",
    "Request",
    "Saturated",
    "Foreign",
    "Stack",
    "Trees",
    "Tuned",
]
