"""Any ``pyspark.ml`` estimator as a nuisance model."""

from __future__ import annotations

import importlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfold.functions.scalar import quoted
from counterfold.models.base import Design, FitFailed, Frame, Model, Request

FEATURES, LABEL = "__features", "__label"


@dataclass(frozen=True)
class Foreign(Model):
    """``regressor`` learns numbers, ``classifier`` two-level targets and treatments.

    Either is an estimator with a features and a label column; a weight column is used if it has
    one, else rows that stand for several are refused.  Folds, counterfactual settings and the
    coding of parents are those of the other models.
    """

    regressor: object = None
    classifier: object = None
    interactions: object = False

    def fit(self, frame: Frame):
        estimator = self.regressor if frame.task == "regression" else self.classifier
        if estimator is None:
            raise FitFailed(f"no estimator for a {frame.task} target ({frame.target})")
        design = Design(frame.parents, frame.kinds, frame.treatments, self.interactions)
        if frame.task == "multi":
            levels = F.array(*[F.lit(v) for v in frame.levels])
            label = F.array_position(levels, quoted(frame.target)) - 1
        else:
            label = frame.y
        rows = frame.df.select(
            _vector(design.columns()).alias(FEATURES), label.cast("double").alias(LABEL),
            frame.weight.cast("double").alias("__weight")).persist()
        try:
            own = estimator.copy()
            own.set(own.featuresCol, FEATURES)
            own.set(own.labelCol, LABEL)
            if own.hasParam("weightCol"):
                own.set(own.weightCol, "__weight")
            elif not rows.where("__weight <> 1").isEmpty():
                raise FitFailed(f"{type(own).__name__} has no weights")
            if own.hasParam("seed"):
                own.set(own.seed, frame.seed)
            fitted = own.fit(rows)
        except FitFailed:
            raise
        except Exception as e:
            raise FitFailed(f"{frame.target}: {e}") from e
        finally:
            rows.unpersist()
        return ForeignFit(design, frame.task, fitted, frame.levels)


def _vector(columns: Sequence[Column]) -> Column:
    return array_to_vector(F.array(*([c.cast("double") for c in columns] or [F.lit(0.0)])))


@dataclass(frozen=True)
class ForeignFit:
    design: Design
    task: str
    fitted: object
    levels: tuple | None

    def transforms(self) -> int:
        return 1

    def add(self, df: DataFrame, requests: Sequence[Request]) -> DataFrame:
        keep, made = list(df.columns), {}
        out = df
        for r in requests:
            setting = tuple(sorted(r.override.items(), key=lambda kv: kv[0]))
            if setting not in made:
                made[setting] = f"__foreign{len(made)}"
                out = self._scores(out, dict(setting), made[setting])
        values = []
        for r in requests:
            score = F.col(made[tuple(sorted(r.override.items(), key=lambda kv: kv[0]))])
            if self.task == "regression":
                value = score
            elif self.task == "multi":
                value = F.get(score, F.lit(self.levels.index(r.level)))
            else:
                first = r.level is not None and r.level == self.levels[0]
                value = F.get(score, F.lit(0 if first else 1))
            values.append(value.alias(r.out))
        return out.select(*[quoted(c) for c in keep], *values)

    def _scores(self, df: DataFrame, setting: Mapping, name: str) -> DataFrame:
        keep = [quoted(c) for c in df.columns]
        fitted = self.fitted.copy()
        fitted.set(fitted.predictionCol, "__prediction")
        if fitted.hasParam("probabilityCol"):
            fitted.set(fitted.probabilityCol, "__probability")
        if fitted.hasParam("rawPredictionCol"):
            fitted.set(fitted.rawPredictionCol, "__raw")
        rows = fitted.transform(df.withColumn(FEATURES, _vector(self.design.columns(setting))))
        if self.task == "regression":
            value = F.col("__prediction")
        elif "__probability" in rows.columns:
            value = vector_to_array("__probability")
        else:  # a classifier that only names a class
            n = len(self.levels) if self.task == "multi" else 2
            value = F.array(*[(F.col("__prediction") == i).cast("double") for i in range(n)])
        return rows.select(*keep, value.alias(name))


def foreign_from_dict(d: Mapping) -> Foreign:
    """``{"regressor": {"class": "pyspark.ml.regression.…", …params}, "classifier": …}``.

    Only classes of ``pyspark.ml`` are looked up; a file cannot name other code.
    """

    def one(spec):
        if spec is None:
            return None
        module, _, name = str(spec["class"]).rpartition(".")
        if module not in ("pyspark.ml.regression", "pyspark.ml.classification"):
            raise ValueError(f"not an estimator of pyspark.ml: {spec['class']}")
        return getattr(importlib.import_module(module), name)(
            **{k: v for k, v in spec.items() if k != "class"})

    return Foreign(one(d.get("regressor")), one(d.get("classifier")), d.get("interactions", False))
