"""Feature transformers: restricted interactions and genotype dosage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.functions.scalar import quoted
from counterfold.operators.schema import matching_columns


class InvalidColumn(ValueError):
    pass


@dataclass(frozen=True)
class RestrictedInteractions:
    """Products of columns up to ``order`` in which at most one column is not primary.

    Primary columns are those named, then those found by a pattern.  With every
    column primary this is the unrestricted interaction transformer.
    """

    order: int = 2
    primary: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    everything: bool = False

    def __post_init__(self):
        if self.order < 2:
            raise ValueError("order must be above 1")

    def terms(self, columns: Sequence[str]) -> list[tuple[str, ...]]:
        if self.everything:
            first = list(columns)
        else:
            by_name = [c for c in columns if c in self.primary]
            by_pattern = matching_columns(columns, self.patterns) if self.patterns else []
            first = list(dict.fromkeys(by_name + by_pattern))
        rest = [c for c in columns if c not in first]
        found: list[tuple[str, ...]] = []
        for size in range(2, self.order + 1):
            found += combinations(first, size)
            found += [
                (*head, other) for head in combinations(first, size - 1) for other in rest
            ]
        return found

    def fit(self, df: DataFrame, columns: Sequence[str] | None = None) -> FittedInteractions:
        names = list(columns if columns is not None else df.columns)
        types = {f.name: f.dataType for f in df.schema.fields}
        for c in names:
            if not isinstance(types[c], T.NumericType):
                raise InvalidColumn(f"column {c} is not numeric and cannot enter an interaction")
        return FittedInteractions(tuple(self.terms(names)))


@dataclass(frozen=True)
class FittedInteractions:
    interactions: tuple[tuple[str, ...], ...]

    @property
    def names(self) -> list[str]:
        return ["_&_".join(t) for t in self.interactions]

    def transform(self, df: DataFrame) -> DataFrame:
        products = [
            reduce(lambda a, b: a * b, [quoted(c).cast("double") for c in t]).alias(n)
            for t, n in zip(self.interactions, self.names)
        ]
        return df.select("*", *products)


class GenotypeError(ValueError):
    pass


@dataclass(frozen=True)
class GenotypeEncoder:
    """Two-letter genotypes to the count of a reference letter, for all columns
    found by a pattern.  The reference letter is the first letter of the first
    genotype in alphabetical order."""

    patterns: tuple[str, ...]

    def fit(self, df: DataFrame) -> FittedGenotypes:
        names = matching_columns(df.columns, self.patterns)
        types = {f.name: f.dataType for f in df.schema.fields}
        aggs = []
        for i, c in enumerate(names):
            if not isinstance(types[c], T.StringType):
                raise GenotypeError(
                    f"column {c} matches a genotype pattern but is not categorical text"
                )
            g = quoted(c)
            letters = F.filter(F.split(g, ""), lambda x: x != "")
            aggs += [
                F.min(g).alias(f"min{i}"),
                F.min(F.when(F.length(g) != 2, g)).alias(f"odd{i}"),
                F.min(F.array_min(letters)).alias(f"low{i}"),
                F.max(F.array_max(letters)).alias(f"high{i}"),
            ]
        if not names:
            return FittedGenotypes({})
        row = df.agg(*aggs).first()
        # Exactly two letters: the smallest and the largest differ, and no genotype
        # holds anything else.
        tests = []
        for i, c in enumerate(names):
            low, high = row[f"low{i}"], row[f"high{i}"]
            others = F.lit(False)
            if low is not None:
                left = F.replace(F.replace(quoted(c), F.lit(low), F.lit("")), F.lit(high), F.lit(""))
                others = F.coalesce(F.length(left) > 0, F.lit(False))
            tests.append(F.max(others).alias(f"x{i}"))
        extra = df.agg(*tests).first()
        reference = {}
        for i, c in enumerate(names):
            low, high = row[f"low{i}"], row[f"high{i}"]
            if low is None or low == high or extra[f"x{i}"]:
                raise GenotypeError(f"{c} does not hold exactly two alleles")
            if row[f"odd{i}"] is not None:
                raise GenotypeError(f"genotype {row[f'odd{i}']} in column {c} is not bi-allelic")
            reference[c] = row[f"min{i}"][0]
        return FittedGenotypes(reference)


@dataclass(frozen=True)
class FittedGenotypes:
    reference: dict[str, str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Same columns in the same order; null genotypes stay null."""

        def dosage(c: str):
            g = quoted(c)
            left = F.replace(g, F.lit(self.reference[c]), F.lit(""))
            return (F.length(g) - F.length(left)).cast("bigint").alias(c)

        return df.select(*[dosage(c) if c in self.reference else quoted(c) for c in df.columns])

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            sorted(self.reference.items()), "column string, reference string"
        )
