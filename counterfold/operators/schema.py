"""Column kinds: one profile of the table, then roles decide how a column is used.

The profile never changes a column.  ``kind`` is how the column serves as a
covariate or treatment, ``outcome_kind`` how it serves as an outcome.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.functions.scalar import quoted

# A column with at most this many distinct values may count as finite.
MAX_FINITE_LEVELS = 100
# Columns profiled by one scan.
COLUMNS_PER_PASS = 200


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    dtype: T.DataType
    rows: int
    nulls: int
    distinct: int  # exact when ``levels`` is filled, else an upper bound
    levels: tuple | None  # sorted distinct values of a column with few of them
    threshold: int

    @property
    def finite(self) -> bool:
        return self.levels is not None and (
            isinstance(self.dtype, (T.BooleanType, T.StringType))
            or len(self.levels) <= self.threshold
        )

    @property
    def kind(self) -> str:
        if self.finite:
            return "finite"
        if isinstance(self.dtype, T.IntegralType):
            return "count"
        if isinstance(self.dtype, T.NumericType):
            return "continuous"
        return "text" if isinstance(self.dtype, T.StringType) else "other"

    @property
    def outcome_kind(self) -> str:
        return "binary" if self.binary else "continuous"

    @property
    def binary(self) -> bool:
        """Exactly the two values 0 and 1 among those that are not null."""
        if self.levels is None or isinstance(self.dtype, T.StringType):
            return False
        return sorted(float(v) for v in self.levels) == [0.0, 1.0]


def finite_threshold(rows: int, max_levels: int = MAX_FINITE_LEVELS) -> int:
    return max(4, int(min(0.3 * rows, max_levels)))


def profile(
    df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = MAX_FINITE_LEVELS
) -> dict[str, ColumnProfile]:
    """Rows, nulls and, where there are few, the levels of each column.

    One scan counts and sketches the distinct values of all columns; a second collects the values
    of those whose sketch is small.  A sketch errs by a few percent, so twice the limit
    is enough to miss no column that has few; how many it has is then counted exactly.
    """
    names = list(dict.fromkeys(columns if columns is not None else df.columns))
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in names if c not in fields]
    if missing:
        raise ValueError(f"columns not in the table: {missing}")
    out: dict[str, ColumnProfile] = {}
    for start in range(0, len(names), COLUMNS_PER_PASS):
        part = names[start : start + COLUMNS_PER_PASS]
        plain = [c for c in part if not isinstance(
            fields[c], (T.ArrayType, T.MapType, T.StructType))]
        row = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count(quoted(c)).alias(f"f{i}") for i, c in enumerate(part)],
            *[F.approx_count_distinct(quoted(c)).alias(f"d{plain.index(c)}") for c in plain],
        ).first()
        few = [c for i, c in enumerate(plain) if row[f"d{i}"] <= 2 * (max_levels + 2)]
        sets = df.agg(*[F.collect_set(quoted(c)).alias(f"s{i}") for i, c in enumerate(few)]).first(
        ) if few else None
        limit = finite_threshold(row["n"], max_levels)
        for i, c in enumerate(part):
            values, distinct = None, row["n"]
            if c in few:
                values = tuple(sorted(set(sets[f"s{few.index(c)}"])))
                distinct = len(values)
            kept = values if values is not None and distinct <= max_levels else None
            out[c] = ColumnProfile(
                c, fields[c], row["n"], row["n"] - row[f"f{i}"], distinct, kept, limit)
    return out


def column_kinds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The profile as a table: column, kind, outcome_kind, distinct count if few."""
    rows = [
        (p.name, p.kind, p.outcome_kind, int(p.nulls), p.distinct if p.finite else None)
        for p in profile(df, columns).values()
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, kind string, outcome_kind string, nulls bigint, levels bigint"
    )


def as_outcome(df: DataFrame, name: str) -> Column:
    """Outcomes are doubles; two-level ones stay 0/1."""
    return quoted(name).cast("double")


def make_float(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    names = [columns] if isinstance(columns, str) else list(columns)
    return df.withColumns({c: quoted(c).cast("double") for c in names})


def make_categorical(
    df: DataFrame, columns: str | Iterable[str], infer_ordered: bool = False
) -> tuple[DataFrame, dict[str, dict]]:
    """Columns as text levels, and per column its sorted levels and orderedness.

    A numeric column is ordered when ``infer_ordered`` is set; text never is.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    fields = {f.name: f.dataType for f in df.schema.fields}
    found = profile(df, names)
    info = {}
    for c in names:
        numeric = isinstance(fields[c], (T.NumericType, T.BooleanType))
        levels = found[c].levels
        if levels is None:
            raise ValueError(f"column {c} has too many values to be categorical")
        info[c] = {"levels": levels, "ordered": bool(infer_ordered and numeric)}
    return df.withColumns({c: quoted(c).cast("string") for c in names}), info


def matching_columns(columns: Iterable[str], patterns: Iterable[str] | None) -> list[str]:
    """Names found by any of the patterns; all names when there is none."""
    if patterns is None:
        return list(columns)
    compiled = [re.compile(p) for p in patterns]
    return [c for c in columns if any(p.search(c) for p in compiled)]


def exact_patterns(names: Iterable[str]) -> list[str]:
    return [f"^{re.escape(n)}$" for n in names]


def _complete(variables: Iterable[str]) -> Column | None:
    keep = None
    for c in sorted(set(variables)):
        test = quoted(c).isNotNull()
        keep = test if keep is None else keep & test
    return keep


def complete_cases(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    """Rows without a null in any of the variables."""
    keep = _complete(variables)
    return df if keep is None else df.where(keep)


def complete_case_ids(df: DataFrame, variables: Iterable[str], key: str) -> DataFrame:
    return complete_cases(df, variables).select(quoted(key))


def dropped_case_ids(df: DataFrame, variables: Iterable[str], key: str) -> DataFrame:
    """Rows that the complete-case filter leaves out; a filter too, so no join."""
    keep = _complete(variables)
    return df.where(~keep if keep is not None else F.lit(False)).select(quoted(key))
