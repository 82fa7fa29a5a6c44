"""Column helpers shared by operators, models and plans."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """A column by its exact name, whatever commas, dots or slashes it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def expit(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def two_sided_p(z: float) -> float:
    """Normal tail on both sides; used on result rows only."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def lossless_cast(value, dtype: T.DataType):
    """``value`` as the column type holds it; raises when it would change.

    1 and 1.0 become true in a boolean column, false becomes 0 in an integer one.
    """
    failure = ValueError(f"level {value!r} cannot be held by a {dtype.simpleString()} column")
    if value is None:
        raise failure
    if isinstance(dtype, T.StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(dtype, T.BooleanType):
        if isinstance(value, str):
            text = value.strip().lower()
            if text in ("true", "false"):
                return text == "true"
            raise failure
        if value in (0, 1):
            return bool(value)
        raise failure
    if isinstance(value, str):
        try:
            value = float(value) if "." in value or "e" in value.lower() else int(value)
        except ValueError:
            raise failure from None
    if isinstance(dtype, T.IntegralType):
        if float(value) == int(value):
            return int(value)
        raise failure
    if isinstance(dtype, T.FractionalType):
        return float(value)
    raise failure
