"""Cross-validation folds as a column.

Folds need the rank of every row in a total order, by stratum.  A window without
partitions, or one per stratum, would put a third of a large table into one task,
so the order is cut into buckets of about equal size: ranks inside a bucket come
from a window, the rest from a table of bucket counts and its running sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from counterfold.functions.scalar import quoted
from counterfold.operators.schema import matching_columns, profile
from counterfold.session import cut_lineage

# Effective sample size below the bound -> number of folds;
# below the first bound every effective sample is its own fold.
SMALL_SAMPLE = 30
FOLDS_BY_SIZE = [(500, 20), (5_000, 10), (10_000, 5)]
FOLDS_LARGE = 3
# Fixed value: weight of the rarest class in the effective sample size.
RARE_CLASS_FACTOR = 5
# Fixed value: folds when none are asked for.
DEFAULT_FOLDS = 6
# Fixed value: folds of a run unless it says otherwise.
DEFAULT_ENGINE_FOLDS = 3

POS = "__pos"
HASH_BITS = 12
MAX_BUCKETS = 4096


def with_row_key(df: DataFrame, name: str = "__row") -> DataFrame:
    """Number the rows of a table that has no key.  The numbers are written once
    to the shared folder: computed again they could differ."""
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))


@dataclass(frozen=True)
class KeyOrder:
    """The order of rows by key and its cut into buckets that never decrease along it.

    ``cuts`` are bucket borders; they only balance the work, ranks are exact whatever
    they are.  With a seed the order is that of a hash, which needs no borders.
    """

    key: str
    seed: int | None = None
    cuts: tuple = ()
    numeric: bool = True

    def add(self, df: DataFrame) -> DataFrame:
        """Add ``__o`` (order) and ``__b`` (bucket)."""
        if self.seed is not None:
            df = df.withColumn("__o", F.xxhash64(quoted(self.key), F.lit(self.seed)))
            return df.withColumn("__b", F.shiftright(F.col("__o"), 64 - HASH_BITS))
        df = df.withColumn("__o", quoted(self.key))
        if not self.cuts:
            return df.withColumn("__b", F.lit(0))
        if not self.numeric:
            cuts = np.array(self.cuts, dtype=object)

            @F.pandas_udf("int")
            def slot(keys: pd.Series) -> pd.Series:
                return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "right"))

            return df.withColumn("__b", slot(F.col("__o")))
        borders = [-float("inf"), *self.cuts, float("inf")]
        search = Bucketizer(splits=borders, inputCol="__k", outputCol="__b", handleInvalid="keep")
        found = search.transform(df.withColumn("__k", _as_number(df, self.key))).drop("__k")
        return found.withColumn("__b", F.col("__b").cast("int"))


def _as_number(df: DataFrame, key: str) -> Column:
    c = quoted(key)
    if isinstance(df.schema[key].dataType, T.NumericType):
        return c.cast("double")
    return c.cast("timestamp").cast("double")


def key_order(df: DataFrame, key: str, seed: int | None = None) -> KeyOrder:
    """The order of a table by a key, which must be unique and never null."""
    check_key(df, key)
    if seed is not None:
        return KeyOrder(key, seed)
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    buckets = min(max(2, wanted), MAX_BUCKETS)
    places = [i / buckets for i in range(1, buckets)]
    dtype = df.schema[key].dataType
    if isinstance(dtype, (T.NumericType, T.TimestampType, T.DateType)):
        found = df.select(_as_number(df, key).alias("k")).approxQuantile("k", places, 0.25 / buckets)
        return KeyOrder(key, None, tuple(sorted(set(found))))
    # Text keys: borders from a bounded sample of keys.
    total = df.count()
    share = min(1.0, 50.0 * buckets / max(total, 1))
    seen = sorted(r[0] for r in df.select(quoted(key)).sample(share, 7).collect())
    cuts = sorted({seen[int(len(seen) * p)] for p in places}) if seen else []
    return KeyOrder(key, None, tuple(cuts), False)


def stratum_column(
    df: DataFrame,
    features: Sequence[str],
    outcome: str | None = None,
    patterns: Sequence[str] | None = None,
    kinds: dict | None = None,
) -> Column:
    """Composite text of the finite features (by name pattern) and a finite outcome:
    ``_v1_v2…`` in table order, the outcome last, null as ``missing``."""
    named = matching_columns(features, patterns)
    wanted = named + ([outcome] if outcome is not None else [])
    kinds = kinds if kinds is not None else profile(df, wanted)
    parts: list[Column] = []
    for c in wanted:
        if kinds[c].finite:
            parts += [F.lit("_"), F.coalesce(quoted(c).cast("string"), F.lit("missing"))]
    return F.concat(*parts) if parts else F.lit("")


@dataclass(frozen=True)
class Placed:
    """Rows with their position, and how many there are (overall, in the rarest stratum)."""

    df: DataFrame
    counts: DataFrame

    def sizes(self) -> tuple[int, int]:
        per = self.counts.groupBy("__s").agg(F.sum("__c").alias("t"))
        row = per.agg(F.sum("t").alias("n"), F.min("t").alias("rarest")).first()
        return int(row["n"] or 0), int(row["rarest"] or 0)


def with_positions(
    df: DataFrame,
    key: str,
    stratum: Column | None = None,
    seed: int | None = None,
    ordering: KeyOrder | None = None,
) -> DataFrame:
    """Add ``__pos``: the row's place (from 0) when strata follow one another in
    order of first appearance and rows inside a stratum follow the key (or, with a
    seed, a hash of it).  ``key`` must be unique.  ``ordering`` is the result of
    ``key_order`` when several tables share one key."""
    return place(df, key, stratum, seed, ordering).df


def place(df, key, stratum=None, seed=None, ordering=None) -> Placed:
    ordering = ordering or key_order(df, key, seed)
    rows = ordering.add(df.withColumn("__s", stratum if stratum is not None else F.lit("")))
    # A small table (strata x buckets) that three branches read: computed once, so the
    # rows are scanned for it once.
    counts = (
        rows.groupBy("__s", "__b")
        .agg(F.count(F.lit(1)).alias("__c"), F.min("__o").alias("__first"))
        .persist()
    )
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("__in", F.coalesce(F.sum("__c").over(before), F.lit(0)))
    # Strata by first appearance: running totals in two steps, by the bucket in
    # which a stratum starts, then over the (few) buckets.
    strata = counts.groupBy("__s").agg(
        F.sum("__c").alias("__t"), F.min("__first").alias("__first"), F.min("__b").alias("__sb")
    )
    starts = strata.groupBy("__sb").agg(F.sum("__t").alias("__bt"))
    bw = Window.orderBy("__sb").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("__sb", F.coalesce(F.sum("__bt").over(bw), F.lit(0)).alias("__base"))
    sw = Window.partitionBy("__sb").orderBy("__first").rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("__run", F.coalesce(F.sum("__t").over(sw), F.lit(0)))
    strata = strata.join(starts, "__sb").select(
        "__s", (F.col("__base") + F.col("__run")).alias("__so")
    )
    offsets = inside.join(strata, "__s").select(
        "__s", "__b", (F.col("__in") + F.col("__so")).alias("__off")
    )
    ties = ["__o"] if seed is None else ["__o", quoted(key)]
    rank = F.row_number().over(Window.partitionBy("__s", "__b").orderBy(*ties)) - 1
    placed = (
        rows.withColumn("__rk", rank)
        .join(offsets, ["__s", "__b"])
        .withColumn(POS, F.col("__off") + F.col("__rk"))
        .drop("__s", "__o", "__b", "__rk", "__off")
    )
    return Placed(placed, counts)


def check_key(df: DataFrame, key: str) -> None:
    """Raise unless every row has a key of its own: ranks and folds would not be defined.

    Keys are counted before they are shuffled, so a key that many rows share is one row a task.
    """
    k = quoted(key)
    bad = df.groupBy(k.alias("k")).count().where("k IS NULL OR count > 1").orderBy(
        F.col("count").desc()).first()
    if bad is not None:
        what = "is null" if bad["k"] is None else f"is not unique: {bad['k']!r} lies"
        raise ValueError(f"the key {key} {what} in {bad['count']} rows")


@dataclass(frozen=True)
class Resampling:
    """How a run splits its rows.

    ``folds``: their number, or None for one that follows from the rows (from those of the rarest
    stratum, if there are strata).  ``by``: ``joint`` balances folds over the treatments and
    a two-level outcome, ``outcome`` over such an outcome alone, ``key`` cuts blocks in
    the order of the key.  ``patterns`` choose among the treatments by name.
    """

    folds: int | None = DEFAULT_ENGINE_FOLDS
    by: str = "joint"
    patterns: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.by not in ("joint", "outcome", "key"):
            raise ValueError(f"unknown resampling: {self.by}")
        if self.folds is not None and self.folds < 2:
            raise ValueError("two folds at least")

    def stratum(self, df, features, outcome, kinds) -> Column | None:
        if self.by == "key":
            return None
        named = features if self.by == "joint" else []
        return stratum_column(df, named, outcome, self.patterns if named else None, kinds)

    def assign(self, placed: Placed, names: Sequence[str]) -> tuple[DataFrame, int]:
        """The fold columns, each balanced inside those before it, and the number of folds."""
        k = self.folds
        rows = rarest = None
        if k is None or self.by == "key":
            rows, rarest = placed.sizes()
        if k is None:
            k = max(2, folds_for(rows if self.by == "key" else min(rows, RARE_CLASS_FACTOR * rarest)))
        pos = F.col(POS)
        columns = {
            name: contiguous(pos, k, rows) if self.by == "key" and level == 0
            else round_robin(pos, k, level - (self.by == "key"))
            for level, name in enumerate(names)
        }
        return placed.df.withColumns(columns).drop(POS), k


def resampling_from(value) -> Resampling:
    """A strategy, a number of folds, a mapping of its fields, or text such as ``adaptive``,
    ``5``, ``adaptive-outcome`` or ``4-key``."""
    if isinstance(value, Resampling):
        return value
    if isinstance(value, int):
        return Resampling(value)
    if isinstance(value, Mapping):
        own = dict(value)
        if own.get("patterns") is not None:
            own["patterns"] = tuple(own["patterns"])
        return Resampling(**own)
    number, _, by = str(value).partition("-")
    return Resampling(None if number == "adaptive" else int(number), by or "joint")


def round_robin(pos: Column, folds: int, level: int = 0) -> Column:
    """Fold 1..K by turns.  ``level`` 1, 2… give further balanced assignments that
    cut across the earlier ones (the next digits of the position in base K)."""
    return (F.floor(pos / F.lit(folds**level)) % F.lit(folds) + F.lit(1)).cast("int")


def contiguous(pos: Column, folds: int, rows: int) -> Column:
    """K blocks in order; the first ``rows mod K`` blocks are one row longer."""
    size, longer = divmod(rows, folds)
    edge = longer * (size + 1)
    late = F.floor((pos - F.lit(edge)) / F.lit(max(size, 1))) + F.lit(longer)
    return (
        F.when(pos < F.lit(edge), F.floor(pos / F.lit(size + 1))).otherwise(late) + F.lit(1)
    ).cast("int")


def count_levels(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """Rows per distinct combination; with a key also its first appearance."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if key is not None:
        aggs.append(F.min(quoted(key)).alias("first_key"))
    return df.groupBy(*[quoted(c) for c in columns]).agg(*aggs)


def effective_size(df: DataFrame, outcome: str | Column, finite: bool) -> DataFrame:
    """One row: n, rarest class count, effective sample size and number of folds."""
    y = quoted(outcome) if isinstance(outcome, str) else outcome
    if finite:
        by = df.groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("c"))
        base = by.agg(F.sum("c").cast("bigint").alias("n"), F.min("c").alias("rarest"))
        neff = F.least(F.col("n"), F.col("rarest") * RARE_CLASS_FACTOR)
    else:
        base = df.agg(
            F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("rarest")
        )
        neff = F.col("n")
    base = base.withColumn("neff", neff)
    folds = F.when(F.col("neff") < SMALL_SAMPLE, F.col("neff"))
    for bound, k in FOLDS_BY_SIZE:
        folds = folds.when(F.col("neff") < bound, F.lit(k))
    return base.withColumn("nfolds", folds.otherwise(F.lit(FOLDS_LARGE)).cast("bigint"))


def adaptive_folds(df: DataFrame, outcome: str | Column, finite: bool) -> int:
    return int(effective_size(df, outcome, finite).first()["nfolds"])


def with_folds(
    df: DataFrame,
    key: str,
    kind: str = "cv",
    k: int | None = None,
    outcome: str | None = None,
    strata: Sequence[str] | None = None,
    patterns: Sequence[str] | None = None,
    seed: int | None = None,
    name: str = "fold",
) -> DataFrame:
    """Add the validation fold of each row.

    kind: ``cv`` contiguous blocks; ``stratified`` by the outcome; ``joint`` by the
    finite ``strata`` columns (filtered by ``patterns``) and a finite outcome;
    ``adaptive`` / ``adaptive-stratified`` / ``adaptive-joint`` choose K themselves.
    With a seed the rows are shuffled first.
    """
    adaptive = kind.startswith("adaptive")
    base = kind.removeprefix("adaptive").strip("-") or "cv"
    if base not in ("cv", "stratified", "joint"):
        raise ValueError(f"unknown fold strategy: {kind}")
    stratum = None
    if base == "stratified":
        if outcome is None:
            raise ValueError("stratified folds need an outcome")
        stratum = F.coalesce(quoted(outcome).cast("string"), F.lit("missing"))
    elif base == "joint":
        stratum = stratum_column(df, strata or [], outcome, patterns)
    placed = place(df, key, stratum, seed)
    rows, rarest = placed.sizes()
    if adaptive:
        if base == "cv":
            finite = outcome is not None and profile(df, [outcome])[outcome].finite
            k = adaptive_folds(df, outcome, True) if finite else folds_for(rows)
        else:
            k = folds_for(min(rows, RARE_CLASS_FACTOR * rarest))
    k = k or DEFAULT_FOLDS
    if base == "cv":
        fold = contiguous(F.col(POS), k, rows)
    else:
        fold = round_robin(F.col(POS), k)
    return placed.df.withColumn(name, fold).drop(POS)


def folds_for(effective: int) -> int:
    """Number of folds for an effective sample size."""
    if effective < SMALL_SAMPLE:
        return max(effective, 1)
    return next((k for bound, k in FOLDS_BY_SIZE if effective < bound), FOLDS_LARGE)
