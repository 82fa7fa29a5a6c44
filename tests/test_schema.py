import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfold.functions.scalar import lossless_cast
from counterfold.operators.schema import (
    complete_case_ids,
    dropped_case_ids,
    exact_patterns,
    make_categorical,
    make_float,
    matching_columns,
    profile,
)


def coercion(spark):
    rows = [
        (1.1, 1.0, 1.0, 1, None, 1.0, None, 1),
        (2.2, 0.0, 0.0, 0, "AC", 0.0, 0.0, 2),
        (None, None, None, None, "CC", 0.0, 0.0, 3),
        (3.5, 1.0, 1.0, 0, "CC", 1.0, 0.0, 4),
        (6.6, 0.0, 2.0, 0, None, 0.0, 0.0, 5),
        (0.0, 0.0, 0.0, 0, "AA", 1.0, 0.0, 6),
        (4.0, 0.0, 3.0, None, "AA", 1.0, 0.0, 6),
    ]
    return spark.createDataFrame(
        rows,
        "Ycont double, Ybin double, Ycount double, T1 int, T2 string, W1 double, W2 double, C int",
    )


def test_kinds(spark):
    k = profile(coercion(spark))
    assert k["T1"].finite and k["T1"].levels == (0, 1)
    assert k["T2"].finite and k["T2"].levels == ("AA", "AC", "CC")
    assert k["Ycont"].kind == "continuous" and k["Ycont"].outcome_kind == "continuous"
    assert k["Ybin"].binary and k["Ybin"].outcome_kind == "binary"
    assert not k["Ycount"].binary and k["Ycount"].outcome_kind == "continuous"
    assert k["W1"].levels == (0.0, 1.0) and k["W2"].levels == (0.0,)
    assert k["C"].kind == "count"
    assert k["T2"].nulls == 2


def test_one_valued_column_is_not_binary(spark):
    k = profile(spark.range(10).select(F.lit(1).alias("a"), (F.col("id") % 2 == 0).alias("b")))
    assert not k["a"].binary and k["b"].binary


def test_profile_with_late_values(spark):
    """Columns that look finite at first and are not."""
    df = spark.range(30_000).select(
        F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("x"),
        (F.col("id") % 4).alias("y"),
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("z"),
    )
    k = profile(df.coalesce(1))
    assert k["x"].kind == "count" and k["x"].nulls == 0 and k["x"].rows == 30_000
    assert k["y"].levels == (0, 1, 2, 3)
    assert k["z"].kind == "count" and k["z"].nulls == len(range(0, 30_000, 7))


def test_complete_cases(spark):
    def rows(w1):
        return spark.createDataFrame(
            [(1, 1, w1[0], None, 1, 1), (2, 2, w1[1], 2, 2, 2), (3, 3, w1[2], 3, 3, 3),
             (4, None, w1[3], 4, 4, 4), (5, 5, w1[4], 5, 5, None)],
            "SAMPLE_ID int, Y int, W1 int, W2 int, T1 int, T2 int",
        )

    names = ["Y", "T1", "T2", "W1", "W2"]
    ids = complete_case_ids(rows([1, 2, 3, 4, 5]), names, "SAMPLE_ID")
    assert sorted(r[0] for r in ids.collect()) == [2, 3]
    ids = complete_case_ids(rows([1, 2, None, 4, 5]), names, "SAMPLE_ID")
    assert [r[0] for r in ids.collect()] == [2]
    dropped = dropped_case_ids(rows([1, 2, None, 4, 5]), names, "SAMPLE_ID")
    assert sorted(r[0] for r in dropped.collect()) == [1, 3, 4, 5]


def test_categorical_and_float(spark):
    df = spark.createDataFrame([(1, "AA", 1), (0, "AC", 2)], "T1 int, T2 string, C1 int")
    out, info = make_categorical(df, ["T1", "T2"], infer_ordered=True)
    assert info["T1"]["ordered"] and not info["T2"]["ordered"]
    assert isinstance(out.schema["T1"].dataType, T.StringType)
    _, info = make_categorical(df, ["T1", "T2"])
    assert not info["T1"]["ordered"]
    assert isinstance(make_float(df, "C1").schema["C1"].dataType, T.DoubleType)


@pytest.mark.parametrize(
    "value,dtype,want",
    [
        (1, T.BooleanType(), True), (0.0, T.BooleanType(), False), ("true", T.BooleanType(), True),
        (False, T.IntegerType(), 0), (2.0, T.LongType(), 2), ("3", T.LongType(), 3),
        (True, T.DoubleType(), 1.0), ("AC", T.StringType(), "AC"),
    ],
)
def test_levels_cast(value, dtype, want):
    got = lossless_cast(value, dtype)
    assert got == want and type(got) is type(want)


@pytest.mark.parametrize(
    "value,dtype", [(2, T.BooleanType()), (1.5, T.LongType()), ("AC", T.LongType())]
)
def test_lossy_levels_raise(value, dtype):
    with pytest.raises(ValueError):
        lossless_cast(value, dtype)


def test_patterns():
    assert matching_columns(["T1", "T12", "W"], exact_patterns(["T1"])) == ["T1"]
    assert matching_columns(["a.b", "axb"], exact_patterns(["a.b"])) == ["a.b"]
    assert matching_columns(["a", "b"], None) == ["a", "b"]
