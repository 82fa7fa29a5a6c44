from itertools import combinations

import pytest
from pyspark.sql import functions as F

from counterfold.operators.features import (
    GenotypeEncoder,
    GenotypeError,
    InvalidColumn,
    RestrictedInteractions,
)

COLUMNS = ["height", "g_a", "smoker", "g_b", "pc"]


def by_rule(first, rest, order):
    """For each order: all combinations of the first columns, then one fewer with each other."""
    out = []
    for k in range(2, order + 1):
        out += combinations(first, k)
        out += [(*c, b) for c in combinations(first, k - 1) for b in rest]
    return out


@pytest.mark.parametrize("order,named,patterns,first", [
    (2, ("smoker",), (), ["smoker"]),
    (3, ("pc", "g_b"), (), ["g_b", "pc"]),
    (2, (), ("^g_",), ["g_a", "g_b"]),
    (4, ("height",), ("^g_", "none"), ["height", "g_a", "g_b"]),
])
def test_interactions_follow_the_rule(order, named, patterns, first):
    got = RestrictedInteractions(order, named, patterns or None).terms(COLUMNS)
    rest = [c for c in COLUMNS if c not in first]
    assert got == by_rule(first, rest, order)


def test_a_small_case_in_full():
    got = RestrictedInteractions(3, ("smoker", "g_a")).terms(["smoker", "g_a", "pc"])
    assert got == [("smoker", "g_a"), ("smoker", "pc"), ("g_a", "pc"), ("smoker", "g_a", "pc")]


def test_interactions_transform(spark):
    df = spark.createDataFrame([(2.0, 3.0, 5.0), (1.0, 4.0, 0.5)], "a double, b double, c double")
    out = RestrictedInteractions(3, ("a", "b")).fit(df).transform(df)
    assert out.columns == ["a", "b", "c", "a_&_b", "a_&_c", "b_&_c", "a_&_b_&_c"]
    assert out.collect()[0][-1] == 30.0
    bad = spark.createDataFrame([("A1", 1)], "A string, B int")
    with pytest.raises(InvalidColumn, match="A"):
        RestrictedInteractions(2, ("A", "B")).fit(bad)
    with pytest.raises(ValueError):
        RestrictedInteractions(1)


def sites(spark, first):
    rows = list(zip(first, ["GT", "TT", "TT", "GT"], [4, 3, 2, 1]))
    return spark.createDataFrame(rows, "site_1 string, site_2 string, place int")


def test_genotypes(spark):
    df = sites(spark, ["TT", "AT", "AA", None])
    fit = GenotypeEncoder(("_1$", "_2$")).fit(df)
    assert fit.reference == {"site_1": "A", "site_2": "G"}
    out = fit.transform(df)
    assert out.columns == df.columns
    rows = out.orderBy(F.col("place").desc()).collect()
    assert [r["site_1"] for r in rows] == [0, 1, 2, None]
    assert [r["site_2"] for r in rows] == [1, 0, 0, 1]


@pytest.mark.parametrize(
    "first,message",
    [
        (["TT", "AT", "AAT", None], "AAT"),
        (["TT", "AT", "GT", None], "two alleles"),
        (["TT", "TT", None, None], "two alleles"),
    ],
)
def test_genotype_errors(spark, first, message):
    with pytest.raises(GenotypeError, match=message):
        GenotypeEncoder(("^site",)).fit(sites(spark, first))


def test_genotype_must_be_text(spark):
    df = spark.createDataFrame([(1,)], "rs1 int")
    with pytest.raises(GenotypeError, match="categorical"):
        GenotypeEncoder(("^rs",)).fit(df)
