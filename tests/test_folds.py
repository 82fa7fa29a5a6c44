import pytest
from pyspark.sql import functions as F

from counterfold.operators.folds import (
    POS,
    adaptive_folds,
    count_levels,
    round_robin,
    stratum_column,
    with_folds,
    with_positions,
    with_row_key,
)
from counterfold.operators.schema import profile


def folds(df, *args, **kw):
    return [r["fold"] for r in with_folds(df, "id", *args, **kw).orderBy("id").collect()]


def test_contiguous_blocks(spark):
    df = spark.range(10)
    # fixed values: ten rows in six blocks, the first four one longer
    assert folds(df) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 6]
    assert folds(spark.range(11), "cv", 4) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4]


def test_stratified_goes_round_across_strata(spark):
    df = spark.createDataFrame([(i, "ab"[i >= 5]) for i in range(10)], "id int, y string")
    # fixed values: the second stratum goes on where the first has ended
    assert folds(df, "stratified", 3, "y") == [1, 2, 3, 1, 2, 3, 1, 2, 3, 1]
    mixed = spark.createDataFrame(list(enumerate("babba")), "id int, y string")
    assert folds(mixed, "stratified", 2, "y") == [1, 2, 2, 1, 1]


@pytest.mark.parametrize("n,k", [(29, 29), (30, 20), (499, 20), (500, 10), (4999, 10), (5000, 5),
                                 (9999, 5), (10000, 3)])
def test_adaptive_number_of_folds_at_its_borders(spark, n, k):
    assert adaptive_folds(spark.range(n), F.lit(1), False) == k


def test_adaptive_by_rarest_class(spark):
    small = spark.createDataFrame(list(enumerate("xxyyyzzzz")), "id int, y string")
    assert sorted(r["n"] for r in count_levels(small, ["y"]).collect()) == [2, 3, 4]
    assert adaptive_folds(small, "y", True) == 9
    large = spark.range(20_090).withColumn("y", F.col("id") >= 20_000)
    assert adaptive_folds(large, "y", True) == 20


def goods(spark):
    rows = [(0, "red", 3, 0.25, True), (1, "blue", 3, 1.5, True), (2, "red", None, -2.75, False),
            (3, None, 5, 9.0, False), (4, "blue", 5, 4.125, True), (5, "red", 3, 7.75, False)]
    return spark.createDataFrame(rows, "id int, colour string, shelf int, mass double, sold boolean")


def test_composite_stratum(spark):
    df = goods(spark)
    kinds = profile(df, ["colour", "shelf", "mass", "sold"])
    assert not kinds["mass"].finite

    def column(*args):
        s = stratum_column(df, *args)
        return [r[0] for r in df.orderBy("id").select(s).collect()]

    x = ["colour", "shelf", "mass"]
    assert column(x) == ["_red_3", "_blue_3", "_red_missing", "_missing_5", "_blue_5", "_red_3"]
    assert column(x, "sold")[0] == "_red_3_true" and column(x, "sold")[3] == "_missing_5_false"
    assert column(x, "mass", ["^sh"]) == ["_3", "_3", "_missing", "_5", "_5", "_3"]
    assert len(set(folds(df, "joint", 2, "sold", x))) == 2
    assert len(set(folds(df, "adaptive-joint", None, "sold", ["shelf"]))) == 5


def test_positions_are_a_permutation_and_folds_balanced(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 3 == 0)
    placed = with_positions(df, "id", F.col("s").cast("string"))
    assert sorted(r[POS] for r in placed.collect()) == list(range(1000))
    two = placed.select(
        "s", round_robin(F.col(POS), 3).alias("a"), round_robin(F.col(POS), 3, 1).alias("b")
    )
    sizes = [r["count"] for r in two.groupBy("a", "b").count().collect()]
    assert len(sizes) == 9 and max(sizes) - min(sizes) <= 3
    for s in (True, False):
        per = [r["count"] for r in two.where(F.col("s") == s).groupBy("a").count().collect()]
        assert max(per) - min(per) <= 1


def test_a_hot_stratum_and_partitions_change_nothing(spark):
    df = spark.range(0, 5000).withColumn("s", F.when(F.col("id") % 10 < 8, "hot").otherwise("x"))
    one = with_folds(df.repartition(1), "id", "stratified", 4, "s")
    many = with_folds(df.repartition(64), "id", "stratified", 4, "s")
    assert one.exceptAll(many).count() == 0 and one.count() == 5000


def test_text_keys_and_shuffling(spark):
    df = spark.range(500).withColumn("key", F.concat(F.lit("k"), F.lpad("id", 5, "0")))
    a = [r["fold"] for r in with_folds(df, "key", "cv", 5).orderBy("id").collect()]
    assert a == [1 + i // 100 for i in range(500)]
    s1, s2 = (folds(df.select("id"), "cv", 5, seed=7) for _ in range(2))
    assert s1 == s2 and s1 != a and sorted(s1) == sorted(a)


def test_row_key_is_fixed_once(spark):
    df = with_row_key(spark.range(50).withColumn("x", F.rand()))
    assert df.orderBy("id").collect() == df.orderBy("id").collect()
    assert df.select("__row").distinct().count() == 50


@pytest.mark.parametrize("seed", [None, 1])
def test_keys_that_are_not_unique_are_refused(spark, seed):
    """Two equal keys among many, many equal ones, text keys, a null: all exactly found."""
    base = spark.range(3000)
    twice = base.union(spark.range(1))
    hot = base.withColumn("id", F.when(F.col("id") < 40, 7).otherwise(F.col("id")))
    text = twice.select(F.concat(F.lit("k"), F.col("id")).alias("id"))
    for df in (twice, hot, text):
        with pytest.raises(ValueError, match="not unique"):
            with_folds(df, "id", "cv", 5, seed=seed)
    for df in (base.withColumn("id", F.when(F.col("id") > 0, F.col("id"))),
               base.select(F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("id"))):
        with pytest.raises(ValueError, match="is null"):
            with_folds(df, "id", "cv", 5, seed=seed)
