import json

import pytest
import yaml
from pyspark.sql import types as T

from counterfold.plans.estimands import (
    AIE,
    ATE,
    CM,
    Configuration,
    EstimandError,
    Graph,
    Joint,
    Levels,
    Nuisance,
    cast_levels,
    estimand_table,
    factorial_ate,
    identify,
    identify_table,
    nuisance_counts,
    proofread,
    treatments_of,
)
from counterfold.plans.engine import NuisanceFits
from counterfold.sources.readers import read_configuration

B = {"case": True, "control": False}


def test_levels_take_the_type_of_their_column():
    schema = T.StructType(
        [T.StructField("T1", T.BooleanType()), T.StructField("T2", T.LongType()),
         T.StructField("Y", T.DoubleType())]
    )
    cm = cast_levels(CM("Y", {"T1": 1, "T2": False}), schema)
    assert cm.treatments == (("T1", Levels(True)), ("T2", Levels(0)))
    aie = cast_levels(AIE("Y", {"T1": {"case": 1, "control": 0.0},
                                "T2": {"case": True, "control": 0}}), schema)
    assert dict(aie.treatments) == {"T1": Levels(True, False), "T2": Levels(1, 0)}
    assert dict(aie.treatments)["T1"].case is True
    with pytest.raises(EstimandError, match="T3"):
        cast_levels(ATE("Y", {"T3": B}), schema)


def test_variables_and_treatments():
    e = ATE("Y", {"T1": B, "T2": B}, {"T1": ["W1", "W2"], "T2": ["W2", "W3"]}, ["C"])
    assert e.variables() == {"Y", "C", "T1", "T2", "W1", "W2", "W3"}
    j = Joint(CM("Y", {"T3": True}), AIE("Y", {"T1": B, "T4": B}))
    assert treatments_of([ATE("Y", {"T1": B}), ATE("Y", {"T2": B}), j]) == {"T1", "T2", "T3", "T4"}


def test_terms():
    assert ATE("Y", {"T": B}).terms() == [(1, (True,)), (-1, (False,))]
    got = dict((s, v) for v, s in AIE("Y", {"a": B, "b": B}).terms())
    assert got == {(True, True): 1, (False, False): 1, (True, False): -1, (False, True): -1}
    assert sum(v for v, _ in AIE("Y", {"a": B, "b": B, "c": B}).terms()) == 0


def test_factorial(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 2)], "C int, T int")
    with pytest.raises(EstimandError, match="'T'"):
        factorial_ate(df.drop("T"))
    with pytest.raises(EstimandError, match="'Y'"):
        factorial_ate(df)
    df = df.withColumnRenamed("C", "Y")
    with pytest.raises(EstimandError, match="'W'"):
        factorial_ate(df)
    df = df.selectExpr("*", "1 as W1", "1 as W_2")
    w = {"T": ("W1", "W_2")}
    assert factorial_ate(df).parts == (
        ATE("Y", {"T": Levels(1, 0)}, w), ATE("Y", {"T": Levels(2, 1)}, w))


def test_identification(spark):
    graph = Graph(("Y",), ("T1",), ("W1", "W2"))
    e = ATE("Y", {"T1": B})
    assert identify(e, graph).confounders == (("T1", ("W1", "W2")),)
    assert identify(Joint(e, e), graph).parts[1].confounders == (("T1", ("W1", "W2")),)
    with pytest.raises(EstimandError, match="graph"):
        identify(e, None)
    with pytest.raises(EstimandError, match="T9"):
        identify(ATE("Y", {"T9": B}), graph)
    done = ATE("Y", {"T1": B}, {"T1": ["X"]})
    assert identify(done, None) is done
    table = estimand_table(spark, [e, ATE("Y", {"T9": B})])
    scm = spark.createDataFrame([("T1", "W2"), ("T1", "W1")], "treatment string, confounder string")
    rows = {r["idx"]: r for r in identify_table(table, scm).collect()}
    assert rows[0]["all_confounders"] == ["W1", "W2"] and rows[0]["identified"]
    assert not rows[1]["identified"]


def test_errors_are_listed_together():
    schema = T.StructType([T.StructField("Y", T.DoubleType())])
    config = Configuration((ATE("Y", {"A": B}, {"A": []}), ATE("Y", {"B": B})))
    with pytest.raises(EstimandError, match="(?s)estimand 1"):
        proofread(config, schema)


@pytest.mark.parametrize("extension", ["json", "yaml"])
def test_configuration_files(spark, tmp_path, extension):
    dump = json.dumps if extension == "json" else yaml.safe_dump
    asked = [ATE("Y", {"T1": B}, {"T1": ["W"]}), Joint(CM("Y", {"T1": True}, {"T1": ["W"]}))]
    path = tmp_path / f"questions.{extension}"
    path.write_text(dump({"type": "Configuration", "estimands": [e.to_dict() for e in asked],
                          "scm": {"treatments": ["T1"], "confounders": ["W"]}}))
    config = read_configuration(spark, str(path))
    assert list(config.estimands) == asked and config.graph.parents_of("T1") == ("W",)
    with pytest.raises(ValueError, match="JSON"):
        read_configuration(spark, "questions.txt")


def shared_questions():
    w = {"T1": ["W"], "T2": ["W"]}
    return [
        ATE("Y", {"T1": Levels(1, 0), "T2": Levels(1, 0)}, w),
        ATE("Y", {"T1": Levels(1, 0), "T2": Levels(2, 0)}, w),
        ATE("Y", {"T1": Levels(1, 0)}, {"T1": ["W"]}),
        ATE("Ynew", {"T3": Levels(1, 0)}, {"T3": ["W"]}),
    ]


def test_use_counts(spark):
    got = {
        (r["target"], tuple(r["parents"])): r["uses"]
        for r in nuisance_counts(estimand_table(spark, shared_questions())).collect()
    }
    assert got == {
        ("Y", ("T1", "T2", "W")): 2, ("T1", ("W",)): 3, ("T2", ("W",)): 2,
        ("Y", ("T1", "W")): 1, ("Ynew", ("T3", "W")): 1, ("T3", ("W",)): 1,
    }


def test_fits_are_released_after_their_last_use():
    q = shared_questions()
    y, t1, t2 = Nuisance("Y", ("T1", "T2", "W")), Nuisance("T1", ("W",)), Nuisance("T2", ("W",))
    fits = NuisanceFits("release-unusable")
    made = []
    for n in (y, t1, t2, y):
        fits.get((n, "m", None), lambda n=n: made.append(n) or n)
    assert made == [y, t1, t2]
    fits.after(q[1:])
    assert {k[0] for k in fits.kept} == {y, t1, t2}
    fits.after(q[2:])
    assert {k[0] for k in fits.kept} == {t1}
    fits.after(q[3:])
    assert not fits.kept
    capped = NuisanceFits(2)
    for n in (y, t1, t2):
        capped.get((n, "m", None), lambda: 1)
    capped.after(q)
    assert len(capped.kept) == 2
    none = NuisanceFits("no-cache")
    none.get((y, "m", None), lambda: 1)
    none.after(q)
    assert not none.kept
    with pytest.raises(ValueError):
        NuisanceFits("max-size")


def test_more_levels_if_asked_for(spark):
    from counterfold import Engine
    from counterfold.jobs import parser

    df = spark.range(1200).selectExpr(
        "id AS SAMPLE_ID", "CAST(id % 120 AS INT) AS T", "concat('s', id % 130) AS W1", "id % 7 * 1.0 AS Y")
    with pytest.raises(EstimandError):
        Engine(df, "factorialATE", "ose--saturated", spark=spark)
    args = parser().parse_args(["estimate", "x", "--max-finite-levels", "150"])
    engine = Engine(df, "factorialATE", "ose--saturated", spark=spark,
                    max_finite_levels=args.max_finite_levels)
    assert len(engine.estimands[0].parts) == 119
    assert engine.kinds["W1"].finite and engine.kinds["T"].finite
