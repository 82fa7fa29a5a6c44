import pytest

from counterfold.models import ElasticNet, Linear, Logistic, Saturated, Stack, Trees, Tuned
from counterfold.plans.registry import (
    PRESETS,
    estimators_from_dict,
    estimators_from_string,
    preset,
    resolve_estimators,
)


def test_defaults_are_elastic_nets():
    got = estimators_from_string("wtmle-ose", ["T1", "T2"])
    assert list(got) == ["WTMLE_GLMNET_GLMNET", "OSE_GLMNET_GLMNET"]
    first = got["WTMLE_GLMNET_GLMNET"]
    assert first.weighted and not first.cross_fitted and first.kind == "tmle"
    for e in got.values():
        assert isinstance(e.models.q_binary, ElasticNet) and isinstance(e.models.g, ElasticNet)
        assert e.models.q_continuous.interactions.primary == ("T1", "T2")
        assert not e.models.g.interactions


def test_one_model_serves_all():
    got = estimators_from_string("cvtmle-cvose--tunedxgboost")
    assert list(got) == ["CVTMLE_TUNEDXGBOOST_TUNEDXGBOOST", "CVOSE_TUNEDXGBOOST_TUNEDXGBOOST"]
    for e in got.values():
        assert e.cross_fitted and not e.weighted
        assert all(isinstance(m, Tuned) for m in e.models.all())


def test_two_models():
    e = estimators_from_string("tmle--sl--glm", ["Coco"])["TMLE_SL_GLM"]
    for q, glm in ((e.models.q_continuous, Linear), (e.models.q_binary, Logistic)):
        assert isinstance(q, Stack)
        members = dict(q.members)
        assert isinstance(members["glmnet"], ElasticNet) and isinstance(members["lr"], glm)
        assert members["lr"].interactions.primary == ("Coco",)
        trees = [m for m in members.values() if isinstance(m, Trees)]
        assert len({(t.max_depth, t.eta) for t in trees}) == 12
        assert all(t.rounds == 100 for t in trees)
    assert e.models.g == Logistic()


@pytest.mark.parametrize("text", ["glmnet", "xtmle--glm", "tmle--nope", "tmle--glm--glm--glm"])
def test_bad_strings(text):
    with pytest.raises(ValueError):
        estimators_from_string(text)


def test_presets_and_files(spark, tmp_path):
    assert len(PRESETS) == 9
    for name in PRESETS:
        e = preset(name)["TMLE"]
        assert e.weighted and e.lower == 1e-8
    assert resolve_estimators(spark, "glm", []) == preset("glm")
    spec = {
        "TMLE": {"type": "tmle", "weighted": True, "lower": 0.001, "models": {
            "Q_continuous": {"model": "stack", "members": {
                "a": {"model": "elastic_net", "interactions": {"order": 3, "patterns": ["^rs"]}},
                "b": {"model": "trees", "rounds": 10}, "c": "constant"}},
            "Q_binary": {"model": "logistic", "interactions": "all"}, "G": "logistic",
            "T2": {"model": "linear"}}},
        "OSE": {"type": "ose", "preset": "glmnet"},
    }
    got = estimators_from_dict(spec)
    assert got["TMLE"].lower == 0.001 and got["TMLE"].models.treatment("T2") == Linear()
    assert got["TMLE"].models.q_continuous.members[0][1].interactions.order == 3
    assert got["OSE"].models == PRESETS["glmnet"]
    assert estimators_from_dict({"A": {"models": {
        "Q_continuous": {"model": "saturated", "on": ["w"]}, "Q_binary": "constant",
        "G": {"model": "tuned", "eta": [0.1]}}}})["A"].models.q_continuous == Saturated(("w",))
    path = tmp_path / "e.yaml"
    path.write_text("OSE: {type: ose, models: {Q_continuous: linear, Q_binary: logistic, G: logistic}}")
    assert resolve_estimators(spark, str(path), [])["OSE"].kind == "ose"
