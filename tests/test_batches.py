"""Answers do not depend on which questions are answered together; Arrow files of any name."""

import pyarrow as pa
import pytest

from counterfold import ATE, Engine
from counterfold.plans import effects
from counterfold.sources.readers import read_arrow


def test_folds_do_not_depend_on_the_batch(people):
    levels = {"case": True, "control": False}
    questions = [ATE("pressure (mm/Hg), mean", {"drug": levels}, {"drug": ["age", "diet"]}),
                 ATE("pressure (mm/Hg), mean", {"diet": levels}, {"diet": ["age", "drug"]})]
    found = []
    for size in (1, 10):
        engine = Engine(people, questions, "cvose--glm", key="SAMPLE_ID", batch_size=size)
        found.append([r.estimate for r in engine().orderBy("idx").collect()])
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_unfinished_fluctuation_is_reported(people, monkeypatch):
    monkeypatch.setattr(effects, "FLUCTUATION_PASSES", 1)
    levels = {"case": True, "control": False}
    question = ATE("recovered?", {"drug": levels}, {"drug": ["age", "mass"]})
    row = Engine(people, [question], "tmle--glm", key="SAMPLE_ID")().first()
    assert "converge" in str(row)


def test_arrow_files_of_any_name(spark, tmp_path):
    for name in ("x.arrow", "y.feather", "z"):
        table = pa.table({"a": [1, 2, 3]})
        with pa.OSFile(str(tmp_path / name), "wb") as sink, pa.ipc.new_file(sink, table.schema) as w:
            w.write_table(table)
    (tmp_path / "not.csv").write_text("a\n1\n")
    assert read_arrow(spark, str(tmp_path)).count() == 9
    assert read_arrow(spark, str(tmp_path / "y.feather")).count() == 3
