"""Catalog queries against their SQL.  A part by default; COUNTERFOLD_ALL=1 for all."""

import math
import os

import duckdb
import pytest

from counterfold.catalog import ORACLE, QUERIES

SF = os.environ.get("COUNTERFOLD_SF", "/root/testdata/sf0.001")
TABLES = "nation customer supplier part orders lineitem events documents labels".split()
SOME = [
    "ate_saturated", "aie_order2", "ps_bounded", "tmle_binary", "cvwtmle_saturated",
    "joint_ate_cov", "ate_missing_outcome", "failed_and_skipped", "influence_kept",
    "merge_results", "glm_logistic_fit", "enet_cv_path", "stack_glm_constant", "gbt_fit", "gbt_rounds",
    "gbt_logistic_rounds",
    "resume_twice", "json_influence", "merge_influence", "arrow_splits", "cvose_adaptive",
    "foreign_linear", "folds_joint", "folds_adaptive_strat", "column_kinds", "identify_backdoor", "snp_dosage",
]
NAMES = sorted(ORACLE) if os.environ.get("COUNTERFOLD_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def key(row):
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (name, a, b)
            else:
                assert x == y, (name, a, b)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) >= 80
