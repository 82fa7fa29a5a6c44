"""Queries on effects: questions, estimators, inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from counterfold.catalog.sqlgen import LineStudy, Study, aie, ate, cm, union
from counterfold.catalog.tables import (
    DOCUMENTS_SQL,
    LINEITEM_SQL,
    ORDERS_SQL,
    documents_cohort,
    lineitem_cohort,
    orders_cohort,
)
from counterfold.models import Saturated
from counterfold.plans import estimands as E
from counterfold.plans.engine import Engine
from counterfold.plans.registry import (
    OSE,
    TMLE,
    Models,
    estimators_from_string,
    preset,
    same_model,
)

QUERIES, ORACLE = {}, {}
SATURATED = same_model(Saturated())


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def summary(results, label=None, a: int = 3, b: int = 3):
    """One row per result; ``label`` maps (idx, estimator) to the name shown."""
    name = F.col("estimator") if label is None else label
    return results.select(
        name.alias("estimator"), (F.round("estimate", a) + 0.0).alias("estimate"),
        F.round("std", b).alias("std"), F.round("se", b).alias("se"), "n", "clipped",
    )


def parts(results, b: int = 3):
    """One row per part of joint results."""
    return results.select("idx", "estimator", F.posexplode("parts").alias("part", "p")).select(
        "idx", "estimator", F.col("part").cast("bigint").alias("part"),
        (F.round("p.estimate", 3) + 0.0).alias("estimate"),
        F.round("p.std", b).alias("std"), F.round("p.se", b).alias("se"),
    )


def by_idx(*names: str):
    out = F.lit(None).cast("string")
    for i, n in enumerate(names):
        out = F.when(F.col("idx") == i, n).otherwise(out)
    return out


TRUE_FALSE = {"case": True, "control": False}
D = (3, 3)
SEG, STATUS = "c_mktsegment", "o_orderstatus"

# --- questions -------------------------------------------------------------------------

FLAGSHIP = Study(
    LINEITEM_SQL, "l_extendedprice", ("hi",), ("l_returnflag", "l_linestatus"),
    (("l_returnflag", "l_linestatus"),), ate(["true"], ["false"]),
)


@query("ate_saturated", union([FLAGSHIP.select("ose", "OSE", digits=D)]))
def ate_saturated(spark, sf):
    question = E.ATE("l_extendedprice", {"hi": TRUE_FALSE}, {"hi": ["l_returnflag", "l_linestatus"]})
    return summary(Engine(lineitem_cohort(spark, sf), [question], {"OSE": OSE(SATURATED)})())


def urgent_study(ask, **kw):
    given = {"q_on": (SEG,), "g_on": ((SEG,),)} | kw
    return Study(ORDERS_SQL, "o_totalprice", ("urgent",), ask=ask, **given)


@query(
    "cm_saturated",
    union([
        urgent_study(cm("true")).select("ose", "urgent", digits=D),
        urgent_study(cm("false")).select("ose", "not urgent", digits=D),
    ]),
)
def cm_saturated(spark, sf):
    asked = [E.CM("o_totalprice", {"urgent": v}, {"urgent": [SEG]}) for v in (True, False)]
    got = Engine(orders_cohort(spark, sf), asked, {"OSE": OSE(SATURATED)})()
    return summary(got, by_idx("urgent", "not urgent"))


TWO = Study(
    ORDERS_SQL, "o_totalprice", ("urgent", "late"), (SEG, STATUS), ((SEG,), (SEG, STATUS)),
    ate(["true", "true"], ["false", "false"]),
)


@query("ate_multi", union([TWO.select("ose", "OSE", digits=D), TWO.select("wtmle", "WTMLE", digits=D)]))
def ate_multi(spark, sf):
    """Two treatments set together, each with confounders of its own."""
    question = E.ATE(
        "o_totalprice", {"urgent": TRUE_FALSE, "late": TRUE_FALSE},
        {"urgent": [SEG], "late": [SEG, STATUS]},
    )
    ests = {"OSE": OSE(SATURATED), "WTMLE": TMLE(SATURATED, weighted=True)}
    return summary(Engine(orders_cohort(spark, sf), [question], ests)())


AIE2 = Study(
    ORDERS_SQL, "o_totalprice", ("urgent", "late"), (SEG,), ((SEG,), (SEG,)),
    aie(["true", "true"], ["false", "false"]),
)


@query("aie_order2", union([AIE2.select("ose", "OSE", digits=D), AIE2.select("tmle", "TMLE", digits=D)]))
def aie_order2(spark, sf):
    question = E.AIE(
        "o_totalprice", {"urgent": TRUE_FALSE, "late": TRUE_FALSE}, {"urgent": [SEG], "late": [SEG]}
    )
    ests = {"OSE": OSE(SATURATED), "TMLE": TMLE(SATURATED)}
    return summary(Engine(orders_cohort(spark, sf), [question], ests)())


AIE3 = Study(
    ORDERS_SQL, "o_totalprice", ("urgent", "late", "rich"), (STATUS,),
    ((STATUS,), (STATUS,), (STATUS,)), aie(["true"] * 3, ["false"] * 3),
)


@query("aie_order3", union([AIE3.select("ose", "OSE", digits=D)]))
def aie_order3(spark, sf):
    names = ("urgent", "late", "rich")
    question = E.AIE(
        "o_totalprice", {n: TRUE_FALSE for n in names}, {n: [STATUS] for n in names}
    )
    return summary(Engine(orders_cohort(spark, sf), [question], {"OSE": OSE(SATURATED)})())


@query(
    "ate_reversed",
    union([
        urgent_study(ate(["true"], ["false"])).select("tmle", "forward", digits=D),
        urgent_study(ate(["false"], ["true"])).select("tmle", "backward", digits=D),
    ]),
)
def ate_reversed(spark, sf):
    back = {"case": False, "control": True}
    asked = [E.ATE("o_totalprice", {"urgent": v}, {"urgent": [SEG]}) for v in (TRUE_FALSE, back)]
    got = Engine(orders_cohort(spark, sf), asked, {"TMLE": TMLE(SATURATED)})()
    return summary(got, by_idx("forward", "backward"))


@query(
    "extra_covariates",
    union([
        urgent_study(ate(["true"], ["false"]), q_on=(SEG, STATUS)).select(k, k.upper(), digits=D)
        for k in ("ose", "wtmle")
    ]),
)
def extra_covariates(spark, sf):
    question = E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": [SEG]}, [STATUS])
    ests = {"OSE": OSE(SATURATED), "WTMLE": TMLE(SATURATED, weighted=True)}
    return summary(Engine(orders_cohort(spark, sf), [question], ests)())


# --- estimators --------------------------------------------------------------------------

COARSE_Q = Models(Saturated((SEG,)), Saturated((SEG,)), Saturated())
URGENT_QUESTION = E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": [SEG, STATUS]})
DEAR_QUESTION = E.ATE("dear", {"urgent": TRUE_FALSE}, {"urgent": [SEG, STATUS]})


def coarse(y="o_totalprice", lower=1e-8, **kw):
    return Study(
        ORDERS_SQL, y, ("urgent",), (SEG,), ((SEG, STATUS),), ate(["true"], ["false"]),
        lower=lower, **kw,
    )


def _one(name, kind, make, y="o_totalprice", lower=1e-8, question=URGENT_QUESTION, digits=D):
    binary = y == "dear"
    sql = union([coarse(y, lower).select(kind, kind.upper(), binary, digits)])

    @query(name, sql)
    def run(spark, sf):
        got = Engine(orders_cohort(spark, sf), [question], {kind.upper(): make(lower)})()
        return summary(got, None, *digits)

    return run


_one("ose_saturated", "ose", lambda b: OSE(COARSE_Q, lower=b))
_one("tmle_saturated", "tmle", lambda b: TMLE(COARSE_Q, lower=b))
_one("wtmle_saturated", "wtmle", lambda b: TMLE(COARSE_Q, weighted=True, lower=b))
_one("tmle_binary", "tmle", lambda b: TMLE(COARSE_Q, lower=b), "dear", 0.41, DEAR_QUESTION, (7, 7))
_one("wtmle_binary", "wtmle", lambda b: TMLE(COARSE_Q, weighted=True, lower=b), "dear", 0.41,
     DEAR_QUESTION, (7, 7))
_one("ose_binary", "ose", lambda b: OSE(COARSE_Q, lower=b), "dear", 1e-8, DEAR_QUESTION, (7, 7))


@query(
    "ps_bounded",
    union([coarse(lower=0.41).select(k, k.upper(), digits=D) for k in ("ose", "tmle", "wtmle")]),
)
def ps_bounded(spark, sf):
    ests = {
        "OSE": OSE(COARSE_Q, lower=0.41),
        "TMLE": TMLE(COARSE_Q, lower=0.41),
        "WTMLE": TMLE(COARSE_Q, weighted=True, lower=0.41),
    }
    return summary(Engine(orders_cohort(spark, sf), [URGENT_QUESTION], ests)())


# Stratified folds over the treatment, in order of the key.
FOLDED_SQL = f"""
  SELECT o.*, (start + row_number() OVER (PARTITION BY o.urgent ORDER BY o_orderkey) - 1) % 3 + 1
           AS fold_
  FROM ({ORDERS_SQL}) o JOIN (
    SELECT urgent AS u, coalesce(sum(c) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0) AS start
    FROM (SELECT urgent, count(*) AS c, min(o_orderkey) AS k FROM ({ORDERS_SQL}) GROUP BY urgent)
  ) s ON o.urgent = s.u"""
CROSSED = Study(
    FOLDED_SQL, "o_totalprice", ("urgent",), (SEG,), ((SEG, STATUS),), ate(["true"], ["false"]),
    fold="fold_",
)


def _crossed(name, kind, est):
    @query(name, union([CROSSED.select(kind, f"CV{kind.upper()}", digits=D)]))
    def run(spark, sf):
        rows = orders_cohort(spark, sf)
        return summary(
            Engine(rows, [URGENT_QUESTION], {f"CV{kind.upper()}": est}, key="o_orderkey")()
        )


_crossed("cvose_saturated", "ose", OSE(COARSE_Q, cross_fitted=True))
_crossed("cvtmle_saturated", "tmle", TMLE(COARSE_Q, cross_fitted=True))
_crossed("cvwtmle_saturated", "wtmle", TMLE(COARSE_Q, weighted=True, cross_fitted=True))



def _folds_for_sql(size: str) -> str:
    """The number of folds of an effective size, as the adaptive strategy takes it."""
    return (f"CASE WHEN {size} < 30 THEN {size} WHEN {size} < 500 THEN 20 WHEN {size} < 5000 "
            f"THEN 10 WHEN {size} < 10000 THEN 5 ELSE 3 END")


_RARE = f"""(SELECT least(sum(c), 5 * min(c)) AS e FROM (
    SELECT urgent, count(*) AS c FROM ({ORDERS_SQL}) GROUP BY urgent))"""
# Blocks along the key: the first ``n mod k`` are one longer.
_BLOCKS = f"""
  SELECT o.*, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1)
              ELSE (pos - (n % 5) * (n // 5 + 1)) // (n // 5) + n % 5 END + 1 AS fold_
  FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n
        FROM ({ORDERS_SQL})) o"""


def _resampled(name: str, base: str, strategy) -> None:
    study = Study(base, "o_totalprice", ("urgent",), (SEG,), ((SEG, STATUS),),
                  ate(["true"], ["false"]), fold="fold_")

    @query(name, union([study.select("ose", "OSE", digits=D)]))
    def run(spark, sf):
        est = {"OSE": OSE(COARSE_Q, cross_fitted=True)}
        got = Engine(orders_cohort(spark, sf), [URGENT_QUESTION], est, key="o_orderkey",
                     resampling=strategy)()
        return summary(got)


_resampled("cvose_adaptive", FOLDED_SQL.replace(
    "% 3 + 1", f"% (SELECT {_folds_for_sql('e')} FROM {_RARE}) + 1"), "adaptive")
_resampled("cvose_blocks", _BLOCKS, "5-key")

# A binary outcome also stratifies the folds.
FOLDED_DEAR = f"""
  SELECT o.*, (start + row_number() OVER (PARTITION BY o.urgent, o.dear ORDER BY o_orderkey) - 1)
           % 3 + 1 AS fold_
  FROM ({ORDERS_SQL}) o JOIN (
    SELECT urgent AS u, dear AS v, coalesce(sum(c) OVER (ORDER BY k ROWS BETWEEN
             UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (SELECT urgent, dear, count(*) AS c, min(o_orderkey) AS k FROM ({ORDERS_SQL})
          GROUP BY urgent, dear)
  ) s ON o.urgent = s.u AND o.dear = s.v"""


@query(
    "cvtmle_binary",
    union([
        Study(FOLDED_DEAR, "dear", ("urgent",), (SEG,), ((SEG, STATUS),), ate(["true"], ["false"]),
              fold="fold_").select("tmle", "CVTMLE", True, (7, 7))
    ]),
)
def cvtmle_binary(spark, sf):
    est = {"CVTMLE": TMLE(COARSE_Q, cross_fitted=True)}
    got = Engine(orders_cohort(spark, sf), [DEAR_QUESTION], est, key="o_orderkey")()
    return summary(got, None, 7, 7)


# --- joint questions ------------------------------------------------------------------------


def status_study(case, control, kind="ose"):
    return Study(
        ORDERS_SQL, "o_totalprice", (STATUS,), (SEG,), ((SEG,),), ate([case], [control]),
        keep=("o_orderkey",),
    )


A, B = status_study("'O'", "'F'"), status_study("'P'", "'O'")


def _pairs(kind):
    def ic(study):
        return f"(WITH {study.influence(kind)} SELECT o_orderkey, u, t FROM ic)"

    return f"(SELECT a.u AS ua, b.u AS ub, a.t AS ta, b.t AS tb FROM {ic(A)} a JOIN {ic(B)} b USING (o_orderkey))"


@query(
    "joint_ate_cov",
    f"""
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(v / 1e6, 3) AS cov, n FROM (
  SELECT 0 AS i, 0 AS j, covar_samp(ua, ua) AS v, count(*) AS n FROM {_pairs('ose')}
  UNION ALL SELECT 0, 1, covar_samp(ua, ub), count(*) FROM {_pairs('ose')}
  UNION ALL SELECT 1, 0, covar_samp(ua, ub), count(*) FROM {_pairs('ose')}
  UNION ALL SELECT 1, 1, covar_samp(ub, ub), count(*) FROM {_pairs('ose')})""",
)
def joint_ate_cov(spark, sf):
    joint = E.Joint(
        E.ATE("o_totalprice", {STATUS: {"case": "O", "control": "F"}}, {STATUS: [SEG]}),
        E.ATE("o_totalprice", {STATUS: {"case": "P", "control": "O"}}, {STATUS: [SEG]}),
    )
    got = Engine(orders_cohort(spark, sf), [joint], {"OSE": OSE(SATURATED)})()
    return (
        got.select("n", F.posexplode("cov").alias("i", "row"))
        .select("n", "i", F.posexplode("row").alias("j", "v"))
        .select(
            F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"),
            F.round(F.col("v") / 1e6, 3).alias("cov"), "n",
        )
    )


def _parts_sql(study, part, name, kind="ose"):
    value = "avg(u)" if kind == "ose" else "avg(t)"
    return f"""(WITH {study.influence(kind)}
SELECT 0 AS idx, '{name}' AS estimator, CAST({part} AS BIGINT) AS part, round({value}, 3) + 0.0 AS estimate,
       round(stddev_samp(u), 3) AS std, round(stddev_samp(u) / sqrt(count(*)), 3) AS se FROM ic)"""


@query("factorial_ate", union([_parts_sql(A, 0, "OSE"), _parts_sql(B, 1, "OSE")]))
def factorial_ate(spark, sf):
    rows = orders_cohort(spark, sf).select(
        F.col(STATUS).alias("T"), F.col("o_totalprice").alias("Y"), F.col(SEG).alias("W_segment")
    )
    return parts(Engine(rows, "factorialATE", {"OSE": OSE(SATURATED)})())


# --- parametric models -----------------------------------------------------------------------

FLAG_STUDY = Study(
    ORDERS_SQL, "o_totalprice", ("urgent",), ("rich",), (("rich",),), ate(["true"], ["false"])
)
FLAG_QUESTION = E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": ["rich"]})


@query(
    "ate_glm",
    union([
        FLAG_STUDY.select("wtmle", "WTMLE_GLM_GLM", digits=D),
        FLAG_STUDY.select("ose", "OSE_GLM_GLM", digits=D),
    ]),
)
def ate_glm(spark, sf):
    """With one two-level confounder the models with interactions are saturated."""
    return summary(Engine(orders_cohort(spark, sf), [FLAG_QUESTION], "wtmle-ose--glm")())


@query(
    "multi_estimator",
    union([
        Study(FOLDED_SQL, "o_totalprice", ("urgent",), ("rich",), (("rich",),),
              ate(["true"], ["false"]), fold="fold_").select(k, f"CV{k.upper()}_GLM_GLM", digits=D)
        for k in ("tmle", "wtmle", "ose")
    ] + [FLAG_STUDY.select("tmle", "TMLE_GLM_GLM", digits=D)]),
)
def multi_estimator(spark, sf):
    rows = orders_cohort(spark, sf)
    text = "cvtmle-cvwtmle-cvose-tmle--glm"
    return summary(Engine(rows, [FLAG_QUESTION], text, key="o_orderkey")())


@query(
    "ate_glm_binary",
    union([
        Study(ORDERS_SQL, "dear", ("urgent",), ("rich",), (("rich",),), ate(["true"], ["false"]),
              lower=0.41).select("tmle", "TMLE", True, (6, 6))
    ]),
)
def ate_glm_binary(spark, sf):
    question = E.ATE("dear", {"urgent": TRUE_FALSE}, {"urgent": ["rich"]})
    models = estimators_from_string("tmle--glm", ["urgent"])["TMLE_GLM_GLM"].models
    got = Engine(orders_cohort(spark, sf), [question], {"TMLE": TMLE(models, lower=0.41)})()
    return summary(got, None, 6, 6)


@query("ate_glmnet")
def ate_glmnet(spark, sf):
    """The default estimators: weighted targeted and one-step, elastic net throughout."""
    rows = orders_cohort(spark, sf)
    return summary(Engine(rows, [URGENT_QUESTION], "wtmle-ose", key="o_orderkey")(), None, 1, 1)


LINE = LineStudy(
    ORDERS_SQL, "o_totalprice", ("urgent",), (), ((),), ate(["true"], ["false"]), lower=0.4,
    x="(c_acctbal - 4000) / 3000",
)


@query(
    "ate_glm_continuous",
    union([LINE.select(k, k.upper(), digits=(2, 2)) for k in ("ose", "tmle", "wtmle")]),
)
def ate_glm_continuous(spark, sf):
    """A numeric confounder; the bound clips, so the three estimators differ."""
    question = E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": ["c_acctbal"]})
    models = estimators_from_string("tmle--glm", ["urgent"])["TMLE_GLM_GLM"].models
    ests = {
        "OSE": OSE(models, lower=0.4),
        "TMLE": TMLE(models, lower=0.4),
        "WTMLE": TMLE(models, weighted=True, lower=0.4),
    }
    return summary(Engine(orders_cohort(spark, sf), [question], ests)(), None, 2, 2)


@query("ate_continuous_covariates")
def ate_continuous_covariates(spark, sf):
    question = E.ATE("o_totalprice", {"urgent": TRUE_FALSE}, {"urgent": ["c_acctbal", "n_regionkey"]})
    return summary(Engine(orders_cohort(spark, sf), [question], "tmle-ose--glm")(), None, 1, 1)


@query(
    "preset_models",
    union([
        Study(f"SELECT *, urgent AS rs1 FROM ({ORDERS_SQL})", "o_totalprice", ("rs1",), ("rich",),
              (("rich",),), ate(["true"], ["false"])).select("wtmle", "TMLE", digits=D)
    ]),
)
def preset_models(spark, sf):
    rows = orders_cohort(spark, sf).withColumn("rs1", F.col("urgent"))
    question = E.ATE("o_totalprice", {"rs1": TRUE_FALSE}, {"rs1": ["rich"]})
    return summary(Engine(rows, [question], preset("glm-with-interactions-for-Q"))())


# --- missing values ----------------------------------------------------------------------------

DOCS = Study(
    f"SELECT * FROM ({DOCUMENTS_SQL}) WHERE quality IS NOT NULL", "quality", ("english",),
    ("long",), (("long",),), ate(["true"], ["false"]), g_base=DOCUMENTS_SQL,
)


@query("ate_missing_outcome", union([
    DOCS.select("tmle", "TMLE", True, (6, 6)), DOCS.select("ose", "OSE", True, (6, 6)),
]))
def ate_missing_outcome(spark, sf):
    """Outcome models learn from labelled rows, propensities from all of them."""
    question = E.ATE("quality", {"english": TRUE_FALSE}, {"english": ["long"]})
    ests = {"TMLE": TMLE(SATURATED), "OSE": OSE(SATURATED)}
    return summary(Engine(documents_cohort(spark, sf), [question], ests)(), None, 6, 6)


# --- many questions ------------------------------------------------------------------------------


def _many_sql() -> str:
    """Every nation's mean, and its effect against the first and the previous nation,
    both ways; influence values row by row."""
    return f"""
WITH b AS ({ORDERS_SQL}),
names AS (SELECT n_name AS name, row_number() OVER (ORDER BY n_name) - 1 AS k,
                 count(*) OVER () AS total FROM (SELECT DISTINCT n_name FROM b)),
q AS (SELECT o_orderstatus, n_name AS name, avg(o_totalprice) AS q, count(*) AS c FROM b
      GROUP BY o_orderstatus, n_name),
g AS (SELECT q.*, c / sum(c) OVER (PARTITION BY o_orderstatus) AS g FROM q),
u AS (SELECT b.o_orderkey, g.name, g.q + CASE WHEN b.n_name = g.name
             THEN (b.o_totalprice - g.q) / g.g ELSE 0 END AS u
      FROM b JOIN g ON b.o_orderstatus = g.o_orderstatus),
asked AS (
  SELECT k AS idx, name AS a, NULL AS c FROM names
  UNION ALL SELECT x.total + x.k - 1, x.name, y.name FROM names x JOIN names y ON y.k = 0 WHERE x.k > 0
  UNION ALL SELECT 2 * x.total + x.k - 2, x.name, y.name FROM names x JOIN names y ON y.k = x.k - 1
  UNION ALL SELECT 3 * x.total + x.k - 3, y.name, x.name FROM names x JOIN names y ON y.k = 0 WHERE x.k > 0),
v AS (SELECT idx, ua.o_orderkey, ua.u - coalesce(uc.u, 0) AS u
      FROM asked JOIN u ua ON asked.a = ua.name
      LEFT JOIN u uc ON asked.c = uc.name AND uc.o_orderkey = ua.o_orderkey)
SELECT CAST(idx AS INTEGER) AS idx, round(avg(u), 3) + 0.0 AS estimate,
       round(stddev_samp(u), 2) AS std, count(*) AS n
FROM v GROUP BY idx"""


@query("many_estimands", _many_sql())
def many_estimands(spark, sf):
    """About a hundred questions on the same rows, answered in shared passes."""
    rows = orders_cohort(spark, sf)
    names = sorted(r[0] for r in rows.select("n_name").distinct().collect())
    w = {"n_name": [STATUS]}
    pairs = [(n, names[0]) for n in names[1:]] + list(zip(names[1:], names))
    pairs += [(names[0], n) for n in names[1:]]
    asked = [E.CM("o_totalprice", {"n_name": n}, w) for n in names]
    asked += [
        E.ATE("o_totalprice", {"n_name": {"case": a, "control": c}}, w) for a, c in pairs
    ]
    got = Engine(rows, asked, {"OSE": OSE(SATURATED)})()
    return got.select(
        "idx", (F.round("estimate", 3) + 0.0).alias("estimate"),
        F.round("std", 2).alias("std"), "n",
    )
