"""Queries on nuisance models: fits against closed forms and Newton steps in SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from counterfold.catalog.tables import lineitem_cohort, orders_cohort, table
from counterfold.models import (
    Constant,
    ElasticNet,
    Foreign,
    Frame,
    Linear,
    Logistic,
    Request,
    Stack,
    Trees,
    Tuned,
)
from counterfold.models.base import WEIGHT
from counterfold.models.linear import EnetPath, _fold_gram
from counterfold.models.trees import fit_trees
from counterfold.operators.schema import profile
from counterfold.plans.registry import model_named

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def frame(df, target, parents, task, fold=None, treatments=(), levels=None, y=None, n_folds=3):
    """Rows with weight 1 as a training frame; ``fold`` is a column expression."""
    names = [target, *parents]
    kinds = profile(df, names)
    rows = df.withColumn(WEIGHT, F.lit(1.0))
    if fold is not None:
        rows = rows.withColumns({"__f0": fold, "__f1": fold})
    return Frame(
        rows, target, F.col(target).cast("double") if y is None else y, task, tuple(parents),
        kinds, tuple(treatments), levels or (kinds[target].levels if task != "regression" else None),
        ("__f0", "__f1") if fold is not None else (), n_folds,
    )


def terms(spark, fit, digits=6):
    return fit.table(spark).select("term", F.round("coefficient", digits).alias("coefficient"))


# --- means -----------------------------------------------------------------------------


@query(
    "constant_models",
    """
SELECT 'o_totalprice' AS target, 'mean' AS level, round(avg(o_totalprice), 4) AS value FROM orders
UNION ALL
SELECT 'o_orderstatus', o_orderstatus, round(count(*) / sum(count(*)) OVER (), 9)
FROM orders GROUP BY o_orderstatus""",
)
def constant_models(spark, sf):
    orders = table(spark, sf, "orders").select("o_totalprice", "o_orderstatus")
    mean = Constant().fit(frame(orders, "o_totalprice", [], "regression"))
    shares = Constant().fit(frame(orders, "o_orderstatus", [], "multi", y=F.lit(0.0)))
    rows = [("o_totalprice", "mean", round(mean.mean, 4))]
    rows += [("o_orderstatus", k, round(v, 9)) for k, v in shares.shares.items()]
    return spark.createDataFrame(rows, "target string, level string, value double")


# --- linear ------------------------------------------------------------------------------


@query(
    "glm_linear_fit",
    """
WITH m AS (SELECT avg(l_quantity) AS a, avg(l_discount) AS b, avg(l_extendedprice) AS y FROM lineitem),
s AS (SELECT sum((l_quantity - a) * (l_quantity - a)) AS aa, sum((l_discount - b) * (l_discount - b)) AS bb,
             sum((l_quantity - a) * (l_discount - b)) AS ab,
             sum((l_quantity - a) * (l_extendedprice - y)) AS ay,
             sum((l_discount - b) * (l_extendedprice - y)) AS yb,
             any_value(a) AS ma, any_value(b) AS mb, any_value(y) AS my
      FROM lineitem, m),
c AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS ca,
             (yb * aa - ay * ab) / (aa * bb - ab * ab) AS cb, ma, mb, my FROM s)
SELECT '(intercept)' AS term, round(my - ca * ma - cb * mb, 5) AS coefficient FROM c
UNION ALL SELECT 'l_quantity', round(ca, 5) FROM c
UNION ALL SELECT 'l_discount', round(cb, 5) FROM c""",
)
def glm_linear_fit(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    # Numbers as they are, not as indices of levels.
    f = numeric(frame(rows, "l_extendedprice", ["l_quantity", "l_discount"], "regression"))
    return terms(spark, Linear().fit(f), 5)


def numeric(f: Frame) -> Frame:
    """The same frame with its parents read as plain numbers."""
    kinds = {
        c: replace(k, levels=None) if c in f.parents else k for c, k in f.kinds.items()
    }
    return replace(f, kinds=kinds)


@query(
    "glm_linear_noint",
    """
WITH s AS (SELECT sum(l_quantity * l_quantity) AS aa, sum(l_discount * l_discount) AS bb,
             sum(l_quantity * l_discount) AS ab, sum(l_quantity * l_extendedprice) AS ay,
             sum(l_discount * l_extendedprice) AS yb FROM lineitem)
SELECT '(intercept)' AS term, 0.0::DOUBLE AS coefficient
UNION ALL SELECT 'l_quantity', round((ay * bb - yb * ab) / (aa * bb - ab * ab), 5) FROM s
UNION ALL SELECT 'l_discount', round((yb * aa - ay * ab) / (aa * bb - ab * ab), 5) FROM s""",
)
def glm_linear_noint(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    f = numeric(frame(rows, "l_extendedprice", ["l_quantity", "l_discount"], "regression"))
    return terms(spark, Linear(intercept=False).fit(f), 5)


def _newton_sql(ridge: float, intercept: bool = True) -> str:
    """Logistic regression of ``dear`` on quantity and discount by Newton steps."""
    one = "1.0" if intercept else "0.0"
    fix = "0.0" if intercept else "1.0"
    return f"""
WITH RECURSIVE cells AS (
  SELECT {one} AS x0, l_quantity AS x1, l_discount AS x2, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END) AS DOUBLE) AS s
  FROM lineitem GROUP BY l_quantity, l_discount),
total AS (SELECT sum(n) AS t FROM cells),
steps(i, b0, b1, b2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1,
    b0 + (g0 * (h11 * h22 - h12 * h12) - g1 * (h01 * h22 - h12 * h02) + g2 * (h01 * h12 - h11 * h02)) / det,
    b1 + (-g0 * (h01 * h22 - h02 * h12) + g1 * (h00 * h22 - h02 * h02) - g2 * (h00 * h12 - h01 * h02)) / det,
    b2 + (g0 * (h01 * h12 - h02 * h11) - g1 * (h00 * h12 - h02 * h01) + g2 * (h00 * h11 - h01 * h01)) / det
  FROM (
    SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02)
              + h02 * (h01 * h12 - h11 * h02) AS det
    FROM (
      SELECT i, b0, b1, b2, sum(x0 * r) / t AS g0, sum(x1 * r) / t - {ridge} * b1 AS g1,
             sum(x2 * r) / t - {ridge} * b2 AS g2,
             sum(x0 * x0 * w) / t + {fix} AS h00, sum(x0 * x1 * w) / t AS h01,
             sum(x0 * x2 * w) / t AS h02, sum(x1 * x1 * w) / t + {ridge} AS h11,
             sum(x1 * x2 * w) / t AS h12, sum(x2 * x2 * w) / t + {ridge} AS h22
      FROM (
        SELECT i, b0, b1, b2, x0, x1, x2, s - n * p AS r, n * p * (1 - p) AS w, t
        FROM (SELECT i, b0, b1, b2, x0, x1, x2, n, s, t,
                     1 / (1 + exp(-(b0 * x0 + b1 * x1 + b2 * x2))) AS p
              FROM steps, cells, total WHERE i < 12))
      GROUP BY i, b0, b1, b2, t)))
SELECT '(intercept)' AS term, round(b0, 6) + 0.0 AS coefficient FROM steps WHERE i = 12
UNION ALL SELECT 'l_quantity', round(b1, 6) FROM steps WHERE i = 12
UNION ALL SELECT 'l_discount', round(b2, 6) FROM steps WHERE i = 12"""


def _logistic(spark, sf, model):
    rows = lineitem_cohort(spark, sf).select("l_quantity", "l_discount", "dear")
    f = numeric(frame(rows, "dear", ["l_quantity", "l_discount"], "binary"))
    return terms(spark, model.fit(f))


@query("glm_logistic_fit", _newton_sql(0.0))
def glm_logistic_fit(spark, sf):
    return _logistic(spark, sf, Logistic())


@query("glm_logistic_noint", _newton_sql(0.0, False))
def glm_logistic_noint(spark, sf):
    return _logistic(spark, sf, Logistic(intercept=False))


@query("glm_ridge_logistic", _newton_sql(0.01))
def glm_ridge_logistic(spark, sf):
    return _logistic(spark, sf, Logistic(penalty=0.01))


@query(
    "glm_softmax_fit",
    """
SELECT c_mktsegment, o_orderstatus AS level, round(count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment), 4)
         AS probability
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus""",
)
def glm_softmax_fit(spark, sf):
    """On one-hot parents alone a softmax model gives the shares of each cell."""
    rows = orders_cohort(spark, sf).select("c_mktsegment", "o_orderstatus").persist()
    f = frame(rows, "o_orderstatus", ["c_mktsegment"], "multi", y=F.lit(0.0))
    fit = Logistic().fit(f)
    out = fit.add(
        rows.select("c_mktsegment").distinct(),
        [Request(f"p{i}", {}, v) for i, v in enumerate(f.levels)],
    )
    pairs = F.array(
        *[F.struct(F.lit(v).alias("level"), F.col(f"p{i}").alias("p")) for i, v in enumerate(f.levels)]
    )
    return out.select("c_mktsegment", F.explode(pairs).alias("e")).select(
        "c_mktsegment", "e.level", F.round("e.p", 4).alias("probability")
    )


# --- elastic net ---------------------------------------------------------------------------


def by_key():
    """Folds 1..3 by the order key."""
    return (F.col("o_orderkey") % 3 + 1).cast("int")



@query(
    "enet_cv_path",
    """
WITH rows_ AS (SELECT o_orderkey % 3 + 1 AS f, c_acctbal AS x, o_totalprice AS y
               FROM orders JOIN customer ON o_custkey = c_custkey),
own AS (SELECT f, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx,
               var_pop(y) AS vy, covar_pop(x, y) AS cxy FROM rows_ GROUP BY f),
train AS (SELECT k.f, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx,
                 var_pop(y) AS vy, covar_pop(x, y) AS cxy
          FROM own k JOIN rows_ r ON r.f <> k.f GROUP BY k.f),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx,
                 var_pop(y) AS vy, covar_pop(x, y) AS cxy FROM rows_),
path AS (SELECT i, abs(cxy) / sqrt(vx * vy) * pow(1e-4, i / 99.0) AS lam FROM total, range(0, 100) t(i)),
fits AS (SELECT i, f, sign(cxy) * greatest(abs(cxy) / sqrt(vx * vy) - lam, 0) * sqrt(vy / vx) AS b,
                mx, my FROM train, path),
held AS (SELECT i, sum(o.n * (o.vy - 2 * b * o.cxy + b * b * o.vx
                  + pow(o.my - h.my - b * (o.mx - h.mx), 2))) / sum(o.n) AS mse
         FROM fits h JOIN own o ON o.f = h.f GROUP BY i),
beta AS (SELECT i, lam * sqrt(vy) AS penalty,
                sign(cxy) * greatest(abs(cxy) / sqrt(vx * vy) - lam, 0) * sqrt(vy / vx) AS b
         FROM total, path)
SELECT CAST(beta.i AS BIGINT) AS step, round(penalty, 4) + 0.0 AS penalty, round(b, 7) + 0.0 AS coefficient,
       round(mse / 1e6, 4) AS held_out FROM beta JOIN held ON beta.i = held.i""",
)
def enet_cv_path(spark, sf):
    rows = orders_cohort(spark, sf).select(
        by_key().alias("fold"), "c_acctbal", "o_totalprice"
    ).persist()
    sums, _ = _fold_gram(
        rows, [F.col("c_acctbal")], F.col("o_totalprice"), F.lit(1.0), "fold"
    )
    path = EnetPath(sums, 1.0, 100, 1e-4, whole=True)
    _, _, _, spread = path._scaled(sum(sums.values()))
    out = [
        (i, float(lam * spread), float(b[0]), float(e))
        for i, (lam, (_, b), e) in enumerate(zip(path.penalties, path.path, path.errors))
    ]
    made = spark.createDataFrame(
        out, "step bigint, penalty double, coefficient double, held_out double"
    )
    return made.select(
        "step", (F.round("penalty", 4) + 0.0).alias("penalty"),
        (F.round("coefficient", 7) + 0.0).alias("coefficient"),
        F.round(F.col("held_out") / 1e6, 4).alias("held_out"),
    )


ENET_PARENTS = ["c_acctbal", "c_mktsegment", "n_regionkey", "urgent"]


@query("enet_cv")
def enet_cv(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "o_totalprice", *ENET_PARENTS).persist()
    f = frame(rows, "o_totalprice", ENET_PARENTS, "regression", by_key(), ("urgent",))
    fit = ElasticNet(interactions=True).fit(f)
    return terms(spark, fit, 3).withColumn("penalty", F.lit(round(fit.penalty, 3)))


@query("enet_logistic_cv")
def enet_logistic_cv(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "dear", *ENET_PARENTS).persist()
    fit = ElasticNet().fit(frame(rows, "dear", ENET_PARENTS, "binary", by_key()))
    return terms(spark, fit, 4).withColumn("penalty", F.lit(round(fit.penalty, 6)))


@query("enet_multinomial")
def enet_multinomial(spark, sf):
    rows = orders_cohort(spark, sf).select("o_orderkey", "o_orderstatus", "c_acctbal", "urgent").persist()
    f = frame(rows, "o_orderstatus", ["c_acctbal", "urgent"], "multi", by_key(), y=F.lit(0.0))
    fit = ElasticNet().fit(f)
    out = fit.add(rows, [Request(f"p{i}", {}, v) for i, v in enumerate(f.levels)])
    return out.groupBy("urgent").agg(
        *[F.round(F.avg(f"p{i}"), 4).alias(f"p_{v}") for i, v in enumerate(f.levels)]
    )


@query(
    "fold_levels",
    "SELECT DISTINCT o_orderstatus AS level FROM orders",
)
def fold_levels(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderstatus").alias("level")).distinct().orderBy("level")


# --- trees -----------------------------------------------------------------------------------


@query(
    "gbt_fit",
    """
WITH cells AS (SELECT l_quantity AS x, count(*) AS n, sum(l_extendedprice) AS s
               FROM lineitem GROUP BY l_quantity),
cuts AS (SELECT a.x AS cut, sum(CASE WHEN b.x <= a.x THEN n2 END) AS nl,
                sum(CASE WHEN b.x <= a.x THEN s2 END) AS sl,
                sum(CASE WHEN b.x > a.x THEN n2 END) AS nr, sum(CASE WHEN b.x > a.x THEN s2 END) AS sr
         FROM (SELECT x FROM cells) a, (SELECT x, n AS n2, s AS s2 FROM cells) b GROUP BY a.x),
best AS (SELECT * FROM cuts WHERE nr IS NOT NULL
         ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)
SELECT l_quantity, round(CASE WHEN l_quantity <= cut THEN sl / nl ELSE sr / nr END, 3) AS prediction
FROM (SELECT DISTINCT l_quantity FROM lineitem), best""",
)
def gbt_fit(spark, sf):
    """One round of depth one: the split SQL can find by trying every cut."""
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    f = numeric(frame(rows, "l_extendedprice", ["l_quantity"], "regression"))
    fit = Trees(rounds=1, max_depth=1, eta=1.0, penalty=0.0).fit(f)
    out = fit.add(rows.select("l_quantity").distinct(), [Request("prediction")])
    return out.select("l_quantity", F.round("prediction", 3).alias("prediction"))


def _boosted_sql(source: str, loss: str, rounds: int, eta: float, penalty: float) -> str:
    """Trees of depth two on ``x1, x2, n, s`` cells, by trying every cut of every node.

    ``source`` is the SQL of the cells; the result has ``x1, x2, m``.
    """
    squared = loss == "squared"
    start = "sum(s) / sum(n)" if squared else "ln(sum(s) / (sum(n) - sum(s)))"
    g = "n * m - s" if squared else "n / (1 + exp(-m)) - s"
    h = "n" if squared else "n / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m)))"
    steps = [f"c0 AS ({source})", f"m0 AS (SELECT c0.*, b AS m FROM c0, (SELECT {start} AS b FROM c0))"]
    for t in range(rounds):
        steps.append(f"g{t} AS (SELECT *, {g} AS g, {h} AS h, 0 AS node FROM m{t})")
        last = f"g{t}"
        for d in range(2):
            tried = " UNION ALL ".join(
                f"SELECT r.node, {i} AS f, v.x AS cut, "
                f"sum(CASE WHEN x{i} <= v.x THEN g ELSE 0 END) AS gl, sum(g) AS ga, "
                f"sum(CASE WHEN x{i} <= v.x THEN h ELSE 0 END) AS hl, sum(h) AS ha "
                f"FROM {last} r, (SELECT DISTINCT x{i} AS x FROM {last}) v GROUP BY r.node, v.x"
                for i in (1, 2))
            steps += [
                f"t{t}{d} AS ({tried})",
                f"s{t}{d} AS (SELECT node AS k, f, cut, row_number() OVER (PARTITION BY node ORDER BY "
                f"gl * gl / (hl + {penalty}) + (ga - gl) * (ga - gl) / (ha - hl + {penalty}) DESC, f, cut)"
                f" AS place FROM t{t}{d} WHERE hl >= 1 AND ha - hl >= 1)",
                f"n{t}{d} AS (SELECT r.* EXCLUDE (node), 2 * node + CASE WHEN "
                f"CASE WHEN f = 1 THEN x1 ELSE x2 END <= cut THEN 0 ELSE 1 END AS node "
                f"FROM {last} r JOIN s{t}{d} ON k = node AND place = 1)",
            ]
            last = f"n{t}{d}"
        steps.append(
            f"m{t + 1} AS (SELECT x1, x2, n, s, m - {eta} * sum(g) OVER (PARTITION BY node) / "
            f"(sum(h) OVER (PARTITION BY node) + {penalty}) AS m FROM {last})")
    value = "m" if squared else "1 / (1 + exp(-m))"
    return "WITH " + ",\n".join(steps) + (
        f"\nSELECT x1 AS l_quantity, x2 AS l_discount, round({value}, 5) AS prediction FROM m{rounds}")


def _boosted(spark, sf, task, model):
    rows = lineitem_cohort(spark, sf).select("l_quantity", "l_discount", "l_extendedprice", "dear")
    target = "l_extendedprice" if task == "regression" else "dear"
    fit = model.fit(numeric(frame(rows, target, ["l_quantity", "l_discount"], task)))
    out = fit.add(rows.select("l_quantity", "l_discount").distinct(), [Request("prediction")])
    return out.select("l_quantity", "l_discount", F.round("prediction", 5).alias("prediction"))


_CELLS = """SELECT l_quantity AS x1, l_discount AS x2, CAST(count(*) AS DOUBLE) AS n,
  CAST(sum({}) AS DOUBLE) AS s FROM lineitem GROUP BY l_quantity, l_discount"""


@query("gbt_rounds", _boosted_sql(_CELLS.format("l_extendedprice"), "squared", 3, 0.3, 1.0))
def gbt_rounds(spark, sf):
    """Three rounds of depth two with a penalty on leaves."""
    return _boosted(spark, sf, "regression", Trees(rounds=3, max_depth=2))


@query("gbt_logistic_rounds", _boosted_sql(
    _CELLS.format("CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END"), "logistic", 2, 0.3, 10.0))
def gbt_logistic_rounds(spark, sf):
    return _boosted(spark, sf, "binary", Trees(rounds=2, max_depth=2, penalty=10.0))


TREE_PARENTS = ["c_acctbal", "urgent", "o_orderstatus"]


def _tree_rows(spark, sf, target):
    names = list(dict.fromkeys(["o_orderkey", target, *TREE_PARENTS, "late"]))
    return orders_cohort(spark, sf).select(*names).persist()


def _mean_prediction(fit, rows, requests):
    out = fit.add(rows, requests)
    return out.groupBy("late").agg(*[F.round(F.avg(r.out), 3).alias(r.out) for r in requests])


@query("gbt_counterfactual")
def gbt_counterfactual(spark, sf):
    rows = _tree_rows(spark, sf, "o_totalprice")
    f = frame(rows, "o_totalprice", TREE_PARENTS, "regression")
    fit = Trees().fit(f)
    asked = [Request("urgent_true", {"urgent": True}), Request("urgent_false", {"urgent": False})]
    return _mean_prediction(fit, rows, asked)


@query("gbt_classes")
def gbt_classes(spark, sf):
    rows = _tree_rows(spark, sf, "o_orderstatus")
    f = frame(rows, "o_orderstatus", ["c_acctbal", "urgent"], "multi", y=F.lit(0.0))
    fit = Trees().fit(f)
    return _mean_prediction(fit, rows, [Request(f"p_{v}", {}, v) for v in f.levels])


@query("gbt_tuned")
def gbt_tuned(spark, sf):
    rows = _tree_rows(spark, sf, "o_totalprice")
    f = frame(rows, "o_totalprice", TREE_PARENTS, "regression", by_key())
    return _mean_prediction(Tuned().fit(f), rows, [Request("prediction")])


@query("gbt_grid")
def gbt_grid(spark, sf):
    """Every member of the super learner's grid."""
    rows = _tree_rows(spark, sf, "o_totalprice")
    f = frame(rows, "o_totalprice", ["c_acctbal", "urgent"], "regression")
    members = [(n, m) for n, m in model_named("SL", "regression", [], True).members
               if isinstance(m, Trees)]
    out, asked = rows, [n for n, _ in members]
    for n, fit in zip(asked, fit_trees(f, [(m, ()) for _, m in members])):
        out = fit.add(out, [Request(n)])
    return out.agg(*[F.round(F.avg(n), 3).alias(n) for n in asked])


@query(
    "foreign_linear",
    """
WITH t AS (SELECT k.f, covar_pop(x, y) / var_pop(x) AS b, avg(y) - covar_pop(x, y) / var_pop(x) * avg(x) AS a
  FROM (SELECT DISTINCT p_partkey % 3 + 1 AS f FROM part) k
  JOIN (SELECT p_partkey % 3 + 1 AS f, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part) r
    ON r.f <> k.f GROUP BY k.f)
SELECT p_partkey, round(a + b * p_size, 3) AS prediction, round(a + b * 10, 3) AS at_ten
FROM part JOIN t ON t.f = p_partkey % 3 + 1""",
)
def foreign_linear(spark, sf):
    """A regression of ``pyspark.ml``, cross-fitted, as seen and with a parent set to 10."""
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    f = numeric(frame(
        rows, "p_retailprice", ["p_size"], "regression", (F.col("p_partkey") % 3 + 1).cast("int")))
    fit = Foreign(LinearRegression(solver="normal", regParam=0.0)).fit_cross(f)
    out = fit.add(f.df, [Request("prediction"), Request("at_ten", {"p_size": 10})])
    return out.select(
        "p_partkey", F.round("prediction", 3).alias("prediction"), F.round("at_ten", 3).alias("at_ten"))


# --- stacks ------------------------------------------------------------------------------------


@query(
    "stack_glm_constant",
    """
WITH r AS (SELECT p_partkey % 3 + 1 AS f, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part),
t AS (SELECT k.f, avg(y) AS m, covar_pop(x, y) / var_pop(x) AS b,
             avg(y) - covar_pop(x, y) / var_pop(x) * avg(x) AS a
      FROM (SELECT DISTINCT f FROM r) k JOIN r ON r.f <> k.f GROUP BY k.f),
z AS (SELECT y, m AS z1, a + b * x AS z2 FROM r JOIN t USING (f)),
s AS (SELECT sum(z1 * z1) AS aa, sum(z2 * z2) AS bb, sum(z1 * z2) AS ab,
             sum(z1 * y) AS ay, sum(z2 * y) AS yb FROM z),
w AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS w1,
             (yb * aa - ay * ab) / (aa * bb - ab * ab) AS w2 FROM s),
g AS (SELECT avg(y) AS m, covar_pop(x, y) / var_pop(x) AS b,
             avg(y) - covar_pop(x, y) / var_pop(x) * avg(x) AS a FROM r)
SELECT p_partkey, round(w1 * m + w2 * (a + b * p_size), 3) AS prediction,
       round(w1, 3) AS w_constant, round(w2, 3) AS w_linear
FROM part, w, g""",
)
def stack_glm_constant(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    f = numeric(
        frame(rows, "p_retailprice", ["p_size"], "regression", (F.col("p_partkey") % 3 + 1).cast("int"))
    )
    fit = Stack((("constant", Constant()), ("linear", Linear()))).fit(f)
    w = fit.weights()
    return fit.add(rows, [Request("prediction")]).select(
        "p_partkey", F.round("prediction", 3).alias("prediction"),
        F.lit(round(w["constant"], 3) + 0.0).alias("w_constant"),
        F.lit(round(w["linear"], 3) + 0.0).alias("w_linear"),
    )


@query("stack_fit")
def stack_fit(spark, sf):
    rows = _tree_rows(spark, sf, "o_totalprice")
    f = frame(rows, "o_totalprice", TREE_PARENTS, "regression", by_key(), ("urgent",))
    stack = model_named("SL", "regression", ["urgent"], True)
    return _mean_prediction(stack.fit(f), rows, [Request("prediction")])


@query("stack_user")
def stack_user(spark, sf):
    rows = _tree_rows(spark, sf, "dear")
    f = frame(rows, "dear", TREE_PARENTS, "binary", by_key())
    stack = Stack(
        (
            ("ridge", Logistic(penalty=0.1)),
            ("constant", Constant()),
            ("trees", Trees()),
        )
    )
    return _mean_prediction(stack.fit(f), rows, [Request("prediction")])
