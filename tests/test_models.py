import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import functions as F

from counterfold.models import (
    Constant,
    ElasticNet,
    FitFailed,
    Foreign,
    Frame,
    Linear,
    Logistic,
    Request,
    Saturated,
    Stack,
    Trees,
    Tuned,
)
from counterfold.models.base import WEIGHT, Design
from counterfold.models.moments import gram
from counterfold.operators.schema import profile

from conftest import expit

N = 1500


@pytest.fixture(scope="module")
def data(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(N, 3)) * [1, 5, 0.2] + [0, 100, 3]
    t = r.uniform(size=N) < 0.4
    y = 2 + x @ [1.0, -0.3, 4.0] + 1.5 * t + r.normal(0, 0.5, N)
    b = (r.uniform(size=N) < expit(0.8 * x[:, 0] - 0.1 * (x[:, 1] - 100) + t)).astype(int)
    c = np.where(r.uniform(size=N) < expit(x[:, 0]), "a", np.where(t, "b", "c"))
    pdf = pd.DataFrame(x, columns=["x1", "x2", "x3"]).assign(
        id=np.arange(N), t=t, y=y, b=b, c=c, g=np.arange(N) % 4)
    df = spark.createDataFrame(pdf).coalesce(1).withColumn(WEIGHT, F.lit(1.0))
    for i in range(2):
        df = df.withColumn(f"__f{i}", (F.floor(F.col("id") / 3**i) % 3 + 1).cast("int"))
    return df.persist(), pdf


def frame(df, target, parents, task, **kw):
    kinds = profile(df, [target, *parents])
    levels = kinds[target].levels if task != "regression" else None
    return Frame(df, target, F.col(target).cast("double") if task != "multi" else F.lit(0.0), task,
                 tuple(parents), kinds, levels=levels, folds=("__f0", "__f1"), **kw)


X = ["x1", "x2", "x3"]


def predict(fit, df, **kw):
    got = fit.add(df, [Request("p", **kw)]).orderBy("id").select("p").collect()
    return np.array([r["p"] for r in got], dtype=float)


def test_linear_against_spark_and_numpy(data):
    df, pdf = data
    fit = Linear().fit(frame(df, "y", [*X, "t"], "regression"))
    a = np.column_stack([np.ones(N), pdf[X], pdf.t])
    want = np.linalg.lstsq(a, pdf.y, rcond=None)[0]
    assert np.allclose([fit.intercept, *fit.coefs], want, rtol=1e-8)
    rows = VectorAssembler(inputCols=[*X, "tt"], outputCol="f").transform(
        df.withColumn("tt", F.col("t").cast("double")))
    ml = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(rows)
    assert np.allclose(fit.coefs, ml.coefficients.toArray(), rtol=1e-6)
    effect = predict(fit, df, override={"t": True}) - predict(fit, df, override={"t": False})
    assert np.allclose(effect, fit.coefs[-1])


def test_cross_fits_leave_their_fold_out(data):
    df, pdf = data
    cross = Linear().fit_cross(frame(df, "y", X, "regression"))
    fold = pdf.id.to_numpy() % 3 + 1
    want = np.empty(N)
    a = np.column_stack([np.ones(N), pdf[X]])
    for k in (1, 2, 3):
        beta = np.linalg.lstsq(a[fold != k], pdf.y[fold != k], rcond=None)[0]
        want[fold == k] = a[fold == k] @ beta
    assert np.allclose(predict(cross, df), want)
    trees = Trees(rounds=1, max_depth=2).fit_cross(frame(df, "y", ["x1"], "regression"))
    out = trees.add(df, [Request("p")])
    assert out.count() == N and out.where("p is null").count() == 0


def test_both_ways_of_summing_products_agree(data, monkeypatch):
    import counterfold.models.moments as M

    df, _ = data
    columns = [F.lit(1.0), *[F.col(c) for c in X], F.col("y")]
    a = gram(df, columns, F.col(WEIGHT), "__f0")
    monkeypatch.setattr(M, "SQL_COLUMNS", 0)
    b = gram(df, columns, F.col(WEIGHT), "__f0")
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_logistic_against_spark(data):
    df, _ = data
    fit = Logistic().fit(frame(df, "b", X, "binary"))
    rows = VectorAssembler(inputCols=X, outputCol="f").transform(df)
    glr = GeneralizedLinearRegression(
        featuresCol="f", labelCol="b", family="binomial", tol=1e-10, maxIter=50).fit(rows)
    assert np.allclose(fit.coefs, glr.coefficients.toArray(), rtol=1e-5)
    assert np.isclose(fit.intercept, glr.intercept, rtol=1e-5)
    ridge = Logistic(penalty=0.05).fit(frame(df, "b", X, "binary"))
    ml = LogisticRegression(featuresCol="f", labelCol="b", regParam=0.05, elasticNetParam=0.0,
                            standardization=False, tol=1e-10, maxIter=500).fit(rows)
    assert np.allclose(ridge.coefs, ml.coefficients.toArray(), atol=1e-4)


def test_cells_give_the_same_fit_as_rows(data):
    df, _ = data
    cells = df.groupBy("g", "t").agg(F.sum(WEIGHT).alias(WEIGHT), F.avg("b").alias("b"))
    kinds = profile(df, ["g", "t", "b"])
    parents = ("g", "t")

    def fit(rows, y):
        return Logistic().fit(Frame(rows, "b", y, "binary", parents, kinds, levels=(0, 1)))

    a, b = fit(df, F.col("b").cast("double")), fit(cells, F.col("b"))
    assert np.allclose([a.intercept, *a.coefs], [b.intercept, *b.coefs], atol=1e-8)


def test_specified_settings():
    from counterfold.plans.registry import model_named

    members = dict(model_named("SL", "regression", [], True).members)
    trees = [m for m in members.values() if isinstance(m, Trees)]
    assert len({(m.max_depth, m.eta) for m in trees}) == 12
    assert {m.rounds for m in trees} == {100} and {m.max_depth for m in trees} == {2, 4, 6, 8}
    grid = Tuned().settings()
    assert len(grid) == 20 and {m.max_depth for m in grid} == {3, 4, 5, 6, 7}
    assert min(m.penalty for m in grid) == 1e-5 and max(m.penalty for m in grid) == 10.0


def test_softmax_against_spark(data, monkeypatch):
    import counterfold.models.linear as L

    df, _ = data
    df = df.withColumn("z2", (F.col("x2") - 100) / 5)
    f = frame(df, "c", ["x1", "z2"], "multi")
    ours = Logistic(penalty=0.02).fit(f)
    rows = VectorAssembler(inputCols=["x1", "z2"], outputCol="f").transform(df).withColumn(
        "label", (F.array_position(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.col("c")) - 1).cast("double"))
    ml = LogisticRegression(featuresCol="f", family="multinomial", regParam=0.02,
                            standardization=False, tol=1e-10, maxIter=500).fit(rows)
    assert np.allclose(np.array(ours.coefs), ml.coefficientMatrix.toArray(), atol=2e-3)
    p = [predict(ours, df, level=v) for v in ("a", "b", "c")]
    assert np.allclose(sum(p), 1.0)
    monkeypatch.setattr(L, "SOFTMAX_COEFFICIENTS", 0)
    other = Logistic().fit(f)
    monkeypatch.undo()
    q = [predict(other, df, level=v) for v in ("a", "b", "c")]
    r = [predict(Logistic().fit(f), df, level=v) for v in ("a", "b", "c")]
    assert np.allclose(q, r, atol=1e-3)


@pytest.mark.parametrize("target,classes", [("b", 1), ("c", 3)])
def test_penalty_path_against_newton_steps(data, monkeypatch, target, classes):
    """Shared curvature, in one pass or in many small ones, reaches the same optimum."""
    import counterfold.models.moments as M
    from counterfold.models.linear import _label, _logistic_rows, _scales

    df, _ = data
    f = frame(df, target, X, "binary" if classes == 1 else "multi")
    columns = Design(f.parents, f.kinds).columns()
    means, sds, _ = _scales(f, columns)
    rows = _logistic_rows(f, columns, means, sds, "__f0").coalesce(1).persist()
    assert _label(f) is not None
    models = [(k, 0.9 * lam, 0.1 * lam) for k in (-1, 1, 2) for lam in (0.1, 0.03, 0.01, 0.001)]
    want, want_held, ok = M.logistic_path(rows, 4, models, True, classes)
    got, held, done, _ = M.penalty_path(rows, 4, models, classes)
    assert all(ok) and all(done)

    def scores(b):
        b = b.reshape(len(models), classes, 4)
        return b - b.mean(axis=1, keepdims=True) if classes > 1 else b

    assert np.allclose(scores(got)[:, :, 1:], scores(want)[:, :, 1:], atol=2e-3)
    assert all(np.isclose(held[i][0], want_held[i][0], rtol=1e-4) for i in range(4, 12))
    monkeypatch.setattr(M, "PASS_COEFFICIENTS", 1)
    monkeypatch.setattr(M, "PASS_SCORES", 40)
    small, _, done, _ = M.penalty_path(rows, 4, models[:5], classes)
    assert all(done) and np.allclose(scores(got)[:5, :, 1:],
                                     (small.reshape(5, classes, 4) - (
                                         small.reshape(5, classes, 4).mean(axis=1, keepdims=True)
                                         if classes > 1 else 0))[:, :, 1:], atol=2e-3)


@pytest.mark.parametrize("classes", [1, 3])
def test_penalty_path_sums_of_a_task_with_one_fold(spark, classes):
    """A task all of whose rows a model leaves out adds nothing to that model."""
    import counterfold.models.moments as M

    r = np.random.default_rng(8)
    pdf = pd.DataFrame({"w": 1.0, "y": (np.arange(60) % max(classes, 2)).astype(float),
                        "k": np.repeat([1, 2], 30), "x0": 1.0, "x1": r.normal(size=60)})
    df = spark.createDataFrame(pdf)
    betas = r.normal(size=(3, 2 * classes))
    asked = betas, np.array([-1, 1, 2]), classes, [0, 1]
    apart, bent = M.path_sums(df.repartitionByRange(2, "k"), *asked)
    whole, bent_whole = M.path_sums(df.coalesce(1), *asked)
    assert all(np.allclose(apart[i][key], whole[i][key]) for i in whole for key in whole[i])
    assert all(np.allclose(bent[i], bent_whole[i]) for i in bent_whole)


def test_penalty_path_works_on_different_rows_only(data, monkeypatch):
    """Every row five times over gives the same net, from a path over no more rows."""
    import counterfold.models.linear as L

    df, _ = data
    seen, path = [], L.penalty_path

    def counted(rows, *args, **kw):
        seen.append(rows.count())
        return path(rows, *args, **kw)

    monkeypatch.setattr(L, "penalty_path", counted)
    five = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("copy")
    net = ElasticNet(penalties=5, ratio=0.1)
    once, often = (net.fit(frame(d, "c", X, "multi")) for d in (df, five))
    assert seen == [N, N]
    assert np.isclose(once.penalty, often.penalty)
    assert np.allclose(once.coefs, often.coefs, atol=1e-6)


def test_classes_with_many_columns_choose_from_the_same_path(spark):
    """Columns without any say, past the number that once changed the grid, change nothing."""
    r = np.random.default_rng(5)
    n, extra = 600, 110
    x = r.normal(size=(n, 2))
    c = np.where(r.uniform(size=n) < expit(2 * x[:, 0]), "a", np.where(x[:, 1] > 0, "b", "c"))
    pdf = pd.DataFrame(x, columns=["x0", "x1"]).assign(c=c, id=np.arange(n))
    for i in range(extra):
        pdf[f"z{i}"] = 0.0
    df = spark.createDataFrame(pdf).coalesce(1).withColumn(WEIGHT, F.lit(1.0))
    for i in range(2):
        df = df.withColumn(f"__f{i}", (F.floor(F.col("id") / 3**i) % 3 + 1).cast("int"))
    few = ElasticNet(penalties=3, ratio=0.1).fit(frame(df, "c", ["x0", "x1"], "multi"))
    many = ElasticNet(penalties=3, ratio=0.1).fit(frame(df, "c", ["x0", "x1", *[f"z{i}" for i in range(extra)]], "multi"))
    assert len(many.coefs) * (len(many.coefs[0]) + 1) > 300
    assert np.isclose(few.penalty, many.penalty)
    assert np.allclose(np.array(few.coefs), np.array(many.coefs)[:, :2], atol=1e-6)


def test_elastic_net_regression_quality(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(1000, 5))
    y = x @ [2.0, 0.0, -1.0, 0.5, 0.0] + r.normal(0, 0.05, 1000)
    names = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(y=y, id=np.arange(1000)))
    df = df.withColumn(WEIGHT, F.lit(1.0)).withColumn("__f0", (F.col("id") % 3 + 1).cast("int"))
    df = df.withColumn("__f1", F.col("__f0"))
    fit = ElasticNet().fit(frame(df, "y", names, "regression"))
    assert np.sqrt(np.mean((predict(fit, df) - y) ** 2)) < 0.1
    rows = VectorAssembler(inputCols=names, outputCol="f").transform(df)
    ml = LinearRegression(featuresCol="f", labelCol="y", elasticNetParam=1.0,
                          regParam=fit.penalty, tol=1e-10, maxIter=1000).fit(rows)
    assert np.allclose(fit.coefs, ml.coefficients.toArray(), atol=2e-3)


def log_loss(p, y):
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))


def test_elastic_net_classifier_quality(spark):
    """Two interleaved half circles, then well separated blobs."""
    r = np.random.default_rng(2)
    n = 1000
    y = np.arange(n) % 2
    a = r.uniform(0, np.pi, n)
    x = np.where(y == 0, np.cos(a), 1 - np.cos(a)) + r.normal(0, 0.05, n)
    z = np.where(y == 0, np.sin(a), 0.5 - np.sin(a)) + r.normal(0, 0.05, n)
    pdf = pd.DataFrame({"id": np.arange(n), "x": x, "z": z, "y": y})
    df = spark.createDataFrame(pdf).coalesce(1).withColumn(WEIGHT, F.lit(1.0))
    for i in range(2):
        df = df.withColumn(f"__f{i}", (F.floor(F.col("id") / 2) % 3 + 1).cast("int"))
    fit = ElasticNet().fit(frame(df, "y", ["x", "z"], "binary"))
    assert log_loss(predict(fit, df), y) < 0.3
    optimum = Logistic().fit(frame(df, "y", ["x", "z"], "binary"))
    assert log_loss(predict(fit, df), y) < log_loss(predict(optimum, df), y) + 0.01

    centre = np.array([[0, 0], [8, 0], [0, 8]])[np.arange(n) % 3]
    blob = centre + r.normal(0, 0.7, (n, 2))
    pdf = pd.DataFrame({"id": np.arange(n), "x": blob[:, 0], "z": blob[:, 1],
                        "c": np.array(["a", "b", "c"])[np.arange(n) % 3]})
    df = spark.createDataFrame(pdf).coalesce(1).withColumn(WEIGHT, F.lit(1.0))
    for i in range(2):
        df = df.withColumn(f"__f{i}", (F.floor(F.col("id") / 3) % 3 + 1).cast("int"))
    fit = ElasticNet().fit(frame(df, "c", ["x", "z"], "multi"))
    p = np.column_stack([predict(fit, df, level=v) for v in ("a", "b", "c")])
    assert -np.mean(np.log(p[np.arange(n), np.arange(n) % 3])) < 0.008


def test_constant_and_saturated(data):
    df, pdf = data
    assert np.isclose(predict(Constant().fit(frame(df, "y", [], "regression")), df)[0], pdf.y.mean())
    shares = Constant().fit(frame(df, "c", [], "multi"))
    assert np.isclose(predict(shares, df, level="a")[0], (pdf.c == "a").mean())
    f = frame(df, "y", ["g", "t"], "regression", treatments=("t",))
    fit = Saturated().fit(f)
    got = predict(fit, df, override={"t": True})
    want = pdf[pdf.t].groupby("g").y.mean()
    assert np.allclose(got, want.loc[pdf.g])
    observed = predict(fit, df)
    assert np.allclose(observed, pdf.groupby(["g", "t"]).y.transform("mean"))
    crossed = predict(Saturated().fit_cross(f), df, override={"t": False})
    other = pdf[(~pdf.t) & (pdf.id % 3 != 0)].groupby("g").y.mean()
    at = (pdf.id % 3 == 0).to_numpy()
    assert np.allclose(crossed[at], other.loc[pdf.g[at]])


def test_large_cell_tables_are_joined_by_shuffle(data, monkeypatch):
    import counterfold.models.base as B
    import counterfold.models.simple as S

    df, pdf = data
    monkeypatch.setattr(B, "BROADCAST_CELLS", 2)
    monkeypatch.setattr(S, "BROADCAST_CELLS", 2)
    fit = Saturated().fit(frame(df, "y", ["g"], "regression"))
    assert np.allclose(predict(fit, df), pdf.groupby("g").y.transform("mean"))
    assert fit.tables
    fit.release()
    assert not fit.tables


def test_stack_learns_the_better_member(data):
    df, pdf = data
    stack = Stack((("constant", Constant()), ("linear", Linear()), ("net", ElasticNet())))
    assert stack.depth == 2 and stack.cells
    fit = stack.fit(frame(df, "y", [*X, "t"], "regression"))
    assert np.sqrt(np.mean((predict(fit, df) - pdf.y) ** 2)) < 0.6
    w = fit.weights()
    assert abs(w["constant"]) < 0.1 and np.isclose(sum(w.values()), 1, atol=0.05)
    many = Stack((("constant", Constant()), ("soft", Logistic(penalty=0.01))))
    f = frame(df, "c", X, "multi")
    p = [predict(many.fit(f), df, level=v) for v in f.levels]
    assert np.allclose(sum(p), 1.0)


def test_stack_weights_of_members_that_are_nearly_alike(spark):
    """Three equal folds: what the line says beyond the mean is all there is to learn."""
    r = np.random.default_rng(12)
    x = r.integers(1, 51, 2000)
    y = 949.6 + 0.0134 * x + r.uniform(-50, 50, 2000)
    pdf = pd.DataFrame({"id": np.arange(6000), "x": np.repeat(x, 3).astype(float), "y": np.repeat(y, 3)})
    df = spark.createDataFrame(pdf).coalesce(1).withColumns(
        {WEIGHT: F.lit(1.0), "__f0": (F.col("id") % 3 + 1).cast("int"), "__f1": F.lit(1)})
    stack = Stack((("constant", Constant()), ("linear", Linear())))
    w = stack.fit(frame(df, "y", ["x"], "regression")).weights()
    assert np.allclose([w["constant"], w["linear"]], [0.0, 1.0], atol=1e-9, rtol=0)


@pytest.mark.parametrize("odd", ["plain", "equal", "multiple", "zero", "constant"])
def test_no_intercept_from_shifted_sums(odd):
    """As numpy on the rows; dependent columns share the smallest solution."""
    from counterfold.models.moments import solve_through_origin

    r = np.random.default_rng(0)
    x = r.normal(size=(500, 4)) * [1, 2, 0.1, 3] + [0.3, 100, 5, 1]
    if odd == "equal":
        x[:, 1] = x[:, 0]
    if odd == "multiple":
        x[:, 1] = 3 * x[:, 2]
    if odd == "zero":
        x[:, 3] = 0
    if odd == "constant":
        x[:, :2] = 7, 5
    y = 3 + x @ [1, 2, 3, -1] + r.normal(size=500)
    shift = np.append(np.median(x[:50], axis=0), np.median(y[:50]))
    z = np.column_stack([np.ones(500), x - shift[:-1], y - shift[-1]])
    size = np.sqrt(np.maximum((x * x).sum(axis=0), 1e-300))
    want = np.linalg.lstsq(x / size, y, rcond=1e-12)[0] / size
    assert np.allclose(solve_through_origin(z.T @ z, shift), want, atol=1e-9)


def test_trees(data):
    df, pdf = data
    f = frame(df, "y", [*X, "t"], "regression")
    fit = Trees(rounds=20, max_depth=4).fit(f)
    assert np.std(predict(fit, df) - pdf.y) < 0.5 * np.std(pdf.y)
    two = fit.add(df, [Request("on", {"t": True}), Request("off", {"t": False})])
    assert [*df.columns, "on", "off"] == two.columns
    effect = two.agg(F.avg(F.col("on") - F.col("off"))).first()[0]
    assert 0.5 < effect < 2.0
    f = frame(df, "c", ["x1", "t"], "multi")
    cls = Trees(rounds=10, max_depth=3).fit(f)
    p = np.stack([predict(cls, df, level=v) for v in f.levels], 1)
    assert np.allclose(p.sum(axis=1), 1.0)
    assert (np.array(f.levels)[p.argmax(axis=1)] == pdf.c).mean() > 0.65  # the best there is: about 0.69


def test_tuned_takes_the_smallest_held_out_loss(data):
    """The loss of every setting and fold is what fits on the other folds give there."""
    from counterfold.models.trees import held_out_losses

    df, pdf = data
    f = frame(df, "b", ["x1", "x2"], "binary")
    tuned = Tuned(Trees(rounds=4), max_depth=(1, 3), penalty=(0.1, 10.0))
    asked = [(m, (("__f0", k),)) for m in tuned.settings() for k in (1, 2, 3)]
    losses = held_out_losses(f, asked)
    fold = pdf.id.to_numpy() % 3 + 1
    for (m, ((_, k),)), (loss, n) in list(zip(asked, losses))[::4]:
        p = predict(m.fit_cross(f), df)[fold == k]
        b = pdf.b.to_numpy()[fold == k]
        want = -(b * np.log(p) + (1 - b) * np.log(1 - p)).sum()
        assert np.isclose(loss, want, rtol=1e-9) and n == (fold == k).sum()
    means = [sum(x[0] for x in losses[i : i + 3]) for i in range(0, 12, 3)]
    best = tuned.best(f, "__f0", [()])[0]
    assert best == tuned.settings()[int(np.argmin(means))]
    assert np.isfinite(predict(tuned.fit(f), df)).all()
    crossed = predict(tuned.fit_cross(f), df)
    assert np.isfinite(crossed).all() and len(np.unique(crossed)) > 3


@pytest.mark.parametrize("task,target", [("regression", "y"), ("binary", "b"), ("multi", "c")])
def test_trees_grow_alike_side_by_side_and_in_step(data, task, target):
    """One task a job, and one pass a level, give the same trees and losses."""
    from counterfold.models.boosting import Job, boost

    df, _ = data
    f = frame(df, target, ["x1", "x2", "t"], task)
    columns = Design(f.parents, f.kinds).columns()
    targets = [f.y] if task != "multi" else [(F.col("c") == v).cast("double") for v in f.levels]
    loss = {"regression": "squared", "binary": "logistic", "multi": "softmax"}[task]
    jobs = [Job(3, 2, 0.3, 1.0), Job(2, 3, 0.1, 0.01, 5.0, (("__f0", 2),)),
            Job(3, 1, 0.3, 10.0, 1.0, (("__f0", 1), ("__f1", 3)))]
    (_, a), (_, b) = (boost(df.repartition(5), columns, targets, f.weight, loss, jobs,
                            max_bins=32, few=few) for few in (10**9, 0))
    for (x, lx, nx), (y, ly, ny) in zip(a, b):
        assert (x.feature == y.feature).all() and (x.cut == y.cut).all()
        assert np.allclose(x.value, y.value, rtol=1e-12, atol=0) and np.allclose(x.base, y.base)
        assert np.isclose(lx, ly) and nx == ny
    assert a[0][2] == 0 and a[1][2] > a[2][2] > 0


def test_trees_without_features_and_with_missing_values(spark, data):
    df, pdf = data
    none = Trees(rounds=3).fit(frame(df, "y", [], "regression"))
    assert np.allclose(predict(none, df), pdf.y.mean())
    rows = spark.createDataFrame([(i, float(i % 5) if i % 7 else None, float(i % 7 == 0), 1.0)
                                  for i in range(200)], "id long, x double, y double, `__n` double")
    kinds = profile(rows.where("x IS NOT NULL"), ["x"])
    f = Frame(rows, "y", F.col("y"), "regression", ("x",), kinds)
    p = predict(Trees(rounds=20, max_depth=2, penalty=0.0).fit(f), rows)
    assert np.isfinite(p).all()


@pytest.mark.parametrize("most", [0, 1 << 16])
def test_trees_score_equal_bins_once(monkeypatch, most):
    """Scores are those of every row by itself, from walks over different rows only."""
    import counterfold.models.trees as M
    from counterfold.models.boosting import Ensemble, to_bins

    r = np.random.default_rng(6)
    cuts = [np.array([-1.0, 0.0, 1.0]), np.array([0.5])]
    made = [Ensemble(np.array([0.1 * k]), np.tile([0, 1, -1], (4, 1, 1)), r.integers(0, 2, (4, 1, 3)),
                     r.normal(size=(4, 1, 7))) for k in range(2)]
    for e in made:
        e.feature = np.concatenate([e.feature, np.full((4, 1, 4), -1)], axis=2)
        e.cut = np.concatenate([e.cut, np.zeros((4, 1, 4), int)], axis=2)
    columns = [r.normal(size=4000), r.integers(0, 2, 4000).astype(float)]
    columns[0][:5] = np.nan
    fold = r.integers(0, 2, 4000)
    want = [made[k].margins(to_bins([c[i:i + 1] for c in columns], cuts, 1))[0, 0]
            for i, k in enumerate(fold)]
    walked, margins = [], Ensemble.margins
    monkeypatch.setattr(M, "REMEMBERED", most)
    monkeypatch.setattr(Ensemble, "margins", lambda e, b: walked.append(len(b)) or margins(e, b))
    scores = M._scores(dict(enumerate(made)), dict(enumerate([cuts, cuts])), "regression")
    got = [v[0] for i in range(0, 4000, 1000) for v in scores(
        pd.Series(fold[i:i + 1000]), *(pd.Series(c[i:i + 1000]) for c in columns))]
    assert got == want
    assert sum(walked) <= 2 * 8 * (4 if most == 0 else 1)


def test_foreign_estimators(data):
    from pyspark.ml.classification import LinearSVC, RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor

    from counterfold.plans.registry import model_from_dict

    df, pdf = data
    f = frame(df, "y", [*X, "t"], "regression")
    fit = Foreign(RandomForestRegressor(numTrees=5, maxDepth=6)).fit_cross(f)
    out = fit.add(df, [Request("seen"), Request("on", {"t": True}), Request("off", {"t": False})])
    assert out.columns == [*df.columns, "seen", "on", "off"] and out.count() == N
    assert out.agg(F.avg(F.col("on") - F.col("off"))).first()[0] > 0
    f = frame(df, "c", ["x1", "t"], "multi")
    cls = model_from_dict({"model": "spark", "classifier": {
        "class": "pyspark.ml.classification.RandomForestClassifier", "numTrees": 5}})
    assert isinstance(cls.classifier, RandomForestClassifier)
    p = np.stack([predict(cls.fit(f), df, level=v) for v in f.levels], 1)
    assert np.allclose(p.sum(axis=1), 1.0) and p.std() > 0.1
    svc = Foreign(classifier=LinearSVC(maxIter=5)).fit(frame(df, "b", X, "binary"))
    assert set(predict(svc, df)) <= {0.0, 1.0}
    with pytest.raises(FitFailed, match="no estimator"):
        Foreign(RandomForestRegressor()).fit(frame(df, "b", X, "binary"))
    with pytest.raises(ValueError, match="not an estimator"):
        model_from_dict({"model": "spark", "regressor": {"class": "os.system"}})


def test_failures(data):
    df, _ = data
    with pytest.raises(FitFailed, match="cannot learn"):
        Linear().fit(frame(df, "b", X, "binary"))
    with pytest.raises(FitFailed, match="cannot learn"):
        Logistic().fit(frame(df, "y", X, "regression"))
    one = frame(df.where("b = 1"), "b", X, "binary")
    with pytest.raises(FitFailed, match="single class"):
        Logistic().fit(one)
    with pytest.raises(FitFailed, match="no rows"):
        Linear().fit(frame(df.where("id < 0"), "y", X, "regression"))


def test_design_matches_interactions_on_the_source_column(data):
    df, _ = data
    kinds = profile(df, ["c", "t", "x1"])
    d = Design(("c", "t", "x1"), kinds, ("c",), True)
    assert d.names == ["c=a", "c=b", "t", "x1", "c=a_&_t", "c=a_&_x1", "c=b_&_t", "c=b_&_x1"]
    fixed = df.limit(1).select(*[c.alias(n) for n, c in zip(d.names, d.columns({"c": "b", "t": 1}))])
    row = fixed.first()
    assert (row["c=a"], row["c=b"], row["c=a_&_t"], row["c=b_&_t"]) == (0.0, 1.0, 0.0, 1.0)
