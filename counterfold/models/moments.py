"""Distributed sums that the linear models are solved from.

The rows are never collected: tasks sum over their own rows, Spark adds the sums up,
and the driver solves systems of the size of the design (p x p).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many columns the products are summed by generated code.
SQL_COLUMNS = 12


def near(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """A value close to each column (a middle one of the first rows).  Sums of
    differences from it keep their digits; it does not change what they say."""
    if not columns:
        return np.zeros(0)
    first = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)]).limit(200)
    values = np.array([list(r) for r in first.collect()], dtype=float)
    if not len(values):
        return np.zeros(len(columns))
    middle = np.array([np.median(v[np.isfinite(v)]) if np.isfinite(v).any() else 0.0
                       for v in values.T])
    return middle


def means_and_spread(df: DataFrame, columns: Sequence[Column], weight: Column):
    """Weighted means and (1/n) standard deviations in one pass."""
    base = near(df, columns)
    means, sds = [], []
    for start in range(0, len(columns), 40):
        part = columns[start : start + 40]
        shifted = [c - F.lit(float(base[start + i])) for i, c in enumerate(part)]
        row = df.agg(
            F.sum(weight).alias("w"),
            *[F.sum(weight * c).alias(f"m{i}") for i, c in enumerate(shifted)],
            *[F.sum(weight * c * c).alias(f"s{i}") for i, c in enumerate(shifted)],
        ).first()
        if not row["w"]:
            return np.zeros(len(columns)), np.ones(len(columns))
        for i in range(len(part)):
            m, s = row[f"m{i}"] / row["w"], row[f"s{i}"] / row["w"]
            means.append(base[start + i] + m)
            # What rounding leaves of a constant column is no spread.
            spread = s - m * m
            sds.append(np.sqrt(spread) if spread > 1e-13 * s else 0.0)
    return np.array(means), np.array(sds)


def gram(
    df: DataFrame, columns: Sequence[Column], weight: Column, fold: str | None = None
) -> dict[int, np.ndarray]:
    """Weighted sums of products of the columns, per fold (0 when there is none)."""
    q = len(columns)
    key = F.col(fold).cast("int") if fold else F.lit(0)
    rows = df.select(
        key.alias("k"), weight.alias("w"), *[c.alias(f"x{i}") for i, c in enumerate(columns)]
    )
    out: dict[int, np.ndarray] = {}
    if q <= SQL_COLUMNS:
        pairs = [(i, j) for i in range(q) for j in range(i, q)]
        got = (
            rows.groupBy("k")
            .agg(*[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}")
                   for i, j in pairs])
            .collect()
        )
        for r in got:
            g = np.zeros((q, q))
            for i, j in pairs:
                g[i, j] = g[j, i] = r[f"s{i}_{j}"]
            out[r["k"]] = g
        return out

    def partial(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = pdf.iloc[:, 2:].to_numpy(dtype=float)
            w = pdf["w"].to_numpy(dtype=float)
            k = pdf["k"].to_numpy()
            for f in np.unique(k):
                m = k == f
                acc[int(f)] = acc.get(int(f), 0.0) + (x[m] * w[m, None]).T @ x[m]
        for f, a in acc.items():
            for i in range(0, q, 64):
                some = range(i, min(i + 64, q))
                yield pd.DataFrame({"k": f, "i": list(some), "v": [a[r] for r in some]})

    # a row of the matrix is a key of its own, so no reducer gets whole matrices of all tasks
    sums = rows.mapInPandas(partial, "k int, i int, v array<double>")
    got = sums.groupBy("k", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    for r in got:
        out.setdefault(r["k"], np.zeros((q, q)))[r["i"]] = r["v"].toArray()
    return out


def solve_least_squares(g: np.ndarray, intercept: bool) -> tuple[float, np.ndarray]:
    """Coefficients from the product sums of (1, x…, y); dependent columns share the
    smallest solution."""
    s = g if intercept else g[1:, 1:]
    a, b = s[:-1, :-1], s[:-1, -1]
    scale = np.sqrt(np.clip(np.diag(a), 1e-300, None))
    beta = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-12)[0] / scale
    return (float(beta[0]), beta[1:]) if intercept else (0.0, beta)


def solve_through_origin(g: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Coefficients without intercept from the product sums of (1, x - m, y - m) and the shifts m.

    Columns that hardly vary look alike in sums of their own products.  So the one that varies
    least is kept, and its multiples are taken from the others and from y such that the shifts
    cancel before anything is summed.  Dependent columns share the smallest solution.
    """
    q = len(g)
    p = q - 2
    if not p:
        return np.zeros(0)
    lift = np.zeros((q - 1, q))  # the columns and y by (1, x - m, y - m)
    lift[:, 0], lift[:, 1:] = shift, np.eye(q - 1)
    spread = np.diag(g)[1:-1]
    level = shift[:-1] ** 2 * g[0, 0]
    steady = np.divide(level, np.maximum(spread, 1e-30 * level), out=np.zeros(p), where=level > 0)
    j = int(np.argmax(steady))
    back, start = np.eye(p), np.zeros(p)  # the answer is back @ beta + start
    size = np.einsum("ij,jk,ik->i", lift, g, lift)
    if steady[j] > 1:
        ratio = shift / shift[j]
        others = np.arange(q - 1) != j
        lift[others, 0] = 0.0
        lift[others, j + 1] -= ratio[others]
        back[j, others[:-1]] -= ratio[:-1][others[:-1]]
        start[j] = ratio[-1]
    s = lift @ g @ lift.T
    a, b = s[:-1, :-1], s[:-1, -1]
    # what rounding leaves of a column that depends on the kept one
    terms = np.einsum("ij,j->i", lift[:-1] ** 2, np.diag(g))
    flat = np.diag(a) <= 1e-12 * terms
    a, b = np.where(flat[:, None] | flat[None, :], 0.0, a), np.where(flat, 0.0, b)
    scale = np.sqrt(np.where(flat, 1.0, np.diag(a)))
    u, d, vt = np.linalg.svd(a / np.outer(scale, scale))
    known = d > 1e-12 * max(d[0], 1e-300)
    beta = vt[known].T @ ((u[:, known].T @ (b / scale)) / d[known]) / scale
    answer = back @ beta + start
    if not known.all():
        free = back @ (vt[~known].T / scale[:, None])
        weigh = np.sqrt(np.clip(size[:-1], 1e-300, None))
        answer = answer - free @ np.linalg.lstsq(
            weigh[:, None] * free, weigh * answer, rcond=1e-12)[0]
    return answer


def penalised_quadratic(h, c, start, l1, l2, sweeps=1000, tol=1e-10) -> np.ndarray:
    """min ½ b'Hb - c'b + Σ l1|b| + ½ l2 b², coordinate by coordinate; columns that
    are 0 rest until the others have settled."""
    b = [float(v) for v in start]
    r = c - h @ start
    diag = [float(v) for v in np.diag(h)]
    l1, l2 = [float(v) for v in l1], [float(v) for v in l2]
    rows = list(h)
    everything = [j for j in range(len(b)) if diag[j] + l2[j] > 0]
    active = everything
    for _ in range(sweeps):
        worst = 0.0
        for j in active:
            old = b[j]
            x = float(r[j]) + diag[j] * old
            t = l1[j]
            new = (x - t if x > t else x + t if x < -t else 0.0) / (diag[j] + l2[j])
            if new != old:
                b[j] = new
                r -= rows[j] * (new - old)
                worst = max(worst, diag[j] * (new - old) ** 2)
        if worst < tol:
            if active is everything:
                break
            active = everything
        else:
            active = [j for j in everything if b[j] != 0.0]
    return np.array(b)


def newton_sums(
    df: DataFrame, betas: np.ndarray, left_out: Sequence[int], classes: int = 1
) -> dict[int, dict]:
    """One pass for many logistic models at once.

    ``df``: ``w, y, k`` and ``x0…`` (x0 is 1).  Model m is trained on rows whose fold
    k differs from ``left_out[m]`` (-1 leaves out nothing).  With one class ``y`` is
    the share of 1, else the number of the level and a model has ``classes`` rows of
    coefficients.  Per model: training loss, loss on the rows left out, gradient and
    curvature.
    """
    m, size_b = betas.shape
    q = size_b // classes
    size = 4 + size_b + size_b * size_b

    def add(acc, x, w, y, b, train):
        eta = x @ b.reshape(classes, q).T
        if classes == 1:
            loss = w * (np.logaddexp(0.0, eta[:, 0]) - y * eta[:, 0])
            p = 1.0 / (1.0 + np.exp(-eta))
            r = y[:, None] - p
        else:
            top = eta.max(axis=1, keepdims=True)
            e = np.exp(eta - top)
            total = e.sum(axis=1, keepdims=True)
            p = e / total
            hit = y[:, None] == np.arange(classes)
            loss = w * (top[:, 0] + np.log(total[:, 0]) - eta[hit])
            r = hit - p
        acc[0] += loss[train].sum()
        acc[1] += loss[~train].sum()
        tw = w * train
        acc[2] += tw.sum()
        acc[3] += w.sum() - tw.sum()
        acc[4 : 4 + size_b] += ((r * tw[:, None]).T @ x).ravel()
        h = acc[4 + size_b :].reshape(classes, q, classes, q)
        for c in range(classes):
            for d in range(c, classes):
                v = tw * p[:, c] * ((c == d) - p[:, d])
                block = (x * v[:, None]).T @ x
                h[c, :, d, :] += block
                if c != d:
                    h[d, :, c, :] += block

    def partial(batches):
        acc = np.zeros((m, size))
        seen = False
        for pdf in batches:
            seen = True
            x = pdf.iloc[:, 3:].to_numpy(dtype=float)
            w = pdf["w"].to_numpy(dtype=float)
            y = pdf["y"].to_numpy(dtype=float)
            k = pdf["k"].to_numpy()
            for i in range(m):
                add(acc[i], x, w, y, betas[i], k != left_out[i])
        if seen:
            yield pd.DataFrame({"m": np.arange(m), "v": list(acc)})

    sums = df.mapInPandas(partial, "m int, v array<double>")
    got = sums.groupBy("m").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    out = {}
    for r in got:
        v = r["v"].toArray()
        out[r["m"]] = {
            "loss": v[0],
            "held_loss": v[1],
            "w": v[2],
            "held_w": v[3],
            "grad": v[4 : 4 + size_b],
            "hess": v[4 + size_b :].reshape(size_b, size_b),
        }
    return out


def logistic_path(
    df: DataFrame,
    q: int,
    models: Sequence[tuple[int, float, float]],
    intercept: bool,
    classes: int = 1,
    passes: int = 40,
    tol: float = 1e-10,
) -> tuple[np.ndarray, dict[int, tuple[float, float]], list[bool]]:
    """Fit logistic (or softmax) models ``(left out fold, l1, l2)`` together by Newton
    steps with a penalised quadratic; columns are standardised by the caller.

    Returns coefficients, mean loss and weight of the rows left out, and which models
    converged.
    """
    m, size_b = len(models), q * classes
    betas = np.zeros((m, size_b))
    steps = np.zeros((m, size_b))
    size = np.ones(m)
    best = np.full(m, np.inf)
    held: dict[int, tuple[float, float]] = {}
    done = [False] * m
    first = np.arange(size_b) % q == 0
    keep = ~first if not intercept else np.ones(size_b, dtype=bool)
    for _ in range(passes):
        live = [i for i in range(m) if not done[i]]
        if not live:
            break
        trial = betas[live] + size[live, None] * steps[live]
        sums = newton_sums(df, trial, [models[i][0] for i in live], classes)
        if not sums:
            raise ValueError("no rows")
        for at, i in enumerate(live):
            s = sums[at]
            if s["w"] <= 0:
                raise ValueError("no training rows")
            _, a, b2 = models[i]
            l1 = np.where(first, 0.0, a)
            l2 = np.where(first, 0.0, b2)
            t = trial[at]
            value = s["loss"] / s["w"] + (l1 * np.abs(t)).sum() + 0.5 * (l2 * t * t).sum()
            if not np.isfinite(value) or value > best[i] + 1e-12 * abs(best[i]):
                size[i] *= 0.5
                done[i] = size[i] < 1e-6
                continue
            gain = best[i] - value
            betas[i], best[i], size[i] = t, value, 1.0
            w = s["held_w"]
            held[i] = (s["held_loss"] / w, w) if w > 0 else (0.0, 0.0)
            h, g = s["hess"] / s["w"], s["grad"] / s["w"]
            h = h + np.eye(size_b) * 1e-12
            step = np.zeros(size_b)
            if not a:
                step[keep] = np.linalg.lstsq(
                    (h + np.diag(l2))[np.ix_(keep, keep)], (g - l2 * t)[keep], rcond=1e-11
                )[0]
            else:
                lock = np.where(keep, l1, np.inf)
                step = penalised_quadratic(h, g + h @ t, t, lock, l2) - t
            steps[i] = step
            if np.sqrt(np.max(step * step * np.diag(h))) < np.sqrt(tol) or gain < 1e-14:
                done[i] = True
                betas[i] = t + step
    return betas, held, done


# --- penalty paths ------------------------------------------------------------------------------

#: Models of a fold whose curvature is summed; the others use the nearest one's.
CURVATURES = 5
#: Coefficients of all models of a pass, and scores of a block of rows: bound a task's memory.
PASS_COEFFICIENTS, PASS_SCORES = 1 << 22, 1 << 20


def path_sums(
    df: DataFrame, betas: np.ndarray, left_out: np.ndarray, classes: int, bent: Sequence[int]
) -> tuple[dict[int, dict], dict[int, np.ndarray]]:
    """One pass: losses and gradients of many models, and curvature of those in ``bent``.

    Rows and models are as in ``newton_sums``.  The curvature has a q x q block for each class;
    what classes do to each other is left out, and made up for by a factor.
    """
    m, size_b = betas.shape
    q = size_b // classes
    of = {fold: np.flatnonzero(left_out == fold) for fold in np.unique(left_out)}

    def chances(x, b):
        eta = (x @ b.reshape(-1, q).T).reshape(len(x), -1, classes)
        if classes == 1:
            return eta, np.logaddexp(0.0, eta[:, :, 0]), 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
        top = eta.max(axis=2, keepdims=True)
        e = np.exp(eta - top)
        total = e.sum(axis=2, keepdims=True)
        return eta, top[:, :, 0] + np.log(total[:, :, 0]), e / total

    def partial(batches):
        acc, curved = np.zeros((m, 4 + size_b)), np.zeros((len(bent), classes, q, q))
        seen, step = False, max(1, PASS_SCORES // max(1, m * classes))
        for pdf in batches:
            seen = True
            x_ = pdf.iloc[:, 3:].to_numpy(dtype=float)
            w_, y_, k_ = (pdf[c].to_numpy(dtype=float) for c in ("w", "y", "k"))
            for i in range(0, len(x_), step):
                x, w, y, k = (v[i : i + step] for v in (x_, w_, y_, k_))
                eta, log_sum, p = chances(x, betas)
                if classes == 1:
                    hit = y[:, None]
                    loss = log_sum - hit * eta[:, :, 0]
                else:
                    hit = y[:, None] == np.arange(classes)
                    loss = log_sum - (eta * hit[:, None, :]).sum(axis=2)
                loss *= w[:, None]
                r = (hit[:, None, :] - p) * w[:, None, None]
                for fold, own in of.items():
                    train = k != fold
                    acc[own, 0] += loss[train][:, own].sum(axis=0)
                    acc[own, 1] += loss[~train][:, own].sum(axis=0)
                    acc[own, 2] += w[train].sum()
                    acc[own, 3] += w[~train].sum()
                    g = r[train][:, own].reshape(-1, len(own) * classes).T @ x[train]
                    acc[own, 4:] += g.reshape(len(own), size_b)
                for at, model in enumerate(bent):
                    tw = w * (k != left_out[model])
                    for c in range(classes):
                        v = tw * p[:, model, c] * (1 - p[:, model, c])
                        curved[at, c] += (x * v[:, None]).T @ x
        if seen:
            yield pd.DataFrame({
                "m": [*range(m), *(m + i for i in range(len(bent)))],
                "v": [*acc, *(c.ravel() for c in curved)]})

    sums = df.mapInPandas(partial, "m int, v array<double>")
    got = sums.groupBy("m").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    found, curved = {}, {}
    for r in got:
        v = r["v"].toArray()
        if r["m"] < m:
            found[r["m"]] = {"loss": v[0], "held_loss": v[1], "w": v[2], "held_w": v[3], "grad": v[4:]}
        else:
            curved[bent[r["m"] - m]] = v.reshape(classes, q, q)
    return found, curved


def penalty_path(
    df: DataFrame, q: int, models: Sequence[tuple[int, float, float]], classes: int = 1,
    passes: int = 100, tol: float = 1e-9, end: Callable[[np.ndarray], int] | None = None,
) -> tuple[np.ndarray, dict[int, tuple[float, float]], list[bool], np.ndarray]:
    """Fit penalised logistic (or softmax) models ``(left out fold, l1, l2)`` together.

    As ``logistic_path``, but a pass sums gradients only, and the curvature of a few models of
    each fold: each model steps by that of the nearest one on its path, and halves steps
    that do not lower its loss.  Memory follows models x columns and a few columns x columns.

    With ``end``, the models are paths of equal lengths, the first that of all rows; ``end``
    gives the length a path of so many first losses should have, and what is beyond it is given up.

    Returns coefficients, mean loss and weight of the rows left out, which models converged,
    and the mean training losses.
    """
    m, size_b = len(models), q * classes
    left_out = np.array([k for k, _, _ in models])
    betas, steps = np.zeros((m, size_b)), np.zeros((m, size_b))
    size, best, plain = np.ones(m), np.full(m, np.inf), np.full(m, np.nan)
    # a step is carried on by a part of what the last one moved; see the rejection below
    sober, goals, age = np.zeros((m, size_b)), np.zeros((m, size_b)), np.zeros(m, int)
    carried = np.zeros(m, bool)
    held: dict[int, tuple[float, float]] = {}
    done = np.zeros(m, bool)
    first = np.arange(size_b) % q == 0
    wider = classes / (classes - 1) if classes > 1 else 1.0
    together = max(1, PASS_COEFFICIENTS // size_b)
    length = int((left_out == left_out[0]).sum())
    given_up = np.zeros(m, bool)
    for _ in range(passes):
        if end is not None:
            ready = length if done[:length].all() else int(done[:length].argmin())
            if (stop := end(plain[:ready])) < ready:
                given_up |= np.arange(m) % length >= stop
        live = np.flatnonzero(~done & ~given_up)
        if not len(live):
            break
        for start in range(0, len(live), together):
            part = live[start : start + together]
            trial = betas[part] + size[part, None] * steps[part]
            bent = []  # places in ``part`` that cover each fold's path evenly
            for k in np.unique(left_out[part]):
                own = np.flatnonzero(left_out[part] == k)
                bent += sorted({int(own[i]) for i in np.linspace(
                    0, len(own) - 1, min(CURVATURES, len(own))).round().astype(int)})
            sums, curved = path_sums(df, trial, left_out[part], classes, bent)
            if not sums:
                raise ValueError("no rows")
            for at, i in enumerate(part):
                s = sums[at]
                if s["w"] <= 0:
                    raise ValueError("no training rows")
                _, a, b2 = models[i]
                l1, l2 = np.where(first, 0.0, a), np.where(first, 0.0, b2)
                t = trial[at]
                value = s["loss"] / s["w"] + (l1 * np.abs(t)).sum() + 0.5 * (l2 * t * t).sum()
                if not np.isfinite(value) or value > best[i] + 1e-12 * abs(best[i]):
                    if carried[i]:
                        steps[i], carried[i], age[i] = sober[i], False, 0
                    else:
                        size[i] *= 0.5
                        done[i] = size[i] < 1e-6
                    continue
                gain = best[i] - value
                betas[i], best[i], size[i] = t, value, 1.0
                plain[i] = s["loss"] / s["w"]
                w = s["held_w"]
                held[i] = (s["held_loss"] / w, w) if w > 0 else (0.0, 0.0)
                near_one = min((b for b in bent if left_out[part[b]] == left_out[i]),
                               key=lambda b: abs(b - at))
                blocks = curved[near_one] * wider / s["w"]
                g, step, worst = s["grad"] / s["w"], np.zeros(size_b), 0.0
                for c in range(classes):
                    own = slice(c * q, (c + 1) * q)
                    h = blocks[c]  # columns without spread have no curvature and rest
                    goal = penalised_quadratic(h, g[own] + h @ t[own], t[own], l1[own], l2[own])
                    step[own] = goal - t[own]
                    worst = max(worst, float(np.max(step[own] ** 2 * np.diag(h))))
                onward = max(age[i] - 1, 0) / (age[i] + 2) * (t + step - goals[i])
                carried[i] = bool(onward.any())
                sober[i], goals[i], steps[i], age[i] = step, t + step, step + onward, age[i] + 1
                if np.sqrt(worst) < np.sqrt(tol) or (gain < 1e-14 and not carried[i]):
                    done[i] = True
                    betas[i] = t + step
    return betas, held, (done & ~given_up).tolist(), plain
