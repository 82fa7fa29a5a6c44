"""Gradient boosted trees over shared histograms.

All models of a call grow together: the folds of a cross-fit, the points of a grid, the members
of a stack are *jobs* that differ in their settings and in the rows they must not see.

* Features are binned once, at their distinct values or at quantiles.  Rows with equal bins and
  folds become one weighted cell, which is exact: gradients only need counts and sums.
* A level of the trees of every job is one pass: each task sums the gradients of its cells by
  (job, node, feature, bin), Spark adds them up and picks the best split of each node.
* If the cells are counted as few, each job is a task of its own over a copy of them.
  Gradients are rounded to whole units small enough that sums of any order are exact, so both ways
  give the same trees.

Squared loss for numbers, log-loss for two classes, softmax for more (a tree per class and round).
A leaf is worth ``-G / (H + penalty)`` times the step size; a split must gain and leave a weight of
``least_weight`` on both sides.  A null feature is beyond the last bin.
"""

from __future__ import annotations

import io
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfold.functions.scalar import quoted
from counterfold.session import cut_lineage

#: Cells that may be sent to every executor, one job a task; more are worked on where they lie.
FEW_CELLS = 200_000
#: Rounds between two cuts of the lineage of the margins.
CUT_EVERY = 8
EXACT = 2.0**52


@dataclass(frozen=True)
class Job:
    """One ensemble.  ``hidden``: (fold column, number) pairs whose rows it does not see; the
    rows of the last pair that no other pair hides are those it is judged on."""

    rounds: int = 100
    max_depth: int = 6
    eta: float = 0.3
    penalty: float = 1.0
    least_weight: float = 1.0
    hidden: tuple[tuple[str, int], ...] = ()

    def trains_on(self, folds: dict[str, np.ndarray], n: int) -> np.ndarray:
        ok = np.ones(n, bool)
        for name, number in self.hidden:
            ok &= folds[name] != number
        return ok

    def judged_on(self, folds: dict[str, np.ndarray], n: int) -> np.ndarray:
        if not self.hidden:
            return np.zeros(n, bool)
        *outer, (name, number) = self.hidden
        ok = folds[name] == number
        for other, k in outer:
            ok &= folds[other] != k
        return ok


@dataclass
class Ensemble:
    """Trees as heaps: children of node i are 2i + 1 and 2i + 2; feature -1 is a leaf."""

    base: np.ndarray  # a start value per class
    feature: np.ndarray  # round, class, node
    cut: np.ndarray  # bins up to it go left
    value: np.ndarray

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, base=self.base, feature=self.feature, cut=self.cut, value=self.value)
        return out.getvalue()

    @staticmethod
    def unpacked(data: bytes) -> Ensemble:
        return Ensemble(**np.load(io.BytesIO(data)))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """Sums of leaf values per row and class."""
        out = np.tile(self.base, (len(bins), 1))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            for k in range(len(self.base)):
                out[:, k] += value[k][_walk(bins, feature[k], cut[k])]
        return out


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The node where each row stops."""
    at = np.zeros(len(bins), np.int64)
    live = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
    while len(live):
        node = at[live]
        right = bins[live, feature[node]] > cut[node]
        at[live] = node = 2 * node + 1 + right
        live = live[feature[node] >= 0]
    return at


@dataclass
class Cells:
    """Weighted rows: bins, weight, sum of the target (a column per class), folds."""

    bins: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    folds: dict[str, np.ndarray]


@dataclass(frozen=True)
class Task:
    """What all jobs share."""

    loss: str  # squared | logistic | softmax
    classes: int
    widths: tuple[int, ...]  # bins of each feature
    unit_g: float
    unit_h: float

    @property
    def width(self) -> int:
        return max(self.widths, default=1)

    def chances(self, margins: np.ndarray) -> np.ndarray:
        if self.loss == "squared":
            return margins
        if self.loss == "logistic":
            return 1.0 / (1.0 + np.exp(-np.clip(margins, -700, 700)))
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, cells: Cells, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole units of the first and second derivative, a column per class."""
        p = self.chances(margins)
        n = cells.n[:, None]
        if self.loss == "squared":
            h = np.broadcast_to(n, p.shape)
        else:
            h = n * p * (1 - p) * (2.0 if self.loss == "softmax" else 1.0)
        return np.rint((n * p - cells.sums) * self.unit_g), np.rint(h * self.unit_h)

    def loss_sum(self, cells: Cells, margins: np.ndarray, rows: np.ndarray) -> tuple[float, float]:
        """Sum of losses (but for a part no model changes) and of weights."""
        p, s, n = self.chances(margins[rows]), cells.sums[rows], cells.n[rows]
        if self.loss == "squared":
            return float((n * p[:, 0] ** 2 - 2 * p[:, 0] * s[:, 0]).sum()), float(n.sum())
        if self.loss == "logistic":
            p, s = np.stack([1 - p[:, 0], p[:, 0]], 1), np.stack([n - s[:, 0], s[:, 0]], 1)
        return float(-(s * np.log(np.clip(p, 1e-15, 1))).sum()), float(n.sum())

    def histogram(self, bins, at, first: int, nodes: int, g, h) -> np.ndarray:
        """Units by node (from ``first``), feature and bin; rows elsewhere are left out."""
        p, w = len(self.widths), self.width
        rows = np.flatnonzero((at >= first) & (at < first + nodes))
        out = np.zeros((2, nodes * p * w))
        for f in range(p):
            key = ((at[rows] - first) * p + f) * w + bins[rows, f]
            out[0] += np.bincount(key, g[rows], nodes * p * w)
            out[1] += np.bincount(key, h[rows], nodes * p * w)
        return out.reshape(2, nodes, p, w)

    def best_split(self, histogram: np.ndarray, job: Job):
        """``feature, cut, GL, HL, GR, HR`` of a node's best split, or None.

        Of equal gains the first feature and bin win."""
        g = np.cumsum(histogram[0], axis=1) / self.unit_g
        h = np.cumsum(histogram[1], axis=1) / self.unit_h
        gl, hl = g[:, :-1], h[:, :-1]
        gr, hr = g[:, -1:] - gl, h[:, -1:] - hl
        ok = (hl >= job.least_weight) & (hr >= job.least_weight) & (hl > 0) & (hr > 0)
        if not ok.any():
            return None
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (gl**2 / (hl + job.penalty) + gr**2 / (hr + job.penalty)
                    - g[:, -1:] ** 2 / (h[:, -1:] + job.penalty))
        gain = np.where(ok, gain, -np.inf)
        f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
        scale = g[f, -1] ** 2 / (h[f, -1] + job.penalty) if h[f, -1] + job.penalty > 0 else 0.0
        if not gain[f, cut] > 1e-12 * abs(scale):
            return None
        return int(f), int(cut), gl[f, cut], hl[f, cut], gr[f, cut], hr[f, cut]


class Growing:
    """The trees of one job, grown level by level from the splits found."""

    def __init__(self, job: Job, base: np.ndarray):
        self.job, k = job, len(base)
        nodes = (1 << (job.max_depth + 1)) - 1
        shape = (job.rounds, k, nodes)
        self.made = Ensemble(
            base, np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape))

    def leaf(self, g: float, h: float) -> float:
        below = h + self.job.penalty
        return -self.job.eta * g / below if below > 0 else 0.0

    def tree(self, t: int, k: int):
        return self.made.feature[t, k], self.made.cut[t, k], self.made.value[t, k]

    def put(self, t: int, k: int, node: int, split) -> None:
        feature, cut, value = self.tree(t, k)
        f, c, gl, hl, gr, hr = split
        feature[node], cut[node] = f, c
        value[2 * node + 1], value[2 * node + 2] = self.leaf(gl, hl), self.leaf(gr, hr)


def _level(task: Task, job: Job, tree, bins, g, h, depth: int):
    """Histograms of the nodes of a level that rows have reached."""
    feature, cut, _ = tree
    at = _walk(bins, feature, cut)
    first = (1 << depth) - 1
    return task.histogram(bins, at, first, 1 << depth, g, h), np.unique(
        at[(at >= first) & (at < 2 * first + 1)])


def grow_alone(task: Task, cells: Cells, job: Job, base: np.ndarray) -> tuple[Ensemble, float, float]:
    """One job over all cells."""
    rows = np.flatnonzero(job.trains_on(cells.folds, len(cells.n)))
    own = Cells(cells.bins[rows], cells.n[rows], cells.sums[rows], {})
    growing = Growing(job, base)
    margins = np.tile(base, (len(cells.n), 1))
    for t in range(job.rounds):
        g, h = task.gradients(own, margins[rows])
        steps = []
        for k in range(task.classes):
            tree = growing.tree(t, k)
            for depth in range(job.max_depth if task.widths else 0):
                found, nodes = _level(task, job, tree, own.bins, g[:, k], h[:, k], depth)
                first, grew = (1 << depth) - 1, False
                for node in nodes.tolist():
                    split = task.best_split(found[:, node - first], job)
                    if split is not None:
                        growing.put(t, k, node, split)
                        grew = True
                if not grew:
                    break
            if tree[0][0] < 0:
                tree[2][0] = growing.leaf(g[:, k].sum() / task.unit_g, h[:, k].sum() / task.unit_h)
            steps.append(tree[2][_walk(cells.bins, tree[0], tree[1])])
        margins += np.stack(steps, 1)
    judged = np.flatnonzero(job.judged_on(cells.folds, len(cells.n)))
    return growing.made, *task.loss_sum(cells, margins, judged)


# --- cells of a table ---------------------------------------------------------------------------


def feature_cuts(df: DataFrame, columns: Sequence[Column], max_bins: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last: distinct values, or quantiles if there are more."""
    if not columns:
        return []
    names = [f"f{i}" for i in range(len(columns))]
    rows = df.select(*[c.cast("double").alias(n) for c, n in zip(columns, names)])
    at = [i / max_bins for i in range(1, max_bins)]
    found = rows.agg(
        *[F.percentile_approx(n, at, 10_000).alias(n) for n in names],
        *[F.approx_count_distinct(n).alias(f"d_{n}") for n in names]).first()
    few = [n for n in names if found[f"d_{n}"] <= 2 * max_bins]
    values: dict[str, list[float]] = {n: [] for n in few}
    if few:  # a bounded number of rows: about two bins' worth of values a feature
        pairs = rows.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in few])).alias("e"))
        for r in pairs.select("e.name", "e.value").where("value IS NOT NULL").distinct().collect():
            values[r.name].append(r.value)
    cuts = []
    for n in names:
        own = sorted(values.get(n, []))
        if n not in few or len(own) > max_bins:
            own = sorted({float(v) for v in found[n] or []})
            cuts.append(np.array(own))
        else:
            cuts.append(np.array(own[:-1], float))
    return cuts


def to_bins(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray], n: int) -> np.ndarray:
    """The bin of each value: how many cuts are below it; not-a-number is the last."""
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.uint16
    out = np.zeros((n, len(cuts)), kind)
    for f, (x, c) in enumerate(zip(columns, cuts)):
        out[:, f] = np.searchsorted(c, np.asarray(x, float), "left")
    return out


def _binned(cuts, classes: int, folds: Sequence[str]):
    p = len(cuts)

    def rows(batches):
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(p)]
            bins = to_bins(columns, cuts, batch.num_rows)
            size = bins.dtype.itemsize * p
            key = [bins[i].tobytes() for i in range(batch.num_rows)] if size else [b""] * batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.binary()), *batch.columns[p:]],
                ["key", *folds, "n", *[f"s{k}" for k in range(classes)]])

    return rows


def make_cells(
    df: DataFrame, columns: Sequence[Column], targets: Sequence[Column], weight: Column,
    folds: Sequence[str], cuts: list[np.ndarray],
) -> DataFrame:
    """``key, folds, n, s0, …``: weights and target sums of rows with equal bins and folds."""
    names = [f"__fold{i}" for i in range(len(folds))]
    sums = [(y.cast("double") * weight).alias(f"s{k}") for k, y in enumerate(targets)]
    rows = df.select(
        *[c.cast("double").alias(f"__x{i}") for i, c in enumerate(columns)],
        *[quoted(f).cast("int").alias(n) for f, n in zip(folds, names)],
        weight.cast("double").alias("n"), *sums)
    schema = ", ".join(["key binary", *[f"{n} int" for n in names], "n double",
                        *[f"s{k} double" for k in range(len(targets))]])
    return rows.mapInArrow(_binned(cuts, len(targets), names), schema).groupBy(
        "key", *names).agg(F.sum("n").alias("n"), *[
            F.sum(f"s{k}").alias(f"s{k}") for k in range(len(targets))])


def _cells_of(table, task: Task, folds: Sequence[str], kind: np.dtype) -> Cells:
    p = len(task.widths)
    column = lambda i: table.column(i).to_numpy(zero_copy_only=False) if isinstance(
        table, pa.RecordBatch) else table.column(i).to_numpy()
    bins = np.frombuffer(b"".join(table.column(0).to_pylist()), kind).reshape(table.num_rows, p)
    own = {f: column(1 + i) for i, f in enumerate(folds)}
    k = 1 + len(folds)
    sums = np.stack([column(k + 1 + c) for c in range(task.classes)], 1)
    return Cells(bins, column(k), sums, own)


# --- jobs over a table ----------------------------------------------------------------------------


def _bases(cells: DataFrame, task: Task, jobs: Sequence[Job], folds: Sequence[str]) -> list[np.ndarray]:
    """Start values of the jobs: the mean, or the log-odds of the classes, of their rows."""
    names = [f"__fold{i}" for i in range(len(folds))]
    rows = cells.groupBy(*names).agg(
        F.sum("n").alias("n"), *[F.sum(f"s{k}").alias(f"s{k}") for k in range(task.classes)]).collect()
    n = np.array([r.n for r in rows])
    sums = np.array([[r[f"s{k}"] for k in range(task.classes)] for r in rows])
    own = {f: np.array([r[m] for r in rows]) for f, m in zip(folds, names)}
    out = []
    for job in jobs:
        ok = job.trains_on(own, len(rows))
        total = n[ok].sum()
        if not total > 0:
            raise ValueError("no rows to learn from")
        mean = sums[ok].sum(axis=0) / total
        if task.loss == "logistic":
            p = np.clip(mean, 1e-6, 1 - 1e-6)
            mean = np.log(p / (1 - p))
        elif task.loss == "softmax":
            mean = np.log(np.clip(mean, 1e-6, 1))
        out.append(mean)
    return out


def _side_by_side(cells: DataFrame, task: Task, jobs, bases, folds, kind, keep: bool):
    """A task per job, each with all cells (at most FEW_CELLS)."""
    spark = cells.sparkSession
    held = _cells_of(cells.toArrow().combine_chunks(), task, folds, kind)
    shared = spark.sparkContext.broadcast(held)

    def rows(batches):
        for batch in batches:
            for j in batch.column(0).to_pylist():
                made, loss, weight = grow_alone(task, shared.value, jobs[j], bases[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j], pa.int64()), pa.array([made.packed() if keep else None], pa.binary()),
                     pa.array([loss]), pa.array([weight])], ["job", "made", "loss", "weight"])

    # the longest jobs first, each a task
    order = sorted(range(len(jobs)), key=lambda j: -jobs[j].rounds * (1 << jobs[j].max_depth))
    ids = spark.createDataFrame([(j,) for j in order], "job long").repartitionByRange(len(jobs), "job")
    found = ids.mapInArrow(rows, "job long, made binary, loss double, weight double").collect()
    shared.destroy()
    out: list = [None] * len(jobs)
    for r in found:
        out[r.job] = (Ensemble.unpacked(r.made) if keep else None, r.loss, r.weight)
    return out


@dataclass
class _Lockstep:
    """All jobs over cells that stay where they are."""

    cells: DataFrame
    task: Task
    jobs: Sequence[Job]
    bases: list[np.ndarray]
    folds: Sequence[str]
    kind: np.dtype
    growing: list[Growing] = field(default_factory=list)

    def __post_init__(self):
        self.growing = [Growing(j, b) for j, b in zip(self.jobs, self.bases)]
        self.schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.cells.schema)

    def _reader(self):
        """A function that gives the cells of a batch and their margins by job and class."""
        task, folds, kind, jobs = self.task, list(self.folds), self.kind, len(self.jobs)

        def read(batch):
            cells = _cells_of(batch, task, folds, kind)
            flat = np.frombuffer(b"".join(batch.column(batch.num_columns - 1).to_pylist()))
            return cells, flat.reshape(len(cells.n), jobs, task.classes)

        return read

    def start(self) -> DataFrame:
        first = np.stack(self.bases).astype(float).tobytes()
        return self.cells.withColumn("margins", F.lit(bytearray(first)))

    def level(self, state: DataFrame, t: int, depth: int) -> bool:
        """One pass: the splits of all nodes of a level."""
        task, jobs, read = self.task, self.jobs, self._reader()
        live = [(j, k) for j, job in enumerate(jobs) if t < job.rounds and depth < job.max_depth
                for k in range(task.classes)
                if depth == 0 or (self.growing[j].tree(t, k)[0][(1 << depth - 1) - 1 : (1 << depth) - 1] >= 0).any()]
        if not live or not task.widths:
            return False
        trees = {(j, k): self.growing[j].tree(t, k) for j, k in live}
        first = (1 << depth) - 1

        def partial(batches):
            sums: dict[tuple, np.ndarray] = {}
            for batch in batches:
                cells, margins = read(batch)
                ready: dict[int, tuple] = {}
                for j, k in live:
                    if j not in ready:
                        rows = np.flatnonzero(jobs[j].trains_on(cells.folds, len(cells.n)))
                        own = Cells(cells.bins[rows], cells.n[rows], cells.sums[rows], {})
                        ready = {j: (own, *task.gradients(own, margins[rows, j]))}
                    own, g, h = ready[j]
                    found, nodes = _level(task, jobs[j], trees[j, k], own.bins, g[:, k], h[:, k], depth)
                    for node in nodes.tolist():
                        key = (j, k, node)
                        sums[key] = sums.get(key, 0) + found[:, node - first]
            keys = list(sums)
            for i in range(0, len(keys), 64):
                some = keys[i : i + 64]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([x[c] for x in some], pa.int32()) for c in range(3)],
                     pa.array([sums[x].astype(np.int64).tobytes() for x in some], pa.binary())],
                    ["job", "class", "node", "sums"])

        shape = (2, len(task.widths), task.width)

        def best(key: tuple, table: pa.Table) -> pa.Table:
            j, k, node = (x.as_py() for x in key)
            total = np.zeros(shape)
            for data in table.column("sums").to_pylist():
                total += np.frombuffer(data, np.int64).reshape(shape)
            split = task.best_split(total, jobs[j])
            g, h = total[0, 0].sum() / task.unit_g, total[1, 0].sum() / task.unit_h
            return pa.table({
                "job": pa.array([j], pa.int32()), "class": pa.array([k], pa.int32()),
                "node": pa.array([node], pa.int32()),
                "split": pa.array([list(map(float, split)) if split else None], pa.list_(pa.float64())),
                "g": [g], "h": [h]})

        found = (
            state.mapInArrow(partial, "job int, class int, node int, sums binary")
            .groupBy("job", "class", "node").applyInArrow(
                best, "job int, class int, node int, split array<double>, g double, h double")
            .collect()  # a row per node: bounded by the sizes of the trees
        )
        for r in found:
            growing = self.growing[r.job]
            if r.split is not None:
                f, c, *rest = r.split
                growing.put(t, r["class"], r.node, (int(f), int(c), *rest))
            elif r.node == 0:
                growing.tree(t, r["class"])[2][0] = growing.leaf(r.g, r.h)
        return any(r.split is not None for r in found)

    def roots(self, state: DataFrame, t: int) -> None:
        """Trees without features: the root alone."""
        task, jobs, read = self.task, self.jobs, self._reader()

        def partial(batches):
            for batch in batches:
                cells, margins = read(batch)
                out = []
                for j, job in enumerate(jobs):
                    rows = np.flatnonzero(job.trains_on(cells.folds, len(cells.n)))
                    own = Cells(cells.bins[rows], cells.n[rows], cells.sums[rows], {})
                    g, h = task.gradients(own, margins[rows, j])
                    out += [(j, k, g[:, k].sum(), h[:, k].sum()) for k in range(task.classes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)], ["job", "class", "g", "h"])

        sums = state.mapInArrow(partial, "job long, class long, g double, h double").groupBy(
            "job", "class").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        for r in sums.collect():
            if t < jobs[r.job].rounds:
                growing = self.growing[r.job]
                growing.tree(t, r["class"])[2][0] = growing.leaf(r.g / task.unit_g, r.h / task.unit_h)

    def moved(self, state: DataFrame, t: int) -> DataFrame:
        """Margins after the trees of a round."""
        task, read = self.task, self._reader()
        trees = {(j, k): self.growing[j].tree(t, k) for j, job in enumerate(self.jobs)
                 if t < job.rounds for k in range(task.classes)}

        def rows(batches):
            for batch in batches:
                cells, margins = read(batch)
                margins = margins.copy()
                for (j, k), (feature, cut, value) in trees.items():
                    margins[:, j, k] += value[_walk(cells.bins, feature, cut)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1],
                     pa.array([m.tobytes() for m in margins], pa.binary())], batch.schema.names)

        return state.mapInArrow(rows, self.schema + ", margins binary")

    def losses(self, state: DataFrame) -> dict[int, tuple[float, float]]:
        task, jobs, read = self.task, self.jobs, self._reader()

        def rows(batches):
            for batch in batches:
                cells, margins = read(batch)
                out = [(j, *task.loss_sum(cells, margins[:, j], np.flatnonzero(
                    job.judged_on(cells.folds, len(cells.n))))) for j, job in enumerate(jobs)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)], ["job", "loss", "weight"])

        sums = state.mapInArrow(rows, "job long, loss double, weight double").groupBy("job").agg(
            F.sum("loss").alias("loss"), F.sum("weight").alias("weight"))
        return {r.job: (r.loss, r.weight) for r in sums.collect()}

    def run(self):
        state, kept = self.start(), []
        for t in range(max(job.rounds for job in self.jobs)):
            if self.task.widths:
                for depth in range(max(job.max_depth for job in self.jobs)):
                    if not self.level(state, t, depth):
                        break
            else:
                self.roots(state, t)
            state = self.moved(state, t)
            state = cut_lineage(state) if t % CUT_EVERY == CUT_EVERY - 1 else state.persist()
            state.count()
            for old in kept:
                old.unpersist()
            kept = [state]
        losses = self.losses(state)
        for old in kept:
            old.unpersist()
        return [(g.made, *losses.get(j, (0.0, 0.0))) for j, g in enumerate(self.growing)]


def boost(
    df: DataFrame, columns: Sequence[Column], targets: Sequence[Column], weight: Column, loss: str,
    jobs: Sequence[Job], *, max_bins: int = 256, keep: bool = True, few: int | None = None,
) -> tuple[list[np.ndarray], list[tuple[Ensemble | None, float, float]]]:
    """Cuts of the features and, per job, the ensemble (if to be kept), the sum of losses on the
    rows it is judged on, and their weight.

    ``targets``: a number, or 0/1 per class.  ``few`` overrides FEW_CELLS.
    """
    folds = sorted({name for job in jobs for name, _ in job.hidden})
    cuts = feature_cuts(df, columns, max_bins)
    cells = make_cells(df, columns, targets, weight, folds, cuts).persist()
    try:
        ranges = cells.agg(
            F.count("*").alias("cells"), F.sum("n").alias("n"),
            F.min(F.col("s0") / F.col("n")).alias("low"),
            F.max(F.col("s0") / F.col("n")).alias("high")).first()
        if not ranges.n:
            raise ValueError("no rows to learn from")
        reach = (4 * (ranges.high - ranges.low) or 1.0) if loss == "squared" else 1.0
        unit = lambda most: 2.0 ** np.floor(np.log2(EXACT / most))
        task = Task(loss, len(targets), tuple(len(c) + 1 for c in cuts),
                    unit(ranges.n * reach), unit(ranges.n))
        kind = to_bins([np.zeros(0)] * len(cuts), cuts, 0).dtype
        bases = _bases(cells, task, jobs, folds)
        if ranges.cells <= (FEW_CELLS if few is None else few):
            return cuts, _side_by_side(cells, task, jobs, bases, folds, kind, keep)
        return cuts, _Lockstep(cells, task, jobs, bases, folds, kind).run()
    finally:
        cells.unpersist()
