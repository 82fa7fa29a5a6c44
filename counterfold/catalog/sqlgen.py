"""Plain SQL for estimates on saturated nuisances, row by row.

Written apart from the engine: it joins cell means back to the rows and never
compresses, so that the two can be held against each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

EDGE = 1e-6


@dataclass(frozen=True)
class Ask:
    """Signed settings of the treatments; levels are SQL literals."""

    terms: tuple[tuple[int, tuple[str, ...]], ...]


def cm(*levels: str) -> Ask:
    return Ask(((1, levels),))


def ate(case: Sequence[str], control: Sequence[str]) -> Ask:
    return Ask(((1, tuple(case)), (-1, tuple(control))))


def aie(case: Sequence[str], control: Sequence[str]) -> Ask:
    out = []
    k = len(case)
    for bits in range(2**k - 1, -1, -1):
        picks = [(bits >> (k - 1 - i)) & 1 for i in range(k)]
        setting = tuple(c if p else o for p, c, o in zip(picks, case, control))
        out.append(((-1) ** (k - sum(picks)), setting))
    return Ask(tuple(out))


@dataclass(frozen=True)
class Study:
    """``base``: SQL of the rows; ``q_on`` cells of the outcome mean; ``g_on`` cells of
    each treatment; ``fold``: SQL of a fold number for cross-fitting."""

    base: str
    y: str
    treatments: tuple[str, ...]
    q_on: tuple[str, ...]
    g_on: tuple[tuple[str, ...], ...]
    ask: Ask
    lower: float = 1e-8
    fold: str | None = None
    keep: tuple[str, ...] = field(default=())
    g_base: str | None = None  # other rows to learn the propensities from

    iterates = False

    def _mean_join(self, name, on: Sequence[str], picks, source="b") -> tuple[str, str]:
        """(CTE, join) of cell means, from the other folds when there are folds."""
        cells = ", ".join(on)
        if self.fold is None:
            group = f" GROUP BY {cells}" if on else ""
            body = f"SELECT {', '.join([*on, *picks])} FROM {source}{group}"
            join = f"JOIN {name} USING ({cells})" if on else f"CROSS JOIN {name}"
            return f"{name} AS ({body})", join
        keys = ", ".join(["k.f AS f", *on])
        group = ", ".join(["k.f", *on])
        body = (
            f"SELECT {', '.join([keys, *picks])} FROM (SELECT DISTINCT f FROM b) k "
            f"JOIN b ON b.f <> k.f GROUP BY {group}"
        )
        return f"{name} AS ({body})", f"JOIN {name} USING ({', '.join(['f', *on])})"

    def rows(self) -> str:
        """CTEs up to ``j``: y, hits, outcome means q and bounded propensities g."""
        terms = self.ask.terms
        tests = [
            " AND ".join(f"{t} = {v}" for t, v in zip(self.treatments, s)) for _, s in terms
        ]
        fold = f", {self.fold} AS f" if self.fold else ""
        base = f"b AS (SELECT *, CAST({self.y} AS DOUBLE) AS yy{fold} FROM ({self.base}) x)"
        q_cte, q_join = self._mean_join(
            "qt", self.q_on, [f"avg(yy) FILTER (WHERE {t}) AS q{i}" for i, t in enumerate(tests)]
        )
        ctes, joins = [base, q_cte], [q_join]
        for k, (t, on) in enumerate(zip(self.treatments, self.g_on)):
            picks = [
                f"avg(CASE WHEN {t} = {s[k]} THEN 1.0 ELSE 0.0 END) AS g{k}_{i}"
                for i, (_, s) in enumerate(terms)
            ]
            source = f"({self.g_base}) gb" if self.g_base else "b"
            cte, join = self._mean_join(f"gt{k}", on, picks, source)
            ctes.append(cte)
            joins.append(join)
        gs = [
            " * ".join(f"g{k}_{i}" for k in range(len(self.treatments))) for i in range(len(terms))
        ]
        columns = ["yy"] + list(self.keep)
        for i, t in enumerate(tests):
            columns += [f"({t}) AS h{i}", f"q{i}", f"greatest({gs[i]}, {self.lower!r}) AS g{i}",
                        f"({gs[i]} < {self.lower!r}) AS c{i}"]
        ctes.append(f"j AS (SELECT {', '.join(columns)} FROM b {' '.join(joins)})")
        return ",\n".join(ctes)

    def _case(self, values: Sequence[str]) -> str:
        whens = " ".join(f"WHEN h{i} THEN {v}" for i, v in enumerate(values))
        return f"CASE {whens} ELSE 0.0 END"

    def moments(self) -> str:
        """CTE ``m``: plug-in d, clever covariate hh, observed prediction qq, weight ww and
        sign cc."""
        signs = [s for s, _ in self.ask.terms]
        d = " + ".join(f"({s}) * q{i}" for i, s in enumerate(signs))
        return f"""m AS (SELECT *, {d} AS d,
  {self._case([f"({s}) / g{i}" for i, s in enumerate(signs)])} AS hh,
  {self._case([f"q{i}" for i in range(len(signs))])} AS qq,
  {self._case([f"1.0 / g{i}" for i in range(len(signs))])} AS ww,
  {self._case([f"({float(s)})" for s in signs])} AS cc,
  {' OR '.join(f"c{i}" for i in range(len(signs)))} AS clip FROM j)"""

    def influence(self, kind: str, binary: bool = False) -> str:
        """CTEs up to ``ic``: u = influence value plus estimate, t = targeted plug-in."""
        signs = [s for s, _ in self.ask.terms]
        head = f"{self.rows()},\n{self.moments()}"
        if kind == "ose":
            return f"{head},\nic AS (SELECT *, d AS t, d + hh * (yy - qq) AS u FROM m)"
        weighted = kind == "wtmle"
        x, w = ("cc", "ww") if weighted else ("hh", "1.0")
        shifts = [f"({s})" if weighted else f"({s}) / g{i}" for i, s in enumerate(signs)]
        if not binary:
            eps = (
                f"e AS (SELECT sum({w} * {x} * (yy - qq)) / sum({w} * {x} * {x}) AS eps FROM m)"
            )
            moved = [f"(q{i} + eps * {h})" for i, h in enumerate(shifts)]
            fitted = f"(qq + eps * {x})"
        else:
            # Newton steps on one coefficient with the offset logit(q).
            eps = f"""s AS (SELECT {x} AS x, {w} AS w, {self._logit('qq')} AS o, sum(yy) AS sy,
    CAST(count(*) AS DOUBLE) AS n FROM m WHERE {x} <> 0 GROUP BY ALL),
steps(i, eps) AS (SELECT 0, 0.0::DOUBLE UNION ALL
  SELECT i + 1, eps + sum(w * x * (sy - n * p)) / sum(w * x * x * n * p * (1 - p))
  FROM (SELECT i, eps, w, x, sy, n, 1 / (1 + exp(-(o + eps * x))) AS p
        FROM steps, s WHERE i < 12) GROUP BY i, eps),
e AS (SELECT eps FROM steps WHERE i = 12)"""
            moved = [
                f"(1 / (1 + exp(-({self._logit(f'q{i}')} + eps * {h}))))"
                for i, h in enumerate(shifts)
            ]
            fitted = f"(1 / (1 + exp(-({self._logit('qq')} + eps * {x}))))"
        t = " + ".join(f"({s}) * {q}" for s, q in zip(signs, moved))
        return (
            f"{head},\n{eps},\nic AS (SELECT *, {t} AS t, "
            f"{t} + hh * (yy - {fitted}) AS u FROM m CROSS JOIN e)"
        )

    @staticmethod
    def _logit(q: str) -> str:
        p = f"least(greatest({q}, {EDGE}), {1 - EDGE})"
        return f"ln({p} / (1 - {p}))"

    def select(self, kind: str, name: str, binary: bool = False, digits=(4, 4)) -> str:
        """One row: estimator, estimate, std, se, n, clipped."""
        steps = self.iterates or (binary and kind != "ose")
        recursive = "RECURSIVE " if steps else ""
        value = "avg(t)" if kind != "ose" else "avg(u)"
        a, b = digits
        return f"""(WITH {recursive}{self.influence(kind, binary)}
SELECT '{name}' AS estimator, round({value}, {a}) + 0.0 AS estimate, round(stddev_samp(u), {b}) AS std,
       round(stddev_samp(u) / sqrt(count(*)), {b}) AS se, count(*) AS n,
       CAST(sum(CASE WHEN clip THEN 1 ELSE 0 END) AS BIGINT) AS clipped FROM ic)"""


@dataclass(frozen=True)
class LineStudy(Study):
    """One two-level treatment and one number ``x``: a line per treatment level for the
    outcome, logistic regression by Newton steps for the treatment."""

    x: str = ""
    iterates = True

    def rows(self) -> str:
        t = self.treatments[0]
        bound = f"{self.lower!r}"
        return f"""b AS (SELECT CAST({self.y} AS DOUBLE) AS yy, {t} AS t, {self.x} AS x FROM ({self.base}) r),
lines AS (SELECT t, covar_pop(x, yy) / var_pop(x) AS sl,
                 avg(yy) - covar_pop(x, yy) / var_pop(x) * avg(x) AS ic FROM b GROUP BY t),
newton(i, b0, b1) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
  SELECT i + 1, b0 + (g0 * h11 - g1 * h01) / (h00 * h11 - h01 * h01),
         b1 + (g1 * h00 - g0 * h01) / (h00 * h11 - h01 * h01)
  FROM (SELECT i, b0, b1, sum(r) AS g0, sum(x * r) AS g1, sum(w) AS h00, sum(x * w) AS h01,
               sum(x * x * w) AS h11
        FROM (SELECT i, b0, b1, x, CASE WHEN t THEN 1 ELSE 0 END - p AS r, p * (1 - p) AS w
              FROM (SELECT i, b0, b1, x, t, 1 / (1 + exp(-(b0 + b1 * x))) AS p
                    FROM newton, b WHERE i < 10))
        GROUP BY i, b0, b1)),
g AS (SELECT yy, t, x, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM b, newton WHERE i = 10),
j AS (SELECT yy, g.t AS h0, NOT g.t AS h1, u.ic + u.sl * x AS q0, v.ic + v.sl * x AS q1,
             greatest(p, {bound}) AS g0, greatest(1 - p, {bound}) AS g1,
             p < {bound} AS c0, 1 - p < {bound} AS c1
      FROM g, (SELECT * FROM lines WHERE t) u, (SELECT * FROM lines WHERE NOT t) v)"""


def union(selects: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM {s}" for s in selects)
