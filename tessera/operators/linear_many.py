"""Many logistic regressions over the same rows, solved together (ML1 in TU1, TU3, TU6, TU7).

A search fits one model for every draw and training part.  Here all of them
advance together: one pass over the rows gives the loss, gradient and Hessian
of every unsolved problem (numpy matrix products over row blocks, rows masked
by fold, sums combined per problem by Spark), and the driver takes a Newton step
for each, proximal for an L1 penalty (feature-sign search).  The number of passes is that of the
slowest problem, whatever the number of draws; what reaches the driver is
``problems × features²`` numbers.

The objective is Spark ML's: mean weighted log loss plus ``1 / (C · n)`` times
half the squared (or the absolute) coefficients, intercept free.  Reductions
(PCA, LDA, RFE) are linear maps of the prepared features, so they only change
the coefficients' coordinates on the driver; all problems share the passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

BLOCK_ROWS = 2_048
MAX_PASSES = 1_000   # as the configured iterations of the learner; Newton steps end far earlier
LEAST_GAIN = 1e-13   # of the mean loss that a further step promises
HINGE_GAIN = 1e-7    # the same for a hinge loss, whose corner is rounded
ROUNDING = 1e-10     # a promise below it that does not show is rounding
TOLERANCE = 1e-9     # of the optimality conditions, per unit of mean loss
EXACT = 1e-12        # of the optimality conditions of one proximal step
MOVES = 20           # per feature, the most moves of one proximal step
WIDTHS = (2.0, 0.5, 0.125, 0.03, 0.008, 0.002)  # a hinge's corner is rounded less and less


@dataclass
class Part:
    """A training part: the folds left out, the one of them that it scores, and the
    preparation fitted on it, per feature the value for NULL, centre and scale."""
    without: tuple
    scored: str | None
    fill: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def prepare(self, x: np.ndarray) -> np.ndarray:
        return (np.where(np.isnan(x), self.fill, x) - self.centre) / self.scale

    def rows(self, fold: tuple) -> np.ndarray:
        """Which rows of a block train: those of no fold left out."""
        names, codes = fold
        return np.array([n not in self.without for n in names], bool)[codes]

    def held(self, fold: tuple) -> np.ndarray:
        names, codes = fold
        return np.array([n == self.scored for n in names], bool)[codes]


@dataclass
class Problem:
    """One regression: its part (an index), penalty, class weights, and the map from
    reduced to prepared features (``features × k``)."""
    part: int
    c: float
    l1: bool
    weight0: float
    weight1: float
    basis: np.ndarray
    n: float = 0.0
    hinge: bool = False
    width: float = 0.0
    damping: float = 0.0
    moments: np.ndarray = field(default=None)
    beta: np.ndarray = field(default=None)
    intercept: float = 0.0
    solved: bool = False

    def theta(self) -> np.ndarray:
        """Coefficients of the prepared features, the intercept last."""
        return np.append(self.basis @ self.beta, self.intercept)


def rows_table(df: DataFrame, features: Sequence[str], label: str, fold: str, key: Sequence[str]) -> DataFrame:
    """Written table ``fold, y, x`` (features as they are, NULL kept) and the struct
    ``key``; rows without a label are left out."""
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    return materialize(df.where(F.col(f"`{label}`").isNotNull()).select(
        F.col(f"`{fold}`").cast("string").alias("fold"), F.col(f"`{label}`").cast("double").alias("y"), x.alias("x"),
        F.struct(*[F.col(f"`{k}`") for k in key]).alias("key")))


def _blocks(batches, d: int):
    """Slices of Arrow batches with fold (names, code of each row), y and x as numpy;
    NULL features are NaN."""
    for b in batches:
        for i in range(0, b.num_rows, BLOCK_ROWS):
            s = b.slice(i, BLOCK_ROWS)
            x = s.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            fold = s.column("fold").fill_null("").dictionary_encode()
            yield s, (fold.dictionary.to_pylist(), fold.indices.to_numpy(zero_copy_only=False)), \
                s.column("y").to_numpy(zero_copy_only=False), x


class HeldRows:
    """Rows that a task holds, for problems solved inside it."""

    def __init__(self, y: np.ndarray, x: np.ndarray):
        self.y, self.x = y, x

    def blocks(self):
        for i in range(0, len(self.y), BLOCK_ROWS):
            y = self.y[i:i + BLOCK_ROWS]
            yield ([""], np.zeros(len(y), np.int64)), y, self.x[i:i + BLOCK_ROWS]


def _sums(table: DataFrame | HeldRows, d: int, block_sums, n_keys: int, width: int) -> np.ndarray:
    """``n_keys × width`` sums over all rows of what ``block_sums`` gives for a block:
    one partial table a task, added up per key."""
    if isinstance(table, HeldRows):
        total = np.zeros((n_keys, width))
        for fold, y, x in table.blocks():
            block_sums(total, fold, y, x)
        return total

    def run(batches):
        total = np.zeros((n_keys, width))
        for _, fold, y, x in _blocks(batches, d):
            block_sums(total, fold, y, x)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(n_keys), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], ["k", "v"])
    got = table.select("fold", "y", "x").mapInArrow(run, "k int, v array<double>") \
        .groupBy("k").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()
    out = np.zeros((n_keys, width))
    for r in got:
        out[r["k"]] = r["v"].toArray()
    return out


def class_moments(table: DataFrame, parts: Sequence[Part], d: int) -> list[dict]:
    """Per part and class (0, 1): n, mean and centred scatter of the prepared features;
    two passes for all parts (means first, so that large ones lose no precision)."""
    def first(total, fold, y, x):
        for k, part in enumerate(parts):
            for c in (0, 1):
                z = part.prepare(x[part.rows(fold) & (y == c)])
                total[2 * k + c] += [len(z), *z.sum(axis=0)]
    sums = _sums(table, d, first, 2 * len(parts), d + 1)
    means = sums[:, 1:] / np.maximum(sums[:, :1], 1)

    def second(total, fold, y, x):
        for k, part in enumerate(parts):
            for c in (0, 1):
                z = part.prepare(x[part.rows(fold) & (y == c)]) - means[2 * k + c]
                total[2 * k + c] += (z.T @ z).ravel()
    scatter = _sums(table, d, second, 2 * len(parts), d * d)
    return [{c: {"label": c, "n": sums[2 * k + c, 0], "mean": means[2 * k + c],
                 "scatter": scatter[2 * k + c].reshape(d, d)} for c in (0, 1)} for k in range(len(parts))]


def _own_coordinates(base: Part, part: Part) -> np.ndarray:
    """The map from the features as ``base`` prepares them (and a one) to those of ``part``."""
    out = np.diag(np.append(base.scale / part.scale, 1.0))
    out[:-1, -1] = (base.centre - part.centre) / part.scale
    return out


def _logistic(m: np.ndarray):
    """Loss, minus its slope, and curvature at margins ``m`` (positive: right side)."""
    e = np.exp(-np.abs(m))
    q = 1 / (1 + e)
    return np.log(1 + e) - np.minimum(m, 0), np.where(m < 0, q, e * q), e * q * q


def _hinge(m: np.ndarray, width: np.ndarray):
    """The same of the hinge loss, its corner rounded to a parabola within ``width``."""
    short = 1 - m
    part = np.clip((short + width) / (2 * width), 0, 1)
    return np.where(short >= width, short, width * part * part), part, (np.abs(short) < width) / (2 * width)


def _derivatives(table: DataFrame, parts: Sequence[Part], live: list[tuple[Problem, np.ndarray]], d: int) -> np.ndarray:
    """Loss, gradient and upper Hessian triangle, each over n, of every live problem at
    the given coefficients.

    Preparations are affine, so rows are prepared as for the first part and their
    products made once for all parts; the driver maps the sums to each part's own
    coordinates.  Only rows with NULLs are prepared once for each different filling.
    """
    up = np.triu_indices(d + 1)
    base, maps = parts[0], [_own_coordinates(parts[0], part) for part in parts]
    owner = np.array([p.part for p, _ in live])
    theta = np.array([maps[p.part].T @ t for p, t in live])
    w0, w1, width = (np.array([getattr(p, a) for p, _ in live])[:, None] for a in ("weight0", "weight1", "width"))
    fills, fill_of = np.unique(np.array([part.fill for part in parts]), axis=0, return_inverse=True)
    fill_of = fill_of.reshape(-1)[owner]

    def add(total, ids, x, y):
        z = np.vstack([((x - base.centre) / base.scale).T, np.ones(len(x))])
        side = np.where(y == 1, 1.0, -1.0)
        products = None
        for loss_of, some in ((_logistic, ids[width[ids, 0] == 0]), (_hinge, ids[width[ids, 0] > 0])):
            if not len(some):
                continue
            if products is None:
                products = (z[up[0]] * z[up[1]]).T
            m = (theta[some] @ z) * side
            loss, slope, curve = loss_of(m) if loss_of is _logistic else loss_of(m, width[some])
            w = np.where(y == 1, w1[some], w0[some])
            total[some, 0] += (w * loss).sum(axis=1)
            total[some, 1:d + 2] -= (w * slope * side) @ z.T
            total[some, d + 2:] += (w * curve) @ products

    def sums(total, fold, y, x):
        names, codes = fold
        holes = np.isnan(x)
        hole = holes.any(axis=1)
        for j, name in enumerate(names):
            ids = np.flatnonzero(np.array([name not in part.without for part in parts])[owner])
            whole, holed = np.flatnonzero((codes == j) & ~hole), np.flatnonzero((codes == j) & hole)
            if len(ids) and len(whole):
                add(total, ids, x[whole], y[whole])
            for i, fill in enumerate(fills if len(holed) else []):
                some = ids[fill_of[ids] == i]
                if len(some):
                    add(total, some, np.where(holes[holed], fill, x[holed]), y[holed])
    out = _sums(table, d, sums, len(live), 1 + (d + 1) + len(up[0]))
    for row, (p, _) in zip(out, live):
        h = np.zeros((d + 1, d + 1))
        h[up] = row[d + 2:]
        t = maps[p.part]
        row[1:d + 2], row[d + 2:] = t @ row[1:d + 2], (t @ (h + np.triu(h, 1).T) @ t.T)[up]
    return out / np.array([p.n for p, _ in live])[:, None]


def _step(problems: list[Problem], grads: list[np.ndarray], hessians: list[np.ndarray]) -> list[np.ndarray]:
    """The (proximal) Newton step of every problem in its own coordinates, intercept last.
    That of a hinge loss is damped by the features' second moments: what bounds it is how
    far margins move."""
    steps = [None] * len(problems)
    for i, p in enumerate(problems):
        if not p.l1:
            lam = np.append(np.full(len(p.beta), 1 / (p.c * p.n)), 0.0)
            damped = hessians[i] + (p.damping * p.moments if p.hinge else 0.0)
            steps[i] = -np.linalg.lstsq(damped + np.diag(lam), grads[i] + lam * np.append(p.beta, 0), rcond=1e-14)[0]
        else:
            at = np.append(p.beta, p.intercept)
            steps[i] = _lasso(hessians[i], grads[i], at, 1 / (p.c * p.n)) - at
    return steps


def _lasso(h: np.ndarray, g: np.ndarray, at: np.ndarray, lam: float) -> np.ndarray:
    """The minimum of a quadratic model (Hessian ``h``, gradient ``g`` at ``at``) plus ``lam``
    times the absolute coefficients but the last.

    Feature-sign search: with the signs of the coefficients that are not zero
    fixed the model is smooth; the way to its minimum is followed to the best of
    the points where a sign changes.  Every move lowers the objective, so dependent
    features (where the model has no single minimum) do no harm.
    """
    x, c = at.copy(), g - h @ at
    free = len(x) - 1
    ridge = 1e-14 * max(float(np.diag(h).max()), 1e-300)
    lam = np.append(np.full(free, lam), 0.0)

    def value(points):  # of columns
        return 0.5 * (points * (h @ points)).sum(axis=0) + c @ points + lam @ np.abs(points)
    now, sign = float(value(x[:, None])[0]), np.sign(x)
    for _ in range(MOVES * len(x)):
        r = h @ x + c
        off = np.where(sign != 0, np.abs(r + lam * sign), 0.0)
        off[free] = abs(r[free])
        if off.max() <= EXACT:  # those that are not zero fit: the worst of the zeros enters
            out = np.where(sign == 0, np.abs(r) - lam, 0.0)
            out[free] = 0.0
            j = int(out.argmax())
            if out[j] <= EXACT:
                break
            sign[j] = -np.sign(r[j])
        on = np.append(np.flatnonzero(sign[:free]), free)
        a = h[np.ix_(on, on)]
        want = x[on] + np.linalg.solve(a + ridge * np.eye(len(on)), -(r[on] + lam[on] * sign[on]))
        move = want - x[on]
        with np.errstate(divide="ignore", invalid="ignore"):
            cross = np.where((x[on] != 0) & (want * x[on] <= 0), x[on] / (x[on] - want), np.inf)
        cross[-1] = np.inf
        ways = np.unique(np.append(cross[cross < 1], 1.0))
        points = np.repeat(x[:, None], len(ways), axis=1)
        points[on] += move[:, None] * ways
        for k, t in enumerate(ways):
            points[on[cross == t], k] = 0.0
        values = value(points)
        k = int(values.argmin())
        if not values[k] < now:
            break
        x, now = points[:, k], float(values[k])
        sign = np.sign(x)
    return x


def _optimal(p: Problem, g: np.ndarray) -> bool:
    lam = 1 / (p.c * p.n)
    if p.l1:
        off = np.where(p.beta != 0, np.abs(g[:-1] + lam * np.sign(p.beta)), np.maximum(np.abs(g[:-1]) - lam, 0))
    else:
        off = np.abs(g[:-1] + lam * p.beta)
    return max(float(off.max(initial=0)), abs(float(g[-1]))) <= TOLERANCE


def _objective(loss: float, p: Problem, beta: np.ndarray) -> float:
    return loss + (np.abs(beta).sum() if p.l1 else 0.5 * beta @ beta) / (p.c * p.n)


def solve(table: DataFrame | HeldRows, parts: Sequence[Part], problems: Sequence[Problem], d: int,
          max_passes: int = MAX_PASSES) -> int:
    """Solve all problems in place; returns the number of passes over the rows.

    A step that does not lower the objective is cut to a quarter (the derivatives of the
    last accepted point stay), so every pass serves each unsolved problem once.
    A problem whose objective cannot be lowered any more counts as solved.
    """
    for p in problems:
        p.beta, p.width = np.zeros(p.basis.shape[1]), WIDTHS[0] if p.hinge else 0.0
    best = {id(p): np.inf for p in problems}   # objective of the accepted point
    trial = {id(p): (p.beta, p.intercept, 1.0) for p in problems}
    step, gains, held = {}, {}, {}
    up = np.triu_indices(d + 1)

    def end(p):
        """Solved, or on from here with a sharper corner."""
        sharper = [w for w in WIDTHS if w < p.width]
        if not sharper:
            p.solved = True
        else:
            p.width, best[id(p)], trial[id(p)] = sharper[0], np.inf, (p.beta, p.intercept, 1.0)

    for n_pass in range(1, max_passes + 1):
        live = [p for p in problems if not p.solved]
        if not live:
            return n_pass - 1
        at = [(p, np.append(p.basis @ trial[id(p)][0], trial[id(p)][1])) for p in live]
        got = _derivatives(table, parts, at, d)
        accepted, grads, hessians = [], [], []
        for p, row in zip(live, got):
            beta, b, t = trial[id(p)]
            value = _objective(row[0], p, beta)
            if value < best[id(p)]:
                if p.hinge and np.isfinite(best[id(p)]):
                    kept = (best[id(p)] - value) / gains[id(p)]
                    p.damping *= 0.2 if kept > 0.75 else 4.0 if kept < 0.25 else 1.0
                best[id(p)], p.beta, p.intercept = value, beta, b
                h = np.zeros((d + 1, d + 1))
                h[up] = row[d + 2:]
                h = h + np.triu(h, 1).T
                basis = np.block([[p.basis, np.zeros((d, 1))], [np.zeros((1, p.basis.shape[1])), np.ones((1, 1))]])
                g = basis.T @ row[1:d + 2]
                if _optimal(p, g):
                    end(p)
                    continue
                accepted.append(p)
                grads.append(g)
                hessians.append(basis.T @ h @ basis)
                if p.hinge:
                    p.moments = hessians[-1] if p.moments is None else p.moments
                    held[id(p)] = g, hessians[-1]
            elif t < 1e-6 or gains[id(p)] <= ROUNDING:
                end(p)
            elif p.hinge:  # the same derivatives, a shorter step
                p.damping, t = max(10 * p.damping, 1e-3), t / 4
                accepted.append(p)
                grads.append(held[id(p)][0])
                hessians.append(held[id(p)][1])
            else:
                t /= 4
                trial[id(p)] = (p.beta + t * step[id(p)][:-1], p.intercept + t * step[id(p)][-1], t)
        if accepted:
            for p, g, s in zip(accepted, grads, _step(accepted, grads, hessians)):
                beta, b = p.beta + s[:-1], p.intercept + s[-1]
                gain = -g @ s + _objective(0.0, p, p.beta) - _objective(0.0, p, beta)
                if p.hinge:
                    gain -= 0.5 * s @ held[id(p)][1] @ s
                step[id(p)], trial[id(p)], gains[id(p)] = s, (beta, b, 1.0), gain
                if gain <= (HINGE_GAIN * (1 + 1e3 * p.width ** 2) if p.hinge else LEAST_GAIN):  # below what the loss can show: the last step, taken unseen
                    if not p.hinge:
                        p.beta, p.intercept = beta, b
                    end(p)
    return max_passes


def scores(table: DataFrame, parts: Sequence[Part], thetas: dict, d: int) -> DataFrame:
    """``draw, fold, y, key, p``: the probabilities of every draw for the rows of the
    fold that its part scores.  ``thetas``: (draw, part index) → coefficients."""
    draws = sorted({k[0] for k in thetas})
    names = ["fold", "y", "key"]

    def run(batches):
        for s, fold, y, x in _blocks(batches, d):
            for k, part in enumerate(parts):
                mine = np.flatnonzero(part.held(fold))
                if not len(mine):
                    continue
                z = np.column_stack([part.prepare(x[mine]), np.ones(len(mine))])
                kept = [s.column(c).take(pa.array(mine)) for c in names]
                for draw in draws:
                    p = 0.5 * (1 + np.tanh(0.5 * (z @ thetas[draw, k])))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), draw, np.int32)), *kept, pa.array(p)],
                                                     ["draw", *names, "p"])
    key = table.schema["key"].dataType.simpleString()
    return table.select(*names, "x").mapInArrow(run, f"draw int, fold string, y double, key {key}, p double")
