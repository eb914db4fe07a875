"""Model selection over metric tables (TU2, TU4, TU8, TU10-TU14, ME11, ME13, ME14).

The inputs are small tables (one row per model × fold, or per candidate
parameter set) that Spark derives from scored data; the operators are
ordinary sorts, windows and aggregates over them.  The one operator that
touches rows, soft voting (TU10), first reduces the rows to distinct
(label, scores) tuples with counts, then scores every weight combination of
a bounded grid, a batch of them at a time, with one grouped exact AUC.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.prefix import BUCKET, bucketize, edge_values, prefix_sums
from tessera.operators.metrics import robustness_band
from tessera.session import materialize

METRICS = ("roc_auc", "f1", "precision", "recall", "accuracy")


# ---- TU4 ---------------------------------------------------------------------------
#: Grid points of a numeric axis, as shares of the way from its low to its high end;
#: a log axis is divided on the log scale.
AXIS_SHARES = {"int": (0, 1), "float": (0, 1), "log_float": (0, 0.5, 1)}


def axis_points(spec: dict) -> list:
    """The grid points of one axis: its choices, or the shares of its range."""
    kind = spec["type"]
    if kind == "categorical":
        return list(spec["choices"])
    if kind not in AXIS_SHARES:
        raise ValueError(f"unknown axis type {kind!r}")
    low, high = spec["low"], spec["high"]
    if kind == "log_float":
        return [float(low) ** (1 - t) * float(high) ** t for t in AXIS_SHARES[kind]]
    return [low + t * (high - low) for t in AXIS_SHARES[kind]]


def expand_grid(search_space: dict) -> list[dict]:
    """TU4: every combination of the axes' points (parameters, not data: one dict per
    cross-validation that follows); the last axis varies fastest."""
    grid: list[dict] = [{}]
    for name, spec in search_space.items():
        points = axis_points(spec)
        grid = [{**so_far, name: x} for so_far in grid for x in points]
    return grid


# ---- TU8 / TU11 / TU12 / TU13 / TU14 -------------------------------------------------------
def keep_if_better(summary: DataFrame, pairs: dict, model: str = "model",
                   score: str = "cv_roc_auc_mean") -> DataFrame:
    """TU8: for each (baseline → tuned) pair keep the tuned one only when its
    mean AUC is strictly higher."""
    pr = summary.sparkSession.createDataFrame(list(pairs.items()), "baseline string, tuned string")
    b = summary.select(F.col(model).alias("baseline"), F.col(score).alias("base_score"))
    t = summary.select(F.col(model).alias("tuned"), F.col(score).alias("tuned_score"))
    j = pr.join(b, "baseline").join(t, "tuned")
    better = F.col("tuned_score") > F.col("base_score")
    return j.select("baseline", F.when(better, F.col("tuned")).otherwise(F.col("baseline")).alias("chosen"),
                    F.when(better, F.col("tuned_score")).otherwise(F.col("base_score")).alias("chosen_score"))


def top_n_models(summary: DataFrame, n: int, score: str = "cv_roc_auc_mean",
                 model: str = "model") -> DataFrame:
    """TU11: the n best models by mean AUC (ties by name)."""
    return summary.orderBy(F.desc(score), F.asc(model)).limit(n)


def select_best(summary: DataFrame, score: str = "cv_roc_auc_mean", std: str = "cv_roc_auc_std",
                model: str = "model") -> DataFrame:
    """TU12: highest mean AUC, then the lower std."""
    return summary.orderBy(F.desc(score), F.asc(std), F.asc(model)).limit(1)


def fold_scores_of(fold_metrics: DataFrame, best: DataFrame, model: str = "model",
                   metric: str = "roc_auc") -> DataFrame:
    """TU13: per-fold scores of the chosen model and their population std."""
    f = fold_metrics.join(best.select(model), model)
    sd = f.agg(F.stddev_pop(metric)).scalar()
    return f.select(model, "fold", metric, sd.alias(f"{metric}_std_pop"))


def search_history(draws: DataFrame, order: str = "draw", objective: str = "objective") -> DataFrame:
    """TU14: objective per draw and the best so far (window over the small
    draw table: one row per draw)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return draws.withColumn("best_so_far", F.max(objective).over(w))


# ---- ME11 / ME13 / ME14 -------------------------------------------------------------------
def robustness(fold_metrics: DataFrame, holdout_fold: int = 0, model: str = "model") -> DataFrame:
    """ME13: CV AUC (other folds) − holdout AUC (one stratified fold) → band."""
    g = fold_metrics.groupBy(model).agg(
        F.avg(F.when(F.col("fold") != holdout_fold, F.col("roc_auc"))).alias("cv_auc"),
        F.max(F.when(F.col("fold") == holdout_fold, F.col("roc_auc"))).alias("holdout_auc"))
    g = g.withColumn("delta", F.col("cv_auc") - F.col("holdout_auc"))
    return g.withColumn("band", robustness_band(F.col("delta")))


# ---- TU10 -----------------------------------------------------------------------------------
def weight_grid(models: Sequence[str], low: int, high: int) -> list[tuple[int, ...]]:
    """Every integer weight vector in [low, high]^k (k = number of models)."""
    return list(itertools.product(range(low, high + 1), repeat=len(models)))


def voted(models: Sequence[str], weights: Sequence[Column | float]) -> Column:
    """Weighted mean of probability columns."""
    num = sum((F.lit(w) * F.col(m) if not isinstance(w, Column) else w * F.col(m)
               for m, w in zip(models, weights)), F.lit(0.0))
    den = sum((F.lit(float(w)) if not isinstance(w, Column) else w.cast("double")
               for w in weights), F.lit(0.0))
    return num / den


#: Weight vectors scored by one job; the rows of the explosion are at most this times
#: the distinct (label, scores) tuples.
VECTORS_PER_BATCH = 100


def _vote_aucs(lv: DataFrame, models: Sequence[str], grid: Sequence[Sequence[int]], first: int, y: str,
               edges: dict[str, list[float]]) -> DataFrame:
    """``combo, roc_auc`` of some vectors, numbered from ``first``."""
    combos = F.array(*[F.struct(F.lit(i).alias("combo"),
                                *[F.lit(int(w)).alias(f"w_{m}") for m, w in zip(models, ws)])
                       for i, ws in enumerate(grid, first)])
    x = lv.select("*", F.explode(combos).alias("__c")).select("*", "__c.*").drop("__c")
    x = x.withColumn("p_vote", voted(models, [F.col(f"w_{m}") for m in models]))
    sl = x.groupBy("combo", "p_vote").agg(
        F.sum(F.when(F.col(y) == 1, F.col("__w")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y) == 0, F.col("__w")).otherwise(0)).alias("neg"))
    c = prefix_sums(bucketize(sl, ["p_vote"], edges, [BUCKET]), ["p_vote"], ["neg", "pos"], ["combo"])
    contrib = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))
    return c.groupBy("combo").agg(
        F.try_divide(F.sum(contrib), F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("roc_auc"))


def soft_voting_search(scores: DataFrame, models: Sequence[str], grid: Sequence[Sequence[int]],
                       y: str = "y", n_buckets: int | None = None,
                       per_batch: int = VECTORS_PER_BATCH) -> DataFrame:
    """TU10: exact AUC of the weighted-mean probability for every weight vector.

    Rows → distinct (y, p_1..p_k) with counts, written once, then for every
    batch of vectors × batch (a bounded literal array, generate not join) and
    one grouped score-level count and bucketed prefix sum per combination.
    The bucket edges are those of the unweighted mean: edges decide how evenly
    levels spread, not the result.
    """
    lv = materialize(scores.groupBy(y, *models).agg(F.count(F.lit(1)).alias("__w")))
    edges = edge_values(lv.select(voted(models, [1] * len(models)).alias("p_vote")), ["p_vote"], n_buckets)
    auc = None
    for first in range(0, len(grid), per_batch):
        part = materialize(_vote_aucs(lv, models, grid[first:first + per_batch], first, y, edges))
        auc = part if auc is None else auc.unionByName(part)
    weights = scores.sparkSession.createDataFrame(
        [(i, *map(int, ws)) for i, ws in enumerate(grid)],
        "combo int, " + ", ".join(f"w_{m} int" for m in models))
    return weights.join(auc, "combo")


#: Cells (weight vectors × score bins) that a task sums up at a time, and the most bins: beyond
#: them exact scores cost no more than further bounds.
CELLS, MOST_BINS = 1 << 20, 1 << 12
#: Levels that a task adds up together, and that it sorts together for exact scores.
LEVELS_AT_ONCE, LEVELS_SORTED = 1 << 15, 1 << 18
LEVELS_A_TASK = 1 << 17
#: Levels × vectors that one exact job deals out, and the sampled levels that the edges of its groups come from.
LEVELS_DEALT, EDGE_ROWS = 1 << 26, 20_000


def _levels(batches, k: int, at_once: int):
    """Scores (a list of arrays, NaN for NULL), negatives and positives of some levels at a time."""
    def split(held):
        s = pa.Table.from_batches(held)
        y, w = s.column(k).to_numpy(), s.column(k + 1).to_numpy().astype(float)
        return [s.column(j).to_numpy().astype(float) for j in range(k)], np.where(y == 0, w, 0.0), np.where(y == 1, w, 0.0)
    held, n = [], 0
    for b in batches:
        for at in range(0, b.num_rows, at_once):
            part = b.slice(at, at_once)
            if held and n + part.num_rows > at_once:
                yield split(held)
                held, n = [], 0
            held, n = [*held, part], n + part.num_rows
    if n:
        yield split(held)


def auc_bounds(lv: DataFrame, models: Sequence[str], grid: np.ndarray, bins: int, y: str = "y") -> np.ndarray:
    """Lower and upper AUC of every weight vector from histograms of its votes.

    Levels in different bins are ordered as their bins; within a bin all pairs
    may be right or wrong; votes without a score are one level, after all others.  A task adds up a histogram per vector, Spark sums them,
    the driver receives two numbers a vector.  A pass takes as many vectors as ``CELLS``
    allows, so its memory depends neither on the vectors nor on the bins.
    """
    step = max(1, CELLS // bins)
    return np.concatenate([np.empty((0, 2)), *[_auc_bounds(lv, models, grid[i:i + step], bins, y)
                                               for i in range(0, len(grid), step)]])


def _auc_bounds(lv: DataFrame, models: Sequence[str], grid: np.ndarray, bins: int, y: str) -> np.ndarray:
    k, v = len(models), len(grid)
    share = grid / grid.sum(axis=1, keepdims=True)

    def run(batches):
        total = np.zeros((v, 2 * (bins + 1)))
        for x, neg, pos in _levels(batches, k, LEVELS_AT_ONCE):
            side, w = np.where(pos > 0, bins + 1, 0), neg + pos
            none = np.isnan(sum(x))
            for i in range(v):  # one vector at a time: its cells and histogram stay in the cache
                vote = x[0] * share[i, 0]
                for j in range(1, k):
                    vote += x[j] * share[i, j]
                vote *= bins
                np.clip(vote, 0, bins - 1, out=vote)
                vote[none] = bins
                cell = vote.astype(np.int64)
                cell += side
                total[i] += np.bincount(cell, w, 2 * (bins + 1))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(v), pa.int32()), pa.array(
                list(total), pa.list_(pa.float64()))], ["k", "v"])
    sums = lv.select(*models, F.col(y), "__w").mapInArrow(run, "k int, v array<double>") \
        .groupBy("k").agg(Summarizer.sum(array_to_vector("v")).alias("v"))

    def bounds(batches):
        for b in batches:
            h = np.array(b.column(1).to_pylist()).reshape(-1, 2, bins + 1)
            neg, pos = h[:, 0], h[:, 1]
            pairs = np.maximum(neg.sum(axis=1) * pos.sum(axis=1), 1)
            low = ((pos * (np.cumsum(neg, axis=1) - neg)).sum(axis=1) + 0.5 * pos[:, -1] * neg[:, -1]) / pairs
            open_ = (pos[:, :-1] * neg[:, :-1]).sum(axis=1) / pairs
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(low), pa.array(low + open_)], ["k", "low", "high"])
    out = np.zeros((v, 2))
    for r in sums.select("k", vector_to_array("v").alias("v")).mapInArrow(bounds, "k int, low double, high double").collect():
        out[r["k"]] = r["low"], r["high"]
    return out


def _vote_levels(x: Sequence[np.ndarray], weights: Sequence[int]) -> np.ndarray:
    """Votes as ``voted`` computes them, bit by bit."""
    num = 0.0
    for w, s in zip(weights, x):
        num = num + w * s
    return num / float(sum(map(float, weights)))


def _added_up(vote: np.ndarray, neg: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct votes in order (NaN last, as one), with their negatives and positives."""
    order = np.argsort(vote, kind="stable")
    vote = vote[order]
    first = np.flatnonzero(np.append(True, (vote[1:] != vote[:-1]) & ~np.isnan(vote[:-1]))) if len(vote) else np.empty(0, int)
    if not len(first):
        return vote, neg, pos
    return vote[first], np.add.reduceat(neg[order], first), np.add.reduceat(pos[order], first)


def exact_aucs(lv: DataFrame, models: Sequence[str], grid: Sequence[Sequence[int]], y: str = "y") -> list[float | None]:
    """Exact AUC of every weight vector; None where a class is missing, nothing without a level.

    A task sorts some levels at a time by each vector's votes and adds up equal ones;
    ranges of votes of a vector (edges from a sample, which decide how evenly levels
    spread, not the result) meet in one group; the driver receives three numbers a
    range.  No row per level and vector is made, and a job deals out a bounded number of levels.
    """
    k, n = len(models), lv.count()
    if not n:
        return []
    seen = lv.select(*models).sample(min(1.0, EDGE_ROWS / n), 13).limit(2 * EDGE_ROWS).toArrow()
    seen = [seen.column(j).to_numpy().astype(float) for j in range(k)]
    ranges = -(-n // LEVELS_SORTED)
    shares = np.arange(1, ranges) / ranges
    step, out = max(1, LEVELS_DEALT // n), []
    for first in range(0, len(grid), step):
        some = [tuple(map(int, ws)) for ws in grid[first:first + step]]
        edges = []
        for ws in some:
            at = _vote_levels(seen, ws)
            at = at[~np.isnan(at)]
            edges.append(np.unique(np.quantile(at, shares, method="lower")) if len(at) and len(shares) else np.empty(0))
        got = lv.select(*models, F.col(y), "__w").mapInArrow(_sorted_votes(some, edges, k), VOTES_SCHEMA) \
            .groupBy("k", "b").applyInArrow(_range_pairs, "k int, b int, neg double, pos double, right double").collect()
        for i in range(len(some)):
            below = won = positives = 0.0
            for r in sorted((r for r in got if r["k"] == i), key=lambda r: r["b"]):
                won += r["right"] + r["pos"] * below
                below, positives = below + r["neg"], positives + r["pos"]
            out.append(won / (positives * below) if positives and below else None)
    return out


VOTES_SCHEMA = "k int, b int, vote binary, neg binary, pos binary"


def _sorted_votes(grid: Sequence[tuple], edges: Sequence[np.ndarray], k: int):
    def run(batches):
        for x, neg, pos in _levels(batches, k, LEVELS_SORTED):
            for i, ws in enumerate(grid):
                parts = _added_up(_vote_levels(x, ws), neg, pos)
                cuts = [0, *np.searchsorted(parts[0], edges[i], side="right").tolist(), len(parts[0])]
                rows = [(i, b, *[p[lo:hi].tobytes() for p in parts]) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if lo < hi]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["k", "b", "vote", "neg", "pos"])
    return run


def _range_pairs(t: pa.Table) -> pa.Table:
    """Negatives and positives of a range of votes, and the pairs in it that are right (ties half)."""
    _, neg, pos = _added_up(*[np.frombuffer(b"".join(t.column(c).to_pylist())) for c in ("vote", "neg", "pos")])
    right = float((pos * (np.cumsum(neg) - neg + 0.5 * neg)).sum())
    return pa.table({"k": t.column("k")[:1], "b": t.column("b")[:1], "neg": [float(neg.sum())], "pos": [float(pos.sum())],
                     "right": [right]})


def best_weights(scores: DataFrame, models: Sequence[str], grid: Sequence[Sequence[int]], y: str = "y",
                 few: float = 0.05) -> dict:
    """TU10: the weight vector with the highest AUC (the first of equals), its exact AUC
    and how many vectors were scored exactly.

    Vectors whose upper bound is under the best lower bound cannot win; the others
    are bounded again with more bins, until at most ``few`` of all are left or
    bins are at their finest.  What is left is scored exactly, so the result is
    that of the whole grid.  Scores are probabilities.
    """
    lv = scores.where(F.col(y).isNotNull()).groupBy(y, *models).agg(F.count(F.lit(1)).alias("__w"))
    lv = materialize(lv)
    # work per level is large: every core gets some, but a task of few levels costs more than it does
    tasks = min(scores.sparkSession.sparkContext.defaultParallelism, -(-lv.count() // LEVELS_A_TASK))
    lv = materialize(lv.repartition(max(1, tasks)))
    left, all_w = np.arange(len(grid)), np.array(grid, float)
    bins = 0
    while len(left) > max(1, few * len(grid)) and bins < MOST_BINS:
        bins = min(MOST_BINS, max(4 * bins, CELLS // len(left)))
        b = auc_bounds(lv, models, all_w[left], bins, y)
        left = left[b[:, 1] >= b[:, 0].max() - 1e-9]  # a margin for rounding at the edges of bins
    auc = {i: a or 0.0 for i, a in zip(left.tolist(), exact_aucs(lv, models, [grid[i] for i in left], y))}
    best = min(auc, key=lambda i: (-auc[i], i)) if auc else 0
    return {"combo": best, "weights": dict(zip(models, grid[best])), "roc_auc": auc.get(best), "scored": len(left)}
