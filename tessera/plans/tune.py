"""Cross-validation, search and ensembles (TU1, TU3, TU5-TU7, TU9, TU10).

The outer loops (folds × parameter draws × learners) are driver-side; every
fit and every score inside them is a distributed Spark job.  The fold frame is
written once (shared checkpoint folder) and its training parts are prepared
once (``Folds``), whatever the number of draws.  Logistic regressions of all draws
and training parts are solved together (``linear_many``).
Fold metrics are computed with the exact distributed metrics of
``tessera.operators.metrics`` over the union of all out-of-fold predictions
(one job per evaluation, not one per fold).  Fits of independent folds run
concurrently from a small driver thread pool (``parallelism``).
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from tessera.operators import linear_many as lm
from tessera.operators import metrics as me
from tessera.operators import one_task
from tessera.operators import reduce as fr
from tessera.operators.models import (DEFAULTS, SEARCH_SPACES, build_estimator, check_names, fit_pipeline,
                                      preparation_numbers, preparation_stage, preparations_of_parts, predict)
from tessera.operators.split import tuning_subsample
from tessera.plans.config import SVC_TUNING_ROWS
from tessera.operators.ensemble import LinearScorer, StackingModel, VotingModel, member_column
from tessera.plans.selection import best_weights, expand_grid, top_n_models, voted, weight_grid

log = logging.getLogger(__name__)
METRIC_NAMES = ("roc_auc", "f1", "precision", "recall", "accuracy")
MAX_FOLD_THREADS = 10
SLOW_FITS = ("random_forest", "xgboost", "lightgbm", "gradient_boosting")
ROW_ID = "__row"
# features of a table that one task holds, and pairs of rows that one task compares; beyond that fits are distributed
ONE_TASK_BYTES, ONE_TASK_PAIRS = 1 << 28, 1 << 32
# FIXED VALUES: draws of a random search and of a search tuned jointly with the reduction
N_ITER, N_TRIALS = 50, 30


class Folds:
    """A written fold table with what all fits on it share: the fold numbers (of a
    fold assignment, so a handful) and the preparation of each training part."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str = "Churn",
                 key: Sequence[str] = ("customerID",), fold: str = "fold"):
        self.df, self.features, self.label, self.key, self.fold = df, list(features), label, list(key), fold
        self.sizes = {r[0]: r[1] for r in df.groupBy(fold).count().orderBy(fold).collect()}  # one row a fold
        self.folds = list(self.sizes)
        self._numbers: dict = {}
        self._rows = self._with_ids = None

    def train(self, without: Sequence) -> DataFrame:
        return self.df.where(~F.col(self.fold).isin(list(without)))

    def part(self, f) -> DataFrame:
        return self.df.where(F.col(self.fold) == f)

    def numbers(self, without: tuple) -> list[tuple]:
        """Preparation of the rows outside ``without``, in whatever order it is given."""
        key = frozenset(without)
        if key not in self._numbers:
            self._numbers[key] = preparation_numbers(self.train(without), self.features)
        return self._numbers[key]

    def prepare(self, withouts: Sequence) -> None:
        """The preparations of several training parts, in shared jobs."""
        new = [w for w in dict.fromkeys(map(frozenset, withouts)) if w not in self._numbers]
        if len(new) > 1:
            self._numbers.update(zip(new, preparations_of_parts(self.df, self.features, self.fold, new)))

    def preparation(self, without: tuple):
        return preparation_stage(self.features, self.numbers(without))

    def rows(self) -> DataFrame:
        """The table that ``linear_many`` passes over, written once."""
        if self._rows is None:
            self._rows = lm.rows_table(self.df, self.features, self.label, self.fold, self.key)
        return self._rows

    def in_one_task(self) -> bool:
        """Whether a task can hold the features of all rows."""
        return 8 * len(self.features) * sum(self.sizes.values()) <= ONE_TASK_BYTES

    def with_ids(self) -> DataFrame:
        """The rows with a number each (``ROW_ID``), written once."""
        if self._with_ids is None:
            self._with_ids = materialize(self.df.withColumn(ROW_ID, F.monotonically_increasing_id()))
        return self._with_ids

    def fit(self, without: Sequence, name: str, params: dict | None, reduction: dict | None = None, seed: int = 13):
        return fit_pipeline(self.train(without), self.features, name, params, reduction, self.label, seed,
                            self.preparation(tuple(without)))


def as_folds(df, features, label="Churn", key=("customerID",), fold="fold") -> Folds:
    return df if isinstance(df, Folds) else Folds(df, features, label, key, fold)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- logistic regressions, all draws and parts at once ------------------------------------------
def solved_together(name: str, reduction: dict | None) -> bool:
    """Whether ``linear_many`` covers a draw: logistic regression, on no or a linear reduction."""
    return name == "logistic_regression" and (reduction or {}).get("ranker", "ridge") == "ridge"


def _basis(reduction: dict | None, moments: dict | None, d: int) -> np.ndarray:
    """The linear map of a reduction fitted on a training part (offsets move the intercept only)."""
    r = reduction or {}
    method = r.get("method", "none")
    if method == "none":
        return np.eye(d)
    ms = [m for m in moments.values() if m["n"]]
    if method == "lda":
        return fr.discriminant_axes(ms)[1]
    n = sum(m["n"] for m in ms)
    mean = sum(m["n"] * np.append(m["mean"], m["label"]) for m in ms) / n
    cov = np.zeros((d + 1, d + 1))
    for m in ms:
        cov[:d, :d] += m["scatter"]
        cov += m["n"] * np.outer(np.append(m["mean"], m["label"]) - mean, np.append(m["mean"], m["label"]) - mean)
    cov /= max(n - 1, 1)
    if method == "pca":
        return fr.principal_axes(cov[:d, :d], max(1, min(int(r.get("n_components", 15)), d - 1)))[1]
    return np.eye(d)[:, fr.ridge_elimination(cov, min(int(r.get("n_features", 15)), d))]


def _class_weights(params: dict, n0: float, n1: float) -> tuple[float, float]:
    if params.get("class_weight") == "balanced":
        k = (n0 > 0) + (n1 > 0)
        return tuple((n0 + n1) / (k * n) if n else 0.0 for n in (n0, n1))
    return 1.0, float(params.get("scale_pos_weight", 1.0))


def linear_parts(fd: Folds, withouts: Sequence[Sequence], scored: Sequence) -> list[lm.Part]:
    """Training parts of ``linear_many`` with the preparation of each."""
    fd.prepare(withouts)
    return [lm.Part(tuple(map(str, w)), None if f is None else str(f), *map(np.array, zip(*fd.numbers(tuple(w)))))
            for w, f in zip(withouts, scored)]


def class_counts(table: DataFrame) -> dict:
    return {(r["fold"], r["y"]): r["count"] for r in table.groupBy("fold", "y").count().collect()}  # folds × classes


def class_sizes(counts: dict, part: lm.Part) -> list[int]:
    """Rows of class 0 and 1 that a part trains on."""
    return [sum(n for (f, y), n in counts.items() if y == c and f not in part.without) for c in (0, 1)]


def linear_oof(fd: Folds, draws: Sequence[tuple], without: Sequence = ()) -> DataFrame:
    """``draw, fold, y, key, p``: out-of-fold probabilities of many logistic regressions
    ((params, reduction) each), every fold scored by the fit on the others.  The
    passes over the rows do not grow with the number of draws."""
    table, d = fd.rows(), len(fd.features)
    folds = [f for f in fd.folds if f not in without]
    parts = linear_parts(fd, [(*without, f) for f in folds], folds)
    counts = class_counts(table)
    reduced = any((r or {}).get("method", "none") != "none" for _, r in draws)
    moments = lm.class_moments(table, parts, d) if reduced else [None] * len(parts)
    problems = {}
    for k, part in enumerate(parts):
        n0, n1 = class_sizes(counts, part)
        for i, (params, reduction) in enumerate(draws):
            p = {**DEFAULTS["logistic_regression"], **(params or {})}
            w0, w1 = _class_weights(p, n0, n1)
            problems[i, k] = lm.Problem(k, float(p["C"]), p["penalty"] == "l1", w0, w1,
                                        _basis(reduction, moments[k], d), n0 * w0 + n1 * w1)
    passes = lm.solve(table, parts, list(problems.values()), d)
    log.info("%d regressions solved in %d passes", len(problems), passes)
    out = lm.scores(table, parts, {k: p.theta() for k, p in problems.items()}, d)
    return out.withColumn("fold", F.col("fold").cast(fd.df.schema[fd.fold].dataType))


def _linear_draws(fd: Folds, draws: Sequence[tuple], seed: int) -> list[dict]:
    """Objective of every draw (mean AUC over the folds), all in one metrics job."""
    ok, out = [], [{"objective": 0.0, "failed": True} for _ in draws]
    for i, (params, reduction) in enumerate(draws):
        try:
            check_names("logistic_regression", reduction)
            build_estimator("logistic_regression", params, 1, seed)
            if float({**DEFAULTS["logistic_regression"], **(params or {})}["C"]) <= 0:
                raise ValueError("C must be positive")
            ok.append(i)
        except (ValueError, IllegalArgumentException) as e:
            log.warning("draw %s refused: %s", params, e)
    if ok:
        auc = me.roc_auc(linear_oof(fd, [draws[i] for i in ok]), "y", "p", by=["draw", "fold"])
        for r in auc.groupBy("draw").agg(F.avg("auc").alias("auc")).collect():  # one row a draw
            out[ok[r["draw"]]] = {"objective": float(r["auc"] or 0.0), "failed": False}
    return out


def oof_predictions(df, features: Sequence[str], name: str, params: dict | None = None,
                    reduction: dict | None = None, label: str = "Churn", key: Sequence[str] = ("customerID",),
                    fold: str = "fold", seed: int = 13, parallelism: int | None = None,
                    without: Sequence = ()) -> DataFrame:
    """Out-of-fold predictions (key, fold, y, p, yhat), written once: for every
    fold, fit on the others and score this one.  ``without`` leaves folds out
    altogether (the inner folds of a nested evaluation)."""
    check_names(name, reduction)
    fd = as_folds(df, features, label, key, fold)
    folds = [f for f in fd.folds if f not in without]
    if solved_together(name, reduction):
        out = linear_oof(fd, [(params, reduction)], without)
        return materialize(out.select("key.*", F.col("fold").alias(fd.fold), F.col("y").cast(fd.df.schema[fd.label].dataType),
                                      "p", (F.col("p") > 0.5).cast("int").alias("yhat")))

    def one(f):
        model = fd.fit((*without, f), name, params, reduction, seed)
        return predict(model, fd.part(f), keep=[*fd.key, fd.fold, fd.label])

    # one driver thread per fold by default: every fold fit is submitted at
    # once, so the cluster scheduler (not the driver) decides the overlap
    workers = parallelism or min(len(folds), MAX_FOLD_THREADS)
    with ThreadPoolExecutor(max_workers=max(1, workers)) as ex:
        parts = list(ex.map(one, folds))
    return materialize(_union(parts).withColumnRenamed(fd.label, "y"))


def cross_validate(df, features: Sequence[str], name: str, params: dict | None = None,
                   reduction: dict | None = None, label: str = "Churn", key=("customerID",),
                   fold: str = "fold", seed: int = 13, parallelism: int | None = None) -> DataFrame:
    """TU1: five metrics per fold (one grouped metrics job over all folds)."""
    check_names(name, reduction)
    fd = as_folds(df, features, label, key, fold)
    oof = oof_predictions(fd, features, name, params, reduction, seed=seed, parallelism=parallelism)
    m = me.classification_metrics(oof, "y", "p", by=[fd.fold])
    return m.select(fd.fold, *METRIC_NAMES)


def summarize(fold_metrics: DataFrame) -> dict:
    """TU2 as a dict (one small row)."""
    return me.aggregate_folds(fold_metrics).first().asDict()


def linear_members(fd: Folds, base: Sequence[tuple[str, dict | None]], withouts: Sequence[frozenset]) -> dict:
    """Logistic regressions and SVCs (with their Platt scaling) of many training parts, all
    solved together: (part, index in ``base``) → scorer."""
    table, d = fd.rows(), len(fd.features)
    parts = linear_parts(fd, [sorted(w) for w in withouts], [None] * len(withouts))
    counts, problems = class_counts(table), {}
    for k, part in enumerate(parts):
        for i, (name, params) in enumerate(base):
            build_estimator(name, params, 1)  # parameters raise here
            p, (n0, n1) = {**DEFAULTS[name], **(params or {})}, class_sizes(counts, part)
            w0, w1 = _class_weights(p, n0, n1)
            problems[k, i] = lm.Problem(k, float(p["C"]), p.get("penalty") == "l1", w0, w1, np.eye(d), n0 * w0 + n1 * w1,
                                        hinge=name == "svc")
    passes = lm.solve(table, parts, list(problems.values()), d)
    platt = {at: lm.Problem(p.part, np.inf, False, p.weight0, p.weight1, p.beta[:, None], p.n)
             for at, p in problems.items() if p.hinge}
    passes += lm.solve(table, parts, list(platt.values()), d)
    log.info("%d members solved in %d passes", len(problems), passes)
    return {(withouts[k], i): LinearScorer(fd.preparation(tuple(withouts[k])), platt.get((k, i), p).theta())
            for (k, i), p in problems.items()}


def fit_members(fd: Folds, base: Sequence[tuple[str, dict | None]], parts: Sequence[frozenset], seed: int = 13,
                parallelism: int | None = None) -> dict:
    """The learners of ``base`` fitted without each set of folds: set → members.

    Linear members of nested parts only score the folds left out: they are solved in
    shared passes.  All other fits, and those on all folds (the pipelines that are
    saved), are submitted from one pool."""
    if not isinstance(fd, Folds):  # fits only, no table to pass over
        return _fit_one_by_one(fd, base, parts, seed, parallelism, {})
    fd.prepare(parts)
    together = [i for i, (name, params) in enumerate(base)
                if name == "logistic_regression" or name == "svc" and "max_iter" not in (params or {})]
    nested = [part for part in parts if part] if together else []
    got = {}
    if nested:
        solved = linear_members(fd, [base[i] for i in together], nested)
        got = {(part, together[j]): scorer for (part, j), scorer in solved.items()}
    return _fit_one_by_one(fd, base, parts, seed, parallelism, got)


def _fit_one_by_one(fd: Folds, base: Sequence[tuple[str, dict | None]], parts: Sequence[frozenset], seed: int,
                    parallelism: int | None, got: dict) -> dict:
    """What ``got`` lacks, submitted from one pool."""
    jobs = [(part, i) for part in parts for i in range(len(base)) if (part, i) not in got]
    jobs.sort(key=lambda j: base[j[1]][0] not in SLOW_FITS)  # long fits first: none is left to run alone
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism or MAX_FOLD_THREADS, len(jobs) or 1))) as ex:
        got.update(zip(jobs, ex.map(lambda j: fd.fit(tuple(j[0]), *base[j[1]], None, seed), jobs)))
    return {part: [got[part, i] for i in range(len(base))] for part in parts}


def wide_oof(fd: Folds, base: Sequence[tuple[str, dict | None]], seed: int = 13, parallelism: int | None = None,
             without: Sequence = (), members: dict | None = None) -> DataFrame:
    """Out-of-fold probabilities of several learners side by side, written once: key,
    fold, label and one column per learner (``ensemble.member_column``).  The rows
    of a fold go through the learners fitted on the others (``members``, where
    they are fitted already) one after the other; where a task can hold the table, each
    learner is fitted on the others and scores the fold in a task of its own."""
    folds = [f for f in fd.folds if f not in without]
    if members is None and fd.in_one_task() and all(one_task.covers(*b) for b in base):
        return _one_task_oof(fd, base, folds, seed, parallelism, without)
    if members is None:
        members = fit_members(fd, base, [frozenset((*without, f)) for f in folds], seed, parallelism)
    cols = [*fd.key, fd.fold, fd.label, *map(member_column, range(len(base)))]

    def one(f):  # kNN members search while their scores are asked for: folds at once
        scored = VotingModel(members[frozenset((*without, f))], [1.0] * len(base)).scores(fd.part(f))
        return scored.select(*[F.col(f"`{c}`") for c in cols])

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism or MAX_FOLD_THREADS, len(folds)))) as ex:
        parts = list(ex.map(one, folds))
    return materialize(_union(parts))


def _one_task_oof(fd: Folds, base: Sequence[tuple[str, dict | None]], folds: Sequence, seed: int,
                  parallelism: int | None, without: Sequence) -> DataFrame:
    """``wide_oof`` with a task for each learner and fold (linear learners of a fold share
    one), submitted from one pool; scores meet their rows by the number of the row."""
    for name, params in base:
        build_estimator(name, params, 1) if name != "knn" else None  # parameters raise here
    rows, n = fd.with_ids(), sum(fd.sizes.values())
    parts = dict(zip(folds, linear_parts(fd, [(*without, f) for f in folds], folds)))
    y = F.col(f"`{fd.label}`").cast("double")
    head = [F.col(ROW_ID).alias("id"), F.col(f"`{fd.fold}`").cast("string").alias("fold"), y.alias("y")]
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in fd.features]).alias("x")
    linear = [(i, *b) for i, b in enumerate(base) if b[0] in one_task.LINEAR]
    jobs = [(f, [(i, *b)]) for f in folds for i, b in enumerate(base) if b[0] not in one_task.LINEAR]
    jobs += [(f, linear) for f in folds if linear]
    jobs.sort(key=lambda j: (*SLOW_FITS, j[1][0][1]).index(j[1][0][1]))  # long fits first

    def scored(job):
        (f, some), more = job, []
        labelled = rows.where(F.col(f"`{fd.label}`").isNotNull())
        if some[0][1] == "knn":
            left_out = sum(fd.sizes[g] for g in without)
            if fd.sizes[f] * (n - left_out - fd.sizes[f]) > ONE_TASK_PAIRS:
                model = fit_pipeline(rows.where(~F.col(fd.fold).isin([*without, f])), fd.features, "knn", some[0][2], None,
                                     fd.label, seed, fd.preparation((*without, f)))
                return materialize(predict(model, rows.where(F.col(fd.fold) == f), [ROW_ID]).select(
                    F.col(ROW_ID).alias("id"), F.lit(some[0][0]).alias("member"), "p"))
            labelled = fd.preparation((*without, f)).transform(labelled)
            # ties go by the same hash of vector and label as in ``KnnPipeline``
            more = [F.xxhash64(F.array(*[F.col(f"__x{i}") for i in range(len(fd.features))]), y.cast("int")).alias("rid")]
        return materialize(labelled.select(*head, x, *more).coalesce(1).mapInArrow(
            one_task.fit_and_score(some, str(f), parts[f], n, seed), one_task.SCORES))

    # a job of one task each: a union of single partitions may be one partition
    workers = max(parallelism or MAX_FOLD_THREADS, rows.sparkSession.sparkContext.defaultParallelism)
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as ex:
        p = _union(list(ex.map(scored, jobs))).groupBy("id").agg(
            *[F.max(F.when(F.col("member") == i, F.col("p"))).alias(member_column(i)) for i in range(len(base))])
    kept = rows.select(*[F.col(f"`{c}`") for c in (ROW_ID, *fd.key, fd.fold, fd.label)])
    return materialize(kept.join(p, kept[ROW_ID] == p["id"]).drop(ROW_ID, "id"))


def fold_metrics_of(wide: DataFrame, names: Sequence[str], fd: Folds) -> DataFrame:
    """(model, fold, metrics...) of all learners in ``wide``, in one metrics job."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(member_column(i)).alias("p"))
                                for i, n in enumerate(names)]))
    long = wide.select(F.col(fd.label).alias("y"), fd.fold, named.alias("m")).select("y", fd.fold, "m.model", "m.p")
    return me.classification_metrics(long, "y", "p", by=["model", fd.fold]).select(fd.fold, *METRIC_NAMES, "model")


def baseline_all(df, features: Sequence[str], names: Sequence[str] | None = None, label: str = "Churn",
                 key=("customerID",), fold: str = "fold", **kw) -> DataFrame:
    """TU3: every learner (default: all there are) with default parameters →
    (model, fold, metrics...)."""
    names = list(names or SEARCH_SPACES)
    for n in names:
        check_names(n)
    fd = as_folds(df, features, label, key, fold)
    return fold_metrics_of(wide_oof(fd, [(n, None) for n in names], **kw), names, fd)


def _score(df, features, name, params, reduction, **kw) -> dict:
    """Mean CV ROC AUC of one draw.  Parameters that the learner refuses score 0 and
    are marked as failed; every other error rises."""
    try:
        fm = cross_validate(df, features, name, params, reduction, **kw)
    except (ValueError, IllegalArgumentException) as e:
        log.warning("draw %s %s refused: %s", name, params, e)
        return {"objective": 0.0, "failed": True}
    return {"objective": float(fm.agg(F.avg("roc_auc")).first()[0] or 0.0), "failed": False}


def _scores(fd, features, name, draws, **kw) -> list[dict]:
    """The objectives of many draws: together where the learner allows it, else one by one."""
    if all(solved_together(name, r) for _, r in draws):
        return _linear_draws(fd, draws, kw.get("seed", 13))
    return [_score(fd, features, name, p, r, **kw) for p, r in draws]


def grid_search(df, features: Sequence[str], name: str, space: dict | None = None, **kw) -> list[dict]:
    """TU5: exhaustive grid (TU4 expansion), scored by mean CV ROC AUC of the
    full pipeline; returns draws sorted best first."""
    check_names(name)
    fd = as_folds(df, features, **{k: kw.pop(k) for k in ("label", "key", "fold") if k in kw})
    grid = expand_grid(space or SEARCH_SPACES[name])
    rows = [{"draw": i, "params": g, **got} for i, (g, got) in enumerate(zip(grid, _scores(
        fd, features, name, [(g, None) for g in grid], **kw)))]
    return sorted(rows, key=lambda r: -r["objective"])


def draw_params(space: dict, rng: np.random.Generator) -> dict:
    """One random draw: choice, int uniform, uniform, log-uniform."""
    out = {}
    for k, s in space.items():
        t = s["type"]
        if t == "categorical":
            out[k] = s["choices"][int(rng.integers(len(s["choices"])))]
        elif t == "int":
            out[k] = int(rng.integers(int(s["low"]), int(s["high"]) + 1))
        elif t == "float":
            out[k] = float(rng.uniform(float(s["low"]), float(s["high"])))
        elif t == "log_float":
            out[k] = float(math.exp(rng.uniform(math.log(float(s["low"])), math.log(float(s["high"])))))
    return out


# FIXED VALUES: the reductions that are tuned jointly with a learner
REDUCTION_SPACE = {"method": {"type": "categorical", "choices": ["none", "pca", "lda", "rfe"]},
                   "n_components": {"type": "int", "low": 5, "high": 28},
                   "n_features": {"type": "int", "low": 5, "high": 28}}


def random_search(df, features: Sequence[str], name: str, n_iter: int | None = None, seed: int = 13,
                  space: dict | None = None, co_tune_reduction: bool = False,
                  fixed: dict | None = None, tuning_rows: int | None = None, **kw) -> list[dict]:
    """TU6 (and TU7 with ``co_tune_reduction``): seeded draws in the order drawn, the
    reduction method and its parameters drawn jointly with the learner's.  Without
    ``n_iter`` the configured number (``N_ITER``, jointly ``N_TRIALS``).

    ``tuning_rows`` bounds the rows that the draws are fitted and scored on (SP3;
    as configured, ``SVC_TUNING_ROWS`` for the SVC and all rows for others)."""
    check_names(name)
    tuning_rows = tuning_rows or (SVC_TUNING_ROWS if name == "svc" else None)
    if tuning_rows:
        if isinstance(df, Folds):
            raise ValueError("a subsample is drawn from a frame, not from prepared folds")
        df = materialize(tuning_subsample(df, list(kw.get("key", ("customerID",))), tuning_rows, seed))
    fd = as_folds(df, features, **{k: kw.pop(k) for k in ("label", "key", "fold") if k in kw})
    rng = np.random.default_rng(seed)
    draws = []
    for _ in range(n_iter or (N_TRIALS if co_tune_reduction else N_ITER)):
        params = {**draw_params(space or SEARCH_SPACES[name], rng), **(fixed or {})}
        draws.append((params, draw_params(REDUCTION_SPACE, rng) if co_tune_reduction else None))
    return [{"draw": i, "params": p, "reduction": r, **got}
            for i, ((p, r), got) in enumerate(zip(draws, _scores(fd, features, name, draws, **kw)))]


def refit_best(df: DataFrame, features: Sequence[str], name: str, draws: Sequence[dict], label: str = "Churn",
               seed: int = 13):
    """The best draw (the first of equals) and the pipeline refitted with it on all rows."""
    best = max(draws, key=lambda r: (r["objective"], -r["draw"]))
    return best, fit_pipeline(df, features, name, best["params"], best.get("reduction"), label, seed)


# ---- TU9 / TU10: fitted ensembles --------------------------------------------------------------
# FIXED VALUES: the meta-model's C, the weights of a vote, and the members of an ensemble
META_C = {"C": {"type": "log_float", "low": 1e-4, "high": 1e4}}
VOTE_LOW, VOTE_HIGH, N_MEMBERS = 1, 10, 3


def _meta_objectives(fd: Folds, inner: dict, outer: dict, cols: Sequence[str], meta_c: Sequence[float]):
    """Fold metrics of the meta-model for every C: all C and outer folds in one solve."""
    rows = None
    for f in fd.folds:  # rows tagged by the outer fold they train, or are scored in
        for tag, frame in ((f"train {f}", inner[f]), (f"score {f}", outer[f])):
            part = frame.select(F.lit(tag).alias("__tag"), F.col(fd.label), *cols, fd.fold)
            rows = part if rows is None else rows.unionByName(part)
    tags = [f"{kind} {f}" for kind in ("train", "score") for f in fd.folds]
    table, d = lm.rows_table(rows, cols, fd.label, "__tag", [fd.fold]), len(cols)
    parts = [lm.Part(tuple(t for t in tags if t != f"train {f}"), f"score {f}", np.zeros(d), np.zeros(d), np.ones(d))
             for f in fd.folds]
    sizes = {r["fold"]: r["count"] for r in table.groupBy("fold").count().collect()}  # one row a tag
    problems = {(i, k): lm.Problem(k, float(c), False, 1.0, 1.0, np.eye(d), float(sizes.get(f"train {f}", 0)))
                for i, c in enumerate(meta_c) for k, f in enumerate(fd.folds)}
    lm.solve(table, parts, list(problems.values()), d)
    scored = lm.scores(table, parts, {k: p.theta() for k, p in problems.items()}, d)
    m = me.classification_metrics(scored.select("draw", f"key.{fd.fold}", "y", "p"), "y", "p", by=["draw", fd.fold])
    return m.select("draw", fd.fold, *METRIC_NAMES).collect()  # one row per C and fold


def stacking(df, features: Sequence[str], base: Sequence[tuple[str, dict]], meta_c: Sequence[float] | None = None,
             label: str = "Churn", key=("customerID",), fold: str = "fold", seed: int = 13,
             parallelism: int | None = None) -> dict:
    """TU9: stacked generalisation, evaluated without a leak.

    For outer fold f the meta-model learns from out-of-fold probabilities made
    inside the other folds only (neither f's rows nor its labels), the members
    are refitted on the other folds, and the stack scores f.  ``C`` of the
    meta-model (``meta_c``; default ``N_TRIALS`` log-uniform draws) is the one
    with the best mean AUC over the outer folds, the first of equals.  Returns
    C, the objective, fold metrics, all objectives, and the stack fitted on all folds.
    """
    for name, _ in base:
        check_names(name)
    if meta_c is None:
        rng = np.random.default_rng(seed)
        meta_c = [draw_params(META_C, rng)["C"] for _ in range(N_TRIALS)]
    fd = as_folds(df, features, label, key, fold)
    cols = [member_column(i) for i in range(len(base))]
    # without f and g is one fit for both, without f serves the outer fold and the final meta-model
    out = [frozenset(x) for k in (0, 1, 2) for x in itertools.combinations(fd.folds, k)]
    members = fit_members(fd, base, out, seed, parallelism)
    inner = {f: wide_oof(fd, base, without=(f,), members=members) for f in fd.folds}
    final = wide_oof(fd, base, members=members)
    outer = {f: final.where(F.col(fd.fold) == f) for f in fd.folds}
    got = _meta_objectives(fd, inner, outer, cols, meta_c)
    history = []
    for i, c in enumerate(meta_c):
        fm = [r for r in got if r["draw"] == i]
        history.append({"C": c, "objective": sum(r["roc_auc"] or 0.0 for r in fm) / len(fm), "fold_metrics": fm})
    best = dict(max(history, key=lambda h: h["objective"]))
    meta = fit_pipeline(final, cols, "logistic_regression",
                        {"C": best["C"], "class_weight": None}, None, fd.label, seed)
    best["history"] = [(h["C"], h["objective"]) for h in history]
    best["model"] = StackingModel(members[frozenset()], meta)
    return best


def fit_voting(df, features: Sequence[str], base: Sequence[tuple[str, dict]], weights: Sequence[float],
               label: str = "Churn", key=("customerID",), fold: str = "fold", seed: int = 13) -> VotingModel:
    """TU10: the members fitted on all rows, voting with ``weights``."""
    return VotingModel(fit_on_all(as_folds(df, features, label, key, fold), base, seed), weights)


def fit_on_all(fd: Folds, base: Sequence[tuple[str, dict | None]], seed: int = 13) -> list:
    """The learners fitted on all rows, side by side."""
    fd.numbers(())  # the preparation they share
    with ThreadPoolExecutor(max_workers=max(1, min(len(base), MAX_FOLD_THREADS))) as ex:
        return list(ex.map(lambda b: fd.fit((), *b, None, seed), base))


def best_vote(df, features: Sequence[str], names: Sequence[str] | None = None, n_members: int = N_MEMBERS,
              label: str = "Churn", key=("customerID",), fold: str = "fold", seed: int = 13) -> dict:
    """TU3 → TU11 → TU10: the ``n_members`` learners with the best mean AUC, the integer
    weights with the best AUC of their out-of-fold votes, and the vote fitted on
    all folds.  Returns names, weights, fold metrics of the vote and the model."""
    names = list(names or SEARCH_SPACES)
    fd = as_folds(df, features, label, key, fold)
    wide = wide_oof(fd, [(n, None) for n in names], seed)
    cv = me.aggregate_folds(fold_metrics_of(wide, names, fd), ["model"])
    top = [r["model"] for r in top_n_models(cv, n_members).collect()]
    cols = [member_column(names.index(n)) for n in top]
    with ThreadPoolExecutor(max_workers=1) as ex:  # the members do not wait for their weights
        members = ex.submit(fit_on_all, fd, [(n, None) for n in top], seed)
        won = best_weights(wide.select(F.col(fd.label).alias("y"), *cols), cols, weight_grid(cols, VOTE_LOW, VOTE_HIGH))
    weights = [won["weights"][c] for c in cols]
    voted_p = wide.select(F.col(fd.label).alias("y"), fd.fold, voted(cols, weights).alias("p"))
    fm = me.classification_metrics(voted_p, "y", "p", by=[fd.fold]).select(fd.fold, *METRIC_NAMES)
    return {"names": top, "weights": weights, "roc_auc": won["roc_auc"], "fold_metrics": fm,
            "model": VotingModel(members.result(), weights)}
