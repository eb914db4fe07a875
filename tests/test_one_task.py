"""Learners fitted in one task each: they are those of the distributed fits."""

import random

import numpy as np
import pytest

from tessera.operators import models as ml
from tessera.operators import one_task as ot
from tessera.plans import tune

COLS = ["a", "b", "tenure", "d"]


def folds(spark, n=150, parts=3):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        x = [rnd.gauss(0, 1), None if i % 9 == 0 else rnd.random(), float(rnd.randint(0, 72)), float(rnd.randint(0, 1))]
        rows.append((f"c{i}", *x, int(x[0] + 0.03 * x[2] + rnd.gauss(0, 0.8) > 1.2), i % 3))
    return spark.createDataFrame(rows, "customerID string, a double, b double, tenure double, d double, Churn int, fold int") \
        .repartition(parts)


def by_key(df, *cols):
    return {r.customerID: tuple(r[c] for c in cols) for r in df.collect()}


def test_members_score_like_distributed_fits(spark, monkeypatch):
    base = [("decision_tree", {"class_weight": None, "max_depth": 4, "min_samples_leaf": 3}),
            ("gradient_boosting", {"n_estimators": 4}), ("knn", {"n_neighbors": 4, "weights": "distance", "metric": "manhattan"}),
            ("logistic_regression", None), ("svc", None)]
    cols = [f"__p{i}" for i in range(len(base))]
    fd = tune.as_folds(folds(spark), COLS)
    with monkeypatch.context() as m:
        m.setattr(tune.Folds, "fit", lambda *_: pytest.fail("a distributed fit"))
        got = by_key(tune.wide_oof(fd, base), *cols)
    monkeypatch.setattr(tune, "ONE_TASK_BYTES", 0)  # a table that no task holds
    want = by_key(tune.wide_oof(fd, base), *cols)
    assert got.keys() == want.keys() and len(got) == 150
    a, b = (np.array([x[k] for k in sorted(x)]) for x in (got, want))
    off = np.abs(a - b)
    # splits of equal gain may be told apart by rounding
    assert (off[:, :3] > 1e-9).mean(axis=0).max() < 0.1 and off[:, 3].max() < 1e-6 and off[:, 4].max() < 1e-3


def test_all_learners_by_default_without_a_distributed_fit(spark, monkeypatch):
    monkeypatch.setattr(tune.Folds, "fit", lambda *_: pytest.fail("a distributed fit"))
    rows = tune.baseline_all(folds(spark), COLS).collect()
    assert sorted({r.model for r in rows}) == sorted(ml.SEARCH_SPACES) and len(rows) == 24
    auc = {n: np.mean([r.roc_auc for r in rows if r.model == n]) for n in ml.SEARCH_SPACES}
    assert auc["random_forest"] > 0.7 and auc["logistic_regression"] > 0.8 and min(auc.values()) > 0.6


def test_files_and_repeated_keys_do_not_matter(spark):
    base = [("random_forest", {"n_estimators": 5}), ("xgboost", {"n_estimators": 3, "subsample": 0.7, "colsample_bytree": 0.5})]
    got = []
    for parts in (1, 4):
        df = folds(spark, parts=parts).withColumnRenamed("tenure", "c")  # not scaled: a mean's rounding depends on files
        wide = tune.wide_oof(tune.as_folds(df.unionByName(df.where("fold = 0")), ["a", "b", "c", "d"]), base)
        assert wide.count() == 200
        got.append(sorted(tuple(r) for r in wide.select("customerID", "__p0", "__p1").collect()))
    assert got[0] == got[1]


def test_neighbours_beyond_what_a_task_compares(spark, monkeypatch):
    fd, base = tune.as_folds(folds(spark), COLS), [("knn", None), ("logistic_regression", None)]
    want = by_key(tune.wide_oof(fd, base), "__p0", "__p1")
    monkeypatch.setattr(tune, "ONE_TASK_PAIRS", 10)
    assert by_key(tune.wide_oof(fd, base), "__p0", "__p1") == want


def test_thresholds_are_midpoints_or_of_equal_weight():
    assert ot.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), np.ones(4), 31).tolist() == [1.5, 2.5]
    assert ot.thresholds(np.ones(4), np.ones(4), 31).tolist() == []
    x = np.arange(100.0)
    assert ot.thresholds(x, np.ones(100), 3).tolist() == [24.5, 49.5, 74.5]
    heavy = ot.thresholds(x, np.where(x < 10, 10.0, 1.0), 1)
    assert len(heavy) == 1 and heavy[0] < 10


def test_deep_trees_do_not_depend_on_what_is_summed_together(monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.random((400, 6)).round(3), (rng.random(400) < 0.4).astype(float)
    for name, p in (("decision_tree", {}), ("random_forest", {"n_estimators": 4}), ("decision_tree", {"min_samples_leaf": 5})):
        args = (name, p, x, y, np.where(y == 1, 2.0, 1.0), x, 3)
        monkeypatch.undo()
        whole = ot.tree_scores(*args)
        monkeypatch.setattr(ot, "CELLS", 500)
        monkeypatch.setattr(ot, "LEAST_ROWS", 7)
        assert np.allclose(whole, ot.tree_scores(*args), atol=1e-12)
        # grown until leaves are pure
        assert ((whole > 0.5) == y).all() == (name == "decision_tree" and not p)
