"""Ensembles as models, bounded vote search, atomic promotion."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ensemble
from tessera.operators import models as ml
from tessera.plans import registry as rg
from tessera.plans import selection as sel
from tessera.plans import tune

from .test_learned_models import COLS, churn_frame


def folds(spark, n=150, k=3):
    from tessera.operators.split import stratified_kfold
    from tessera.session import materialize
    return materialize(stratified_kfold(churn_frame(spark, n, holes=True), ["customerID"], "Churn", k, 1))


def test_vote_is_promoted_loaded_and_scores_repeated_keys(spark, tmp_path):
    df = folds(spark)
    vote = tune.fit_voting(df, COLS, [("logistic_regression", {}), ("knn", {"n_neighbors": 7}), ("decision_tree", {"max_depth": 3})],
                           [5, 2, 3])
    root = str(tmp_path / "reg")
    assert rg.promote_if_better(spark, root, "r", "voting", 0.8, 0.5, vote) == 1
    back = rg.load_model(spark, root)
    assert isinstance(back, ensemble.VotingModel) and back.weights == [5.0, 2.0, 3.0]
    rows = df.drop("Churn", "fold").withColumn("customerID", F.lit("same")).withColumn("p0", F.lit("mine"))
    a = sorted((r.a or 9, round(r.p, 12)) for r in ml.predict(vote, rows, ["a", "customerID"]).collect())
    b = sorted((r.a or 9, round(r.p, 12)) for r in ml.predict(back, rows, ["a", "customerID"]).collect())
    assert a == b and len(a) == 150


def test_stack_saves_and_draws_its_c(spark, tmp_path):
    df = folds(spark)
    best = tune.stacking(df, COLS, [("logistic_regression", {}), ("decision_tree", {"max_depth": 3})])
    assert len(best["history"]) == 30 and len({c for c, _ in best["history"]}) == 30
    assert all(1e-4 <= c <= 1e4 for c, _ in best["history"])
    assert best["objective"] == max(o for _, o in best["history"]) > 0.7
    best["model"].save(str(tmp_path / "stack"))
    back = ensemble.load(spark, str(tmp_path / "stack"))
    assert isinstance(back, ensemble.StackingModel)
    one, two = ({r.customerID: r.p for r in ml.predict(m, df, ["customerID"]).collect()} for m in (best["model"], back))
    assert one == two and len(one) == 150
    with pytest.raises(ValueError):
        ensemble.VotingModel([1, 2], [1.0])


def test_linear_members_of_nested_parts_are_solved_together(spark, monkeypatch):
    """Only the trees and the saved members are fitted one by one, and the SVC's hinge loss
    is no higher than that of Spark's own fit."""
    from pyspark.ml.functions import vector_to_array
    fd, fits, solved, fit, solve = tune.as_folds(folds(spark), COLS), [], [], tune.Folds.fit, tune.lm.solve

    def fitted(self, without, name, *a):
        fits.append((name, frozenset(without)))
        return fit(self, without, name, *a)

    def solving(table, parts, problems, d):
        solved.append(list(problems))
        return solve(table, parts, problems, d)
    monkeypatch.setattr(tune.Folds, "fit", fitted)
    monkeypatch.setattr(tune.lm, "solve", solving)
    base = [("logistic_regression", {}), ("svc", {}), ("decision_tree", {"max_depth": 3})]
    parts = [frozenset(), frozenset({1}), frozenset({0, 2})]
    members = tune.fit_members(fd, base, parts)
    assert sorted(fits, key=str) == sorted([(n, parts[0]) for n, _ in base] + [("decision_tree", p) for p in parts[1:]], key=str)
    svc = next(p for p in solved[0] if p.hinge and p.part == 0)
    model = fit(fd, (1,), "svc", {})
    rows = model.transform(fd.train((1,))).select("Churn", vector_to_array("features").alias("x"), "__svc_margin").toPandas()
    x, side = np.array(rows.x.tolist()), np.where(rows.Churn == 1, 1, -1)
    w = np.where(rows.Churn == 1, svc.weight1, svc.weight0)

    def loss(beta, margin):
        return (w * np.maximum(0, 1 - side * margin)).sum() / svc.n + 0.5 * beta @ beta / (svc.c * svc.n)
    theirs = loss(model.stages[-3].coefficients.toArray(), np.array([v[0] for v in rows["__svc_margin"]]))
    assert loss(svc.beta, x @ svc.beta + svc.intercept) <= theirs + 1e-4
    # Platt scaling is at its optimum on the training rows: the weighted errors sum to nothing
    got = {r.customerID: r.p for r in ml.predict(members[parts[1]][1], fd.train((1,)), ["customerID"]).collect()}
    keys = [r.customerID for r in model.transform(fd.train((1,))).select("customerID").collect()]
    error = w * (np.array([got[k] for k in keys]) - (side > 0)) / svc.n
    assert len(got) == 100 and abs(error.sum()) < 1e-6 and abs(error @ (x @ svc.beta)) < 1e-6


def test_parts_are_prepared_together_as_one_by_one(spark):
    df = folds(spark)
    whole = df.na.fill(0.5)
    for frame in (df, whole):
        sets = [(), (0,), (1, 2)]
        got = ml.preparations_of_parts(frame, COLS, "fold", sets)
        want = [ml.preparation_numbers(frame.where(~F.col("fold").isin(list(s))), COLS) for s in sets]
        assert np.allclose(np.array(got), np.array(want))


def test_best_vote_takes_the_best_learners_and_weights(spark):
    df = folds(spark)
    names = ["logistic_regression", "decision_tree", "svc", "knn"]
    got = tune.best_vote(df, COLS, names, n_members=2)
    cv = {r.model: r.s for r in tune.baseline_all(df, COLS, names).groupBy("model").agg(F.avg("roc_auc").alias("s")).collect()}
    assert got["names"] == sorted(names, key=lambda n: (-cv[n], n))[:2]
    assert all(1 <= w <= 10 for w in got["weights"]) and got["fold_metrics"].count() == 3
    assert ml.predict(got["model"], df).count() == 150


def test_bounded_search_is_the_whole_grid(spark):
    rnd = random.Random(3)
    names = ["u", "v", "w"]
    rows = []
    for _ in range(3000):
        y = rnd.random() < 0.4
        rows.append((int(y), *[round(min(1.0, max(0.0, rnd.gauss(0.5 + s * (y - 0.5), 0.25))), 3) for s in (0.3, 0.1, 0.2)]))
    df = spark.createDataFrame(rows, "y int, u double, v double, w double")
    grid = sel.weight_grid(names, 1, 10)
    got = sel.best_weights(df, names, grid)
    y, x = np.array([r[0] for r in rows]), np.array([r[1:] for r in rows])

    def auc(ws):
        p = sum(w * x[:, i] for i, w in enumerate(ws)) / sum(ws)
        order = np.argsort(p, kind="stable")
        rank = np.empty(len(p))
        levels, inverse, count = np.unique(p, return_inverse=True, return_counts=True)
        rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
        n1 = y.sum()
        return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1)) + 0 * order[0]
    aucs = [auc(ws) for ws in grid]
    assert abs(max(aucs) - got["roc_auc"]) < 1e-12 and abs(aucs[got["combo"]] - max(aucs)) < 1e-12
    assert got["scored"] <= 50  # of 1,000
    lv = df.groupBy("y", *names).agg(F.count(F.lit(1)).alias("__w"))
    bounds = sel.auc_bounds(lv, names, np.array(grid[::50], float), 64)
    assert all(low <= a + 1e-12 and a <= high + 1e-12 for (low, high), a in zip(bounds, aucs[::50]))


def test_vote_bounds_do_not_depend_on_the_levels_added_up_together(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(rng.randint(0, 1), rng.random(), round(rng.random(), 1), rng.randint(1, 4)) for _ in range(300)]
    lv = spark.createDataFrame(rows, "y int, u double, v double, __w long").repartition(3)
    grid, got = np.array([[1, 1], [3, 1], [1, 9]], float), []
    for at_once in (7, 1 << 15):
        monkeypatch.setattr(sel, "LEVELS_AT_ONCE", at_once)
        got.append(sel.auc_bounds(lv, ["u", "v"], grid, 40))
    assert np.array_equal(*got) and (got[0][:, 0] <= got[0][:, 1]).all()
    assert not sel.auc_bounds(lv.limit(0), ["u", "v"], grid, 40).any()


def test_exact_votes_equal_the_scored_grid(spark, monkeypatch):
    """NULL scores come last, rows of a third label count for nothing, ties count half;
    neither the levels sorted together nor the vectors of a job matter."""
    rng = random.Random(4)
    rows = [(rng.choice([0, 1, 0, 1, 2]), rng.choice([None, *[i / 10 for i in range(11)]]), round(rng.random(), 1),
             rng.randint(1, 4)) for _ in range(400)]
    lv = spark.createDataFrame(rows, "y int, u double, v double, __w long").repartition(3)
    grid = sel.weight_grid(["u", "v"], 1, 4)
    edges = {"p_vote": [0.2, 0.4, 0.6]}
    want = {r.combo: r.roc_auc for r in sel._vote_aucs(lv, ["u", "v"], grid, 0, "y", edges).collect()}
    for at_once, dealt in ((1 << 18, 1 << 26), (50, 1)):
        monkeypatch.setattr(sel, "LEVELS_SORTED", at_once)
        monkeypatch.setattr(sel, "LEVELS_DEALT", dealt)
        some = grid if dealt > 1 else grid[:3]
        assert sel.exact_aucs(lv, ["u", "v"], some) == [want[i] for i in range(len(some))]
    bounds = sel.auc_bounds(lv, ["u", "v"], np.array(grid, float), 4096)
    assert all(low - 1e-12 <= want[i] <= high + 1e-12 for i, (low, high) in enumerate(bounds))
    assert sel.exact_aucs(lv.where("y = 1"), ["u", "v"], grid[:2]) == [None, None]
    assert sel.exact_aucs(lv.limit(0), ["u", "v"], grid[:2]) == []


def test_vectors_that_cannot_be_told_apart_do_not_add_to_the_memory_of_a_task(spark, monkeypatch):
    """Every score has both labels: all vectors have AUC 0.5, so bounds leave out none."""
    held, bound = [], sel._auc_bounds
    monkeypatch.setattr(sel, "CELLS", 64)
    monkeypatch.setattr(sel, "MOST_BINS", 32)
    monkeypatch.setattr(sel, "_auc_bounds", lambda lv, m, grid, bins, y: (
        held.append(len(grid) * bins), bound(lv, m, grid, bins, y))[1])
    df = spark.createDataFrame([(y, i / 10, (i * 7 % 11) / 10) for i in range(11) for y in (0, 1)], "y int, u double, v double")
    got = sel.best_weights(df, ["u", "v"], sel.weight_grid(["u", "v"], 1, 3))
    assert got == {"combo": 0, "weights": {"u": 1, "v": 1}, "roc_auc": 0.5, "scored": 9}
    assert max(held) <= 64 and len(held) > 2


def test_promotion_survives_crashes_and_races(spark, tmp_path):
    root = str(tmp_path / "reg")

    class Fails:
        def save(self, path):
            raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        rg.promote_if_better(spark, root, "r0", "m", 0.7, 0.5, Fails())
    model = ml.fit_pipeline(churn_frame(spark, 60), COLS, "decision_tree", {"max_depth": 2})
    assert rg.promote_if_better(spark, root, "r1", "m", 0.7, 0.5, model) == 1
    (tmp_path / "reg" / "model_versions" / "v00000002.json").touch()  # died while committing
    assert rg.promote_if_better(spark, root, "r2", "m", 0.8, 0.5, model) == 3
    assert rg.load_model(spark, root).transform(churn_frame(spark, 20)).count() == 20
    with ThreadPoolExecutor(2) as ex:  # the same score twice: one of them is no better than the other
        got = list(ex.map(lambda r: rg.promote_if_better(spark, root, r, "m", 0.9, 0.5, model), ["r3", "r4"]))
    assert sorted(got, key=str) == [4, None]
    assert sorted(r.version for r in rg.versions(spark, root).collect()) == [1, 3, 4]


def test_forest_rows_keep_their_nodes_and_trees_stay_the_same(spark):
    from tessera.operators import models as ml
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(400).selectExpr("cast(id % 7 as double) a", "cast(id * id % 31 as double) b", "1.0 + id % 2 weight",
                                     "cast(id * 13 % 5 < 2 as double) label")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    est = ml.build_estimator("random_forest", {"n_estimators": 6})
    assert est.getCacheNodeIds()
    assert est.fit(data).toDebugString.split("\n", 1)[1] == \
        est.copy({est.cacheNodeIds: False}).fit(data).toDebugString.split("\n", 1)[1]


def test_long_fits_start_first_and_members_keep_their_order(monkeypatch):
    from tessera.plans import tune

    class Fake:
        def numbers(self, without):
            return None

        def fit(self, without, name, params, reduction, seed):
            begun.append(name)
            return name, tuple(without)
    begun, base = [], [("knn", None), ("xgboost", None), ("svc", None), ("random_forest", None)]
    parts = [frozenset([0]), frozenset([1])]
    got = tune.fit_members(Fake(), base, parts, parallelism=1)
    assert begun == ["xgboost", "random_forest"] * 2 + ["knn", "svc"] * 2
    assert got == {p: [(n, tuple(p)) for n, _ in base] for p in parts}


def test_boosted_presets_are_fitted_side_by_side(spark, monkeypatch):
    import threading
    from tessera.operators import models as ml
    from tessera.plans.catalog import models as cat
    together = threading.Barrier(3, timeout=30)
    d = spark.createDataFrame([("a", 0, False), ("b", 1, True)], "customerID string, Churn int, is_test boolean")
    monkeypatch.setattr(cat, "_split", lambda *_: d)
    monkeypatch.setattr(ml, "fit_preparation", lambda *_: None)
    monkeypatch.setattr(ml, "fit_pipeline", lambda *a: (together.wait(), a[2])[1])
    monkeypatch.setattr(ml, "predict", lambda m, df, keep: df.selectExpr(*keep, f"'{m}' fitted"))
    rows = cat.ml4_boosted_trees(spark, "").collect()
    assert sorted((r.customerID, r.model, r.fitted) for r in rows) == sorted(("b", n, n) for n in ml.BOOSTED_DEFAULT_DEPTH)
