"""Many logistic regressions at once, against Spark ML; models after an ingest."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import linear_many as lm
from tessera.operators import models as ml
from tessera.plans import tune

COLS = ["a", "b", "c", "d"]


def frame(spark, n=600, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 3, 0.5, 1] + [0, 5, -1, 0]
    x[:, 3] = x[:, 0] + 0.3 * x[:, 3]  # correlated
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] - 0.4 * x[:, 1] + 2 + 0.2 * x[:, 2])))).astype(int)
    rows = [(f"k{i}", *map(float, r), int(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    rows[7] = ("k7", None, *rows[7][2:])
    return spark.createDataFrame(rows, "customerID string, a double, b double, c double, d double, Churn int, fold int")


@pytest.mark.parametrize("c,penalty,weights", [(1.0, "l2", "balanced"), (0.01, "l2", None), (50.0, "l1", "balanced"),
                                               (0.05, "l1", None), (0.002, "l1", "balanced")])
def test_coefficients_agree_with_spark(spark, c, penalty, weights):
    df = frame(spark)
    numbers = ml.preparation_numbers(df, COLS, ["a", "b"])
    part = lm.Part((), None, *map(np.array, zip(*numbers)))
    n1 = df.where("Churn = 1").count()
    w = (600 / (2 * (600 - n1)), 600 / (2 * n1)) if weights else (1.0, 1.0)
    problem = lm.Problem(0, c, penalty == "l1", *w, np.eye(4), 600.0)
    lm.solve(lm.rows_table(df, COLS, "Churn", "fold", ["customerID"]), [part], [problem], 4)
    data = ml.preparation_stage(COLS, numbers).transform(df).withColumn("label", F.col("Churn").cast("double")) \
        .withColumn("weight", F.when(F.col("Churn") == 1, w[1]).otherwise(w[0]))
    data = VectorAssembler(inputCols=[f"__x{i}" for i in range(4)], outputCol="features").transform(data)
    want = LogisticRegression(regParam=1 / (c * 600), elasticNetParam=float(penalty == "l1"), standardization=False,
                              maxIter=2000, tol=1e-13, weightCol="weight").fit(data)
    assert np.allclose(problem.beta, want.coefficients.toArray(), atol=1e-4)
    assert abs(problem.intercept - want.intercept) < 1e-4
    if penalty == "l1":
        assert ((problem.beta == 0) == (np.abs(want.coefficients.toArray()) < 1e-7)).all()


def test_dependent_features_and_separable_classes_end(spark):
    rows = [(f"k{i}", float(i % 2), 1.0 - i % 2, float(i), 2.0 * i, int(i > 20), i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "customerID string, a double, b double, c double, d double, Churn int, fold int")
    fd = tune.as_folds(df, COLS)
    draws = [({"C": c, "penalty": p}, None) for c in (1e-4, 1.0, 1e4) for p in ("l1", "l2")]
    out = tune.linear_oof(fd, draws).toPandas()
    assert len(out) == 6 * 40 and out.p.between(0, 1).all()


def test_passes_do_not_grow_with_draws(spark, monkeypatch):
    fd, passes, table = tune.as_folds(frame(spark), COLS), [], lm._derivatives

    def counted(*args):
        passes[-1] += 1
        return table(*args)
    monkeypatch.setattr(lm, "_derivatives", counted)
    for n in (2, 20):
        passes.append(0)
        tune.linear_oof(fd, [({"C": 10.0 ** (i % 5 - 2), "penalty": "l2"}, None) for i in range(n)])
    assert passes[1] <= passes[0] + 6


@pytest.mark.parametrize("reduction", [{"method": "pca", "n_components": 2}, {"method": "lda"},
                                       {"method": "rfe", "n_features": 2}])
def test_reduced_draws_score_as_their_pipelines(spark, reduction):
    df = frame(spark)
    fd = tune.as_folds(df, COLS)
    got = {r.key.customerID: r.p for r in tune.linear_oof(fd, [({"C": 0.5}, None), ({"C": 0.5}, reduction)])
           .where("draw = 1").collect()}
    for f in fd.folds[:1]:
        model = fd.fit((f,), "logistic_regression", {"C": 0.5}, reduction)
        for r in ml.predict(model, fd.part(f), keep=["customerID"]).collect():
            assert abs(got[r.customerID] - r.p) < 2e-3  # Spark's fit ends at its own tolerance


def test_search_keeps_refused_draws_and_configured_numbers(spark):
    df = frame(spark)
    out = tune.random_search(df, COLS, "logistic_regression", space={"C": {"type": "float", "low": 0.5, "high": 2}})
    assert len(out) == 50 and all(0.5 < r["objective"] <= 1 and not r["failed"] for r in out)
    grid = tune.grid_search(df, COLS, "logistic_regression", {"C": {"type": "categorical", "choices": [-1.0, 1.0]}})
    assert [(r["params"]["C"], r["failed"]) for r in grid] == [(1.0, False), (-1.0, True)]
    assert grid[1]["objective"] == 0.0


def test_l1_steps_are_exact_where_features_depend_on_each_other():
    """Dummies that add up to the intercept, a copy and a near copy, and next to no penalty."""
    rng = np.random.default_rng(2)
    kind, v = rng.integers(0, 3, 2000), rng.normal(size=2000)
    z = np.column_stack([*(kind == k for k in range(3)), v, v, v + 1e-4 * rng.normal(size=2000), rng.normal(size=2000),
                         np.ones(2000)]).astype(float)
    h, g = z.T @ z / 8000, z.T @ (0.5 - (rng.random(2000) < 0.3 + 0.05 * kind)) / 2000
    for lam in (1e-2, 1e-5, 1e-9):
        x = lm._lasso(h, g, np.zeros(8), lam)
        r = g + h @ x
        off = np.where(x[:-1] != 0, r[:-1] + lam * np.sign(x[:-1]), np.maximum(np.abs(r[:-1]) - lam, 0))
        assert np.abs(off).max() < 1e-11 and abs(r[-1]) < 1e-11


def test_parts_share_sums_whatever_their_preparation(spark):
    """Solved together, parts with other fillings and scales have what each has alone."""
    df = frame(spark).withColumn("c", F.when(F.col("fold") != 1, F.col("c")))
    fd = tune.as_folds(df, COLS)
    parts = [lm.Part((str(f),), str(f), *map(np.array, zip(*ml.preparation_numbers(fd.train((f,)), COLS, ["a", "b"]))))
             for f in fd.folds]
    assert len({float(p.fill[2]) for p in parts}) > 1

    def solved(parts):
        problems = [lm.Problem(k, 20.0, l1, 1.5, 0.8, np.eye(4), 400.0) for k in range(len(parts)) for l1 in (False, True)]
        lm.solve(fd.rows(), parts, problems, 4)
        return [p.theta() for p in problems]
    assert np.allclose(solved(parts), [t for part in parts for t in solved([part])], atol=1e-6)


def test_models_work_after_an_ingest_and_an_observation(spark, tmp_path):
    """A session that has observed rows holds what cannot be serialised; models fitted
    in it must not carry the session into scoring."""
    from pyspark.sql import Observation

    from tessera.operators import metrics as me
    from tessera.sources import io
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("id,v\n1,2\n3,4\n")
    audit = io.ingest_csv(spark, str(raw), str(tmp_path / "out"), "id int, v int")
    assert audit["rows"] == 2 and [r.rows for r in audit["per_file"].collect()] == [2]
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    df = frame(spark, 150)
    small = {"random_forest": {"n_estimators": 3, "max_depth": 3}}
    for name in ml.SEARCH_SPACES:
        params = small.get(name, {"n_estimators": 3, "max_depth": 2} if name in ml.BOOSTED_DEFAULT_DEPTH else None)
        model = ml.fit_pipeline(df, COLS, name, params)
        assert ml.predict(model, df, keep=["customerID"]).where("p BETWEEN 0 AND 1").count() == 150
    model = ml.fit_pipeline(df, COLS, "logistic_regression")
    assert me.permutation_importance(model, df, COLS, ["customerID"], "Churn", repeats=2).count() == 4
    assert tune.cross_validate(df, COLS, "logistic_regression").count() == 3
