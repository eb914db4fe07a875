"""Learned operators, selection rules, kNN vs brute force, models, registry, streaming."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import knn
from tessera.operators import learned as ln
from tessera.operators import metrics as me
from tessera.operators import models as ml
from tessera.operators import reduce as fr
from tessera.plans import registry as rg
from tessera.plans import selection as sel
from tessera.plans import tune


def test_scaler_constant_column_unchanged(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    m = ln.StandardScaler(["a", "c"]).fit(df)
    out = m.transform(df).collect()
    assert [r.c for r in out] == [5.0, 5.0]
    assert abs(out[0].a + 0.7071067811865475) < 1e-12


def test_single_row_scaler(spark):
    df = spark.createDataFrame([(2.0,)], "a double")
    assert ln.StandardScaler(["a"]).fit(df).transform(df).first().a == 2.0


def test_group_median_all_null_group_and_unseen(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("c", 10.0)], "g string, x double")
    m = ln.GroupMedianImputer("x", "g").fit(train)
    test = spark.createDataFrame([("a", None), ("b", None), ("z", None), (None, None)], "g string, x double")
    out = {r.g: r.x for r in m.transform(test).collect()}
    assert out["a"] == 2.0 and out["b"] == 3.0 and out["z"] == 3.0 and out[None] == 3.0


def test_median_imputer_missing_column(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(KeyError):
        ln.MedianImputer(["b"]).fit(df)


def test_one_hot_learned_unknown(spark):
    train = spark.createDataFrame([("x",), ("y",), ("z",)], "c string")
    m = ln.OneHotLearned(["c"]).fit(train)
    out = m.transform(spark.createDataFrame([("q",), ("z",)], "c string")).collect()
    assert m.output_columns() == ["c_y", "c_z"]
    assert (out[0].c_y, out[0].c_z, out[1].c_z) == (0, 0, 1)


def test_qcut_dedup(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]], "t double")
    m = ln.QuantileBinner("t", 4).fit(df)
    exp = pd.qcut(pd.Series([0, 0, 0, 0, 1, 2, 3, 4, 5, 6]), 4, labels=False, duplicates="drop")
    got = [r.bin for r in m.transform(df).collect()]
    assert got == exp.astype(float).tolist()


def test_anova_matches_formula(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    x = rng.normal(size=400) + y
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    got = fr.anova_f(df, ["x"], "y").first().f_value
    g = [x[y == c] for c in (0, 1)]
    grand = x.mean()
    ssb = sum(len(a) * (a.mean() - grand) ** 2 for a in g)
    ssw = sum(((a - a.mean()) ** 2).sum() for a in g)
    assert abs(got - ssb / (ssw / (len(x) - 2))) < 1e-6


def test_pca_lda_shapes(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)), columns=list("abcd"))
    pdf["y"] = (pdf.a + pdf.b > 0).astype(int)
    df = spark.createDataFrame(pdf)
    p = fr.fit_pca(df, list("abcd"), 10)
    assert p.weights.shape == (4, 3)
    vals = np.sort(np.linalg.eigvalsh(np.cov(pdf[list("abcd")].to_numpy().T)))[::-1]
    assert np.allclose(p.explained, vals[:3] / vals.sum())
    lda = fr.fit_lda(df, list("abcd"), "y")
    assert lda.output_columns() == ["ld_1"]
    out = lda.transform(df, keep=["y"]).toPandas()
    assert abs(np.corrcoef(out.ld_1, out.y)[0, 1]) > 0.5


def test_knn_matches_bruteforce(spark):
    rng = np.random.default_rng(5)
    n, d = 120, 6
    vecs = rng.normal(size=(n, d)).astype(np.float32)
    labels = rng.integers(0, 3, n)
    pdf = pd.DataFrame({"vec_id": np.arange(n), "embedding": list(vecs), "label": labels})
    df = spark.createDataFrame(pdf, "vec_id long, embedding array<float>, label int")
    nb = knn.knn_neighbors(df, df, 5, "euclidean", blocks=3)
    pred = {r.qid: r.pred for r in knn.knn_predict(nb).collect()}
    v = vecs.astype(np.float64)
    for i in range(n):
        dist = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        dist[i] = np.inf
        idx = np.lexsort((np.arange(n), dist))[:5]
        counts = np.bincount(labels[idx], minlength=3)
        assert pred[i] == int(np.argmax(counts))


def test_knn_small_queries_against_many_references(spark, monkeypatch):
    """Separate block counts per side (1 query block, 8 reference blocks)
    give the same neighbours as brute force."""
    monkeypatch.setattr(knn, "ROWS_PER_BLOCK", 16)
    rng = np.random.default_rng(7)
    nr, nq, d = 120, 10, 3
    rv = rng.integers(0, 4, (nr, d)).astype(np.float32)
    qv = rng.integers(0, 4, (nq, d)).astype(np.float32)
    refs = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(nr), "embedding": list(rv),
                                               "label": rng.integers(0, 2, nr)}),
                                 "vec_id long, embedding array<float>, label int")
    qs = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(1000, 1000 + nq), "embedding": list(qv),
                                             "label": np.zeros(nq, dtype=int)}),
                               "vec_id long, embedding array<float>, label int")
    got = sorted((r.qid, r.rank, r.rid) for r in knn.knn_neighbors(qs, refs, 4, "manhattan").collect())
    want = []
    for i in range(nq):
        dist = np.abs(rv.astype(np.float64) - qv[i]).sum(axis=1)
        want += [(1000 + i, j + 1, int(r)) for j, r in enumerate(np.lexsort((np.arange(nr), dist))[:4])]
    assert got == sorted(want)


def _vectors(spark, first, v, labels=None):
    return spark.createDataFrame(
        [(first + i, [float(x) for x in row], int(labels[i]) if labels is not None else 0) for i, row in enumerate(v)],
        "vec_id long, embedding array<double>, label int")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_cells_prune_clustered_vectors(spark, metric, monkeypatch):
    """Clusters with ties and a hot group of equal vectors: brute force's neighbours
    from under 30 % of the pairs, over many cells, the hot cell in several blocks."""
    monkeypatch.setattr(knn, "ROWS_PER_BLOCK", 64)
    rng = np.random.default_rng(3)
    centres = rng.integers(-50, 50, (12, 8))
    v = (centres[rng.integers(0, 12, 400)] + rng.integers(-1, 2, (400, 8))).astype(float)
    v = np.vstack([v, np.tile(centres[0], (200, 1))])
    df = _vectors(spark, 0, v, rng.integers(0, 2, len(v)))
    plan = knn.plan_cells(df, df, 6, metric)
    assert len(plan.cells) > 8 and max(r for _, _, r in plan.cells) > 64
    assert plan.pairs < 0.3 * len(v) ** 2
    got = sorted((r.qid, r.rank, r.rid) for r in knn.knn_neighbors(df, df, 6, metric).collect())
    want = []
    for i in range(len(v)):
        diff = v - v[i]
        dist = np.sqrt((diff * diff).sum(1)) if metric == "euclidean" else np.abs(diff).sum(1)
        dist[i] = np.inf
        want += [(i, j + 1, int(r)) for j, r in enumerate(np.lexsort((np.arange(len(v)), dist))[:6])]
    assert got == sorted(want)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_copies_of_a_query_stay_few_where_nothing_is_pruned(spark, metric):
    """Random vectors of 32 dimensions, some ids repeated: brute force's neighbours, and a
    query is copied to a handful of cells, not to nearly every one of √n."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(700, 32))
    ids = [*range(690), *[5] * 10]
    df = spark.createDataFrame([(i, row.tolist(), 0) for i, row in zip(ids, v)], "vec_id long, embedding array<double>, label int")
    plan = knn.plan_cells(df, df, 4, metric)
    assert plan.queries.agg(F.max(F.size("cells"))).first()[0] <= max(8, spark.sparkContext.defaultParallelism)
    got = sorted((r.qid, r.rid) for r in knn.knn_neighbors(df.where("vec_id <> 5"), df, 4, metric).collect())
    want = []
    for i in set(range(690)) - {5}:
        diff = v - v[i]
        dist = np.sqrt((diff * diff).sum(1)) if metric == "euclidean" else np.abs(diff).sum(1)
        dist[i] = np.inf
        want += [(i, ids[j]) for j in np.argsort(dist)[:4]]
    assert got == sorted(want)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_estimates_lose_no_neighbour_far_from_the_origin(metric):
    """Differences near or below the error of the estimates: the full sort decides."""
    rng = np.random.default_rng(4)
    for offset, scale in ((1e6, 1e-3), (1e160, 1e150), (0.0, 1e-30), (1.0, 1e-12)):
        q, r = (offset + scale * rng.normal(size=(n, 5)) for n in (9, 300))
        out = knn._block_topk(3, metric, False)(pd.DataFrame({"id": range(9), "vec": list(q)}), pd.DataFrame(
            {"id": range(300), "vec": list(r), "label": np.zeros(300, int)}))
        d = knn._distances(q, r, metric)
        want = [(i, j) for i in range(9) for j in np.lexsort((np.arange(300), d[i]))[:3] if np.isfinite(d[i, j])]
        assert list(zip(out.qid, out.rid)) == want


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_boxes_leave_out_most_pairs_of_mixed_features(spark, metric, monkeypatch):
    """Rows of two-valued columns and two scaled numbers, as the modelling frame has, lie too evenly
    for distances to pivots; boxes leave out most pairs, and brute force's neighbours
    come out, ties included, also where a query's own cell has too few references."""
    monkeypatch.setattr(knn, "ROWS_PER_BLOCK", 50)
    rng = np.random.default_rng(6)
    v = np.column_stack([2 * rng.integers(0, 2, (1600, 5)), rng.normal(size=(1600, 2)).round(1)]).astype(float)
    q, r, k = v[:400], v[400:], 5
    refs, queries = _vectors(spark, 0, r, rng.integers(0, 2, len(r))), _vectors(spark, 5000, q)
    plan = knn.plan_cells(queries, refs, k, metric, exclude_self=False)
    assert plan.pairs < 0.2 * len(q) * len(r)
    for kk, some in ((k, q), (70, q[:40])):
        got = sorted((x.qid, x["rank"], x.rid) for x in knn.knn_neighbors(
            queries.where(F.col("vec_id") < 5000 + len(some)), refs, kk, metric, exclude_self=False).collect())
        d = knn._distances(some, r, metric)
        assert got == [(5000 + i, j + 1, int(x)) for i in range(len(some))
                       for j, x in enumerate(np.lexsort((np.arange(len(r)), d[i]))[:kk])]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_leaves_of_a_group(metric, monkeypatch):
    """Inside a group most references are left out by their leaf's box; neighbours, ties and
    the rows of a query's own id are those of a full sort, whatever the numbers' size."""
    monkeypatch.setattr(knn, "ROWS_PER_LEAF", 16)
    rng = np.random.default_rng(9)
    for offset, scale in ((0.0, 1.0), (1e6, 1e-3), (1e160, 1e150), (0.0, 1e-160)):
        v = offset + scale * np.vstack([rng.integers(-9, 10, (600, 3)), np.ones((50, 3))])
        ids, bound = rng.permutation(len(v)), np.full(100, np.inf)
        _, pieces = knn._pieces(v[:100], v, ids[:100], ids, bound, 4, metric, True)
        if scale == 1.0:
            assert sum(len(a) * len(b) for a, b in pieces) < 0.4 * 100 * len(v)
        out = knn._block_topk(4, metric, True)(
            pd.DataFrame({"id": ids[:100], "vec": list(v[:100])}),
            pd.DataFrame({"id": ids, "vec": list(v), "label": np.zeros(len(v), int)}))
        with np.errstate(over="ignore"):
            d = knn._distances(v[:100], v, metric)
        d[np.arange(100), np.arange(100)] = np.inf
        assert list(zip(out.qid, out.rid)) == [(ids[i], ids[j]) for i in range(100)
                                               for j in np.lexsort((ids, d[i]))[:4] if np.isfinite(d[i, j])]


def test_knn_awkward_rows(spark):
    """Null, NaN and infinite vectors have no neighbours and are nobody's; few
    references are all returned; none give none."""
    refs = spark.createDataFrame([(1, [0.0, 0.0], 1), (2, [3.0, 4.0], 0), (3, None, 1), (4, [float("nan"), 0.0], 1),
                                  (5, [float("inf"), 0.0], 1), (6, [None, 1.0], 1)],
                                 "vec_id long, embedding array<double>, label int")
    got = knn.knn_neighbors(refs, refs, 5, "euclidean").collect()
    assert sorted((r.qid, r.rid, r.dist) for r in got) == [(1, 2, 5.0), (2, 1, 5.0)]
    assert knn.knn_neighbors(refs, refs.limit(0), 5).count() == 0
    assert knn.knn_neighbors(refs.limit(0), refs, 5).count() == 0


def test_knn_block_topk_ties_match_sort():
    """Per-block top-k (partition + candidate sort) equals a full sort by
    (distance, reference id), including ties at the cut and the self row."""
    rng = np.random.default_rng(11)
    for _ in range(60):
        nq, nr, dim, k = (int(x) for x in (rng.integers(1, 25), rng.integers(1, 25),
                                           rng.integers(1, 4), rng.integers(1, 8)))
        qv = rng.integers(0, 3, (nq, dim)).astype(float)
        rv = rng.integers(0, 3, (nr, dim)).astype(float)
        qid, rid = rng.permutation(50)[:nq], rng.permutation(50)[:nr]
        qdf = pd.DataFrame({"id": qid, "vec": list(qv)})
        rdf = pd.DataFrame({"id": rid, "vec": list(rv), "label": rng.integers(0, 2, nr)})
        for metric in ("euclidean", "manhattan"):
            out = knn._block_topk(k, metric, True)(qdf, rdf)
            want = []
            for i in range(nq):
                diff = qv[i] - rv
                dist = (np.sqrt((diff * diff).sum(axis=1)) if metric == "euclidean"
                        else np.abs(diff).sum(axis=1))
                dist[rid == qid[i]] = np.inf
                order = [j for j in np.lexsort((rid, dist))[:k] if np.isfinite(dist[j])]
                want += [(qid[i], rid[j]) for j in order]
            assert list(zip(out.qid, out.rid)) == want


def test_expand_grid():
    g = sel.expand_grid({"a": {"type": "categorical", "choices": ["x", "y"]},
                         "b": {"type": "int", "low": 1, "high": 3},
                         "c": {"type": "log_float", "low": 1e-2, "high": 1e2}})
    assert len(g) == 12 and {round(x["c"], 6) for x in g} == {0.01, 1.0, 100.0} and {x["b"] for x in g} == {1, 3}
    with pytest.raises(ValueError):
        sel.expand_grid({"a": {"type": "odd", "low": 1, "high": 2}})


def test_promotion_sequence_is_the_action(spark, tmp_path):
    """Each run meets the version current at its time, also along chains of near ties."""
    scores = [(0.8, 0.5), (0.8 - 9e-7, 0.6), (0.8 - 1.5e-6, 0.7), (0.7, 0.9), (0.81, 0.1), (0.81, 0.1)]
    runs = spark.createDataFrame([(i, a, f) for i, (a, f) in enumerate(scores)],
                                 "run int, cv_roc_auc_mean double, cv_f1_mean double")
    got = [r.version for r in rg.promotion_sequence(runs).orderBy("run").collect()]
    root = str(tmp_path / "seq")
    assert got == [rg.promote_if_better(spark, root, f"r{i}", "m", a, f) for i, (a, f) in enumerate(scores)]
    assert got == [1, 2, 3, None, 4, None]


def test_registry_errors_rise(spark, tmp_path):
    root = tmp_path / "bad"
    assert rg.promote_if_better(spark, str(root), "r1", "m", 0.8, 0.5) == 1
    for f in (root / "model_versions").glob("v*.json"):
        f.write_bytes(b"{broken")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        rg.promote_if_better(spark, str(root), "r2", "m", 0.1, 0.1)


def test_promotion_rule(spark):
    runs = spark.createDataFrame([(1, 0.80, 0.5), (2, 0.79, 0.9), (3, 0.80 + 5e-7, 0.6), (4, 0.85, 0.1)],
                                 "run int, cv_roc_auc_mean double, cv_f1_mean double")
    out = rg.promotion_sequence(runs).orderBy("run").collect()
    assert [r.promoted for r in out] == [True, False, True, True]
    assert [r.version for r in out] == [1, None, 2, 3]


def test_registry_roundtrip(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml import Pipeline
    root = str(tmp_path / "reg")
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.2, 0.0), (0.9, 1.0)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression()]).fit(df)
    rg.log_run(spark, root, "r1", "lr", {"C": 1.0}, summary={"cv_roc_auc_mean": 0.8})
    assert rg.promote_if_better(spark, root, "r1", "lr", 0.8, 0.5, model) == 1
    assert rg.promote_if_better(spark, root, "r2", "lr", 0.7, 0.9, model) is None
    assert rg.promote_if_better(spark, root, "r3", "lr", 0.7, 0.9, model, force=True) == 2
    loaded = rg.load_model(spark, root)
    assert loaded.transform(df).count() == 4


def churn_frame(spark, n=300, seed=6, holes=False):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n), "tenure": rng.normal(50, 20, n)})
    pdf["Churn"] = (pdf.a + 0.02 * (pdf.tenure - 50) + 0.5 * rng.normal(size=n) > 0).astype(int)
    if holes:
        pdf.loc[::7, "a"] = None
        pdf.loc[::11, "tenure"] = None
    pdf["customerID"] = [f"c{i}" for i in range(n)]
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                 "a double, b double, tenure double, Churn int, customerID string")


COLS = ["a", "b", "tenure"]


def test_models_fit_and_cv(spark):
    from tessera.operators.split import stratified_kfold
    from tessera.session import materialize
    f = tune.Folds(materialize(stratified_kfold(churn_frame(spark), ["customerID"], "Churn", 3, 1)), COLS)
    fm = tune.cross_validate(f, COLS, "logistic_regression", parallelism=2)
    assert fm.count() == 3 and fm.agg(F.avg("roc_auc")).first()[0] > 0.8
    draws = tune.random_search(f, COLS, "decision_tree", 2, 1)
    assert len(draws) == 2 and not any(d["failed"] for d in draws)
    best, model = tune.refit_best(f.df, COLS, "decision_tree", draws)
    assert ml.predict(model, f.df).count() == 300 and best in draws
    refused = tune.random_search(f, COLS, "decision_tree", 1, 1, fixed={"max_depth": 99})
    assert refused[0]["failed"] and refused[0]["objective"] == 0.0


@pytest.mark.parametrize("name", ["logistic_regression", "svc", "decision_tree", "knn", "lightgbm"])
def test_learners_train_with_nulls_and_reload(spark, tmp_path, name):
    """A NULL feature is imputed; the saved model scores raw rows as the fitted one."""
    df = churn_frame(spark, holes=True)
    params = {"n_estimators": 5} if name == "lightgbm" else {"max_depth": 4} if name == "decision_tree" else None
    model = ml.fit_pipeline(df, COLS, name, params)
    p = {r.customerID: r.p for r in ml.predict(model, df, ["customerID"]).collect()}
    root = str(tmp_path / "reg")
    assert rg.promote_if_better(spark, root, "r", name, 0.8, 0.5, model) == 1
    again = {r.customerID: r.p for r in ml.predict(rg.load_model(spark, root), df, ["customerID"]).collect()}
    assert len(p) == 300 and all(abs(p[k] - again[k]) < 1e-12 and 0 <= p[k] <= 1 for k in p)


def test_preparation_imputes_and_scales(spark):
    df = churn_frame(spark, holes=True)
    out = ml.fit_preparation(df, COLS).transform(df).toPandas()
    med = df.toPandas().median(numeric_only=True)
    assert np.allclose(out["__x0"], out["a"].fillna(med["a"]))           # not a scaled column
    filled = out["tenure"].fillna(med["tenure"])
    assert np.allclose(out["__x2"], (filled - filled.mean()) / filled.std(ddof=1))


@pytest.mark.parametrize("reduction,width", [({"method": "pca", "n_components": 2}, 2), ({"method": "lda"}, 1),
                                             ({"method": "rfe", "n_features": 2}, 2), (None, 3)])
def test_reductions(spark, reduction, width):
    df = churn_frame(spark)
    model = ml.fit_pipeline(df, COLS, "logistic_regression", None, reduction)
    assert len(model.stages[-1].coefficients) == width
    auc = me.roc_auc(ml.predict(model, df, ["Churn"]).withColumnRenamed("Churn", "y")).first().auc
    assert auc > (0.6 if reduction and reduction["method"] == "pca" else 0.8)


def test_unknown_names_raise_before_any_job(spark):
    df = churn_frame(spark, 20)
    for name, red in (("nonsense", None), ("svc", {"method": "nonsense"})):
        with pytest.raises(ValueError):
            ml.fit_pipeline(df, COLS, name, None, red)
        with pytest.raises(ValueError):
            tune.cross_validate(df, COLS, name, None, red)
    with pytest.raises(ValueError):
        ml.fit_pipeline(df, COLS, "random_forest", {"max_depth": 31})


def test_stacking_does_not_leak(spark):
    """With permuted labels the stack is no better than chance; with real ones it predicts."""
    from tessera.operators.split import stratified_kfold
    base = [("logistic_regression", {}), ("decision_tree", {"max_depth": 8})]
    df = churn_frame(spark, 240)
    rng = np.random.default_rng(9)
    noise = spark.createDataFrame([(f"c{i}", int(v)) for i, v in enumerate(rng.integers(0, 2, 240))], "customerID string, z int")
    for frame, low, high in ((df, 0.75, 1.0), (df.join(noise, "customerID").drop("Churn").withColumnRenamed("z", "Churn"), 0.3, 0.64)):
        f = stratified_kfold(frame, ["customerID"], "Churn", 3, 1)
        best = tune.stacking(f, COLS, base, meta_c=(1.0,))
        assert low < best["objective"] < high
    assert {r.yhat for r in ml.predict(best["model"], df.drop("Churn"), ["customerID"]).collect()} <= {0, 1}


def test_holdout_evaluation_has_both_curves(spark, monkeypatch):
    from tessera.plans.catalog import load_all
    load_all()
    from tessera.plans.catalog import models as cat
    pred = spark.createDataFrame([("holdout", 1, 0.9), ("holdout", 0, 0.9), ("holdout", 0, 0.1),
                                  ("train", 1, 0.7), ("train", 0, 0.2)], "split string, y int, p double")
    monkeypatch.setattr(cat, "_holdout_predictions", lambda spark, sf: pred)
    got = sorted(tuple(r) for r in cat.me12_holdout_roc(spark, "").select("split", "threshold", "fpr", "tpr").collect())
    assert got == [("holdout", 0.1, 1.0, 1.0), ("holdout", 0.9, 0.5, 1.0), ("train", 0.2, 1.0, 1.0), ("train", 0.7, 0.0, 1.0)]
    rates = {r.split: r.roc_auc for r in cat.me12_holdout_evaluation(spark, "").collect()}
    assert rates == {"holdout": 0.75, "train": 1.0}


def test_voting_search_finds_ratios_above_three(spark):
    import random
    from tessera.plans.catalog import load_all
    load_all()
    from tessera.plans.catalog import tuning
    assert len(set(tuning.GRID)) == 1000 and all(1 <= w <= 10 for ws in tuning.GRID for w in ws)
    rnd = random.Random(5)
    rows = [tuple(rnd.randrange(101) / 100 for _ in tuning.VOTE_MODELS) for _ in range(300)]
    rows = [(int(10 * a + b + 6 * c > 8.5), a, b, c) for a, b, c in rows]
    df = spark.createDataFrame(rows, "y int, " + ", ".join(f"{m} double" for m in tuning.VOTE_MODELS))
    got = {r.combo: r.roc_auc for r in sel.soft_voting_search(df, tuning.VOTE_MODELS, tuning.GRID, per_batch=400).collect()}
    assert sorted(got) == list(range(1000))
    for k in range(0, 1000, 37):
        u, v, w = tuning.GRID[k]
        p = [(y, (u * a + v * b + w * c) / (u + v + w)) for y, a, b, c in rows]
        pairs = [(a, b) for y, a in p if y for z, b in p if not z]
        assert abs(got[k] - sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)) < 1e-9
    small = max(v for k, v in got.items() if max(tuning.GRID[k]) <= 3)
    assert got[tuning.GRID.index((10, 1, 6))] > 0.99999 > small


def test_voting_is_the_weighted_mean(spark):
    from tessera.operators.split import stratified_kfold
    f = stratified_kfold(churn_frame(spark, 120), ["customerID"], "Churn", 2, 1)
    vote = tune.fit_voting(f, COLS, [("logistic_regression", {}), ("decision_tree", {"max_depth": 3})], [3, 1])
    a, b = ({r.customerID: r.p for r in ml.predict(m, f, ["customerID"]).collect()} for m in vote.members)
    for r in ml.predict(vote, f, ["customerID"]).collect():
        assert abs(r.p - (3 * a[r.customerID] + b[r.customerID]) / 4) < 1e-12


def test_tree_rules(spark):
    df = spark.createDataFrame([(float(i % 10), float(i % 10 > 4)) for i in range(100)], "x double, Churn double")
    model = ml.fit_pipeline(df, ["x"], "decision_tree", {"max_depth": 2}, None, "Churn")
    info = ml.tree_rules(model.stages[-1], ["x"])
    assert info["depth"] == 1 and info["num_leaves"] == 2
    assert [line.strip().split(" ")[0] for line in info["rules"]] == ["If", "Predict:", "Else", "Predict:"]
    cut = ml.tree_rules(model.stages[-1], ["x"], 0)
    assert cut["rules"] == ["  ... truncated: 4 lines"]


def test_csv_header_is_checked(spark, tmp_path):
    from tessera.sources import io
    schema = "id bigint, name string"
    for case, text in (("good", "id,name\n1,a\n"), ("swapped", "name,id\n2,1\n"), ("other", "id,other\n1,a\n")):
        d = tmp_path / case
        d.mkdir()
        (d / "part.csv").write_text(text)
        (d / "rest.csv").write_text("id,name\n7,z\n8,y\n")
        if case == "good":
            audit = io.ingest_csv(spark, str(d), str(tmp_path / "out"), schema, required_columns=["id", "name"])
            assert (audit["rows"], audit["files"]) == (3, 2)
            assert {r.file_name: r.rows for r in audit["per_file"].collect()} == {"part.csv": 1, "rest.csv": 2}
        else:
            with pytest.raises(Exception):
                io.ingest_csv(spark, str(d), str(tmp_path / f"out-{case}"), schema, required_columns=["id", "name"])


def test_failed_write_does_not_count(spark, tmp_path):
    from tessera.sources import io
    p = tmp_path / "out"
    (p / "_temporary" / "0").mkdir(parents=True)
    assert not io.exists_nonempty(spark, str(p))
    assert io.write_once(spark, spark.range(3), str(p)) and not io.write_once(spark, spark.range(9), str(p))
    assert spark.read.parquet(str(p)).count() == 3


def test_rfe_keeps_the_informative_features(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(1e6, 1, size=(400, 5))  # large means must not matter
    y = (x[:, 1] - 1e6 + 2 * (x[:, 3] - 1e6) > 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({**{f"f{i}": x[:, i] for i in range(5)}, "y": y}))
    assert fr.rfe(df, [f"f{i}" for i in range(5)], "y", 2) == ["f1", "f3"]
    assert set(fr.rfe(df, [f"f{i}" for i in range(5)], "y", 2, ranker="forest")) == {"f1", "f3"}


def test_permutation_importance_finds_the_signal(spark):
    df = churn_frame(spark, 200)
    model = ml.fit_pipeline(df, COLS, "logistic_regression")
    got = {r.feature: r.importance for r in me.permutation_importance(
        model, df, COLS, ["customerID"], "Churn", repeats=3).collect()}
    assert set(got) == set(COLS) and got["a"] > 0.15 > abs(got["b"])


def test_permutation_importance_broadcasts_no_rows(spark, monkeypatch):
    """The values of all rows and features are neither broadcast nor exploded on both sides."""
    from tessera.functions import prefix
    df, seen = churn_frame(spark, 200), []
    model = ml.fit_pipeline(df, COLS, "logistic_regression")
    monkeypatch.setattr(me, "materialize", lambda d, *a: seen.append(d) or materialize(d, *a))
    from tessera.session import materialize
    want = me.permutation_importance(model, df, COLS, ["customerID"], "Churn", repeats=2)
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in seen]
    scored = next(p for p in plans if "Generate" in p)
    assert "BroadcastHashJoin" not in scored and scored.count("Join") == 1
    assert want.count() == len(COLS) and prefix.BUCKET not in want.columns


def test_many_categories_and_classes(spark, monkeypatch):
    from tessera.functions.features import learn_categories
    df = spark.range(2400).selectExpr("CAST(id % 1200 AS STRING) AS c", "CAST(id % 1200 AS INT) AS y")
    assert len(learn_categories(df, "c")) == 1200
    out = ln.with_class_weight(df, "y").agg(F.min("weight"), F.max("weight"), F.count("weight")).first()
    assert tuple(out) == (1.0, 1.0, 2400)


def test_streaming_windows(spark):
    from tessera.sources.io import scratch_dir
    from tessera.streaming.monitor import stream_monitor
    from tessera.session import table
    sf = "/root/testdata/sf0.001"
    out = stream_monitor(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema,
                         scratch_dir(spark, "t-sink"), scratch_dir(spark, "t-ck"))
    batch = table(spark, sf, "events").agg(F.count("*")).first()[0]
    assert 0 < out.agg(F.sum("n")).first()[0] <= batch


def test_balanced_weight_column_matches_weight_table(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "y int")
    table = {r.y: r.weight for r in ln.balanced_weights(df, "y").collect()}
    got = sorted((r.y if r.y is not None else -1, r.weight)
                 for r in ln.with_class_weight(df, "y").collect())
    assert table[0] == 5 / 9 and table[1] == 5 / 3
    assert got == [(-1, None), (0, table[0]), (0, table[0]), (0, table[0]), (1, table[1])]


def test_group_median_one_pass_fit(spark):
    pdf = pd.DataFrame({"g": ["a", "a", "a", "b", "b", None, None, "c"],
                        "x": [1.0, 2.0, 10.0, 4.0, None, 7.0, None, None]})
    df = spark.createDataFrame(pdf, "g string, x double")
    m = ln.GroupMedianImputer("x", "g").fit(df)
    assert m.global_median == float(np.median([1.0, 2.0, 10.0, 4.0, 7.0]))
    assert {r.g: r.median for r in m.params().collect()} == {"a": 2.0, "b": 4.0}
    out = sorted(m.transform(df).select("g", "x").collect(), key=lambda r: (str(r.g), r.x))
    filled = {(r.g, r.x) for r in out}
    assert ("b", 4.0) in filled and (None, 4.0) in filled and ("c", 4.0) in filled
    assert len(out) == 8
