"""Catalog: models (ML1-ML9), kNN (ML6, with oracle), CV and search (TU1,
TU3, TU5-TU7, TU9) and batch scoring (SC1).  Models train on the
``features`` frame; rows-only checks except kNN."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tessera.operators import knn
from tessera.operators import models as ml
from tessera.operators import split as sp
from tessera.plans import tune
from tessera.plans.catalog import register
from tessera.plans.catalog.common import rnd
from tessera.plans.config import FEATURE_COLUMNS, ID_COLUMN, PCA_COMPONENTS, RFE_FEATURES, SEED, TARGET
from tessera.session import materialize, table
from tessera.sources import frames


def _split(spark, sf):
    return sp.stratified_holdout(frames.features(spark, sf), [ID_COLUMN], TARGET, 0.2, SEED)


def _fitted(spark, sf, name, params=None, reduction=None):
    """The split frame (written once) and a pipeline fitted on its training part."""
    d = materialize(_split(spark, sf))
    return d, ml.fit_pipeline(d.where(~F.col("is_test")), FEATURE_COLUMNS, name, params, reduction, TARGET, SEED)


def _fit_predict(spark, sf, name, params=None, reduction=None):
    d, model = _fitted(spark, sf, name, params, reduction)
    return ml.predict(model, d.where(F.col("is_test")), keep=[ID_COLUMN, TARGET])


@register("ml1_logistic_regression")
def ml1_logistic_regression(spark, sf):
    return _fit_predict(spark, sf, "logistic_regression")


@register("ml2_decision_tree")
def ml2_decision_tree(spark, sf):
    return _fit_predict(spark, sf, "decision_tree", {"max_depth": 7, "criterion": "entropy"})


@register("ml3_random_forest")
def ml3_random_forest(spark, sf):
    return _fit_predict(spark, sf, "random_forest", {"max_depth": 10, "max_features": 0.5})


@register("ml4_boosted_trees")
def ml4_boosted_trees(spark, sf):
    """The three boosted presets with their default number of trees, fitted side by side:
    a boosted fit is a chain of small jobs that alone leaves most cores idle."""
    d = materialize(_split(spark, sf))
    train, test = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    prep = ml.fit_preparation(train, FEATURE_COLUMNS)
    names = list(ml.BOOSTED_DEFAULT_DEPTH)
    with ThreadPoolExecutor(max_workers=len(names)) as ex:
        models = list(ex.map(lambda name: ml.fit_pipeline(train, FEATURE_COLUMNS, name, None, None, TARGET, SEED, prep),
                             names))
    out = None
    for name, model in zip(names, models):
        p = ml.predict(model, test, keep=[ID_COLUMN, TARGET]).withColumn("model", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


@register("ml4_histogram_boosting")
def ml4_histogram_boosting(spark, sf):
    """Histogram boosting with L1/L2 and leaf-wise growth: 40 trees of at most 20 leaves
    on 5 levels, fitted on the training part and scored on the holdout."""
    from tessera.operators import hist_boost
    d = materialize(_split(spark, sf))
    model = hist_boost.fit(d.where(~F.col("is_test")), FEATURE_COLUMNS, TARGET,
                           {"n_estimators": 40, "num_leaves": 20, "max_depth": 5, "reg_lambda": 1.0, "reg_alpha": 0.1,
                            "scale_pos_weight": 2.77}, seed=SEED)
    return model.predict(d.where(F.col("is_test")), [ID_COLUMN, TARGET])


@register("ml5_svc_platt")
def ml5_svc_platt(spark, sf):
    return _fit_predict(spark, sf, "svc")


@register("ml6_knn_learner")
def ml6_knn_learner(spark, sf):
    return _fit_predict(spark, sf, "knn", {"n_neighbors": 15, "weights": "distance"})


@register("ml7_linear_threshold")
def ml7_linear_threshold(spark, sf):
    return _fit_predict(spark, sf, "linear_threshold")


@register("ml8_pipeline_with_pca")
def ml8_pipeline_with_pca(spark, sf):
    return _fit_predict(spark, sf, "logistic_regression", None, {"method": "pca", "n_components": PCA_COMPONENTS})


@register("ml8_pipeline_with_lda")
def ml8_pipeline_with_lda(spark, sf):
    return _fit_predict(spark, sf, "logistic_regression", None, {"method": "lda"})


@register("ml8_pipeline_with_rfe")
def ml8_pipeline_with_rfe(spark, sf):
    return _fit_predict(spark, sf, "logistic_regression", None, {"method": "rfe", "n_features": RFE_FEATURES})


@register("ml9_tree_rules")
def ml9_tree_rules(spark, sf):
    _, model = _fitted(spark, sf, "decision_tree", {"max_depth": 4})
    info = ml.tree_rules(model.stages[-1], FEATURE_COLUMNS)
    return spark.createDataFrame(list(enumerate(info["rules"])), "line int, rule string").withColumns(
        {c: F.lit(info[c]) for c in ("depth", "num_nodes", "num_leaves")})


# ---- ML6 kNN ---------------------------------------------------------------------------------
def _dist_sql(metric):
    x = "CAST(a.embedding[i] AS DOUBLE)"
    y = "CAST(b.embedding[i] AS DOUBLE)"
    term = f"({x} - {y}) * ({x} - {y})" if metric == "euclidean" else f"abs({x} - {y})"
    s = f"list_reduce(list_transform(generate_series(1, len(a.embedding)), lambda i: {term}), lambda u, v: u + v)"
    return f"sqrt({s})" if metric == "euclidean" else s


def _knn_sql(k, metric, weights):
    score = "sum(1.0)" if weights == "uniform" else \
        "CASE WHEN max(CAST(dist = 0 AS INTEGER)) = 1 THEN sum(CAST(dist = 0 AS DOUBLE)) ELSE sum(1.0 / dist) END"
    return f"""
WITH pairs AS (SELECT a.vec_id AS qid, b.vec_id AS rid, b.label AS rlabel, {_dist_sql(metric)} AS dist
               FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, rid) AS rn FROM pairs)
       WHERE rn <= {k}),
z AS (SELECT qid, max(CAST(dist = 0 AS INTEGER)) AS has_zero FROM nn GROUP BY qid),
votes AS (SELECT nn.qid, rlabel, sum(CASE WHEN z.has_zero = 1 THEN CAST(dist = 0 AS DOUBLE)
                                          {'ELSE 1.0' if weights == 'uniform' else 'ELSE 1.0 / dist'} END) AS score
          FROM nn JOIN z ON nn.qid = z.qid GROUP BY nn.qid, rlabel),
pred AS (SELECT qid, rlabel AS pred FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, rlabel)
         AS r FROM votes) WHERE r = 1)
SELECT e.vec_id, e.label, p.pred FROM embeddings e JOIN pred p ON e.vec_id = p.qid"""


def _knn(spark, sf, k, metric, weights):
    e = table(spark, sf, "embeddings")
    pred = knn.knn_predict(knn.knn_neighbors(e, e, k, metric), weights)
    return e.select("vec_id", "label").join(pred.withColumnRenamed("qid", "vec_id"), "vec_id")


@register("ml6_knn_uniform_euclidean", _knn_sql(5, "euclidean", "uniform"))
def ml6_knn_uniform_euclidean(spark, sf):
    return _knn(spark, sf, 5, "euclidean", "uniform")


@register("ml6_knn_distance_manhattan", _knn_sql(7, "manhattan", "distance"))
def ml6_knn_distance_manhattan(spark, sf):
    return _knn(spark, sf, 7, "manhattan", "distance")


# ---- TU1 / TU3 / TU5 / TU6 / TU7 / TU9 ----------------------------------------------------------
def _cv_frame(spark, sf):
    # holdout and folds of the remaining rows from one hash rank (same seed)
    d = sp.stratified_holdout_kfold(frames.features(spark, sf), [ID_COLUMN], TARGET, 0.2, 5, SEED)
    return materialize(d.where(~F.col("is_test")).drop("is_test"))


@register("tu1_cross_validate")
def tu1_cross_validate(spark, sf):
    return tune.cross_validate(_cv_frame(spark, sf), FEATURE_COLUMNS, "logistic_regression")


@register("tu3_baseline_all")
def tu3_baseline_all(spark, sf):
    """All eight learners with default parameters over five folds."""
    return tune.baseline_all(_cv_frame(spark, sf), FEATURE_COLUMNS)


def _draws_frame(spark, rows):
    import json
    return spark.createDataFrame(
        [(r["draw"], json.dumps(r["params"], sort_keys=True), json.dumps(r.get("reduction")), r["objective"], r["failed"])
         for r in rows], "draw int, params string, reduction string, objective double, failed boolean")


@register("tu5_grid_search")
def tu5_grid_search(spark, sf):
    return _draws_frame(spark, tune.grid_search(_cv_frame(spark, sf), FEATURE_COLUMNS, "decision_tree"))


@register("tu6_random_search")
def tu6_random_search(spark, sf):
    return _draws_frame(spark, tune.random_search(_cv_frame(spark, sf), FEATURE_COLUMNS, "logistic_regression", seed=SEED))


@register("tu7_co_tune_reduction")
def tu7_co_tune_reduction(spark, sf):
    return _draws_frame(spark, tune.random_search(_cv_frame(spark, sf), FEATURE_COLUMNS, "logistic_regression",
                                                  seed=SEED, co_tune_reduction=True))


STACK_BASE = [("logistic_regression", {"C": 1.0}), ("svc", {"C": 1.0}), ("decision_tree", {"max_depth": 7})]


@register("tu9_stacking")
def tu9_stacking(spark, sf):
    """Nested stacking of three members; C of the meta-model is the best of 30 draws."""
    best = tune.stacking(_cv_frame(spark, sf), FEATURE_COLUMNS, STACK_BASE)
    rows = [(int(r["fold"]), float(r["roc_auc"] or 0.0), float(r["f1"])) for r in best["fold_metrics"]]
    return spark.createDataFrame(rows, "fold int, roc_auc double, f1 double").withColumn(
        "meta_C", F.lit(float(best["C"])))


@register("tu10_voting_model")
def tu10_voting_model(spark, sf):
    """All learners cross-validated, the best three voting with the best weights of
    their out-of-fold scores; logged, promoted, loaded back and scored on the holdout."""
    from tessera.plans import registry as rg
    from tessera.sources.io import scratch_dir
    d = materialize(_split(spark, sf))
    folds = materialize(sp.stratified_kfold(d.where(~F.col("is_test")).drop("is_test"), [ID_COLUMN], TARGET, 5, SEED))
    vote = tune.best_vote(folds, FEATURE_COLUMNS)
    root, cv = scratch_dir(spark, "registry"), tune.summarize(vote["fold_metrics"])
    rg.log_run(spark, root, "vote", "voting", {"members": vote["names"], "weights": vote["weights"]}, vote["fold_metrics"], cv)
    rg.promote_if_better(spark, root, "vote", "voting", cv["cv_roc_auc_mean"], cv["cv_f1_mean"], vote["model"])
    return ml.predict(rg.load_model(spark, root), d.where(F.col("is_test")), keep=[ID_COLUMN, TARGET])


# ---- SC1 ---------------------------------------------------------------------------------------
@register("sc1_score_batch")
def sc1_score_batch(spark, sf):
    """Fit on raw customers, promote, and score raw customers (without TotalCharges and
    PaymentMethod) with what the registry loads and nothing else."""
    from tessera.operators.monitor import score_batch
    from tessera.operators.raw_model import RawModel
    from tessera.plans import registry as rg
    from tessera.sources.io import scratch_dir
    raw, root = materialize(frames.subscribers(spark, sf)), scratch_dir(spark, "registry")
    model = RawModel.fit(sp.stratified_holdout(raw, [ID_COLUMN], TARGET, 0.2, SEED).where(~F.col("is_test")).drop("is_test"),
                         "decision_tree", {"max_depth": 7})
    rg.promote_if_better(spark, root, "sc1", "decision_tree", 0.0, 0.0, model)
    batch = raw.drop("TotalCharges", TARGET, "PaymentMethod")
    return score_batch(rg.load_model(spark, root), batch, keep=[ID_COLUMN])


# ---- FR2 / FR3 / FR4, LN7 --------------------------------------------------------------------
from tessera.operators import reduce as fr  # noqa: E402
from tessera.operators import metrics as me  # noqa: E402


@register("fr2_pca")
def fr2_pca(spark, sf):
    d = materialize(_split(spark, sf))
    proj = fr.fit_pca(d.where(~F.col("is_test")), FEATURE_COLUMNS, PCA_COMPONENTS)
    return proj.transform(d, keep=[ID_COLUMN])


@register("fr3_lda")
def fr3_lda(spark, sf):
    d = materialize(_split(spark, sf))
    proj = fr.fit_lda(d.where(~F.col("is_test")), FEATURE_COLUMNS, TARGET)
    return proj.transform(d, keep=[ID_COLUMN, TARGET])


@register("fr4_rfe")
def fr4_rfe(spark, sf):
    d = materialize(_split(spark, sf).where(~F.col("is_test")))
    keep = fr.rfe(d, FEATURE_COLUMNS, TARGET, RFE_FEATURES, ranker="ridge")
    return spark.createDataFrame(list(enumerate(keep)), "rank int, feature string")


_LN7_SCALED = ["tenure", "MonthlyCharges", "TotalCharges"]
_LN7_SQL = ("WITH q AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med_{c}, quantile_cont(CAST({c} AS DOUBLE), 0.75) "
    f"- quantile_cont(CAST({c} AS DOUBLE), 0.25) AS iqr_{c}" for c in _LN7_SCALED) + " FROM features),\n"
    "cats AS (SELECT v, row_number() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT contract_encoded AS v FROM features "
    "WHERE contract_encoded IS NOT NULL))\n"
    + "\nUNION ALL ".join(f"SELECT customerID, {i} AS position, round((CAST({c} AS DOUBLE) - med_{c}) / "
                          f"CASE WHEN iqr_{c} = 0 THEN 1.0 ELSE iqr_{c} END, 6) AS value FROM features, q"
                          for i, c in enumerate(_LN7_SCALED))
    + "\nUNION ALL SELECT customerID, CAST(r + 1 AS INTEGER), CAST((contract_encoded = v) IS TRUE AS DOUBLE) "
      "FROM features, cats WHERE r > 1"
      "\nUNION ALL SELECT customerID, CAST((SELECT count(*) + 2 FROM cats) AS INTEGER), CAST(SeniorCitizen AS DOUBLE) FROM features")


@register("ln7_column_transformer", _LN7_SQL, ("features",))
def ln7_column_transformer(spark, sf):
    from tessera.operators import learned as ln
    d = frames.features(spark, sf)
    scaler = ln.RobustScaler(["tenure", "MonthlyCharges", "TotalCharges"]).fit(d)
    onehot = ln.OneHotLearned(["contract_encoded"]).fit(d)
    out = ln.column_transformer(d, [(scaler, ["tenure", "MonthlyCharges", "TotalCharges"]),
                                    (onehot, ["contract_encoded"])], passthrough=["SeniorCitizen"])
    from pyspark.ml.functions import vector_to_array
    return out.select(ID_COLUMN, F.posexplode(vector_to_array("features")).alias("position", "value")) \
        .withColumn("value", rnd("value"))


# ---- ME9 / ME10 / ME12 / ME16 ----------------------------------------------------------------
@register("me9_feature_importance")
def me9_feature_importance(spark, sf):
    _, model = _fitted(spark, sf, "random_forest", {"max_depth": 10})
    return spark.createDataFrame(ml.feature_importance(model.stages[-1], FEATURE_COLUMNS),
                                 "feature string, importance double")


@register("me10_permutation_importance")
def me10_permutation_importance(spark, sf):
    d, model = _fitted(spark, sf, "logistic_regression")
    return me.permutation_importance(model, d.where(F.col("is_test")), FEATURE_COLUMNS, [ID_COLUMN], TARGET, repeats=5)


def _holdout_predictions(spark, sf):
    """split, y, p of the holdout and the training rows, written once."""
    d, model = _fitted(spark, sf, "decision_tree", {"max_depth": 5})
    pr = ml.predict(model, d, keep=["is_test", TARGET]).withColumnRenamed(TARGET, "y")
    return materialize(pr.withColumn("split", F.when(F.col("is_test"), "holdout").otherwise("train")).drop("is_test"))


def _by_split(pr, metric):
    parts = [metric(pr.where(F.col("split") == name)).withColumn("split", F.lit(name)) for name in ("holdout", "train")]
    return parts[0].unionByName(parts[1])


@register("me12_holdout_evaluation")
def me12_holdout_evaluation(spark, sf):
    return _by_split(_holdout_predictions(spark, sf), me.classification_metrics)


@register("me12_holdout_roc")
def me12_holdout_roc(spark, sf):
    """The ROC curves that belong to me12_holdout_evaluation."""
    return _by_split(_holdout_predictions(spark, sf), me.roc_curve)


@register("me16_coefficients_table")
def me16_coefficients_table(spark, sf):
    _, model = _fitted(spark, sf, "logistic_regression")
    lr = model.stages[-1]
    rows = [(f, float(c)) for f, c in zip(FEATURE_COLUMNS, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "feature string, coefficient double")


# ---- RG1 / RG5 ---------------------------------------------------------------------------------
@register("rg1_rg5_registry_roundtrip")
def rg1_rg5_registry_roundtrip(spark, sf):
    """Log a CV run, promote its model, load the current version back and score."""
    from tessera.plans import registry as rg
    from tessera.sources.io import scratch_dir
    root = scratch_dir(spark, "registry")
    cv = _cv_frame(spark, sf)
    fm = tune.cross_validate(cv, FEATURE_COLUMNS, "decision_tree", {"max_depth": 4})
    summary = tune.summarize(fm)
    rg.log_run(spark, root, "run-1", "decision_tree", {"max_depth": 4}, fm, summary)
    d, model = _fitted(spark, sf, "decision_tree", {"max_depth": 4})
    rg.promote_if_better(spark, root, "run-1", "decision_tree", summary["cv_roc_auc_mean"],
                         summary["cv_f1_mean"], model)
    loaded = rg.load_model(spark, root)
    return ml.predict(loaded, d.where(F.col("is_test")), keep=[ID_COLUMN, TARGET])
