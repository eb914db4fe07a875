"""Models (ML1-ML9) as Spark ML estimators.

A fixed table maps every configured learner to a Spark ML estimator; its
parameters are translated from the original (scikit-learn style) names.
``fit_pipeline`` (ML8) imputes NULL features with training medians, scales the
configured columns, reduces (none, PCA, LDA, RFE) and fits the learner.  Every
fitted step is a plain Spark ML stage (the learned numbers are literals of a
``SQLTransformer``), so the whole ``PipelineModel`` saves, loads and scores raw
feature rows.  P(class 1) is extracted JVM-side with ``vector_to_array``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES, RAW, LABEL, WEIGHT = "features", "__raw", "label", "weight"
SVC_ITERATIONS = 100  # of an SVC that configures none (its loss is not smooth: the tolerance is rarely met)
MAX_DEPTH = 30  # the deepest tree that Spark ML grows; the default, as the original sets no bound

# FIXED VALUES: search spaces of the configured learners, in the original
# parameter names (low/high/choices as configured).
SEARCH_SPACES: dict = {
    "logistic_regression": {"C": {"type": "log_float", "low": 1e-4, "high": 1e4},
                            "penalty": {"type": "categorical", "choices": ["l2", "l1"]}},
    "decision_tree": {"max_depth": {"type": "int", "low": 2, "high": 15},
                      "min_samples_leaf": {"type": "int", "low": 1, "high": 20},
                      "criterion": {"type": "categorical", "choices": ["gini", "entropy"]}},
    "knn": {"n_neighbors": {"type": "int", "low": 3, "high": 30},
            "weights": {"type": "categorical", "choices": ["uniform", "distance"]},
            "metric": {"type": "categorical", "choices": ["euclidean", "manhattan"]}},
    "svc": {"C": {"type": "log_float", "low": 0.1, "high": 1000.0}},
    "random_forest": {"n_estimators": {"type": "int", "low": 50, "high": 400},
                      "max_depth": {"type": "int", "low": 3, "high": 20},
                      "max_features": {"type": "float", "low": 0.2, "high": 1.0}},
    "gradient_boosting": {"n_estimators": {"type": "int", "low": 50, "high": 400},
                          "max_depth": {"type": "int", "low": 2, "high": 8},
                          "learning_rate": {"type": "log_float", "low": 0.01, "high": 0.5},
                          "subsample": {"type": "float", "low": 0.5, "high": 1.0}},
    "xgboost": {"n_estimators": {"type": "int", "low": 50, "high": 500},
                "max_depth": {"type": "int", "low": 3, "high": 10},
                "learning_rate": {"type": "log_float", "low": 0.01, "high": 0.5},
                "subsample": {"type": "float", "low": 0.5, "high": 1.0},
                "colsample_bytree": {"type": "float", "low": 0.4, "high": 1.0}},
    "lightgbm": {"n_estimators": {"type": "int", "low": 50, "high": 500},
                 "learning_rate": {"type": "log_float", "low": 0.01, "high": 0.5},
                 "subsample": {"type": "float", "low": 0.5, "high": 1.0},
                 "colsample_bytree": {"type": "float", "low": 0.4, "high": 1.0}},
}
# FIXED VALUES: default parameters (original names)
DEFAULTS: dict = {
    "logistic_regression": {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "max_iter": 1000},
    "decision_tree": {"class_weight": "balanced"},
    "random_forest": {"n_estimators": 100, "class_weight": "balanced"},
    "gradient_boosting": {"n_estimators": 100},
    "xgboost": {"n_estimators": 100, "scale_pos_weight": 2.77},
    "lightgbm": {"n_estimators": 100, "class_weight": "balanced"},
    "svc": {"C": 1.0, "class_weight": "balanced"},
    "knn": {"n_neighbors": 5, "weights": "uniform", "metric": "euclidean"},
    "linear_threshold": {},
}
REDUCTIONS = ("none", "pca", "lda", "rfe")
# depths that the boosted presets use by default
BOOSTED_DEFAULT_DEPTH = {"gradient_boosting": 3, "xgboost": 6, "lightgbm": 5}


def probability_of_one(col: str = "probability") -> Column:
    """P(class 1) from a probability vector, without a Python UDF."""
    return vector_to_array(F.col(col))[1]


def uses_weights(name: str, params: dict) -> bool:
    return params.get("class_weight") == "balanced" or "scale_pos_weight" in params


def check_names(name: str, reduction: dict | None = None) -> None:
    """Raise on a learner or reduction that does not exist, before any job runs."""
    if name not in DEFAULTS:
        raise ValueError(f"unknown learner {name!r}; known: {sorted(DEFAULTS)}")
    method = (reduction or {}).get("method", "none")
    if method not in REDUCTIONS:
        raise ValueError(f"unknown reduction {method!r}; known: {REDUCTIONS}")


def _depth(p: dict) -> int:
    d = int(p.get("max_depth") or MAX_DEPTH)
    if d > MAX_DEPTH:
        raise ValueError(f"max_depth {d}: Spark ML trees are at most {MAX_DEPTH} deep")
    return d


def build_estimator(name: str, params: dict | None = None, n_rows: float | None = None,
                    seed: int = 13) -> Estimator:
    """ML1-ML5, ML7: the Spark estimator for a learner name and its parameters.

    ``n_rows`` (total training weight) converts the inverse strength C of
    the original into Spark's mean-loss ``regParam = 1 / (C · n)``.
    """
    check_names(name)
    p = {**DEFAULTS[name], **(params or {})}
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    if uses_weights(name, p):
        common["weightCol"] = WEIGHT
    n = float(n_rows or 1)
    if name == "logistic_regression":
        return LogisticRegression(regParam=1.0 / (float(p["C"]) * n),
                                  elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
                                  standardization=False, maxIter=int(p["max_iter"]), **common)
    if name == "decision_tree":
        return DecisionTreeClassifier(impurity=p.get("criterion", "gini"), maxDepth=_depth(p),
                                      minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                      seed=seed, **common)
    if name == "random_forest":
        mf = p.get("max_features")
        # every row keeps the node it is in: else each pass ships all trees grown so far to every task
        return RandomForestClassifier(numTrees=int(p["n_estimators"]), maxDepth=_depth(p), cacheNodeIds=True,
                                      featureSubsetStrategy=str(float(mf)) if mf else "sqrt",
                                      minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                      seed=seed, **common)
    if name in ("gradient_boosting", "xgboost", "lightgbm"):
        cs = p.get("colsample_bytree")
        return GBTClassifier(maxIter=int(p["n_estimators"]),
                             maxDepth=_depth({"max_depth": p.get("max_depth", BOOSTED_DEFAULT_DEPTH[name])}),
                             stepSize=float(p.get("learning_rate", 0.1)),
                             subsamplingRate=float(p.get("subsample", 1.0)),
                             featureSubsetStrategy=str(float(cs)) if cs else "all",
                             seed=seed, **common)
    if name in ("svc", "linear_threshold"):
        return LinearSVC(regParam=1.0 / (float(p.get("C", 1.0)) * n), maxIter=int(p.get("max_iter", SVC_ITERATIONS)),
                         standardization=False, **common)
    raise ValueError(f"{name!r} is not fitted as one estimator")


# ---- preparation: impute, scale -------------------------------------------------------------
PARTS_AT_ONCE = 5  # training parts whose quantile sketches a task holds at the same time


def preparations_of_parts(df: DataFrame, features: Sequence[str], fold: str, withouts: Sequence) -> list[list[tuple]]:
    """``preparation_numbers`` of the rows outside each of ``withouts`` (sets of folds), in one
    grouped job for several.  Parts with NULLs are prepared one by one: their medians are exact."""
    out = []
    for i in range(0, len(withouts), PARTS_AT_ONCE):
        some = withouts[i:i + PARTS_AT_ONCE]
        parts = [df.where(~F.col(fold).isin(list(w))) for w in some]
        tags = F.array(*[F.when(~F.col(fold).isin(list(w)), F.lit(k)) for k, w in enumerate(some)])
        cols = [F.col(f"`{c}`").alias(f"__f{j}") for j, c in enumerate(features)]
        tagged = df.select(F.explode(F.array_compact(tags)).alias("__part"), *cols)
        aggs = _column_numbers(features, _scaled(features), {c: F.col(f"__f{j}").cast("double") for j, c in enumerate(features)})
        rows = {r["__part"]: r.asDict() for r in tagged.groupBy("__part").agg(*aggs).collect()}  # one row a part
        out += [preparation_numbers(part, features, row=rows.get(k)) for k, part in enumerate(parts)]
    return out


def _scaled(features: Sequence[str]) -> list[str]:
    from tessera.plans.config import SCALE_COLUMNS
    return [c for c in SCALE_COLUMNS if c in features]


def _moments(features: Sequence[str], scale: Sequence[str], xs: dict) -> list[Column]:
    return [a for i, c in enumerate(features) if c in scale
            for a in (F.avg(xs[c]).alias(f"m{i}"), F.stddev_samp(xs[c]).alias(f"s{i}"))]


def _column_numbers(features: Sequence[str], scale: Sequence[str], xs: dict) -> list[Column]:
    """Per feature the number of NULLs and an approximate median, and the moments of ``scale``."""
    return [*[F.count_if(x.isNull()).alias(f"n{i}") for i, x in enumerate(xs.values())],
            *[F.percentile_approx(x, 0.5).alias(f"q{i}") for i, x in enumerate(xs.values())], *_moments(features, scale, xs)]


def preparation_numbers(df: DataFrame, features: Sequence[str], scale: Sequence[str] | None = None,
                        row: dict | None = None) -> list[tuple]:
    """Per feature (value for NULL, centre, scale): training medians, and LN3 scaling of
    ``scale`` (default: the configured columns among ``features``; others and constant
    columns have centre 0 and scale 1).

    One aggregate gives null counts, means and deviations of all features.
    Columns with NULLs take the exact median of LN1 (and their moments once
    more after imputing); columns without take an approximate median, which
    only serves rows scored later.  ``row``: the aggregate, where it was made for
    several parts (``preparations_of_parts``).
    """
    from tessera.operators.learned import MedianImputer
    scale = _scaled(features) if scale is None else scale
    xs = {c: F.col(f"`{c}`").cast("double") for c in features}
    row = row or df.agg(*_column_numbers(features, scale, xs)).first().asDict()
    holes = [c for i, c in enumerate(features) if row[f"n{i}"]]
    median = {c: row[f"q{i}"] or 0.0 for i, c in enumerate(features)}
    if holes:
        exact = MedianImputer(holes).fit(df).medians
        median.update({c: float(v) if v is not None else 0.0 for c, v in exact.items()})
        if set(holes) & set(scale):
            filled = {c: F.coalesce(x, F.lit(median[c])) for c, x in xs.items()}
            row.update(df.agg(*_moments(features, scale, filled)).first().asDict())
    scaled = {c for i, c in enumerate(features) if c in scale and row.get(f"s{i}")}
    return [(float(median[c]), float(row[f"m{i}"]) if c in scaled else 0.0, float(row[f"s{i}"]) if c in scaled else 1.0)
            for i, c in enumerate(features)]


def fit_preparation(df: DataFrame, features: Sequence[str], scale: Sequence[str] | None = None) -> SQLTransformer:
    """Imputation and scaling by ``preparation_numbers`` as a stage that adds
    ``__x0 .. __xn``."""
    return preparation_stage(features, preparation_numbers(df, features, scale))


def preparation_stage(features: Sequence[str], numbers: Sequence[tuple]) -> SQLTransformer:
    parts = []
    for i, (c, (fill, centre, scale)) in enumerate(zip(features, numbers)):
        expr = f"coalesce(CAST(`{c}` AS DOUBLE), {fill!r}D)"
        if (centre, scale) != (0.0, 1.0):
            expr = f"({expr} - {centre!r}D) / {scale!r}D"
        parts.append(f"{expr} AS __x{i}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def without_summary(model):
    """A fitted model without its training summary, which holds on to the session: it is
    of no use for scoring, and what the session refers to may not be serialisable."""
    java = getattr(model, "_java_obj", None)
    if java is not None and getattr(model, "hasSummary", False):
        from pyspark import SparkContext
        java.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit_reduction(df: DataFrame, columns: Sequence[str], reduction: dict | None, label: str, seed: int) -> list:
    """Fitted stages from the prepared columns to the ``features`` vector."""
    from tessera.operators import reduce as fr
    r = reduction or {}
    method = r.get("method", "none")
    if method == "pca":
        assemble = VectorAssembler(inputCols=list(columns), outputCol=RAW)
        k = max(1, min(int(r.get("n_components", 15)), len(columns) - 1))
        return [assemble, PCA(k=k, inputCol=RAW, outputCol=FEATURES).fit(assemble.transform(df))]
    if method == "lda":
        p = fr.fit_lda(df, columns, label)
        outs = [f"__ld{j}" for j in range(p.weights.shape[1])]
        exprs = [" + ".join(f"(`{c}` - {float(p.mean[i])!r}D) * {float(p.weights[i, j])!r}D"
                            for i, c in enumerate(columns)) + f" AS {o}" for j, o in enumerate(outs)]
        return [SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"),
                VectorAssembler(inputCols=outs, outputCol=FEATURES)]
    if method == "rfe":
        keep = fr.rfe(df, columns, label, min(int(r.get("n_features", 15)), len(columns)),
                      r.get("ranker", "ridge"), seed=seed)
        return [VectorAssembler(inputCols=keep, outputCol=FEATURES)]
    return [VectorAssembler(inputCols=list(columns), outputCol=FEATURES)]


def fit_platt_svc(svc: LinearSVC, data: DataFrame) -> list:
    """ML5: the SVC, its margin, and a one-variable logistic regression of the label
    on it (Platt scaling) — three plain stages that save and load."""
    svm = without_summary(svc.copy({svc.rawPredictionCol: "__svc_raw", svc.predictionCol: "__svc_class"}).fit(data))
    margin = VectorSlicer(inputCol="__svc_raw", outputCol="__svc_margin", indices=[1])
    scored = margin.transform(svm.transform(data))
    kw = {"weightCol": svc.getWeightCol()} if svc.isSet("weightCol") else {}
    platt = LogisticRegression(featuresCol="__svc_margin", labelCol=svc.getLabelCol(), regParam=0.0, **kw)
    return [svm, margin, without_summary(platt.fit(scored))]


def linear_threshold_table(model) -> list[tuple[str, float]]:
    """ML7/ME16: coefficients and intercept of a fitted linear model."""
    return list(enumerate(model.coefficients.toArray().tolist())) + [("intercept", float(model.intercept))]


def with_weights(df: DataFrame, name: str, params: dict | None, label: str) -> DataFrame:
    """The class weights that a learner's parameters ask for, as column ``weight``."""
    from tessera.operators.learned import with_class_weight
    p = {**DEFAULTS[name], **(params or {})}
    if WEIGHT in df.columns or not uses_weights(name, p):
        return df
    return with_class_weight(df, label, "balanced" if p.get("class_weight") == "balanced"
                             else float(p["scale_pos_weight"]))


def fit_pipeline(df: DataFrame, features: Sequence[str], name: str, params: dict | None = None,
                 reduction: dict | None = None, label: str = "Churn", seed: int = 13,
                 preparation: SQLTransformer | None = None):
    """ML8: impute → scale the configured columns → reduce → learner.

    Unknown names raise before any job.  ``preparation`` may be shared by fits
    on the same rows.  Class weights are added unless ``weight`` is there.
    Returns a ``PipelineModel``; for ``knn`` a ``KnnPipeline``.
    """
    check_names(name, reduction)
    build_estimator(name, params, 1, seed) if name != "knn" else None  # parameters raise here
    prep = preparation or fit_preparation(df, features)
    data = with_weights(df, name, params, label).withColumn(LABEL, F.col(f"`{label}`").cast("double"))
    data = prep.transform(data)
    stages = [prep, *fit_reduction(data, [f"__x{i}" for i in range(len(features))], reduction, label, seed)]
    for stage in stages[1:]:
        data = stage.transform(data)
    if name == "knn":
        return KnnPipeline.fit(PipelineModel(stages), data, {**DEFAULTS["knn"], **(params or {})})
    n = None
    if name in ("logistic_regression", "svc", "linear_threshold"):
        n = data.agg(F.sum(WEIGHT) if WEIGHT in data.columns else F.count(F.lit(1))).first()[0]
    est = build_estimator(name, params, n, seed)
    return PipelineModel(stages + (fit_platt_svc(est, data) if name == "svc" else [without_summary(est.fit(data))]))


class KnnPipeline:
    """ML6 as a learner: prepared reference vectors in a written table; scoring is
    the exact cell search of ``tessera.operators.knn``."""

    def __init__(self, prepared: PipelineModel, refs: DataFrame, params: dict):
        self.prepared, self.refs, self.params = prepared, refs, params

    @staticmethod
    def fit(prepared: PipelineModel, data: DataFrame, params: dict) -> "KnnPipeline":
        from tessera.session import materialize
        refs = data.select(vector_to_array(FEATURES).alias("embedding"), F.col(LABEL).cast("int").alias("label"))
        # the id, which orders ties, follows from the row: equal rows are interchangeable
        refs = materialize(refs.withColumn("vec_id", F.xxhash64("embedding", "label")))
        return KnnPipeline(prepared, refs, params)

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        from tessera.operators.knn import knn_neighbors
        from tessera.session import materialize
        q = materialize(self.prepared.transform(df).select(
            F.monotonically_increasing_id().alias("vec_id"), vector_to_array(FEATURES).alias("embedding"),
            *[F.col(f"`{k}`") for k in keep]))
        near = knn_neighbors(q, self.refs, int(self.params["n_neighbors"]), self.params["metric"], exclude_self=False)
        one = F.col("rlabel").cast("double")
        if self.params["weights"] == "distance":  # exact matches alone decide where there are any
            exact = F.col("dist") == 0
            p = F.coalesce(F.avg(F.when(exact, one)), F.sum(F.when(~exact, one / F.col("dist")))
                           / F.sum(F.when(~exact, 1 / F.col("dist"))))
        else:
            p = F.avg(one)
        p = near.groupBy(F.col("qid").alias("vec_id")).agg(p.alias("p"))
        return q.join(p, "vec_id").select(*[F.col(f"`{k}`") for k in keep], "p", (F.col("p") > 0.5).cast("int").alias("yhat"))

    def save(self, path: str) -> None:
        spark = self.refs.sparkSession
        self.prepared.write().save(f"{path}/prepared")
        self.refs.write.mode("error").parquet(f"{path}/refs")
        spark.createDataFrame([(int(self.params["n_neighbors"]), self.params["weights"], self.params["metric"])],
                              "n_neighbors int, weights string, metric string").write.mode("error").parquet(f"{path}/params")

    @staticmethod
    def load(spark, path: str) -> "KnnPipeline":
        params = spark.read.parquet(f"{path}/params").first().asDict()
        return KnnPipeline(PipelineModel.load(f"{path}/prepared"), spark.read.parquet(f"{path}/refs"), params)


def predict(model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Probability of class 1 and the predicted class, plus ``keep`` columns."""
    if hasattr(model, "predict"):  # kNN and ensembles
        return model.predict(df, keep)
    out = model.transform(df)
    prob = (probability_of_one("probability") if "probability" in out.columns
            else (F.col("prediction") == 1).cast("double"))
    return out.select(*[F.col(f"`{k}`") for k in keep], prob.alias("p"),
                      F.col("prediction").cast("int").alias("yhat"))


def tree_rules(model, feature_names: Sequence[str], max_depth: int | None = None) -> dict:
    """ML9: depth, node and leaf counts, and the rules with their predictions.

    ``max_depth`` (None: all) replaces each deeper branch by one line that
    says how many of its lines were left out."""
    def named(line):
        return re.sub(r"feature (\d+)", lambda m: feature_names[int(m.group(1))]
                      if int(m.group(1)) < len(feature_names) else m.group(0), line)
    lines, hidden = [], 0
    for line in [*model.toDebugString.splitlines()[1:], ""]:
        depth = len(line) - len(line.lstrip()) - 2
        if line and max_depth is not None and (depth > max_depth or depth == max_depth and "Predict" not in line):
            hidden += 1
            continue
        if hidden:
            lines.append(" " * (max_depth + 2) + f"... truncated: {hidden} lines")
            hidden = 0
        if line.strip():
            lines.append(named(line))
    return {"depth": model.depth, "num_nodes": model.numNodes, "num_leaves": (model.numNodes + 1) // 2, "rules": lines}


def feature_importance(model, feature_names: Sequence[str]) -> list[tuple[str, float]]:
    """ME9: tree importances, else |coefficient|; sorted descending."""
    if hasattr(model, "featureImportances"):
        imp = model.featureImportances.toArray().tolist()
    elif hasattr(model, "coefficients"):
        imp = [abs(v) for v in model.coefficients.toArray().tolist()]
    else:
        return []
    pairs = list(zip(feature_names, imp))
    return sorted(pairs, key=lambda t: (-t[1], t[0]))
