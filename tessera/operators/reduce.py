"""Feature reduction and selection (FR1-FR6).

PCA, LDA and ridge RFE need only first and second moments: distributed
aggregates produce the (d × d) scatter matrices, which are tiny, and the small
linear algebra runs on the driver with numpy; projecting is a per-row dot
product of column expressions.  RFE with a forest refits it on a written frame
and drops the weakest feature each round.  The ANOVA F statistic of FR5 is a grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# ---- FR5 ------------------------------------------------------------------------
def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F of every feature against the class label.

    One grouped aggregate (count, mean, sample variance per class and
    feature — k rows), then the F formula over that small table.
    Constant features give NULL (0/0).
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(features):
        x = _q(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.coalesce(F.var_samp(x), F.lit(0.0)).alias(f"v{i}")]
    per_class = df.groupBy(_q(label)).agg(*aggs)
    stack = ", ".join(f"'{c}', m{i}, v{i}" for i, c in enumerate(features))
    long = per_class.selectExpr("n", f"stack({len(features)}, {stack}) AS (feature, m, v)")
    g = long.groupBy("feature").agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"),
        F.collect_list(F.struct("n", "m", "v")).alias("cls"))
    ssb = F.aggregate("cls", F.lit(0.0), lambda acc, s: acc + s["n"] * (s["m"] - F.col("grand")) ** 2)
    ssw = F.aggregate("cls", F.lit(0.0), lambda acc, s: acc + (s["n"] - 1) * s["v"])
    f = F.try_divide(ssb / (F.col("k") - 1), ssw / (F.col("N") - F.col("k")))
    return g.select("feature", f.alias("f_value"))


def select_k_best(scores: DataFrame, k: int) -> DataFrame:
    """FR5: rank by F (descending, NULL last, ties by name) and keep the best k."""
    from pyspark.sql import Window
    w = Window.orderBy(F.desc_nulls_last("f_value"), F.asc("feature"))
    return scores.withColumn("rank", F.row_number().over(w)).withColumn("selected", F.col("rank") <= k)


def selected_features(ranked: DataFrame) -> list[str]:
    """FR6: names after reduction (one row per feature)."""
    return [r["feature"] for r in ranked.where("selected").orderBy("rank").collect()]


# ---- moments ------------------------------------------------------------------------
def moments(df: DataFrame, features: Sequence[str], label: str | None = None) -> list[dict]:
    """Per class (or overall): n, mean vector and centred scatter matrix.

    Counts, means and variances come from one ``Summarizer`` aggregate, the
    correlations from Spark's distributed Gram matrix of the centred vectors (one
    job per class): no raw cross products, so large means lose no precision.
    Only d × d numbers per class reach the driver.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation, Summarizer
    x = df.select(*[_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                  *([_q(label).alias("y")] if label else []))
    x = VectorAssembler(inputCols=[f"x{i}" for i in range(len(features))], outputCol="v").transform(x)
    stats = Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    rows = (x.groupBy("y") if label else x.groupBy()).agg(stats).collect()
    out = []
    for r in rows:
        n, mean, var = r["s"]["count"], r["s"]["mean"].toArray(), r["s"]["variance"].toArray()
        part = x.where(F.col("y").eqNullSafe(F.lit(r["y"]))) if label else x
        corr = Correlation.corr(part, "v").first()[0].toArray() if n > 1 else np.eye(len(features))
        sd = np.sqrt(np.maximum(var, 0))
        scatter = np.nan_to_num(corr) * np.outer(sd, sd) * max(n - 1, 0)
        np.fill_diagonal(scatter, var * max(n - 1, 0))
        out.append({"label": r["y"] if label else None, "n": n, "mean": mean, "scatter": scatter})
    return out


# ---- FR2 / FR3 ------------------------------------------------------------------------
@dataclass
class Projection:
    """Centred linear projection: out_j = Σ_i (x_i − mean_i) · W[i, j]."""
    features: list
    mean: np.ndarray
    weights: np.ndarray
    prefix: str
    explained: list | None = None

    def output_columns(self) -> list[str]:
        return [f"{self.prefix}{j + 1}" for j in range(self.weights.shape[1])]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        cols = []
        for j, name in enumerate(self.output_columns()):
            expr = F.lit(0.0)
            for i, c in enumerate(self.features):
                w = float(self.weights[i, j])
                if w != 0.0:
                    expr = expr + (_q(c).cast("double") - F.lit(float(self.mean[i]))) * F.lit(w)
            cols.append(expr.alias(name))
        return df.select(*[_q(k) for k in keep], *cols)


def principal_axes(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a covariance and their vectors, the largest loading positive."""
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    vals, vecs = vals[order], vecs[:, order]
    signs = np.sign(vecs[np.argmax(np.abs(vecs), axis=0), range(vecs.shape[1])])
    return vals, vecs * np.where(signs == 0, 1, signs)


def fit_pca(df: DataFrame, features: Sequence[str], n_components: int) -> Projection:
    """FR2: centred PCA (sample covariance), n capped at features − 1."""
    m = moments(df, features)[0]
    mean, cov = m["mean"], m["scatter"] / max(m["n"] - 1, 1)
    k = min(n_components, len(features) - 1)
    vals, vecs = principal_axes(cov, k)
    total = float(np.trace(cov))
    return Projection(list(features), mean, vecs, "pc_", [float(v / total) if total else 0.0 for v in vals])


def discriminant_axes(ms: Sequence[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Grand mean and unit discriminant directions from the moments of the classes."""
    d = len(ms[0]["mean"])
    n_tot = sum(m["n"] for m in ms)
    grand = sum(m["n"] * m["mean"] for m in ms) / n_tot
    Sw, Sb = np.zeros((d, d)), np.zeros((d, d))
    for m in ms:
        Sw += m["scatter"]
        diff = (m["mean"] - grand)[:, None]
        Sb += m["n"] * diff @ diff.T
    k = max(1, len(ms) - 1)
    vals, vecs = np.linalg.eig(np.linalg.pinv(Sw) @ Sb)
    order = np.argsort(vals.real)[::-1][:k]
    W = vecs[:, order].real
    W = W / np.where(np.linalg.norm(W, axis=0) == 0, 1, np.linalg.norm(W, axis=0))
    return grand, W


def fit_lda(df: DataFrame, features: Sequence[str], label: str) -> Projection:
    """FR3: linear discriminant directions (classes − 1 outputs) from class
    means and the pooled within-class scatter."""
    ms = moments(df, features, label)
    grand, W = discriminant_axes(ms)
    return Projection(list(features), grand, W, "ld_")


def reduce_none(df: DataFrame) -> DataFrame:
    """FR1: pass through."""
    return df


def ridge_elimination(cov: np.ndarray, n_keep: int, reg: float = 1.0) -> list[int]:
    """Features left when the weakest ridge coefficient goes, round by round; ``cov``
    is of the features and, last, the label."""
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    unit = np.where(sd > 0, sd, 1)
    corr, with_y = (cov / np.outer(unit, unit))[:-1, :-1], cov[:-1, -1] / unit[:-1]
    left = list(range(len(cov) - 1))
    while len(left) > n_keep:
        beta = np.linalg.solve(corr[np.ix_(left, left)] + reg * np.eye(len(left)), with_y[left])
        left.pop(int(np.argmin(np.abs(beta))))
    return left


# ---- FR4 -------------------------------------------------------------------------
def rfe(df: DataFrame, features: Sequence[str], label: str, n_keep: int,
        ranker: str = "ridge", reg: float = 1.0, seed: int = 13) -> list[str]:
    """FR4: refit the ranker, drop the weakest feature, repeat until n_keep.

    Ridge ranks by |coefficient| on standardised inputs: every round solves
    (R + reg·I) β = r for the features left, from moments computed once.  The
    forest ranks by impurity importance and is refitted on a written frame.
    """
    if ranker == "ridge":
        m = moments(df, [*features, label])[0]
        cov = m["scatter"] / max(m["n"] - 1, 1)
        return [features[i] for i in ridge_elimination(cov, n_keep, reg)]
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from tessera.session import materialize
    cur = list(features)
    base = materialize(df.select(*[_q(c).cast("double").alias(c) for c in cur], _q(label).cast("double").alias("__y")))
    while len(cur) > n_keep:
        x = VectorAssembler(inputCols=cur, outputCol="__raw", handleInvalid="keep").transform(base)
        model = RandomForestClassifier(featuresCol="__raw", labelCol="__y", numTrees=50, seed=seed).fit(x)
        cur.pop(int(np.argmin(model.featureImportances.toArray())))
    return cur
