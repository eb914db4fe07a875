"""Classification metrics and diagnostics (ME1-ME16), exact and distributed.

Counts come from one aggregate with ``count_if``; ROC AUC and the curves come
from score-level counts (one row per distinct score, per group) and the
bucketed prefix sums of :mod:`tessera.functions.prefix`, so no step needs a
single-partition sort.  Ties count half (Mann-Whitney), as in the usual
rank formula.  ``0/0`` ratios are 0, as with ``zero_division=0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from tessera.functions.features import round_to
from tessera.functions.prefix import prefix_sums, with_edge_buckets


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _div0(num: Column, den: Column) -> Column:
    """num/den with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def predicted(p: Column, threshold: float = 0.5) -> Column:
    """ME15: class from probability, ``p >= t``."""
    return (p >= F.lit(threshold)).cast("int")


# ---- counts ----------------------------------------------------------------------
def confusion_aggs(y: Column, yhat: Column) -> list[Column]:
    return [F.count_if((y == 1) & (yhat == 1)).alias("tp"),
            F.count_if((y == 0) & (yhat == 1)).alias("fp"),
            F.count_if((y == 1) & (yhat == 0)).alias("fn"),
            F.count_if((y == 0) & (yhat == 0)).alias("tn")]


def rates_from_counts(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    """precision, recall, F1 (= 2tp / (2tp+fp+fn)), accuracy; 0/0 → 0."""
    return [_div0(tp, tp + fp).alias("precision"), _div0(tp, tp + fn).alias("recall"),
            _div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
            _div0(tp + tn, tp + fp + fn + tn).alias("accuracy")]


def confusion_matrix(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5,
                     by: Sequence[str] = ()) -> DataFrame:
    """ME5: TN FP FN TP (per group) in one aggregate."""
    yhat = predicted(_q(p), threshold)
    return df.groupBy(*by).agg(*confusion_aggs(_q(y), yhat))


# ---- ROC AUC and curves --------------------------------------------------------------
def score_levels(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, distinct score): positives and negatives at that score.

    Rows without a label or a score take no part in any metric: they are left
    out here and in the confusion counts alike."""
    return df.where(_q(y).isNotNull() & _q(p).isNotNull()).groupBy(*by, _q(p).alias("score")).agg(
        F.sum(_q(y).cast("long")).alias("pos"),
        (F.count(F.lit(1)) - F.sum(_q(y).cast("long"))).alias("neg"))


def _cumulated(df: DataFrame, y: str, p: str, by: Sequence[str], n_buckets: int | None) -> DataFrame:
    """Running counts over score levels.  The levels are written once: edges, totals
    and running sums then read that small table, and the input is read once."""
    lv = materialize(score_levels(df, y, p, by))
    lv = with_edge_buckets(lv, "score", per=list(by), n_buckets=n_buckets)
    return prefix_sums(lv, ["score"], ["neg", "pos"], list(by))


def roc_auc(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (),
            n_buckets: int | None = None) -> DataFrame:
    """ME2: exact ROC AUC per group (column ``auc``); NULL for a one-class group.

    AUC = Σ_s pos_s · (neg_below_s + ½ neg_s) / (P · N).  All terms are
    multiples of ½ below 2^53, so the sum is exact in double precision.
    """
    c = _cumulated(df, y, p, by, n_buckets)
    contrib = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(contrib), F.max("tot_pos").cast("double") * F.max("tot_neg"))
         .alias("auc"))


def roc_curve(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """ME3: (threshold, fpr, tpr) at every distinct score, classifying ``p >= threshold``."""
    c = _cumulated(df, y, p, (), n_buckets)
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(fp.cast("double"), F.col("tot_neg")).alias("fpr"),
                    F.try_divide(tp.cast("double"), F.col("tot_pos")).alias("tpr"))


def pr_curve(df: DataFrame, y: str = "y", p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """ME4: (threshold, precision, recall, prevalence) at every distinct score."""
    c = _cumulated(df, y, p, (), n_buckets)
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return c.select(F.col("score").alias("threshold"),
                    _div0(tp, tp + fp).alias("precision"),
                    F.try_divide(tp.cast("double"), F.col("tot_pos")).alias("recall"),
                    (F.col("tot_pos") / (F.col("tot_pos") + F.col("tot_neg"))).alias("prevalence"))


# ---- ME1 / ME15 ---------------------------------------------------------------------------
def classification_metrics(df: DataFrame, y: str = "y", p: str | None = "p",
                           yhat: str | None = None, threshold: float = 0.5,
                           by: Sequence[str] = ()) -> DataFrame:
    """ME1/ME15: roc_auc, f1, precision, recall, accuracy per group.

    The class is ``p >= threshold`` unless ``yhat`` is given; AUC uses the
    probability when present, else the class (as the original did).
    """
    score = p if p else yhat
    if yhat and p:  # the class is not a function of the score: count it beside
        rows = df.where(_q(y).isNotNull() & _q(p).isNotNull() & _q(yhat).isNotNull())
        counts = rows.groupBy(*by).agg(*confusion_aggs(_q(y), _q(yhat)))
        auc = roc_auc(rows, y, p, by).withColumnsRenamed({c: f"__a{i}" for i, c in enumerate(by)})
        on = [_q(c).eqNullSafe(F.col(f"__a{i}")) for i, c in enumerate(by)]
        out = counts.join(auc, on, "left") if by else counts.withColumn("auc", auc.select("auc").scalar())
    else:
        # one pass: AUC and confusion counts all follow from the score levels
        c = _cumulated(df, y, score, by, None)
        one = predicted(F.col("score"), threshold) == 1 if p else F.col("score") == 1
        contrib = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))

        def total(what, when):
            return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0))
        out = c.groupBy(*by).agg(
            F.try_divide(F.sum(contrib), F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("auc"),
            total("pos", one).alias("tp"), total("neg", one).alias("fp"),
            total("pos", ~one).alias("fn"), total("neg", ~one).alias("tn"))
    out = out.select(*by, "auc", *rates_from_counts(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")),
                     "tp", "fp", "fn", "tn")
    return out.select(*by, F.col("auc").alias("roc_auc"), "f1", "precision", "recall", "accuracy",
                      "tp", "fp", "fn", "tn")


# ---- ME6 / ME7 / ME8 ------------------------------------------------------------------------
def calibration_bin(p: Column, n_bins: int = 10) -> Column:
    """1-based bin of right-closed equal-width bins; 0 falls in the first.

    Edges are j·(1+1e-8)/n for j = 1..n-1 (the slightly widened uniform
    grid the original used), and the bin is the count of edges below p.
    """
    edges = [j * (1 + 1e-8) / n_bins for j in range(1, n_bins)]
    return (sum(((p > F.lit(e)).cast("int") for e in edges), F.lit(0)) + 1).cast("int")


def calibration_curve(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10) -> DataFrame:
    """ME6: per non-empty bin: mean predicted, share positive, count."""
    return (df.withColumn("bin", calibration_bin(_q(p), n_bins))
              .groupBy("bin").agg(F.avg(_q(p)).alias("mean_predicted"),
                                  F.avg(_q(y).cast("double")).alias("fraction_positive"),
                                  F.count(F.lit(1)).alias("n")))


def classification_report(df: DataFrame, y: str = "y", p: str = "p",
                          threshold: float = 0.5) -> DataFrame:
    """ME7: per class precision/recall/F1/support, plus macro and weighted averages.

    One aggregate of the four confusion counts; the six result rows are
    projections of that single row.
    """
    c = df.agg(*confusion_aggs(_q(y), predicted(_q(p), threshold)))
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, s1 = _div0(tp, tp + fp), _div0(tp, tp + fn), tp + fn
    p0, r0, s0 = _div0(tn, tn + fn), _div0(tn, tn + fp), tn + fp
    f1_1, f1_0 = _div0(2 * tp, 2 * tp + fp + fn), _div0(2 * tn, 2 * tn + fn + fp)
    n = s0 + s1

    def row(label, prec, rec, f1, sup):
        return F.struct(F.lit(label).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1"), sup.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f1_0, s0), row("1", p1, r1, f1_1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", _div0(p0 * s0 + p1 * s1, n), _div0(r0 * s0 + r1 * s1, n),
            _div0(f1_0 * s0 + f1_1 * s1, n), n))
    return c.select(F.explode(rows).alias("r")).select("r.*")


def weighted_recall(df: DataFrame, y: str = "y", p: str = "p", threshold: float = 0.5) -> DataFrame:
    """ME8: support-weighted recall (the notebook's search score)."""
    return classification_report(df, y, p, threshold).where("label = 'weighted avg'").select(
        F.col("recall").alias("weighted_recall"))


# ---- ME11 / ME13 / ME14 ----------------------------------------------------------------------
def fold_comparison(fold_metrics: DataFrame, fold: str = "fold") -> DataFrame:
    """ME11: AUC and F1 per fold plus a ``mean`` row (over the small fold table)."""
    per = fold_metrics.select(F.col(fold).cast("string").alias("fold"), "roc_auc", "f1")
    mean = fold_metrics.agg(F.lit("mean").alias("fold"), F.avg("roc_auc").alias("roc_auc"),
                            F.avg("f1").alias("f1"))
    return per.unionByName(mean)


def robustness_band(delta: Column, bands=((0.05, "good"), (0.10, "moderate")),
                    else_band: str = "bad") -> Column:
    """ME13: band of CV AUC − holdout AUC."""
    expr = None
    for lim, name in bands:
        expr = F.when(delta < lim, name) if expr is None else expr.when(delta < lim, name)
    return expr.otherwise(else_band)


def model_comparison(per_model: DataFrame, model: str = "model",
                     metrics: Sequence[str] = ("roc_auc", "f1", "precision", "recall", "accuracy")
                     ) -> DataFrame:
    """ME14: one row per model × metric (unpivot of a small metrics table)."""
    return per_model.unpivot([model], list(metrics), "metric", "value")


def aggregate_folds(fold_metrics: DataFrame, by: Sequence[str] = (),
                    metrics: Sequence[str] = ("roc_auc", "f1", "precision", "recall", "accuracy")
                    ) -> DataFrame:
    """TU2: mean and sample std per metric (``cv_<m>_mean``, ``cv_<m>_std``)."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"cv_{m}_mean"), F.stddev_samp(m).alias(f"cv_{m}_std")]
    return fold_metrics.groupBy(*by).agg(*aggs)


def round_metrics(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: round_to(F.col(c), digits) for c in cols})


# ---- ME10 ---------------------------------------------------------------------------------
def permutation_importance(model, df: DataFrame, features: Sequence[str], key: Sequence[str],
                           label: str, repeats: int = 5, seed: int = 13) -> DataFrame:
    """ME10: AUC drop when one feature's values are shuffled across rows.

    Rows get one hash rank, written once.  A (feature, repeat) permutes the ranks
    by a random affine map r → a·r + b mod n (a coprime to n), so no further
    sort is needed.  Every row sends each value to the rank that the inverse map
    gives: what is shuffled for each (row, feature, repeat) is only a rank and one
    value, and the full row is joined back inside the scoring task.  Both sides of
    that join grow with the rows, so neither is broadcast.
    All features × repeats go through the model in one ``transform`` and one
    grouped exact AUC.
    """
    import math

    import numpy as np

    from tessera.functions.prefix import hash_rank
    from tessera.operators.models import predict
    base = materialize(hash_rank(df, list(key), f"{seed}-base", rank_col="__r").drop("group_n"))
    n, rng = base.count(), np.random.default_rng(seed)

    def permutation():
        a = int(rng.integers(1, max(2, n)))
        while math.gcd(a, max(1, n)) != 1:
            a = int(rng.integers(1, max(2, n)))
        return a, int(rng.integers(0, max(1, n)))
    combos = []
    for i in range(len(features)):
        for rep in range(repeats):
            a, b = permutation()
            combos.append(F.struct(F.lit(i).alias("__fi"), F.lit(rep).alias("__rep"),
                                   F.lit(pow(a, -1, max(1, n))).cast("decimal(38,0)").alias("inverse"),
                                   F.lit(max(1, n) - b).cast("decimal(19,0)").alias("back")))
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    sent = base.select("__r", values.alias("v"), F.explode(F.array(*combos)).alias("c")).select(
        F.pmod(F.col("c.inverse") * (F.col("__r").cast("decimal(19,0)") + F.col("c.back")), F.lit(max(1, n)))
        .cast("bigint").alias("__r"), "c.__fi", "c.__rep", F.get("v", F.col("c.__fi")).alias("__value"))
    permuted = sent.hint("merge").join(base.hint("merge"), "__r")
    permuted = permuted.withColumns({c: F.when(F.col("__fi") == i, F.col("__value")).otherwise(F.col(f"`{c}`"))
                                     for i, c in enumerate(features)})
    scored = predict(model, permuted, keep=["__fi", "__rep", label]).withColumnRenamed(label, "y")
    auc = roc_auc(scored, "y", "p", by=["__fi", "__rep"])
    base_auc = roc_auc(predict(model, df, keep=[label]).withColumnRenamed(label, "y")).select("auc").scalar()
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "__fi int, feature string")
    per = auc.groupBy("__fi").agg(F.avg("auc").alias("permuted_auc"), F.stddev_samp("auc").alias("std"))
    return (per.join(names, "__fi").select(
        "feature", (base_auc - F.col("permuted_auc")).alias("importance"), "std")
        .orderBy(F.desc("importance"), "feature"))
