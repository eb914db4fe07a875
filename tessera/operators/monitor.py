"""Batch scoring and monitoring (SC1-SC6).

Batches are NTILE slices of a reproducible order computed with the bucketed
rank (no single-partition window over rows).  Per-batch metrics are one
grouped aggregate plus a grouped exact AUC; moving averages and drift bands
run on the per-batch table (one row per batch), never on rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.prefix import hash_rank, ntile
from tessera.operators.metrics import classification_metrics

# FIXED VALUES: risk bands of the scoring page
RISK_LOW, RISK_MEDIUM = 0.30, 0.60


def risk_band(p: Column, low: float = RISK_LOW, medium: float = RISK_MEDIUM) -> Column:
    """SC2: < 0.30 low, < 0.60 medium, else high."""
    return F.when(p < low, "low").when(p < medium, "medium").otherwise("high")


def assign_batches(df: DataFrame, key: Sequence[str], n_batches: int, seed=13,
                   batch: str = "batch") -> DataFrame:
    """SC3: n disjoint consecutive batches (1-based) of the md5(seed-key)
    order; sizes differ by at most one (the first N mod n batches get one
    more row), every row belongs to exactly one batch."""
    r = hash_rank(df, list(key), seed)
    return r.withColumn(batch, ntile(F.col("rank"), F.col("group_n"), n_batches)).drop(
        "rank", "group_n")


def metrics_by_batch(df: DataFrame, y: str = "y", p: str = "p", batch: str = "batch",
                     threshold: float = 0.5) -> DataFrame:
    """SC4: AUC, F1, precision, recall, accuracy, real and predicted rate per
    batch.  The rates come from the same confusion counts (real = (tp+fn)/n,
    predicted = (tp+fp)/n), so the batch frame is aggregated once plus the
    grouped AUC."""
    m = classification_metrics(df, y, p, threshold=threshold, by=[batch])
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return m.select(batch, "roc_auc", "f1", "precision", "recall", "accuracy",
                    ((F.col("tp") + F.col("fn")) / n).alias("rate_real"),
                    ((F.col("tp") + F.col("fp")) / n).alias("rate_predicted"))


def moving_average(per_batch: DataFrame, value: str, window: int, batch: str = "batch",
                   out: str | None = None) -> DataFrame:
    """SC5: mean of the last ``window`` batches (min 1 value; NULLs skipped).

    Runs over the per-batch table, whose size is the batch count.
    """
    w = Window.orderBy(batch).rowsBetween(-(window - 1), 0)
    return per_batch.withColumn(out or f"{value}_ma", F.avg(value).over(w))


def drift_band(per_batch: DataFrame, value: str, window: int, batch: str = "batch") -> DataFrame:
    """SC6: moving mean ± population std of the whole series."""
    ma = moving_average(per_batch, value, window, batch, "ma")
    sd = per_batch.agg(F.stddev_pop(value)).scalar()
    return ma.withColumn("lower", F.col("ma") - sd).withColumn("upper", F.col("ma") + sd)


def score_batch(model, raw: DataFrame, feature_columns: Sequence[str] | None = None, keep: Sequence[str] = (),
                categories: dict | None = None) -> DataFrame:
    """SC1: raw customer rows → FX20 → FX23 → FX19 → model → probability, class.

    A ``RawModel`` (what the registry loads) brings feature columns and learned
    categories itself.  For a model over features they are passed in; either way a
    batch with fewer categories or columns still yields every expected column.
    """
    from tessera.operators.models import predict
    from tessera.operators.raw_model import RawModel, raw_features
    if isinstance(model, RawModel):
        scored = model.predict(raw, keep)
    else:
        scored = predict(model, raw_features(raw, feature_columns, categories, keep), keep)
    return scored.withColumnsRenamed({"p": "probability", "yhat": "prediction"})
