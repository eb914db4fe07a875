"""Candidate scorers over lineitem, for the metric / tuning / registry operators.

Five deterministic scores in [0, 1] computed from lineitem columns, with the
label y = returned.  They stand in for the probabilities of several fitted
models so that fold metrics, model comparison, selection, voting and
promotion all run over a table that Spark derives from the test data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.features import round_to
from tessera.operators.split import stratified_kfold
from tessera.session import materialize, table
from tessera.sources.frames import SCORED_KEY

# FIXED VALUES: candidate score definitions (name -> expression over lineitem)
# (each is rounded to 3 decimals, which creates ties on purpose)
CANDIDATES = {
    "price": "l_extendedprice / 110000.0",
    "net_price": "l_extendedprice * (1 - l_discount) / 110000.0",
    "discount": "l_discount * 10.0",
    "tax": "l_tax * 12.5",
    "quantity": "l_quantity / 50.0",
}
FOLD_SEED = 13
N_FOLDS = 5


def wide_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, y and one column per candidate."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*SCORED_KEY, (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     *[round_to(F.expr(e), 3).alias(n) for n, e in CANDIDATES.items()])


def long_scores(spark: SparkSession, sf_dir: str, with_folds: bool = True) -> DataFrame:
    """(key, y, fold, model, p): one row per lineitem row and candidate."""
    w = wide_scores(spark, sf_dir)
    if with_folds:
        # the fold table is reused by every evaluation: materialise it once in
        # the shared checkpoint folder (lineage cut, survives executor loss)
        w = materialize(stratified_kfold(w, SCORED_KEY, "y", N_FOLDS, FOLD_SEED))
    ids = SCORED_KEY + ["y"] + (["fold"] if with_folds else [])
    return w.unpivot(ids, list(CANDIDATES), "model", "p")


def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, fold, roc_auc, f1, precision, recall, accuracy) from one plan:
    grouped counts and grouped exact AUC over (model, fold)."""
    from tessera.operators.metrics import classification_metrics
    m = classification_metrics(long_scores(spark, sf_dir), "y", "p", by=["model", "fold"])
    return m.select("model", "fold", "roc_auc", "f1", "precision", "recall", "accuracy")
