"""Reproducible stratified splits and folds (SP1-SP4).

Rows are ordered within each class by md5(seed-key) (ties by key) using the
hash-bucketed rank of :mod:`tessera.functions.prefix`: the same rows land in
the same split whatever the partitioning, and no class is sorted in one
task.  ``rand()`` / ``sampleBy`` are not used: neither is reproducible across
partitionings nor exact in size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.prefix import hash_rank


def stratified_holdout(df: DataFrame, key: Sequence[str], label: str, share: float = 0.2,
                       seed=13, flag: str = "is_test") -> DataFrame:
    """SP1: per class, the first round(n_c × share) rows in hash order are test."""
    r = hash_rank(df, list(key), seed, by=[label])
    n_test = F.round(F.col("group_n") * F.lit(float(share)))
    return r.withColumn(flag, F.col("rank") < n_test).drop("rank", "group_n")


def stratified_kfold(df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed=13,
                     fold: str = "fold") -> DataFrame:
    """SP2: fold = hash rank within class mod k, so every fold holds each class
    to within one row."""
    r = hash_rank(df, list(key), seed, by=[label])
    return r.withColumn(fold, (F.col("rank") % k).cast("int")).drop("rank", "group_n")


def stratified_holdout_kfold(df: DataFrame, key: Sequence[str], label: str, share: float = 0.2,
                             k: int = 5, seed=13, flag: str = "is_test",
                             fold: str = "fold") -> DataFrame:
    """SP1 then SP2 on the remaining rows, from ONE hash rank.

    With the same seed and key, the remaining rows of a class keep their
    hash order and are exactly the ranks ``n_test .. n-1``, so their rank
    among the remaining rows is ``rank - n_test``: the result equals
    ``stratified_kfold(stratified_holdout(df).where(~is_test))`` (fold NULL
    on test rows) with one shuffle and sort instead of two.
    """
    r = hash_rank(df, list(key), seed, by=[label])
    n_test = F.round(F.col("group_n") * F.lit(float(share)))
    is_test = F.col("rank") < n_test
    return (r.withColumn(flag, is_test)
             .withColumn(fold, F.when(~is_test, ((F.col("rank") - n_test) % k).cast("int")))
             .drop("rank", "group_n"))


def tuning_subsample(df: DataFrame, key: Sequence[str], n: int, seed=13) -> DataFrame:
    """SP3: at most n rows for slow learners (seeded, without replacement)."""
    from tessera.operators.profile import sample_rows
    return sample_rows(df, n, seed, list(key))


def x_y_split(df: DataFrame, target: str) -> tuple[list[str], str]:
    """SP4: feature column names and the target (schema only)."""
    return [c for c in df.columns if c != target], target
