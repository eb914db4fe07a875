"""Metrics, prefix ranks, splits and batches: properties and brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.prefix import hash_rank, ntile
from tessera.operators import metrics as me
from tessera.operators import monitor as sc
from tessera.operators import split as sp


def _auc_bruteforce(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = 0.0
    for a in pos:
        s += (neg < a).sum() + 0.5 * (neg == a).sum()
    return s / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 2000)
    p = np.round(rng.random(2000) * 0.5 + 0.3 * y, 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = me.roc_auc(df).first().auc
    assert abs(got - _auc_bruteforce(y, p)) < 1e-12
    flipped = me.roc_auc(df.withColumn("p", 1 - F.col("p"))).first().auc
    assert abs(flipped - (1 - got)) < 1e-12


def test_auc_single_class_and_all_tied(spark):
    one = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, p double")
    assert me.roc_auc(one).first().auc is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, p double")
    assert me.roc_auc(tied).first().auc == 0.5


def test_calibration_edges(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.3), (1, 0.31), (1, 1.0)], "y int, p double")
    bins = [r[0] for r in df.select(me.calibration_bin(F.col("p"))).collect()]
    assert bins == [1, 1, 3, 4, 10]


def test_classification_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    r = me.classification_metrics(df).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.accuracy == 1.0


def test_null_scores_and_labels_take_no_part(spark):
    rows = [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.6)]
    full = me.classification_metrics(spark.createDataFrame(rows, "y int, p double")).first()
    holes = spark.createDataFrame(rows + [(1, None), (None, 0.7), (None, None)], "y int, p double")
    assert me.classification_metrics(holes).first() == full
    assert (full.roc_auc, full.tp, full.fp, full.fn, full.tn) == (0.75, 1, 1, 1, 1)


def test_metrics_by_group_and_given_class(spark):
    rows = [("a", 1, 0.9, 1), ("a", 0, 0.1, 1), (None, 1, 0.2, 0), (None, 0, 0.3, 0), ("b", 1, 0.4, 1)]
    df = spark.createDataFrame(rows, "g string, y int, p double, c int")
    by_score = {r.g: r for r in me.classification_metrics(df, by=["g"]).collect()}
    assert by_score["a"].roc_auc == 1.0 and by_score["b"].roc_auc is None and by_score[None].roc_auc == 0.0
    assert (by_score["a"].tp, by_score["a"].fp, by_score[None].fn, by_score[None].tn) == (1, 0, 1, 1)
    by_class = {r.g: r for r in me.classification_metrics(df, yhat="c", by=["g"]).collect()}
    assert (by_class["a"].tp, by_class["a"].fp) == (1, 1) and by_class["a"].roc_auc == 1.0


def test_folds_disjoint_complete_balanced(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    f = sp.stratified_kfold(df, ["k"], "y", 5, 13).toPandas()
    assert len(f) == 1003 and f.k.is_unique
    counts = f.groupby(["y", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1) <= 1).all()
    h = sp.stratified_holdout(df, ["k"], "y", 0.2, 13).toPandas()
    share = h.groupby("y").is_test.mean()
    assert ((share - 0.2).abs() < 0.01).all()


def test_holdout_kfold_in_one_rank_equals_composition(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    two = sp.stratified_kfold(sp.stratified_holdout(df, ["k"], "y", 0.2, 7).where(~F.col("is_test"))
                              .drop("is_test"), ["k"], "y", 5, 7)
    one = sp.stratified_holdout_kfold(df, ["k"], "y", 0.2, 5, 7)
    assert sorted(map(tuple, two.select("k", "fold").collect())) == \
        sorted(map(tuple, one.where(~F.col("is_test")).select("k", "fold").collect()))
    held = sp.stratified_holdout(df, ["k"], "y", 0.2, 7).select("k", "is_test")
    assert held.exceptAll(one.select("k", "is_test")).count() == 0
    assert one.where("is_test AND fold IS NOT NULL").count() == 0


def test_batches_ntile(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    b = sc.assign_batches(df, ["k"], 10).groupBy("batch").count().orderBy("batch").toPandas()
    assert b["count"].tolist() == [11, 11, 11] + [10] * 7


def test_moving_average_skips_null(spark):
    t = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "batch int, v double")
    out = [r.v_ma for r in sc.moving_average(t, "v", 2).orderBy("batch").collect()]
    assert out == [1.0, 1.0, 3.0]


def test_hash_rank_partition_independent(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = hash_rank(df, ["k"], 7).orderBy("k").toPandas()["rank"].tolist()
    b = hash_rank(df.repartition(13), ["k"], 7).orderBy("k").toPandas()["rank"].tolist()
    assert a == b and sorted(a) == list(range(500))


def test_ntile_formula(spark):
    df = spark.range(7).select(F.col("id").alias("r"), F.lit(7).alias("n"))
    out = [x[0] for x in df.select(ntile(F.col("r"), F.col("n"), 3)).collect()]
    assert out == [1, 1, 1, 2, 2, 3, 3]


def test_null_group_is_a_group_not_lost_rows(spark):
    """A NULL class is ranked as its own group (SQL PARTITION BY semantics)."""
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(40)], "k int, y int")
    r = hash_rank(df, ["k"], 13, by=["y"]).toPandas()
    assert len(r) == 40
    sizes = r.groupby(r.y.fillna(-1)).group_n.first().to_dict()
    assert sizes == {-1: 10, 0: 10, 1: 20}
    for _, g in r.groupby(r.y.fillna(-1)):
        assert sorted(g["rank"]) == list(range(len(g)))


def test_grouped_metrics_keep_null_group(spark):
    df = spark.createDataFrame([(g, y, p) for g in (None, 1) for y, p in ((0, 0.1), (1, 0.9), (0, 0.8), (1, 0.3))],
                               "g int, y int, p double")
    m = {r.g: r.roc_auc for r in me.classification_metrics(df, "y", "p", by=["g"]).collect()}
    assert m[None] == m[1] == 0.75  # 3 of 4 (pos, neg) pairs ordered
