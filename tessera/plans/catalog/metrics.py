"""Catalog: metrics (ME1-ME15), splits (SP1-SP3), batch monitoring (SC2-SC6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import metrics as me
from tessera.operators import monitor as sc
from tessera.operators import split as sp
from tessera.operators.profile import sample_rows
from tessera.plans.catalog import register
from tessera.plans.catalog.common import rnd
from tessera.plans.catalog.sqlgen import (HASH_KEY_SQL, KEY_SQL, auc_sql, cls_metrics_sql,
                                          counts_sql, rank_sql, rates_sql)
from tessera.plans.config import ID_COLUMN, SEED, TARGET
from tessera.session import materialize
from tessera.sources import frames, scorers
from tessera.sources.frames import SCORED_KEY

SC = ("scored",)


def _scored(spark, sf):
    return frames.scored(spark, sf)


# ---- ME1 / ME2 / ME15 ---------------------------------------------------------------
@register("me1_classification_metrics", cls_metrics_sql("scored"), SC)
def me1_classification_metrics(spark, sf):
    return me.round_metrics(me.classification_metrics(_scored(spark, sf)))


@register("me2_roc_auc", "SELECT round(auc, 6) AS auc FROM (" + auc_sql("scored") + ")", SC)
def me2_roc_auc(spark, sf):
    return me.round_metrics(me.roc_auc(_scored(spark, sf)))


@register("me2_roc_auc_by_linestatus",
          "SELECT l_linestatus, round(auc, 6) AS auc FROM ("
          + auc_sql("(SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER) AS y, "
                    "round(l_extendedprice / 110000.0, 3) AS p FROM lineitem)", ["l_linestatus"]) + ")")
def me2_roc_auc_by_linestatus(spark, sf):
    from tessera.session import table
    from tessera.functions.features import round_to
    li = table(spark, sf, "lineitem").select(
        "l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("y"),
        round_to(F.col("l_extendedprice") / 110000.0, 3).alias("p"))
    return me.round_metrics(me.roc_auc(li, by=["l_linestatus"]))


@register("me15_threshold_metrics", cls_metrics_sql("scored", t=0.3), SC)
def me15_threshold_metrics(spark, sf):
    return me.round_metrics(me.classification_metrics(_scored(spark, sf), threshold=0.3))


# ---- ME3 / ME4 ----------------------------------------------------------------------
_LEVELS = """
lv AS (SELECT p, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg FROM scored GROUP BY p),
cm AS (SELECT *, sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
              sum(pos) OVER () AS tot_p, sum(neg) OVER () AS tot_n FROM lv)
"""


@register("me3_roc_curve", "WITH " + _LEVELS + """
SELECT p AS threshold, round(CAST(fp AS DOUBLE) / tot_n, 6) AS fpr, round(CAST(tp AS DOUBLE) / tot_p, 6) AS tpr
FROM cm""", SC)
def me3_roc_curve(spark, sf):
    return me.round_metrics(me.roc_curve(_scored(spark, sf)))


@register("me4_pr_curve", "WITH " + _LEVELS + """
SELECT p AS threshold, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END, 6)
         AS precision,
       round(CAST(tp AS DOUBLE) / tot_p, 6) AS recall, round(CAST(tot_p AS DOUBLE) / (tot_p + tot_n), 6) AS prevalence
FROM cm""", SC)
def me4_pr_curve(spark, sf):
    return me.round_metrics(me.pr_curve(_scored(spark, sf)))


# ---- ME5 - ME8 ------------------------------------------------------------------------
@register("me5_confusion_matrix", counts_sql("scored"), SC)
def me5_confusion_matrix(spark, sf):
    return me.confusion_matrix(_scored(spark, sf))


def _cal_bin_sql(p="p", n=10):
    edges = [j * (1 + 1e-8) / n for j in range(1, n)]
    return "(1 + " + " + ".join(f"CAST({p} > CAST('{e!r}' AS DOUBLE) AS INTEGER)" for e in edges) + ")"


@register("me6_calibration_curve", f"""
SELECT bin, round(avg(p), 6) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 6) AS fraction_positive,
       count(*) AS n
FROM (SELECT CAST({_cal_bin_sql()} AS INTEGER) AS bin, p, y FROM scored) GROUP BY bin""", SC)
def me6_calibration_curve(spark, sf):
    return me.round_metrics(me.calibration_curve(_scored(spark, sf)))


_REPORT = """
WITH c AS (""" + counts_sql("scored") + """),
r AS (SELECT *,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS p1,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS r1,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1_1,
  CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / CAST(tn + fn AS DOUBLE) END AS p0,
  CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) END AS r0,
  CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE CAST(2 * tn AS DOUBLE) / CAST(2 * tn + fn + fp AS DOUBLE) END AS f1_0,
  tp + fn AS s1, tn + fp AS s0 FROM c),
rows AS (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f1_0 AS f1, s0 AS support FROM r
  UNION ALL SELECT '1', p1, r1, f1_1, s1 FROM r
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, s0 + s1 FROM r
  UNION ALL SELECT 'weighted avg',
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE CAST(p0 * s0 + p1 * s1 AS DOUBLE) / CAST(s0 + s1 AS DOUBLE) END,
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE CAST(r0 * s0 + r1 * s1 AS DOUBLE) / CAST(s0 + s1 AS DOUBLE) END,
    CASE WHEN s0 + s1 = 0 THEN 0.0 ELSE CAST(f1_0 * s0 + f1_1 * s1 AS DOUBLE) / CAST(s0 + s1 AS DOUBLE) END,
    s0 + s1 FROM r)
"""


@register("me7_classification_report", _REPORT + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM rows""", SC)
def me7_classification_report(spark, sf):
    return me.round_metrics(me.classification_report(_scored(spark, sf)))


@register("me8_weighted_recall", _REPORT + """
SELECT round(recall, 6) AS weighted_recall FROM rows WHERE label = 'weighted avg'""", SC)
def me8_weighted_recall(spark, sf):
    return me.round_metrics(me.weighted_recall(_scored(spark, sf)))


# ---- SP1 - SP3 ------------------------------------------------------------------------------
FEAT = ("features",)


@register("sp1_stratified_holdout", f"""
SELECT customerID, Churn,
       {rank_sql('customerID', 'customerID', SEED, 'Churn')} < round(count(*) OVER (PARTITION BY Churn) * 0.2)
         AS is_test
FROM features""", FEAT)
def sp1_stratified_holdout(spark, sf):
    f = frames.features(spark, sf).select(ID_COLUMN, TARGET)
    return sp.stratified_holdout(f, [ID_COLUMN], TARGET, 0.2, SEED)


@register("sp2_stratified_kfold", f"""
SELECT customerID, Churn, CAST({rank_sql('customerID', 'customerID', SEED, 'Churn')} % 5 AS INTEGER) AS fold
FROM features""", FEAT)
def sp2_stratified_kfold(spark, sf):
    f = frames.features(spark, sf).select(ID_COLUMN, TARGET)
    return sp.stratified_kfold(f, [ID_COLUMN], TARGET, 5, SEED)


@register("sp2_fold_balance", """
SELECT fold, y, count(*) AS n FROM scores_folds GROUP BY fold, y""", ("scores_folds",))
def sp2_fold_balance(spark, sf):
    w = sp.stratified_kfold(scorers.wide_scores(spark, sf), SCORED_KEY, "y", scorers.N_FOLDS,
                            scorers.FOLD_SEED)
    return w.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n"))


@register("sp3_tuning_subsample", f"""
SELECT customerID, Churn FROM features ORDER BY md5('{SEED}-' || customerID), customerID LIMIT 1000""", FEAT)
def sp3_tuning_subsample(spark, sf):
    f = frames.features(spark, sf).select(ID_COLUMN, TARGET)
    return sp.tuning_subsample(f, [ID_COLUMN], 1000, SEED)


# ---- SC2 - SC6 -------------------------------------------------------------------------------
@register("sc2_risk_band", """
SELECT band, count(*) AS n, round(avg(p), 6) AS mean_p
FROM (SELECT CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS band, p FROM scored)
GROUP BY band""", SC)
def sc2_risk_band(spark, sf):
    s = _scored(spark, sf).withColumn("band", sc.risk_band(F.col("p")))
    return s.groupBy("band").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("p")).alias("mean_p"))


N_BATCHES, MA_WINDOW = 10, 3
_BATCHED = f"""
batched AS (SELECT *, CAST(ntile({N_BATCHES}) OVER (ORDER BY md5('{SEED}-' || {HASH_KEY_SQL}), {KEY_SQL}) AS INTEGER)
                      AS batch FROM scored)"""


def _batched(spark, sf):
    # batch assignment is read by several aggregates: materialise it once
    return materialize(sc.assign_batches(_scored(spark, sf), SCORED_KEY, N_BATCHES, SEED))


@register("sc3_assign_batches", "WITH " + _BATCHED + """
SELECT batch, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM batched GROUP BY batch""", SC)
def sc3_assign_batches(spark, sf):
    return _batched(spark, sf).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("positives"))


_BATCH_METRICS = "WITH " + _BATCHED + """,
m AS (""" + cls_metrics_sql("batched", ["batch"], with_counts=False) + """),
rt AS (SELECT batch, avg(CAST(y AS DOUBLE)) AS rate_real, avg(CAST(p >= 0.5 AS DOUBLE)) AS rate_predicted
       FROM batched GROUP BY batch),
bm AS (SELECT m.*, round(rt.rate_real, 6) AS rate_real, round(rt.rate_predicted, 6) AS rate_predicted
       FROM m JOIN rt ON m.batch = rt.batch)
"""


def _batch_metrics(spark, sf):
    return me.round_metrics(sc.metrics_by_batch(_batched(spark, sf)))


@register("sc4_metrics_by_batch", _BATCH_METRICS + "SELECT * FROM bm", SC)
def sc4_metrics_by_batch(spark, sf):
    return _batch_metrics(spark, sf)


@register("sc5_moving_average", _BATCH_METRICS + f"""
SELECT batch, roc_auc, round(avg(roc_auc) OVER (ORDER BY batch ROWS BETWEEN {MA_WINDOW - 1} PRECEDING AND CURRENT ROW), 6)
         AS roc_auc_ma FROM bm""", SC)
def sc5_moving_average(spark, sf):
    bm = _batch_metrics(spark, sf).select("batch", "roc_auc")
    return me.round_metrics(sc.moving_average(bm, "roc_auc", MA_WINDOW))


@register("sc6_drift_band", _BATCH_METRICS + f"""
SELECT batch, round(ma, 6) AS ma, round(ma - sd, 6) AS lower, round(ma + sd, 6) AS upper
FROM (SELECT batch, avg(f1) OVER (ORDER BY batch ROWS BETWEEN {MA_WINDOW - 1} PRECEDING AND CURRENT ROW) AS ma,
             (SELECT stddev_pop(f1) FROM bm) AS sd FROM bm)""", SC)
def sc6_drift_band(spark, sf):
    bm = _batch_metrics(spark, sf).select("batch", "f1")
    return me.round_metrics(sc.drift_band(bm, "f1", MA_WINDOW).select("batch", "ma", "lower", "upper"))
