"""Catalog: learned column operators (LN1-LN9) and ANOVA selection (FR5).

Models are fitted on the training part of a stratified holdout (SP1) and
applied to every row, so each query exercises fit and transform.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import learned as ln
from tessera.operators import reduce as fr
from tessera.operators import split as sp
from tessera.plans.catalog import register
from tessera.plans.catalog.common import encoded_subscribers, rnd
from tessera.plans.catalog.sqlgen import rank_sql
from tessera.plans.config import FEATURE_COLUMNS, ID_COLUMN, SCALE_COLUMNS, SEED, TARGET
from tessera.plans.oracle_frames import define
from tessera.session import table
from tessera.sources import frames

_SPLIT = f"{rank_sql('customerID', 'customerID', SEED, 'Churn')} < round(count(*) OVER (PARTITION BY Churn) * 0.2)"
define("enc_split", f"enc_split AS (SELECT *, {_SPLIT} AS is_test FROM enc)", ("enc",))
define("feat_split", f"feat_split AS (SELECT *, {_SPLIT} AS is_test FROM features)", ("features",))


def _enc_split(spark, sf):
    return sp.stratified_holdout(encoded_subscribers(spark, sf), [ID_COLUMN], TARGET, 0.2, SEED)


def _feat_split(spark, sf):
    return sp.stratified_holdout(frames.features(spark, sf), [ID_COLUMN], TARGET, 0.2, SEED)


def _train(df):
    return df.where(~F.col("is_test"))


@register("ln1_median_impute", """
SELECT customerID, round(coalesce(TotalCharges, (SELECT quantile_cont(TotalCharges, 0.5) FROM enc_split
       WHERE NOT is_test)), 6) AS TotalCharges FROM enc_split""", ("enc_split",))
def ln1_median_impute(spark, sf):
    d = _enc_split(spark, sf)
    m = ln.MedianImputer(["TotalCharges"]).fit(_train(d))
    return m.transform(d).select(ID_COLUMN, rnd("TotalCharges").alias("TotalCharges"))


@register("ln2_group_median_impute", """
WITH gm AS (SELECT Contract, quantile_cont(TotalCharges, 0.5) AS gm FROM enc_split
            WHERE NOT is_test AND Contract IS NOT NULL GROUP BY Contract)
SELECT customerID, round(coalesce(TotalCharges, gm.gm, (SELECT quantile_cont(TotalCharges, 0.5) FROM enc_split
       WHERE NOT is_test)), 6) AS TotalCharges
FROM enc_split e LEFT JOIN gm ON e.Contract = gm.Contract""", ("enc_split",))
def ln2_group_median_impute(spark, sf):
    d = _enc_split(spark, sf)
    m = ln.GroupMedianImputer("TotalCharges", "Contract").fit(_train(d))
    return m.transform(d).select(ID_COLUMN, rnd("TotalCharges").alias("TotalCharges"))


@register("ln2_group_medians", """
SELECT Contract, round(quantile_cont(TotalCharges, 0.5), 6) AS median FROM enc_split
WHERE NOT is_test AND Contract IS NOT NULL GROUP BY Contract""", ("enc_split",))
def ln2_group_medians(spark, sf):
    m = ln.GroupMedianImputer("TotalCharges", "Contract").fit(_train(_enc_split(spark, sf)))
    return m.params().select("Contract", rnd("median").alias("median"))


def _q(c):
    return f'"{c}"'


@register("ln3_standard_scale", "SELECT customerID, " + ", ".join(
    f"round(CASE WHEN (SELECT stddev_samp({_q(c)}) FROM feat_split WHERE NOT is_test) > 0 "
    f"THEN ({_q(c)} - (SELECT avg({_q(c)}) FROM feat_split WHERE NOT is_test)) / "
    f"(SELECT stddev_samp({_q(c)}) FROM feat_split WHERE NOT is_test) ELSE {_q(c)} END, 6) AS {_q(c)}"
    for c in SCALE_COLUMNS) + " FROM feat_split", ("feat_split",))
def ln3_standard_scale(spark, sf):
    d = _feat_split(spark, sf)
    m = ln.StandardScaler(SCALE_COLUMNS).fit(_train(d))
    out = m.transform(d)
    return out.select(ID_COLUMN, *[rnd(c).alias(c) for c in SCALE_COLUMNS])


@register("ln4_scale_params", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({_q(c)}), 6) AS mean, round(stddev_samp({_q(c)}), 6) AS std "
    f"FROM feat_split WHERE NOT is_test" for c in SCALE_COLUMNS), ("feat_split",))
def ln4_scale_params(spark, sf):
    m = ln.StandardScaler(SCALE_COLUMNS).fit(_train(_feat_split(spark, sf)))
    p = m.params_frame(spark)
    return p.select("feature", rnd("mean").alias("mean"), rnd("std").alias("std"))


ROBUST = ["tenure", "MonthlyCharges", "TotalCharges"]


@register("ln5_robust_scale", "WITH q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS med_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS iqr_{c}"
    for c in ROBUST) + " FROM feat_split WHERE NOT is_test)\nSELECT customerID, " + ", ".join(
    f"round((CAST({c} AS DOUBLE) - med_{c}) / CASE WHEN iqr_{c} = 0 THEN 1.0 ELSE iqr_{c} END, 6) AS {c}"
    for c in ROBUST) + " FROM feat_split, q", ("feat_split",))
def ln5_robust_scale(spark, sf):
    d = _feat_split(spark, sf)
    m = ln.RobustScaler(ROBUST).fit(_train(d))
    return m.transform(d).select(ID_COLUMN, *[rnd(c).alias(c) for c in ROBUST])


OH = ["Contract", "PaymentMethod", "InternetService"]


def _oh_sql():
    parts = []
    for c in OH:
        parts.append(f"SELECT '{c}' AS col, v FROM (SELECT DISTINCT {c} AS v FROM enc_split "
                     f"WHERE NOT is_test AND {c} IS NOT NULL)")
    cats = "\nUNION ALL ".join(parts)
    return f"""
WITH cats AS ({cats}),
kept AS (SELECT col, v FROM (SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY v) AS r FROM cats) WHERE r > 1)
SELECT e.customerID, k.col || '_' || k.v AS column_name,
       CAST(CASE k.col WHEN 'Contract' THEN e.Contract = k.v WHEN 'PaymentMethod' THEN e.PaymentMethod = k.v
            ELSE e.InternetService = k.v END IS TRUE AS INTEGER) AS value
FROM enc_split e, kept k"""


@register("ln6_one_hot_learned", _oh_sql(), ("enc_split",))
def ln6_one_hot_learned(spark, sf):
    d = _enc_split(spark, sf)
    m = ln.OneHotLearned(OH, drop_first=True).fit(_train(d))
    out = m.transform(d)
    cols = m.output_columns()
    return out.select(ID_COLUMN, *[F.col(f"`{c}`") for c in cols]).unpivot(
        [ID_COLUMN], cols, "column_name", "value")


@register("ln8_class_weights", """
SELECT quality, count(*) AS n_c,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY quality""")
def ln8_class_weights(spark, sf):
    w = ln.balanced_weights(table(spark, sf, "labels"), "quality")
    return w.select("quality", "n_c", rnd("weight").alias("weight"))


@register("ln8_class_weights_churn", """
SELECT Churn, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM features GROUP BY Churn""", ("features",))
def ln8_class_weights_churn(spark, sf):
    w = ln.balanced_weights(frames.features(spark, sf), TARGET)
    return w.select(TARGET, "n_c", rnd("weight").alias("weight"))


@register("ln8_weight_column", """
SELECT toxic, weight, count(*) AS n FROM (
  SELECT toxic, CAST(CASE WHEN toxic = 1 THEN 2.77 ELSE 1.0 END AS DOUBLE) AS weight FROM labels) GROUP BY toxic, weight""")
def ln8_weight_column(spark, sf):
    w = ln.with_class_weight(table(spark, sf, "labels"), "toxic", 2.77)
    return w.groupBy("toxic", "weight").agg(F.count(F.lit(1)).alias("n"))


@register("ln9_quantile_bins", """
WITH e AS (SELECT list_distinct([quantile_cont(tenure, 0.0), quantile_cont(tenure, 0.2), quantile_cont(tenure, 0.4),
                                 quantile_cont(tenure, 0.6), quantile_cont(tenure, 0.8), quantile_cont(tenure, 1.0)])
                  AS edges FROM features)
SELECT customerID, CAST(CASE WHEN tenure < list_min(edges) OR tenure > list_max(edges) THEN NULL
       ELSE greatest(len(list_filter(edges, lambda x: x < tenure)) - 1, 0) END AS DOUBLE) AS bin
FROM features, e""", ("features",))
def ln9_quantile_bins(spark, sf):
    d = frames.features(spark, sf)
    m = ln.QuantileBinner("tenure", 5).fit(d)
    return m.transform(d).select(ID_COLUMN, "bin")


ANOVA_FEATURES = [c for c in FEATURE_COLUMNS]


def _anova_sql():
    parts = []
    for c in ANOVA_FEATURES:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(f"""SELECT '{c}' AS feature, Churn, count(*) AS n, avg({x}) AS m,
               coalesce(var_samp({x}), 0.0) AS v FROM features GROUP BY Churn""")
    return f"""
WITH pc AS ({' UNION ALL '.join(parts)}),
g AS (SELECT feature, sum(n) AS n_tot, count(*) AS k, sum(n * m) / sum(n) AS grand FROM pc GROUP BY feature),
f AS (SELECT pc.feature, sum(pc.n * (pc.m - g.grand) ** 2) / (max(g.k) - 1) AS msb,
             sum((pc.n - 1) * pc.v) / (max(g.n_tot) - max(g.k)) AS msw
      FROM pc JOIN g ON pc.feature = g.feature GROUP BY pc.feature),
s AS (SELECT feature, CASE WHEN msw = 0 THEN NULL ELSE msb / msw END AS f_value FROM f)
SELECT feature, round(f_value, 4) AS f_value,
       CAST(row_number() OVER (ORDER BY f_value DESC NULLS LAST, feature) AS INTEGER) AS rank,
       row_number() OVER (ORDER BY f_value DESC NULLS LAST, feature) <= 10 AS selected
FROM s"""


@register("fr5_select_k_best", _anova_sql(), ("features",))
def fr5_select_k_best(spark, sf):
    f = fr.anova_f(frames.features(spark, sf), ANOVA_FEATURES, TARGET)
    ranked = fr.select_k_best(f, 10)
    return ranked.select("feature", rnd("f_value", 4).alias("f_value"),
                         F.col("rank").cast("int").alias("rank"), "selected")
