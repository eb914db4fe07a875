"""Catalog: fold tables, selection, voting, registry rules (TU2, TU8, TU10-TU14,
ME11, ME13, ME14, RG2-RG4), over per-fold metrics derived from lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import metrics as me
from tessera.plans import registry as rg
from tessera.plans import selection as sel
from tessera.plans.catalog import register
from tessera.sources import scorers

FM = ("fold_metrics",)
CV = ("cv_summary",)
METRICS = ["roc_auc", "f1", "precision", "recall", "accuracy"]
CV_COLS = ", ".join(f"round(cv_{m}_mean, 6) AS cv_{m}_mean, round(cv_{m}_std, 6) AS cv_{m}_std"
                    for m in METRICS)


def _cv(spark, sf):
    return me.aggregate_folds(scorers.fold_metrics(spark, sf), ["model"])


@register("tu2_aggregate_folds", f"SELECT model, {CV_COLS} FROM cv_summary", CV)
def tu2_aggregate_folds(spark, sf):
    return me.round_metrics(_cv(spark, sf))


@register("me11_fold_comparison", """
WITH best AS (SELECT model FROM cv_summary ORDER BY cv_roc_auc_mean DESC, cv_roc_auc_std ASC, model LIMIT 1),
f AS (SELECT fm.* FROM fold_metrics fm JOIN best USING (model))
SELECT CAST(fold AS VARCHAR) AS fold, round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1 FROM f
UNION ALL SELECT 'mean', round(avg(roc_auc), 6), round(avg(f1), 6) FROM f""", CV)
def me11_fold_comparison(spark, sf):
    fm = scorers.fold_metrics(spark, sf)
    best = sel.select_best(me.aggregate_folds(fm, ["model"]))
    return me.round_metrics(me.fold_comparison(fm.join(best.select("model"), "model")))


@register("me13_robustness", """
SELECT model, round(cv_auc, 6) AS cv_auc, round(holdout_auc, 6) AS holdout_auc, round(delta, 6) AS delta,
       CASE WHEN delta < 0.05 THEN 'good' WHEN delta < 0.1 THEN 'moderate' ELSE 'bad' END AS band
FROM (SELECT model, avg(roc_auc) FILTER (WHERE fold <> 0) AS cv_auc, max(roc_auc) FILTER (WHERE fold = 0) AS holdout_auc,
             avg(roc_auc) FILTER (WHERE fold <> 0) - max(roc_auc) FILTER (WHERE fold = 0) AS delta
      FROM fold_metrics GROUP BY model)""", FM)
def me13_robustness(spark, sf):
    r = sel.robustness(scorers.fold_metrics(spark, sf))
    return me.round_metrics(r.drop("band")).join(r.select("model", "band"), "model")


@register("me14_model_comparison", "SELECT model, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT model, "
          + ", ".join(f"cv_{m}_mean AS {m}" for m in METRICS)
          + " FROM cv_summary) ON " + ", ".join(METRICS) + " INTO NAME metric VALUE value)", CV)
def me14_model_comparison(spark, sf):
    s = _cv(spark, sf).select("model", *[F.col(f"cv_{m}_mean").alias(m) for m in METRICS])
    return me.round_metrics(me.model_comparison(s))


@register("tu8_keep_if_better", """
WITH pairs AS (SELECT * FROM (VALUES ('price', 'net_price'), ('quantity', 'tax')) AS t(baseline, tuned))
SELECT p.baseline, CASE WHEN t.cv_roc_auc_mean > b.cv_roc_auc_mean THEN p.tuned ELSE p.baseline END AS chosen,
       round(CASE WHEN t.cv_roc_auc_mean > b.cv_roc_auc_mean THEN t.cv_roc_auc_mean ELSE b.cv_roc_auc_mean END, 6)
         AS chosen_score
FROM pairs p JOIN cv_summary b ON b.model = p.baseline JOIN cv_summary t ON t.model = p.tuned""", CV)
def tu8_keep_if_better(spark, sf):
    out = sel.keep_if_better(_cv(spark, sf), {"price": "net_price", "quantity": "tax"})
    return me.round_metrics(out)


@register("tu11_top_n_models", f"""
SELECT model, {CV_COLS} FROM cv_summary ORDER BY cv_roc_auc_mean DESC, model LIMIT 3""", CV)
def tu11_top_n_models(spark, sf):
    return me.round_metrics(sel.top_n_models(_cv(spark, sf), 3))


@register("tu12_select_best", f"""
SELECT model, {CV_COLS} FROM cv_summary ORDER BY cv_roc_auc_mean DESC, cv_roc_auc_std ASC, model LIMIT 1""", CV)
def tu12_select_best(spark, sf):
    return me.round_metrics(sel.select_best(_cv(spark, sf)))


@register("tu13_fold_scores_of_best", """
WITH best AS (SELECT model FROM cv_summary ORDER BY cv_roc_auc_mean DESC, cv_roc_auc_std ASC, model LIMIT 1),
f AS (SELECT fm.model, fm.fold, fm.roc_auc FROM fold_metrics fm JOIN best USING (model))
SELECT model, fold, round(roc_auc, 6) AS roc_auc, round((SELECT stddev_pop(roc_auc) FROM f), 6) AS roc_auc_std_pop
FROM f""", CV)
def tu13_fold_scores_of_best(spark, sf):
    fm = scorers.fold_metrics(spark, sf)
    best = sel.select_best(me.aggregate_folds(fm, ["model"]))
    return me.round_metrics(sel.fold_scores_of(fm, best))


VOTE_MODELS = ["price", "net_price", "quantity"]
GRID = sel.weight_grid(VOTE_MODELS, 1, 10)  # modeling.yaml: weight_low, weight_high


def _voting_sql():
    vals = ", ".join(f"({i}, {', '.join(map(str, ws))})" for i, ws in enumerate(GRID))
    cols = ", ".join(f"w_{m}" for m in VOTE_MODELS)
    num = "0.0 + " + " + ".join(f"w_{m} * {m}" for m in VOTE_MODELS)
    den = "CAST(0.0 AS DOUBLE) + " + " + ".join(f"CAST(w_{m} AS DOUBLE)" for m in VOTE_MODELS)
    return f"""
WITH lv AS (SELECT y, {', '.join(VOTE_MODELS)}, count(*) AS w FROM scores_wide GROUP BY y, {', '.join(VOTE_MODELS)}),
g AS (SELECT * FROM (VALUES {vals}) AS g(combo, {cols})),
x AS (SELECT combo, y, w, ({num}) / ({den}) AS p FROM lv, g),
sl AS (SELECT combo, p, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS neg
       FROM x GROUP BY combo, p),
c AS (SELECT *, sum(neg) OVER (PARTITION BY combo ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
             sum(pos) OVER (PARTITION BY combo) AS tot_pos, sum(neg) OVER (PARTITION BY combo) AS tot_neg FROM sl),
a AS (SELECT combo, sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (CAST(max(tot_pos) AS DOUBLE) * max(tot_neg)) AS roc_auc
      FROM c GROUP BY combo),
voting AS (SELECT g.combo, {', '.join('g.w_' + m for m in VOTE_MODELS)}, round(a.roc_auc, 6) AS roc_auc
           FROM g JOIN a ON g.combo = a.combo)
"""


def _voting(spark, sf):
    out = sel.soft_voting_search(scorers.wide_scores(spark, sf), VOTE_MODELS, GRID)
    return me.round_metrics(out)


@register("tu10_soft_voting", _voting_sql() + "SELECT * FROM voting", ("scores_wide",))
def tu10_soft_voting(spark, sf):
    return _voting(spark, sf)


@register("tu10_best_vote", _voting_sql().replace("round(a.roc_auc, 6) AS roc_auc", "a.roc_auc") + f"""
SELECT combo, {', '.join('w_' + m for m in VOTE_MODELS)}, round(roc_auc, 6) AS roc_auc FROM voting
ORDER BY voting.roc_auc DESC, combo LIMIT 1""", ("scores_wide",))
def tu10_best_vote(spark, sf):
    """The winner of the whole grid, found by bounds: few vectors are scored exactly."""
    won = sel.best_weights(scorers.wide_scores(spark, sf), VOTE_MODELS, GRID)
    row = (won["combo"], *[int(won["weights"][m]) for m in VOTE_MODELS], won["roc_auc"])
    out = spark.createDataFrame([row], "combo int, " + ", ".join(f"w_{m} int" for m in VOTE_MODELS) + ", roc_auc double")
    return me.round_metrics(out)


@register("tu14_search_history", _voting_sql() + """
SELECT combo AS draw, roc_auc AS objective,
       max(roc_auc) OVER (ORDER BY combo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far
FROM voting""", ("scores_wide",))
def tu14_search_history(spark, sf):
    draws = _voting(spark, sf).select(F.col("combo").alias("draw"), F.col("roc_auc").alias("objective"))
    return sel.search_history(draws)


ORDER_SQL = "CASE model " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(scorers.CANDIDATES)) + " END"
# the runs in order, each against the version current at its time (a fold, so recursive)
_RUNS = f"""
WITH runs AS (SELECT {ORDER_SQL} AS run, model, cv_roc_auc_mean, cv_f1_mean FROM cv_summary),
n AS (SELECT *, row_number() OVER (ORDER BY run) AS i FROM runs),
fold AS (
  SELECT i, run, model, cv_roc_auc_mean, cv_f1_mean, true AS promoted, 1 AS version,
         cv_roc_auc_mean AS cur_auc, cv_f1_mean AS cur_f1 FROM n WHERE i = 1
  UNION ALL
  SELECT s.i, s.run, s.model, s.cv_roc_auc_mean, s.cv_f1_mean, s.ok, f.version + CAST(s.ok AS INTEGER),
         CASE WHEN s.ok THEN s.cv_roc_auc_mean ELSE f.cur_auc END, CASE WHEN s.ok THEN s.cv_f1_mean ELSE f.cur_f1 END
  FROM fold f JOIN LATERAL (
    SELECT n.*, n.cv_roc_auc_mean > f.cur_auc
                OR (abs(n.cv_roc_auc_mean - f.cur_auc) < 1e-6 AND n.cv_f1_mean > f.cur_f1) AS ok
    FROM n WHERE n.i = f.i + 1) s ON true),
seq AS (SELECT run, model, round(cv_roc_auc_mean, 6) AS cv_roc_auc_mean, round(cv_f1_mean, 6) AS cv_f1_mean,
               promoted, CAST(CASE WHEN promoted THEN version END AS INTEGER) AS version FROM fold)
"""


def _runs(spark, sf):
    order = F.expr(ORDER_SQL.replace("CASE model", "CASE `model`"))
    runs = _cv(spark, sf).select(order.alias("run"), "model", "cv_roc_auc_mean", "cv_f1_mean")
    seq = rg.promotion_sequence(runs)
    return seq.withColumns({"cv_roc_auc_mean": me.round_to(F.col("cv_roc_auc_mean"), 6),
                            "cv_f1_mean": me.round_to(F.col("cv_f1_mean"), 6)})


@register("rg3_promotion_sequence", _RUNS + "SELECT * FROM seq", CV)
def rg3_promotion_sequence(spark, sf):
    return _runs(spark, sf)


@register("rg2_current_version", _RUNS + """
SELECT version, model, cv_roc_auc_mean, cv_f1_mean FROM seq WHERE promoted ORDER BY version DESC LIMIT 1""", CV)
def rg2_current_version(spark, sf):
    versions = _runs(spark, sf).where("promoted").select("version", "model", "cv_roc_auc_mean", "cv_f1_mean")
    return rg.current_version(versions)


@register("rg4_experiment_summary", """
SELECT model, round(cv_roc_auc_mean, 4) AS cv_roc_auc_mean, round(cv_roc_auc_std, 4) AS cv_roc_auc_std,
       round(cv_f1_mean, 4) AS cv_f1_mean, CAST(row_number() OVER (ORDER BY cv_roc_auc_mean DESC, cv_roc_auc_std ASC, model)
       AS INTEGER) AS rank
FROM cv_summary""", CV)
def rg4_experiment_summary(spark, sf):
    s = _cv(spark, sf).select("model", "cv_roc_auc_mean", "cv_roc_auc_std", "cv_f1_mean")
    return rg.experiment_summary(s, 4)
