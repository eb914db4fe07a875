"""SQL text for the oracle side of metric queries (DuckDB dialect).

Written independently of the Spark operators: plain window functions over
the whole table, which DuckDB runs on one machine at the check scale.
"""

from __future__ import annotations

from tessera.plans.oracle_frames import define
from tessera.sources.frames import SCORED_KEY
from tessera.sources.scorers import CANDIDATES, FOLD_SEED, N_FOLDS

KEY_SQL = ", ".join(SCORED_KEY)
HASH_KEY_SQL = "concat_ws('|', " + KEY_SQL + ")"


def _by(by):
    return ", ".join(by)


def auc_sql(src: str, by=(), y="y", p="p") -> str:
    """SELECT by..., auc — exact ROC AUC with ties counted half."""
    b = _by(by)
    sel = f"{b}, " if by else ""
    part = f"PARTITION BY {b}" if by else ""
    grp = f"GROUP BY {b}" if by else ""
    return f"""SELECT {sel}CASE WHEN max(tot_pos) * max(tot_neg) = 0 THEN NULL
       ELSE sum(pos * ((cum_neg - neg) + 0.5 * neg)) / (CAST(max(tot_pos) AS DOUBLE) * max(tot_neg)) END AS auc
FROM (SELECT *, sum(neg) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
             sum(pos) OVER ({part}) AS tot_pos, sum(neg) OVER ({part}) AS tot_neg
      FROM (SELECT {sel}{p} AS p, CAST(sum({y}) AS BIGINT) AS pos, CAST(count(*) - sum({y}) AS BIGINT) AS neg
            FROM {src} GROUP BY {sel}{p})) {grp}"""


def _d0(num, den):
    return f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def rates_sql(tp="tp", fp="fp", fn="fn", tn="tn", r=6) -> str:
    return (f"round({_d0(tp, f'{tp} + {fp}')}, {r}) AS precision, "
            f"round({_d0(tp, f'{tp} + {fn}')}, {r}) AS recall, "
            f"round({_d0(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')}, {r}) AS f1, "
            f"round({_d0(f'{tp} + {tn}', f'{tp} + {fp} + {fn} + {tn}')}, {r}) AS accuracy")


def counts_sql(src: str, by=(), t=0.5, y="y", p="p") -> str:
    b = _by(by)
    sel = f"{b}, " if by else ""
    grp = f"GROUP BY {b}" if by else ""
    return (f"SELECT {sel}count(*) FILTER (WHERE {y} = 1 AND {p} >= {t}) AS tp, "
            f"count(*) FILTER (WHERE {y} = 0 AND {p} >= {t}) AS fp, "
            f"count(*) FILTER (WHERE {y} = 1 AND {p} < {t}) AS fn, "
            f"count(*) FILTER (WHERE {y} = 0 AND {p} < {t}) AS tn FROM {src} {grp}")


def cls_metrics_sql(src: str, by=(), t=0.5, with_counts=True) -> str:
    """by..., roc_auc, f1, precision, recall, accuracy [, tp, fp, fn, tn]."""
    on = " AND ".join(f"c.{k} = a.{k}" for k in by) or "true"
    sel = "".join(f"c.{k}, " for k in by)
    extra = ", tp, fp, fn, tn" if with_counts else ""
    return (f"SELECT {sel}round(a.auc, 6) AS roc_auc, {rates_sql()}{extra} "
            f"FROM ({counts_sql(src, by, t)}) c LEFT JOIN ({auc_sql(src, by)}) a ON {on}")


def rank_sql(key_sql: str, order_keys: str, seed, by=None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (f"(row_number() OVER ({part}ORDER BY md5('{seed}-' || {key_sql}), {order_keys}) - 1)")


# ---- shared frames ---------------------------------------------------------------------
define("scores_wide", "scores_wide AS (SELECT " + KEY_SQL
       + ", CAST(l_returnflag = 'R' AS INTEGER) AS y, "
       + ", ".join(f"round({e}, 3) AS {n}" for n, e in CANDIDATES.items()) + " FROM lineitem)")
define("scores_folds", "scores_folds AS (SELECT *, CAST("
       + rank_sql(HASH_KEY_SQL, KEY_SQL, FOLD_SEED, "y") + f" % {N_FOLDS} AS INTEGER) AS fold "
       "FROM scores_wide)", ("scores_wide",))
define("scores_long", "scores_long AS (SELECT " + KEY_SQL + ", y, fold, model, p FROM "
       "(UNPIVOT scores_folds ON " + ", ".join(CANDIDATES) + " INTO NAME model VALUE p))",
       ("scores_folds",))
define("fold_metrics", "fold_metrics AS (SELECT c.model, c.fold, a.auc AS roc_auc, "
       + ", ".join(f"{_d0(n, d)} AS {m}" for m, n, d in [
           ("f1", "2 * tp", "2 * tp + fp + fn"), ("precision", "tp", "tp + fp"),
           ("recall", "tp", "tp + fn"), ("accuracy", "tp + tn", "tp + fp + fn + tn")])
       + f" FROM ({counts_sql('scores_long', ['model', 'fold'])}) c LEFT JOIN "
       f"({auc_sql('scores_long', ['model', 'fold'])}) a ON c.model = a.model AND c.fold = a.fold)",
       ("scores_long",))
define("cv_summary", "cv_summary AS (SELECT model, "
       + ", ".join(f"avg({m}) AS cv_{m}_mean, stddev_samp({m}) AS cv_{m}_std"
                   for m in ["roc_auc", "f1", "precision", "recall", "accuracy"])
       + " FROM fold_metrics GROUP BY model)", ("fold_metrics",))
