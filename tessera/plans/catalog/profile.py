"""Catalog: profiling and aggregations (AG1-AG15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile as ag
from tessera.plans.catalog import register
from tessera.plans.catalog.common import R, encoded_subscribers, rnd
from tessera.plans.config import BOX_COLUMNS, CORR_COLUMNS, RAW_COLUMNS, SKEW_COLUMNS, TERNARY_PROFILE
from tessera.sources import frames
from tessera.session import table


def _round_all(df, digits=R):
    return ag_round(df, digits)


def ag_round(df, digits=R):
    from tessera.functions.features import round_stats
    return round_stats(df, digits)


# ---- AG1 -----------------------------------------------------------------------
@register("ag1_table_overview", """
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE TotalCharges IS NOT NULL AND (TRY_CAST(TotalCharges AS DOUBLE) IS NULL
                        OR isnan(TRY_CAST(TotalCharges AS DOUBLE)))) AS unparsable_TotalCharges,
       21 AS n_columns
FROM subscribers""", ("subscribers",))
def ag1_table_overview(spark, sf):
    return ag.table_overview(frames.subscribers(spark, sf), ["TotalCharges"])


# ---- AG2 -----------------------------------------------------------------------
def _missing_sql(cols, src):
    parts = [f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS missing_count, "
             f"round((count(*) - count(\"{c}\")) * 100.0 / count(*), 4) AS missing_percent FROM {src}"
             for c in cols]
    return "\nUNION ALL ".join(parts)


@register("ag2_missing_profile", _missing_sql(list(RAW_COLUMNS), "enc"), ("enc",))
def ag2_missing_profile(spark, sf):
    return ag.missing_profile(encoded_subscribers(spark, sf), list(RAW_COLUMNS))


# ---- AG3 -----------------------------------------------------------------------
@register("ag3_missing_explained_by", """
SELECT count(*) FILTER (WHERE TotalCharges IS NULL) AS n_missing,
       count(*) FILTER (WHERE TotalCharges IS NULL AND tenure = 0) AS n_missing_and_condition,
       coalesce(bool_and(CASE WHEN TotalCharges IS NULL THEN coalesce(tenure = 0, false) END), true)
         AS all_explained
FROM enc""", ("enc",))
def ag3_missing_explained_by(spark, sf):
    df = encoded_subscribers(spark, sf)
    return ag.missing_explained_by(df, F.col("TotalCharges"), F.col("tenure") == 0)


# ---- AG4 -----------------------------------------------------------------------
@register("ag4_value_counts_contract", """
SELECT Contract AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM subscribers GROUP BY Contract""", ("subscribers",))
def ag4_value_counts_contract(spark, sf):
    return ag.value_counts(frames.subscribers(spark, sf), "Contract")


@register("ag4_value_counts_orderstatus", """
SELECT o_orderstatus AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM orders GROUP BY o_orderstatus""")
def ag4_value_counts_orderstatus(spark, sf):
    return ag.value_counts(table(spark, sf, "orders"), "o_orderstatus")


@register("ag4_target_distribution", """
SELECT Churn AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share
FROM enc GROUP BY Churn""", ("enc",))
def ag4_target_distribution(spark, sf):
    return ag.value_counts(encoded_subscribers(spark, sf), "Churn")


# ---- AG5 -----------------------------------------------------------------------
def _rate_sql(col):
    return (f"SELECT {col}, round(avg(Churn), 4) AS churn_rate, count(*) AS n FROM enc "
            f"GROUP BY {col} ORDER BY churn_rate DESC, {col}")


@register("ag5_churn_by_contract", _rate_sql("Contract"), ("enc",))
def ag5_churn_by_contract(spark, sf):
    return ag.rate_by_group(encoded_subscribers(spark, sf), "Contract")


@register("ag5_churn_by_internet", _rate_sql("InternetService"), ("enc",))
def ag5_churn_by_internet(spark, sf):
    return ag.rate_by_group(encoded_subscribers(spark, sf), "InternetService")


@register("ag5_churn_by_payment", _rate_sql("PaymentMethod"), ("enc",))
def ag5_churn_by_payment(spark, sf):
    return ag.rate_by_group(encoded_subscribers(spark, sf), "PaymentMethod")


# ---- AG6 -----------------------------------------------------------------------
def _ternary_sql():
    vals = ", ".join(f"'{v}'" for v in TERNARY_PROFILE["values"])
    parts = [f"SELECT '{c}' AS feature, {c} AS value, Churn FROM enc" for c in TERNARY_PROFILE["columns"]]
    return (f"SELECT feature, value, round(avg(Churn), 4) AS churn_rate, count(*) AS n FROM ("
            + " UNION ALL ".join(parts) + f") WHERE value IN ({vals}) GROUP BY feature, value")


@register("ag6_rate_by_feature_value", _ternary_sql(), ("enc",))
def ag6_rate_by_feature_value(spark, sf):
    return ag.rate_by_feature_value(encoded_subscribers(spark, sf), TERNARY_PROFILE["columns"],
                                    TERNARY_PROFILE["values"])


# ---- AG7 -----------------------------------------------------------------------
def _skew_sql(cols, src):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(CASE WHEN count({c}) > 2 THEN skewness(CAST({c} AS DOUBLE)) END, {R}) "
        f"AS skewness FROM {src}" for c in cols)


@register("ag7_skewness", _skew_sql(SKEW_COLUMNS, "enc"), ("enc",))
def ag7_skewness(spark, sf):
    return ag_round(ag.skewness(encoded_subscribers(spark, sf), SKEW_COLUMNS))


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("ag7_skewness_lineitem", _skew_sql(LI_NUM, "lineitem"))
def ag7_skewness_lineitem(spark, sf):
    return ag_round(ag.skewness(table(spark, sf, "lineitem"), LI_NUM))


# ---- AG8 -----------------------------------------------------------------------
def _describe_sql(cols, src):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), {R}) AS mean, "
        f"round(stddev_samp({c}), {R}) AS std, round(min({c}), {R}) AS min, "
        f"round(quantile_cont({c}, 0.25), {R}) AS p25, round(quantile_cont({c}, 0.5), {R}) AS p50, "
        f"round(quantile_cont({c}, 0.75), {R}) AS p75, round(max({c}), {R}) AS max "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {src})" for c in cols)


@register("ag8_describe", _describe_sql(BOX_COLUMNS, "enc"), ("enc",))
def ag8_describe(spark, sf):
    return ag_round(ag.describe(encoded_subscribers(spark, sf), BOX_COLUMNS))


@register("ag8_describe_lineitem", _describe_sql(LI_NUM, "lineitem"))
def ag8_describe_lineitem(spark, sf):
    return ag_round(ag.describe(table(spark, sf, "lineitem"), LI_NUM))


# ---- AG9 -----------------------------------------------------------------------
AG9_COLS = ["gender", "InternetService", "Contract", "PaymentMethod", "tenure", "SeniorCitizen"]


@register("ag9_distinct_profile", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, CAST(min({c}) AS VARCHAR) AS min, "
    f"CAST(max({c}) AS VARCHAR) AS max FROM subscribers" for c in AG9_COLS), ("subscribers",))
def ag9_distinct_profile(spark, sf):
    return ag.distinct_profile(frames.subscribers(spark, sf), AG9_COLS)


ORD9 = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@register("ag9_distinct_profile_orders", "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, CAST(min({c}) AS VARCHAR) AS min, "
    f"CAST(max({c}) AS VARCHAR) AS max FROM orders" for c in ORD9))
def ag9_distinct_profile_orders(spark, sf):
    return ag.distinct_profile(table(spark, sf, "orders"), ORD9)


# ---- AG10 / AG11 -----------------------------------------------------------------
def _q(c):
    return f'"{c}"'


@register("ag10_corr_with_target", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({_q(c)} AS DOUBLE), CAST(Churn AS DOUBLE)), {R}) AS corr "
    f"FROM features" for c in CORR_COLUMNS if c != "Churn"), ("features",))
def ag10_corr_with_target(spark, sf):
    return ag_round(ag.corr_with_target(frames.features(spark, sf), CORR_COLUMNS))


def _corr_matrix_sql():
    parts = []
    for i, a in enumerate(CORR_COLUMNS):
        for b in CORR_COLUMNS[i + 1:]:
            e = f"round(corr(CAST({_q(a)} AS DOUBLE), CAST({_q(b)} AS DOUBLE)), {R})"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {e} AS corr FROM features")
            parts.append(f"SELECT '{b}' AS a, '{a}' AS b, {e} AS corr FROM features")
        parts.append(f"SELECT '{a}' AS a, '{a}' AS b, CASE WHEN stddev_samp({_q(a)}) > 0 THEN 1.0 END "
                     f"AS corr FROM features")
    return "\nUNION ALL ".join(parts)


@register("ag11_corr_matrix", _corr_matrix_sql(), ("features",))
def ag11_corr_matrix(spark, sf):
    return ag_round(ag.corr_matrix(frames.features(spark, sf), CORR_COLUMNS))


# ---- AG12 ---------------------------------------------------------------------------
def _hist_sql(col, bins, by, src):
    by_sel = f", {by}" if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
WITH st AS (SELECT min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi FROM {src}),
b AS (
  SELECT CASE WHEN hi = lo THEN 0
              WHEN CAST({col} AS DOUBLE) = hi THEN {bins - 1}
              ELSE least({bins - 1}, CAST(floor((CAST({col} AS DOUBLE) - lo) / ((hi - lo) / {float(bins)})) AS INTEGER))
         END AS bin{by_sel}, lo, hi
  FROM {src}, st WHERE {col} IS NOT NULL)
SELECT bin{by_sel}, count(*) AS count,
       round(lo + bin * ((hi - lo) / {float(bins)}), {R}) AS bin_lo,
       round(lo + (bin + 1) * ((hi - lo) / {float(bins)}), {R}) AS bin_hi,
       round(count(*) / (sum(count(*)) OVER ({part}) * ((hi - lo) / {float(bins)})), {R}) AS density
FROM b GROUP BY bin{by_sel}, lo, hi"""


@register("ag12_histogram_ratio_by_class",
          _hist_sql("monthly_to_total_ratio", 40, "Churn", "features"), ("features",))
def ag12_histogram_ratio_by_class(spark, sf):
    return ag_round(ag.histogram(frames.features(spark, sf), "monthly_to_total_ratio", 40,
                                 by="Churn", density=True))


@register("ag12_histogram_extendedprice",
          _hist_sql("l_extendedprice", 30, None, "lineitem"))
def ag12_histogram_extendedprice(spark, sf):
    return ag_round(ag.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30, density=True))


# ---- AG13 ---------------------------------------------------------------------------
def _box_sql(col, by, src):
    return f"""
WITH x AS (SELECT {by}, CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
q AS (SELECT {by}, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM x GROUP BY {by}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.{by}, count(*) AS n, round(min(x), {R}) AS min, round(any_value(q1), {R}) AS q1,
       round(any_value(median), {R}) AS median, round(any_value(q3), {R}) AS q3,
       round(max(x), {R}) AS max,
       round(min(x) FILTER (WHERE x >= lo_f AND x <= hi_f), {R}) AS whisker_lo,
       round(max(x) FILTER (WHERE x >= lo_f AND x <= hi_f), {R}) AS whisker_hi,
       count(*) FILTER (WHERE NOT (x >= lo_f AND x <= hi_f)) AS n_outliers
FROM x JOIN f ON x.{by} = f.{by} GROUP BY f.{by}"""


@register("ag13_box_stats_tenure", _box_sql("tenure", "Churn", "enc"), ("enc",))
def ag13_box_stats_tenure(spark, sf):
    return ag_round(ag.box_stats(encoded_subscribers(spark, sf), "tenure", "Churn"))


@register("ag13_box_stats_total", _box_sql("TotalCharges", "Churn", "enc"), ("enc",))
def ag13_box_stats_total(spark, sf):
    return ag_round(ag.box_stats(encoded_subscribers(spark, sf), "TotalCharges", "Churn"))


@register("ag13_box_stats_quantity", _box_sql("l_quantity", "l_returnflag", "lineitem"))
def ag13_box_stats_quantity(spark, sf):
    return ag_round(ag.box_stats(table(spark, sf, "lineitem"), "l_quantity", "l_returnflag"))


# ---- AG14 / AG15 -------------------------------------------------------------------------
@register("ag14_top_k_acctbal", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 10""")
def ag14_top_k_acctbal(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return ag.top_k(c, "c_acctbal", 10, by_abs=True, tiebreak=["c_custkey"])


@register("ag15_sample_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('42-' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100""")
def ag15_sample_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return ag.sample_rows(o, 100, 42, ["o_orderkey"])
