"""Catalog: stateless feature operators (FX1-FX23) on the subscribers frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import features as fx
from tessera.plans.catalog import register
from tessera.plans.catalog.common import R, rnd
from tessera.plans.config import FEATURE_COLUMNS, FEATURE_CONFIG as CFG, ID_COLUMN
from tessera.plans.feature_chain import feature_chain
from tessera.session import table
from tessera.sources import frames

SUB = ("subscribers",)
FEAT = ("features",)


def _sub(spark, sf):
    return frames.subscribers(spark, sf)


@register("fx1_type_cast", """
SELECT customerID, CASE WHEN isnan(TRY_CAST(TotalCharges AS DOUBLE)) THEN NULL
                        ELSE TRY_CAST(TotalCharges AS DOUBLE) END AS TotalCharges
FROM subscribers""", SUB)
def fx1_type_cast(spark, sf):
    return fx.type_cast(_sub(spark, sf), CFG["type_cast"]).select(ID_COLUMN, "TotalCharges")


@register("fx2_binary_flag", """
SELECT customerID, tenure, CAST(tenure = 0 IS TRUE AS INTEGER) AS is_new_customer FROM subscribers""", SUB)
def fx2_binary_flag(spark, sf):
    return fx.binary_flags(_sub(spark, sf), CFG["binary_flags"]).select(
        ID_COLUMN, "tenure", "is_new_customer")


BIN = CFG["binary_encoding"]["columns"]


@register("fx3_binary_encode", "SELECT customerID, " + ", ".join(
    f"CAST({c} = 'Yes' IS TRUE AS INTEGER) AS {c}" for c in BIN) + " FROM subscribers", SUB)
def fx3_binary_encode(spark, sf):
    return fx.binary_encode(_sub(spark, sf), BIN, "Yes").select(ID_COLUMN, *BIN)


TERN = CFG["ternary_encoding"]["columns"]


@register("fx4_ordinal_map", "SELECT customerID, " + ", ".join(TERN) + " FROM features", FEAT)
def fx4_ordinal_map(spark, sf):
    te = CFG["ternary_encoding"]
    return fx.ordinal_encode(_sub(spark, sf), te["columns"], te["ordinal_map"]).select(ID_COLUMN, *TERN)


@register("fx4_unmapped_counts", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN "
    "('No phone service', 'No internet service', 'No', 'Yes')) AS " + c for c in TERN)
    + " FROM subscribers", SUB)
def fx4_unmapped_counts(spark, sf):
    te = CFG["ternary_encoding"]
    return fx.unmapped_counts(_sub(spark, sf), te["columns"], te["ordinal_map"])


@register("fx5_categorical_binary", "SELECT customerID, is_female FROM features", FEAT)
def fx5_categorical_binary(spark, sf):
    spec = [s for s in CFG["categorical_encoding"] if s["strategy"] == "binary"]
    out = fx.categorical_encode(_sub(spark, sf), spec)
    assert "gender" not in out.columns
    return out.select(ID_COLUMN, "is_female")


@register("fx6_categorical_ordinal", "SELECT customerID, contract_encoded FROM features", FEAT)
def fx6_categorical_ordinal(spark, sf):
    spec = [s for s in CFG["categorical_encoding"] if s["strategy"] == "ordinal"]
    return fx.categorical_encode(_sub(spark, sf), spec).select(ID_COLUMN, "contract_encoded")


ONE_HOT = ["internet_DSL", "internet_Fiber optic", "internet_No",
           "payment_Bank transfer (automatic)", "payment_Credit card (automatic)",
           "payment_Electronic check", "payment_Mailed check"]


@register("fx7_one_hot", "SELECT customerID, " + ", ".join(f'"{c}"' for c in ONE_HOT)
          + " FROM features", FEAT)
def fx7_one_hot(spark, sf):
    spec = [s for s in CFG["categorical_encoding"] if s["strategy"] == "one_hot"]
    return fx.categorical_encode(_sub(spark, sf), spec).select(
        ID_COLUMN, *[F.col(f"`{c}`") for c in ONE_HOT])


def _encoded(spark, sf):
    """subscribers through cast → flags → impute → binary → ternary → categorical."""
    cfg = {k: v for k, v in CFG.items()
           if k in ("type_cast", "binary_flags", "imputation", "binary_encoding",
                    "ternary_encoding", "categorical_encoding")}
    return feature_chain(_sub(spark, sf), cfg)


@register("fx9_n_services", "SELECT customerID, n_services FROM features", FEAT)
def fx9_n_services(spark, sf):
    d = CFG["derived_features"]
    return _encoded(spark, sf).select(ID_COLUMN, fx.n_services(d["service_columns"]).alias("n_services"))


@register("fx10_avg_monthly_per_service",
          f"SELECT customerID, round(avg_monthly_per_service, {R}) AS avg_monthly_per_service FROM features",
          FEAT)
def fx10_avg_monthly_per_service(spark, sf):
    out = fx.derived_features(_encoded(spark, sf), CFG["derived_features"])
    return out.select(ID_COLUMN, rnd("avg_monthly_per_service").alias("avg_monthly_per_service"))


@register("fx11_tenure_bin", "SELECT customerID, tenure, tenure_bin FROM features", FEAT)
def fx11_tenure_bin(spark, sf):
    d = CFG["derived_features"]
    return _sub(spark, sf).select(ID_COLUMN, "tenure",
                                  fx.tenure_bin(F.col("tenure"), d["tenure_bins"]).alias("tenure_bin"))


@register("fx12_has_fiber_monthly", "SELECT customerID, has_fiber_monthly FROM features", FEAT)
def fx12_has_fiber_monthly(spark, sf):
    out = fx.derived_features(_encoded(spark, sf), CFG["derived_features"])
    return out.select(ID_COLUMN, "has_fiber_monthly")


@register("fx13_ratio", f"""
SELECT customerID, round(monthly_to_total_ratio, {R}) AS monthly_to_total_ratio,
       round(total_per_month, {R}) AS total_per_month FROM features""", FEAT)
def fx13_ratio(spark, sf):
    out = fx.ratio_features(_encoded(spark, sf), CFG["ratio_features"])
    return out.select(ID_COLUMN, rnd("monthly_to_total_ratio").alias("monthly_to_total_ratio"),
                      rnd("total_per_month").alias("total_per_month"))


@register("fx13_ratio_unfilled", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       round(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END, {R}) AS tax_per_discount
FROM lineitem""")
def fx13_ratio_unfilled(spark, sf):
    li = table(spark, sf, "lineitem")
    spec = [{"name": "tax_per_discount", "numerator": "l_tax", "denominator": "l_discount"}]
    out = fx.ratio_features(li, spec)
    return out.select("l_orderkey", "l_linenumber", "l_partkey",
                      rnd("tax_per_discount").alias("tax_per_discount"))


@register("fx14_log1p_clip", f"""
SELECT customerID, round(log_tenure, {R}) AS log_tenure,
       round(log_TotalCharges, {R}) AS log_TotalCharges FROM features""", FEAT)
def fx14_log1p_clip(spark, sf):
    out = fx.log_transform(_encoded(spark, sf), CFG["log_transform"]["columns"])
    return out.select(ID_COLUMN, rnd("log_tenure").alias("log_tenure"),
                      rnd("log_TotalCharges").alias("log_TotalCharges"))


@register("fx14_log1p_clip_acctbal", f"""
SELECT c_custkey, round(ln(1 + CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END), {R}) AS log_c_acctbal
FROM customer""")
def fx14_log1p_clip_acctbal(spark, sf):
    out = fx.log_transform(table(spark, sf, "customer"), ["c_acctbal"])
    return out.select("c_custkey", rnd("log_c_acctbal").alias("log_c_acctbal"))


@register("fx15_constant_impute", "SELECT customerID, TotalCharges FROM features", FEAT)
def fx15_constant_impute(spark, sf):
    s = fx.type_cast(_sub(spark, sf), CFG["type_cast"])
    return fx.constant_impute(s, CFG["imputation"]).select(ID_COLUMN, "TotalCharges")


FEATURE_SQL_COLS = ", ".join(f'"{c}"' for c in FEATURE_COLUMNS + ["Churn"])


def _round_sql_cols():
    doubles = {"log_tenure", "MonthlyCharges", "TotalCharges", "log_TotalCharges",
               "monthly_to_total_ratio", "total_per_month", "avg_monthly_per_service"}
    return ", ".join(f'round("{c}", {R}) AS "{c}"' if c in doubles else f'"{c}"'
                     for c in FEATURE_COLUMNS + ["Churn"])


@register("fx16_select_features", "SELECT " + _round_sql_cols() + " FROM features", FEAT)
def fx16_select_features(spark, sf):
    out = fx.select_features(_encoded_full(spark, sf),
                             CFG["feature_selection"]["features_to_keep"])
    return fx.round_stats(out, R)


def _encoded_full(spark, sf):
    cfg = {k: v for k, v in CFG.items() if k != "feature_selection"}
    return feature_chain(_sub(spark, sf), cfg)


@register("fx17_drop_columns", """
SELECT gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines,
       InternetService, OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV,
       StreamingMovies, Contract, PaperlessBilling, PaymentMethod, MonthlyCharges, TotalCharges, Churn
FROM subscribers""", SUB)
def fx17_drop_columns(spark, sf):
    return fx.drop_columns(_sub(spark, sf), [ID_COLUMN])


# scoring-time raw rows: a batch that only carries some of the raw fields
SCORING_FIELDS = ["customerID", "tenure", "MonthlyCharges", "Contract", "InternetService",
                  "PhoneService", "MultipleLines"]


def _scoring_batch(spark, sf):
    raw = _sub(spark, sf).select(*SCORING_FIELDS)
    return fx.derive_total_charges(raw)


@register("fx20_derive_total_charges", """
SELECT customerID, tenure, MonthlyCharges,
       CASE WHEN tenure > 0 THEN CAST(CAST(tenure AS DOUBLE) * MonthlyCharges AS VARCHAR) ELSE '0' END
         AS TotalCharges,
       'Electronic check' AS PaymentMethod, 'No internet service' AS OnlineSecurity
FROM subscribers""", SUB)
def fx20_derive_total_charges(spark, sf):
    return _scoring_batch(spark, sf).select(ID_COLUMN, "tenure", "MonthlyCharges", "TotalCharges",
                                            "PaymentMethod", "OnlineSecurity")


@register("fx19_conform_to_schema", """
SELECT customerID, "payment_Electronic check", 0 AS "payment_Mailed check",
       0 AS "payment_Bank transfer (automatic)", 0 AS "payment_Credit card (automatic)",
       "internet_DSL", "internet_Fiber optic", "internet_No", round(TotalCharges, 6) AS TotalCharges
FROM (SELECT customerID, 1 AS "payment_Electronic check",
             CAST(InternetService = 'DSL' IS TRUE AS INTEGER) AS "internet_DSL",
             CAST(InternetService = 'Fiber optic' IS TRUE AS INTEGER) AS "internet_Fiber optic",
             CAST(InternetService = 'No' IS TRUE AS INTEGER) AS "internet_No",
             CASE WHEN tenure > 0 THEN CAST(tenure AS DOUBLE) * MonthlyCharges ELSE 0.0 END AS TotalCharges
      FROM subscribers)""", SUB)
def fx19_conform_to_schema(spark, sf):
    """Scoring batch through the chain: one-hot sees a single payment method
    (the default), conform restores the other three as 0."""
    out = feature_chain(_scoring_batch(spark, sf), keep=[ID_COLUMN])
    conf = fx.conform_to_schema(out, [ID_COLUMN] + FEATURE_COLUMNS, fill=0)
    cols = [ID_COLUMN, "payment_Electronic check", "payment_Mailed check",
            "payment_Bank transfer (automatic)", "payment_Credit card (automatic)",
            "internet_DSL", "internet_Fiber optic", "internet_No"]
    return conf.select(*[F.col(f"`{c}`") for c in cols], rnd("TotalCharges").alias("TotalCharges"))


@register("fx21_filter_rows", """
SELECT customerID, tenure, MonthlyCharges FROM subscribers
WHERE TRY_CAST(TotalCharges AS DOUBLE) IS NULL""", SUB)
def fx21_filter_rows(spark, sf):
    s = fx.type_cast(_sub(spark, sf), CFG["type_cast"])
    return fx.filter_rows(s, null_in="TotalCharges").select(ID_COLUMN, "tenure", "MonthlyCharges")


@register("fx21_filter_value", """
SELECT customerID, tenure FROM subscribers WHERE Contract = 'Two year' AND Churn = 'Yes'""", SUB)
def fx21_filter_value(spark, sf):
    return fx.filter_rows(_sub(spark, sf), equals={"Contract": "Two year", "Churn": "Yes"}).select(
        ID_COLUMN, "tenure")


@register("fx22_round_stats", """
SELECT l_returnflag, round(avg(l_extendedprice), 2) AS avg_price, round(avg(l_discount), 4) AS avg_disc
FROM lineitem GROUP BY l_returnflag""")
def fx22_round_stats(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.avg("l_extendedprice").alias("avg_price"), F.avg("l_discount").alias("avg_disc"))
    return fx.round_stats(fx.round_stats(g, 2, ["avg_price"]), 4, ["avg_disc"])


@register("fx23_features", "SELECT " + _round_sql_cols() + " FROM features", FEAT)
def fx23_features(spark, sf):
    return fx.round_stats(feature_chain(_sub(spark, sf)), R)
