"""Churn configuration: feature chain, quality suite and monitoring policy.

FIXED VALUES: every literal below is policy that must equal the original
project's configuration for results to match (column names, category
labels, maps, bins, thresholds).  They are plain data; the mechanism lives in
``tessera.functions.features``, ``tessera.operators.quality`` and friends.
"""

from __future__ import annotations

TARGET = "Churn"
ID_COLUMN = "customerID"

# ---- raw table (fixed values) ------------------------------------------------
RAW_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]
ADDON_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection",
                 "TechSupport", "StreamingTV", "StreamingMovies"]
PAYMENT_METHODS = ["Electronic check", "Mailed check",
                   "Bank transfer (automatic)", "Credit card (automatic)"]

# ---- feature chain (fixed values) -------------------------------------------
FEATURE_CONFIG: dict = {
    "type_cast": [{"column": "TotalCharges", "dtype": "float64"}],
    "binary_flags": [{"column": "tenure", "value": 0, "new_column": "is_new_customer"}],
    "imputation": [{"column": "TotalCharges", "strategy": "constant", "fill_value": 0}],
    "binary_encoding": {
        "columns": ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"],
        "positive_value": "Yes",
    },
    "ternary_encoding": {
        "columns": ["MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
                    "TechSupport", "StreamingTV", "StreamingMovies"],
        "ordinal_map": {"No phone service": 0, "No internet service": 0, "No": 1, "Yes": 2},
    },
    "categorical_encoding": [
        {"column": "gender", "strategy": "binary", "positive_value": "Female",
         "new_column": "is_female"},
        {"column": "InternetService", "strategy": "one_hot", "prefix": "internet",
         "drop_first": False},
        {"column": "Contract", "strategy": "ordinal", "new_column": "contract_encoded",
         "ordinal_map": {"Month-to-month": 0, "One year": 1, "Two year": 2}},
        {"column": "PaymentMethod", "strategy": "one_hot", "prefix": "payment",
         "drop_first": False},
    ],
    "derived_features": {
        "service_columns": ["OnlineSecurity", "OnlineBackup", "DeviceProtection",
                            "TechSupport", "StreamingTV", "StreamingMovies"],
        "tenure_column": "tenure",
        "tenure_bins": [0, 12, 24, 48, 72],
        "fiber_column": "internet_Fiber optic",
        "contract_column": "contract_encoded",
        "monthly_charges_column": "MonthlyCharges",
    },
    "ratio_features": [
        {"name": "monthly_to_total_ratio", "numerator": "MonthlyCharges",
         "denominator": "TotalCharges", "fill_nan": 0},
        {"name": "total_per_month", "numerator": "TotalCharges",
         "denominator": "tenure", "fill_nan": 0},
    ],
    "log_transform": {"columns": ["TotalCharges", "tenure"]},
    "feature_selection": {
        "target": "Churn",
        "features_to_keep": [
            "is_female", "SeniorCitizen", "Partner", "Dependents",
            "PhoneService", "MultipleLines",
            "internet_DSL", "internet_Fiber optic", "internet_No",
            "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
            "StreamingTV", "StreamingMovies",
            "contract_encoded", "PaperlessBilling",
            "payment_Bank transfer (automatic)", "payment_Credit card (automatic)",
            "payment_Electronic check", "payment_Mailed check",
            "tenure", "log_tenure", "MonthlyCharges", "TotalCharges", "log_TotalCharges",
            "monthly_to_total_ratio", "total_per_month",
            "n_services", "tenure_bin", "has_fiber_monthly", "avg_monthly_per_service",
            "is_new_customer",
            "Churn",
        ],
    },
}
FEATURE_COLUMNS = [c for c in FEATURE_CONFIG["feature_selection"]["features_to_keep"]
                   if c != TARGET]

# ---- quality suite (fixed values) -------------------------------------------
_YES_NO = ["Yes", "No"]
_ADDON_DOMAIN = ["Yes", "No", "No internet service"]
QUALITY_SUITE: dict = {
    "table": [
        {"type": "row_count_between", "min_value": 6000, "max_value": 8000},
        {"type": "columns_match_set", "column_set": RAW_COLUMNS, "exact_match": True},
    ],
    "columns": {
        "customerID": [{"type": "not_null"}, {"type": "unique"}],
        "gender": [{"type": "not_null"}, {"type": "in_set", "value_set": ["Male", "Female"]}],
        "SeniorCitizen": [{"type": "not_null"}, {"type": "in_set", "value_set": [0, 1]}],
        "Partner": [{"type": "not_null"}, {"type": "in_set", "value_set": _YES_NO}],
        "Dependents": [{"type": "not_null"}, {"type": "in_set", "value_set": _YES_NO}],
        "tenure": [{"type": "not_null"}, {"type": "between", "min_value": 0, "max_value": 72}],
        "PhoneService": [{"type": "not_null"}, {"type": "in_set", "value_set": _YES_NO}],
        "MultipleLines": [{"type": "not_null"},
                          {"type": "in_set", "value_set": ["Yes", "No", "No phone service"]}],
        "InternetService": [{"type": "not_null"},
                            {"type": "in_set", "value_set": ["DSL", "Fiber optic", "No"]}],
        "OnlineSecurity": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "OnlineBackup": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "DeviceProtection": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "TechSupport": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "StreamingTV": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "StreamingMovies": [{"type": "not_null"}, {"type": "in_set", "value_set": _ADDON_DOMAIN}],
        "Contract": [{"type": "not_null"},
                     {"type": "in_set", "value_set": ["Month-to-month", "One year", "Two year"]}],
        "PaperlessBilling": [{"type": "not_null"}, {"type": "in_set", "value_set": _YES_NO}],
        "PaymentMethod": [{"type": "not_null"}, {"type": "in_set", "value_set": PAYMENT_METHODS}],
        "MonthlyCharges": [{"type": "not_null"},
                           {"type": "between", "min_value": 0.0, "max_value": 150.0}],
        "TotalCharges": [{"type": "not_null", "mostly": 0.99}],
        "Churn": [{"type": "not_null"}, {"type": "in_set", "value_set": _YES_NO}],
    },
}

# ---- exploratory profile (fixed values) -------------------------------------
RATE_GROUP_COLUMNS = ["Contract", "InternetService", "PaymentMethod"]
TERNARY_PROFILE = {"columns": ["OnlineSecurity", "TechSupport", "StreamingTV"],
                   "values": ["No internet service", "No", "Yes"]}
SKEW_COLUMNS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"]
CORR_COLUMNS = ["SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges",
                "log_tenure", "log_TotalCharges", "monthly_to_total_ratio",
                "total_per_month", "Churn"]
BOX_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]

# ---- modelling and monitoring policy (fixed values) -------------------------
SEED = 13
HOLDOUT_SHARE = 0.20
N_FOLDS = 5
ROBUSTNESS_BANDS = [(0.05, "good"), (0.10, "moderate")]  # else "bad"
PROMOTION_TIE_EPS = 1e-6
CALIBRATION_BINS = 10

# ---- model input policy (fixed values) --------------------------------------
SCALE_COLUMNS = ["tenure", "log_tenure", "MonthlyCharges", "TotalCharges", "log_TotalCharges",
                 "monthly_to_total_ratio", "total_per_month", "n_services",
                 "avg_monthly_per_service"]
PCA_COMPONENTS = 15
RFE_FEATURES = 15
SVC_TUNING_ROWS = 3000
