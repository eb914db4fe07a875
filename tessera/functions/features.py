"""Stateless column operators (FX1-FX22).

Each operator is ``DataFrame -> DataFrame`` (usable with ``df.transform``)
built from JVM-side expressions only, so a whole chain stays inside one
whole-stage-codegen span and Catalyst prunes whatever the final ``select``
does not need.  Absent input columns are skipped (with a warning), as in the
original steps.

Null, never NaN: numeric parsing maps NaN to NULL so that aggregates skip
missing values the way the pandas original did.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

_NUMERIC_TARGETS = {"float64", "float32", "float", "double", "int64", "int32", "int",
                    "integer", "long", "bigint", "numeric"}


def _present(df: DataFrame, cols: Sequence[str], step: str) -> list[str]:
    have = set(df.columns)
    missing = [c for c in cols if c not in have]
    if missing:
        log.warning("%s: columns absent, skipped: %s", step, missing)
    return [c for c in cols if c in have]


# ---- FX1 ---------------------------------------------------------------------
def to_number(col: Column) -> Column:
    """Parse as double; unparsable or NaN → NULL (never raises under ANSI)."""
    x = col.cast("string").try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def type_cast(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """FX1: numeric targets are parsed (unparsable → NULL, width not applied);
    other targets are cast with ``try_cast``, leaving the column unchanged
    when every cast would fail is not checked (that would be a job)."""
    out = {}
    for spec in specs:
        c, dtype = spec["column"], str(spec["dtype"]).lower()
        if c not in df.columns:
            log.warning("type_cast: column %s absent, skipped", c)
            continue
        if dtype in _NUMERIC_TARGETS:
            out[c] = to_number(F.col(c))
        else:
            out[c] = F.col(c).try_cast(dtype)
    return df.withColumns(out) if out else df


# ---- FX2 / FX3 / FX5 -----------------------------------------------------------
def equals_flag(col: Column, value) -> Column:
    """0/1 of ``col == value``; NULL compares as not equal (→ 0)."""
    return F.coalesce(col == F.lit(value), F.lit(False)).cast("int")


def binary_flags(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """FX2: new 0/1 column per spec, original kept."""
    out = {s["new_column"]: equals_flag(F.col(s["column"]), s["value"])
           for s in specs if s["column"] in df.columns}
    return df.withColumns(out) if out else df


def binary_encode(df: DataFrame, columns: Sequence[str], positive_value="Yes") -> DataFrame:
    """FX3: in place, ``== positive`` → 1, everything else (NULL too) → 0."""
    cols = _present(df, columns, "binary_encode")
    return df.withColumns({c: equals_flag(F.col(c), positive_value) for c in cols}) if cols else df


# ---- FX4 / FX6 -------------------------------------------------------------------
def map_lookup(col: Column, mapping: dict) -> Column:
    """Dictionary lookup as a CASE chain; unmapped (and NULL) → NULL."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr


def ordinal_encode(df: DataFrame, columns: Sequence[str], mapping: dict) -> DataFrame:
    """FX4: ternary/ordinal map in place; unmapped → NULL."""
    cols = _present(df, columns, "ordinal_encode")
    return df.withColumns({c: map_lookup(F.col(c), mapping) for c in cols}) if cols else df


def unmapped_counts(df: DataFrame, columns: Sequence[str], mapping: dict) -> DataFrame:
    """Count of non-null values outside the map, per column, in one pass."""
    keys = list(mapping)
    return df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(keys)).alias(c)
                    for c in _present(df, columns, "unmapped_counts")])


# ---- FX5-FX8 categorical ------------------------------------------------------
def learn_categories(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values of one column: the names of its one-hot
    columns, so as many as the result will have columns."""
    return learn_categories_many(df, [column])[column]


def one_hot(df: DataFrame, column: str, categories: Sequence, prefix: str | None = None,
            drop_first: bool = False, keep_original: bool = False) -> DataFrame:
    """FX7: one 0/1 column per category, named ``prefix_value``; NULL → all 0."""
    prefix = prefix if prefix is not None else column.lower().replace(" ", "_")
    cats = list(categories)[1:] if drop_first else list(categories)
    out = {f"{prefix}_{v}": equals_flag(F.col(column), v) for v in cats}
    df = df.withColumns(out)
    return df if keep_original else df.drop(column)


def learn_categories_many(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-null values of several columns in ONE job.

    The columns are unpivoted to (column, value) and de-duplicated with a
    partial and a final aggregate; the driver gets the names of the columns
    that the encoded frame will have.
    """
    if not columns:
        return {}
    stack = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    rows = (df.selectExpr(f"stack({len(columns)}, {stack}) AS (__c, __v)")
              .where(F.col("__v").isNotNull()).distinct().collect())
    out: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        out[r["__c"]].append(r["__v"])
    for c, vals in out.items():
        typ = df.schema[c].dataType.typeName()
        cast = float if typ in ("double", "float") else int if typ in ("integer", "long", "short", "byte") else str
        out[c] = sorted(cast(v) for v in vals)
    return out


def categorical_encode(df: DataFrame, specs: Sequence[dict],
                       categories: dict | None = None) -> DataFrame:
    """FX5-FX8: binary / ordinal / one-hot per spec; the original column dropped.

    ``categories`` gives the one-hot categories per column; the missing ones
    are learned together in one small aggregate (:func:`learn_categories_many`).
    Unknown strategies raise at plan time (FX8, stricter than a warning).
    """
    categories = dict(categories or {})
    for spec in specs:
        if spec["strategy"] not in ("binary", "ordinal", "one_hot"):
            raise ValueError(f"unknown categorical strategy {spec['strategy']!r} for {spec['column']}")
    to_learn = [s["column"] for s in specs if s["strategy"] == "one_hot"
                and s["column"] in df.columns and s["column"] not in categories]
    categories.update(learn_categories_many(df, to_learn))
    for spec in specs:
        c, strategy = spec["column"], spec["strategy"]
        if c not in df.columns:
            log.warning("categorical_encode: column %s absent, skipped", c)
            continue
        if strategy == "binary":
            df = df.withColumn(spec["new_column"], equals_flag(F.col(c), spec["positive_value"])).drop(c)
        elif strategy == "ordinal":
            df = df.withColumn(spec["new_column"], map_lookup(F.col(c), spec["ordinal_map"])).drop(c)
        else:
            df = one_hot(df, c, categories[c], spec.get("prefix"), spec.get("drop_first", False))
    return df


# ---- FX9-FX12 derived ------------------------------------------------------------
def n_services(columns: Sequence[str], yes_code: int = 2) -> Column:
    """FX9: number of listed columns equal to the 'Yes' code."""
    return sum((equals_flag(F.col(c), yes_code) for c in columns), F.lit(0)).cast("int")


def safe_ratio(num: Column, den: Column, fill=None) -> Column:
    """num/den; den = 0, NULL or a non-finite result → NULL, then ``fill``."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    r = F.when(F.abs(r) == F.lit(float("inf")), F.lit(None).cast("double")).otherwise(r)
    r = F.when(F.isnan(r), F.lit(None).cast("double")).otherwise(r)
    return F.coalesce(r, F.lit(float(fill))) if fill is not None else r


def right_closed_bins(col: Column, edges: Sequence[float]) -> Column:
    """Label 0..n-1 of right-closed intervals (e[i], e[i+1]]; outside → NULL."""
    expr = None
    for i in range(len(edges) - 1):
        cond = (col > F.lit(edges[i])) & (col <= F.lit(edges[i + 1]))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def tenure_bin(col: Column, bins: Sequence[float]) -> Column:
    """FX11: edges ``[-1] + bins[1:]``, right-closed (tenure 0 joins the first bin)."""
    return right_closed_bins(col, [-1] + list(bins[1:]))


def derived_features(df: DataFrame, cfg: dict) -> DataFrame:
    """FX9-FX12: n_services, avg_monthly_per_service, tenure_bin, has_fiber_monthly."""
    out = {}
    services = _present(df, cfg["service_columns"], "derived_features")
    if services:
        out["n_services"] = n_services(services)
        mc = cfg.get("monthly_charges_column", "MonthlyCharges")
        if mc in df.columns:
            out["avg_monthly_per_service"] = safe_ratio(F.col(mc), n_services(services), 0.0)
    if cfg["tenure_column"] in df.columns:
        out["tenure_bin"] = tenure_bin(F.col(cfg["tenure_column"]), cfg["tenure_bins"])
    fib, con = cfg["fiber_column"], cfg["contract_column"]
    if fib in df.columns and con in df.columns:
        out["has_fiber_monthly"] = F.coalesce(
            (F.col(fib) == 1) & (F.col(con) == 0), F.lit(False)).cast("int")
    return df.withColumns(out) if out else df


# ---- FX13 / FX14 / FX15 -------------------------------------------------------
def ratio_features(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """FX13: named ratios with optional fill for undefined values."""
    out = {}
    for s in specs:
        if s["numerator"] in df.columns and s["denominator"] in df.columns:
            out[s["name"]] = safe_ratio(F.col(s["numerator"]), F.col(s["denominator"]),
                                        s.get("fill_nan"))
        else:
            log.warning("ratio_features: %s skipped (columns absent)", s["name"])
    return df.withColumns(out) if out else df


def log1p_clip(col: Column) -> Column:
    """FX14: log1p(max(x, 0)); NULL stays NULL (``greatest`` would invent 0)."""
    x = col.cast("double")
    return F.log1p(F.when(x < 0, F.lit(0.0)).otherwise(x))


def log_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FX14: new ``log_<col>`` per listed column."""
    cols = _present(df, columns, "log_transform")
    return df.withColumns({f"log_{c}": log1p_clip(F.col(c)) for c in cols}) if cols else df


def constant_impute(df: DataFrame, specs: Sequence[dict]) -> DataFrame:
    """FX15: NULL → configured constant (stateless strategies only)."""
    out = {}
    for s in specs:
        if s.get("strategy", "constant") != "constant":
            continue
        c = s["column"]
        if c in df.columns:
            out[c] = F.coalesce(F.col(c), F.lit(s["fill_value"]).cast(df.schema[c].dataType))
    return df.withColumns(out) if out else df


# ---- FX16-FX22 -------------------------------------------------------------------
def select_features(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """FX16: listed columns that exist, in listed order (plus ``keep`` columns)."""
    cols = _present(df, columns, "select_features")
    extra = [k for k in keep if k in df.columns and k not in cols]
    return df.select(*[F.col(f"`{c}`") for c in cols + extra])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """FX17."""
    return df.drop(*columns)


def sanitize_name(name: str) -> str:
    """FX18: '<' → 'lt_', '[' → '(', ']' → ')'."""
    return name.replace("<", "lt_").replace("[", "(").replace("]", ")")


def sanitize_names(df: DataFrame) -> DataFrame:
    """FX18 over every column (schema only, no job)."""
    ren = {c: sanitize_name(c) for c in df.columns if sanitize_name(c) != c}
    return df.withColumnsRenamed(ren) if ren else df


def conform_to_schema(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """FX19: reindex to the expected columns; absent ones filled with ``fill``."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns])


# FIXED VALUES: defaults for absent raw fields of a customer to be scored
RAW_DEFAULTS = {
    "gender": "Male", "SeniorCitizen": 0, "Partner": "No", "Dependents": "No",
    "tenure": 0, "PhoneService": "No", "MultipleLines": "No phone service",
    "InternetService": "No", "OnlineSecurity": "No internet service",
    "OnlineBackup": "No internet service", "DeviceProtection": "No internet service",
    "TechSupport": "No internet service", "StreamingTV": "No internet service",
    "StreamingMovies": "No internet service", "Contract": "Month-to-month",
    "PaperlessBilling": "No", "PaymentMethod": "Electronic check", "MonthlyCharges": 0.0,
}


def derive_total_charges(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """FX20: raw rows to be scored: absent or NULL fields take the defaults,
    TotalCharges = tenure × MonthlyCharges as text, "0" when tenure is 0."""
    defaults = RAW_DEFAULTS if defaults is None else defaults
    out = {}
    for c, v in defaults.items():
        out[c] = F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
    df = df.withColumns(out).withColumn("tenure", F.col("tenure").cast("bigint"))
    total = (F.col("tenure").cast("double") * F.col("MonthlyCharges").cast("double")).cast("string")
    return df.withColumn("TotalCharges", F.when(F.col("tenure") > 0, total).otherwise(F.lit("0")))


def filter_rows(df: DataFrame, *, null_in: str | None = None, equals: dict | None = None) -> DataFrame:
    """FX21: boolean masks (rows where a column is NULL; rows matching values)."""
    cond = F.lit(True)
    if null_in:
        cond = cond & F.col(null_in).isNull()
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def round_to(col: Column, digits: int) -> Column:
    """Round to ``digits`` decimals as ``round(x * 10^d) / 10^d`` in binary
    floating point (half away from zero).  Bit-identical to the SQL engines
    that round this way; ``F.round`` instead rounds the shortest decimal
    string, which differs on values such as 32.1203125."""
    m = float(10 ** digits)
    return F.round(col.cast("double") * F.lit(m)) / F.lit(m)


def round_stats(df: DataFrame, digits: int = 4, columns: Sequence[str] | None = None) -> DataFrame:
    """FX22: round floating columns (see :func:`round_to`; pandas is half-even)."""
    cols = columns or [f.name for f in df.schema.fields
                       if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: round_to(F.col(f"`{c}`"), digits) for c in cols}) if cols else df
