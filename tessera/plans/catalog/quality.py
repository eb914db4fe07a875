"""Catalog: data-quality checks (QC1-QC7)."""

from __future__ import annotations

import json

from tessera.operators import quality as qc
from tessera.operators.quality import Check
from tessera.plans.catalog import register
from tessera.plans.config import QUALITY_SUITE, RAW_COLUMNS
from tessera.session import table
from tessera.sources import frames


def _lit(v):
    return f"'{v}'" if isinstance(v, str) else repr(v)


def _pct(num, den):
    return f"round(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) * 100.0 / {den} END, 6)"


def _row(i, chk, n, miss, miss_pct, unexp, unexp_pct, pct_total, pct_nm, observed, success, src):
    col = "NULL" if chk.column is None else f"'{chk.column}'"
    kw = json.dumps(chk.kwargs, sort_keys=True).replace("'", "''")
    return (f"SELECT {i} AS check_id, '{chk.type}' AS type, CAST({col} AS VARCHAR) AS \"column\", "
            f"'{kw}' AS kwargs, CAST({n} AS BIGINT) AS element_count, "
            f"CAST({miss} AS BIGINT) AS missing_count, CAST({miss_pct} AS DOUBLE) AS missing_percent, "
            f"CAST({unexp} AS BIGINT) AS unexpected_count, CAST({unexp_pct} AS DOUBLE) AS unexpected_percent, "
            f"CAST({pct_total} AS DOUBLE) AS unexpected_percent_total, "
            f"CAST({pct_nm} AS DOUBLE) AS unexpected_percent_nonmissing, "
            f"CAST({observed} AS DOUBLE) AS observed_value, CAST({success} AS BOOLEAN) AS success "
            f"FROM {src}")


def check_sql(i: int, chk: Check, src: str, schema_cols) -> str:
    kw = chk.kwargs
    if chk.type == "row_count_between":
        conds = []
        if kw.get("min_value") is not None:
            conds.append(f"count(*) >= {kw['min_value']}")
        if kw.get("max_value") is not None:
            conds.append(f"count(*) <= {kw['max_value']}")
        return _row(i, chk, "count(*)", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL",
                    "count(*)", " AND ".join(conds) or "true", src)
    if chk.type == "columns_match_set":
        ok = set(kw["column_set"]) == set(schema_cols)
        return _row(i, chk, "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL",
                    "true" if ok else "false", f"(SELECT 1) AS one_row_{i}")
    key = chk.key
    anynull = " OR ".join(f'"{k}" IS NULL' for k in key)
    n, miss = "count(*)", f"count(*) FILTER (WHERE {anynull})"
    nm = f"({n} - {miss})"
    mostly = float(kw.get("mostly", 1.0))
    c = f'"{chk.column}"'
    if chk.type == "not_null":
        succ = f"CASE WHEN {n} = 0 THEN true ELSE CAST({n} - {miss} AS DOUBLE) / {n} >= {mostly} END"
        return _row(i, chk, n, miss, _pct(miss, n), miss, _pct(miss, n), _pct(miss, n),
                    _pct(miss, nm), "NULL", succ, src)
    if chk.type == "in_set":
        vals = ", ".join(_lit(v) for v in kw["value_set"])
        unexp = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN ({vals}))"
    elif chk.type == "between":
        bad = []
        if kw.get("min_value") is not None:
            bad.append(f"{c} < {kw['min_value']}")
        if kw.get("max_value") is not None:
            bad.append(f"{c} > {kw['max_value']}")
        unexp = f"count(*) FILTER (WHERE {c} IS NOT NULL AND ({' OR '.join(bad)}))"
    elif chk.type == "unique":
        keys = ", ".join(f'"{k}"' for k in key)
        nn = " AND ".join(f'"{k}" IS NOT NULL' for k in key)
        unexp = (f"(SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM {src} WHERE {nn} "
                 f"GROUP BY {keys} HAVING count(*) > 1))")
    else:
        raise ValueError(chk.type)
    succ = (f"CASE WHEN {nm} = 0 THEN true ELSE CAST({nm} - {unexp} AS DOUBLE) / {nm} >= {mostly} END")
    return _row(i, chk, n, miss, _pct(miss, n), unexp, _pct(unexp, nm), _pct(unexp, n),
                _pct(unexp, nm), "NULL", succ, src)


def suite_sql(checks, src, schema_cols) -> str:
    return "\nUNION ALL ".join(check_sql(i, c, src, schema_cols) for i, c in enumerate(checks))


ROWCOUNT = [Check("row_count_between", None, {"min_value": 6000, "max_value": 8000})]
NOT_NULL = [Check("not_null", "customerID"), Check("not_null", "TotalCharges", {"mostly": 0.99})]
UNIQUE_SUB = [Check("unique", "customerID")]
LI_PAIR = [Check("unique", "l_orderkey", {"columns": ["l_orderkey", "l_linenumber"]})]
ORD_CHECKS = [Check("not_null", "o_orderkey"), Check("unique", "o_orderkey"),
              Check("in_set", "o_orderstatus", {"value_set": ["F", "O", "P"]})]
CUST_CHECKS = [Check("not_null", "c_name"), Check("unique", "c_name")]
LI_RANGE = [Check("between", "l_discount", {"min_value": 0, "max_value": 0.1}),
            Check("between", "l_quantity", {"min_value": 1, "max_value": 40})]
SUB_SET_RANGE = [Check("in_set", "gender", {"value_set": ["Male", "Female"]}),
                 Check("in_set", "SeniorCitizen", {"value_set": [0, 1]}),
                 Check("between", "MonthlyCharges", {"min_value": 0.0, "max_value": 150.0}),
                 Check("between", "tenure", {"min_value": 0, "max_value": 72})]
SUITE = qc.checks_from_suite(QUALITY_SUITE)


@register("qc1_row_count_between", suite_sql(ROWCOUNT, "subscribers", RAW_COLUMNS), ("subscribers",))
def qc1_row_count_between(spark, sf):
    return qc.run_checks(frames.subscribers(spark, sf), ROWCOUNT)


@register("qc3_not_null", suite_sql(NOT_NULL, "subscribers", RAW_COLUMNS), ("subscribers",))
def qc3_not_null(spark, sf):
    return qc.run_checks(frames.subscribers(spark, sf), NOT_NULL)


@register("qc4_unique_customer_id", suite_sql(UNIQUE_SUB, "subscribers", RAW_COLUMNS), ("subscribers",))
def qc4_unique_customer_id(spark, sf):
    return qc.run_checks(frames.subscribers(spark, sf), UNIQUE_SUB)


@register("qc4_unique_lineitem_pair", suite_sql(LI_PAIR, "lineitem", []))
def qc4_unique_lineitem_pair(spark, sf):
    return qc.run_checks(table(spark, sf, "lineitem"), LI_PAIR)


@register("qc4_orders_checks", suite_sql(ORD_CHECKS, "orders", []))
def qc4_orders_checks(spark, sf):
    return qc.run_checks(table(spark, sf, "orders"), ORD_CHECKS)


@register("qc4_customer_checks", suite_sql(CUST_CHECKS, "customer", []))
def qc4_customer_checks(spark, sf):
    return qc.run_checks(table(spark, sf, "customer"), CUST_CHECKS)


@register("qc5_qc6_subscriber_domains", suite_sql(SUB_SET_RANGE, "subscribers", RAW_COLUMNS),
          ("subscribers",))
def qc5_qc6_subscriber_domains(spark, sf):
    return qc.run_checks(frames.subscribers(spark, sf), SUB_SET_RANGE)


@register("qc6_between_lineitem", suite_sql(LI_RANGE, "lineitem", []))
def qc6_between_lineitem(spark, sf):
    return qc.run_checks(table(spark, sf, "lineitem"), LI_RANGE)


@register("qc7_run_suite", suite_sql(SUITE, "subscribers", RAW_COLUMNS), ("subscribers",))
def qc7_run_suite(spark, sf):
    return qc.run_suite(frames.subscribers(spark, sf), QUALITY_SUITE)


@register("qc7_suite_summary", "SELECT coalesce(bool_and(success), true) AS success, count(*) AS total, "
          "count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed FROM ("
          + suite_sql(SUITE, "subscribers", RAW_COLUMNS) + ")", ("subscribers",))
def qc7_suite_summary(spark, sf):
    return qc.suite_summary(qc.run_suite(frames.subscribers(spark, sf), QUALITY_SUITE))
