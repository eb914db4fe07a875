"""Declarative data-quality checks (QC1-QC9) compiled into one pass.

A suite is a list of table checks and per-column checks (same shape as the
original configuration).  :func:`run_suite` compiles every count into ONE
aggregate over the table; each ``unique`` check adds one grouped count on its
key (partial aggregation first, so a hot value is pre-combined before the
shuffle).  The result is one row per check with the usual result fields and
a summary row set; no per-check job, nothing collected but the final rows.

Result fields per check: element_count, missing_count, missing_percent,
unexpected_count, unexpected_percent (of non-missing; of all rows for
``not_null``), unexpected_percent_total, unexpected_percent_nonmissing,
observed_value (row count check), success.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.features import round_to



@dataclass
class Check:
    type: str
    column: str | None = None
    kwargs: dict = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        if self.column is None:
            return []
        return list(self.kwargs.get("columns") or [self.column])


def checks_from_suite(suite: dict) -> list[Check]:
    """Flatten ``{"table": [...], "columns": {col: [...]}}`` to checks, in order."""
    out = [Check(c["type"], None, {k: v for k, v in c.items() if k != "type"})
           for c in suite.get("table", [])]
    for col, specs in suite.get("columns", {}).items():
        out += [Check(s["type"], col, {k: v for k, v in s.items() if k != "type"}) for s in specs]
    return out


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _pct(num: Column, den: Column) -> Column:
    return round_to(F.when(den > 0, num.cast("double") * 100.0 / den), 6)


def _unique_dupes(df: DataFrame, key: Sequence[str]) -> Column:
    """Scalar subquery: rows that belong to a duplicated key (NULL keys left out)."""
    nn = F.lit(True)
    for k in key:
        nn = nn & _q(k).isNotNull()
    g = (df.where(nn).groupBy(*[_q(k) for k in key]).agg(F.count(F.lit(1)).alias("__c"))
           .where(F.col("__c") > 1).agg(F.coalesce(F.sum("__c"), F.lit(0)).cast("bigint")))
    return g.scalar()


def _in_set_cond(col: Column, values: Sequence) -> Column:
    return col.isin(list(values))


def _any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in cols:
        cond = cond | _q(k).isNull()
    return cond


def _counts(i: int, chk: Check, df: DataFrame, cols: list[str]) -> tuple[list[Column], Column]:
    """Aggregates needed by one check (named ``m{i}``/``u{i}``) and the
    check's descriptor struct, which only references those names."""
    typ, kw = chk.type, chk.kwargs
    aggs: list[Column] = []
    miss = unexp = F.lit(None).cast("bigint")
    table_ok = F.lit(None).cast("boolean")
    if typ == "row_count_between":
        cond = F.lit(True)
        if kw.get("min_value") is not None:
            cond = cond & (F.col("__n") >= kw["min_value"])
        if kw.get("max_value") is not None:
            cond = cond & (F.col("__n") <= kw["max_value"])
        table_ok = cond
    elif typ == "columns_match_set":
        want = set(kw["column_set"])
        table_ok = F.lit(want == set(cols) if kw.get("exact_match", True) else want <= set(cols))
    elif any(k not in cols for k in chk.key):
        table_ok = F.lit(False)  # absent column: fails without touching the data
    else:
        c = _q(chk.column)
        aggs.append(F.count_if(_any_null(chk.key)).alias(f"m{i}"))
        miss = F.col(f"m{i}")
        if typ == "not_null":
            unexp = miss
        elif typ == "in_set":
            aggs.append(F.count_if(c.isNotNull() & ~c.isin(list(kw["value_set"]))).alias(f"u{i}"))
            unexp = F.col(f"u{i}")
        elif typ == "between":
            bad = F.lit(False)
            if kw.get("min_value") is not None:
                bad = bad | (c < F.lit(kw["min_value"]))
            if kw.get("max_value") is not None:
                bad = bad | (c > F.lit(kw["max_value"]))
            aggs.append(F.count_if(c.isNotNull() & bad).alias(f"u{i}"))
            unexp = F.col(f"u{i}")
        elif typ == "unique":
            unexp = _unique_dupes(df, chk.key)
        else:
            raise ValueError(f"unknown check type {typ!r}")
    desc = F.struct(F.lit(i).alias("check_id"), F.lit(typ).alias("type"),
                    F.lit(chk.column).cast("string").alias("column"),
                    F.lit(json.dumps(chk.kwargs, sort_keys=True)).alias("kwargs"),
                    F.lit(float(kw.get("mostly", 1.0))).alias("mostly"),
                    miss.cast("bigint").alias("missing"), unexp.cast("bigint").alias("unexpected"),
                    table_ok.alias("table_ok"))
    return aggs, desc


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """QC1-QC7: one row per check.

    One aggregate over ``df`` computes the row count and, per column check,
    a NULL count and an unexpected count (flat named columns, so the
    generated code stays small); each ``unique`` check is one grouped count
    on its key, referenced as a scalar subquery.  The one-row result is
    exploded into check rows and every ratio and verdict is one generic
    expression over those rows.
    """
    cols = df.columns
    aggs, descs = [F.count(F.lit(1)).alias("__n")], []
    for i, chk in enumerate(checks):
        a, d = _counts(i, chk, df, cols)
        aggs += a
        descs.append(d)
    one = df.agg(*aggs)
    rows = one.select(F.col("__n").alias("n"), F.explode(F.array(*descs)).alias("d")).select("n", "d.*")
    n, miss, unexp = F.col("n"), F.col("missing"), F.col("unexpected")
    is_table = F.col("type").isin("row_count_between", "columns_match_set")
    not_null = F.col("type") == "not_null"
    nonmissing = n - miss
    den = F.when(not_null, n).otherwise(nonmissing)
    verdict = F.when(den == 0, F.lit(True)).otherwise(
        (den - unexp).cast("double") / den >= F.col("mostly"))
    success = F.when(is_table | F.col("table_ok").isNotNull(), F.col("table_ok")).otherwise(verdict)
    counted = miss.isNotNull()
    return rows.select(
        "check_id", "type", "column", "kwargs",
        F.when(F.col("type") == "columns_match_set", F.lit(None)).when(
            counted | (F.col("type") == "row_count_between"), n).cast("bigint").alias("element_count"),
        miss.alias("missing_count"),
        _pct(miss, n).alias("missing_percent"),
        unexp.alias("unexpected_count"),
        _pct(unexp, den).alias("unexpected_percent"),
        _pct(unexp, n).alias("unexpected_percent_total"),
        _pct(unexp, nonmissing).alias("unexpected_percent_nonmissing"),
        F.when(F.col("type") == "row_count_between", n.cast("double")).alias("observed_value"),
        success.cast("boolean").alias("success"))


def run_suite(df: DataFrame, suite: dict) -> DataFrame:
    """QC7: the whole configured suite."""
    return run_checks(df, checks_from_suite(suite))


def suite_summary(results: DataFrame) -> DataFrame:
    """QC7: success, total, passed, failed."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"))


def suite_report(results: DataFrame) -> DataFrame:
    """QC8: one JSON document ``{success,total,passed,failed,details:[...]}`` with
    whole values.  One aggregate over the check rows (one row per check, so the ``collect_list`` is bounded by the
    suite size, not by the data)."""
    d = F.struct(
        "check_id", "type", "column", "success", "kwargs",
        F.struct("element_count", "missing_count", "missing_percent", "unexpected_count",
                 "unexpected_percent", "unexpected_percent_total",
                 "unexpected_percent_nonmissing", "observed_value").alias("result"))
    doc = results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.array_sort(F.collect_list(d)).alias("details"))
    return doc.select(F.to_json(F.struct("*")).alias("report"))


class QualityError(RuntimeError):
    pass


def fail_on_error(summary: DataFrame) -> dict:
    """QC9: raise when any check failed (one tiny action on the summary)."""
    row = summary.first().asDict()
    if not row["success"]:
        raise QualityError(f"{row['failed']} of {row['total']} quality checks failed")
    return row


def schema_matches(df: DataFrame, column_set: Sequence[str], exact: bool = True) -> bool:
    """QC2 on its own: compare column names (no job)."""
    return set(df.columns) == set(column_set) if exact else set(column_set) <= set(df.columns)
