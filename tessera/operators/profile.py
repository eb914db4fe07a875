"""Profiling and aggregations (AG1-AG16).

Each statistic is one aggregate plan with partial (map-side) aggregation,
computing many columns in the same pass; results are small DataFrames.
Nothing is collected except where noted (bounded lists).  No window without
``partitionBy`` runs over rows: orderings happen on the aggregated result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.features import round_to, to_number


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# ---- AG1 / AG2 / AG3 -----------------------------------------------------------
def table_overview(df: DataFrame, numeric_text: Sequence[str] = ()) -> DataFrame:
    """AG1: rows, columns, and the count of non-numeric text per listed column
    (a blank counts as unparsable, as in the original's coercion)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(_q(c).isNotNull() & to_number(_q(c)).isNull()).alias(f"unparsable_{c}")
             for c in numeric_text]
    return df.agg(*aggs).withColumn("n_columns", F.lit(len(df.columns)))


def dtypes_profile(df: DataFrame) -> list[tuple[str, str]]:
    """AG1/AG16 companion: (column, type) from the schema (no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AG2: NULL count and percent per column, one aggregate then unpivot."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(_q(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__n", f"stack({len(cols)}, {stack}) AS (column, missing_count)")
    return long.select(
        "column", F.col("missing_count").cast("bigint").alias("missing_count"),
        round_to(F.try_divide(F.col("missing_count") * 100.0, F.col("__n")), 4)
         .alias("missing_percent"))


def missing_explained_by(df: DataFrame, missing_col: Column, condition: Column) -> DataFrame:
    """AG3: are all rows with a missing value also rows where ``condition`` holds?"""
    return df.agg(
        F.count_if(missing_col.isNull()).alias("n_missing"),
        F.count_if(missing_col.isNull() & condition).alias("n_missing_and_condition"),
        F.coalesce(F.bool_and(F.when(missing_col.isNull(), F.coalesce(condition, F.lit(False)))),
                   F.lit(True)).alias("all_explained"))


# ---- AG4 / AG5 / AG6 -----------------------------------------------------------
def value_counts(df: DataFrame, column: str) -> DataFrame:
    """AG4: count and share per value (NULL counted as its own value).

    The total is a scalar subquery over the grouped result: a column with
    many distinct values never meets in one task (no unpartitioned window),
    and no join with a one-row table is needed.
    """
    g = df.groupBy(_q(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", round_to(F.col("n") / g.agg(F.sum("n")).scalar(), 4))


def rate_by_group(df: DataFrame, group: str, target: str = "Churn") -> DataFrame:
    """AG5: mean of the 0/1 target and n per category, highest rate first."""
    return (df.groupBy(_q(group).alias(group))
              .agg(round_to(F.avg(_q(target)), 4).alias("churn_rate"),
                   F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("churn_rate"), F.asc(group)))


def rate_by_feature_value(df: DataFrame, columns: Sequence[str], values: Sequence[str],
                          target: str = "Churn") -> DataFrame:
    """AG6: long table (feature, value, churn_rate, n) for columns × listed values.

    One unpivot (a projection) and one grouped aggregate; value pairs that
    never occur are absent, as in the original.
    """
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = df.selectExpr(f"`{target}` AS __y", f"stack({len(columns)}, {stack}) AS (feature, value)")
    return (long.where(F.col("value").isin(list(values)))
                .groupBy("feature", "value")
                .agg(round_to(F.avg("__y"), 4).alias("churn_rate"),
                     F.count(F.lit(1)).alias("n")))


# ---- AG7 / AG8 / AG9 ------------------------------------------------------------
def sample_skewness(col: Column) -> Column:
    """Bias-corrected (pandas) skewness: population skew × sqrt(n(n-1))/(n-2)."""
    n = F.count(col).cast("double")
    return F.when(n > 2, F.skewness(col) * F.sqrt(n * (n - 1)) / (n - 2))


def skewness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG7: one aggregate, then one row per column."""
    wide = df.agg(*[sample_skewness(_q(c).cast("double")).alias(f"s{i}")
                    for i, c in enumerate(columns)])
    stack = ", ".join(f"'{c}', s{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, skewness)")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG8: count, mean, sample std, min, exact quartiles, max per column."""
    from tessera.operators.quantiles import exact_quantiles
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', n{i}, a{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(columns))
    basic = wide.selectExpr(
        f"stack({len(columns)}, {stack}) AS (column, count, mean, std, min, max)")
    return (basic.join(q, "column", "left")
                 .select("column", F.col("count").cast("bigint").alias("count"), "mean", "std",
                         "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
                         F.col("q2").alias("p75"), "max"))


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG9: distinct count, min and max per column (one aggregate).

    ``count_distinct`` is exact (it plans as a two-level aggregate, so no
    single task sees every value of a hot column).
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.count_distinct(_q(c)).alias(f"d{i}"),
                 F.min(_q(c)).cast("string").alias(f"lo{i}"),
                 F.max(_q(c)).cast("string").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', d{i}, lo{i}, hi{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {stack}) AS (column, n_unique, min, max)")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """AG9: sorted distinct values of a column, as a table of whatever size."""
    return df.select(column).distinct().orderBy(column)


# ---- AG10 / AG11 -----------------------------------------------------------------
def corr_with_target(df: DataFrame, columns: Sequence[str], target: str = "Churn") -> DataFrame:
    """AG10: Pearson of each column with the target (pairwise complete),
    strongest absolute value first."""
    cols = [c for c in columns if c != target]
    wide = df.agg(*[F.corr(_q(c).cast("double"), _q(target).cast("double")).alias(f"r{i}")
                    for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', r{i}" for i, c in enumerate(cols))
    return (wide.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, corr)")
                .orderBy(F.desc(F.abs("corr")), "feature"))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG11: pairwise-complete Pearson matrix as (a, b, corr), one aggregate of
    k(k-1)/2 correlations; the diagonal is 1 for non-constant columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.corr(_q(a).cast("double"), _q(b).cast("double")).alias(f"r{j}")
                    for j, (a, b) in enumerate(pairs)],
                  *[F.stddev_samp(_q(c).cast("double")).alias(f"sd{i}")
                    for i, c in enumerate(columns)])
    entries = []
    for j, (a, b) in enumerate(pairs):
        entries += [f"'{a}', '{b}', r{j}", f"'{b}', '{a}', r{j}"]
    for i, c in enumerate(columns):
        entries.append(f"'{c}', '{c}', CASE WHEN sd{i} > 0 THEN 1.0D END")
    return wide.selectExpr(f"stack({len(entries)}, {', '.join(entries)}) AS (a, b, corr)")


# ---- AG12 / AG13 -------------------------------------------------------------------
def histogram(df: DataFrame, column: str, bins: int, by: str | None = None,
              density: bool = False) -> DataFrame:
    """AG12: equal-width bins over [min, max] (numpy semantics: last bin closed).

    min/max come from one scalar subquery each; the binning is a projection
    followed by one grouped aggregate.  With ``by`` (e.g. the class) the
    edges are shared and counts are per group; ``density`` divides by
    (group count × bin width) like numpy.
    """
    x = _q(column).cast("double")
    stats = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(x == hi, F.lit(bins - 1)).otherwise(
        F.least(F.lit(bins - 1), F.floor((x - lo) / width).cast("int")))
    idx = F.when(hi == lo, F.lit(0)).otherwise(idx)
    keys = [F.col("__b").alias("bin")] + ([_q(by).alias(by)] if by else [])
    g = (df.where(x.isNotNull()).withColumn("__b", idx)
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("count")))
    g = g.withColumn("bin_lo", lo + F.col("bin") * width).withColumn(
        "bin_hi", lo + (F.col("bin") + 1) * width)
    if density:
        from pyspark.sql import Window
        w = Window.partitionBy(*([by] if by else []))
        g = g.withColumn("density", F.col("count") / (F.sum("count").over(w) * width))
    return g


MAX_BROADCAST_GROUPS = 200_000


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """AG13: five-number summary, 1.5-IQR whiskers and outlier count per group.

    Exact interpolated quartiles from :func:`exact_quantiles` (no single-task
    sort), then one join of the per-group fences back to the rows for the
    whisker ends and outlier counts.
    """
    from tessera.operators.quantiles import exact_quantiles
    from tessera.session import small_side
    q = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by=[by]).select(
        by, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    x = _q(column).cast("double")
    fences = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
              .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # the fences table has one row per group: broadcast under a measured
    # bound, so the rows are never shuffled on the (few-valued) group key
    fences = small_side(fences, MAX_BROADCAST_GROUPS)
    rows = df.select(_q(by).alias(by), x.alias("__x")).where(F.col("__x").isNotNull())
    j = rows.join(fences, by)
    inside = (F.col("__x") >= F.col("lo_fence")) & (F.col("__x") <= F.col("hi_fence"))
    agg = j.groupBy(by).agg(
        F.min("__x").alias("min"), F.max("__x").alias("max"),
        F.min(F.when(inside, F.col("__x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return fences.join(agg, by).select(by, "n", "min", "q1", "median", "q3", "max",
                                       "whisker_lo", "whisker_hi", "n_outliers")


# ---- AG14 / AG15 / AG16 -------------------------------------------------------------
def top_k(df: DataFrame, value: str, k: int, by_abs: bool = False,
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """AG14: the k largest rows by value (or |value|), ties by ``tiebreak``;
    plans as TakeOrderedAndProject: a per-partition top-k, then a merge of
    k × partitions rows."""
    key = F.abs(_q(value)) if by_abs else _q(value)
    return df.orderBy(key.desc_nulls_last(), *[_q(c) for c in tiebreak]).limit(k)


def hash_key(seed, key_cols: Sequence[str]) -> Column:
    """md5 of ``seed-key`` — the reproducible random order used for samples
    and splits (same value in DuckDB: ``md5(seed || '-' || key)``)."""
    key = (F.concat_ws("|", *[_q(c).cast("string") for c in key_cols])
           if len(key_cols) > 1 else _q(key_cols[0]).cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}-"), key))


def sample_rows(df: DataFrame, n: int, seed, key_cols: Sequence[str]) -> DataFrame:
    """AG15: n rows without replacement, seeded, independent of partitioning:
    the n smallest md5(seed-key) (ties broken by key), a top-k plan."""
    h = hash_key(seed, key_cols)
    return df.orderBy(h, *[_q(c) for c in key_cols]).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    """AG16: numeric columns by type (schema only)."""
    return _numeric(df)
