"""Exact interpolated quantiles by group, without one task per hot group.

Spark's ``percentile`` keeps a value→count map per group in one aggregation
buffer; for a hot group with many distinct values that buffer lands in one
task.  Here the values are first reduced to (group, value, count), then the
bucketed prefix sums of :mod:`tessera.functions.prefix` give every distinct
value its cumulative rank range, and only the ≤ 2 rows per requested
probability that straddle the target rank survive.  Same result as
``numpy.quantile``/``pandas.quantile`` (linear interpolation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.prefix import BUCKET, bucketize, edge_values, prefix_sums
from tessera.session import materialize


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: Sequence[str] = (), n_buckets: int | None = None) -> DataFrame:
    """One row per (by..., column) with ``q0..q{k-1}`` for ``probs`` and ``n``.

    NULLs are skipped; a group with no values is absent.
    """
    by = list(by)
    edges = edge_values(df, columns, n_buckets)
    bcols = [f"__b{i}" for i in range(len(columns))]
    wide = bucketize(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*by, *columns])]),
                     columns, edges, bcols)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE), {b}" for c, b in zip(columns, bcols))
    long = wide.selectExpr(*[f"`{b}`" for b in by],
                           f"stack({len(columns)}, {stack}) AS (column, x, {BUCKET})").where("x IS NOT NULL")
    vc = long.groupBy(*by, "column", "x", BUCKET).agg(F.count(F.lit(1)).alias("c"))
    vc = materialize(vc)  # the input is read for the edges and for this table, nothing more
    ps = prefix_sums(vc, ["x"], ["c"], by + ["column"])
    # each distinct value covers 0-based ranks [cum_c - c, cum_c)
    hits = []
    for i, p in enumerate(probs):
        h = (F.col("tot_c") - 1) * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        start, end = F.col("cum_c") - F.col("c"), F.col("cum_c")
        hits.append(F.struct(F.lit(i).alias("i"), (h - lo).alias("frac"),
                             ((start <= lo) & (lo < end)).alias("is_lo"),
                             ((start <= hi) & (hi < end)).alias("is_hi")))
    ex = (ps.select(*by, "column", "x", "tot_c", F.explode(F.array(*hits)).alias("h"))
            .where("h.is_lo OR h.is_hi"))
    per_p = ex.groupBy(*by, "column", F.col("h.i").alias("i")).agg(
        F.max(F.when(F.col("h.is_lo"), F.col("x"))).alias("x_lo"),
        F.max(F.when(F.col("h.is_hi"), F.col("x"))).alias("x_hi"),
        F.max("h.frac").alias("frac"), F.max("tot_c").alias("n"))
    per_p = per_p.withColumn(
        "v", F.when(F.col("frac") == 0, F.col("x_lo"))
              .otherwise(F.col("x_lo") + F.col("frac") * (F.col("x_hi") - F.col("x_lo"))))
    return per_p.groupBy(*by, "column").agg(
        F.max("n").cast("bigint").alias("n"),
        *[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"q{i}") for i in range(len(probs))])


def exact_median(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Median per (by..., column) as ``median``."""
    return exact_quantiles(df, columns, [0.5], by).withColumnRenamed("q0", "median")
