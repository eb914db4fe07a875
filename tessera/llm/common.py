"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

#: A key holding at least 1/HEAVY_PARTS of all rows is "heavy"; at most
#: HEAVY_PARTS keys can be, which bounds what is broadcast for them.
HEAVY_PARTS = 256
#: Tables of fixed-width rows are broadcast up to this many rows, counted.
BROADCAST_ROWS = 1_000_000


def text_of(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def id_of(col: str) -> Column:
    return F.col(f"`{col}`").cast("bigint")


def lean(run):
    """A batch function that gives Arrow's unused memory back when its task ends: the
    worker processes live on and serve the stages that follow."""
    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return out


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``df`` as the struct ``row``, beside ``more``: no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(k) for k, c in more.items()])


def counted_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``df`` (fixed-width rows), count it, and mark it for broadcast only
    when the count is within ``max_rows``; larger tables join by shuffle."""
    t = materialize(df)
    return F.broadcast(t) if t.count() <= max_rows else t


def join_by_group(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str,
                  n_rows: int) -> DataFrame:
    """Left join of ``rows`` to ``groups`` (unique on ``keys``) without a hot task.

    ``size`` holds how many of the ``n_rows`` rows have the key.  Keys of at
    least ``n_rows / HEAVY_PARTS`` rows — at most HEAVY_PARTS of them exist —
    are broadcast.  Rows that met a heavy key join the rest under a hash of
    their own columns, so they spread over all tasks instead of following it.
    """
    values = [c for c in groups.columns if c not in keys]
    heavy_at = max(2, -(-n_rows // HEAVY_PARTS))
    heavy = groups.filter(F.col(size) >= heavy_at).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(v).alias(f"__h_{v}") for v in values], F.lit(True).alias("__hit"))
    light = groups.filter(F.col(size) < heavy_at).select(
        F.lit(0).cast("bigint").alias("__salt"), *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(v).alias(f"__l_{v}") for v in values])
    own = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 40)) + 1  # never the light side's 0
    out = rows.join(F.broadcast(heavy), [F.col(k) == F.col(f"__k_{k}") for k in keys], "left") \
              .drop(*[f"__k_{k}" for k in keys]) \
              .withColumn("__rs", F.when(F.col("__hit"), own).otherwise(F.lit(0).cast("bigint")))
    out = out.join(light, [F.col("__rs") == F.col("__salt")]
                   + [F.col(k) == F.col(f"__k_{k}") for k in keys], "left")
    return out.select(*[F.col(c) for c in rows.columns],
                      *[F.coalesce(F.col(f"__h_{v}"), F.col(f"__l_{v}")).alias(v) for v in values])


def n_buckets(n_rows: int, per_bucket: int) -> int:
    """Bucket count that keeps about ``per_bucket`` rows in each."""
    return max(1, -(-n_rows // per_bucket))
