"""Global order without one partition: bucketed prefix sums and ranks.

``Window.orderBy`` without ``partitionBy`` sends every row to one task.  The
pattern used instead (for ROC/AUC, exact quantiles, NTILE batches and
stratified splits):

1. reduce to rows unique on the order key where possible (distinct score
   levels, distinct values), so a hot key cannot make one task large;
2. give every row a coarse bucket that is monotone in the order key:
   approximate-percentile edges of the key (equal row counts per bucket) or
   the leading hex digits of an md5 key;
3. totals per (group, bucket) — a table of at most groups × buckets rows —
   and their exclusive running sum: the offset of each bucket;
4. a window partitioned by (group, bucket) orders rows inside one bucket;
   global position = bucket offset + local position.

Every step is a partitioned operator; the largest single sort is one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "__bkt"
MIN_BUCKETS, MAX_BUCKETS = 256, 65_536  # of ordered values; the edges pass through the driver
MIN_HEX, MAX_HEX = 3, 6  # leading hex digits of an md5 key: 4096 to 16.7 million buckets


def bucket_count(spark) -> int:
    """Buckets of ordered values: two for each shuffle partition.  That setting is
    what a session scales with its data, so buckets stay as large as its tasks."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BUCKETS, min(MAX_BUCKETS, 2 * n))


def hex_digits(spark) -> int:
    """Leading md5 digits that give at least four buckets for each shuffle partition."""
    n, digits = 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MIN_HEX
    while 16 ** digits < n and digits < MAX_HEX:
        digits += 1
    return digits


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def edge_values(df: DataFrame, cols: Sequence[str], n_buckets: int | None = None,
                accuracy: int | None = None) -> dict[str, list[float]]:
    """Approximate-percentile bucket edges per column, from ONE aggregate.

    At most ``MAX_BUCKETS`` doubles per column reach the driver, whatever the
    data.
    """
    n_buckets = n_buckets or bucket_count(df.sparkSession)
    accuracy = accuracy or max(10_000, 20 * n_buckets)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(*[F.percentile_approx(_q(c).cast("double"), probs, accuracy).alias(f"e{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: sorted({e for e in (row[f"e{i}"] or []) if e is not None and e == e})
            for i, c in enumerate(cols)}


def bucketize(df: DataFrame, cols: Sequence[str], edges: dict[str, list[float]],
              outs: Sequence[str]) -> DataFrame:
    """Bucket ids by binary search over the edges (Spark ML ``Bucketizer``,
    JVM-side), monotone in each column; NULL/NaN go to an extra last bucket."""
    from pyspark.ml.feature import Bucketizer
    tmp = [f"__bz{i}" for i in range(len(cols))]
    splits = [[float("-inf")] + (edges[c] or [0.0]) + [float("inf")] for c in cols]
    src = df.withColumns({t: F.coalesce(_q(c).cast("double"), F.lit(float("nan")))
                          for t, c in zip(tmp, cols)})
    out = Bucketizer(splitsArray=splits, inputCols=tmp, outputCols=[f"{t}_b" for t in tmp],
                     handleInvalid="keep").transform(src)
    return out.withColumns({o: F.col(f"{t}_b").cast("int") for o, t in zip(outs, tmp)}) \
              .drop(*tmp, *[f"{t}_b" for t in tmp])


def with_edge_buckets(df: DataFrame, x: str, per: Sequence[str] = (),
                      n_buckets: int | None = None, accuracy: int | None = None) -> DataFrame:
    """Add ``__bkt``: the approximate-percentile bucket of ``x``.

    The edges are global (one small aggregate, collected), so the bucket is
    monotone in ``x`` inside every ``per`` group as well; groups only change
    how evenly rows spread over buckets, never correctness.
    """
    edges = edge_values(df, [x], n_buckets, accuracy)
    return bucketize(df, [x], edges, [BUCKET])


def with_hash_bucket(df: DataFrame, hex_col: str, digits: int | None = None) -> DataFrame:
    """Add ``__bkt`` from the leading hex digits of an md5 string column."""
    digits = digits or hex_digits(df.sparkSession)
    return df.withColumn(BUCKET, F.conv(F.substring(_q(hex_col), 1, digits), 16, 10).cast("int"))


def prefix_sums(df: DataFrame, order: Sequence[str], values: Sequence[str],
                by: Sequence[str] = (), bucket: str = BUCKET) -> DataFrame:
    """Inclusive running sums of ``values`` in ``order`` within ``by`` groups.

    Adds ``cum_<v>`` (sum over rows ordered at or before this one) and
    ``tot_<v>`` (group total) for every value column.  ``df`` must carry a
    bucket column monotone in ``order``; rows should be unique on
    (by, order) — ties are ordered arbitrarily otherwise.
    """
    by = list(by)
    totals = df.groupBy(*by, bucket).agg(*[F.sum(_q(v)).alias(f"__t_{v}") for v in values])
    wb = Window.partitionBy(*by).orderBy(bucket)
    # ``totals`` has at most (groups × buckets) rows: the one place a window
    # may be unpartitioned (no ``by``) is this small table.
    ex = wb.rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*by)
    totals = totals.select(
        *by, bucket,
        *[F.coalesce(F.sum(f"__t_{v}").over(ex), F.lit(0)).alias(f"__o_{v}") for v in values],
        *[F.sum(f"__t_{v}").over(wg).alias(f"tot_{v}") for v in values])
    # null-safe keys: a NULL group is a group of its own (as in SQL's
    # PARTITION BY), not rows lost by an equi-join
    ren = {k: f"__pk{i}" for i, k in enumerate(by + [bucket])}
    totals = totals.withColumnsRenamed(ren)
    if not by:
        totals = F.broadcast(totals)  # bounded by the bucket count
    j = df.join(totals, [_q(k).eqNullSafe(F.col(r)) for k, r in ren.items()]).drop(*ren.values())
    wl = (Window.partitionBy(*by, bucket).orderBy(*[_q(c) for c in order])
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return j.select(*[_q(c) for c in df.columns],
                    *[(F.col(f"__o_{v}") + F.sum(_q(v)).over(wl)).alias(f"cum_{v}") for v in values],
                    *[F.col(f"tot_{v}") for v in values])


def hash_order(seed, key_cols: Sequence[str]) -> Column:
    """md5(seed-key): reproducible pseudo-random order, equal in DuckDB."""
    key = (F.concat_ws("|", *[_q(c).cast("string") for c in key_cols])
           if len(key_cols) > 1 else _q(key_cols[0]).cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}-"), key))


def hash_rank(df: DataFrame, key_cols: Sequence[str], seed, by: Sequence[str] = (),
              rank_col: str = "rank") -> DataFrame:
    """0-based rank of each row within ``by`` in md5(seed-key) order (ties by key),
    plus ``group_n``, the size of its group.  No single-partition sort."""
    h = df.withColumn("__h", hash_order(seed, key_cols)).withColumn("__one", F.lit(1))
    # the first 15 hex digits as a non-negative long: same order as the md5
    # string on those digits, compared as a primitive; md5 and key break ties
    h = h.withColumn("__hl", F.conv(F.substring("__h", 1, 15), 16, 10).cast("bigint"))
    h = with_hash_bucket(h, "__h")
    r = prefix_sums(h, ["__hl", "__h", *key_cols], ["__one"], by)
    return (r.withColumn(rank_col, (F.col("cum___one") - 1).cast("bigint"))
             .withColumn("group_n", F.col("tot___one").cast("bigint"))
             .drop("__h", "__hl", "__one", BUCKET, "cum___one", "tot___one"))


def ntile(rank: Column, n_rows: Column, n: int) -> Column:
    """NTILE(n) from a 0-based rank and the row count: the first ``N mod n``
    tiles hold one extra row (same as SQL ``ntile``)."""
    q = F.floor(n_rows / F.lit(n))
    rem = n_rows - q * F.lit(n)
    big = (q + 1) * rem
    return F.when(rank < big, F.floor(rank / (q + 1)) + 1).otherwise(
        rem + F.floor((rank - big) / F.greatest(q, F.lit(1))) + 1).cast("int")
