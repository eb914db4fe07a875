"""Sharding by rendezvous hashing over weighted shards (operator 6).

Every shard draws a pseudo-random number for a record's key and the largest
weighted draw wins.  Adding a shard adds one draw, so a record either stays or
moves into the new shard.  Slots number the records of a shard without gaps:
records are dealt into hash buckets, the small table of counts per (shard,
bucket) gives the offset of each bucket, and a window numbers the records
inside one bucket — no shard, however large, is sorted by one task.
Built-in functions only; rows carry no text when they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import id_of, n_buckets, text_of

ROWS_PER_BUCKET = 100_000


def draw(key: Column, shard: int) -> Column:
    """Pseudo-random number in (0, 1) of a key and a shard: 48 bits of an MD5."""
    h = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{shard}"))), 1, 12), 16, 10).cast("double")
    return (h + 0.5) / float(1 << 48)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the largest weight / -ln(draw); the lower shard on a tie."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("shards need positive weights")
    scored = [F.struct((F.lit(float(w)) / -F.log(draw(key, j))).alias("s"), F.lit(-j).alias("j"))
              for j, w in enumerate(weights)]
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return (-best["j"]).cast("int")


def stable_key(id_col: str) -> Column:
    """The record key as text; a null key is the key ``null``."""
    return F.coalesce(id_of(id_col).cast("string"), F.lit("null"))


def assign(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text",
           grown_weights: Sequence[float] | None = None) -> DataFrame:
    """``doc_id, size`` (UTF-8 bytes + 1), ``text_crc32, shard, slot`` and, with
    ``grown_weights``, ``grown_shard``: the shard under those weights.

    Key and weights alone decide the shard: repeated keys share one, null keys
    share that of the key ``null``.  Slots run from 0 within a shard, ordered
    by hash bucket, key, size and checksum; rows equal in all of them are
    interchangeable.  A null text has size 1 and the checksum of no bytes.
    """
    body = text_of(text_col).cast("binary")
    key = stable_key(id_col)
    rows = docs.select(
        id_of(id_col).alias("doc_id"), (F.length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), rendezvous(key, weights).alias("shard"),
        (rendezvous(key, grown_weights) if grown_weights else F.lit(None).cast("int")).alias("grown_shard"),
        F.xxhash64(key, body).alias("__h"))
    buckets = n_buckets(docs.count(), ROWS_PER_BUCKET)
    rows = rows.withColumn("__b", F.pmod("__h", F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "__b").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("shard").alias("__s"), F.col("__b").alias("__o"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("shard", "__b").orderBy("doc_id", "size", "text_crc32", "__h")
    numbered = rows.withColumn("__r", F.row_number().over(inside))
    out = numbered.join(offsets, (F.col("shard") == F.col("__s")) & (F.col("__b") == F.col("__o")))
    return out.select("doc_id", "size", "text_crc32", "shard",
                      (F.col("__first") + F.col("__r") - 1).cast("bigint").alias("slot"), "grown_shard")


def write(docs: DataFrame, path: str, weights: Sequence[float], id_col: str = "doc_id") -> None:
    """Write all columns of ``docs`` under ``path/shard=<n>``, each shard in as many
    files as tasks hold rows of it."""
    if "shard" in docs.columns:
        raise ValueError("column shard already exists")
    docs.withColumn("shard", rendezvous(stable_key(id_col), weights)).write.partitionBy("shard").parquet(path)
