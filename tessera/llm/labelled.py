"""Bounded samples of labelled documents, for the operators that learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_of, text_of
from tessera.session import materialize


def remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the key's text modulo ``mod`` (null keys: -1, never learned from)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod)), F.lit(-1)).cast("int")


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, max_per_class: int,
               id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """Written table ``text, y`` of at most ``max_per_class`` labelled documents of
    either class outside the held-out fold, equal texts once, and per class
    (labels there are, labels sampled).

    The sample is the first ``max_per_class`` keys in hash order; it has at most
    2 · ``max_per_class`` rows of two numbers, so it is broadcast to the scan.
    Contradicting labels of a key count as 1; null labels and keys are skipped.
    """
    one = labels.select(id_of("doc_id").alias("k"), F.col(label).cast("int").alias("y")) \
        .filter(F.col("k").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("k"), mod) != held_out)) \
        .groupBy("k").agg(F.max("y").alias("y"))
    one = materialize(one)
    there = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}  # two rows
    first = [one.filter(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(max_per_class) for y in (0, 1)]
    sample = materialize(first[0].unionByName(first[1]))
    rows = docs.select(id_of(id_col).alias("d"), text_of(text_col).alias("text")) \
        .join(F.broadcast(sample), F.col("d") == F.col("k"))
    rows = materialize(rows.select("text", "y").dropDuplicates(["text", "y"]))
    got = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    return rows, {y: (there.get(y, 0), got.get(y, 0)) for y in (0, 1)}
