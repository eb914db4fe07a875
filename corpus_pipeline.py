"""Corpus pipeline over ``documents``: clean, deduplicate, mix and encode.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's rows as
Parquet in the shared checkpoint folder before the next stage reads them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, mixing, simhash, toxicity
from tessera.llm.queries import TOXIC_AT, bpe_path
from tessera.session import materialize, table

#: The learned toxicity stage cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below its threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(COLUMNS), model, TOXIC_AT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts (the largest doc_id)."""
    return exact_dedup.deduplicate(docs.select(COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (the smallest doc_id)."""
    return simhash.keep_one(docs.select(COLUMNS), shingle=4, max_bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass that the schedule takes words of, sorted in
    the schedule's order (part files in the order of their names)."""
    out = mixing.mixed_documents(docs.select(COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix, with a digest of what they decode to."""
    out = bpe.encode(docs, bpe_path(), public_tokenizers.PATTERN, with_decoded=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
