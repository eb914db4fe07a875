"""Frames shared by the catalog entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import features as fx
from tessera.sources import frames

R = 6  # decimals every floating result is rounded to, in Spark and in SQL


def rnd(c, digits: int = R):
    return fx.round_to(c if not isinstance(c, str) else F.col(f"`{c}`"), digits)


def encoded_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subscribers after FX1 (TotalCharges → number) and FX3 on the target."""
    s = frames.subscribers(spark, sf_dir)
    s = fx.type_cast(s, [{"column": "TotalCharges", "dtype": "float64"}])
    return fx.binary_encode(s, ["Churn"], "Yes")


