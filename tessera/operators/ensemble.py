"""Fitted ensembles (TU9, TU10): soft voting and stacking as one model.

Rows go through the members one after the other, each adding its probability as
a column: no join on a key, so repeated or missing keys do no harm, and with
Spark ML members the whole ensemble is one chain of projections.  Ensembles
save and load like any other model, so the registry can promote them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.models import KnnPipeline, predict


def member_column(i: int) -> str:
    return f"__p{i}"


class LinearScorer:
    """A preparation and coefficients (the intercept last) of a logistic score, for rows
    scored inside an evaluation; it is not saved."""

    def __init__(self, preparation, theta: Sequence[float]):
        self.preparation, self.theta = preparation, [float(t) for t in theta]

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        m = sum((F.lit(t) * F.col(f"__x{i}") for i, t in enumerate(self.theta[:-1])), F.lit(self.theta[-1]))
        return self.preparation.transform(df).select(*[F.col(f"`{k}`") for k in keep], (1 / (1 + F.exp(-m))).alias("p")) \
            .withColumn("yhat", (F.col("p") > 0.5).cast("int"))


class VotingModel:
    """Soft voting: weighted mean of the members' probabilities."""

    kind = "voting"

    def __init__(self, members: Sequence, weights: Sequence[float]):
        if len(members) != len(weights) or not members or not sum(weights) > 0:
            raise ValueError("a vote needs members, a weight for each, and a positive sum")
        self.members, self.weights = list(members), [float(w) for w in weights]

    def scores(self, df: DataFrame) -> DataFrame:
        """``df`` and one probability column per member."""
        for i, m in enumerate(self.members):
            df = predict(m, df, keep=df.columns).withColumnRenamed("p", member_column(i)).drop("yhat")
        return df

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        p = sum((F.lit(w) * F.col(member_column(i)) for i, w in enumerate(self.weights)), F.lit(0.0)) / sum(self.weights)
        return self.scores(df).select(*[F.col(f"`{k}`") for k in keep], p.alias("p")) \
            .withColumn("yhat", (F.col("p") >= 0.5).cast("int"))

    def save(self, path: str) -> None:
        for i, m in enumerate(self.members):
            m.save(f"{path}/member{i}")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(self.kind, self.weights)], "kind string, weights array<double>") \
            .write.mode("error").parquet(f"{path}/ensemble")


class StackingModel(VotingModel):
    """Members whose probabilities feed a logistic meta-model (no pass-through)."""

    kind = "stacking"

    def __init__(self, members: Sequence, meta):
        super().__init__(members, [1.0] * len(members))
        self.meta = meta

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return predict(self.meta, self.scores(df), keep)

    def save(self, path: str) -> None:
        self.meta.save(f"{path}/meta")
        super().save(path)


def load(spark: SparkSession, path: str):
    """A saved model of any kind: with its feature chain, ensemble, kNN or pipeline."""
    from tessera.sources.io import path_exists
    if path_exists(spark, f"{path}/chain"):
        from tessera.operators.raw_model import RawModel
        return RawModel.load(spark, path)
    if path_exists(spark, f"{path}/ensemble"):
        row = spark.read.parquet(f"{path}/ensemble").first()
        members = [load(spark, f"{path}/member{i}") for i in range(len(row["weights"]))]
        return StackingModel(members, load(spark, f"{path}/meta")) if row["kind"] == "stacking" \
            else VotingModel(members, row["weights"])
    if path_exists(spark, f"{path}/boost"):
        from tessera.operators.hist_boost import HistogramBoost
        return HistogramBoost.load(spark, path)
    if path_exists(spark, f"{path}/refs"):
        return KnnPipeline.load(spark, path)
    return PipelineModel.load(path)
