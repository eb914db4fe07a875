"""A model that scores raw customer rows (SC1, RG5): the feature chain it was fitted
behind, with the categories learned then, and the fitted model, saved as one.

Raw rows go through FX20 (derived total), FX23 (the configured chain, one-hot
columns from the learned categories) and FX19 (absent columns filled), then
through the model.  The chain's configuration is saved as JSON and the categories
as a table of (column, position, JSON value), so a loaded model needs nothing but the rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import features as fx
from tessera.operators.models import fit_pipeline, predict
from tessera.plans.config import FEATURE_COLUMNS, FEATURE_CONFIG, ID_COLUMN, SEED, TARGET
from tessera.plans.feature_chain import feature_chain


def one_hot_columns(cfg: dict) -> list[str]:
    return [s["column"] for s in cfg.get("categorical_encoding", []) if s["strategy"] == "one_hot"]


def raw_features(raw: DataFrame, feature_columns: Sequence[str], categories: dict, keep: Sequence[str] = (),
                 cfg: dict | None = None) -> DataFrame:
    """``keep`` and every feature column of raw rows, absent ones as 0."""
    x = feature_chain(fx.derive_total_charges(raw), cfg, categories=categories, keep=list(keep))
    return fx.conform_to_schema(x, [*keep, *feature_columns], fill=0)


class RawModel:
    """A fitted model behind the feature chain."""

    def __init__(self, model, categories: dict, feature_columns: Sequence[str] = FEATURE_COLUMNS,
                 cfg: dict | None = None):
        self.model, self.categories = model, {c: list(v) for c, v in categories.items()}
        self.feature_columns, self.cfg = list(feature_columns), cfg or FEATURE_CONFIG

    @staticmethod
    def fit(raw: DataFrame, name: str, params: dict | None = None, reduction: dict | None = None, label: str = TARGET,
            key: str = ID_COLUMN, seed: int = SEED, cfg: dict | None = None,
            feature_columns: Sequence[str] = FEATURE_COLUMNS) -> "RawModel":
        """Learn the categories and fit the learner on raw rows with a label."""
        from tessera.session import materialize
        cfg = cfg or FEATURE_CONFIG
        cats = fx.learn_categories_many(raw, one_hot_columns(cfg))
        train = materialize(feature_chain(raw, cfg, categories=cats, keep=[key]))
        return RawModel(fit_pipeline(train, feature_columns, name, params, reduction, label, seed), cats, feature_columns, cfg)

    def predict(self, raw: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, ``p``, ``yhat`` of raw rows, whatever optional columns they lack."""
        return predict(self.model, raw_features(raw, self.feature_columns, self.categories, keep, self.cfg), keep)

    def save(self, path: str) -> None:
        self.model.save(f"{path}/model")
        spark = SparkSession.getActiveSession()
        values = [(c, i, json.dumps(v)) for c, vs in self.categories.items() for i, v in enumerate(vs)]
        spark.createDataFrame(values, "column string, position int, value string") \
            .write.mode("error").parquet(f"{path}/categories")
        spark.createDataFrame([(json.dumps(self.cfg), self.feature_columns, list(self.categories))],
                              "config string, features array<string>, columns array<string>") \
            .write.mode("error").parquet(f"{path}/chain")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RawModel":
        from tessera.operators import ensemble
        row = spark.read.parquet(f"{path}/chain").first()
        values = spark.read.parquet(f"{path}/categories").groupBy("column").agg(
            F.sort_array(F.collect_list(F.struct("position", "value"))).alias("v")).collect()  # one row a column
        learned = {r["column"]: [json.loads(v["value"]) for v in r["v"]] for r in values}
        cats = {c: learned.get(c, []) for c in row["columns"]}
        return RawModel(ensemble.load(spark, f"{path}/model"), cats, row["features"], json.loads(row["config"]))
