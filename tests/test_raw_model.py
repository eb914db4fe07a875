"""Models that score raw customers after loading, with nothing else."""

from pyspark.sql import functions as F

from tessera.operators import ensemble
from tessera.operators import models as ml
from tessera.operators.monitor import score_batch
from tessera.operators.raw_model import RawModel, one_hot_columns, raw_features
from tessera.plans import registry as rg
from tessera.plans.config import FEATURE_COLUMNS, FEATURE_CONFIG
from tessera.sources import frames

from .conftest import SF001


def test_loaded_model_scores_raw_rows(spark, tmp_path):
    raw = frames.subscribers(spark, SF001)
    model = RawModel.fit(raw, "logistic_regression", {"C": 0.5})
    assert set(model.categories) == set(one_hot_columns(FEATURE_CONFIG)) == {"InternetService", "PaymentMethod"}
    root = str(tmp_path / "reg")
    assert rg.promote_if_better(spark, root, "r", "lr", 0.8, 0.5, model) == 1
    back = rg.load_model(spark, root)
    assert back.categories == model.categories and back.cfg == FEATURE_CONFIG

    def scored(m, rows, **kw):
        return {r.customerID: (round(r.probability, 12), r.prediction)
                for r in score_batch(m, rows, keep=["customerID"], **kw).collect()}
    whole = scored(back, raw.drop("Churn"))
    assert len(whole) == raw.count() and whole == scored(model, raw.drop("Churn"))
    assert whole == scored(model.model, raw.drop("Churn"), feature_columns=FEATURE_COLUMNS, categories=model.categories)
    # a batch with one category, and one without the column, is scored as in the whole
    dsl = raw.where("InternetService = 'DSL'").drop("Churn")
    assert scored(back, dsl).items() <= whole.items()
    assert len(scored(back, raw.drop("Churn", "PaymentMethod", "TotalCharges"))) == len(whole)
    other = raw.drop("Churn").withColumn("InternetService", F.lit("Satellite"))
    assert len(scored(back, other)) == len(whole)  # an unseen category is none of the learned
    assert score_batch(back, raw.where("false"), keep=["customerID"]).count() == 0


def test_an_ensemble_behind_the_chain(spark, tmp_path):
    raw = frames.subscribers(spark, SF001)
    cats = RawModel.fit(raw, "decision_tree", {"max_depth": 2}).categories
    train = raw_features(raw, [*FEATURE_COLUMNS, "Churn"], cats, ["customerID"])
    members = [ml.fit_pipeline(train, FEATURE_COLUMNS, "decision_tree", {"max_depth": d}) for d in (2, 3)]
    RawModel(ensemble.VotingModel(members, [1, 2]), cats).save(str(tmp_path / "m"))
    out = score_batch(ensemble.load(spark, str(tmp_path / "m")), raw, keep=["customerID"])
    assert out.where("probability BETWEEN 0 AND 1").count() == raw.count()
