"""Edge rows for the stateless feature operators (FX1-FX22)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import features as fx
from tessera.plans.config import FEATURE_COLUMNS, FEATURE_CONFIG
from tessera.plans.feature_chain import feature_chain


def test_type_cast_edges(spark):
    df = spark.createDataFrame([(" ",), ("NaN",), ("Infinity",), (" 7 ",), ("12.5",), (None,), ("abc",)],
                               "TotalCharges string")
    out = [r[0] for r in fx.type_cast(df, [{"column": "TotalCharges", "dtype": "float64"}]).collect()]
    assert out[0] is None and out[1] is None and out[5] is None and out[6] is None
    assert math.isinf(out[2]) and out[3] == 7.0 and out[4] == 12.5


def test_binary_and_ordinal_null_unseen(spark):
    df = spark.createDataFrame([("Yes", "No"), ("No", "Maybe"), (None, None)], "a string, b string")
    enc = fx.binary_encode(df, ["a"], "Yes")
    assert [r.a for r in enc.collect()] == [1, 0, 0]
    ordm = fx.ordinal_encode(df, ["b"], {"No": 1, "Yes": 2})
    assert [r.b for r in ordm.collect()] == [1, None, None]
    cnt = fx.unmapped_counts(df, ["b"], {"No": 1, "Yes": 2}).first()
    assert cnt.b == 1


def test_one_hot_null_and_drop_first(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    out = fx.one_hot(df, "c", ["x", "y"], "p", drop_first=True)
    assert out.columns == ["p_y"]
    assert [r.p_y for r in out.collect()] == [0, 1, 0]


def test_unknown_strategy_raises(spark):
    df = spark.createDataFrame([("x",)], "c string")
    with pytest.raises(ValueError):
        fx.categorical_encode(df, [{"column": "c", "strategy": "target"}])


def test_ratio_zero_den_and_fill(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0), (None, 1.0)], "n double, d double")
    r = [x[0] for x in df.select(fx.safe_ratio(F.col("n"), F.col("d"), 0)).collect()]
    assert r == [0.0, 0.5, 0.0]
    r2 = [x[0] for x in df.select(fx.safe_ratio(F.col("n"), F.col("d"))).collect()]
    assert r2[0] is None and r2[2] is None


def test_log1p_clip(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (math.e - 1,)], "x double")
    out = [r[0] for r in df.select(fx.log1p_clip(F.col("x"))).collect()]
    assert out[0] == 0.0 and out[1] is None and abs(out[2] - 1.0) < 1e-12


def test_tenure_bins_right_closed(spark):
    df = spark.createDataFrame([(0,), (12,), (13,), (48,), (72,), (73,), (None,)], "t int")
    out = [r[0] for r in df.select(fx.tenure_bin(F.col("t"), [0, 12, 24, 48, 72])).collect()]
    assert out == [0, 0, 1, 2, 3, None, None]


def test_sanitize_and_conform(spark):
    df = spark.createDataFrame([(1, 2)], "`a<b` int, `c[1]` int")
    assert fx.sanitize_names(df).columns == ["alt_b", "c(1)"]
    conf = fx.conform_to_schema(fx.sanitize_names(df), ["alt_b", "missing"])
    assert conf.first().asDict() == {"alt_b": 1, "missing": 0}


def test_derive_total_charges(spark):
    df = spark.createDataFrame([(0, 50.0), (3, 10.5)], "tenure int, MonthlyCharges double")
    out = fx.derive_total_charges(df).select("TotalCharges", "PaymentMethod").collect()
    assert out[0].TotalCharges == "0" and out[1].TotalCharges == "31.5"
    assert out[0].PaymentMethod == "Electronic check"


def test_round_to_matches_binary_half_away(spark):
    df = spark.createDataFrame([(32.1203125,), (0.125,), (-2.5,)], "x double")
    out = [r[0] for r in df.select(fx.round_to(F.col("x"), 6)).collect()]
    assert out[0] == round(32.1203125 * 1e6) / 1e6 or out[0] == 32.120312


def test_feature_chain_schema(spark):
    from tessera.sources.frames import subscribers
    out = feature_chain(subscribers(spark, "/root/testdata/sf0.001"))
    assert out.columns == FEATURE_CONFIG["feature_selection"]["features_to_keep"]
    assert len(FEATURE_COLUMNS) == 33
    row = out.agg(F.count("*").alias("n"), F.sum("Churn").alias("churn")).first()
    assert row.n == 150 and row.churn == 45
