"""Quality checks and profile statistics against hand-computed values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import profile as ag
from tessera.operators import quality as qc
from tessera.operators.quality import Check
from tessera.operators.quantiles import exact_quantiles


def test_unique_dups_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    r = qc.run_checks(df, [Check("unique", "k")]).first()
    assert r.unexpected_count == 2 and r.missing_count == 2 and not r.success
    assert r.element_count == 5


def test_checks_on_empty_table(spark):
    df = spark.createDataFrame([], "k int, s string")
    rows = qc.run_checks(df, [Check("not_null", "k"), Check("in_set", "s", {"value_set": ["a"]}),
                              Check("between", "k", {"min_value": 0, "max_value": 1}),
                              Check("unique", "k"),
                              Check("row_count_between", None, {"min_value": 1, "max_value": 5})]).collect()
    assert [r.success for r in rows] == [True, True, True, True, False]


def test_mostly_and_blank_not_null(spark):
    df = spark.createDataFrame([(" ",)] * 99 + [(None,)], "t string")
    ok = qc.run_checks(df, [Check("not_null", "t", {"mostly": 0.99})]).first()
    strict = qc.run_checks(df, [Check("not_null", "t")]).first()
    assert ok.success and not strict.success and ok.unexpected_count == 1


def test_absent_column_fails_without_job(spark):
    df = spark.createDataFrame([(1,)], "a int")
    r = qc.run_checks(df, [Check("not_null", "zzz")]).first()
    assert r.success is False


def test_suite_report_and_fail_on_error(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    res = qc.run_checks(df, [Check("unique", "k"), Check("in_set", "s", {"value_set": ["x", "y"]})])
    summ = qc.suite_summary(res)
    assert summ.first().asDict() == {"success": False, "total": 2, "passed": 1, "failed": 1}
    assert '"details"' in qc.suite_report(res).first().report
    with pytest.raises(qc.QualityError):
        qc.fail_on_error(summ)


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = np.round(rng.normal(size=3000) * 10, 1)
    grp = rng.integers(0, 3, size=3000)
    pdf = pd.DataFrame({"g": grp, "x": vals})
    df = spark.createDataFrame(pdf)
    q = exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.9], by=["g"]).collect()
    for r in q:
        xs = pdf[pdf.g == r.g].x.to_numpy()
        exp = np.quantile(xs, [0.1, 0.25, 0.5, 0.9])
        got = [r.q0, r.q1, r.q2, r.q3]
        assert np.allclose(got, exp, rtol=0, atol=1e-9)


def test_skewness_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 3.0, 9.0, None]})
    df = spark.createDataFrame(pdf)
    got = ag.skewness(df, ["x"]).first().skewness
    assert abs(got - pdf.x.skew()) < 1e-12


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (4.0,)], "x double")
    h = {r.bin: r["count"] for r in ag.histogram(df, "x", 4).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 1}


def test_sample_rows_reproducible(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in ag.sample_rows(df, 10, 42, ["k"]).collect()]
    b = [r.k for r in ag.sample_rows(df.repartition(7), 10, 42, ["k"]).collect()]
    assert a == b and len(set(a)) == 10


def test_small_side_broadcast_only_under_measured_bound(spark):
    from tessera.session import small_side
    big = spark.range(1000).withColumn("g", F.col("id") % 3)
    groups = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "g long, name string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(t):
            j = big.join(t, "g")
            return j._jdf.queryExecution().executedPlan().toString(), j.count()
        text, n = plan(small_side(groups, 3))
        assert "BroadcastHashJoin" in text and n == 1000
        text, n = plan(small_side(groups, 2))
        assert "BroadcastHashJoin" not in text and n == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_box_stats_against_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 400), "x": rng.normal(size=400).round(2)})
    r = {row.g: row for row in ag.box_stats(spark.createDataFrame(pdf), "x", "g").collect()}
    for g, part in pdf.groupby("g"):
        q1, med, q3 = np.quantile(part.x, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = part.x[(part.x >= lo) & (part.x <= hi)]
        row = r[g]
        assert row.n == len(part) and abs(row.median - med) < 1e-9 and abs(row.q1 - q1) < 1e-9
        assert row.whisker_lo == inside.min() and row.whisker_hi == inside.max()
        assert row.n_outliers == len(part) - len(inside)
