"""ML4 histogram boosting against a direct search over the rows."""

import random

import numpy as np
import pytest

from tessera.operators import ensemble
from tessera.operators import hist_boost as hb

SCHEMA = "id bigint, a double, b double, c double, y int"


def data(n=900, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rnd.randint(0, 9) / 1.0, rnd.choice([None, float("nan"), 1.0, 2.0, 5.0, 7.5])
        c = rnd.random()
        up = (a > 4) != (b is not None and b == b and b > 2)
        rows.append((i, a, b, c, int(rnd.random() < (0.92 if up else 0.08))))
    return rows


def worth(g, h, lam, alpha):
    return max(abs(g) - alpha, 0) ** 2 / (h + lam)


def brute_split(bins, g, h, lam, alpha, least):
    best = (0.0, -1, -1)
    whole = worth(g.sum(), h.sum(), lam, alpha)
    for f in range(bins.shape[1]):
        for cut in sorted(set(bins[:, f]))[:-1]:
            left = bins[:, f] <= cut
            if h[left].sum() < least or h[~left].sum() < least:
                continue
            gain = (worth(g[left].sum(), h[left].sum(), lam, alpha) + worth(g[~left].sum(), h[~left].sum(), lam, alpha) - whole) / 2
            if gain > best[0] + 1e-9:
                best = (gain, f, int(cut))
    return best


def brute_leafwise(bins, g, h, num_leaves, max_depth, lam, alpha, least):
    """Splits (node, feature, rows to the left) of leaf-wise growth, one split at a time."""
    leaves, done = {0: np.arange(len(g))}, {}
    while len(leaves) < num_leaves:
        found = {i: brute_split(bins[r], g[r], h[r], lam, alpha, least) for i, r in leaves.items() if i < 2 ** max_depth - 1}
        found = {i: s for i, s in found.items() if s[1] >= 0}
        if not found:
            break
        i = max(found, key=lambda k: (round(found[k][0], 9), -k))
        gain, f, cut = found[i]
        rows = leaves.pop(i)
        left = bins[rows, f] <= cut
        leaves[2 * i + 1], leaves[2 * i + 2] = rows[left], rows[~left]
        done[i] = (f, int(left.sum()), gain)
    return done, leaves


@pytest.mark.parametrize("lam,alpha,least", [(0.0, 0.0, 0.0), (1.0, 0.0, 0.5), (3.0, 2.0, 1.0)])
def test_best_split_equals_brute_force(lam, alpha, least):
    rnd = np.random.default_rng(5)
    for _ in range(60):
        n = int(rnd.integers(2, 60))
        bins, g, h = rnd.integers(0, 6, (n, 3)), rnd.normal(size=n), rnd.random(n) + 0.01
        hist = [np.stack([np.bincount(bins[:, f], v, 6) for f in range(3)]) for v in (g, h)]
        got, want = hb.best_split(*hist, np.ones(3, bool), lam, alpha, least), brute_split(bins, g, h, lam, alpha, least)
        assert np.isclose(got[0], want[0], atol=1e-8)
        if want[1] >= 0:
            left = bins[:, got[1]] <= got[2]
            assert np.isclose(got[3], g[left].sum()) and np.isclose(got[6], h[~left].sum())


@pytest.mark.parametrize("leaves,alpha", [(2, 0.0), (5, 0.0), (7, 4.0), (40, 0.0)])
def test_first_tree_is_the_leafwise_one(spark, leaves, alpha):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    p = {"n_estimators": 1, "max_depth": 4, "num_leaves": leaves, "reg_alpha": alpha, "learning_rate": 1.0,
         "min_child_weight": 2.0, "max_bins": 32}
    model = hb.fit(df, ["a", "b", "c"], "y", p)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    bins = np.stack([np.where(np.isnan(x[:, j]), 0, 1 + np.searchsorted(model.edges[j], x[:, j])) for j in range(3)], 1)
    y = np.array([r[4] for r in rows])
    q = y.mean()
    want, ends = brute_leafwise(bins, q - y, np.full(len(y), q * (1 - q)), leaves, 4, 1.0, alpha, 2.0)
    (tree,) = model.trees
    assert {i for i, n in tree.items() if "f" in n} == set(want)
    assert len([n for n in tree.values() if "v" in n]) == len(ends) <= leaves
    for i, r in ends.items():
        g = (q - y[r]).sum()
        assert np.isclose(tree[i]["v"], -np.sign(g) * max(abs(g) - alpha, 0) / (q * (1 - q) * len(r) + 1.0))


def test_learns_saves_and_scores_awkward_rows(spark, tmp_path):
    rows = data(1500)
    df = spark.createDataFrame(rows, SCHEMA)
    p = {"n_estimators": 28, "max_depth": 3, "num_leaves": 6, "learning_rate": 0.3}  # margins are written anew once
    model = hb.fit(df.filter("id % 3 > 0"), ["a", "b", "c"], "y", p)
    assert len(model.trees) == 28
    got = {r.id: r for r in model.predict(df, ["id"]).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert np.mean([got[r[0]].yhat == r[4] for r in held]) > 0.88
    again = hb.fit(df.filter("id % 3 > 0").repartition(7), ["a", "b", "c"], "y", p)
    other = {r.id: r.p for r in again.predict(df, ["id"]).collect()}
    assert max(abs(other[i] - r.p) for i, r in got.items()) < 1e-6
    model.save(str(tmp_path / "m"))
    loaded = ensemble.load(spark, str(tmp_path / "m"))
    odd = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (2, 1e300, -1e300, 0.0, 1)], SCHEMA)
    a, b = (sorted(m.predict(odd, ["id", "y"]).collect(), key=str) for m in (model, loaded))
    assert a == b and len(a) == 3 and all(0 <= r.p <= 1 for r in a)
    assert loaded.predict(odd.limit(0), ["id"]).count() == 0


def test_regularised_sampled_and_degenerate(spark):
    df = spark.createDataFrame(data(400) + [(9_999, 1.0, 1.0, 1.0, None)], SCHEMA)
    f = ["a", "b", "c"]
    assert hb.fit(df, f, "y", {"n_estimators": 3, "reg_alpha": 1e6}).trees == []
    flat = hb.fit(df.filter("y = 1"), f, "y", {"n_estimators": 2})
    assert all(r.p > 0.99 for r in flat.predict(df, ["id"]).collect())
    drawn = hb.fit(df, f, "y", {"n_estimators": 4, "subsample": 0.5, "colsample_bytree": 0.67, "max_depth": 2})
    assert 1 <= len(drawn.trees) <= 4
    with pytest.raises(ValueError, match="unknown parameters"):
        hb.fit(df, f, "y", {"leaves": 3})
    with pytest.raises(ValueError, match="no row"):
        hb.fit(df.limit(0), f, "y", {"n_estimators": 2})
