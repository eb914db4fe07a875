"""ML4: histogram gradient boosting with L1/L2 terms and a bound on the leaves.

Features are binned once to bytes and written in blocks of rows.  One pass per tree
level sums gradients and Hessians per (node, feature, bin): every task adds up its own
histograms, the parts of a node meet in one group, and the group finds the node's best
split, so only splits reach the driver.  The gain is the second-order one,
``T(G)² / (H + λ)`` of both sides less that of the node, with ``T`` the soft threshold
at α.

Trees grow leaf by leaf: the leaf of the greatest gain splits next until there are
``num_leaves``.  A node's best split depends on its own rows alone, so all nodes of a
level are searched in one pass and the order of growth is settled afterwards from the
gains: the tree is the leaf-wise one of at most ``max_depth`` levels, in ``max_depth``
passes instead of one per leaf.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialize

MAX_BINS = 255        # bins of a feature; bin 0 holds NULL and NaN
BLOCK_ROWS = 16_384   # rows per written block
REFRESH = 25          # trees after which the margins are written anew
MAX_DEPTH = 10        # a level holds at most 2^9 nodes: 63 MB of histograms for 30 features
DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "num_leaves": 31, "reg_lambda": 1.0,
            "reg_alpha": 0.0, "min_child_weight": 1e-3, "subsample": 1.0, "colsample_bytree": 1.0, "max_bins": MAX_BINS,
            "scale_pos_weight": 1.0}
SPLIT_SCHEMA = "node int, gain double, feature int, bin int, gl double, hl double, gr double, hr double"


def soft(g, alpha: float):
    """Soft threshold: the L1 term takes ``alpha`` off the gradient sum."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def best_split(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, lam: float, alpha: float, least: float) -> tuple:
    """(gain, feature, bin, left G, left H, right G, right H) of a node from its
    histograms (features × bins); rows of at most that bin go left.  Ties go to the
    lesser feature, then bin; no split that gains: feature -1, sums of the node left."""
    gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
    total_g, total_h = g[0].sum(), h[0].sum()
    gr, hr = total_g - gl, total_h - hl

    def worth(a, b):
        return soft(a, alpha) ** 2 / np.maximum(b + lam, 1e-12)
    gain = (worth(gl, hl) + worth(gr, hr) - worth(total_g, total_h)) / 2
    fits = (hl >= least) & (hr >= least) & allowed[:, None] & (hl > 0) & (hr > 0)
    gain = np.where(fits, gain, -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    if not gain[f, b] > 1e-9:
        return 0.0, -1, -1, float(total_g), float(total_h), 0.0, 0.0
    return float(gain[f, b]), f, b, float(gl[f, b]), float(hl[f, b]), float(gr[f, b]), float(hr[f, b])


def grow(splits: dict[int, tuple], num_leaves: int, lam: float, alpha: float, rate: float) -> dict:
    """The leaf-wise tree from the best split of every node (heap numbering: children of
    i are 2i + 1 and 2i + 2): split the leaf of the greatest gain until ``num_leaves``."""
    def value(g, h):
        return float(-rate * soft(g, alpha) / max(h + lam, 1e-12))
    root = splits[0]
    tree = {0: {"v": value(root[3] + root[5], root[4] + root[6])}}
    heap, leaves = [(-root[0], 0)] if root[1] >= 0 else [], 1
    while heap and leaves < num_leaves:
        _, i = heapq.heappop(heap)
        _, f, b, gl, hl, gr, hr = splits[i]
        tree[i] = {"f": f, "b": b}
        for j, (g, h) in ((2 * i + 1, (gl, hl)), (2 * i + 2, (gr, hr))):
            tree[j] = {"v": value(g, h)}
            if j in splits and splits[j][1] >= 0:
                heapq.heappush(heap, (-splits[j][0], j))
        leaves += 1
    return tree


def node_of(bins: np.ndarray, tree: dict, depth: int) -> np.ndarray:
    """Node that every row (of bytes) reaches in ``depth`` levels of a tree or a part of one."""
    at = np.zeros(len(bins), np.int64)
    size = max(tree) + 1 if tree else 1
    feature, cut = np.full(size, -1), np.zeros(size, np.int64)
    for i, n in tree.items():
        if "f" in n:
            feature[i], cut[i] = n["f"], n["b"]
    for _ in range(depth):
        f = feature[np.minimum(at, size - 1)]
        on = np.flatnonzero((f >= 0) & (at < size))
        if not len(on):
            break
        at[on] = 2 * at[on] + 1 + (bins[on, f[on]] > cut[at[on]])
    return at


def margins(bins: np.ndarray, trees: Sequence[dict]) -> np.ndarray:
    out = np.zeros(len(bins))
    for t in trees:
        value = np.zeros(max(t) + 1)
        for i, n in t.items():
            value[i] = n.get("v", 0.0)
        out += value[node_of(bins, t, MAX_DEPTH)]
    return out


@dataclass
class HistogramBoost:
    """A fitted booster; scores, saves and loads like the other models."""
    features: list[str]
    edges: list[list[float]]
    base: float
    params: dict
    trees: list[dict] = field(default_factory=list)

    def binned(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Bytes (rows × features): 0 for NULL and NaN, else one more than the number of
        edges below the value."""
        out = np.zeros((len(columns[0]), len(self.features)), np.uint8)
        for j, (c, e) in enumerate(zip(columns, self.edges)):
            x = c.to_numpy(zero_copy_only=False).astype(float)
            out[:, j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(e, float), x, side="left"))
        return out

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, ``p`` (probability of class 1) and ``yhat``."""
        shared, k = df.sparkSession.sparkContext.broadcast(self), len(keep)

        def run(batches):
            m = shared.value
            for b in batches:
                z = m.base + margins(m.binned(b.columns[k:]), m.trees)
                p = pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[:k], p], [*b.schema.names[:k], "p"])
        src = df.select(*[F.col(f"`{c}`") for c in keep],
                        *[F.col(f"`{c}`").cast("double").alias(f"__f{i}") for i, c in enumerate(self.features)])
        schema = T.StructType([*src.schema.fields[:k], T.StructField("p", T.DoubleType())])
        return src.mapInArrow(run, schema).withColumn("yhat", (F.col("p") >= 0.5).cast("int"))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(self.__dict__),)], "model string").write.mode("error").parquet(f"{path}/boost")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> HistogramBoost:
        got = json.loads(spark.read.parquet(f"{path}/boost").first()["model"])
        got["trees"] = [{int(i): n for i, n in t.items()} for t in got["trees"]]
        return cls(**got)


def check_params(params: dict | None) -> dict:
    p = {**DEFAULTS, **(params or {})}
    unknown = set(p) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}; known: {sorted(DEFAULTS)}")
    if not 1 <= p["max_depth"] <= MAX_DEPTH or p["num_leaves"] < 2 or not 2 <= p["max_bins"] <= MAX_BINS:
        raise ValueError(f"max_depth is 1 to {MAX_DEPTH}, num_leaves at least 2, max_bins 2 to {MAX_BINS}")
    return p


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """Upper edges of at most ``max_bins`` - 1 value bins per feature: distinct approximate
    quantiles, one aggregate over all features."""
    at = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    xs = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in features]
    row = df.agg(*[F.percentile_approx(x, at, 10_000).alias(f"q{i}") if at else F.lit(None).alias(f"q{i}")
                   for i, x in enumerate(xs)]).first()
    return [sorted(set(q or [])) for q in row]


def _blocks(df: DataFrame, model: HistogramBoost, label: str, weight: str | None) -> DataFrame:
    """Written blocks of rows: ``bins`` (bytes), ``y``, ``w``, ``z`` (margins) as packed numbers."""
    shared, n = df.sparkSession.sparkContext.broadcast(model), len(model.features)

    def run(batches):
        m = shared.value
        for b in batches:
            for a in range(0, b.num_rows, BLOCK_ROWS):
                s = b.slice(a, BLOCK_ROWS)
                y, w = (s.column(n + i).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
                w = w * np.where(y == 1, m.params["scale_pos_weight"], 1.0)
                yield _packed(m.binned(s.columns[:n]), y, w, np.full(len(y), m.base))
    src = df.select(*[F.col(f"`{c}`").cast("double").alias(f"__f{i}") for i, c in enumerate(model.features)],
                    F.col(f"`{label}`").cast("double").alias("__y"),
                    (F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)) if weight else F.lit(1.0)).alias("__w"))
    return materialize(src.filter(F.col("__y").isin(0.0, 1.0)).mapInArrow(run, BLOCK_SCHEMA))


BLOCK_SCHEMA = "bins binary, y binary, w binary, z binary"


def _packed(bins, y, w, z) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (bins, y, w, z)], ["bins", "y", "w", "z"])


def _unpacked(batches, n: int):
    for b in batches:
        for bins, *rest in zip(*(c.to_pylist() for c in b.columns)):
            yield np.frombuffer(bins, np.uint8).reshape(-1, n), *(np.frombuffer(x) for x in rest)


def level_splits(blocks: DataFrame, model: HistogramBoost, recent: Sequence[dict], tree: dict, depth: int,
                 allowed: np.ndarray, seed: int) -> dict[int, tuple]:
    """Best split of every node on level ``depth`` of the tree in the making (``tree`` holds
    the splits above), in one pass.  ``recent`` are the trees that the written margins lack."""
    n, p = len(model.features), model.params
    n_bins = p["max_bins"] + 1
    shared = blocks.sparkSession.sparkContext.broadcast((list(recent), tree))
    lam, alpha, least, part_of = p["reg_lambda"], p["reg_alpha"], p["min_child_weight"], p["subsample"]

    def run(batches):
        recent, tree = shared.value
        first = 2 ** depth - 1
        sums: dict[int, np.ndarray] = {}
        for bins, y, w, z in _unpacked(batches, n):
            q = 1 / (1 + np.exp(-np.clip(z + margins(bins, recent), -700, 700)))
            g, h = w * (q - y), w * q * (1 - q)
            at = node_of(bins, tree, depth)
            use = at >= first
            if part_of < 1:  # the draw follows from the block's rows and the tree
                use &= np.random.default_rng([seed, int(bins.sum()), len(bins)]).random(len(bins)) < part_of
            for i in np.unique(at[use]).tolist():
                mine = np.flatnonzero(use & (at == i))
                place = (bins[mine].astype(np.int64) + np.arange(n) * n_bins).ravel()
                got = np.stack([np.bincount(place, np.repeat(v[mine], n), n * n_bins) for v in (g, h)])
                sums[i] = sums[i] + got if i in sums else got
        for i, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([s.tobytes()], pa.binary())], ["node", "part"])

    def search(t: pa.Table) -> pa.Table:
        s = np.zeros(2 * n * n_bins)
        for part in sorted(t.column("part").to_pylist()):  # one order of adding: reruns agree
            s += np.frombuffer(part)
        g, h = s.reshape(2, n, n_bins)
        got = (t.column("node")[0].as_py(), *best_split(g, h, allowed, lam, alpha, least))
        return pa.table([pa.array([v], pa.int32() if i in (0, 2, 3) else pa.float64()) for i, v in enumerate(got)],
                        names=[c.split()[0] for c in SPLIT_SCHEMA.split(", ")])
    rows = blocks.mapInArrow(run, "node int, part binary").groupBy("node").applyInArrow(search, SPLIT_SCHEMA).collect()
    return {r[0]: tuple(r[1:]) for r in rows}  # at most 2^depth nodes


def _with_margins(blocks: DataFrame, trees: Sequence[dict], n: int) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast(list(trees))

    def run(batches):
        for bins, y, w, z in _unpacked(batches, n):
            yield _packed(bins, y, w, z + margins(bins, shared.value))
    return materialize(blocks.mapInArrow(run, BLOCK_SCHEMA))


def fit(df: DataFrame, features: Sequence[str], label: str, params: dict | None = None, weight: str | None = None,
        seed: int = 13) -> HistogramBoost:
    """Boosted trees on rows with label 0 or 1 (others are left out; NULL weights count 0).

    NULL and NaN features share the lowest bin.  A single class gives a constant model;
    a table without labelled rows raises.  Unknown parameters raise before any job.
    """
    p = check_params(params)
    rows = df.filter(F.col(f"`{label}`").cast("double").isin(0.0, 1.0))
    model = HistogramBoost(list(features), bin_edges(rows, features, p["max_bins"]), 0.0, p)
    y = F.col(f"`{label}`").cast("double")
    w = (F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)) if weight else F.lit(1.0)) \
        * F.when(y == 1, p["scale_pos_weight"]).otherwise(1.0)
    both = rows.agg(F.sum(w * y), F.sum(w)).first()
    if not both[1]:
        raise ValueError("no row with a label and a positive weight")
    share = min(max(both[0] / both[1], 1e-6), 1 - 1e-6)
    model.base = float(np.log(share / (1 - share)))
    blocks, recent = _blocks(rows, model, label, weight), []
    rnd = np.random.default_rng(seed)
    for t in range(int(p["n_estimators"])):
        allowed = np.zeros(len(features), bool)
        allowed[rnd.permutation(len(features))[:max(1, round(p["colsample_bytree"] * len(features)))]] = True
        splits, partial = {}, {}
        for depth in range(int(p["max_depth"])):
            got = level_splits(blocks, model, recent, partial, depth, allowed, seed + t)
            splits.update(got)
            opened = {i: {"f": s[1], "b": s[2]} for i, s in got.items() if s[1] >= 0}
            if not opened:
                break
            partial.update(opened)
        if not splits or splits[0][1] < 0:
            if p["subsample"] == 1 and p["colsample_bytree"] == 1:
                break  # nothing gains, and the next tree would see the same
            continue
        tree = grow(splits, int(p["num_leaves"]), p["reg_lambda"], p["reg_alpha"], p["learning_rate"])
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == REFRESH and t + 1 < p["n_estimators"]:
            blocks, recent = _with_margins(blocks, recent, len(features)), []
    return model
