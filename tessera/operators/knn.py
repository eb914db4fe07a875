"""ML6: exact k-nearest-neighbour search and classification by boxed cells.

No row per pair is ever made, and pairs that cannot be neighbours are not
compared:

1. a sample of the references of the least id hashes is halved at the median of
   the dimension that spreads most, again and again: one cell for
   ``ROWS_PER_BLOCK`` references, at most ``MAX_CELLS``;
2. every reference joins the cell that the cuts lead it to; a cell knows the box
   around all of its references;
3. a query's k-th distance within its own cell bounds its k-th neighbour from
   above, and its distance to a box bounds that to all references in it from below: it
   visits only cells that can hold a neighbour;
4. a cell with more than ``ROWS_PER_BLOCK`` rows of a side is dealt into blocks
   by id hash, so a hot cell spreads over as many tasks as it needs;
   ``cogroup`` on (cell, query block, reference block) makes the groups.  Large
   blocks keep the copies of a query few where nothing can be left out;
5. inside a group the references are halved on into leaves of ``ROWS_PER_LEAF``, whose
   boxes leave out most of them in the same way; one matrix product (euclidean) or
   32-bit sums (manhattan) estimate the distances that remain with a known error; only
   pairs that the estimate does not put beyond the bound get their distance, and the k
   best references per query are kept (ties by reference id); a grouped merge keeps the
   k best of all.

Distances are accumulated dimension by dimension in float64, left to right,
so they are bit-identical to a sequential SQL sum.  Bounds carry the errors of
the estimates and a relative slack far above rounding, so pruning never drops a
neighbour or a tie.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

ROWS_PER_BLOCK = 16_384   # rows of either side that meet in one group; references to a cell
ROWS_PER_LEAF = 512       # references to a leaf of a group
MOST_LEAVES = 0.5         # of a group's leaves that queries visit; beyond that they are compared with all at once
MAX_CELLS = 1024          # cells; the cuts and a box per cell reach the driver
SPREAD = 4                # references looked at per cell
SAMPLE_ROWS = 4096        # references that are cut into cells (and reach the driver)
ROWS_PER_STEP = 256       # rows bounded by the sample at a time
PAIRS_AT_ONCE = 1 << 20   # pairs estimated at a time
PAIRS_PER_STEP = 1 << 15  # candidates whose distances are summed at a time
SLACK = 1e-9


def _distances(q: np.ndarray, r: np.ndarray, metric: str) -> np.ndarray:
    acc = np.zeros((q.shape[0], r.shape[0]))
    for j in range(q.shape[1]):
        diff = q[:, j][:, None] - r[:, j][None, :]
        acc += diff * diff if metric == "euclidean" else np.abs(diff)
    return np.sqrt(acc) if metric == "euclidean" else acc


def _estimates(q: np.ndarray, r: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Squared (euclidean) or plain (manhattan) distances up to an error, and the largest
    error per query: one matrix product, or sums of 32-bit floats.  None where numbers
    are too large for that."""
    d = q.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        if metric == "euclidean":
            qq, rr = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", r, r)
            got = q @ r.T
            got *= -2.0
            got += qq[:, None]
            got += rr[None, :]
            error = 4 * (d + 8) * np.finfo(np.float64).eps * (qq + rr.max())
        else:
            a, b = q.astype(np.float32), np.ascontiguousarray(r.T.astype(np.float32))
            got, diff = np.zeros((len(q), len(r)), np.float32), np.empty((len(q), len(r)), np.float32)
            for j in range(d):
                np.subtract(b[j][None, :], a[:, j][:, None], out=diff)
                np.abs(diff, out=diff)
                got += diff
            # underflow of the 32-bit numbers counts too
            error = 4 * (d + 8) * (np.finfo(np.float32).eps * (np.abs(q).sum(axis=1) + np.abs(r).sum(axis=1).max())
                                   + np.finfo(np.float32).tiny)
    return (got, error) if np.isfinite(error).all() and np.isfinite(got).all() else None


def _pair_distances(q: np.ndarray, r: np.ndarray, qi: np.ndarray, ri: np.ndarray, metric: str) -> np.ndarray:
    """The distances of given pairs, summed as ``_distances`` does."""
    out = np.empty(len(qi))
    for at in range(0, len(qi), PAIRS_PER_STEP):
        diff = q[qi[at:at + PAIRS_PER_STEP]] - r[ri[at:at + PAIRS_PER_STEP]]
        diff = diff * diff if metric == "euclidean" else np.abs(diff)
        acc = np.zeros(len(diff))
        for j in range(diff.shape[1]):
            acc += diff[:, j]
        out[at:at + PAIRS_PER_STEP] = np.sqrt(acc) if metric == "euclidean" else acc
    return out


def _candidates(q: np.ndarray, r: np.ndarray, qid: np.ndarray, rid: np.ndarray, bound: np.ndarray, k: int,
                metric: str, exclude_self: bool):
    """Pairs, with their distances, that hold the ``k`` nearest references of every query
    that are not beyond its bound (ties included)."""
    got = _estimates(q, r, metric)
    if got is None:
        d, error = _distances(q, r, metric), np.zeros(len(q))
    else:
        d, error = got
        bound = bound * bound if metric == "euclidean" else bound
    limit = bound * (1 + SLACK) + error
    if exclude_self:
        d[qid[:, None] == rid[None, :]] = np.inf
    with np.errstate(over="ignore"):
        near = d <= np.nextafter(limit.astype(d.dtype), d.dtype.type(np.inf))[:, None]
    many = np.flatnonzero(near.sum(axis=1) > 2 * k)
    if len(many):  # their k-th nearest in this block bounds them closer
        kth = np.partition(d[many], k - 1, axis=1)[:, k - 1].astype(np.float64)
        cut = np.minimum(limit[many], np.where(kth >= 0, kth * (1 + SLACK), kth) + 2 * error[many])
        near[many] = d[many] <= np.nextafter(cut, np.inf)[:, None]
    qi, ri = np.nonzero(near & np.isfinite(d))
    return qi, ri, _pair_distances(q, r, qi, ri, metric)


def _cut(x: np.ndarray) -> tuple[int, float] | None:
    """The dimension that spreads most and where it halves the rows (``<=`` goes left);
    None where it does not."""
    with np.errstate(over="ignore", invalid="ignore"):
        j = int(x.var(axis=0).argmax())
        at = float(np.median(x[:, j]))
    if not (x[:, j] > at).any():
        below = x[:, j][x[:, j] < at]
        if not len(below):
            return None
        at = float(below.max())
    return (j, at) if (x[:, j] <= at).any() and (x[:, j] > at).any() else None


def _leaves(r: np.ndarray) -> list[np.ndarray]:
    """Rows of ``r`` (indices) halved into leaves."""
    out, todo = [], [np.arange(len(r))]
    while todo:
        rows = todo.pop()
        cut = _cut(r[rows]) if len(rows) > ROWS_PER_LEAF else None
        if cut is None:
            out.append(rows)
        else:
            left = r[rows, cut[0]] <= cut[1]
            todo += [rows[left], rows[~left]]
    return out


def _box_gaps(q: np.ndarray, low: np.ndarray, high: np.ndarray, metric: str) -> np.ndarray:
    """Least distance of every row to anything in every box, but for rounding."""
    out = np.empty((len(q), len(low)))
    with np.errstate(over="ignore"):
        for b in range(len(low)):
            gap = np.maximum(low[b] - q, q - high[b])
            np.maximum(gap, 0.0, out=gap)
            out[:, b] = np.sqrt(np.einsum("ij,ij->i", gap, gap)) if metric == "euclidean" else gap.sum(axis=1)
    return out


def _pieces(q: np.ndarray, r: np.ndarray, qid: np.ndarray, rid: np.ndarray, bound: np.ndarray, k: int, metric: str,
            exclude_self: bool) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Closer bounds, and which queries are compared with which references: the leaves
    within a query's bound, or all where leaves leave out little."""
    leaves, whole = _leaves(r), [(np.arange(len(q)), np.arange(len(r)))]
    if len(leaves) == 1:
        return bound, whole
    gaps = _box_gaps(q, np.array([r[x].min(axis=0) for x in leaves]), np.array([r[x].max(axis=0) for x in leaves]), metric)
    bound, own = bound.copy(), gaps.argmin(axis=1)
    for b, leaf in enumerate(leaves):
        mine = np.flatnonzero(own == b)
        for at in range(0, len(mine), ROWS_PER_STEP):
            here = mine[at:at + ROWS_PER_STEP]
            bound[here] = np.minimum(bound[here], _sample_bound(q[here], qid[here], r[leaf], rid[leaf], k, metric, exclude_self))
    near = gaps * (1 - SLACK) <= bound[:, None]
    if near.mean() > MOST_LEAVES:
        return bound, whole
    return bound, [(np.flatnonzero(near[:, b]), leaf) for b, leaf in enumerate(leaves)]


def _first(qi: np.ndarray, ri: np.ndarray, dd: np.ndarray, rid: np.ndarray, k: int):
    """The first ``k`` candidates of every query by (distance, reference id)."""
    order = np.lexsort((rid[ri], dd, qi))
    qi, ri, dd = qi[order], ri[order], dd[order]
    keep = (np.arange(len(qi)) - np.searchsorted(qi, qi, side="left") < k) & np.isfinite(dd)
    return qi[keep], ri[keep], dd[keep]


def _nearest(q: np.ndarray, r: np.ndarray, qid: np.ndarray, rid: np.ndarray, bound: np.ndarray, k: int, metric: str,
             exclude_self: bool):
    """Query, reference and distance of the ``k`` nearest references within the bounds."""
    bound, pieces = _pieces(q, r, qid, rid, bound, k, metric, exclude_self)
    found = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
    for rows, cols in pieces:
        kk, step = min(k, len(cols)), max(1, PAIRS_AT_ONCE // len(cols))
        for at in range(0, len(rows), step):
            here = rows[at:at + step]
            qi, ri, dd = _candidates(q[here], r[cols], qid[here], rid[cols], bound[here], kk, metric, exclude_self)
            # only the candidates are ordered
            qi, ri, dd = _first(qi, ri, dd, rid[cols], kk)
            found.append((here[qi], cols[ri], dd))
    return _first(*map(np.concatenate, zip(*found)), rid, k)


def _matrix(df: pd.DataFrame) -> np.ndarray:
    return np.vstack(df["vec"].to_numpy()).astype(np.float64)


def _block_topk(k: int, metric: str, exclude_self: bool):
    def fn(qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
        cols = ["qid", "rid", "rlabel", "dist"]
        if qdf.empty or rdf.empty:
            return pd.DataFrame({c: [] for c in cols}).astype(
                {"qid": "int64", "rid": "int64", "rlabel": "int32", "dist": "float64"})
        qid, rid, label = qdf["id"].to_numpy(), rdf["id"].to_numpy(), rdf["label"].to_numpy()
        bound = qdf["bound"].to_numpy() if "bound" in qdf else np.full(len(qdf), np.inf)
        qi, ri, dd = _nearest(_matrix(qdf), _matrix(rdf), qid, rid, bound, k, metric, exclude_self)
        return pd.DataFrame({c: x.astype(t) for c, t, x in zip(
            cols, ("int64", "int64", "int32", "float64"), (qid[qi], rid[ri], label[ri], dd))})
    return fn


def _block_bound(k: int, metric: str, exclude_self: bool):
    """Queries with their k-th distance within references of their own cell."""
    def fn(qdf: pd.DataFrame, rdf: pd.DataFrame) -> pd.DataFrame:
        bound = np.full(len(qdf), np.inf)
        if len(qdf) and len(rdf):
            qi, _, dd = _nearest(_matrix(qdf), _matrix(rdf), qdf["id"].to_numpy(), rdf["id"].to_numpy(), bound, k, metric,
                                 exclude_self)
            kth = np.arange(len(qi)) - np.searchsorted(qi, qi, side="left") == k - 1
            bound[qi[kth]] = dd[kth]
        return qdf[["id", "vec"]].assign(bound=bound)
    return fn


@dataclass
class CellPlan:
    """Queries with the cells they visit, references with their cell, rows of both per cell."""
    queries: DataFrame                     # id, vec, cells
    refs: DataFrame                        # id, vec, label, cell
    cells: list[tuple[int, int, int]]      # cell, visiting queries, references

    @property
    def pairs(self) -> int:
        """Pairs that are compared."""
        return sum(q * r for _, q, r in self.cells)


def _finite(vec: Column) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _rows(df: DataFrame, id_col: str, vec_col: str, *more: Column) -> DataFrame:
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"), *more).where(_finite(F.col("vec")))


def choose_cuts(seen: np.ndarray, n: int) -> list[tuple]:
    """Cuts of the sample into at most ``n`` cells, the fullest halved first: per node
    (dimension, value, left, right); a negative child ``-1 - c`` is cell ``c``."""
    nodes, fullest, cells = [], [(-len(seen), 0, np.arange(len(seen)), None)], 0
    while fullest:  # every part with its place: the node and side it hangs on
        size, order, rows, place = heapq.heappop(fullest)
        cut = _cut(seen[rows]) if cells + len(fullest) + 1 < n else None
        child = -1 - cells if cut is None else len(nodes)
        if place:
            nodes[place[0]][place[1]] = child
        if cut is None:
            cells += 1
            continue
        left = seen[rows, cut[0]] <= cut[1]
        nodes.append([*cut, None, None])
        for side, part in ((2, rows[left]), (3, rows[~left])):
            heapq.heappush(fullest, (-len(part), 2 * child + side, part, (child, side)))
    return [tuple(x) for x in nodes]


def _cells_of(x: np.ndarray, cuts: list[tuple]) -> np.ndarray:
    """The cell that the cuts lead every row to."""
    out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))] if cuts else []
    while todo:
        node, rows = todo.pop()
        if node < 0:
            out[rows] = -1 - node
        elif len(rows):
            j, at, left, right = cuts[node]
            goes = x[rows, j] <= at
            todo += [(left, rows[goes]), (right, rows[~goes])]
    return out


def _in_cells(cuts: list[tuple]):
    def fn(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=_cells_of(_matrix(pdf), cuts))
    return fn


def _task_boxes(batches):
    """A row per cell of a task: references, least and largest number of every dimension."""
    boxes = {}
    for pdf in batches:
        for cell, part in pdf.groupby("cell"):
            x = _matrix(part)
            n, low, high = boxes.get(cell, (0, x[0], x[0]))
            boxes[cell] = n + len(x), np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
    if boxes:
        yield pd.DataFrame([(c, *b) for c, b in boxes.items()], columns=["cell", "rows", "low", "high"])


def _cell_box(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([(pdf["cell"].iloc[0], pdf["rows"].sum(), np.min(pdf["low"].to_list(), axis=0),
                          np.max(pdf["high"].to_list(), axis=0))], columns=["cell", "rows", "low", "high"])


def _sample_bound(q: np.ndarray, qid: np.ndarray, sample: np.ndarray, ids: np.ndarray, k: int, metric: str,
                  exclude_self: bool) -> np.ndarray:
    """Upper bound of every query's k-th distance: that to the k-th nearest of some references,
    rows of the query's own id left out."""
    if len(sample) < k:
        return np.full(len(q), np.inf)
    got = _estimates(q, sample, metric)
    d, error = got if got else (_distances(q, sample, metric), np.zeros(len(q)))
    if exclude_self:
        d[qid[:, None] == ids[None, :]] = np.inf
    kth = np.partition(d, k - 1, axis=1)[:, k - 1].astype(np.float64)
    kth = np.maximum(kth, 0.0) * (1 + SLACK) + error
    return np.where(np.isnan(kth), np.inf, np.sqrt(kth) if got and metric == "euclidean" else kth)


def _visits(names: np.ndarray, low: np.ndarray, high: np.ndarray, sample: np.ndarray, ids: np.ndarray, k: int,
            metric: str, exclude_self: bool):
    """Cells that can hold one of a query's nearest references (or a tie with the last).
    A query whose own cell gave no bound takes that of the sample."""
    def fn(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            q, qid, bound = _matrix(pdf), pdf["id"].to_numpy(), pdf["bound"].to_numpy().copy()
            open_ = np.flatnonzero(np.isinf(bound))
            for at in range(0, len(open_), ROWS_PER_STEP):
                here = open_[at:at + ROWS_PER_STEP]
                bound[here] = _sample_bound(q[here], qid[here], sample, ids, k, metric, exclude_self)
            near = _box_gaps(q, low, high, metric) * (1 - SLACK) <= bound[:, None]
            yield pdf.assign(cells=[names[row] for row in near], bound=bound)
    return fn


def plan_cells(queries: DataFrame, refs: DataFrame, k: int, metric: str = "euclidean", id_col: str = "vec_id",
               vec_col: str = "embedding", label_col: str = "label", exclude_self: bool = True,
               cells: int | None = None) -> CellPlan | None:
    """Cells of the references and the visits of the queries; None without a reference."""
    spark = refs.sparkSession
    r = _rows(refs, id_col, vec_col, F.col(f"`{label_col}`").cast("int").alias("label"))
    if cells is None:
        cells = min(MAX_CELLS, max(math.ceil(refs.count() / ROWS_PER_BLOCK), spark.sparkContext.defaultParallelism))
    rows = r.select("id", "vec").orderBy(F.xxhash64("id", F.lit(3)), "id").limit(max(SAMPLE_ROWS, SPREAD * cells)).collect()
    if not rows:
        return None
    ids = np.array([np.nan if x["id"] is None else x["id"] for x in rows])
    sample = np.array([x["vec"] for x in rows], float)
    cuts = choose_cuts(sample, cells)
    r = materialize(r.mapInPandas(_in_cells(cuts), "id long, vec array<double>, label int, cell int"))
    box = "cell int, rows long, low array<double>, high array<double>"
    boxes = r.select("cell", "vec").mapInPandas(_task_boxes, box).groupBy("cell").applyInPandas(_cell_box, box).collect()
    names = np.array([b["cell"] for b in boxes], np.int32)  # a row per cell, all of which have references
    low, high = (np.array([b[side] for b in boxes], float) for side in ("low", "high"))
    rows_of = {b["cell"]: b["rows"] for b in boxes}
    q = materialize(_rows(queries, id_col, vec_col).mapInPandas(_in_cells(cuts), "id long, vec array<double>, cell int"))
    own = {x["cell"]: x["count"] for x in q.groupBy("cell").count().collect()}  # a row per cell
    q = materialize(_bounded(q, r, own, rows_of, k, metric, exclude_self).mapInPandas(
        _visits(names, low, high, sample, ids, k, metric, exclude_self),
        "id long, vec array<double>, cells array<int>, bound double"))
    visits = {v["cell"]: v["n"] for v in q.select(F.explode("cells").alias("cell")).groupBy("cell")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    return CellPlan(q, r, [(c, visits[c], n) for c, n in rows_of.items() if c in visits])


def _dealt(spark, cells: list[tuple[int, int, int]]) -> DataFrame:
    """Blocks of queries and of references per cell (at most MAX_CELLS rows)."""
    return F.broadcast(spark.createDataFrame([(c, math.ceil(q / ROWS_PER_BLOCK), math.ceil(r / ROWS_PER_BLOCK))
                                              for c, q, r in cells], "cell int, qbs long, rbs long"))


def _bounded(q: DataFrame, r: DataFrame, own: dict, rows_of: dict, k: int, metric: str, exclude_self: bool) -> DataFrame:
    """Queries with the k-th distance in their own cell: each block of them meets one
    block of the cell's references."""
    if not own:
        return q.select("id", "vec", F.lit(math.inf).alias("bound"))
    # (a cell without references cannot be: the cuts are those of references)
    dealt = _dealt(q.sparkSession, [(c, n, rows_of.get(c, 1)) for c, n in own.items()])
    q = q.join(dealt, "cell").select("cell", "id", "vec", F.pmod(F.xxhash64("id", F.lit(1)), "qbs").alias("qb"))
    meets = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("qbs") - 1),
                     lambda b: F.pmod(b, F.col("rbs")) == F.pmod(F.xxhash64("id", F.lit(2)), F.col("rbs")))
    r = r.join(dealt, "cell").select("cell", "id", "vec", F.explode(meets).alias("qb"))
    return q.groupBy("cell", "qb").cogroup(r.groupBy("cell", "qb")).applyInPandas(
        _block_bound(k, metric, exclude_self), "id long, vec array<double>, bound double")


def knn_neighbors(queries: DataFrame, refs: DataFrame, k: int, metric: str = "euclidean",
                  id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                  exclude_self: bool = True, blocks: int | None = None) -> DataFrame:
    """(qid, rid, rlabel, dist, rank) for the k nearest references of every query;
    ``blocks`` sets the number of cells.

    Rows without a vector, or with a null, NaN or infinite number in it, have
    no neighbours and are nobody's.  With fewer than k references a query gets
    them all.
    """
    plan = plan_cells(queries, refs, k, metric, id_col, vec_col, label_col, exclude_self, blocks)
    spark = refs.sparkSession
    schema = "qid long, rid long, rlabel int, dist double"
    if plan is None:
        return spark.createDataFrame([], schema + ", rank int")
    dealt = _dealt(spark, plan.cells)
    q = plan.queries.select("id", "vec", "bound", F.explode("cells").alias("cell")).join(dealt, "cell").select(
        "cell", "id", "vec", "bound", F.pmod(F.xxhash64("id", F.lit(1)), "qbs").alias("qb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rbs") - 1)).alias("rb"))
    r = plan.refs.join(dealt, "cell").select(
        "cell", "id", "vec", "label", F.pmod(F.xxhash64("id", F.lit(2)), "rbs").alias("rb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qbs") - 1)).alias("qb"))
    cand = (q.groupBy("cell", "qb", "rb").cogroup(r.groupBy("cell", "qb", "rb"))
             .applyInPandas(_block_topk(k, metric, exclude_self), schema))
    w = Window.partitionBy("qid").orderBy("dist", "rid")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_predict(neighbors: DataFrame, weights: str = "uniform") -> DataFrame:
    """Vote over the k neighbours: most votes (uniform) or largest Σ 1/d
    (distance; exact matches win outright); ties → smallest label."""
    if weights == "distance":
        has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
        wgt = F.when(has_zero == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    else:
        wgt = F.lit(1.0)
    votes = neighbors.withColumn("__w", wgt).groupBy("qid", "rlabel").agg(F.sum("__w").alias("score"))
    best = votes.groupBy("qid").agg(F.min_by("rlabel", F.struct(-F.col("score"), F.col("rlabel"))).alias("pred"))
    return best
