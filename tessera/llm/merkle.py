"""Merkle dataset manifest with retained SHA-256 states (operator 12).

A tree per group (here: language) over the leaf digests of its rows in key
order; the group roots are the leaves of one more tree, whose root signs the
dataset.  A parent is the SHA-256 of its children's hex digests, one after the
other, ``arity`` of them at most; a lone last child has a parent of its own.

States: a parent is hashed slot by slot and keeps a copy of the hash state
before each child.  To fold a changed child into the root, the state before its
slot is resumed and only the replacement and the siblings to its right are
absorbed; what stands to its left is in the state already.

Spread: positions come from one range sort (``positions``).  Blocks of
``arity ** LEVELS`` consecutive nodes are raised by one task each to their
common ancestor, whatever the size of the group; block roots are the nodes of
the next round, so rounds grow with the logarithm of the rows.  Going down
again, every block gets the path from its ancestor to the root as one row and
gives each of its nodes the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import id_of
from tessera.session import materialize

ARITY = 2
LEVELS = 10  # tree levels that one task raises at once: arity ** LEVELS nodes


# ---- digests --------------------------------------------------------------------------
def field(value: Column) -> Column:
    """One value as ``<UTF-8 bytes>:<text>``, a null as ``-``."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of a row's values in the given order."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


class Parent:
    """A parent node: its children's digests, its own, and the hash states before
    each child slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: Sequence[bytes]):
        state = hashlib.sha256()
        self.children, self.states = children, []
        for c in children:
            self.states.append(state.copy())
            state.update(c)
        self.digest = state.hexdigest().encode()

    def resume(self, slot: int, replacement: bytes) -> bytes:
        """The digest with another child in ``slot``: the state before it, the
        replacement, the siblings to the right."""
        state = self.states[slot].copy()
        state.update(replacement)
        for c in self.children[slot + 1:]:
            state.update(c)
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join([*self.children[:slot], *self.children[slot + 1:]])


def raise_nodes(nodes: Sequence[bytes], arity: int, levels: int | None) -> list[list[Parent]]:
    """The parents above ``nodes``, level by level: ``levels`` of them, or (None)
    until one node remains."""
    out = []
    while len(out) < levels if levels is not None else len(nodes) > 1:
        parents = [Parent(nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        out.append(parents)
        nodes = [p.digest for p in parents]
    return out


# ---- positions ------------------------------------------------------------------------
def positions(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` (0-based within the group, in ``order``, nulls first)
    and ``size`` (rows of the group); written once.

    One range sort over (group, order) deals a large group over many parts; the
    offset of a part within a group is the sum of the parts before it."""
    by = [F.asc_nulls_first(c) for c in [*group, *order]]
    done = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    # a row for each part and group in it
    runs = materialize(done.groupBy(part.alias("__part"), *group).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")))
    w = Window.partitionBy(*group)
    before = w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
                          "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                          F.sum("__n").over(w).alias("size"))
    same = [F.col("__part") == F.col("__p"),
            *[F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(group)]]
    out = done.withColumn("__part", part).join(offsets, same)
    return out.select(*[F.col(c) for c in rows.columns],
                      (F.col("__before") + F.col("__at") - F.col("__first")).alias("pos"), "size")


# ---- rounds ---------------------------------------------------------------------------
STEP = "array<struct<left:array<string>,right:array<string>>>"


def _levels(size: int, arity: int, levels: int) -> int | None:
    """A tree with more nodes than one block is raised by all levels, a smaller one
    to its root."""
    return levels if size > arity ** levels else None


def _block_roots(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``tree, pos, size, hash`` of the next round: one row per block of nodes."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        size = t.column("size")[0].as_py()
        hashes = [x.encode() for x in t.column("hash").to_pylist()]
        up = raise_nodes(hashes, arity, _levels(size, arity, levels))
        root = up[-1][0].digest if up else hashes[0]
        return pa.table({"tree": t.column("tree").slice(0, 1), "pos": t.column("block").slice(0, 1),
                         "size": pa.array([-(-size // arity ** levels)], pa.int64()),
                         "hash": pa.array([root.decode()])})
    blocks = nodes.select("tree", "pos", "size", "hash", F.floor(F.col("pos") / arity ** levels).alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(run, "tree bigint, pos bigint, size bigint, hash string")


def _paths(nodes: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """``tree, pos, path, root``: for every node the siblings left and right of it at
    each level up to the root.  ``above``: the same of the block roots."""
    def run(key, nodes: pa.Table, above: pa.Table) -> pa.Table:
        t = nodes.sort_by("pos")
        n = t.num_rows
        hashes = [x.encode() for x in t.column("hash").to_pylist()]
        up = raise_nodes(hashes, arity, _levels(t.column("size")[0].as_py(), arity, levels))
        rest = above.column("path")[0].as_py()
        paths = []
        for i in range(n):
            path = []
            for parents in up:
                i, slot = divmod(i, arity)
                kids = parents[i].children
                path.append({"left": kids[:slot], "right": kids[slot + 1:]})
            paths.append(path + rest)
        kind = pa.list_(pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))]))
        return pa.table({"tree": t.column("tree"), "pos": t.column("pos"), "path": pa.array(paths, kind),
                         "root": pa.array([above.column("root")[0].as_py()] * n)})
    block = F.floor(F.col("pos") / arity ** levels)
    left = nodes.select("tree", "pos", "size", "hash", block.alias("block"))
    up = above.select("tree", F.col("pos").alias("block"), "path", "root")
    return left.groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(
        run, f"tree bigint, pos bigint, path {STEP}, root string")


def _rounds(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The nodes of every round, the last with one node a tree; all written."""
    out = [nodes]
    while (out[-1].agg(F.max("size")).first()[0] or 0) > 1:
        out.append(materialize(_block_roots(out[-1], arity, levels)))
    return out


def _descend(rounds: list[DataFrame], top: DataFrame, arity: int, levels: int) -> DataFrame:
    """The paths of the first round's block roots, given those of the last round."""
    for nodes in reversed(rounds[1:-1]):
        top = materialize(_paths(nodes, top, arity, levels))
    return top


# ---- the manifest ---------------------------------------------------------------------
def audit(leaves: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``id, leaf, claimed, grp, subroot, root, siblings, folded_root``: the manifest
    and a check of what is claimed of every row, one row per input row.

    ``leaves``: ``id`` (bigint), ``grp`` (string), ``leaf`` (hex digest) and
    ``claimed`` (the digest to check in its place).  A group's leaves stand in
    ascending order of id (null first, repeated ids by digest), groups by their
    text (null first, then bytewise).  ``siblings`` is the text of all siblings,
    level by level, left to right (empty for a single leaf); ``folded_root`` is
    the root that ``claimed`` gives with the siblings of the original leaf.
    """
    lv = positions(leaves.select("id", "grp", "leaf", "claimed"), ["grp"], ["id", "leaf", "claimed"])
    groups = positions(lv.groupBy("grp").agg(F.max("size").alias("rows")), [], ["grp"]) \
        .select("grp", F.col("pos").alias("tree"))
    groups = materialize(groups)
    lv = lv.join(groups.select(F.col("grp").alias("__g"), "tree"), F.col("grp").eqNullSafe(F.col("__g"))).drop("__g")
    lv = materialize(lv)
    rounds = _rounds(lv.select("tree", "pos", "size", F.col("leaf").alias("hash")), arity, levels)
    sub = rounds[-1]  # one node a tree: the group roots
    n = sub.count()
    tops = _rounds(sub.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"),
                              F.lit(n).cast("bigint").alias("size"), "hash"), arity, levels)
    no_path = F.array().cast(STEP)
    top = tops[-1].select("tree", "pos", no_path.alias("path"), F.col("hash").alias("root"))
    top = _descend(tops, top, arity, levels)
    if len(tops) > 1:
        top = materialize(_paths(tops[0], top, arity, levels))
    # from the group roots down to the blocks of leaves
    top = top.select(F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", "root") \
        .join(sub.select("tree", F.col("hash").alias("subroot")), "tree")
    subroots = materialize(top.select("tree", "subroot"))
    above = _descend(rounds, materialize(top.select("tree", "pos", "path", "root")), arity, levels)
    return _folded(lv, above.join(subroots, "tree"), arity, levels)


def _folded(leaves: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """Siblings and folded roots of all leaves, block by block."""
    def run(key, t: pa.Table, above: pa.Table) -> pa.Table:
        t = t.sort_by("pos")
        hashes = [x.encode() for x in t.column("leaf").to_pylist()]
        claims = [x.encode() for x in t.column("claimed").to_pylist()]
        up = raise_nodes(hashes, arity, _levels(t.column("size")[0].as_py(), arity, levels))
        root, subroot = above.column("root")[0].as_py(), above.column("subroot")[0].as_py()
        # the parents above the block, rebuilt once: the block's own ancestor stands in its slot
        node, path = (up[-1][0].digest if up else hashes[0]), []
        for step in above.column("path")[0].as_py():
            left, right = ([x.encode() for x in step[k]] for k in ("left", "right"))
            path.append((Parent([*left, node, *right]), len(left)))
            node = path[-1][0].digest
        high = b"".join(p.siblings(slot) for p, slot in path)
        siblings, folded = [], []
        for i, (own, claim) in enumerate(zip(hashes, claims)):
            steps = []
            for parents in up:
                i, slot = divmod(i, arity)
                steps.append((parents[i], slot))
            siblings.append((b"".join(p.siblings(slot) for p, slot in steps) + high).decode())
            if claim == own:
                folded.append(node.decode())
                continue
            for p, slot in steps + path:
                claim = p.resume(slot, claim)
            folded.append(claim.decode())
        n = t.num_rows
        return pa.table({"id": t.column("id"), "leaf": t.column("leaf"), "claimed": t.column("claimed"),
                         "grp": t.column("grp"), "subroot": pa.array([subroot] * n, pa.string()),
                         "root": pa.array([root] * n, pa.string()),
                         "siblings": pa.array(siblings, pa.string()), "folded_root": pa.array(folded, pa.string())})
    block = F.floor(F.col("pos") / arity ** levels).alias("block")
    up = above.select("tree", F.col("pos").alias("block"), "path", "root", "subroot")
    return leaves.select("*", block).groupBy("tree", "block").cogroup(up.groupBy("tree", "block")).applyInArrow(
        run, "id bigint, leaf string, claimed string, grp string, subroot string, root string, siblings string, folded_root string")


def manifest(docs: DataFrame, columns: Sequence[str], group_col: str, id_col: str = "doc_id",
             claims: dict[str, Column] | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``audit`` of the rows of ``docs``: leaves over ``columns`` in order, grouped by
    ``group_col``; ``claims`` replaces columns in the rows to check (default: none).

    Nulls are values of their own (``-`` in a leaf, a group for a null group),
    repeated rows are leaves each, an empty table gives no rows, and columns
    outside ``columns`` are not read.
    """
    if arity < 2 or levels < 1:
        raise ValueError("a tree needs an arity of 2 and a level at least")
    now = {c: F.col(f"`{c}`") for c in columns}
    said = {**now, **(claims or {})}
    return audit(docs.select(id_of(id_col).alias("id"), F.col(f"`{group_col}`").cast("string").alias("grp"),
                             leaf(list(now.values())).alias("leaf"), leaf([said[c] for c in columns]).alias("claimed")),
                 arity, levels)
