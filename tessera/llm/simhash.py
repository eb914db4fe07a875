"""SimHash near-duplicates by segment-popcount embedding (operator 5).

A fingerprint is mapped to the bit counts of its two-bit segments.  One
differing bit changes one count by at most one, so the Manhattan distance of
two embeddings is a lower bound of the Hamming distance of their fingerprints.
The range join "Manhattan distance at most d" runs on a grid: the segments form
``d + 4`` groups, at most d groups of a linking pair differ, so the pair shares
the cell (all counts) of at least four groups.  Every fingerprint goes to the
cell of every choice of four groups; in a cell, pairs pass the Manhattan bound
and are then verified on all 64 bits.

Only distinct fingerprints join (copies are one row), and a cell gives a
spanning forest of its links instead of all its pairs: a breadth-first walk
over the fingerprints not reached yet, which is close to linear for a cluster
of near copies.  Cells that a hash sample shows to be large are dealt as pairs
of blocks to many tasks.  The links are joined into components by contraction:
every node takes its smallest neighbour under a mixed (random-like) order,
edges move to those nodes, until no edge is left.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import slices
from tessera.llm.common import BROADCAST_ROWS, counted_side, id_of, join_by_group, lean, packed, text_of
from tessera.session import materialize

SEED = 42
AGREE = 4             # groups that a cell fixes
BLOCK = 8_192         # fingerprints of a large cell that one task compares with as many
SAMPLE = 64           # one fingerprint in SAMPLE (by hash) is counted to find large cells
SHORT_RUN = 48        # cells up to this size are compared by shifted arrays
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd: multiplying by it permutes 64-bit numbers


def fingerprint(text: str, shingle: int, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words."""
    words = text.encode().lower().split()  # bytes: A-Z only; splits at 09-0D and 20
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    first = np.append(0, ends[:n - shingle] + 1).tolist()
    hash64 = xxhash.xxh64_intdigest
    h = np.fromiter((hash64(joined[a:b], seed) for a, b in zip(first, ends[shingle - 1:].tolist())),
                    np.uint64, n - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 65_536):
        part = np.ascontiguousarray(h[i:i + 65_536]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = SEED) -> DataFrame:
    """``doc_id, text_hash, fp`` (64 bits as signed integers), null texts as empty ones."""
    @lean
    def run(batches):
        for b in slices(batches):
            got = np.fromiter((fingerprint(t, shingle, seed) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got.view(np.int64))],
                                             ["doc_id", "text_hash", "fp"])
    src = docs.select(id_of(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                      text_of(text_col).alias("t"))
    return src.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


# -- the embedding and its grid ---------------------------------------------
def embed(fp: np.ndarray) -> np.ndarray:
    """Counts of the 32 two-bit segments, packed as 32 two-bit fields."""
    low = np.uint64(0x5555555555555555)
    return (fp & low) + ((fp >> np.uint64(1)) & low)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed embeddings: |difference| of each field is the
    bit count of the two in unary (00, 01, 11), so two bit counts give it."""
    low = np.uint64(0x5555555555555555)

    def unary(x):  # 0 -> 00, 1 -> 01, 2 -> 11
        two = (x >> np.uint64(1)) & low
        return (x & low) | two | (two << np.uint64(1))
    return np.bitwise_count(unary(a) ^ unary(b))


def cells(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """(n, choices) cell keys: for each choice of AGREE of the segment groups, the
    counts of those groups and the number of the choice, mixed into 64 bits."""
    n_groups = max_bits + AGREE
    fields = (embed(fp)[:, None] >> np.arange(0, 64, 2, dtype=np.uint64)[None, :]) & np.uint64(3)
    edge = np.linspace(0, 32, n_groups + 1).astype(int)
    code = np.stack([(fields[:, a:b] * np.uint64(3) ** np.arange(b - a, dtype=np.uint64)).sum(1, dtype=np.uint64)
                     for a, b in zip(edge, edge[1:])], 1)
    out = np.empty((len(fp), len(list(combinations(range(n_groups), AGREE)))), np.uint64)
    for c, groups in enumerate(combinations(range(n_groups), AGREE)):
        key = np.full(len(fp), c + 1, np.uint64)
        for g in groups:
            # equal cells always get equal keys; other cells that should meet one are
            # only compared in vain
            key = (key ^ code[:, g]) * MIX
            key ^= key >> np.uint64(29)
        out[:, c] = key
    return out


def _cell_rows(nodes: DataFrame, max_bits: int) -> DataFrame:
    @lean
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(fp), 4_096):
                key = cells(fp[i:i + 4_096], max_bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64).ravel()),
                     pa.array(np.repeat(fp[i:i + 4_096], key.shape[1]).view(np.int64))], ["cell", "fp"])
    return nodes.select("fp").mapInArrow(run, "cell bigint, fp bigint")


# -- links inside cells -------------------------------------------------------
def _near(a, b, max_bits):
    ok = manhattan(embed(a), embed(b)) <= max_bits
    ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= max_bits
    return ok


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of the distinct fingerprints of one cell."""
    left, out = fp, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            hit = _near(np.full(len(left), u), left, max_bits)
            if hit.any():
                got, left = left[hit], left[~hit]
                out.append((np.full(len(got), u), got))
                queue.extend(got)
    return out


def links_of_sorted(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal cells of sorted arrays."""
    start = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]).any(1) if cell.ndim > 1 else cell[1:] != cell[:-1]))
    size = np.diff(np.append(start, len(cell)))
    found = []
    for s, n in zip(start[size > SHORT_RUN], size[size > SHORT_RUN]):
        found += forest(np.unique(fp[s:s + n]), max_bits)
    run = np.repeat(np.arange(len(size)), size)
    short = (size > 1) & (size <= SHORT_RUN)
    at = np.flatnonzero(short[run])
    for lag in range(1, int(size[short].max()) if short.any() else 1):
        at = at[at + lag < len(run)]
        at = at[run[at] == run[at + lag]]
        ok = _near(fp[at], fp[at + lag], max_bits)
        found.append((fp[at[ok]], fp[at[ok] + lag]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _links(dealt: DataFrame, max_bits: int) -> DataFrame:
    """Links of partitions sorted by (cell, part); a run may span batches."""
    def emit(c, f):
        a, b = links_of_sorted(c, f, max_bits)
        pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        pair = pair[pair[:, 0] != pair[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0].view(np.int64)), pa.array(pair[:, 1].view(np.int64))],
                                          ["a", "b"]) if len(pair) else None

    @lean
    def run(batches):
        c, f = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)
        held = []
        for b in batches:
            if not b.num_rows:
                continue
            bc = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], 1)
            held.append((bc, b.column(2).to_numpy(zero_copy_only=False).view(np.uint64)))
            if sum(len(x[1]) for x in held) < 65_536 or (bc[0] == bc[-1]).all() and (held[0][0][0] == bc[-1]).all():
                continue
            c, f = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            cut = np.flatnonzero((c != c[-1]).any(1))
            cut = cut[-1] + 1 if len(cut) else 0  # the last run may go on in the next batch
            if cut and (out := emit(c[:cut], f[:cut])) is not None:
                yield out
            held = [(c[cut:], f[cut:])]
        if held:
            c, f = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            if (out := emit(c, f)) is not None:
                yield out
    return dealt.select("cell", "part", "fp").mapInArrow(run, "a bigint, b bigint")


def link_fingerprints(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect
    everything within ``max_bits`` of each other; no link between others."""
    parts = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = _cell_rows(nodes, max_bits)
    # large cells, from the counts of a hash sample: only decides how cells are dealt
    sampled = _cell_rows(nodes.filter(F.pmod(F.xxhash64("fp"), F.lit(SAMPLE)) == 0), max_bits)
    large = counted_side(sampled.groupBy("cell").agg((F.ceil(F.count(F.lit(1)) * SAMPLE / BLOCK)).alias("blocks"))
                         .filter("blocks > 1").select(F.col("cell").alias("__c"), "blocks"))
    rows = rows.join(large, rows.cell == F.col("__c"), "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    # pair of blocks (i, j), i <= j, as one number; a fingerprint of block x is in all pairs with x
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
        lambda y: F.least(own, y) * F.col("blocks") + F.greatest(own, y)))
    dealt = rows.select("cell", F.explode(pairs).alias("part"), "fp")
    dealt = dealt.repartition(parts, "cell", "part").sortWithinPartitions("cell", "part", "fp")
    return _links(dealt, max_bits)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link; connected nodes share a root.

    Nodes are 64-bit numbers without meaningful order (mixed ones): taking the
    smallest neighbour then removes a constant share of the nodes each round.
    Hub nodes are met by broadcast (``join_by_group``), so no task gets the
    links of a hub.
    """
    edges = materialize(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps = []
    while n := edges.count():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialize(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("to"), F.count(F.lit(1)).alias("n")))
        steps.append(to)
        e = join_by_group(edges, to.select("a", F.col("to").alias("ta"), "n"), ["a"], "n", n).drop("n")
        e = join_by_group(e, to.select(F.col("a").alias("b"), F.col("to").alias("tb"), "n"), ["b"], "n", n)
        edges = materialize(e.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    label = steps[-1].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for to in reversed(steps[:-1]):
        # a node's target is in the next step's table unless its component was finished
        used = to.groupBy("to").agg(F.count(F.lit(1)).alias("m"))
        named = used.join(label, F.col("to") == F.col("node"), "left").select(
            "to", F.coalesce("root", "to").alias("root"), "m")
        label = materialize(join_by_group(to.select(F.col("a").alias("node"), "to"), named, ["to"], "m", to.count())
                            .select("node", "root"))
    return label


def _map_numbers(df: DataFrame, names: str, by: int) -> DataFrame:
    """Multiply 64-bit columns (odd ``by``: a permutation of all numbers)."""
    cols = names.split()

    @lean
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array((
                c.to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(by)).view(np.int64)) for c in b.columns], cols)
    return df.mapInArrow(run, ", ".join(f"{c} bigint" for c in cols))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` — one row per input row.

    ``component_id`` is the smallest key reachable over links of at most
    ``max_bits`` differing bits (null keys are skipped; null if all are null);
    ``root`` is a fingerprint of the component and names it.  Texts without
    words (null, empty, blank) have the fingerprint 0 and link like any other.
    Repeated rows share everything.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col, seed))
    n_rows = rows.count()
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    # contraction needs an order without meaning: it runs on multiplied fingerprints
    links = _map_numbers(link_fingerprints(nodes, max_bits), "a b", int(MIX))
    label = _map_numbers(components(links), "fp root", pow(int(MIX), -1, 1 << 64))
    label = materialize(label.join(nodes, "fp"))
    least = label.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("m"))
    linked = join_by_group(label.select("fp", "root"), least, ["root"], "m", label.count())
    linked = linked.select("fp", F.col("root").alias("__root"), F.col("component_id").alias("__id"))
    named = nodes.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("__root", "fp").alias("root"),
        F.when(F.col("__root").isNull(), F.col("first")).otherwise(F.col("__id")).alias("component_id"))
    return join_by_group(rows, materialize(named), ["fp"], "n", n_rows) \
        .select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, one of each component: that with
    the smallest key (of several with this key, the smallest text hash; of repeated
    rows with this key and text, the one of the least row hash)."""
    rows = materialize(near_duplicates(docs, shingle, max_bits, id_col, text_col))
    head = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = rows.filter(head).groupBy("root").agg(F.min("text_hash").alias("__h"), F.count(F.lit(1)).alias("__n"))
    first = first.filter("__n > 1").select(F.col("root").alias("__root"), "__h")
    more = rows.filter(head).join(first, F.col("root") == F.col("__root")).filter("text_hash <> __h")
    drop = rows.filter(~head).select("doc_id", "text_hash").unionByName(more.select("doc_id", "text_hash"))
    drop = counted_side(drop)
    key = packed(docs, d=id_of(id_col), t=F.xxhash64(text_of(text_col)))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash"))
    kept = key.join(drop, same, "left_anti")
    again = materialize(rows.filter(head).groupBy("doc_id", "text_hash").count().filter("count > 1").drop("count"))
    n_again = again.count()
    if not n_again:
        return kept.select("row.*")
    again = F.broadcast(again) if n_again <= BROADCAST_ROWS else again
    one = kept.join(again, same, "left_semi").groupBy("d", "t").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))


def hex_of(fp: str):
    """The 16 lowercase hex digits of a fingerprint column."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
