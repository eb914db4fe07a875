"""Mixing sources to target weights with a low-discrepancy schedule (operator 7).

Targets: the mix holds ``ratio`` times all words; sources share it by weight,
but none takes more than ``limit`` times its own words, and what one cannot
take is shared among the others.

Schedule: the mix is cut into ``slots`` equal-token blocks.  The points of a
van der Corput sequence fall into the cumulative weights of the sources: slot
k belongs to the source whose interval holds point k.  With a power of two of
points, those in an interval are consecutive integers with reversed bits, so
each source lists its own slots, and their rank orders its blocks.

Blocks: the documents of a source, shuffled by a hash, form a stream of words
that repeats; block r covers the r-th equal piece of it.  Joining slots and
blocks on (source, rank) gives the words that each document contributes, and
the slot and the position in the block where they stand in the mix.  These
pieces are written sorted by slot; counts and mixed documents derive from them.
Stream offsets come from totals per (source, hash bucket), so no task sorts a
whole source, however large.  The schedule has a fixed number of slots at any
input size and is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import counted_side, id_of, join_by_group, n_buckets, text_of
from tessera.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SLOTS = 1 << 14          # equal-token blocks of the whole mix
ROWS_PER_BUCKET = 4_096
SEED = "mix"


def shuffle_key(id_col: str, seed: str = SEED) -> Column:
    """Pseudo-random order of documents: MD5 of key and seed."""
    return F.md5(F.concat(F.coalesce(id_of(id_col).cast("string"), F.lit("null")), F.lit(f"/{seed}")))


def source_targets(sizes: DataFrame, weights: Sequence[float], ratio: float, limit: float) -> DataFrame:
    """``src, source, n, source_size, target, take`` from (source, size) rows.

    Sources are numbered in code-point order, null last, and weigh
    ``weights[number mod len]``.  Filling every source to
    ``min(limit · size, level · weight)`` has one level at which the total is
    right: the largest of those that any set of full sources would imply, and
    the full ones come first when ordered by limit · size / weight.  ``take``
    is the target in whole words.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")  # one row per source
    per = per.withColumn("src", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod("src", F.lit(len(weights))) + 1)
    per = per.withColumn("w", w).withColumn("full", F.lit(float(limit)) * F.col("source_size"))
    by_need = Window.orderBy(F.col("full") / F.col("w"), "src")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.lit(float(ratio)) * F.sum("source_size").over(every)
             - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    per = per.withColumn("level", level)
    target = F.least(F.col("full"), F.max("level").over(every) * F.col("w"))
    return per.select("src", "source", "n", "source_size", target.alias("target"),
                      F.floor(target + 0.5).cast("bigint").alias("take"))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """``src, rank, slot``: the blocks of every source and their places in the mix."""
    need = F.ceil(F.col("take") / F.lit(block)).cast("bigint")
    s = sources.withColumn("need", need)
    total = s.agg(F.sum("need")).first()[0] or 0
    bits = max(1, math.ceil(math.log2(max(2, total))))
    points = 1 << bits
    before = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("first", F.coalesce(F.sum("need").over(before), F.lit(0)))

    def edge(c):  # first point at or above c/total
        return F.ceil(c.cast("double") * float(points) / float(max(1, total))).cast("bigint")
    s = s.filter("need > 0").select("src", "need", edge(F.col("first")).alias("lo"),
                                    edge(F.col("first") + F.col("need")).alias("hi"))
    s = s.select("src", "need", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("point"))
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("bigint")  # bit reversal
    s = s.select("src", "need", slot.alias("slot"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy("slot")) - 1
    return s.withColumn("rank", rank.cast("bigint")).filter("rank < need").select("src", "rank", "slot")


def streams(docs: DataFrame, weights: Sequence[float], ratio: float, limit: float, id_col: str,
            text_col: str, source_col: str, seed: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their place in the stream of their source, and the sources."""
    words = F.size(F.regexp_extract_all(text_of(text_col), F.lit(WORD), 0)).cast("bigint")
    rows = materialize(docs.select(
        id_of(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"), words.alias("size"),
        F.col(f"`{source_col}`").cast("string").alias("source"), shuffle_key(id_col, seed).alias("h")))
    n_rows = rows.count()
    sources = counted_side(source_targets(rows, weights, ratio, limit))
    # a null source is a source: join on its text with a mark no text can have
    mark = F.struct(F.col("source").isNull().alias("no"), F.coalesce("source", F.lit("")).alias("name"))
    named = sources.select(mark.alias("key"), "src", "n", "source_size", "target", "take")
    rows = join_by_group(rows.withColumn("key", mark).drop("source"), named, ["key"], "n", n_rows).drop("key", "n")
    buckets = n_buckets(n_rows, ROWS_PER_BUCKET)
    rows = rows.withColumn("b", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double")
                                        / float(1 << 32) * buckets).cast("int"))
    before = Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("src", "b").agg(F.sum("size").alias("t")).select(
        F.col("src").alias("__s"), F.col("b").alias("__b"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "b").orderBy("h", "doc_id", "size", "text_hash") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("run", F.sum("size").over(inside)) \
        .join(totals, (F.col("src") == F.col("__s")) & (F.col("b") == F.col("__b")))
    rows = rows.withColumn("start", F.col("base") + F.col("run") - F.col("size"))
    return rows.select("doc_id", "text_hash", "size", "src", "source_size", "target", "take", "start"), sources


def _pieces(docs, weights, ratio, limit, id_col, text_col, source_col, seed, slots) -> DataFrame:
    """One row per document, pass over its source and block, written in the order of
    the mix; ``lo``, ``hi`` are the words of the document in it, ``pos`` the words of
    the block before them (null, and last, without a block)."""
    rows, sources = streams(docs, weights, ratio, limit, id_col, text_col, source_col, seed)
    total = sources.agg(F.sum("take")).first()[0] or 0
    block = max(1, math.ceil(total / slots))
    plan = schedule(sources, block)  # at most slots + number of sources rows
    passes = F.ceil(F.col("take") / F.greatest("source_size", F.lit(1))).cast("int")
    rows = rows.withColumn("pass", F.explode_outer(F.when(
        (F.col("size") > 0) & (passes > 0), F.sequence(F.lit(0), passes - 1))))
    at = F.col("start") + F.col("pass") * F.col("source_size")
    rows = rows.withColumn("at", at).withColumn("to", F.least(F.col("at") + F.col("size"), F.col("take")))
    first, last = F.floor(F.col("at") / block), F.floor((F.col("to") - 1) / block)
    rows = rows.withColumn("rank", F.explode_outer(F.when(F.col("to") > F.col("at"), F.sequence(first, last))))
    plan = counted_side(plan.select(F.col("src").alias("__src"), F.col("rank").alias("__rank"), "slot"))
    rows = rows.join(plan, (F.col("src") == F.col("__src")) & (F.col("rank") == F.col("__rank")), "left")
    hit = F.col("slot").isNotNull()
    lo = F.greatest(F.col("at"), F.col("rank") * block) - F.col("at")
    hi = F.least(F.col("to"), (F.col("rank") + 1) * block) - F.col("at")
    pos = F.greatest(F.col("at") - F.col("rank") * block, F.lit(0))
    rows = rows.select("doc_id", "text_hash", "size", "src", "source_size", "target", "start", "pass", "slot",
                       F.when(hit, pos).cast("bigint").alias("pos"), F.when(hit, lo).alias("lo"),
                       F.when(hit, hi).alias("hi"))
    return materialize(in_order(rows))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows sorted by their place in the mix, in ranges of it."""
    place = [F.asc_nulls_last("slot"), F.asc("pos"), F.asc("doc_id")]
    return rows.repartitionByRange(*place).sortWithinPartitions(*place)


def interleave(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ratio: float = 1.5, limit: float = 2.0,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
               slots: int = SLOTS) -> DataFrame:
    """``slot, pos, doc_id, text_hash, src, pass, lo, hi``: the mix as pieces of
    documents.  Sorted by (slot, pos) the words ``lo`` to ``hi`` of the documents are
    the mix, in which every prefix holds the sources near their shares.
    """
    p = _pieces(docs, weights, ratio, limit, id_col, text_col, source_col, seed, slots)
    return p.filter("slot IS NOT NULL").select("slot", "pos", "doc_id", "text_hash", "src", "pass", "lo", "hi")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ratio: float = 1.5, limit: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
        slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: how many words of every row the
    mix takes, repeats counted; at most ``limit`` (rounded up) passes over a row.

    Null and empty texts have size 0 and nothing taken.  Null sources form one
    source, numbered last.  The order depends on key, size and text only, so
    reruns agree; rows equal in all three are interchangeable.
    """
    p = _pieces(docs, weights, ratio, limit, id_col, text_col, source_col, seed, slots)
    keys = ["doc_id", "size", "src", "source_size", "target", "start", "text_hash"]
    # rows of size 0 share their start with others: count them instead of merging
    got = p.groupBy(*keys).agg(F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0)).cast("bigint").alias("taken"),
                               F.count(F.lit(1)).alias("rows"))
    again = F.when(F.col("size") == 0, F.sequence(F.lit(1).cast("bigint"), F.col("rows"))) \
        .otherwise(F.array(F.lit(1).cast("bigint")))
    return got.withColumn("again", F.explode(again)).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), ratio: float = 1.5, limit: float = 2.0,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
                    slots: int = SLOTS, with_place: bool = False) -> DataFrame:
    """The mix itself: all columns of ``docs``, one row per document and pass that the
    mix takes words of, sorted by the place of its first word; ``with_place`` adds this
    place as ``slot, pos`` (written files keep no order between them).  A document that a pass takes in part (at the end of its
    source's target) holds the words taken, joined by spaces; all others keep their
    text.  Rows must be unique on (key, text), as after deduplication.
    """
    p = _pieces(docs, weights, ratio, limit, id_col, text_col, source_col, seed, slots).filter("slot IS NOT NULL")
    # a document's words in one pass are contiguous: blocks follow one another
    part = p.groupBy("doc_id", "text_hash", "size", "pass").agg(
        F.min(F.struct("lo", "slot", "pos")).alias("first"), F.max("hi").alias("hi"))
    # one row per document with its one or few passes, joined once
    part = materialize(part.groupBy("doc_id", "text_hash", "size")
                       .agg(F.sort_array(F.collect_list(F.struct("pass", "first", "hi"))).alias("passes")))
    named = {f"__c{i}": c for i, c in enumerate(docs.columns)}
    key = docs.select(*[F.col(f"`{c}`").alias(k) for k, c in named.items()], id_of(id_col).alias("d"),
                      F.xxhash64(text_of(text_col)).alias("t"), text_of(text_col).alias("text"))
    kept = key.join(part, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("text_hash")))
    kept = kept.withColumn("e", F.explode("passes"))
    lo, hi = F.col("e.first.lo").cast("int"), F.col("e.hi").cast("int")
    some = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), lo + 1, hi - lo), " ")
    text = F.when((lo == 0) & (hi == F.col("size")), F.col("text")).otherwise(some)
    kept = in_order(kept.select(*[(text if c == text_col else F.col(k)).alias(k) for k, c in named.items()],
                                "e.first.slot", "e.first.pos", "doc_id"))
    return kept.select(*[F.col(k).alias(c) for k, c in named.items()], *["slot", "pos"] * with_place)
