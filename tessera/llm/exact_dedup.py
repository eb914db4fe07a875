"""Exact deduplication with counting quotient filters (operator 2).

1. Every text gets a 64-bit fingerprint and its SHA-256; these narrow rows are
   written once.
2. Each task builds counting quotient filters of its fingerprints, one per
   range of leading bits.  Filters of one range meet in one task and merge
   losslessly by their sorted remainders; the ranges of a 64-bit hash hold
   equal shares of the distinct fingerprints, however hot a text is, because a
   copy only raises a counter.
3. Fingerprints with a count above one are candidates.  Texts that have them
   are grouped by their bytes (partial aggregation leaves one row per task and
   distinct text before the shuffle, so a hot text moves once per task).
4. The narrow rows learn their group by an equi-join whose hot keys are
   broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, counted_side, id_of, join_by_group, lean, packed, text_of
from tessera.session import materialize

FLUSH_ROWS = 1 << 20  # fingerprints that one task holds before it emits filters
CHUNK_ROWS = 65_536    # equal rows written out by a task at a time


class CountingQuotientFilter:
    """Counted set of 64-bit fingerprints as quotient runs of sorted remainders.

    A fingerprint is its quotient (``q`` leading bits below the shared prefix)
    and its remainder.  ``occupied`` has a bit per quotient, ``run_end`` a bit
    per slot, slots hold the remainders in (quotient, remainder) order, and
    counters are kept only where they exceed one.  Nothing is rounded away:
    ``decode`` returns exactly what was put in.
    """

    def __init__(self, prefix_bits: int, prefix: int, q: int, occupied, run_end, remainders, at, extra):
        self.prefix_bits, self.prefix, self.q = prefix_bits, prefix, q
        self.occupied, self.run_end, self.remainders, self.at, self.extra = occupied, run_end, remainders, at, extra

    @staticmethod
    def build(values: np.ndarray, counts: np.ndarray, prefix_bits: int) -> CountingQuotientFilter:
        """From sorted distinct uint64 fingerprints that share their leading bits."""
        q = max(1, min(32, int(len(values)).bit_length(), 63 - prefix_bits))
        r = 64 - prefix_bits - q
        prefix = int(values[0] >> np.uint64(64 - prefix_bits)) if prefix_bits else 0
        quotient = ((values >> np.uint64(r)) & np.uint64((1 << q) - 1)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        run_end = np.append(quotient[1:] != quotient[:-1], True)
        at = np.flatnonzero(counts > 1)
        return CountingQuotientFilter(prefix_bits, prefix, q, occupied, run_end,
                                      values & np.uint64((1 << r) - 1), at, counts[at])

    def decode(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted fingerprints and their counts."""
        r = 64 - self.prefix_bits - self.q
        run = np.cumsum(self.run_end) - self.run_end  # runs that ended before each slot
        value = self.remainders | (np.flatnonzero(self.occupied)[run].astype(np.uint64) << np.uint64(r))
        if self.prefix_bits:
            value |= np.uint64(self.prefix) << np.uint64(64 - self.prefix_bits)
        count = np.ones(len(value), np.int64)
        count[self.at] = self.extra
        return value, count

    def to_bytes(self) -> bytes:
        width = -(-(64 - self.prefix_bits - self.q) // 8)
        head = np.array([self.prefix_bits, self.prefix, self.q, len(self.remainders), len(self.at), width], "<i8")
        slots = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        return b"".join(x.tobytes() for x in (
            head, np.packbits(self.occupied), np.packbits(self.run_end), np.ascontiguousarray(slots),
            self.at.astype("<u4"), self.extra.astype("<i8")))

    @staticmethod
    def from_bytes(raw: bytes) -> CountingQuotientFilter:
        bits, prefix, q, n, more, width = np.frombuffer(raw, "<i8", 6).tolist()
        pos = 48

        def take(kind, count):
            nonlocal pos
            x = np.frombuffer(raw, kind, count, pos)
            pos += x.nbytes
            return x
        occupied = np.unpackbits(take(np.uint8, -(-(1 << q) // 8)), count=1 << q).astype(bool)
        run_end = np.unpackbits(take(np.uint8, -(-n // 8)), count=n).astype(bool)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = take(np.uint8, n * width).reshape(n, width)
        return CountingQuotientFilter(bits, prefix, q, occupied, run_end, slots.view("<u8").ravel(),
                                      take("<u4", more).astype(np.int64), take("<i8", more))

    @staticmethod
    def merge(filters: Iterable[CountingQuotientFilter]) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints of several filters in order, counters added; equal
        numbers of filters merge with each other, so a fingerprint moves
        log(filters) times."""
        held: list[tuple[int, np.ndarray, np.ndarray]] = []  # filters merged, fingerprints, counts

        def join_last():
            (n, v, c), (m, w, d) = held.pop(), held.pop()
            v, c = np.concatenate([w, v]), np.concatenate([d, c])
            order = np.argsort(v, kind="stable")  # two sorted runs: a merge
            v, c = v[order], c[order]
            new = np.append(True, v[1:] != v[:-1])
            held.append((n + m, v[new], np.add.reduceat(c, np.flatnonzero(new))))
        for f in filters:
            if len(f.remainders):
                held.append((1, *f.decode()))
                while len(held) > 1 and held[-2][0] <= held[-1][0]:
                    join_last()
        while len(held) > 1:
            join_last()
        return held[0][1:] if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _filters(hashes: DataFrame, prefix_bits: int) -> DataFrame:
    """(range, filter): the filters of every task, one per range of leading bits."""
    def flush(parts):
        value, count = np.unique(np.concatenate(parts).view(np.uint64), return_counts=True)
        lead = (value >> np.uint64(64 - prefix_bits)).astype(np.int64) if prefix_bits else np.zeros(len(value), np.int64)
        cuts = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))
        raw = [CountingQuotientFilter.build(v, c, prefix_bits).to_bytes() for v, c in
               zip(np.split(value, cuts[1:]), np.split(count, cuts[1:]))]
        return pa.RecordBatch.from_arrays([pa.array(lead[cuts]), pa.array(raw, pa.binary())], ["range", "filter"])

    @lean
    def run(batches):
        parts, held = [], 0
        for b in batches:
            if b.num_rows:
                parts.append(b.column(0).to_numpy(zero_copy_only=False))
                held += b.num_rows
            if held >= FLUSH_ROWS:
                yield flush(parts)
                parts, held = [], 0
        if held:
            yield flush(parts)
    return hashes.select("fp").mapInArrow(run, "range bigint, filter binary")


def repeated_fingerprints(hashes: DataFrame) -> DataFrame:
    """``fp, n`` of the fingerprints that occur more than once in column ``fp``."""
    ranges = max(1, int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def merge(t: pa.Table) -> pa.Table:
        value, count = CountingQuotientFilter.merge(
            CountingQuotientFilter.from_bytes(x) for x in t.column("filter").to_pylist())
        many = count > 1
        return pa.table({"fp": pa.array(value[many].view(np.int64)), "n": pa.array(count[many])})
    return _filters(hashes, (ranges - 1).bit_length()).groupBy("range").applyInArrow(merge, "fp bigint, n bigint")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fingerprint_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` — one row per input row.

    Texts are equal when their bytes are; a null text equals the empty text.
    Of equal texts the row with the largest key stays (null keys are smaller
    than all others); if that key is repeated, one of its rows stays.
    ``fingerprint_bits`` only sets how many texts reach byte verification.
    """
    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    fp = F.shiftrightunsigned(F.xxhash64("text"), 64 - fingerprint_bits) if fingerprint_bits < 64 else F.xxhash64("text")
    src = src.withColumn("fp", fp)
    rows = materialize(src.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256")))
    n_rows = rows.count()
    repeated = materialize(repeated_fingerprints(rows))
    if repeated.count() <= BROADCAST_ROWS:
        candidates = src.join(F.broadcast(repeated), "fp")
        routed = rows.join(F.broadcast(repeated), "fp")
    else:
        candidates = join_by_group(src, repeated, ["fp"], "n", n_rows).filter("n IS NOT NULL")
        routed = join_by_group(rows, repeated, ["fp"], "n", n_rows).filter("n IS NOT NULL")
    groups = candidates.groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = materialize(groups.filter("group_size > 1")
                         .select("fp", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"))
    out = join_by_group(rows, groups, ["fp", "text_sha256"], "group_size", n_rows)
    single = F.col("group_size").isNull()
    out = out.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                     F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"), "text_sha256")
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # a repeated key among equal texts: one of its rows stays
    again = materialize(routed.groupBy("doc_id", "text_sha256").count().filter("count > 1"))
    if not again.isEmpty():
        hit = again.select(F.col("doc_id").alias("__d"), F.col("text_sha256").alias("__s"))
        hit = F.broadcast(hit) if again.count() <= BROADCAST_ROWS else hit
        same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_sha256") == F.col("__s"))
        # such rows are equal: counted, then written out again in chunks, the first row kept
        chunks = out.join(hit, same, "left_semi").groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n")) \
            .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK_ROWS})"))).repartition("doc_id", "chunk")
        twice = chunks.withColumn("at", F.explode(F.expr(
            f"sequence(chunk * {CHUNK_ROWS}, least(n, (chunk + 1) * {CHUNK_ROWS}) - 1)"))) \
            .withColumn("kept", F.col("kept") & (F.col("at") == 0)).select(*out.columns)
        out = out.join(hit, same, "left_anti").unionByName(twice)
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``exact_groups`` keeps."""
    rows = materialize(exact_groups(docs, id_col, text_col))
    key = packed(docs, d=id_of(id_col), s=F.sha2(text_of(text_col), 256))
    drop = rows.filter(~F.col("kept")).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    drop = counted_side(drop.select("doc_id", "text_sha256"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("s") == F.col("text_sha256"))
    out = key.join(drop, same, "left_anti").select("row.*")
    # a key and text that occur more than once and stay once
    stay = rows.filter("kept").select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"))
    once = counted_side(stay.join(drop, same, "left_semi").withColumnsRenamed({"d": "doc_id", "s": "text_sha256"}))
    if not once.isEmpty():
        stays = key.join(once, same).groupBy("d", "s").agg(F.first("row").alias("row"))  # a row per task shuffles
        out = out.unionByName(stays.select("row.*"))
    return out
