"""Target-distribution importance resampling over deduplicated segments (operator 13).

Documents are drawn so that their hashed n-gram features follow a target
corpus: the log ratio of the two bucket distributions is the gain of a feature,
a document weighs the sum of its gains, and the largest weights under Gumbel
noise are drawn (sampling without replacement).

Segments: a line feed separates words, so it cuts a text into lines whose
words and n-grams do not depend on what surrounds them.  Equal lines (after
normalising) are grouped over the whole corpus; the features of each distinct
line are hashed once and its occurrences multiply them, in the corpus counts
and in the weights.  The n-grams that run over line ends depend on the
neighbours: they are hashed per document and added separately.

Bounds: a bucket table has ``N_BUCKETS`` rows, the only thing the driver
receives.  Lines that many documents share meet their documents through
``join_by_group``.  Ranks come from one range sort: positions inside a part
plus the sizes of the parts before it.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_of, join_by_group, lean, packed, text_of
from tessera.session import materialize

N_BUCKETS = 10_000
LONGEST = 3            # words of the longest feature
MIN_WORDS = 20         # a document with fewer is never drawn
SEED = "42"
FLUSH_BYTES = 8 << 20  # distinct lines that a task holds before it passes them on

#: Bytes of a text after normalising: A-Z lower-cased, other ASCII but 0-9, a-z and the line feed a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b == 10 or chr(b).isalnum() else 32 for b in range(256))


def lines_of(text: bytes) -> list[list[bytes]]:
    """The words of every line of a UTF-8 text; lines without words are left out."""
    return [w for line in text.translate(NORMAL).split(b"\n") if (w := line.split())]


def line_features(words: list[bytes], n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to ``LONGEST`` words of one line: the checksum of a
    longer run continues that of the shorter one."""
    sums, out = list(map(crc32, words)), []
    spaced = [b" " + w for w in words]
    for n in range(1, LONGEST + 1):
        out += sums
        sums = list(map(crc32, spaced[n:], sums))
    return np.array(out, np.int64) % n_buckets


def cross_features(lines: list[list[bytes]], n_buckets: int = N_BUCKETS) -> np.ndarray:
    """Buckets of the runs that begin in one line and end in a later one."""
    words = [w for line in lines for w in line]
    out, end = [], 0
    for line in lines[:-1]:
        end += len(line)
        for start in range(max(end - LONGEST + 1, end - len(line)), end):
            total = crc32(b" ".join(words[start:end]))
            for w in words[end:start + LONGEST]:
                total = crc32(b" " + w, total)
                out.append(total)
    return np.array(out, np.int64) % n_buckets


def line_key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _kind(n_buckets: int) -> str:
    """Packed buckets are little-endian unsigned integers, as short as they can be."""
    return "<u2" if n_buckets <= 1 << 16 else "<u4"


def _raw(buckets: np.ndarray, n_buckets: int) -> bytes:
    return buckets.astype(_kind(n_buckets)).tobytes()


def _binary_text(docs: DataFrame, text_col: str) -> Column:
    return text_of(text_col).cast("binary").alias("t")


def distinct_lines(docs: DataFrame, text_col: str = "text", n_buckets: int = N_BUCKETS) -> DataFrame:
    """Written table ``key, n, features``: every distinct line with its occurrences
    and the buckets of its features, packed."""
    @lean
    def count(batches):
        seen, held = Counter(), 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(seen.values(), pa.int64())],
                                              ["line", "n"])
        for b in batches:
            for text in b.column(0):
                for words in lines_of(text.as_py()):
                    line = b" ".join(words)
                    seen[line] += 1
                    held += len(line) if seen[line] == 1 else 0
                if held >= FLUSH_BYTES:
                    yield out()
                    seen, held = Counter(), 0
        if seen:
            yield out()

    @lean
    def hashed(batches):
        for b in batches:
            for i in range(0, b.num_rows, 4_096):
                part = b.slice(i, 4_096)
                lines = [x.split(b" ") for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(line_key, lines), pa.binary()), part.column(1),
                     pa.array([_raw(line_features(x, n_buckets), n_buckets) for x in lines], pa.binary())], ["key", "n", "features"])
    lines = docs.select(_binary_text(docs, text_col)).mapInArrow(count, "line binary, n bigint")
    lines = lines.groupBy("line").agg(F.sum("n").alias("n"))
    return materialize(lines.mapInArrow(hashed, "key binary, n bigint, features binary"), "zstd")


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   n_buckets: int = N_BUCKETS, row_id: Column | None = None) -> DataFrame:
    """Written table of one row per document: ``rid, doc_id, n_words, keys`` (its
    lines' keys, each once), ``times`` (how often) and ``cross`` (buckets of the
    runs over line ends)."""
    @lean
    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                texts = [lines_of(x) for x in part.column(2).to_pylist()]
                keys = [Counter(map(line_key, x)) for x in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array([sum(map(len, x)) for x in texts], pa.int64()),
                    pa.array([list(k) for k in keys], pa.list_(pa.binary())),
                    pa.array([list(k.values()) for k in keys], pa.list_(pa.int64())),
                    pa.array([_raw(cross_features(x, n_buckets), n_buckets) for x in texts], pa.binary())],
                    ["rid", "doc_id", "n_words", "keys", "times", "cross"])
    src = docs.select((F.monotonically_increasing_id() if row_id is None else row_id).alias("rid"),
                      id_of(id_col).alias("doc_id"), _binary_text(docs, text_col))
    return materialize(src.mapInArrow(
        run, "rid bigint, doc_id bigint, n_words bigint, keys array<binary>, times array<bigint>, cross binary"))


def bucket_counts(lines: DataFrame, doc_lines: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """How often every bucket occurs: distinct lines' features times occurrences, and
    the runs over line ends."""
    @lean
    def run(batches):
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for raw, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                np.add.at(total, np.frombuffer(raw, _kind(n_buckets)), n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    both = lines.select("features", "n").unionAll(doc_lines.select("cross", F.lit(1).cast("bigint")))
    got = both.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(n_buckets, np.int64)  # at most n_buckets rows came back
    for r in got:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 · log ratio) of the smoothed bucket shares, target over source."""
    s_all, t_all, m = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((float(t + 1) * (s_all + m)) / (float(s + 1) * (t_all + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _gain_sum(df: DataFrame, features: str, gain: np.ndarray) -> DataFrame:
    """``df`` with the column ``features`` replaced by ``weight``, the sum of its gains."""
    at, keep, kind = df.columns.index(features), [c for c in df.columns if c != features], _kind(len(gain))

    @lean
    def run(batches):
        for b in batches:
            w = [int(gain[np.frombuffer(x, kind)].sum()) for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(w, pa.int64())], [*keep, "weight"])
    types = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join([*[f"{c} {types[c]}" for c in keep], "weight bigint"]))


def weigh(lines: DataFrame, doc_lines: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rid, doc_id, n_words, weight``: gains of a distinct line summed once, times its
    occurrences in the document, plus those of the runs over line ends."""
    groups = materialize(_gain_sum(lines, "features", gain))
    total = groups.agg(F.sum("n")).first()[0] or 0
    rows = doc_lines.select("rid", F.explode(F.arrays_zip("keys", "times")).alias("z")) \
        .select("rid", F.col("z.keys").alias("key"), F.col("z.times").alias("m"))
    met = join_by_group(rows, groups, ["key"], "n", total)
    own = _gain_sum(doc_lines.select("rid", "doc_id", "n_words", "cross"), "cross", gain)
    parts = own.unionByName(met.select("rid", (F.col("weight") * F.col("m")).alias("weight")), allowMissingColumns=True)
    return parts.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                    F.sum("weight").alias("weight"))


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 · Gumbel noise) of a key: the first 8 hex digits of a SHA-256 (a null
    key draws as the key ``null``)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / float(1 << 32)))).cast("bigint")


def ranked(scored: DataFrame, share: int) -> DataFrame:
    """``rid, rank`` of the ``share`` percent (rounded down) with the highest scores,
    ties to the smaller doc_id, null keys last."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("rid")]
    # positions: the id of a row is its part and its place there, in the order of the range sort
    done = materialize(scored.select("score", "doc_id", "rid").repartitionByRange(*order).sortWithinPartitions(*order)
                       .select("rid", F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    sizes = sorted((r["part"], r["count"]) for r in done.groupBy(part.alias("part")).count().collect())  # one row a part
    first, before = [], 0
    for p, n in sizes:
        first.append((p, before))
        before += n
    top = before * share // 100
    offsets = F.broadcast(scored.sparkSession.createDataFrame(first, "part bigint, before bigint"))
    out = done.withColumn("part", part).join(offsets, "part")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return out.select("rid", rank.alias("rank")).filter(F.col("rank") <= top)


def _score(docs: DataFrame, target: DataFrame, id_col: str, text_col: str, target_text: str, share: int,
           n_buckets: int, min_words: int, seed: str, row_id: Column | None = None) -> DataFrame:
    lines = distinct_lines(docs, text_col, n_buckets)
    doc_lines = document_lines(docs, id_col, text_col, n_buckets, row_id)
    t_lines, t_docs = distinct_lines(target, target_text, n_buckets), \
        document_lines(target.select(F.lit(0).alias("k"), F.col(f"`{target_text}`").alias("t")), "k", "t", n_buckets)
    gain = gains(bucket_counts(lines, doc_lines, n_buckets), bucket_counts(t_lines, t_docs, n_buckets))
    out = weigh(lines, doc_lines, gain)
    n = F.col("n_words")
    features = sum((F.greatest(n - i, F.lit(0)) for i in range(1, LONGEST)), n)
    out = materialize(out.select("rid", "doc_id", n, features.cast("bigint").alias("n_features"), "weight",
                                 (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")))
    return out.join(ranked(out.filter(n >= min_words), share), "rid", "left")


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               target_text: str = "text", share: int = 5, n_buckets: int = N_BUCKETS,
               min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``, one row per document.

    ``rank`` numbers the documents drawn: ``share`` percent of those with at
    least ``min_words`` words, the highest scores first; null for the others.
    A null or empty text has no features and weight 0.  Equal texts weigh the
    same, repeated rows are ranked one after the other.  An empty target gives
    every bucket the share of the smoothing.  Extra columns are not read.
    """
    return _score(docs, target, id_col, text_col, target_text, share, n_buckets, min_words, seed) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", share: int = 5, n_buckets: int = N_BUCKETS,
             min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """The documents that ``importance`` draws, with all their columns (repeated rows
    are drawn one by one)."""
    rows = materialize(packed(docs, __rid=F.monotonically_increasing_id()))
    src = rows.select(F.col("__rid").alias("r"), F.col("row").getField(id_col).alias("i"),
                      F.col("row").getField(text_col).alias("x"))
    drawn = _score(src, target, "i", "x", target_text, share, n_buckets, min_words, seed, F.col("r"))
    drawn = drawn.filter("rank IS NOT NULL").select(F.col("rid").alias("__rid"))
    return rows.join(drawn, "__rid", "left_semi").select("row.*")
