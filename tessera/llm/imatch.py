"""I-Match document fingerprints (operator 8), built-in functions only.

The lexicon holds the terms whose inverse document frequency lies in a band:
in at least ``low`` and at most ``high`` of all documents.  Since every
document counts once per term, at most (mean distinct terms) / ``low`` terms
can reach the band, so its size does not grow with the number of documents.
A document keeps its distinct lexicon terms, sorted, and hashes them once as a
whole and once for each of several randomised subsets of the lexicon: levels
of disjoint random subsets, ``LEVELS`` giving 1/rate of the lexicon each.
Sparse subsets survive edits of long documents, dense ones describe short
documents.  A document without a lexicon term hashes all its terms instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import id_of, n_buckets, text_of
from tessera.session import materialize

LOW, HIGH = 0.01, 0.5
LEVELS = (32, 128, 512)  # a subset of a level holds 1/rate of the lexicon
SUBSETS = 12             # subsets used of each level
INFORMED = 6             # signatures a level needs to speak for itself
ROWS_PER_BUCKET = 2_000
MAX_BUCKETS = 100_000    # bounds the bucket edges that pass through the driver
NONE = "-" * 16         # no term: a signature is 16 hex digits, all 64 bits


def terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased runs of letters and digits."""
    words = F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """``term`` (hash), ``df`` of the band, from all documents."""
    n = docs.count()
    seen = docs.select(F.explode(terms(text_of(text_col))).alias("term"))
    return seen.groupBy("term").agg(F.count(F.lit(1)).alias("df")) \
        .filter(F.col("df").between(low * n, high * n))


def _hex(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), len(NONE), "0"))


def signatures(own: Column, band: Column) -> Column:
    """Array of signatures of sorted band terms: the whole, then every subset.

    ``own`` are all terms of the document, used where it has no band term."""
    kept = F.when(F.size(band) > 0, band).otherwise(F.sort_array(own))
    whole = F.array(F.when(F.size(kept) > 0, _hex(F.xxhash64(kept))).otherwise(F.lit(NONE)))
    return F.concat(whole, *[_level(kept, i, rate) for i, rate in enumerate(LEVELS)])


def _level(kept: Column, i: int, rate: int) -> Column:
    """Signatures of the subsets of one level; other bits of the hash choose the
    subset at each level."""
    def slot(t):
        return F.pmod(F.shiftrightunsigned(t, 18 * i), F.lit(rate))
    some = F.filter(kept, lambda t: slot(t) < SUBSETS)

    def subset(j):
        got = F.filter(some, lambda t: slot(t) == j)
        return F.when(F.size(got) > 0, _hex(F.xxhash64(got))).otherwise(F.lit(NONE))
    return F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), subset)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among those that at least one of the two has.

    Read from the sparsest level with ``INFORMED`` such signatures, else from
    all levels; 1 if the whole signatures agree, 0 if nothing is shared."""
    def counts(first, n):
        pair = F.zip_with(F.slice(a, first, n), F.slice(b, first, n), lambda x, y: F.when(
            (x == NONE) & (y == NONE), F.lit(0)).when(x == y, F.lit(1001)).otherwise(F.lit(1)))
        # informed signatures modulo 1000, equal ones in the thousands
        return F.aggregate(pair, F.lit(0), lambda s, x: s + x)

    def share(c):
        return F.floor(c / 1000) / F.pmod(c, F.lit(1000))
    every = counts(2, SUBSETS * len(LEVELS))
    out = F.when(F.pmod(every, F.lit(1000)) > 0, share(every)).otherwise(F.lit(0.0))
    for i in range(len(LEVELS)):
        c = counts(2 + i * SUBSETS, SUBSETS)
        out = F.when(F.pmod(c, F.lit(1000)) >= INFORMED, share(c)).otherwise(out)
    return F.when(F.get(a, F.lit(0)) == F.get(b, F.lit(0)), F.lit(1.0)).otherwise(out)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, next_text, ghost, bucket) in descending key order, and the
    window that follows this order inside a bucket.

    Buckets are key ranges from approximate quantiles.  The first document of
    the bucket below is copied into each bucket as its last row (``ghost``),
    the overall first one into the lowest bucket, so the document that follows
    is known from one shuffle, without a global sort.  Repeated keys follow the
    order of a text hash; null keys come last.
    """
    lowest = -(1 << 63)
    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    ids = src.select(F.coalesce("doc_id", F.lit(lowest)).alias("sid"))
    buckets = min(MAX_BUCKETS, n_buckets(docs.count(), ROWS_PER_BUCKET))
    edges = []
    if buckets > 1:
        got = ids.agg(F.percentile_approx("sid", [i / buckets for i in range(1, buckets)], 20 * buckets)).first()[0]
        edges = sorted({int(e) for e in got or []})
    src = _bucketize(src.withColumn("sid", F.coalesce("doc_id", F.lit(lowest))), edges)
    tops = src.groupBy("bucket").agg(F.max("sid").alias("top"))
    # at most MAX_BUCKETS + 1 rows: one window over all of them, then a broadcast
    up = F.lead("bucket").over(Window.orderBy("bucket"))
    ghosts = tops.select("top", F.coalesce(up, F.min("bucket").over(Window.partitionBy())).alias("into"))
    src = src.join(F.broadcast(ghosts), F.col("sid") == F.col("top"), "left")
    at = F.when(F.col("into").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("g")))) \
        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("g")),
                           F.struct(F.col("into").alias("b"), F.lit(1).alias("g"))))
    src = src.select("doc_id", "sid", "text", F.xxhash64("text").alias("th"), F.explode(at).alias("at")) \
        .select("doc_id", "sid", "text", "th", F.col("at.b").alias("bucket"), F.col("at.g").alias("ghost"))
    w = Window.partitionBy("bucket").orderBy("ghost", F.desc("sid"), "th")
    return src.withColumn("next_text", F.lead("text").over(w)), w


def _bucketize(df: DataFrame, edges: list[int]) -> DataFrame:
    """``bucket``: position of ``sid`` among the edges (Spark ML's binary search)."""
    if not edges:
        return df.withColumn("bucket", F.lit(0))
    from pyspark.ml.feature import Bucketizer
    cuts = sorted({float(e) for e in edges})
    b = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__x", outputCol="__y")
    return b.transform(df.withColumn("__x", F.col("sid").cast("double"))) \
        .withColumn("bucket", F.col("__y").cast("int")).drop("__x", "__y")


def edited_text() -> Column:
    """The text with its last third replaced by as much of the next one's start."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW,
                  high: float = HIGH) -> DataFrame:
    """``doc_id, n_chars, edited_text, sigs, edited_sigs, near_edited, near_next``.

    Null texts are empty.  Texts without a term have the signature of nothing;
    two of them are alike (1).  Repeated rows follow one another.
    """
    words = materialize(lexicon(docs, text_col, low, high))
    band = words.agg(F.sort_array(F.collect_list("term"))).scalar()  # bounded, see above
    rows, w = with_next(docs, id_col, text_col)
    rows = rows.withColumn("edited", F.when(F.col("ghost") == 0, edited_text()))
    rows = rows.select("*", terms(F.col("text")).alias("own"),
                       terms(F.coalesce("edited", F.lit(""))).alias("own_edited"))
    rows = rows.select("*", F.sort_array(F.array_intersect("own", band)).alias("kept"),
                       F.sort_array(F.array_intersect("own_edited", band)).alias("kept_edited"))
    rows = rows.select("doc_id", "sid", "th", "bucket", "ghost", F.length("text").cast("bigint").alias("n_chars"),
                       F.col("edited").alias("edited_text"),
                       signatures(F.col("own"), F.col("kept")).alias("sigs"),
                       signatures(F.col("own_edited"), F.col("kept_edited")).alias("edited_sigs"))
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(w)).filter("ghost = 0")
    return rows.select("doc_id", "n_chars", "edited_text", "sigs", "edited_sigs",
                       likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                       likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))
