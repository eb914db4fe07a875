"""Token counts of whole texts, huge ones by overlap resynchronisation (operator 4).

A text of at most ``chunk_chars`` code points is counted in one go.  A longer
one is cut into chunks; each chunk also holds the first ``overlap`` code points
of the next one, and chunks of one document are encoded by different tasks.

Two neighbouring chunks are spliced at a proven common boundary: the
pre-tokenising pattern scans from left to right and remembers nothing across
the start of a pre-token, so if both chunks start a pre-token at the same
offset of the overlap, they agree from there on.  The left chunk's starts are
true ones (by induction from the start of the document) except the last two
of a cut chunk, whose end or lookahead the cut may have changed; those are not
offered.  The right chunk's starts may be wrong until it has resynchronised,
so the first start that both have is the splice.  Documents with an overlap
without a common start (a long run of letters or spaces) are cut again with an
overlap ``WIDEN`` times as long, until it covers the document.
"""

from __future__ import annotations

import bisect

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import load, slices
from tessera.llm.common import id_of, lean, text_of
from tessera.session import materialize

CHUNK_CHARS = 32_768
OVERLAP = 256
WIDEN = 16


def _number_rows(docs: DataFrame, chunk_chars: int, path: str, pattern: str) -> DataFrame:
    """Count short texts; hand long ones on.  ``row_key`` (task, position) tells
    repeated rows apart and holds because the result is written once."""
    @lean
    def run(batches):
        from pyspark import TaskContext
        bpe, task, n = load(path, pattern), TaskContext.get().partitionId(), 0
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            count: list[int | None] = [None] * len(texts)
            for i, c in zip(short, bpe.count_many([texts[i] for i in short])):
                count[i] = c
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{task}-{n + i}" for i in range(len(texts))]), b.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(count, pa.int64()),
                pa.array([t if c is None else None for t, c in zip(texts, count)], pa.string())],
                ["row_key", "doc_id", "n_bytes", "n_tokens", "long_text"])
            n += len(texts)
        bpe.forget()
    return docs.mapInArrow(run, "row_key string, doc_id bigint, n_bytes bigint, n_tokens bigint, long_text string")


def _cut(long_docs: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """(row_key, k, of, text) with chunk k = [k·c, (k+1)·c + overlap) of the text."""
    @lean
    def run(batches):
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                of = max(1, -(-max(0, len(text) - overlap) // chunk_chars))
                for k in range(of):
                    end = len(text) if k == of - 1 else (k + 1) * chunk_chars + overlap
                    yield pa.RecordBatch.from_pydict(
                        {"row_key": [key], "k": [k], "of": [of], "text": [text[k * chunk_chars:end]]},
                        schema=pa.schema([("row_key", pa.string()), ("k", pa.int64()),
                                          ("of", pa.int64()), ("text", pa.string())]))
    return long_docs.select("row_key", "long_text").mapInArrow(
        run, "row_key string, k bigint, of bigint, text string")


def _starts(bpe, text: str) -> tuple[list[int], list[int]]:
    """Offsets at which pre-tokens start, and the tokens before each; one more
    entry for the end.  Special tokens count as one pre-token."""
    at: list[int] = []
    words: list[bytes | None] = []
    pos = 0
    for unit in (bpe.special_split.split(text) if bpe.special_split else [text]):
        if unit in bpe.special:
            at.append(pos)
            words.append(None)
        else:
            for m in bpe.pattern.finditer(unit):
                at.append(pos + m.start())
                words.append(m.group().encode())
        pos += len(unit)
    size = {w: len(x) for w, x in bpe.encode_words(list({w for w in words if w})).items()}
    before, n = [0], 0
    for w in words:
        n += 1 if w is None else size[w]
        before.append(n)
    return [*at, len(text)], before


def _encode_chunks(chunks: DataFrame, chunk_chars: int, overlap: int, path: str, pattern: str) -> DataFrame:
    """Per chunk its total and the offered splice points: pre-token starts with
    the tokens before them, in its head and in its tail (offsets in the overlap)."""
    schema = pa.schema([("row_key", pa.string()), ("k", pa.int64()), ("of", pa.int64()), ("n", pa.int64()),
                        *[(c, pa.list_(pa.int64())) for c in ("head", "head_n", "tail", "tail_n")]])

    @lean
    def run(batches):
        bpe = load(path, pattern)
        # a special token's string may be cut by the chunk's end: starts within its
        # length of the end are not offered either
        guard = max((len(s) for s in bpe.special), default=0)
        for b in batches:
            for key, k, of, text in zip(*(c.to_pylist() for c in b.columns)):
                at, before = _starts(bpe, text)
                cut = k < of - 1
                head = bisect.bisect_left(at, overlap) if k else 0
                lo = bisect.bisect_left(at, chunk_chars) if cut else 0
                hi = max(lo, min(len(at) - 3, bisect.bisect_left(at, len(text) - guard))) if cut else 0
                yield pa.RecordBatch.from_pydict({
                    "row_key": [key], "k": [k], "of": [of], "n": [before[-1]],
                    "head": [at[:head]], "head_n": [before[:head]],
                    "tail": [[x - chunk_chars for x in at[lo:hi]]], "tail_n": [before[lo:hi]]}, schema=schema)
    return chunks.mapInArrow(run, "row_key string, k bigint, of bigint, n bigint, head array<bigint>, "
                                  "head_n array<bigint>, tail array<bigint>, tail_n array<bigint>")


def splice(rows: pd.DataFrame, chunk_chars: int) -> int | None:
    """Tokens of a document from its chunks; None if two neighbours share no
    pre-token start in their overlap."""
    total, before, since = 0, 0, 0  # up to the last splice: tokens; its tokens and offset in this chunk
    left = None
    for r in rows.sort_values("k").itertuples():
        if left is not None:
            right = dict(zip(r.head, r.head_n))
            hit = next(((n, right[x], x) for x, n in zip(left.tail, left.tail_n)
                        if x in right and x + chunk_chars >= since), None)
            if hit is None:
                return None
            total += hit[0] - before
            _, before, since = hit
        left = r
    return int(total + left.n - before)


def count_tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024, chunk_chars: int = CHUNK_CHARS,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes`` (UTF-8), ``n_tokens, over_limit`` (more than ``limit``).

    Null and empty texts: 0 bytes, 0 tokens.  Repeated rows and null keys: one
    result row each.  The number of rounds grows with the logarithm of the
    longest run without a boundary, not with the number of documents.
    """
    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    base = materialize(_number_rows(src, chunk_chars, path, pattern))
    done = [base.filter("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens")]
    pending = base.filter("n_tokens IS NULL").select("row_key", "doc_id", "n_bytes", "long_text")

    def join_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row_key": [pdf["row_key"].iloc[0]], "n_tokens": pd.array([splice(pdf, chunk_chars)], "Int64")})

    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    while not pending.isEmpty():
        chunks = _cut(pending, chunk_chars, overlap).repartition(parts, "row_key", "k")
        got = materialize(_encode_chunks(chunks, chunk_chars, overlap, path, pattern)
                          .groupBy("row_key").applyInPandas(join_chunks, "row_key string, n_tokens bigint"))
        counted = got.filter("n_tokens IS NOT NULL")
        done.append(pending.select("row_key", "doc_id", "n_bytes").join(counted, "row_key")
                    .select("doc_id", "n_bytes", "n_tokens"))
        pending = pending.join(got.filter("n_tokens IS NULL").select("row_key"), "row_key", "left_semi")
        overlap *= WIDEN
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
