"""Quality classifier on random-indexing word vectors (operator 10).

Random indexing: every word — a whole lower-cased run between spaces, nothing cut
or merged — owns a sparse random index vector that follows from its 64-bit hash, so
there is no table of them.  A word's context vector adds the index vectors of its
left and right neighbours over all documents.  Context vectors are kept for the
words that hold at least 1/``SHARES`` of all words of the corpus: at most
``SHARES`` such words can exist, at every size, and their table is the only one
that the driver and the broadcast see.  The vector of a rarer word is its index
vector alone.  A document pools its word vectors (mean and deviation) and adds its
length, the share of distinct words, the mean word length and the share of words
with a context vector.  A two-layer numpy network, fitted on a bounded labelled
sample, gives a logit, and a temperature fitted on a part of the sample that the
network did not see makes it a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import slices, steps
from tessera.llm.common import id_of, lean, text_of
from tessera.llm.labelled import fit_sample
from tessera.session import materialize

MAX_PER_CLASS = 20_000  # labelled documents of either class that the fit reads at most
SHARES = 65_536         # words with this part of all words have context vectors: at most as many words
DIMS = 64
NONZERO = 8             # entries of an index vector, seven bits of the hash each
SURFACE = 4
BLOCK_WORDS = 128       # words per row when context tables are summed
PIECE = 32_768          # word vectors at a time while pooling
FLUSH_WORDS = 500_000   # distinct words counted by a task before it emits them
HIDDEN = 32
EPOCHS = 40
MAX_WORDS = 100_000     # hashes of words remembered per process


class WordHashes(dict):
    """word -> 64-bit hash of the whole lower-cased word; remembers a bounded number."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        if len(self) < MAX_WORDS:
            self[word] = h
        return h


_HASHES = WordHashes()


def hashes_of(text: str) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """Index vectors (rows of ``DIMS`` small integers) of words, from their hashes:
    six bits choose a place and one the sign, ``NONZERO`` times."""
    out, row = np.zeros((len(hashes), DIMS), np.float32), np.arange(len(hashes))
    for k in range(NONZERO):
        part = (hashes >> np.uint64(7 * k)).astype(np.int64) & 127
        out[row, part & 63] += 1 - 2 * (part >> 6)
    return out


def frequent_words(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the words that hold at least 1/``SHARES`` of all words of all
    documents (at most ``SHARES``)."""
    @lean
    def run(batches):
        keys, counts, waiting, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def folded():
            every = np.concatenate([keys, *(k for k, _ in waiting)])
            n = np.concatenate([counts, *(c for _, c in waiting)])
            kinds, at = np.unique(every, return_inverse=True)
            return kinds, np.bincount(at, n, len(kinds)).astype(np.int64)

        def out():
            return pa.RecordBatch.from_pydict({"word": pa.array(keys.view(np.int64), pa.int64()),
                                               "n": pa.array(counts, pa.int64())})
        for b in slices(batches):
            for step in steps(b.column(0).to_pylist()):
                waiting.append(np.unique(np.concatenate([hashes_of(t) for t in step]), return_counts=True))
                size += len(waiting[-1][0])
                if size > FLUSH_WORDS:
                    keys, counts = folded()
                    waiting, size = [], 0
                    if len(keys) > FLUSH_WORDS:
                        yield out()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = folded()
        yield out()
    words = docs.select(text_of(text_col).alias("t")).mapInArrow(run, "word bigint, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n"))
    words = materialize(words)
    total = words.agg(F.sum("n")).first()[0] or 0
    rows = words.filter(F.col("n") * SHARES >= total).select("word").collect()  # at most SHARES rows
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def places(keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``keys``, which of the hashes are there)."""
    if not len(keys):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return at, keys[at] == hashes


def context_counts(docs: DataFrame, keys: np.ndarray, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Context vectors (a row per word of ``keys``) and occurrences, whole numbers summed
    over all documents; every neighbour, frequent or not, adds its own index vector.

    Each task sums one table and emits the blocks it used; blocks meet in groups, and
    only the final table, of at most ``SHARES`` rows, reaches the driver.
    """
    n_blocks = -(-len(keys) // BLOCK_WORDS)
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    @lean
    def run(batches):
        keys, table = shared.value, np.zeros((n_blocks * BLOCK_WORDS, DIMS + 1), np.int64)
        for b in slices(batches):
            for step in steps(b.column(0).to_pylist()):
                parts = [hashes_of(t) for t in step]
                # a mark between documents: no neighbours across it
                first = np.zeros(sum(map(len, parts)), bool)
                ends = np.cumsum([len(p) for p in parts])
                first[[e for e, p in zip(ends - [len(p) for p in parts], parts) if len(p)]] = True
                kinds, at = np.unique(np.concatenate(parts), return_inverse=True)
                row, known = places(keys, kinds)
                np.add.at(table[:, DIMS], row[known], np.bincount(at, minlength=len(kinds))[known])
                right = np.flatnonzero(~first[1:]) + 1  # tokens with a left neighbour
                me, by = np.concatenate([at[right - 1], at[right]]), np.concatenate([at[right], at[right - 1]])
                by = by[known[me]]
                me = row[me[known[me]]]
                mine, me = np.unique(me, return_inverse=True)
                for k in range(NONZERO):
                    part = (kinds >> np.uint64(7 * k)).astype(np.int64)[by] & 127
                    got = np.bincount(me * DIMS + (part & 63), 1.0 - 2 * (part >> 6), len(mine) * DIMS)
                    table[mine, :DIMS] += got.astype(np.int64).reshape(-1, DIMS)
        both = table.reshape(n_blocks, BLOCK_WORDS * (DIMS + 1))
        used = np.flatnonzero(both.any(1))
        for i in used.tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([both[i].tobytes()], pa.binary())],
                                             ["block", "part"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_WORDS * (DIMS + 1), np.int64)
        for x in t.column("part"):
            total += np.frombuffer(x.as_py(), np.int64)
        return pa.table({"block": t.column("block").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})
    rows = docs.select(text_of(text_col).alias("t")).mapInArrow(run, "block bigint, part binary") \
        .groupBy("block").applyInArrow(add, "block bigint, part binary").collect()  # SHARES / BLOCK_WORDS rows
    out = np.zeros((n_blocks * BLOCK_WORDS, DIMS + 1), np.int64)
    for r in rows:
        out[r["block"] * BLOCK_WORDS:][:BLOCK_WORDS] = np.frombuffer(r["part"], np.int64).reshape(-1, DIMS + 1)
    return out[:len(keys), :DIMS], out[:len(keys), DIMS]


@dataclass
class WordVectors:
    """Centred, unit-length context vectors of the frequent words; the vector of any word
    adds its unit-length index vector."""
    keys: np.ndarray
    context: np.ndarray

    @classmethod
    def learn(cls, docs: DataFrame, text_col: str = "text") -> WordVectors:
        keys = frequent_words(docs, text_col)
        context, seen = context_counts(docs, keys, text_col)
        v = context / np.maximum(seen, 1)[:, None] - context.sum(0) / max(1.0, seen.sum())
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        return cls(keys, v.astype(np.float32))

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, which words have a context vector)."""
        out = index_vectors(hashes) / np.float32(np.sqrt(NONZERO))
        row, known = places(self.keys, hashes)
        out[known] += self.context[row[known]]
        return out, known


def pooled(texts: list[str], vectors: WordVectors) -> np.ndarray:
    """A row per text: mean and deviation of its word vectors, log length, share of
    distinct words, log mean word length, share of words with a context vector; zeros
    for a text without words."""
    own = [np.unique(hashes_of(t), return_counts=True) for t in texts]
    total = np.array([n.sum() for _, n in own], float)
    doc = np.repeat(np.arange(len(texts)), [len(k) for k, _ in own])
    kinds = np.concatenate([k for k, _ in own])
    share = (np.concatenate([n for _, n in own]) / np.maximum(total, 1)[doc]).astype(np.float32)
    sums = np.zeros((len(texts), 2 * DIMS + 1))
    for a in range(0, len(kinds), PIECE):
        d, w = doc[a:a + PIECE], share[a:a + PIECE, None]
        v, known = vectors.of(kinds[a:a + PIECE])
        starts = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        sums[d[starts]] += np.add.reduceat(np.concatenate([v * w, v * v * w, known[:, None] * w], 1), starts)
    out = np.zeros((len(texts), 2 * DIMS + SURFACE), np.float32)
    out[:, :DIMS] = sums[:, :DIMS]
    out[:, DIMS:2 * DIMS] = np.sqrt(np.maximum(sums[:, DIMS:2 * DIMS] - sums[:, :DIMS] ** 2, 0))
    some = np.maximum(total, 1)
    out[:, 2 * DIMS] = np.log1p(total)
    out[:, 2 * DIMS + 1] = [len(k) for k, _ in own] / some
    out[:, 2 * DIMS + 2] = np.log1p([max(0, len(t) - t.count(" ")) for t in texts] / some) * (total > 0)
    out[:, 2 * DIMS + 3] = sums[:, 2 * DIMS]
    return out


@dataclass
class QualityModel:
    vectors: WordVectors
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, w: np.ndarray, seed: int = 11) -> tuple[list[np.ndarray], float]:
    """Two layers by Adam on weighted log loss, then the temperature on the fifth
    of the rows that was kept aside."""
    rnd = np.random.default_rng(seed)
    order = rnd.permutation(len(x))
    aside, rest = order[:len(x) // 5], order[len(x) // 5:]
    p = [rnd.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rnd.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    size = max(16, min(256, len(rest) // 8))
    for _ in range(max(EPOCHS, 4_000 * size // max(1, 8 * len(rest)))):
        rest = rnd.permutation(rest)
        for i in range(0, len(rest), size):
            at = rest[i:i + size]
            h = np.tanh(x[at] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[at]) * w[at] / w[at].sum()
            back = d[:, None] * p[2] * (1 - h * h)
            t += 1
            for j, g in enumerate((x[at].T @ back + 1e-3 * p[0], back.sum(0), h.T @ d + 1e-3 * p[2], np.array([d.sum()]))):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                p[j] = p[j] - 0.003 * (m[j] / (1 - 0.9 ** t)) / (np.sqrt(v[j] / (1 - 0.999 ** t)) + 1e-8)
    z = np.tanh(x[aside] @ p[0] + p[1]) @ p[2] + p[3]

    def loss(temp):
        q = 1 / (1 + np.exp(-np.clip(z / temp, -30, 30)))
        return -(w[aside] * np.log(np.clip(np.where(y[aside] == 1, q, 1 - q), 1e-9, 1))).sum()
    temps = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    return p, float(temps[np.argmin([loss(c) for c in temps])]) if len(aside) else 1.0


def fit(docs: DataFrame, labels: DataFrame, mod: int = 3, held_out: int = 1, id_col: str = "doc_id",
        text_col: str = "text", max_per_class: int = MAX_PER_CLASS) -> QualityModel:
    """Word vectors from all documents, the network from labelled ones outside the
    held-out fold.  With one class or none the network is constant (that class, or 0.5)."""
    vectors = WordVectors.learn(docs, text_col)
    sample, classes = fit_sample(docs, labels, "quality", mod, held_out, max_per_class, id_col, text_col)
    rows = features(sample, vectors, "y", "text").collect()  # bounded by the sample
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], float).reshape(-1, 2 * DIMS + SURFACE)
    y = np.array([r["key"] for r in rows], float)
    order = np.lexsort((*x.T[:8], y))  # the collected order is not fixed; the fit is
    x, y = x[order], y[order]
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    if len(set(y)) < 2:
        bias = 0.0 if not len(y) else 30.0 if y[0] else -30.0
        return QualityModel(vectors, mean, scale, [np.zeros((x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                                                   np.zeros(HIDDEN), np.array([bias])], 1.0)
    w = np.where(y == 1, classes[1][0] / max(1, classes[1][1]), classes[0][0] / max(1, classes[0][1]))
    layers, temperature = train((x - mean) / scale, y, w)
    return QualityModel(vectors, mean, scale, layers, temperature)


def features(docs: DataFrame, vectors: WordVectors, key_col: str, text_col: str) -> DataFrame:
    """``key, x``: pooled features as packed 32-bit floats."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    @lean
    def run(batches):
        for b in slices(batches):
            x = [row.tobytes() for step in steps(b.column(1).to_pylist()) for row in pooled(step, shared.value)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], ["key", "x"])
    src = docs.select(F.col(f"`{key_col}`").cast("bigint").alias("key"), text_of(text_col).alias("t"))
    return src.mapInArrow(run, "key bigint, x binary")


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score``: calibrated probability of quality 1 for every row; null and
    empty texts are scored on features of zero."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def run(batches):
        m = shared.value
        for b in slices(batches):
            p = [m.probability(pooled(step, m.vectors).astype(float)) for step in steps(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(p), pa.float64())], ["doc_id", "score"])
    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    return src.mapInArrow(run, "doc_id bigint, score double")
