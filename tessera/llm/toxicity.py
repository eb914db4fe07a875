"""Toxicity by maximum-scoring segments (operator 3).

Tokens get log-odds of the toxic against the clean class under an informative
Dirichlet prior, whose pseudo-counts follow the token's frequency in all
documents.  Every token scores its own log-odds, toxic or clean, drawn towards
zero by a standard error, less ``DRIFT``; log-odds within ``MIN_Z`` standard errors
of zero, and those of tokens that the labelled sample does not hold, are zero.
Tokens whose plain rates in the sample do not differ clearly are taken as zero
before their corpus frequency is looked up.  Toxic evidence must occur in ``MIN_DOCS`` toxic documents of the
sample.  One linear scan over all tokens of a text finds its maximal scoring
segments — the toxic passages.  Under the clean model the
scores of maximal segments follow an extreme-value law, so a segment of score
S in a text of n tokens has the E-value K·n·exp(-λS); λ solves
E[exp(λ·score)] = 1 for clean tokens and K comes from the segments of clean
training texts.  A text's evidence adds the significance of its passages and a
logistic curve turns it into a probability.

Token counts are summed by Spark; the model is a table of scored tokens whose
size is bounded by the labelled sample (``max_per_class``).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import slices
from tessera.llm.common import id_of, lean, text_of
from tessera.llm.labelled import fit_sample
from tessera.session import materialize

MAX_PER_CLASS = 20_000  # labelled documents of either class that the fit reads at most
MIN_Z = 2.0             # standard errors that a token's log-odds lie from zero, else they count as zero
MIN_DOCS = 2            # toxic sample documents that a token with toxic evidence occurs in
PRIOR = 0.1             # pseudo-counts as a share of the sample's tokens
DRIFT = 0.5             # cost of every token
FOLDS = 4               # parts of the sample; a text is calibrated on tables learned from the others
COUNTS = ("toxic_n", "clean_n", "toxic_docs")
FLUSH_WORDS = 50_000   # distinct words counted by a task before it emits them

WORD = re.compile(r"[^\W\d_]+")


def lowered(text: str) -> str:
    """Lower case that keeps every offset."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a sequence in linear
    time: every segment that no prefix, suffix or neighbour can improve."""
    found: list[list[float]] = []  # left sum, right sum, first, last
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        left, first = before, i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j -= 1
            if j < 0 or found[j][1] >= total:
                found.append([left, total, first, i])
                break
            # the segment since candidate j improves on both: they become one
            left, first = found[j][0], int(found[j][2])
            del found[j:]
    return [(int(f), int(e), r - lft) for lft, r, f, e in found]


def passages(words: list[str], table: dict[str, float], drift: float) -> list[tuple[int, int, float, float]]:
    """Maximal segments (first token, last token, score, new) of a text's tokens.
    ``new`` is the best segment within where toxic tokens that the text held before
    score 0: words of a text repeat far more often than the clean model of
    independent tokens allows."""
    scores = np.fromiter((table.get(w, -drift) for w in words), float, len(words))
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    total = np.append(0.0, np.cumsum(scores))
    steps = np.empty(2 * len(up) - 1)
    steps[::2], steps[1::2] = scores[up], total[up[1:]] - total[up[:-1] + 1]  # a token, what lies between, a token
    found = maximal_segments(steps.tolist())
    seen: set[str] = set()
    for i, at in enumerate(up.tolist()):
        if words[at] in seen:
            steps[2 * i] = 0.0
        seen.add(words[at])
    # a segment of the lower scores lies within one of the higher ones
    new, k = [0.0] * len(found), 0
    for a, _, s in maximal_segments(steps.tolist()):
        while found[k][1] < a:
            k += 1
        new[k] = max(new[k], s)
    return [(int(up[a // 2]), int(up[z // 2]), s, n) for (a, z, s), n in zip(found, new)]


@dataclass
class ToxicModel:
    table: dict[str, float]
    drift: float
    lam: float
    k: float
    bias: float
    slope: float

    def evidence(self, found, n_words: int) -> float:
        """Sum over passages of -ln P(a clean text of this length has one as good)."""
        out = 0.0
        for *_, new in found:
            e = self.k * max(1, n_words) * math.exp(-self.lam * new)
            out -= math.log(-math.expm1(-e)) if e > 1e-12 else math.log(1e-12)
        return out

    def judge(self, low: str):
        """(passages, tokens, evidence) of a lower-cased text."""
        words = WORD.findall(low)
        found = passages(words, self.table, self.drift)
        return found, len(words), self.evidence(found, len(words))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * math.log1p(evidence)))))


def word_counts(sample: DataFrame) -> DataFrame:
    """``word`` and arrays by fold ``toxic_n, clean_n, toxic_docs`` over the labelled sample."""
    @lean
    def run(batches):
        count: dict[tuple[str, int], list[int]] = {}

        def out():
            cols = list(zip(*count.values())) or [(), (), ()]
            return pa.RecordBatch.from_pydict({
                "word": pa.array([w for w, _ in count], pa.string()), "fold": pa.array([f for _, f in count], pa.int32()),
                **{c: pa.array(list(x), pa.int64()) for c, x in zip(COUNTS, cols)}})
        for b in slices(batches, 256):
            for text, y, fold in zip(*(b.column(i).to_pylist() for i in range(3))):
                for w, n in Counter(WORD.findall(lowered(text))).items():
                    c = count.setdefault((w, fold), [0, 0, 0])
                    c[1 - y] += n
                    c[2] += y
            if len(count) > FLUSH_WORDS:
                yield out()
                count.clear()
        yield out()
    got = sample.select("text", "y", "fold").mapInArrow(
        run, "word string, fold int, toxic_n bigint, clean_n bigint, toxic_docs bigint")
    return got.groupBy("word").agg(*[F.array(*[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(c))), F.lit(0))
                                               for f in range(FOLDS)]).alias(c) for c in COUNTS])


def corpus_counts(docs: DataFrame, words: list[str], text_col: str) -> tuple[dict[str, int], int]:
    """Occurrences of ``words`` in all documents, and the tokens there are."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    @lean
    def run(batches):
        asked, seen, total = set(shared.value), Counter(), 0
        for b in slices(batches):
            for text in b.column(0).to_pylist():
                found = WORD.findall(lowered(text))
                total += len(found)
                seen.update(filter(asked.__contains__, found))
        seen[""] = total
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()),
                                          "n": pa.array(list(seen.values()), pa.int64())})
    rows = docs.select(text_of(text_col).alias("t")).mapInArrow(run, "word string, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n")).collect()  # one row per word asked for
    got = {r["word"]: r["n"] for r in rows}
    return got, got.pop("", 0)


def fit(docs: DataFrame, labels: DataFrame, mod: int = 4, held_out: int = 2, id_col: str = "doc_id",
        text_col: str = "text", max_per_class: int = MAX_PER_CLASS) -> ToxicModel:
    """Learn from labelled documents outside the held-out fold; without toxic labels
    no token scores and every text gets the score 0 or the only class there is."""
    sample, classes = fit_sample(docs, labels, "toxic", mod, held_out, max_per_class, id_col, text_col)
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int"))
    counts = materialize(word_counts(sample))
    sums = counts.agg(*[F.sum(F.get(c, F.lit(f))) for c in COUNTS[:2] for f in range(FOLDS)]).first()
    n_t, n_c = (np.array([x or 0 for x in sums[i:i + FOLDS]], float) for i in (0, FOLDS))
    if not n_t.sum() or not n_c.sum():
        return ToxicModel({}, DRIFT, 1.0, 1.0, 30.0 if n_t.sum() else -30.0, 0.0)

    def added(c):
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    t, c = added("toxic_n"), added("clean_n")
    # tokens that can score: twice as frequent in toxic texts, or rarer there by MIN_Z
    # standard errors (half an occurrence added); the others score as unknown tokens do
    toxic_side = (added("toxic_docs") >= MIN_DOCS) & (t / n_t.sum() > 2 * c / n_c.sum())
    clean_side = F.log((c + 0.5) / (t + 0.5)) + math.log(n_t.sum() / n_c.sum()) > MIN_Z * F.sqrt(1 / (c + 0.5) + 1 / (t + 0.5))
    likely = counts.filter(toxic_side | clean_side).collect()  # bounded by the sample
    corpus, total = corpus_counts(docs, [r["word"] for r in likely], text_col)
    words = [r["word"] for r in likely]
    toxic, clean, in_docs = (np.array([r[c] for r in likely], float).reshape(-1, FOLDS) for c in COUNTS)
    common = np.array([max(1, corpus.get(w, 0)) for w in words], float) / max(1, total)

    def learned(use: np.ndarray) -> ToxicModel:
        t_n, c_n = n_t[use].sum(), n_c[use].sum()
        prior = PRIOR * (t_n + c_n)
        t, c = toxic[:, use].sum(1) + prior * common, clean[:, use].sum(1) + prior * common
        delta = np.log(t / (t_n + prior - t)) - np.log(c / (c_n + prior - c))
        error = np.sqrt(1 / t + 1 / c)
        own = np.where(np.abs(delta) > MIN_Z * error, delta - np.sign(delta) * error, 0.0)
        own[(own > 0) & (in_docs[:, use].sum(1) < MIN_DOCS)] = 0.0
        known = np.flatnonzero(own)  # the others score as unknown tokens do
        table = {words[i]: float(own[i] - DRIFT) for i in known}
        return ToxicModel(table, DRIFT, _lambda(own[known] - DRIFT, c[known] / (c_n + prior), DRIFT), 1.0, 0.0, 0.0)
    every = np.arange(FOLDS)
    model, others = learned(every), [learned(np.delete(every, f)) for f in range(FOLDS)]
    # K: passages that clean texts have under tables learned without them, against
    # exp(-λ·score) at the least score
    got = segment_stats(sample, others)
    none = got[:, 0] == 0
    least = min((x for x in model.table.values() if x > 0), default=0.0)
    k = max(0.1, float(got[none, 2].sum())) / (max(1.0, float(got[none, 1].sum())) * math.exp(-model.lam * least))
    for m in (model, *others):
        m.k = k
    return _calibrate(segment_stats(sample, others), model, classes)


def _lambda(scores: np.ndarray, p: np.ndarray, drift: float) -> float:
    """The positive root of E[exp(λ·score)] = 1 for clean tokens (bisection)."""
    if not (scores > 0).any():
        return 1.0

    def excess(x):
        return float((p * np.exp(np.minimum(x * scores, 600))).sum() + (1 - p.sum()) * math.exp(-x * drift)) - 1
    lo, hi = 1e-6, 1.0
    while excess(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    return hi


def segment_stats(sample: DataFrame, models: list[ToxicModel]) -> np.ndarray:
    """Rows (label, words, passages, evidence) of the bounded labelled sample, each
    text under the model that was learned without its fold."""
    shared = sample.sparkSession.sparkContext.broadcast(models)

    @lean
    def run(batches):
        for b in slices(batches):
            out = []
            for text, y, fold in zip(*(b.column(i).to_pylist() for i in range(3))):
                got, n, evidence = shared.value[fold].judge(lowered(text))
                out.append((y, n, len(got), evidence))
            yield pa.RecordBatch.from_arrays([pa.array([float(r[i]) for r in out], pa.float64()) for i in range(4)],
                                             ["y", "n", "found", "evidence"])
    rows = sample.select("text", "y", "fold").mapInArrow(
        run, "y double, n double, found double, evidence double").collect()
    return np.array([tuple(r) for r in rows], float).reshape(-1, 4)


def _calibrate(got: np.ndarray, model: ToxicModel, classes: dict[int, tuple[int, int]]) -> ToxicModel:
    """Logistic curve over log evidence, classes weighted as they occur in the labels."""
    y, x = got[:, 0], np.log1p(got[:, 3])
    w = np.where(y == 1, classes[1][0] / max(1, classes[1][1]), classes[0][0] / max(1, classes[0][1]))
    beta, design, ridge = np.zeros(2), np.stack([np.ones(len(x)), x], 1), np.array([1e-2, 1.0])

    def loss(b):
        z = design @ b
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + (ridge * b * b).sum() / 2)
    for _ in range(100):  # Newton steps, halved until the loss falls
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (w * (y - p)) - ridge * beta
        step = np.linalg.solve((design * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ design + np.diag(ridge), grad)
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    model.bias, model.slope = float(beta[0]), float(max(0.0, beta[1]))
    return model


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, passages`` (array of start, end in code points, score, E-value).

    Null and empty texts have no passage and the score of no evidence.
    Repeated rows get one result row each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])

    @lean
    def run(batches):
        m = shared.value
        for b in slices(batches):
            scores, spans = [], []
            for text in b.column(1).to_pylist():
                low = lowered(text)
                got, n, evidence = m.judge(low)
                scores.append(m.score(evidence))
                at = [w.span() for w in WORD.finditer(low)] if got else []
                spans.append([{"start": at[a][0], "end": at[z][1], "score": s, "e_value": m.k * n * math.exp(-m.lam * s)}
                              for a, z, s, _ in got])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))],
                                             ["doc_id", "score", "passages"])
    src = docs.select(id_of(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    return src.mapInArrow(run, "doc_id bigint, score double, "
                               "passages array<struct<start:bigint,end:bigint,score:double,e_value:double>>")


def keep_clean(docs: DataFrame, model: ToxicModel, at: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``at``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    @lean
    def run(batches):
        m = shared.value
        for b in slices(batches):
            keep = []
            for text in b.column(column).to_pylist():
                keep.append(m.score(m.judge(lowered(text or ""))[2]) < at)
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def score_of_nothing(model: ToxicModel) -> float:
    """Score of a text without any passage."""
    return model.score(0.0)
