"""Operators 3 and 10, and the pipeline."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import labelled, quality_net, toxicity

from .helpers import AWKWARD, DOC_SCHEMA, awkward, empty, prose, rows

LABELS = "doc_id bigint, quality int, toxic int"


def brute_segments(s):
    """Maximal segments by their definition: take the best segment (the shortest, then
    the first), then do the same left and right of it."""
    if not s:
        return []
    best, at = 0, None
    for i in range(len(s)):
        total = 0
        for j in range(i, len(s)):
            total += s[j]
            if total > best or (total == best and at and j - i < at[1] - at[0]):
                best, at = total, (i, j)
    if at is None:
        return []
    i, j = at
    return (brute_segments(s[:i]) + [(i, j, best)]
            + [(a + j + 1, b + j + 1, x) for a, b, x in brute_segments(s[j + 1:])])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=14))
def test_maximal_segments(scores):
    got = toxicity.maximal_segments(scores)
    want = brute_segments(scores)
    # equal sums may be cut differently; scores and disjointness must agree
    assert sorted(round(x) for _, _, x in got) == sorted(x for _, _, x in want)
    assert all(sum(scores[a:b + 1]) == x for a, b, x in got)


def toxic_set(n, seed):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(rnd, rnd.choice([30, 80, 200])).split(" ")
        for _ in range(3 * bad):
            words.insert(rnd.randrange(len(words)), rnd.choice(["Grumble", "snarl!", "spitewort"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_set(400, 1)
    df, lab = spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(df, lab)
    assert {"grumble", "snarl", "spitewort"} <= set(model.table)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert all((got[i].score >= 0.3) == (i % 4 == 0) for i in range(400))
    for i in range(0, 400, 4):
        text = docs[i][1].lower()
        found = " ".join(text[p.start:p.end] for p in got[i].passages)
        assert all(w in found for w in ("grumble", "snarl", "spitewort") if w in text)
    kept = toxicity.keep_clean(df, model, 0.3)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4}


def test_toxicity_counts_words_whatever_divides_them(spark):
    """Spaces, tabs, CR, NBSP and blank lines between the same words: same passages, same
    score; clean evidence between two toxic words parts them."""
    docs, labels = toxic_set(200, 7)
    docs = [(i, t if i % 4 == 0 else t + " harvest harvest", *more) for i, t, *more in docs]
    model = toxicity.fit(spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, LABELS))
    words = ["snarl", *["river"] * 200, "grumble"]
    texts = [sep.join(words) for sep in (" ", "\t", "\r", "\u00a0", "\n\n", "   ")]
    got = [model.judge(t) for t in texts]
    assert all(g == got[0] for g in got) and got[0][1] == 202 and len(got[0][0]) == 2
    assert model.table["harvest"] < -model.drift  # clean evidence counts
    near = toxicity.passages(["snarl", "qqq", "grumble"], model.table, model.drift)
    apart = toxicity.passages(["snarl", "harvest", "harvest", "harvest", "harvest", "grumble"], model.table, model.drift)
    assert len(near) == 1 and len(apart) == 2


def test_passages_equal_brute_force():
    rnd = random.Random(3)
    table = {"a": 2.0, "b": 1.0, "c": -1.5}
    for _ in range(200):
        words = [rnd.choice("abcdef") for _ in range(rnd.randrange(30))]
        got = toxicity.passages(words, table, 0.5)
        want = brute_segments([table.get(w, -0.5) for w in words])
        assert sorted(round(x, 6) for *_, x, _ in got) == sorted(round(x, 6) for *_, x in want)
        for a, z, s, new in got:
            assert abs(sum(table.get(w, -0.5) for w in words[a:z + 1]) - s) < 1e-9
            once = [0.0 if table.get(w, 0) > 0 and w in words[:i] else table.get(w, -0.5)
                    for i, w in enumerate(words[a:z + 1], a)]
            assert abs(new - max([0.0] + [sum(once[i:j]) for i in range(len(once)) for j in range(i + 1, len(once) + 1)])) < 1e-9


def test_held_out_labels_are_not_learned(spark):
    docs, labels = toxic_set(120, 2)
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    lab = spark.createDataFrame(labels, LABELS)
    fold = labelled.remainder(lab.doc_id, 4)
    turned = lab.withColumn("toxic", (fold == 2).cast("int") + (fold != 2).cast("int") * lab.toxic)
    a, b = toxicity.fit(df, lab), toxicity.fit(df, turned)
    assert a.table == b.table and (a.bias, a.slope) == (b.bias, b.slope)


def test_toxicity_awkward_rows(spark):
    docs, labels = toxic_set(100, 3)
    model = toxicity.fit(spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, LABELS))
    got = toxicity.score(awkward(spark), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty(spark), model).count() == 0
    assert toxicity.keep_clean(awkward(spark), model, 0.3).columns == awkward(spark).columns
    none = toxicity.fit(awkward(spark), spark.createDataFrame([(1, None, None), (None, 1, 1)], LABELS))
    assert {r.score for r in toxicity.score(awkward(spark), none).collect()} == {toxicity.score_of_nothing(none)}


def test_quality_on_held_out_rows(spark):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(300):
        text = prose(rnd, rnd.choice([40, 120]))
        if i % 3 == 0:
            text = " ".join(w + rnd.choice(["***", "%%%", "&&&"]) for w in text.split(" "))
        docs.append((i, text, "en", "s", 0))
        labels.append((i, int(i % 3 != 0), 0))
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    model = quality_net.fit(df, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.score for r in quality_net.score(df, model).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 3 != 0) for i in range(300)]) > 0.97
    assert 0.5 <= model.temperature <= 8.0
    out = quality_net.score(awkward(spark), model).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    assert quality_net.score(empty(spark), model).count() == 0


def test_quality_without_labels(spark):
    lab = spark.createDataFrame([], LABELS)
    model = quality_net.fit(awkward(spark), lab)
    assert {r.score for r in quality_net.score(awkward(spark), model).collect()} == {0.5}
    quality_net.fit(empty(spark), lab)


def test_context_counts_are_neighbours(spark):
    texts = ["a b a", "b", None, "", "don't can't he's don't", "A " * 50 + "rare-1 b"]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    keys = quality_net.frequent_words(df)
    context, seen = quality_net.context_counts(df, keys)
    want, n = {}, {}
    for t in texts:
        w = (t or "").lower().split()
        for i, x in enumerate(w):
            n[x] = n.get(x, 0) + 1
            by = w[max(0, i - 1):i] + w[i + 1:i + 2]
            want[x] = want.get(x, 0) + sum((quality_net.index_vectors(quality_net.hashes_of(y))[0] for y in by),
                                           np.zeros(quality_net.DIMS))
    assert len(keys) == len(want) == 6  # words with apostrophes and symbols stay apart
    for x, v in want.items():
        (row,), (there,) = quality_net.places(keys, quality_net.hashes_of(x))
        assert there and (context[row] == v).all() and seen[row] == n[x]


def test_frequent_words_hold_their_share(spark, monkeypatch):
    monkeypatch.setattr(quality_net, "SHARES", 10)
    df = spark.createDataFrame([(1, "a " * 12 + "b " * 2 + "c d e f g h", "", "", 0)], DOC_SCHEMA)
    got = set(quality_net.frequent_words(df).tolist())
    assert got == set(quality_net.hashes_of("a b").tolist())  # 12 and 2 of 20 words; the others 1


def test_index_vectors_differ_and_long_texts_pool_whole(monkeypatch):
    every = quality_net.hashes_of(" ".join(f"word{i}" for i in range(50_000)))
    assert len(np.unique(quality_net.index_vectors(every), axis=0)) == 50_000
    keys = np.sort(every[:1_000])
    vectors = quality_net.WordVectors(keys, np.random.default_rng(1).normal(size=(1_000, quality_net.DIMS)).astype(np.float32))
    texts = ["", "x", " ".join(f"word{i % 700}" for i in range(5_000)), "word1 word1 zz"]
    whole = quality_net.pooled(texts, vectors)
    monkeypatch.setattr(quality_net, "PIECE", 64)
    assert np.allclose(whole, quality_net.pooled(texts, vectors), atol=1e-4) and not whole[0].any()
    v, known = vectors.of(quality_net.hashes_of(texts[3]))
    assert np.allclose(whole[3, :quality_net.DIMS], v.mean(0), atol=1e-5)
    assert np.allclose(whole[3, quality_net.DIMS:2 * quality_net.DIMS], v.std(0), atol=1e-3)
    assert known.tolist() == [True, True, False] and np.isclose(whole[3, -1], 2 / 3)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from .test_dedup import brute_components
    from .test_native import brute_mix
    docs, labels = toxic_set(160, 5)
    extra = rows(160, 6)
    docs += [(1000 + i, *r) for i, *r in extra]
    spark.createDataFrame(docs, DOC_SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    out = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, out, str(tmp_path))
        got.write.parquet(str(tmp_path / f"stage{k}"))
        out = spark.read.parquet(str(tmp_path / f"stage{k}"))
        if k < 4:
            assert out.columns == corpus_pipeline.COLUMNS
        if k == 0:
            left = [d for d in left if d[0] >= 160 or d[0] % 4]
        elif k == 1:
            left = list({d[1]: d for d in sorted(left, key=lambda d: d[0])}.values())
        elif k == 2:
            keep = {c for _, _, c in brute_components(left)}
            left = [d for d in left if str(d[0]) in keep]
        if k < 3:
            assert sorted(r.doc_id for r in out.collect()) == sorted(d[0] for d in left), name
        elif k == 3:
            words = {}
            for r in out.collect():
                words[str(r.doc_id)] = words.get(str(r.doc_id), 0) + len(r.text.split())
                assert r.n_chars == len(r.text)
            assert words == {i: n for i, _, _, _, n in brute_mix(left) if n}
            mixed = out.count()
    assert out.count() == mixed and set(out.columns) == {"doc_id", "n_tokens", "ids", "decoded_sha256"}
