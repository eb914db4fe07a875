"""Operators 11, 12 and 13: brute force, laws and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import merkle, pii, resample

from .helpers import AWKWARD, CLASHING, DOC_SCHEMA, awkward, empty, prose, rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


# -- merkle ----------------------------------------------------------------------
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(r, more=0):
    values = [r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def brute_path(levels, i, arity):
    out = []
    for level in levels[:-1]:
        first = i // arity * arity
        out.append((level[first:i], level[i + 1:first + arity]))
        i //= arity
    return out


def brute_audit(docs, changed, arity):
    """Sorted (leaf, subroot, root, siblings, folded root) of all rows."""
    by = defaultdict(list)
    for r in docs:
        by[r[2]].append((r[0] is not None, r[0] or 0, brute_leaf(r), brute_leaf(r, changed(r))))
    trees = {g: brute_tree([x[2] for x in sorted(v)], arity) for g, v in by.items()}
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    top = brute_tree([trees[g][-1][0] for g in names], arity)
    out = []
    for g, v in by.items():
        for i, (_, _, leaf, claim) in enumerate(sorted(v)):
            path = brute_path(trees[g], i, arity) + brute_path(top, names.index(g), arity)
            for left, right in path:
                claim = sha(*left, claim, *right)
            out.append((leaf, trees[g][-1][0], top[-1][0], "".join("".join(a + b) for a, b in path), claim))
    return sorted(out)


def tampered(r):
    return int(zlib.crc32(str(r[0]).encode()) % 7 == 0) if r[0] is not None else 0


@pytest.mark.parametrize("arity,levels,n", [(2, 2, 75), (3, 1, 60), (2, 10, 40), (2, 3, 1)])
def test_manifest_equals_brute_force(spark, arity, levels, n):
    docs = [(i, t, ["en", "de", None, "ñ", "en"][i % 5], s, c) for i, t, _, s, c in rows(n, 3)]
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    claims = {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = merkle.manifest(df, COLUMNS, "lang", claims=claims, arity=arity, levels=levels).collect()
    want = brute_audit(docs, tampered, arity)
    assert sorted((r.leaf, r.subroot, r.root, r.siblings, r.folded_root) for r in got) == want
    root = want[0][2]
    assert all((r.folded_root == root) == (r.leaf == r.claimed) for r in got)


def test_resuming_a_state_equals_hashing_again():
    kids = [sha(str(i)).encode() for i in range(5)]
    p = merkle.Parent(kids)
    for slot in range(5):
        new = sha("new").encode()
        changed = [*kids[:slot], new, *kids[slot + 1:]]
        assert p.resume(slot, new) == sha(*[c.decode() for c in changed]).encode()
        assert p.resume(slot, kids[slot]) == p.digest  # states are copies: nothing was used up


def test_manifest_awkward_rows(spark):
    got = merkle.manifest(awkward(spark), COLUMNS, "lang", levels=2).collect()
    want = brute_audit(AWKWARD, lambda r: 0, 2)
    assert sorted((r.leaf, r.subroot, r.root, r.siblings, r.folded_root) for r in got) == want
    assert merkle.manifest(empty(spark), COLUMNS, "lang").count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(awkward(spark), COLUMNS, "lang", arity=1)


def test_every_change_of_a_column_shows(spark):
    df = spark.createDataFrame(rows(30, 5), DOC_SCHEMA)
    for c in ("source", "text", "lang"):
        out = merkle.manifest(df, COLUMNS, "lang", claims={c: F.concat(F.col(c), F.lit("x"))}, levels=2)
        assert out.filter("folded_root = root").count() == 0


# -- personal data -----------------------------------------------------------------
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    """The contract's patterns, as they stand."""
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in m.group() if d in "0123456789"]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else None,
                    "card": 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(a, z, kind) for a, _, z, kind in sorted(out)]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "-", "%", " ", "+", "(", ")", "1", "0", "25", "255", "256", "é", "7 ",
                                 "4111111111111111", "+1 (555) 123-4567", "10.0.0.1", "x@y.zz"]), max_size=25).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert [s[:3] for s in pii.base_spans(text)] == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("x" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+" + "1 " * 150_000):
        assert all(k in pii.KINDS for _, _, k, _ in pii.base_spans(text))


def brute_added(docs, window, left_bits, min_contexts):
    """Added spans per document, by the definition."""
    per = []
    for r in docs:
        text = r[1] or ""
        base = pii.base_spans(text)
        words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\w+", text)
                 if not any(m.start() < z and a < m.end() for a, z, *_ in base)]
        near = defaultdict(lambda: ([], set()))
        for a, z, kind, value in base:
            left = [w for w in words if w[1] <= a][-window:]
            right = [w for w in words if w[0] >= z][:window]
            near[f"{kind}:{value}"][0].append(tuple(w[2] for w in left + right))
            near[f"{kind}:{value}"][1].update(left + right)
        per.append((words, {e: (tuple(c), s) for e, (c, s) in near.items()}))
    half = lambda t: t[:(len(t) + 1) // 2] + "*"
    df, both, ctx, df_e = Counter(), Counter(), defaultdict(set), Counter()
    for words, near in per:
        terms = {w[2] for w in words}
        df.update(terms | {half(t) for t in terms})
        for e, (c, s) in near.items():
            df_e[e] += 1
            for t in {w[2] for w in s} | {half(w[2]) for w in s}:
                both[e, t] += 1
                ctx[e, t].add(c)

    def left(e, t):
        return math.log2(df[t] / both[e, t])
    out = []
    for words, near in per:
        got = {}
        for e, (_, s) in near.items():
            for a, z, t in s:
                if df_e[e] < len(docs) and len(ctx[e, t]) >= min_contexts and left(e, t) < left_bits:
                    g = half(t)
                    keep = left(e, g) >= left_bits and len(g) - 1 < len(t)
                    got[a, z] = min(got.get((a, z), (math.inf, "")), (len(g), g) if keep else (0, ""))
        out.append(sorted((a, z, "generalised" if g else "removed", g) for (a, z), (_, g) in got.items()))
    return out


def told_set(n, seed):
    """Documents in which one term marks one address, and copies of a context."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        words = prose(rnd, 40).split(" ")
        if i % 6 == 0:
            words[10:10] = ["Zanzibarite", "kamil", "mail", "ann@example.com", "kallo"]
        if i % 5 == 0:
            words[25:25] = ["call", "+1 (555) 123-4567", "kamilrado"]
        text = " ".join(words)
        out.append((i, out[0][1] if i and i % 8 == 0 else text, "en", "s", len(text)))
    return out


def test_added_spans_equal_brute_force(spark):
    docs = told_set(90, 2)
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    want = brute_added(docs, pii.WINDOW, pii.LEFT_BITS, pii.MIN_CONTEXTS)
    got = {r.doc_id: r for r in pii.find(df).collect()}
    for r, added in zip(docs, want):
        mine = [(s.start, s.end, s.kind, s.replacement) for s in got[r[0]].spans if s.kind in pii.ADDED]
        assert mine == added
        assert [(s.start, s.end, s.kind) for s in got[r[0]].base] == plain_spans(r[1])
        assert [s.start for s in got[r[0]].spans] == sorted(s.start for s in got[r[0]].spans)
    kinds = Counter(k for x in want for _, _, k, _ in x)
    assert kinds["removed"] and kinds["generalised"]
    clean = pii.sanitise(df).collect()
    assert len(clean) == 90 and set(clean[0].asDict()) == set(df.columns)
    assert not any("ann@" in r.text or "555" in r.text or "Zanzibarite" in r.text for r in clean)
    untouched = {r[0]: r[1] for r, added in zip(docs, want) if not plain_spans(r[1])}
    assert all(r.text == untouched[r.doc_id] for r in clean if r.doc_id in untouched)


def test_pii_awkward_rows(spark):
    df = awkward(spark)
    got = pii.find(df).collect()
    assert len(got) == len(AWKWARD) and all(r.spans == [] for r in got)
    back = pii.sanitise(df)
    assert back.columns == df.columns and set(CLASHING) <= set(back.columns)
    assert sorted(str((r.doc_id, r.text)) for r in back.collect()) == sorted(str(r[:2]) for r in AWKWARD)
    assert pii.find(empty(spark)).count() == 0 and pii.sanitise(empty(spark)).count() == 0


def test_overlapping_spans_are_cut_once():
    spans = [{"start": 2, "end": 6, "replacement": "<a>"}, {"start": 4, "end": 9, "replacement": "<b>"},
             {"start": 9, "end": 10, "replacement": ""}]
    assert pii.cut("0123456789ab", spans) == "01<a>ab"


# -- resampling --------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_features(text, m):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % m for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute_importance(docs, target, m, share, least):
    feats = [brute_features(r[1], m) for r in docs]
    s, t = (Counter(b for _, f in x for b in f) for x in (feats, [brute_features(x, m) for x in target]))
    sn, tn = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sn + m) / ((s[b] + 1) * (tn + m)))) for b in range(m)]
    out = []
    for r, (n, f) in zip(docs, feats):
        h = int(hashlib.sha256(f"42:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([r[0], len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for i, x in enumerate(able[:share * len(able) // 100]):
        x[4] = i + 1
    return sorted((x[:5] for x in out), key=str)


def lined(n, seed):
    rnd = random.Random(seed)
    line = [prose(rnd, k) for k in (1, 2, 5, 9, 1, 30)]
    return [(i, "\n".join(rnd.choice([*line, "", " - ", "Ünï-" + prose(rnd, 3)]) for _ in range(rnd.choice([1, 3, 12]))),
             "en", "s", 0) for i in range(n)]


def test_importance_equals_brute_force(spark):
    docs, target = lined(120, 4), ["kalo mira star", "Kalin kalin\nkalin", None, ""]
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id bigint, text string")
    got = resample.importance(df, bench, share=30, n_buckets=200, min_words=5)
    want = brute_importance(docs, target, 200, 30, 5)
    assert sorted((list(r) for r in got.collect()), key=str) == want
    drawn = resample.resample(df, bench, share=30, n_buckets=200, min_words=5)
    assert drawn.columns == df.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(x[0] for x in want if x[4])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "B1", "é", "\n", " ", "-", "x y z", "\n\n"]), max_size=20).map("".join))
def test_segments_give_every_feature_once(text):
    lines = resample.lines_of(text.encode())
    got = Counter(b for w in lines for b in resample.line_features(w, 997).tolist())
    got.update(resample.cross_features(lines, 997).tolist())
    assert got == Counter(brute_features(text, 997)[1])


def test_importance_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "one word")], "item_id bigint, text string")
    got = resample.importance(awkward(spark), bench, share=50, n_buckets=100, min_words=1)
    assert sorted((list(r) for r in got.collect()), key=str) == brute_importance(AWKWARD, ["one word"], 100, 50, 1)
    assert resample.importance(empty(spark), bench).count() == 0
    none = resample.importance(awkward(spark), bench.filter("false"), share=50, n_buckets=100, min_words=1)
    assert none.count() == len(AWKWARD)
    drawn = resample.resample(awkward(spark), bench, share=100, n_buckets=100, min_words=1)
    assert drawn.count() == 9 and set(CLASHING) <= set(drawn.columns)
