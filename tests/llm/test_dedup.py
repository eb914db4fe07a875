"""Operators 2 and 5 against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import exact_dedup, simhash
from tessera.llm.exact_dedup import CountingQuotientFilter as Cqf

from .helpers import AWKWARD, DOC_SCHEMA, awkward, empty, rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), min_size=1, max_size=4),
       st.sampled_from([0, 1, 5]))
def test_filters_are_lossless(parts, bits):
    if bits:  # one filter holds one range of leading bits
        parts = [[(x >> bits) | (1 << (63 - bits + 1)) for x in p] for p in parts]
    parts = [[x % (1 << (64 - bits)) for x in p] for p in parts]
    total = defaultdict(int)
    filters = []
    for p in parts:
        v, c = np.unique(np.array(p + p[:3], np.uint64), return_counts=True)
        for x, n in zip(v.tolist(), c.tolist()):
            total[x] += n
        filters.append(Cqf.from_bytes(Cqf.build(v, c, bits).to_bytes()))
    v, c = Cqf.merge(filters)
    assert dict(zip(v.tolist(), c.tolist())) == dict(total) and (np.diff(v.astype(object)) > 0).all()


def brute_exact(docs):
    groups = defaultdict(list)
    for i, t, *_ in docs:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(str(i), str(keep), len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 5])
def test_exact_groups(spark, bits):
    for docs, df in ((AWKWARD, awkward(spark)), (rows(300), spark.createDataFrame(rows(300), DOC_SCHEMA))):
        got = exact_dedup.exact_groups(df, fingerprint_bits=bits).collect()
        assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute_exact(docs)
        kept = [r for r in got if r.kept]
        assert len({r.text_sha256 for r in kept}) == len(kept) == len({r.text_sha256 for r in got})
        assert all(str(r.doc_id) == str(r.keep_id) for r in kept)
    assert exact_dedup.exact_groups(empty(spark)).count() == 0


def test_exact_groups_by_shuffle(spark, monkeypatch):
    """Beyond the broadcast bound the result is the same."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", 0)
    docs = rows(200, 4) + [(1000 + i, "hot copy", "en", "s", 8) for i in range(150)]
    got = exact_dedup.exact_groups(spark.createDataFrame(docs, DOC_SCHEMA)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == brute_exact(docs)


def test_deduplicate_keeps_columns(spark):
    df = awkward(spark)
    got = exact_dedup.deduplicate(df)
    assert got.columns == df.columns
    assert sorted((r.text or "") for r in got.collect()) == sorted({t or "" for _, t, *_ in AWKWARD})


# -- SimHash -------------------------------------------------------------------
def plain_fingerprint(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(values, max_bits):
    """Brute force over all pairs of distinct values."""
    values = list(dict.fromkeys(values))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_fingerprint_bits():
    rnd = random.Random(2)
    for _, t, *_ in rows(80, 7) + AWKWARD[:5]:
        assert simhash.fingerprint(t or "", 4) == plain_fingerprint(t, 4)
    assert simhash.fingerprint("A B É x\x1cy", 4) == plain_fingerprint("a b É x\x1cy", 4)
    assert rnd


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=6), st.integers(1, 4))
def test_bound_and_grid(fp, flips, d):
    other = fp
    for b in flips:
        other ^= 1 << b
    a, b = np.array([fp], np.uint64), np.array([other], np.uint64)
    seg = sum(abs((fp >> i & 3).bit_count() - (other >> i & 3).bit_count()) for i in range(0, 64, 2))
    got = int(simhash.manhattan(simhash.embed(a), simhash.embed(b))[0])
    assert got == seg <= (fp ^ other).bit_count()
    if (fp ^ other).bit_count() <= d:
        assert (simhash.cells(a, d) == simhash.cells(b, d)).any()


def test_forest_spans_components():
    rnd = random.Random(3)
    base = [rnd.getrandbits(64) for _ in range(4)]
    fps = list({x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for x in base for _ in range(120)})
    links = [(int(u), int(v)) for a, b in simhash.forest(np.array(fps, np.uint64), 4) for u, v in zip(a, b)]
    assert all((u ^ v).bit_count() <= 4 for u, v in links) and len(links) < len(fps)
    want = components_of(fps, 4)
    assert len(links) == len(fps) - len(set(want.values()))


def brute_components(docs, k=4, d=4):
    fp = [plain_fingerprint(t, k) for _, t, *_ in docs]
    root = components_of(fp, d)
    least = {}
    for (i, *_), f in zip(docs, fp):
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return sorted((str(i), f, str(least.get(root[f]))) for (i, *_), f in zip(docs, fp))


@pytest.mark.parametrize("block", [simhash.BLOCK, 4])
def test_near_duplicates(spark, block, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", block)
    if block == 4:
        monkeypatch.setattr(simhash, "SAMPLE", 1)
        monkeypatch.setattr(simhash, "SHORT_RUN", 3)
    for docs, df in ((AWKWARD, awkward(spark)), (rows(250, 8), spark.createDataFrame(rows(250, 8), DOC_SCHEMA))):
        got = simhash.near_duplicates(df).collect()
        assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == brute_components(docs)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_chain_and_hub_components(spark):
    rnd = random.Random(4)
    ids = [rnd.getrandbits(62) for _ in range(400)]
    edges = list(zip(ids[:100], ids[1:101])) + [(ids[150], x) for x in ids[151:380]] + [(5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[x] for x in ids[:101]}) == 1 and len({got[x] for x in ids[150:380]}) == 1
    assert got[ids[0]] != got[ids[150]] and len(got) == 101 + 230


def test_keep_one(spark):
    docs = rows(200, 5)
    df = exact_dedup.deduplicate(spark.createDataFrame(docs, DOC_SCHEMA))
    left = [tuple(r) for r in df.collect()]
    got = simhash.keep_one(df)
    assert got.columns == df.columns
    want = {c for _, _, c in brute_components(left)}
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(want)


def test_merge_of_many_filters():
    """A range's filters of many tasks: the same counts as one count of all."""
    rnd = np.random.default_rng(9)
    every, filters = [], []
    for _ in range(37):
        v = rnd.integers(0, 400, rnd.integers(1, 60)).astype(np.uint64) << np.uint64(40)
        every.append(v)
        filters.append(exact_dedup.CountingQuotientFilter.build(*np.unique(v, return_counts=True), 4))
    got, want = exact_dedup.CountingQuotientFilter.merge(filters), np.unique(np.concatenate(every), return_counts=True)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert len(exact_dedup.CountingQuotientFilter.merge([])[0]) == 0


def test_keep_one_of_repeated_rows(spark):
    same = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"other{i * 7}" for i in range(40))
    docs = [(1, same, "en", "s", 0)] * 3 + [(1, same, "de", "t", 1), (5, same, "en", "s", 0)] * 2 \
        + [(2, other, "en", "s", 0), (None, None, "en", "s", 0), (None, None, "en", "s", 0)]
    got = simhash.keep_one(spark.createDataFrame(docs, DOC_SCHEMA).repartition(3)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 1), (False, 2), (True, 0)]
    again = simhash.keep_one(spark.createDataFrame(docs[::-1], DOC_SCHEMA)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_hot_repeated_rows_keep_one(spark, monkeypatch):
    """One row many times, with a null key too: one of them stays, none is lost."""
    monkeypatch.setattr(exact_dedup, "CHUNK_ROWS", 7)
    data = [(5, "same", "en", "s", 4)] * 50 + [(None, "nil", "en", "s", 3)] * 15 + [(9, "same", "en", "s", 4)] * 20 + [(1, "x", "en", "s", 1)]
    df = spark.createDataFrame(data, DOC_SCHEMA)
    got = exact_dedup.exact_groups(df).collect()
    assert len(got) == 86
    assert sorted((r.doc_id, r.group_size) for r in got if r.kept and r.doc_id) == [(1, 1), (9, 70)]
    assert sum(r.kept for r in got) == 3
    kept = exact_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "nil"), (1, "x"), (9, "same")]
