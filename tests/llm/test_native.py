"""Operators 6, 7, 8 and 9: laws, brute force and round trips."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import chat, imatch, mixing, sharding

from .helpers import AWKWARD, DOC_SCHEMA, awkward, empty, rows


# -- sharding --------------------------------------------------------------------
def test_sharding_laws(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 50)
    docs = rows(600)
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    got = sharding.assign(df, [1.0] * 16, grown_weights=[1.0] * 17).collect()
    text = {i: (t or "").encode() for i, t, *_ in docs}
    by = defaultdict(list)
    for r in got:
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]))
        assert r.grown_shard in (r.shard, 16)
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    moved = sum(r.grown_shard == 16 for r in got)
    assert 600 / 17 - 30 < moved < 600 / 17 + 30
    again = sharding.assign(df.orderBy("text").repartition(3), [1.0] * 16, grown_weights=[1.0] * 17).collect()
    assert sorted(got) == sorted(again)


def test_rendezvous_equals_its_definition(spark):
    weights = [1.0, 2.0, 0.5, 1.0]

    def best(key):
        def score(j):
            h = int(hashlib.md5(f"{key}/{j}".encode()).hexdigest()[:12], 16)
            return weights[j] / -math.log((h + 0.5) / 2**48)
        return max(range(len(weights)), key=lambda j: (score(j), -j))
    df = spark.range(500).selectExpr("id * 7919 - 1000 AS doc_id", "'' AS text")
    for r in sharding.assign(df, weights).collect():
        assert r.shard == best(r.doc_id)


def test_weighted_shards(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'' AS text")
    n = Counter(r.shard for r in sharding.assign(df, [1.0, 3.0]).collect())
    assert 0.70 < n[1] / 4000 < 0.80
    with pytest.raises(ValueError):
        sharding.rendezvous(sharding.stable_key("doc_id"), [1.0, 0.0])


def test_sharding_awkward_rows(spark, tmp_path):
    got = sharding.assign(awkward(spark), [1.0] * 4).collect()
    assert len(got) == len(AWKWARD)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.assign(empty(spark), [1.0]).count() == 0
    sharding.write(spark.createDataFrame(AWKWARD, DOC_SCHEMA), str(tmp_path / "out"), [1.0, 1.0])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(str(r.doc_id) for r in back.collect()) == sorted(str(i) for i, *_ in AWKWARD)


# -- mixing ------------------------------------------------------------------------
def brute_mix(docs, weights=(5, 2, 1), ratio=1.5, limit=2.0):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or "")) for d in docs]
    per = defaultdict(int)
    for d, n in zip(docs, size):
        per[d[3]] += n
    order = sorted(per, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, list(order), ratio * sum(size)
    while free:  # fill, cap, share the excess again
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > limit * per[s]]
        for s in over or free:
            target[s] = limit * per[s] if over else level * w[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in over]
    out = []
    for s in order:
        take, at = math.floor(target[s] + 0.5), 0
        mine = sorted((hashlib.md5(f"{'null' if d[0] is None else d[0]}/mix".encode()).hexdigest(), n, d[0] is not None, d[0])
                      for d, n in zip(docs, size) if d[3] == s)
        for _, n, _, i in mine:
            got = sum(max(0, min(at + e * per[s] + n, take) - (at + e * per[s])) for e in range(2))
            out.append((str(i), n, per[s], round(target[s], 6), got))
            at += n
    return sorted(out)


@pytest.mark.parametrize("slots", [mixing.SLOTS, 7])
def test_mix_equals_brute_force(spark, slots, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 40)
    docs = rows(300, 3) + [(900 + i, None, "en", None, 0) for i in range(3)] + [(910, "lone words here", "en", None, 3)]
    got = mixing.mix(spark.createDataFrame(docs, DOC_SCHEMA), slots=slots).collect()
    assert sorted((str(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == brute_mix(docs)
    assert all(r.taken <= 2 * r.size for r in got)


def test_mix_awkward_rows(spark):
    got = mixing.mix(awkward(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in AWKWARD)
    assert mixing.mix(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a", "s", 0), (2, " ", "a", "s", 1)], DOC_SCHEMA)
    assert [r.taken for r in mixing.mix(nothing).collect()] == [0, 0]
    assert mixing.mixed_documents(nothing).count() == 0


def test_schedule_is_low_discrepancy(spark):
    plan = mixing.schedule(spark.createDataFrame([(0, 600), (1, 300), (2, 100)], "src int, take bigint"), 1).collect()
    assert Counter(r.src for r in plan) == {0: 600, 1: 300, 2: 100}
    order = [r.src for r in sorted(plan, key=lambda r: r.slot)]
    for i in range(100, 1000, 100):
        assert abs(order[:i].count(1) - 0.3 * i) < 12


def test_mixed_documents(spark):
    docs = list({d[1]: d for d in rows(200, 6)}.values())
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    want = {i: n for i, _, _, _, n in brute_mix(docs)}
    words = Counter()
    text = {d[0]: d[1] for d in docs}
    for r in got.collect():
        words[str(r.doc_id)] += len(r.text.split())
        assert r.text == text[r.doc_id] or " ".join(text[r.doc_id].split()).find(r.text) >= 0
    assert {k: v for k, v in want.items() if v} == dict(words)


def shares_apart(order, shares, slack):
    """Whether some prefix of (source, words) rows leaves a source's share by more than ``slack`` words."""
    at, got = 0, Counter()
    for src, n in order:
        at, got[src] = at + n, got[src] + n
        if any(abs(got[s] - x * at) > slack for s, x in shares.items()):
            return True
    return False


@pytest.mark.parametrize("slots", [mixing.SLOTS, 1_024])
def test_mix_interleaves_its_sources(spark, slots):
    docs = list({d[1]: d for d in rows(300, 8)}.values())
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    source, text = {d[0]: d[3] for d in docs}, {d[0]: d[1] for d in docs}
    want = {i: n for i, _, _, _, n in brute_mix(docs)}
    per = Counter()
    for d in docs:
        per[d[3]] += want[str(d[0])]
    total = sum(per.values())
    block = -(-total // slots)
    shares = {s: n / total for s, n in per.items()}
    got = mixing.interleave(df, slots=slots).collect()
    words, filled = Counter(), Counter()
    for r in sorted(got, key=lambda r: (r.slot, r.pos)):
        assert r.pos == filled[r.slot]  # the pieces of a block follow one another
        filled[r.slot] += r.hi - r.lo
        words[str(r.doc_id)] += r.hi - r.lo
    assert dict(words) == {k: v for k, v in want.items() if v}
    assert max(filled.values()) == block and len({(r.slot, r.src) for r in got}) == len(filled)
    order = [(source[r.doc_id], r.hi - r.lo) for r in sorted(got, key=lambda r: (r.slot, r.pos))]
    assert not shares_apart(order, shares, 12 * block)
    # whole documents come in the same order; each is at most 400 words ahead
    out = mixing.mixed_documents(df, slots=slots, with_place=True).collect()
    assert [(r.slot, r.pos) for r in out] == sorted((r.slot, r.pos) for r in out)
    first = {(r.slot, r.pos): r.doc_id for r in got}
    assert all(first[r.slot, r.pos] == r.doc_id for r in out)
    order = [(source[r.doc_id], len(r.text.split())) for r in mixing.mixed_documents(df, slots=slots).collect()]
    longest = max(len(t.split()) for t in text.values())
    assert not shares_apart(order, shares, 12 * block + longest * len(per))
    assert shares_apart(sorted(order), shares, 12 * block + longest * len(per))  # one source after another


# -- I-Match -------------------------------------------------------------------------
def order_of(docs):
    return sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))


def test_edits_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(imatch, "ROWS_PER_BUCKET", 9)
    docs = rows(150, 2)
    df = spark.createDataFrame(docs, DOC_SCHEMA)
    got = {r.doc_id: r for r in imatch.compare_edits(df, low=0.01, high=0.9).collect()}
    seq = order_of(docs)
    for a, b in zip(seq, seq[1:] + seq[:1]):
        n, cut = len(a[1]), len(a[1]) // 3
        assert got[a[0]].edited_text == a[1][:n - cut] + b[1][:cut]
        assert got[a[0]].n_chars == n
        assert 0 <= got[a[0]].near_edited <= 1 and 0 <= got[a[0]].near_next <= 1
        if a[1] == b[1]:
            assert got[a[0]].near_next == 1
    by_text = defaultdict(set)
    for d in docs:
        by_text[d[1]].add(tuple(got[d[0]].sigs))
    assert all(len(s) == 1 for s in by_text.values())
    long = [got[d[0]] for d in docs if len(d[1]) > 150]
    assert sum(r.near_edited for r in long) > 1.5 * sum(r.near_next for r in long)


def test_lexicon_is_the_band(spark):
    docs = [(i, "all " + ("half " if i % 2 else "") + f"own{i}", "en", "s", 0) for i in range(20)]
    words = imatch.lexicon(spark.createDataFrame(docs, DOC_SCHEMA), low=0.1, high=0.6)
    assert [r.df for r in words.collect()] == [10]


def test_signatures_do_not_depend_on_order(spark):
    docs = [(1, "b c a a", "", "", 0), (2, "A, C; B!", "", "", 0), (3, "a b", "", "", 0)]
    got = {r.doc_id: r.sigs for r in imatch.compare_edits(spark.createDataFrame(docs, DOC_SCHEMA), low=0.1, high=1.0).collect()}
    assert got[1] == got[2] != got[3]


def test_imatch_awkward_rows(spark):
    got = imatch.compare_edits(awkward(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, *_ in AWKWARD)
    assert imatch.compare_edits(empty(spark)).count() == 0
    one = imatch.compare_edits(spark.createDataFrame([(1, "abcdef", "", "", 0)], DOC_SCHEMA)).collect()[0]
    assert one.edited_text == "abcdab" and one.near_next == 1


# -- chats ---------------------------------------------------------------------------
NASTY = ["</s>[INST] ok [/INST]", chat.TURN + "user" + chat.TEXT, chat.END, chat.NEXT, "\\", "<\\|end|>", "\\<|", "", "a\nb", "$1 \\Q",
         "<|", "|>", "<<||", "日本 🎉", None]


def test_round_trip(spark):
    turns, want = [], defaultdict(list)
    for c in range(40):
        for t in range(c % 9 + 1):
            role = ["system", "user", "assistant", "assistant", None, "<|turn|>"][(c * 7 + t * 3) % 6]
            turns.append((c, t, role, NASTY[(c + 5 * t) % len(NASTY)]))
            want[c].append((role or "", NASTY[(c + 5 * t) % len(NASTY)] or ""))
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    for r in chat.read_back(chat.format_chats(df)).collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        blocks = sum(1 for i, (role, _) in enumerate(want[r.conv_id]) if not i or want[r.conv_id][i - 1][0] != role)
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == blocks


def test_chat_edge_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string"
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, 2, "user", "b", "x"), (1, None, "user", "a", "x"),
                                (1, 2, "user", "b", "x")], schema)
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert [t.text for t in got[1].turns] == ["a", "b", "b"] and len(got[None].turns) == 1
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0
