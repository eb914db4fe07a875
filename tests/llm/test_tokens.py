"""Operators 1 and 4 against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, token_counts

from .helpers import AWKWARD, awkward, empty

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def strange_texts(n, seed=3):
    rnd = random.Random(seed)
    bits = ["a", "B", "é", " ", "  ", "\n", "\n\n", "\t", "\xa0", "'s", "'ll", "1", "²", "!", "...", "<|endoftext|>", "日本",
            "🎉", "\x1c", "\x85", "x" * 150, " " * 120, "\r\n", "the ", "ing", " don't", "<|endo"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_encoder_equals_library(library):
    b = bpe.load(PATH, PATTERN)
    texts = strange_texts(1500)
    for t, ids, n in zip(texts, b.encode_many(texts), b.count_many(texts)):
        ref = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == ref, t
        assert n == len(ref)
        assert b.decode(ids) == library.decode(ref, skip_special_tokens=False)


def test_long_words_merge_alike():
    b = bpe.load(PATH, PATTERN)
    rnd = random.Random(5)
    for _ in range(60):
        w = "".join(rnd.choice("abetn e!=") for _ in range(rnd.randint(2, bpe.SHORT))).encode()
        assert b.merge_long(w).tolist() == b.merge_short([w])[0].tolist()


def test_words_merged_end_to_end_are_those_merged_alone():
    b = bpe.load(PATH, PATTERN)
    rnd = random.Random(7)
    words = list({"".join(rnd.choice("abetn e!=") for _ in range(rnd.randint(1, 2 * bpe.SHORT))).encode() for _ in range(80)})
    ids, starts, size = b.encode_flat(words)
    assert [ids[i:i + n].tolist() for i, n in zip(starts, size)] == [b.merge_long(w).tolist() for w in words]
    assert int(size.sum()) == len(ids)
    assert [len(x) for x in b.encode_flat([])] == [0, 0, 0]


def test_broken_ids_decode_as_library(library):
    b = bpe.load(PATH, PATTERN)
    rnd = random.Random(6)
    for _ in range(200):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        assert b.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


def test_piece_table_restarts(library, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    b = bpe.ByteBpe(PATH, PATTERN)
    texts = strange_texts(60, 9)
    for t, ids in zip(texts, b.encode_many(texts)):
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids


def test_encode_and_decode_rows(spark, library):
    got = bpe.encode(awkward(spark), PATH, PATTERN, with_decoded=True).collect()
    assert len(got) == len(AWKWARD)
    ref = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in AWKWARD)
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == ref
    again = bpe.decode(bpe.encode(awkward(spark), PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in got) == sorted(t or "" for _, t, *_ in AWKWARD)
    assert bpe.encode(empty(spark), PATH, PATTERN).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(40, 4), (64, 16), (7, 3)])
def test_counts_by_splicing(spark, library, chunk, overlap):
    texts = [*strange_texts(150, chunk), "x" * 700, " " * 300 + "a", "ab " * 200, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, PATH, PATTERN, limit=30, chunk_chars=chunk, overlap=overlap).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit, got[i].n_bytes) == (n, n > 30, len((t or "").encode())), repr(t)


def test_counts_of_awkward_rows(spark, library):
    got = token_counts.count_tokens(awkward(spark), PATH, PATTERN, chunk_chars=1000, overlap=8).collect()
    ref = sorted((str(i), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in AWKWARD)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == ref
    assert token_counts.count_tokens(empty(spark), PATH, PATTERN).count() == 0


def test_query_digests(spark, library):
    from tessera.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in docs.items()}
    for r in QUERIES["op1_bpe_encode_decode"](spark, d).collect():
        assert r.ids_sha256 == hashlib.sha256(np.array(ids[r.doc_id], "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    for r in QUERIES["op4_token_counts"](spark, d).collect():
        assert (r.n_tokens, r.n_bytes) == (len(ids[r.doc_id]), len(docs[r.doc_id].encode()))
