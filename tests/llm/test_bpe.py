"""The transducer against the tokenizers library and against the merge list by itself."""

import hashlib
import random

import numpy as np
import pytest

from crestline.llm import bpe, queries
from crestline.llm.common import read

SF = "/root/testdata/sf0.01"
ODD = ["a", "b", "e", "th", " ", "  ", "\n", "\t", "\x00", "1", "23", "é", "中", "　", "'s", "'ll", "<|endoftext|>", "_", "=", "--", "The", "ing", "\U0001f600", "."]


@pytest.fixture(scope="module")
def tool():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(queries.tokenizer_path()))


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_documents_equal_the_library(spark, tool):
    docs = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    for r in queries.op5_bpe(spark, SF).collect():
        want = tool.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(tool.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_strings_equal_the_library(tool, encoder):
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(1, 60)))
        assert ids(encoder(text)) == tool.encode(text, add_special_tokens=False).ids, text


def test_a_huge_pre_token_takes_constant_state(tool):
    encoder = bpe.Encoder(bpe.Vocabulary(queries.tokenizer_path()))
    v, t = encoder.transducer.v, encoder.transducer
    bound = bpe.CHUNK + v.lookahead + t.longest
    rng = random.Random(3)
    for text in ("".join(rng.choice("abcdeinrsth") for _ in range(1_000_000)), "=" * 100_000, " " * 50_000 + "x", "ab" * 100_000):
        assert ids(encoder(text)) == tool.encode(text, add_special_tokens=False).ids
        assert t.held_most <= bound
    assert len(encoder.units) <= 10 and len(encoder.tokens) <= 10


def test_every_pre_token_goes_through_the_transducer(encoder, monkeypatch):
    seen = []
    fresh = bpe.Encoder(encoder.transducer.v)
    whole = fresh.transducer._read
    monkeypatch.setattr(fresh.transducer, "_read", lambda *a: seen.append(1) or whole(*a))
    fresh("some words, and 12 more")
    assert len(seen) == 6


def test_windows_do_not_change_the_ids(encoder, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ODD) for _ in range(400)) for _ in range(50)]
    want = [encoder(t) for t in texts]
    monkeypatch.setattr(bpe, "WINDOW", 7)
    monkeypatch.setattr(bpe, "CHUNK", 3)
    assert [bpe.Encoder(encoder.transducer.v)(t) for t in texts] == want


def plain(text, merges):
    """The encoding by merging, rank by rank from left to right, as token end positions."""
    tokens = list(text)
    for u, v in merges:
        out, i = [], 0
        while i < len(tokens):
            if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) == (u, v):
                out.append(u + v)
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        tokens = out
    ends, at = set(), 0
    for t in tokens:
        at += len(t)
        ends.add(at)
    return ends


def test_sufficient_lookahead_settles_boundaries():
    rng = random.Random(6)
    close = 0
    for _ in range(150):
        tokens, merges = list("abc"), []
        while len(merges) < 9:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) <= 12:
                merges.append((u, v))
                tokens.append(u + v)
        place = {t: i for i, t in enumerate(tokens)}
        enough = bpe.sufficient_lookahead([(place[u], place[v], place[u + v]) for u, v in merges], {i: len(t) for t, i in place.items()})
        for _ in range(30):
            text = "".join(rng.choice(tokens) for _ in range(14))
            whole = plain(text, merges)
            for n in range(1, len(text)):
                part = plain(text[:n], merges)
                assert {e for e in part if e <= n - enough} == {e for e in whole if e <= n - enough}, (merges, text, n)
                off = [e for e in part ^ whole if e < n]
                close = max(close, max((n - e for e in off), default=0) / enough)
    assert close > 0.3


def test_ids_decode_to_the_text(spark):
    texts = [None, "", "a b", "Ünï ☃ <|endoftext|>", "x" * 70_000, "a b"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    kept = bpe.encoded(docs, queries.tokenizer_path())
    assert {r["doc_id"]: r["text"] for r in bpe.decoded(kept, queries.tokenizer_path()).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["decoded_sha256"] for r in kept.collect()} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
    none = docs.where("doc_id < 0")
    assert bpe.encoded(none, queries.tokenizer_path()).count() == bpe.decoded(bpe.encoded(none, queries.tokenizer_path()), queries.tokenizer_path()).count() == 0
