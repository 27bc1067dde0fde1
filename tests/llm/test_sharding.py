"""Sharding against brute-force ranks and cuts, and what becomes of equal texts."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crestline.llm import sharding
from crestline.llm.common import read


def brute(docs, shards):
    """(doc_id, size, crc, shard, slot) of every row: rank within the source by the draw, sort by fractional rank, cut."""
    draw = F.xxhash64(F.lit(sharding.SEED), "doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    rows = []
    for r in docs.select("doc_id", "source", "text", draw.alias("h")).collect():
        raw = (r["text"] or "").encode()
        # Hash buckets are ranges of the unsigned hash, sorted by the signed one inside: both orders agree within a bucket.
        rows.append(("-" if r["source"] is None else "=" + r["source"], r["h"] % 2**64, r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32(raw), len(raw) + 1, r["doc_id"]))
    rows.sort()
    n, seen, order = Counter(r[0] for r in rows), Counter(), []
    for s, *_, crc, size, doc_id in rows:
        seen[s] += 1
        order.append(((2 * seen[s] - 1) / (2 * n[s]), s, doc_id, size, crc))
    order.sort(key=lambda x: x[:2])
    out, total = [], len(order)
    for g, (_, _, doc_id, size, crc) in enumerate(order):
        k = g * shards // total
        out.append((doc_id, size, crc, k, g - -(-k * total // shards)))
    return sorted(out, key=repr)


def got(docs, shards):
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shard(docs, shards).collect()), key=repr)


@pytest.mark.parametrize("shards", [8, 3])
def test_ranks_and_cuts(spark, shards):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    assert got(docs, shards) == brute(docs, shards)


def test_awkward_rows(spark):
    texts = [None, "", "a", "a", "é" * 70_000, "b c"]
    rows = [(None if i % 7 == 0 else i % 50, texts[i % 6], None if i % 4 == 0 else "s", i, "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _h int, shard string")
    out = got(docs, 8)
    per = Counter(r[3] for r in out)
    assert len(out) == 200 and max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r[4] for r in out if r[3] == k) == list(range(per[k])) for k in per)
    assert got(docs.where("doc_id < 0"), 8) == [] and [r[3:] for r in got(docs.limit(1), 8)] == [(0, 0)]


def test_equal_texts_spread_as_rows_do(spark):
    docs = spark.createDataFrame([(i, "one text" if i % 3 == 0 else f"t{i}", f"s{i % 2}") for i in range(2400)], "doc_id long, text string, source string")
    copies = Counter(k for i, _, _, k, _ in got(docs, 8) if i % 3 == 0)
    assert set(copies) == set(range(8)) and max(copies.values()) < 140 and min(copies.values()) > 65


def test_more_buckets_change_nothing(spark, monkeypatch):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    want = got(docs, 8)
    monkeypatch.setattr(sharding, "_HASH_BITS", 3)
    monkeypatch.setattr(sharding, "_RANK_BUCKETS", 5)
    monkeypatch.setattr(sharding, "_BUCKET_ROWS", 20)
    assert got(docs, 8) == want
