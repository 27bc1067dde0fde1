"""The splitting tree in the result of the mix: quotas, disjoint blocks, and what a replaced draw would change."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.llm import mixing
from crestline.llm.common import read

SF = "/root/testdata/sf0.01"


def blocks(docs, seed=mixing.SEED):
    """The block of each doc_id."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 52)
    return {r["doc_id"]: (r["source"], r["b"]) for r in docs.select("doc_id", "source", h.alias("b")).collect()}


def test_blocks_fill_the_quotas_of_the_tree(spark):
    docs = spark.createDataFrame([(i, f"w{i} x y", f"s{i % 3}") for i in range(900)], "doc_id long, text string, source string")
    # Equal sizes and weights: every target is its source's size, one whole pass over its blocks and nothing else.
    out = {r["doc_id"]: r["_mix"] for r in mixing.planned(docs, ["doc_id"], weights=(1,)).collect()}
    where = blocks(docs)
    shard_of, quota = {}, defaultdict(set)
    for k, m in out.items():
        assert m["copies"] == 1 and len(m["shards"]) == 1
        assert shard_of.setdefault(where[k], m["shards"][0]) == m["shards"][0], "a block goes to one shard"
        quota[where[k][0]].add(where[k])
    quotas = np.array([len(quota[s]) for s in ("s0", "s1", "s2")])
    want = mixing.split(quotas, mixing.SHARDS, np.random.default_rng(mixing.SEED))
    got = Counter((n, s) for (s, _), n in shard_of.items())
    assert all(got[n, s] == want[n, i] for n in range(mixing.SHARDS) for i, s in enumerate(("s0", "s1", "s2")))
    # Shards take the next blocks of each source in order, so their blocks are disjoint runs.
    for s in quota:
        runs = [shard_of[b] for b in sorted(quota[s])]
        assert runs == sorted(runs)


def test_the_draw_decides_the_result(spark, monkeypatch):
    docs = read(spark, SF, "documents")
    real = sorted((r["doc_id"], r["taken"], tuple(r["shards"])) for r in mixing.digest(docs).collect())
    assert all((t == 0) == (not s) for _, t, s in real) or any(s for _, _, s in real)
    assert len({n for _, _, s in real for n in s}) == mixing.SHARDS

    def first(quotas, shards, rng):
        return np.vstack([quotas, *[np.zeros_like(quotas)] * (shards - 1)])

    monkeypatch.setattr(mixing, "split", first)
    other = sorted((r["doc_id"], r["taken"], tuple(r["shards"])) for r in mixing.digest(docs).collect())
    assert other != real and [x[:2] for x in other] == [x[:2] for x in real]
    assert {n for _, _, s in other for n in s} == {0}


def test_every_copy_has_a_shard_and_blocks_stay_whole(spark):
    docs = read(spark, SF, "documents")
    where = blocks(docs)
    out = mixing.digest(docs).collect()
    passes = defaultdict(lambda: defaultdict(set))
    for r in out:
        assert r["taken"] == r["size"] * len(r["shards"]) or r["size"] == 0
        for p, n in enumerate(r["shards"]):
            passes[where[r["doc_id"]]][p].add(n)
    # But for the few documents that fill a gap, all rows of a block are in the same shard on each pass.
    split = [k for k, v in passes.items() for p in v if len(v[p]) > 1]
    assert len(split) <= 40


def test_mix_has_the_copies_and_groups_by_size(spark, monkeypatch):
    rows = [(i, " ".join(["w"] * (1 + i % 40)), None if i % 5 == 0 else f"s{i % 4}", i % 3) for i in range(600)] + [(None, None, None, 1), (7, "", "s1", 2), (7, "", "s1", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _shard int")
    want = Counter()
    for r in mixing.planned(docs, docs.columns).collect():
        want[tuple(r)[:4]] += r["_mix"]["copies"]
    assert Counter(map(tuple, mixing.mix(docs).collect())) == +want
    monkeypatch.setattr(mixing, "GROUP_WORDS", 100)
    assert Counter(map(tuple, mixing.mix(docs).collect())) == +want
    assert mixing.mix(docs.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_by_hand(seed):
    rng = np.random.default_rng(seed)
    sizes = [int(x) for x in rng.integers(1, 1000, 9)]
    got, left, open_ = mixing.targets(sizes), float(sum(sizes)), set(range(9))
    assert abs(sum(got) - left) < 1e-6
    assert all(g <= 3 * n + 1e-9 for g, n in zip(got, sizes))
    weight = [(5, 2, 1)[i % 3] for i in range(9)]
    free = [i for i in open_ if got[i] < 3 * sizes[i] - 1e-9]
    assert len({round(got[i] / weight[i], 6) for i in free}) <= 1
