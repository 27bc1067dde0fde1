"""The training-data operators against SQL, brute force and awkward rows."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from oracle import differences

from crestline.llm import bpe, chat, fingerprints, langid, licenses, mixing, near_dedup, quality_model, quality_rules, queries, sharding
from crestline.llm.common import read

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard string, _w string"


def rows(texts, ids=None):
    return [(i if ids is None else ids[i], t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", len(t or ""), 7, "x", "y") for i, t in enumerate(texts)]


LONG = " ".join(f"word{i % 700}" for i in range(60_000))
ODD = [None, "", " \n\t", "one", "two words", "a b a b a b a b a b a b", LONG, LONG, "Ünï çødé – ☃ <|endoftext|> x", "THE QUICK " * 40, "a b c"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(ODD, [0, 1, 2, 3, 4, 5, 6, 7, 8, None, 1]), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(9)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality long, toxic long")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert not differences(queries.queries()[name](spark, SF), queries.oracle_sql()[name], SF)


def test_odd_and_empty_tables(spark, odd, empty, labels):
    runs = {
        "fingerprints": lambda d: fingerprints.scan(d),
        "licenses": lambda d: licenses.scan(d.withColumnRenamed("source", "path"), ["doc_id"]),
        "langid": lambda d: langid.scan(langid.from_documents(d, ["doc_id"])),
        "langid keep": lambda d: langid.keep(d),
        "model": lambda d: quality_model.scan(d, labels),
        "bpe": lambda d: bpe.digest(d, queries.tokenizer_path()),
        "rules": lambda d: quality_rules.scan(d, labels),
        "rules keep": lambda d: quality_rules.keep(d, labels),
        "near": lambda d: near_dedup.linked(d, 2),
        "dedup": lambda d: near_dedup.dedup(d),
        "mixing": lambda d: mixing.digest(d),
        "mix": lambda d: mixing.mix(d),
        "sharding": lambda d: sharding.shard(d),
        "bpe encoded": lambda d: bpe.encoded(d, queries.tokenizer_path()),
        "bpe decoded": lambda d: bpe.decoded(bpe.encoded(d, queries.tokenizer_path()), queries.tokenizer_path()),
        "pages": lambda d: langid.scan(langid.from_pages(d.selectExpr("doc_id", "source as url", "text as html"), ["doc_id"])),
    }
    for name, run in runs.items():
        n = run(odd).count()
        assert n == len(ODD) or name in ("langid keep", "rules keep", "dedup", "mix"), (name, n)
        assert run(empty).count() == 0, name


def test_mixing_meets_targets(spark):
    docs = {r["doc_id"]: r for r in read(spark, SF, "documents").collect()}
    out = queries.op8_mixing(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    size, taken, goal = Counter(), Counter(), {}
    for r in out:
        s = docs[r["doc_id"]]["source"]
        assert r["size"] == len(docs[r["doc_id"]]["text"].encode().split()) and r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        size[s] += r["size"]
        taken[s] += r["taken"]
        goal[s] = r["target"]
    assert abs(sum(goal.values()) - sum(size.values())) < 1e-6 * sum(size.values())
    for s in goal:
        assert goal[s] <= 3 * size[s] + 1e-6 and abs(taken[s] - goal[s]) <= 0.05 * goal[s], s
    again = queries.op8_mixing(spark, SF).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, again), key=repr)


def test_mixing_passes_long_documents_by(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(7)
    sizes = {"a": [3000] * 100, "b": [100_000, *rng.integers(50, 551, 1000).tolist()]}
    docs = spark.createDataFrame([(2000 * i + j, "w " * n, s) for i, s in enumerate(sizes) for j, n in enumerate(sizes[s])], "doc_id long, text string, source string")
    # A seed that puts the long document among the first of its source; about 60,000 words of it are owed.
    places = [F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 52) for seed in range(200)]
    seed = int(np.argmin(docs.where("doc_id = 2000").select(*places).first()))
    rows = mixing.planned(docs, ["source"], seed=seed, weights=(240, 460)).select("source", "_mix.*").collect()
    for s, most in (("a", 3000), ("b", 550)):
        own = [r for r in rows if r["source"] == s]
        assert len(own) == len(sizes[s]) and all(r["copies"] == len(r["shards"]) for r in own)
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= most, (seed, s)


def test_split_is_exact():
    q = np.array([17, 0, 5, 1000])
    parts = mixing.split(q, 7, np.random.default_rng(3))
    assert parts.shape == (7, 4) and (parts.sum(axis=0) == q).all() and (parts >= 0).all()
    assert parts.sum(axis=1).max() - parts.sum(axis=1).min() <= 3


def test_near_estimate_and_prefix_join(spark):
    rng = np.random.default_rng(5)
    x = near_dedup.mix(rng.integers(0, 2**62, 1000).astype(np.uint64))
    for share in (0.5, 0.8, 1.0):
        k = int(2000 * share / (1 + share))
        a, b = np.unique(x[:1000]), np.unique(np.concatenate([x[:k], near_dedup.mix(x[k:] + np.uint64(1))]))
        assert abs(near_dedup.estimate(near_dedup.sketch(a), near_dedup.sketch(b)) - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(base[: 60 - i] + [f"u{i}x{j}" for j in range(i)]) for i in range(12)}
    sets = near_dedup._with_sets(spark.createDataFrame(list(texts.items()), "node long, text string"), 2)
    got = {(r["a"], r["b"]) for r in near_dedup._by_prefix(spark.createDataFrame([(i, i) for i in texts], "node long, c long"), sets, 80).collect()}
    s = {i: set(zip(t.split(), t.split()[1:])) for i, t in texts.items()}
    want = {(a, b) for a in s for b in s if a < b and 100 * len(s[a] & s[b]) >= 80 * len(s[a] | s[b])}
    assert want and want <= got


def test_rules_certify_with_many_labels(spark):
    docs = [(i, ("good plain words here and there " * 2) if i % 2 else ("bad### word$$$ " * 5 + " ".join(f"z{i}k{j}" for j in range(60))), "en", "s", 0, 0, "", "") for i in range(6000)]
    table = quality_rules.scan(spark.createDataFrame([(a, t + " ".join(f"q{a}n{j}" for j in range(60)), *r) for a, t, *r in docs], SCHEMA), spark.createDataFrame([(i, i % 2) for i in range(6000)], "doc_id long, quality long"))
    out = {r["doc_id"]: r for r in table.collect()}
    assert all(not r["kept"] for k, r in out.items() if k % 2 == 0 and not r["base_failed"])
    assert all(r["kept"] for k, r in out.items() if k % 2 and not r["base_failed"]) and any(r["kept"] for r in out.values())


def test_licences_inherit(spark):
    text = "some code here"
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", text), ("a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."), ("a/c/d/y.py", text), ("z.py", text),
             ("q/h.py", "# This work is licensed under the GNU General Public License, version 3.\n" + text), (None, text), ("e/f.py", None)]
    out = {r["path"]: (r["licence"], r["via"], r["inherited_from"]) for r in licenses.scan(spark.createDataFrame(files, "path string, text string"), []).collect()}
    assert out["a/LICENSE"] == ("MIT", "file", None) and out["a/b/x.py"] == ("Apache-2.0", "inherited", "a/b")
    assert out["a/c/d/y.py"] == ("MIT", "inherited", "a") and out["q/h.py"][:2] == ("GPL-3.0", "header")
    assert out["z.py"][1] == out[None][1] == out["e/f.py"][1] == "none"


def test_rules_of_every_language(spark):
    plain = lambda i: " ".join(f"q{i}n{j}" for j in range(60))
    docs = [(100 * k + i, ("### $$$ %%% &&& ||| <<< *** ### $$$ " * (i >= 20)) + plain(i), f"l{k:02d}", None, 0, 0, "", "") for k in range(70) for i in range(22)]
    table, marks = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(d[0], int(d[0] % 100 < 20)) for d in docs], "doc_id long, quality long")
    rules = quality_rules.certified(quality_rules.measured(table), marks, risk=0.5).collect()
    assert {r["stratum"] for r in rules} == {f"l{k:02d}" for k in range(70)}
    out = quality_rules.scan(table.union(spark.createDataFrame([(9999, plain(1), None, None, 0, 0, "", "")], SCHEMA)), marks, risk=0.5).collect()
    assert len(out) == 70 * 22 + 1 and all(r["kept"] == (r["doc_id"] == 9999 or r["doc_id"] % 100 < 20) for r in out)


def test_every_licence_line_of_the_tables(spark):
    said = {
        "All rights reserved.": "All-Rights-Reserved", "Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    docs = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    out = {r["doc_id"]: r for r in queries.op2_license_scan(spark, SF).collect()}
    want = {k: {said[x] for x in (t or "").split("\n") if x in said} for k, t in docs.items()}
    assert set().union(*want.values()) == set(said.values())
    for k, names in want.items():
        assert out[k]["licence"] in names if names else out[k]["via"] not in ("file", "header"), (k, names, out[k])


def test_reserved_rights_block_inheritance(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/x.py", "# All rights reserved.\ncode"), ("a/y.py", "# Copyright 2020 Some Firm. All rights reserved.\ncode"), ("a/w.py", "code"),
             ("b/z.py", "# Copyright 2020 Some Firm. All rights reserved.\n# Licensed under the Apache License, Version 2.0.\ncode"), ("b/v.py", "he wrote that some people think of all rights reserved by many other long words in prose here")]
    files += [(f"c/{i}", "prose without any notice") for i in range(200)]
    out = {r["path"]: (r["licence"], r["via"]) for r in licenses.scan(spark.createDataFrame(files, "path string, text string"), []).collect()}
    assert out["a/x.py"] == out["a/y.py"] == ("All-Rights-Reserved", "header") and out["a/w.py"] == ("MIT", "inherited")
    assert out["b/z.py"] == ("Apache-2.0", "header") and out["b/v.py"][1] == "none"


def test_pipeline(spark):
    import corpus_pipeline

    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
    kept = corpus_pipeline.encode(spark, docs, SMALL)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in bpe.decoded(kept, queries.tokenizer_path()).collect()} == set(texts.items())
