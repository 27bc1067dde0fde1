"""Fingerprints against sketches made by hand, row by row, and the order of neighbours under awkward ids."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from crestline.llm import fingerprints as fp
from crestline.llm.common import read

SF = "/root/testdata/sf0.01"


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def chain(hashes):
    s = 42
    for h in hashes:
        s = xxhash.xxh64_intdigest((h % 2**64).to_bytes(8, "little"), seed=s)
    return s


def shingles(text):
    h = [xxhash.xxh64_intdigest(w, seed=42) for w in text.encode().split()]
    return {chain(h[i : i + 5]) >> 16 for i in range(max(1, len(h) - 4))} if h else set()


def sketch(hashes):
    low = sorted(h for h in hashes if h < fp.THRESHOLD)
    return low if len(low) >= fp.LEAST else sorted(hashes)[: fp.LEAST]


def likeness(a, b):
    top = min(2**48 - 1 if len(x) < fp.LEAST else max(fp.THRESHOLD - 1, x[-1]) for x in (a, b))
    x, y = ({h for h in s if h <= top} for s in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def check(rows, out):
    """`rows` (doc_id, text) against the output rows, each by itself."""
    key = lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42)))
    rows = sorted(((i, t or "") for i, t in rows), key=key)
    want = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + after[:half]
        f, g, ef = sketch(shingles(t)), sketch(shingles(after)), sketch(shingles(e))
        text = lambda s: "".join(f"{h:012X}" for h in s)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), text(f), text(ef), round(likeness(f, ef), 12), round(likeness(f, g), 12)))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_every_row_of_the_documents(spark):
    docs = read(spark, SF, "documents")
    check([(r["doc_id"], r["text"]) for r in docs.collect()], fp.scan(docs))


@pytest.mark.parametrize("size", [4000, 7, 1])
def test_awkward_ids_in_any_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE_ROWS", size)
    rng = random.Random(size)
    words = [f"w{i}" for i in range(50)]
    rows = [(rng.choice([None, None, 5, 5, 2**63 - 1, -(2**63), rng.randrange(60)]), rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 200)))])) for _ in range(150)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, p int, t string")
    check(rows, fp.scan(table))
    assert fp.scan(table.limit(0)).count() == 0
    check(rows[:1], fp.scan(spark.createDataFrame(rows[:1], "doc_id long, text string")))


def test_hot_ids_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_ROWS", 50)
    table = spark.createDataFrame([(7 if i % 3 else (None if i % 2 else i), f"text number {i}") for i in range(3000)], "doc_id long, t string")
    led = fp.with_next(table, ["doc_id", "t"], F.xxhash64("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [len(p) for p in led.rdd.glom().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = led.collect()
    order = {(r["doc_id"], r["t"]): (r["_next"]["doc_id"], r["_next"]["t"]) for r in rows}
    at = (rows[0]["doc_id"], rows[0]["t"])
    for seen in range(1, 3001):
        at = order[at]
        if at == (rows[0]["doc_id"], rows[0]["t"]):
            break
    assert seen == 3000 == len(rows), "one ring through all rows"
    assert max(sizes) < 1000, sizes


def as_sketch(spark, sets):
    """Sketches of sets of hashes by the operator's own columns."""
    return spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "i long, g array<bigint>")


def test_merge_is_the_sketch_of_both_and_containment_is_close(spark):
    rng = random.Random(8)
    draw = lambda n: {rng.randrange(2**48) for _ in range(n)}
    whole = draw(40_000)
    listed = sorted(whole)
    pairs = [(set(rng.sample(listed, n)) | draw(m), whole if big else draw(n)) for n, m, big in [(5, 0, 1), (5, 5, 1), (40, 10, 1), (100, 100, 1), (3000, 1000, 1), (500, 0, 0), (0, 3, 0), (0, 0, 0), (0, 0, 1)]]
    rows = [(i, sketch(a), sketch(b)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, a array<bigint>, b array<bigint>")
    out = df.select("i", fp.merge(F.col("a"), F.col("b")).alias("m"), fp.containment(F.col("a"), F.col("b")).alias("c"), fp.likeness(F.col("a"), F.col("b")).alias("l")).collect()
    for r in out:
        a, b = pairs[r["i"]]
        assert r["m"] == sketch(a | b), r["i"]
        assert abs(r["l"] - likeness(sketch(a), sketch(b))) < 1e-12
        if len(a) >= 200:
            assert abs(r["c"] - len(a & b) / len(a)) < 4 * 0.5 / np.sqrt(len(a) / fp.SCALE)
    # A short text in a long one: judged on those of its hashes that the long one's bound covers.
    assert abs(next(r["c"] for r in out if r["i"] == 4) - 0.75) < 0.06


def test_error_of_likeness(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in read(spark, "/root/testdata/sf0.01", "documents").collect())
    off, floor = [], 0
    got = {r["doc_id"]: r["near_edited"] for r in fp.scan(read(spark, "/root/testdata/sf0.01", "documents")).collect()}
    for n, (i, t) in enumerate(docs):
        after, half = docs[(n + 1) % len(docs)][1], len(t) // 2
        a, b = shingles(t), shingles(t[: len(t) - half] + after[:half])
        off.append(abs(got[i] - (len(a & b) / len(a | b) if a | b else 1.0)))
        floor += len([h for h in a if h < fp.THRESHOLD]) < fp.LEAST
    print("mean error", np.mean(off), "one in ten over", np.quantile(off, 0.9), "one in a hundred over", np.quantile(off, 0.99), "share by the least hashes", floor / len(docs))
    assert np.mean(off) < 0.04 and np.quantile(off, 0.99) < 0.16
