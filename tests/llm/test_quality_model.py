"""The quality classifier: held-out accuracy and calibration, word vectors by hand, labels that contradict."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.llm import quality_model, queries
from crestline.llm.common import read

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def held(spark):
    out = queries.op4_quality_classifier(spark, SF).join(read(spark, SF, "labels").select("doc_id", "quality"), "doc_id")
    return [(r["quality"], r["score"], r["predicted"], r["doc_id"]) for r in out.where("held_out").collect()]


def test_held_out_accuracy_and_calibration(held):
    y, score = np.array([h[0] for h in held]), np.array([h[1] for h in held])
    assert all((zlib.crc32(str(h[3]).encode()) % 4 == 2) and h[2] == (h[1] >= 0.7) for h in held)
    right = np.mean(y == (score >= 0.7))
    order = np.argsort(score)
    rank = np.empty(len(y))
    rank[order] = np.arange(len(y))
    auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() - 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    print(len(y), "held out: accuracy", right, "area", auc, "mean score", score.mean(), "share", y.mean())
    assert right > 0.93 and auc > 0.95 and abs(score.mean() - y.mean()) < 0.04


def test_vectors_by_hand(spark):
    texts = ["a b c a", "b c", None, "", "c a b b d"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    known = quality_model.vocabulary(docs)
    assert set(known) == set("abcd") and sorted(known.values()) == [512, 513, 514, 515]
    got = quality_model.corpus_vectors(docs, known)
    want = np.zeros((516, 32))
    for t in texts:
        w = (t or "").split()
        for i, here in enumerate(w):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(w):
                    places, signs = quality_model.index_entries(np.array([zlib.crc32(w[j].encode())]))
                    for p, s in zip(places[0], signs[0]):
                        want[known[here], p] += s
                        want[zlib.crc32(b"a") % 512, p] += s
    want = np.sign(want) * np.sqrt(np.abs(want))
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(got, want)


def test_vocabulary_has_the_most_frequent_words(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i}" for _ in range(2**i)),) for i in range(10)] + [("x" * 65,)] * 5000, "text string")
    assert set(quality_model.vocabulary(docs, 4)) == {"w9", "w8", "w7", "w6"}
    assert quality_model.vocabulary(docs, 0) == {} == quality_model.vocabulary(docs.limit(0))


def test_labels_that_contradict_and_repeat(spark):
    good, bad = "plain words in a row that say something", "$$$ ### 999 ||| *** %%%"
    docs = [(i, (good if i % 2 else bad) + f" {i}") for i in range(200)]
    marks = [(i, i % 2) for i in range(200)]
    table = spark.createDataFrame([(*d, 1, 0.5) for d in docs], "doc_id long, text string, quality int, score double")
    once = quality_model.scan(table, spark.createDataFrame(marks, "doc_id long, quality long")).collect()
    more = marks + marks + [(500, 0), (None, 1), (3, None), (4, 9)] + [(i, 1 - i % 2) for i in range(150, 160)]
    twice = quality_model.scan(table, spark.createDataFrame(more[::-1], "doc_id long, quality long")).collect()
    less = quality_model.scan(table, spark.createDataFrame([m for m in marks if not 150 <= m[0] < 160], "doc_id long, quality long")).collect()
    assert sorted(twice) == sorted(less) and all((r["score"] > 0.5) == r["doc_id"] % 2 for r in once)
    shown = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality long")
    assert {r["score"] for r in quality_model.scan(table, shown).collect()} == {1.0}
    assert {r["score"] for r in quality_model.scan(table, shown.where("doc_id < 0")).collect()} == {0.5}


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "w " * 300_000), (3, "other"), (3, "other"), (4, "x" * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality long")
    out = quality_model.scan(docs, labels).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    assert quality_model.scan(docs.where(F.lit(False)), labels).count() == 0
