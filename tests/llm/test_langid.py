"""Language ID where the declaration is not there to help, and its parts by hand."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.llm import common, langid
from crestline.llm.common import read

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def evidence(spark):
    return langid.from_documents(read(spark, SF, "documents"), ["doc_id", "lang"])


def test_held_back_declarations_are_found(spark, evidence):
    # A quarter of the declarations is withheld, a tenth is wrong; the model is fitted on what is left.
    draw = F.pmod(F.xxhash64("_row.doc_id"), F.lit(20))
    shown = F.when(draw < 5, F.lit(None)).when(draw < 7, F.lit("fr")).otherwise(F.col("declared"))
    out = langid.scan(evidence.withColumn("declared", shown)).withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(20))).collect()
    for low, high, least in ((0, 5, 0.98), (5, 7, 0.97), (7, 20, 0.98)):
        part = [r["language"] == r["lang"] for r in out if low <= r["draw"] < high]
        assert len(part) > 50 and np.mean(part) >= least, (low, np.mean(part))


def test_model_is_the_counts_of_the_sample(spark, evidence):
    model = langid.fit(evidence, per_language=10**9)
    counts = {}
    for r in evidence.select("declared", "text").distinct().collect():
        counts.setdefault(r["declared"], Counter()).update(langid.trigrams(r["text"]))
    want = langid.Model(counts)
    assert model.languages == want.languages and model.place == want.place and np.allclose(model.rows, want.rows)
    few = langid.fit(evidence, per_language=40, grams=50)
    assert len(few.place) <= 50 * len(few.languages)


def test_no_language_is_left_out(spark):
    words = lambda k: " ".join(f"{chr(97 + k % 26)}{chr(97 + (k * 7 + j) % 26)}{chr(97 + (j * k + 3) % 26)}o" for j in range(30))
    rows = [(k * 10 + i, words(k), f"l{k:02d}", "h") for k in range(45) for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = langid.scan(langid.from_documents(table, ["doc_id", "lang"])).collect()
    assert len({r["language"] for r in out}) == 45 and all(r["language"] == r["lang"] for r in out)


def test_many_hosts_and_hot_hosts_give_the_same(spark, evidence, monkeypatch):
    want = sorted(map(tuple, langid.scan(evidence).collect()))
    monkeypatch.setattr(langid, "_HOSTS", 0)
    assert sorted(map(tuple, langid.scan(evidence).collect())) == want
    monkeypatch.setattr(common, "LEAST_HOT", 10)
    assert sorted(map(tuple, langid.scan(evidence).collect())) == want


def test_awkward_rows(spark):
    rows = [(1, None, "en", "h", 1), (2, "", "en", None, 1), (3, "12 34 !", None, "h", 1), (4, "the cat sat on the mat " * 30_000, "en", "h", 1), (4, "the cat sat on the mat", None, "h", 1), (None, "the cat", "und", "h", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _l int")
    out = langid.scan(langid.from_documents(table, ["doc_id", "_l"])).collect()
    assert len(out) == 6 and all(r["language"] == "und" and not r["kept"] for r in out if r["doc_id"] in (1, 2, 3))
    assert all(r["language"] == "en" for r in out if r["doc_id"] in (4, None))
    assert langid.keep(table).columns == table.columns and langid.keep(table).count() == 3
    assert all(r["language"] == "und" for r in langid.scan(langid.from_documents(table.withColumn("lang", F.lit(None).cast("string")), ["doc_id"])).collect())
    assert langid.keep(table.where("doc_id < 0")).count() == 0


def test_pages_against_their_declared_language(spark):
    pages = langid.from_pages(read(spark, "/root/testdata/sf0.001", "pages"), ["page_id"])
    declared = {r["page_id"]: r["declared"] for r in pages.select("_row.page_id", "declared").collect()}
    out = langid.scan(pages.withColumn("declared", F.when(F.pmod(F.xxhash64("_row.page_id"), F.lit(4)) > 0, F.col("declared")))).collect()
    assert np.mean([r["language"] == declared[r["page_id"]] for r in out if declared[r["page_id"]]]) > 0.97
