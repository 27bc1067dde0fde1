"""Quality rules where they act: against their SQL at a scale at which cutoffs are certified, and on contradicting labels."""

from math import comb

import pytest
from oracle import differences
from pyspark.sql import functions as F

from crestline.llm import quality_rules, queries
from crestline.llm.common import read, settled

SF = "/root/testdata/sf0.1"


def test_rules_act_and_equal_the_sql(spark):
    out = queries.op6_quality_rules(spark, SF)
    assert not differences(out, queries.oracle_sql()["op6_quality_rules"], SF)
    assert out.where("not base_failed and not kept").count() > 100


def test_every_large_stratum_catches_its_bad_documents(spark):
    judged = queries.op6_quality_rules(spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").join(settled(read(spark, SF, "labels"), "quality"), "doc_id")
    table = {
        r["lang"]: r
        for r in judged.where("not base_failed").groupBy("lang").agg(
            F.count_if((F.col("quality") == 1) & ~F.col("kept")).alias("lost"), F.count_if(F.col("quality") == 1).alias("good"),
            F.count_if((F.col("quality") == 0) & ~F.col("kept")).alias("caught"), F.count_if(F.col("quality") == 0).alias("bad"),
        ).collect()
    }
    print(table)
    for r in table.values():
        assert r["lost"] <= quality_rules.RISK * r["good"]
        if r["good"] >= 297:
            assert r["caught"] >= 0.95 * r["bad"], r


@pytest.mark.parametrize("n,k", [(300, 0), (300, 1), (500, 2), (2000, 20), (7, 3)])
def test_binomial_tail(spark, n, k):
    p = quality_rules.RISK
    row = spark.range(1).select(quality_rules._binomial_cdf(F.lit(k), F.lit(n), p).alias("x")).first()
    want = 1.0 if k > n * p else sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert abs(row["x"] - want) < 1e-9


def test_contradicting_and_repeated_labels(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (None, 1), (4, 7), (5, 0)], "doc_id long, quality long")
    assert {(r["doc_id"], r["quality"]) for r in settled(labels, "quality").collect()} == {(2, 1), (5, 0)}


def test_keep_is_what_scan_keeps(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    docs = docs.withColumnRenamed("n_chars", "n_words").withColumn("kept", F.lit("clash")).withColumn("_t", F.lit(1))
    out = quality_rules.keep(docs, labels)
    assert out.columns == docs.columns
    want = {r["doc_id"] for r in quality_rules.scan(docs, labels).where("kept").collect()}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want) and out.where("kept = 'clash'").count() == len(want)
