"""Sharding by proportional stratified interleaving.

The rows of each source are put in a seeded random order and ranked; row r of n has the
fractional rank (2r-1)/2n. All rows are sorted by fractional rank and cut into shards whose counts
differ by one at most, so that each shard has every source in its share.

No task ever sees a whole source or table: ranks are counted per hash bucket and shifted by bucket offsets, and
the place in the global order is counted per bucket of fractional rank, whose offset follows
from the sources' totals alone. There are more buckets where there are more rows, which changes no result.

Groups of equal texts: the law is `rows`, which binds counts alone, so equal texts are rows like others. The draw
has the doc_id in it, so copies are spread over the shards as independently as other rows of their source;
no group is kept together and none weighs on one shard.

Cases: very long texts are read for their size and checksum only; null text has no bytes; null source is a source of its own; null and repeated doc_ids are
rows like others, ties broken by the text's checksum and size (rows equal in all of these are
interchangeable); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import key_of, text_of

SHARDS, SEED = 8, 20260101
#: The least bits of hash buckets of a source, the least buckets of fractional ranks, and the rows for which one bucket of all is meant.
_HASH_BITS, _RANK_BUCKETS, _BUCKET_ROWS = 10, 4096, 200_000


def _div(a: Column, b: Column | int) -> Column:
    """Whole-number division of columns that are not negative."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot and grown_shard (null) of every row."""
    rows = docs.count()
    bits = max(_HASH_BITS, (rows // _BUCKET_ROWS).bit_length())
    buckets = max(_RANK_BUCKETS, rows // _BUCKET_ROWS)
    draw = F.xxhash64(F.lit(seed), "doc_id", F.crc32(F.encode(text_of(), "UTF-8")))
    keyed = docs.select("doc_id", key_of("source").alias("_s"), draw.alias("_h"), "text")
    keyed = keyed.withColumn("_b", F.shiftrightunsigned("_h", 64 - bits))
    counts = keyed.groupBy("_s", "_b").agg(F.count("*").alias("_c"))
    by_source = Window.partitionBy("_s")
    before = F.sum("_c").over(by_source.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_s", "_b", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_c").over(by_source).alias("_n"))
    totals = keyed.groupBy("_s").agg(F.count("*").alias("_n"))
    bucket = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("_f")
    starts = totals.select("_n", bucket).groupBy("_f").agg(
        F.sum(_div(2 * F.col("_n") * F.col("_f") + (buckets - 1), 2 * buckets)).alias("_start")
    )
    sized = keyed.select(
        "doc_id", "_s", "_b", "_h",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(), "UTF-8")).alias("text_crc32"),
    )
    within = Window.partitionBy("_s", "_b").orderBy("_h", "doc_id", "text_crc32", "size")
    ranked = sized.withColumn("_r", F.row_number().over(within)).join(offsets, ["_s", "_b"])
    odd = 2 * (F.col("_before") + F.col("_r")) - 1
    ranked = ranked.select(
        "doc_id", "size", "text_crc32", "_s",
        (odd / (2 * F.col("_n"))).alias("_x"),
        _div(odd * buckets, 2 * F.col("_n")).alias("_f"),
    )
    placed = ranked.withColumn("_p", F.row_number().over(Window.partitionBy("_f").orderBy("_x", "_s"))).join(starts, "_f")
    placed = placed.withColumn("_g", (F.col("_start") + F.col("_p") - 1).cast("long"))
    placed = placed.withColumn("_k", _div(F.col("_g") * shards, max(rows, 1)))
    first = _div(F.col("_k") * rows + (shards - 1), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_k").cast("int").alias("shard"),
        (F.col("_g") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
