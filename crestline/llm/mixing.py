"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's rows are put in a seeded random order and cut into up to 4096 blocks by their hash. The
words a source owes become whole passes over its blocks plus a last, partial pass, which takes documents in
order up to a cut and leaves out those larger than what is owed. What is then missing is made up by the document whose
size fits it best, or where that leaves more than half of it, by a further pass over the smaller ones, until no
document brings the source nearer to its target; each step halves what is missing. How many blocks of each source go to each output shard is drawn by a splitting tree:
the shards are halved again and again and each half's share of every source's quota is drawn from the
multivariate hypergeometric distribution, so that all quotas are met exactly. Each shard then
takes the next blocks of each source, disjoint by construction, and is shuffled by itself.

What is brought to the driver is one row per source (totals, and as many numbers as there are shards); all per-row
work stays distributed and no task holds a whole source. Output groups are sized by the words of the mix.

Cases: null text has no words; null source is a source of its own, after all others; sources
without words have target 0; repeated rows and doc_ids are rows like others; an empty table
gives an empty result; further columns pass through `mix`.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import key_of, text_of, words_of

WEIGHTS, CEILING = (5, 2, 1), 3
SEED, SHARDS = 20260101, 16
#: Words of a group of rows that `mix` shuffles by itself.
GROUP_WORDS = 4_000_000
_BITS = 12


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, ceiling: int = CEILING) -> list[float]:
    """Each source's words, given its size; sources stand in their order of weights."""
    want = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(want[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * want[i] / total >= ceiling * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * want[i] / total
            break
        for i in over:
            out[i] = float(ceiling * sizes[i])
            left -= out[i]
            open_.discard(i)
    return out


def split(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """quotas (sources) dealt to shards: a matrix (shards, sources) whose columns sum to quotas."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    take = int(quotas.sum()) * left // shards
    drawn = rng.multivariate_hypergeometric(quotas, take, method="marginals") if len(quotas) else quotas
    return np.vstack([split(drawn, left, rng), split(quotas - drawn, shards - left, rng)])


def planned(docs: DataFrame, carried: list[str], shards: int = SHARDS, seed: int = SEED, weights=WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """The `carried` columns of `docs` plus _mix: struct(size, source_size, target, copies, shards).

    `copies` is how often the row is in the mix, `shards` has one output shard for each copy.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*carried).alias("_row"), key_of("source").alias("_s"),
        F.size(words_of(text_of())).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h"),
    ).withColumn("_b", F.shiftrightunsigned("_h", 64 - _BITS))
    light = rows.select("_s", "_b", "_h", "_size").persist(StorageLevel.MEMORY_AND_DISK)
    small = light.groupBy("_s", "_b").agg(F.sum("_size").alias("_words")).persist(StorageLevel.MEMORY_AND_DISK)
    totals = {r["_s"]: (r["w"], r["n"]) for r in small.groupBy("_s").agg(F.sum("_words").alias("w"), F.count("*").alias("n")).collect()}
    names = sorted(totals, key=lambda s: (s == "-", s.encode()))
    sizes = [totals[s][0] for s in names]
    goal = targets(sizes, weights, ceiling)
    whole = [int(g // n) if n else 0 for g, n in zip(goal, sizes)]
    rest = [g - k * n for g, k, n in zip(goal, whole, sizes)]
    given = spark.createDataFrame(
        [(s, n, g, k, r) for s, n, g, k, r in zip(names, sizes, goal, whole, rest)],
        "_s string, _all long, _target double, _whole int, _rest double",
    )
    order = Window.partitionBy("_s").orderBy("_b")
    blocks = small.select("_s", "_b", (F.row_number().over(order) - 1).alias("_rank")).join(given, "_s")
    within = Window.partitionBy("_s", "_b").orderBy("_h", "_size")
    place = F.row_number().over(within).alias("_n")
    #: Per source, the cuts (cap, b, n): the partial pass takes documents of `cap` words at most up to place n of block b.
    cuts: dict[str, list] = {s: [] for s in names}
    fill: dict[str, list] = {s: [] for s in names}
    gaps = dict(zip(names, rest))
    taken = "_s string, _gap double, _cuts array<struct<cap: double, b: long, n: int>>, _fill array<struct<b: long, n: int>>"

    def cut_in() -> Column:
        upto = lambda c: (F.col("_b") < c["b"]) | ((F.col("_b") == c["b"]) & (F.col("_n") <= c["n"]))
        return (F.col("_size") > 0) & F.exists("_cuts", lambda c: (F.col("_size") <= c["cap"]) & upto(c))

    numbered = light.select("_s", "_b", "_size", place).persist(StorageLevel.MEMORY_AND_DISK)

    def free(of: list[str]) -> DataFrame:
        """Documents of the sources `of` that the partial pass does not take yet, with their source's gap."""
        state = F.broadcast(spark.createDataFrame([(s, gaps[s], cuts[s], fill[s]) for s in of], taken))
        filled = F.array_contains("_fill", F.struct(F.col("_b").alias("b"), F.col("_n").alias("n")))
        return numbered.join(state, "_s").where((F.col("_size") > 0) & ~cut_in() & ~filled)

    def passed(of: list[str]) -> None:
        """A pass over the free documents no larger than the gap, up to the first that would overshoot."""
        fit = free(of).where(F.col("_size") <= F.col("_gap"))
        ahead = F.sum("_words").over(order) - F.col("_words")
        sums = fit.groupBy("_s", "_b").agg(F.sum("_size").alias("_words"), F.first("_gap").alias("_gap"))
        sums = sums.withColumn("_before", ahead).withColumn("_over", F.col("_before") + F.col("_words") > F.col("_gap"))
        ends = sums.groupBy("_s").agg(F.min(F.when(F.col("_over"), F.struct("_b", "_before"))).alias("_end"), F.sum("_words").alias("_sum")).collect()
        open_ = [(r["_s"], r["_end"]["_b"], r["_end"]["_before"]) for r in ends if r["_end"]]
        last = fit.join(F.broadcast(spark.createDataFrame(open_, "_s string, _b long, _before long")), ["_s", "_b"])
        last = last.withColumn("_upto", F.col("_before") + F.sum("_size").over(Window.partitionBy("_s").orderBy("_n")))
        held = F.col("_upto") <= F.col("_gap")
        stops = {r["_s"]: r for r in last.groupBy("_s").agg(F.max(F.when(held, F.col("_n"))).alias("n"), F.max(F.when(held, F.col("_upto"))).alias("got")).collect()} if open_ else {}
        for r in ends:
            cap, (b, n, got) = gaps[r["_s"]], (2**_BITS, 0, r["_sum"])
            if r["_end"]:
                stop = stops[r["_s"]]
                b, n, got = r["_end"]["_b"], stop["n"] or 0, r["_end"]["_before"] if stop["got"] is None else stop["got"]
            cuts[r["_s"]].append((cap, b, n))
            gaps[r["_s"]] -= got

    passed([s for s in names if gaps[s] >= 1])
    # Candidates stay where their blocks are: no task holds a source's.
    while near := [s for s in names if gaps[s] > 0.5]:
        off = F.abs(F.col("_size") - F.col("_gap"))
        far = off > F.col("_gap") / 2
        best = F.min(F.struct(far.alias("far"), (far & (F.col("_size") > F.col("_gap"))).alias("over"), off.alias("off"), "_b", "_n", "_size")).alias("f")
        found = {r["_s"]: r["f"] for r in free(near).where(off < F.col("_gap")).groupBy("_s").agg(best).collect()}
        if not found:
            break
        again = []
        for s, f in found.items():
            if not f["far"] or f["over"]:
                fill[s].append((f["_b"], f["_n"]))
                gaps[s] -= f["_size"]
            else:
                again.append(s)
        if again:
            passed(again)
    numbered.unpersist()
    # Blocks that have documents of the partial pass.
    end = spark.createDataFrame([(s, max([c[1] for c in cuts[s]], default=-1)) for s in names], "_s string, _end long")
    blocks = blocks.join(F.broadcast(end), "_s").withColumn("_last", F.col("_b") <= F.col("_end"))
    partial = {r["_s"]: r["n"] for r in blocks.where("_last").groupBy("_s").agg(F.count("*").alias("n")).collect()}
    quotas = np.array([k * totals[s][1] + max(partial.get(s, 0), int(bool(fill[s]))) for s, k in zip(names, whole)], dtype=np.int64)
    dealt = np.cumsum(split(quotas, shards, np.random.default_rng(seed)), axis=0)[:-1] if names else np.zeros((0, 0))
    shares = spark.createDataFrame(
        [(s, totals[s][1], dealt[:, i].tolist(), cuts[s], fill[s], int((dealt[:, i] < quotas[i]).sum())) for i, s in enumerate(names)],
        "_s string, _blocks long, _dealt array<long>, _cuts array<struct<cap: double, b: long, n: int>>, _fill array<struct<b: long, n: int>>, _fill_shard int",
    )
    passes = F.filter(F.sequence(F.lit(0), F.col("_whole")), lambda p: (p < F.col("_whole")) | F.col("_last"))
    at = lambda p: F.size(F.filter("_dealt", lambda c: c <= p * F.col("_blocks") + F.col("_rank")))
    blocks = blocks.join(shares, "_s").withColumn("_shards", F.transform(passes, at))
    blocks = blocks.select("_s", "_b", "_all", "_target", "_whole", "_shards", "_cuts", "_fill", "_fill_shard")
    out = rows.withColumn("_n", F.row_number().over(within)).join(blocks, ["_s", "_b"])
    filler = F.array_contains("_fill", F.struct(F.col("_b").alias("b"), F.col("_n").alias("n")))
    own = F.slice("_shards", F.lit(1), F.col("_whole") + F.when(cut_in(), 1).otherwise(0))
    dealt_to = F.when(filler, F.concat(F.slice("_shards", F.lit(1), F.col("_whole")), F.array("_fill_shard"))).otherwise(own)
    mix = F.struct(
        F.col("_size").alias("size"), F.col("_all").alias("source_size"), F.col("_target").alias("target"),
        F.size(dealt_to).alias("copies"), dealt_to.alias("shards"),
    )
    return out.select("_row.*", mix.alias("_mix"))


def digest(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and shards (the output shard of each copy) of every row."""
    m = F.col("_mix")
    return planned(docs, ["doc_id"], shards, seed).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"),
        (m["size"] * m["copies"]).cast("long").alias("taken"), m["shards"].alias("shards"),
    )


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of the mix, with the columns of `docs`, dealt to output shards and shuffled in each.

    A shard's rows stand in as many groups as it has GROUP_WORDS words, each shuffled by itself.
    """
    whole = planned(docs, docs.columns, shards, seed)
    words = sum(r["w"] or 0 for r in docs.agg(F.sum(F.size(words_of(text_of())).cast("long")).alias("w")).collect())
    groups = 1 + words // (shards * GROUP_WORDS)
    chosen = whole.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.posexplode("_mix.shards").alias("_copy", "_shard"))
    local = F.xxhash64(F.lit(seed + 1), F.col("_row.doc_id"), "_copy")
    group = F.pmod(local, F.lit(groups))
    return chosen.repartition(shards * groups, "_shard", group).sortWithinPartitions("_shard", local).select("_row.*")
