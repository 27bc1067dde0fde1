"""MinHash near-dedup with HyperMinHash registers.

A text's set holds the hashes of its distinct `width`-word shingles, lower-cased in A-Z. Its sketch
has 252 buckets. Each shingle falls into one bucket a round; a bucket keeps the least hash of the first
round that reaches it, so that two sets agree in a bucket with probability equal to their
Jaccard similarity, whatever their sizes. Stored is a 16-bit register per bucket: 6 bits of the
leading-zero count and 10 bits of mantissa (mixed with the round). Bands of six registers, 42 of them, bring
sets of similarity 0.8 together but for a chance of 2e-6.

Copies with equal sets are folded first: each different set is a node of its own, whatever doc_ids its rows
have. Within a band, each set is held against one member only, the
one that meets most others in all bands (a star), never against all others;
members of bands that still hold several components after that are joined by the rarest shingles of
their sets, which finds every pair that can be similar and few others; members of one component are no pair there, and
shingles of one component alone take no part. A pair passes a
collision-corrected estimate from the registers first, with a margin of six standard
deviations, and then the exact comparison of full sets. Links are followed to components by
large-star/small-star rounds, whose number grows with the logarithm of the longest chain. Bands, sets, shingles
and nodes that hold many rows are dealt to many tasks in every join.

Cases: null text and texts without words have an empty set and link with nothing; a text with
fewer words than `width` has its whole sequence as one shingle; very long texts are one row's work, linear in
their length; rows with a null doc_id take no part (component_id null, kept); rows of equal set are one class;
rows that share a doc_id but not the set are judged each by its own set; an empty table gives an empty
result. `dedup` keeps, of each component, the row with the least doc_id, then the least key of its set, then
the least hash of all its columns, and of rows equal in every column one; a component is never left without a
row; all columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import cut, fresh, give_back, hot_keys, joined, row_hash

BUCKETS, BAND, BANDS = 252, 6, 42
_SEED = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Chance that different values give equal registers: mantissa and leading-zero count both agree.
COLLISION = 2.0**-10 / 3
MARGIN = 6 * (0.8 * 0.2 / BUCKETS) ** 0.5
_WORDS_KEPT = 400_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Hash of each word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, width: int, words: Words) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.array([words[w] for w in found], np.uint64)
    n = max(1, len(h) - width + 1)
    out = np.full(n, len(h) if len(h) < width else width, np.uint64)
    for k in range(min(width, len(h))):
        out = mix(out * _SEED + h[k : k + n])
    return np.unique(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The 16-bit registers of a set that isn't empty."""
    out = np.zeros(BUCKETS, np.uint16)
    empty = np.ones(BUCKETS, bool)
    n, done = len(hashes), 0
    while empty.any():
        rounds = np.arange(done, done + max(1, 1536 // n), dtype=np.uint64)
        v = mix(hashes[None, :] + (rounds[:, None] + np.uint64(1)) * _SEED)
        bucket = (v >> np.uint64(48)) % np.uint64(BUCKETS)
        value = v & np.uint64((1 << 44) - 1)
        key = (bucket << np.uint64(56)) | (np.minimum(rounds - np.uint64(done), np.uint64(4095))[:, None] << np.uint64(44)) | value
        key = np.sort(key, axis=None)
        at = (key >> np.uint64(56)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        b, k = at[first], key[first]
        new = empty[b]
        b, k = b[new], k[new]
        low = (k & np.uint64((1 << 44) - 1)).astype(np.float64) + 1
        mantissa, exponent = np.frexp(low)
        zeros = (44 - exponent + 1).astype(np.uint64)
        bits = ((mantissa - 0.5) * 2048).astype(np.uint64)
        round_ = ((k >> np.uint64(44)) & np.uint64(4095)) + np.uint64(done)
        out[b] = ((zeros << np.uint64(10)) | (bits & np.uint64(1023))).astype(np.uint16) ^ (round_ * np.uint64(40503)).astype(np.uint16)
        empty[b] = False
        done += len(rounds)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity from two sketches, corrected for chance agreement of registers."""
    return max(0.0, ((a == b).mean() - COLLISION) / (1 - COLLISION))


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, x, n, key (of the whole set) and regs of each row of `docs` (doc_id, x, text); key and regs are null for empty sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for batch in batches:
            n, keys, regs = [], [], []
            for text in batch["text"]:
                s = shingle_set(text, width, words)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(sketch(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": batch["x"], "n": n, "key": keys, "regs": regs})
        del words
        give_back()

    return docs.mapInPandas(run, "doc_id long, x long, n long, key binary, regs binary")


def _with_sets(docs: DataFrame, width: int) -> DataFrame:
    """node, s (the set) and r (its registers) of each node of `docs` (node, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, seen = Words(), set()
        for batch in batches:
            # Rows equal in every column stand for one node.
            new = [i for i, node in enumerate(batch["node"]) if not (node in seen or seen.add(node))]
            sets = [shingle_set(batch["text"].iat[i], width, words) for i in new]
            yield pd.DataFrame({"node": batch["node"].iloc[new].to_numpy(), "s": [s.tobytes() for s in sets], "r": [sketch(s).tobytes() if len(s) else b"" for s in sets]})

    return docs.mapInPandas(run, "node long, s binary, r binary")


def _count(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("m"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for sa, ra, sb, rb in zip(batch["sa"], batch["ra"], batch["sb"], batch["rb"]):
                if estimate(np.frombuffer(ra, np.uint16), np.frombuffer(rb, np.uint16)) < percent / 100 - MARGIN:
                    keep.append(False)
                    continue
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]
        give_back()

    a = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("r").alias("ra"))
    b = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("r").alias("rb"))
    total = pairs.count()
    first = joined(pairs, a, ["a"], F.col("b"), hot_keys(_count(pairs, "a"), ["a"], total))
    both = joined(first, b, ["b"], F.col("a"), hot_keys(_count(pairs, "b"), ["b"], total))
    return both.mapInPandas(run, "a long, b long").distinct()


def _by_prefix(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components `c` among `rows` (node, c) that can have the similarity.

    Two sets with Jaccard similarity t share one of the n - ceil(t n) + 1 rarest shingles of
    each, rarity being any order common to all, and after the first they share, both have enough
    left to reach the intersection. Shingles that only one component has are left out before sets are paired.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, c, s in zip(batch["node"], batch["c"], batch["s"]):
                h = np.frombuffer(s, np.int64)
                yield pd.DataFrame({"node": node, "c": c, "n": len(h), "h": h})

    shingles = cut(rows.join(sets.select("node", "s"), "node").mapInPandas(run, "node long, c long, n long, h long").distinct())
    often = shingles.groupBy("h").agg(F.count("*").alias("m"), F.min("c").alias("x"), F.max("c").alias("y")).where("m > 1")
    # Shingles of one set alone come first in the order, and find no partner.
    shared = joined(shingles, often, ["h"], F.col("node"), hot_keys(often, ["h"], shingles.count()))
    alone = Window.partitionBy("node")
    place = F.row_number().over(alone.orderBy("m", "h")) + (F.col("n") - F.count("*").over(alone))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    kept = cut(shared.withColumn("place", place).where((F.col("place") <= prefix) & (F.col("x") != F.col("y"))).select("node", "c", "n", "h", "place"))
    side = lambda k: kept.select("h", F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("c").alias(f"c{k}"), F.col("place").alias(f"p{k}"))
    # What can still be shared from the first common shingle on must reach the least intersection.
    sized = f"{100 + percent} * (1 + least(na - pa, nb - pb)) >= {percent} * (na + nb)"
    return side("a").join(side("b"), "h").where(f"a < b and ca <> cb and {sized}").select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable from each node of the edges (a, b)."""
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    state = None
    while True:
        # Large star: neighbours above a node go to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"), F.count("*").alias("m"))
        total = 2 * state[0] if state else both.count()
        star = joined(both.where("v > u"), least.drop("m"), ["u"], F.col("v"), hot_keys(least, ["u"], total))
        large = star.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        # Small star: neighbours below a node go to the least of them, and so does the node.
        low = large.groupBy("u").agg(F.min("v").alias("least"), F.count("*").alias("m"))
        star = joined(large, low.drop("m"), ["u"], F.col("v"), hot_keys(low, ["u"], total))
        small = star.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(low.select("u", F.col("least").alias("v")))
        edges = cut(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum("v")).first()
        if now == state:
            break
        state = now
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")


def _judged(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, x, n_shingles, component_id and head of each row of `docs` (doc_id, x, text); head: the row stands for its component."""
    signed = cut(_signed(docs, width))
    sets = signed.where("key is not null and doc_id is not null")
    folded = sets.groupBy("key").agg(F.min(F.struct("doc_id", "x")).alias("first"), F.count("*").alias("m"), F.first("n").alias("n"), F.first("regs").alias("regs"))
    heads = cut(folded.withColumn("node", F.monotonically_increasing_id()))
    nodes = heads.count()
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1)))
    width_bytes = 2 * BAND
    banded = heads.select("node", "regs", band.alias("i")).select(
        "node", F.xxhash64("i", F.substring("regs", F.col("i") * width_bytes + 1, F.lit(width_bytes))).alias("band")
    )
    shared = cut(banded.groupBy("band").agg(F.count("*").alias("m"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("band", "m"))
    hot = hot_keys(shared, ["band"], BANDS * nodes)
    rows = joined(banded, shared, ["band"], F.col("node"), hot).dropDuplicates(["band", "node"])
    # The member that meets most others is the likeliest centre of a band.
    rows = cut(rows)
    central = rows.groupBy("node").agg(F.sum("m").alias("met"))
    rows = cut(rows.join(central, "node"))
    wanted = heads.join(central.select("node"), "node").select("node", "first.doc_id", "first.x")
    known = cut(_with_sets(docs.join(wanted, ["doc_id", "x"]).select("node", "text"), width))
    hubs = rows.groupBy("band").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("hub"))
    stars = joined(rows.select("band", "node"), hubs, ["band"], F.col("node"), hot).where("node <> hub")
    stars = cut(stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    links = cut(_links(stars, known, percent))
    found = components(links)
    # Members of bands that still hold several components are joined by their rarest shingles.
    placed = rows.join(found, "node", "left").select("band", "node", F.coalesce("component", "node").alias("c"))
    open_ = placed.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where("lo <> hi and m > 2")
    rest = cut(joined(placed, open_.select("band"), ["band"], F.col("node"), hot).select("node", "c").distinct())
    across = cut(_by_prefix(rest, known, percent).join(stars, ["a", "b"], "left_anti"))
    if across.limit(1).count():
        found = components(links.unionByName(_links(across, known, percent)))
    # What stands for a component is the first row of its first set.
    graph = heads.select("node", "key", "first", "m").join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    best = graph.groupBy("c").agg(F.min(F.struct(F.col("first.doc_id"), "key", F.col("first.x"))).alias("head"), F.count("*").alias("m"))
    graph = joined(graph.select("node", "key", "c", F.col("m").alias("of")), best.drop("m"), ["c"], F.col("node"), hot_keys(best, ["c"], nodes))
    graph = graph.select("key", "head", F.col("of").alias("m"))
    signed = signed.select("doc_id", "x", "n", "key", F.coalesce("key", F.lit(b"")).alias("k"))
    graph = graph.withColumnRenamed("key", "k")
    out = joined(signed.where("key is not null and doc_id is not null"), graph.drop("m"), ["k"], F.struct("doc_id", "x"), hot_keys(graph, ["k"], signed.count()))
    out = out.select("doc_id", "x", "n", F.col("head.doc_id").alias("c"), (F.struct("doc_id", "key", "x") == F.col("head")).alias("h"))
    alone = signed.where("key is null or doc_id is null").select("doc_id", "x", "n", F.col("doc_id").alias("c"), F.lit(True).alias("h"))
    out = out.unionByName(alone)
    return out.select("doc_id", "x", F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), F.col("h").alias("head"))


def linked(docs: DataFrame, width: int, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of each row of `docs` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("x"), "text")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return _judged(rows, width, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def dedup(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component of `docs`, with the columns of `docs`; rows without words or doc_id all stay, but for full repeats."""
    mark, same = fresh(docs.columns, "_x"), fresh(docs.columns, "_id")
    marked = docs.withColumns({mark: row_hash(docs), same: F.col("doc_id").cast("long")})
    judged = cut(_judged(marked.select(F.col(same).alias("doc_id"), F.col(mark).alias("x"), "text"), width, percent))
    gone = judged.where("not head").select(F.col("doc_id").alias(same), F.col("x").alias(mark)).distinct()
    repeated = judged.groupBy("doc_id", "x").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if repeated:
        marked = marked.dropDuplicates([same, mark])
    return marked.join(gone, [same, mark], "left_anti").drop(mark, same)
