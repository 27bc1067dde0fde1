"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every 5-word shingle hash below a fixed fraction (a quarter) of the range of 48-bit hashes, so sketches of
texts of any length can be merged (union) and compared: the hashes kept are a uniform sample of the shingles. Texts of
so few shingles that fewer than 16 hashes lie below the threshold (about 64 shingles) keep their 16 least hashes, since
otherwise most texts of a few words would have the same, empty sketch. Their bound is then the largest hash kept, or the
whole range if there are no more shingles, so that they are compared exactly. This rule is closed under merging:
the merge of two sketches is the sketch of both texts' shingles together.

Everything is built from DataFrame functions. The document after a row in the order of doc_id is
found without a global sort: ids are cut at quantiles into ranges, an id (or null) that holds many rows is cut further
by its texts' hashes, each range is sorted by itself, and the first rows of a range also go, as guests, to the range
before. Only texts are shuffled; sketches are computed after it.

Cases: null text is the empty text, whose sketch is empty; two empty sketches are alike (1), an
empty one and another are not (0); a text of fewer than five words has one shingle, its whole
word sequence; very long texts are one row's work; null doc_ids come first; rows with equal doc_id are ordered by their
text's hash; with one row, the next document is the row itself; an empty table gives an empty result; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import words_of

WIDTH, LEAST, SCALE = 5, 16, 4
#: Rows of a range of ids, and the most ranges.
RANGE_ROWS, MAX_RANGES = 4000, 65_536
BITS = 48
THRESHOLD = 2**BITS // SCALE


def shingles(words: str) -> Column:
    """48-bit hashes of all WIDTH-word shingles of a column of word hashes, repeats included."""
    w = F.col(words)
    wide = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (WIDTH - 1), F.lit(0))),
        lambda x, i: F.shiftrightunsigned(F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WIDTH)]), 64 - BITS),
    )
    one = F.array(F.shiftrightunsigned(F.xxhash64(w), 64 - BITS))
    return F.when(F.size(w) >= WIDTH, wide).when(F.size(w) > 0, one).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """`df` with the sorted sketch of the column `text` (not null) as `out`."""
    df = df.withColumn("_w", F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn("_g", shingles("_w")).drop("_w")
    df = df.withColumn("_low", F.array_distinct(F.filter("_g", lambda h: h < THRESHOLD)))
    least = F.slice(F.sort_array(F.array_distinct("_g")), 1, LEAST)
    return df.withColumn(out, F.when(F.size("_low") >= LEAST, F.sort_array("_low")).otherwise(least)).drop("_g", "_low")


def bound(sketch: Column) -> Column:
    """The largest hash up to which a sketch is complete."""
    return F.when(F.size(sketch) < LEAST, F.lit(2**BITS - 1)).otherwise(
        F.greatest(F.lit(THRESHOLD - 1), F.element_at(sketch, -1))
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two sketches."""
    top = F.least(bound(a), bound(b))
    x, y = F.filter(a, lambda h: h <= top), F.filter(b, lambda h: h <= top)
    both, one = F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)
    return F.when(one == 0, F.lit(1.0)).otherwise(both / F.greatest(one - both, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has as well."""
    top = F.least(bound(a), bound(b))
    x, y = F.filter(a, lambda h: h <= top), F.filter(b, lambda h: h <= top)
    return F.when(F.size(x) == 0, (F.size(y) == 0).cast("double")).otherwise(F.size(F.array_intersect(x, y)) / F.size(x))


def merge(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    all_ = F.sort_array(F.array_union(a, b))
    low = F.filter(all_, lambda h: h < THRESHOLD)
    return F.when(F.size(low) >= LEAST, low).otherwise(F.slice(all_, 1, LEAST))


def as_text(sketch: Column) -> Column:
    """A fingerprint as a string: the hashes in hexadecimal, 12 digits each, in order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), BITS // 4, "0")), "")


def _longs(values: list[int]) -> Column:
    """A constant array, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _below(cuts: list[int], x: Column) -> Column:
    """How many of the ascending `cuts` are at most x, in steps of about the square root of their number."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    upto = lambda values: F.size(F.filter(values, lambda c: c <= x))
    coarse = upto(_longs(cuts[::step]))
    fine = upto(F.slice(_longs(cuts), F.greatest((coarse - 1) * step, F.lit(0)) + 1, F.lit(step)))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def with_next(df: DataFrame, payload: list[str], tie: Column) -> DataFrame:
    """`df` with struct column `_next`: the payload of the next row in the order of (doc_id, tie), or of the first after the last.

    `tie` is a 64-bit hash.
    """
    df = df.withColumn("_tie", tie)
    seen = df.agg(F.count("*").alias("n"), F.count("doc_id").alias("ids")).first()
    ranges = min(MAX_RANGES, max(1, seen["n"] // RANGE_ROWS))
    found: list[int] = []
    if seen["ids"] and ranges > 1:
        at = [i / ranges for i in range(1, ranges)]
        found = [int(x) for x in df.agg(F.percentile_approx("doc_id", at, 100 * ranges).alias("q")).first()["q"]]
    # A quantile met more than once is an id of many rows: a range of its own, cut into pieces by the hash.
    hot = {x: n + 1 for x, n in Counter(found).items() if n > 1}
    cuts = sorted({*found, *(x + 1 for x in hot if x < 2**63 - 1)})
    pieces = [max(1, ranges * (seen["n"] - seen["ids"]) // max(1, seen["n"])), 1, *(hot.get(c, 1) for c in cuts)]
    starts = [0, *accumulate(pieces)]
    # Range 0 has the rows without id, range 1 those before the first cut.
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + _below(cuts, F.col("doc_id"))) + 1
    share = F.shiftrightunsigned(F.col("_tie").bitwiseXOR(F.lit(-(2**63))), 33)
    piece = F.call_function("div", share * F.element_at(_longs(pieces), place), F.lit(2**31))
    df = df.withColumn("_p", F.element_at(_longs(starts), place) + piece)
    # At most a row a piece comes to the driver: which pieces have rows, and the first of each.
    firsts = {r["p"]: r["m"] for r in df.groupBy(F.col("_p").alias("p")).agg(F.min(F.struct("doc_id", "_tie")).alias("m")).collect()}
    used = sorted(firsts)
    number = {p: i for i, p in enumerate(used)}
    dense = _longs([number.get(p, 0) for p in range(starts[-1])])
    df = df.withColumn("_p", F.element_at(dense, F.col("_p").cast("int") + 1).cast("int"))
    ids, ties = _longs([firsts[p]["doc_id"] or 0 for p in used] or [0]), _longs([firsts[p]["_tie"] for p in used] or [0])
    is_first = (F.coalesce("doc_id", F.lit(0)) == F.element_at(ids, F.col("_p") + 1)) & (F.col("_tie") == F.element_at(ties, F.col("_p") + 1))
    put = lambda p, guest, wrap: F.struct(p.alias("p"), F.lit(guest).alias("guest"), F.lit(wrap).alias("wrap"))
    places = F.array_compact(F.array(
        put(F.col("_p"), 0, 0),
        F.when((F.col("_p") > 0) & is_first, put(F.col("_p") - 1, 1, 0)),
        F.when((F.col("_p") == 0) & is_first, put(F.lit(max(0, len(used) - 1)), 1, 1)),
    ))
    placed = df.select(*[c for c in df.columns if c != "_p"], F.inline(places))
    # Guests stand behind the rows of a range: they are those of the next one, or the very first.
    order = Window.partitionBy("p").orderBy("wrap", "guest", F.asc_nulls_first("doc_id"), "_tie")
    led = placed.withColumn("_next", F.lead(F.struct(*payload)).over(order))
    return led.where("guest = 0").drop("p", "guest", "wrap", "_tie")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_edited."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    df = with_next(df, ["t"], F.xxhash64("t"))
    half = F.call_function("div", F.length("t"), F.lit(2)).cast("int")
    edited = F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring("_next.t", F.lit(1), half))
    df = df.select("doc_id", "t", F.col("_next.t").alias("u"), edited.alias("e"))
    for text, out in (("t", "f"), ("u", "g"), ("e", "ef")):
        df = with_sketch(df, text, out)
    f, ef, g = F.col("f"), F.col("ef"), F.col("g")
    return df.select(
        "doc_id", F.length("t").cast("long").alias("n_chars"), F.sha2(F.encode("e", "UTF-8"), 256).alias("edited_sha256"),
        as_text(f).alias("fingerprint"), as_text(ef).alias("edited_fingerprint"),
        likeness(f, ef).alias("near_edited"), likeness(f, g).alias("near_next"), containment(f, ef).alias("contained_edited"),
    )
