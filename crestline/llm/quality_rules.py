"""Quality rules whose cutoffs are certified on labelled holdouts.

A document fails a rule if a measure of it lies above a cutoff. Cutoffs are picked per stratum
(the document's `lang`) from a fixed grid. A measure's cutoffs are tested in a fixed sequence, from the highest down,
each by the exact binomial test on the stratum's labelled good documents of "more than `risk` of the good documents are
lost", up to the first that isn't rejected; those before it are admissible. A fixed sequence needs no correction for
its length, so the level is `delta` divided by the number of sequences (Bonferroni over strata and measures). (A
lower cutoff loses at least as many, so its bound is never better, and the sequence ends where the test first fails.)
Of the admissible cutoffs the one that catches most labelled bad documents wins, then
the one that loses fewest good ones, then the highest. A rule without an admissible cutoff is off in
that stratum: with no good document lost, a stratum needs log(delta / tests) / log(1 - risk) labelled good
documents, 297 for four strata.

Everything is built from DataFrame functions.

Cases: null text is the empty text (no words, base rules fail, not kept); a null or rare stratum
has no cutoffs, so only the base rules act; very long texts are one row's work; labels that contradict one another count
as none, repeated ones once; repeated rows are judged alike, each on its own; an
empty table gives an empty result; further columns pass through `judged` and never take part, and a
further column that bears the name of an output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import computed_once, cut, settled, text_of, words_of

#: The symbols counted and the least number of words.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: The greatest share of good documents a rule may lose in a stratum, and the chance that any rule loses more.
RISK, DELTA = 0.02, 0.05
#: Cutoffs tried for each measure.
GRID = {
    "symbol_share": [0.01, 0.02, 0.04, 0.06, 0.1, 0.2, 0.3],
    "repeat_share": [0.1, 0.15, 0.2, 0.3, 0.4],
    "dup_line_share": [0.1, 0.2, 0.3, 0.4, 0.5],
    "caps_share": [0.2, 0.3, 0.4, 0.5, 0.7, 0.9],
    "mean_word": [9.0, 10.0, 12.0, 15.0, 20.0],
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_FEW = 64


def _repeated(words: str) -> Column:
    """How many words lie in 3-word windows that occur twice or more.

    Windows are compared by 64-bit hash. Hashes that occur twice are found by sorting; with few
    of them their places are found by look-up, else by sorting (hash, place) pairs.
    """
    w = F.col(words)
    windows = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )
    return windows


def _covered(places: Column) -> Column:
    """Number of words covered by 3-word windows that start at the ascending `places`."""
    steps = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return steps


def measured(docs: DataFrame) -> DataFrame:
    """`docs` with COUNTS, n_upper, n_lines and base_failed."""
    names = [c for c in docs.columns if c not in {*COUNTS, "n_upper", "n_lines", "base_failed"}]
    text = text_of()
    df = docs.select(*names, text.alias("_t")).withColumn("_w", words_of(F.col("_t")))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumns({"_lines": lines, "_h": _repeated("_w")})
    df = df.withColumn("_sorted", F.sort_array("_h"))
    ordered = F.col("_sorted")
    df = df.withColumn(
        "_twice",
        F.array_distinct(F.filter(ordered, lambda x, i: (i > 0) & (x == F.get(ordered, i - 1)))),
    ).drop("_sorted")
    h, twice = F.col("_h"), F.col("_twice")
    marked = F.transform(h, lambda x, i: F.when(F.array_contains(twice, x), i))
    looked_up = _covered(F.filter(marked, lambda i: i.isNotNull()))
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    again = F.filter(
        F.zip_with(
            F.zip_with(pairs, F.slice(pairs, 2, F.size(h)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            F.concat(F.slice(pairs, 1, 1), F.slice(pairs, 1, F.size(h) - 1)),
            lambda x, before: F.when(
                (x["a"]["h"] == x["b"]["h"])
                | ((before["h"] == x["a"]["h"]) & (before["i"] != x["a"]["i"])),
                x["a"]["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    repeats = (
        F.when(F.size(twice) == 0, 0)
        .when(F.size(twice) <= _FEW, looked_up)
        .otherwise(_covered(F.sort_array(again)))
    )
    lacking = lambda chars: F.length("_t") - F.length(F.translate("_t", chars, ""))
    df = df.select(
        *names,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        lacking(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        lacking("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
    )
    df = computed_once(df)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _measures() -> dict[str, Column]:
    def ratio(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "symbol_share": ratio("n_symbols", "word_chars"),
        "repeat_share": ratio("n_repeat_words", "n_words"),
        "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "caps_share": ratio("n_upper", "word_chars"),
        "mean_word": ratio("word_chars", "n_words"),
    }


def _binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed term by term in logarithms."""
    import math

    odds, none = math.log(p / (1 - p)), n * F.lit(math.log1p(-p))
    return F.when(k > n * p, F.lit(1.0)).otherwise(
        F.aggregate(
            F.filter(F.sequence(F.lit(0), k.cast("int")), lambda i: i > 0),
            F.struct(none.alias("log"), F.exp(none).alias("sum")),
            lambda acc, i: F.struct(
                (acc["log"] + F.log((n - i + 1) / i) + odds).alias("log"),
                (acc["sum"] + F.exp(acc["log"] + F.log((n - i + 1) / i) + odds)).alias("sum"),
            ),
            lambda acc: acc["sum"],
        )
    )


def certified(measures: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row (stratum, measure, cutoff, lost, good, caught) for each rule that is on.

    `measures` is the result of `measured` with a `lang` column, `labels` has doc_id and quality. Documents that
    fail the base rules and rows without stratum, label or doc_id take no part. Every stratum is tested.
    """
    labelled = settled(labels, "quality").withColumnRenamed("quality", "_q")
    held = (
        measures.where(~F.col("base_failed") & F.col("lang").isNotNull())
        .select("doc_id", F.col("lang").alias("stratum"), *[v.alias(k) for k, v in _measures().items()])
        .join(labelled, "doc_id")
    )
    counts = [
        F.count_if((F.col(m) > c) & (F.col("_q") == q)).alias(f"{m}|{i}|{q}")
        for m, cs in GRID.items() for i, c in enumerate(cs) for q in (0, 1)
    ]
    table = held.groupBy("stratum").agg(F.count_if(F.col("_q") == 1).alias("good"), *counts)
    tried = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.lit(float(c)).alias("cutoff"), F.col(f"{m}|{i}|0").alias("caught"), F.col(f"{m}|{i}|1").alias("lost"))
        for m, cs in GRID.items() for i, c in enumerate(cs)
    ])
    strata = F.count("*").over(Window.partitionBy(F.lit(1)))
    rows = table.withColumn("strata", strata).select("stratum", "good", "strata", F.inline(tried))
    tail = _binomial_cdf(F.col("lost"), F.col("good"), risk)
    rows = rows.where((tail <= F.lit(delta) / (F.col("strata") * len(GRID))) & (F.col("caught") > 0))
    best = F.max_by(F.struct("cutoff", "caught", "lost", "good"), F.struct("caught", -F.col("lost"), "cutoff"))
    return rows.groupBy("stratum", "measure").agg(best.alias("b")).select("stratum", "measure", "b.*")


def judged(measures: DataFrame, rules: DataFrame) -> DataFrame:
    """`measures` with `kept`: the base rules and all rules of the stratum hold.

    The rules come to the driver, at most one row a stratum and measure, and are broadcast as one row a stratum: a
    stratum has rules from log(delta / tests) / log(1 - risk) labelled good documents on, so labels bound their number.
    """
    found: dict[str, dict[str, float]] = {}
    for r in rules.collect():
        found.setdefault(r["stratum"], {})[r["measure"]] = r["cutoff"]
    names = list(GRID)
    table = measures.sparkSession.createDataFrame(
        [(s, *[c.get(m) for m in names]) for s, c in sorted(found.items())],
        ", ".join(["_stratum string", *[f"_cut_{m} double" for m in names]]),
    )
    passes = F.lit(True)
    for name, column in _measures().items():
        passes = passes & ~F.coalesce(column > F.col(f"_cut_{name}"), F.lit(False))
    joined = measures.join(F.broadcast(table), F.col("lang") == F.col("_stratum"), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & passes).drop("_stratum", *[f"_cut_{m}" for m in names])


def scan(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """doc_id, COUNTS, base_failed and kept of every row of `docs` (doc_id, text, lang)."""
    rows = cut(measured(docs.select("doc_id", "lang", "text")).drop("text"))
    return judged(rows, certified(rows, labels, risk, delta)).select("doc_id", *COUNTS, "base_failed", "kept")


def keep(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The rows of `docs` that the rules keep, with the columns of `docs`; each text is measured once, and stored with its measures."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = cut(measured(docs.select(row.alias("_row"), "doc_id", "lang", "text")).drop("text"))
    return judged(rows, certified(rows, labels, risk, delta)).where("kept").select("_row.*")
