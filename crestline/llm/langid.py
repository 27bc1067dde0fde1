"""Language ID by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the text's likelihood under character-trigram models, the
declared markup language, the suffix of the address, and a prior of the host. Every declared language has a trigram model,
fitted on a bounded sample of rows that declare it (about `per_language` different texts each: those whose seeded
hash lies under a share of the hash range); trigrams are counted where the rows are, and the driver gets the GRAMS
most frequent ones of each language. All else covers every row. The text counts as at most `text_weight` trigrams'
worth of evidence, so that a long text is not surer than its model is. Host priors are posterior
counts by grouped aggregation, smoothed by those of the host's domain, which are smoothed by
those of all rows. "und" (undetermined) competes as a model that finds all trigrams of the alphabet
equally likely; a document is kept unless "und" wins or its language has a posterior under `sure`.

Each text is scored once; the scored rows are stored and read again for the priors and the verdict. What the driver
holds is a model: at most GRAMS rows for each declared language, however many documents there are.

Cases: null or empty text, or one without letters, gives no text evidence and the language "und"; very long texts are
scored word by word in bounded memory; null
declared language, suffix or host gives no evidence of that kind; a declared language no model knows ("und" or only
declared by texts without letters) gives none either; ties go to the first language by name; repeated rows are judged
alike; an empty table gives an empty result; without any declared row all are "und"; further columns pass through,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import computed_once, cut, give_back, hot_keys, joined, key_of, small_batches

PER_LANGUAGE, GRAMS, TEXT_WEIGHT, SURE, SEED = 1500, 20_000, 40.0, 0.5, 20260101
#: How often a declared language or an address suffix is right, and the counts behind a host's and a domain's prior.
DECLARED, SUFFIX, HOST_COUNT, DOMAIN_COUNT = 0.9, 0.8, 20.0, 50.0
#: Words remembered with their scores, and the most host priors that are broadcast.
_WORDS_KEPT, _HOSTS = 300_000, 10_000
#: Languages of country-code suffixes.
SUFFIXES = {"at": "de", "de": "de", "es": "es", "fr": "fr", "mx": "es", "uk": "en", "us": "en"}
_LETTERS = regex.compile(r"\p{L}+")


def trigrams(text: str) -> Counter:
    """Character trigrams of the words of a text, a space before and after each."""
    out: Counter = Counter()
    for word, n in Counter(_LETTERS.findall(text.lower())).items():
        w = f" {word} "
        for i in range(len(w) - 2):
            out[w[i : i + 3]] += n
    return out


class Model:
    """Log-likelihoods of character trigrams in each language."""

    def __init__(self, counts: Mapping[str, Mapping[str, int]]):
        self.languages = sorted(counts)
        grams = sorted(set().union(*counts.values())) if counts else []
        letters = len({c for g in grams for c in g}) or 1
        size = len(grams) + 1
        totals = [sum(counts[k].values()) + 0.5 * size for k in self.languages]
        #: One row of log-likelihoods a trigram, the first for trigrams not seen; the last column counts.
        self.rows = np.ones((len(grams) + 1, len(self.languages) + 2))
        for j, (k, total) in enumerate(zip(self.languages, totals)):
            self.rows[0, j] = np.log(0.5 / total)
            self.rows[1:, j] = np.log((np.array([counts[k].get(g, 0) for g in grams], float) + 0.5) / total)
        self.rows[:, -2] = -3 * np.log(letters)
        self.place = {g: i + 1 for i, g in enumerate(grams)}

    def places(self, word: str) -> list[int]:
        """Rows of the trigrams of a word's parts."""
        place, out = self.place.get, []
        for part in _LETTERS.findall(word.lower()):
            w = f" {part} "
            out += [place(w[i : i + 3], 0) for i in range(len(part))]
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods and the number of trigrams of each word."""
        parts = [self.places(w) for w in words]
        sizes = np.array([len(p) for p in parts])
        out = np.zeros((len(words), self.rows.shape[1]))
        flat = self.rows[[x for p in parts for x in p]]
        if len(flat):
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out[sizes > 0] = np.add.reduceat(flat, starts[sizes > 0], axis=0)
        return out


class Scorer:
    """Text log-likelihoods per language, with words' scores remembered in bounded memory."""

    def __init__(self, model: Model, weight: float):
        self.model, self.weight = model, weight
        self.places: dict[str, int] = {}
        self.rows = np.zeros((1024, len(model.languages) + 2))

    def __call__(self, text: str | None) -> list[float]:
        words = (text or "").split()
        total = np.zeros(self.rows.shape[1])
        for i in range(0, len(words), 8192):
            if len(self.places) > _WORDS_KEPT:
                self.places.clear()
            part, places = words[i : i + 8192], self.places
            new = list(dict.fromkeys(w for w in part if w not in places))
            if new:
                n = len(places)
                while n + len(new) > len(self.rows):
                    self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
                self.rows[n : n + len(new)] = self.model.scores(new)
                places.update(zip(new, range(n, n + len(new))))
            total += self.rows[[places[w] for w in part]].sum(axis=0)
        grams = total[-1]
        if not grams:
            return [0.0] * (self.rows.shape[1] - 1)
        scores = total[:-1] * min(1.0, self.weight / grams)
        return (scores - scores.max()).tolist()


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, grams: int = GRAMS) -> Model:
    """Trigram models of every declared language, on about `per_language` different texts each."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "text"), 11) / F.lit(2.0**53)
    declared = docs.where("declared is not null and declared <> 'und' and text is not null").select("declared", "text", place.alias("place"))
    texts = declared.groupBy("declared").agg(F.approx_count_distinct("place").alias("n")).collect()  # a row a declared language
    shares = docs.sparkSession.createDataFrame([(r["declared"], per_language / max(1, r["n"])) for r in texts], "declared string, share double")
    picked = declared.join(F.broadcast(shares), "declared").where("place < share").groupBy("declared", "place").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held: dict[str, Counter] = {}
            for name, text in zip(batch["declared"], batch["text"]):
                held.setdefault(name, Counter()).update(trigrams(text))
            rows = [(k, g, n) for k, c in held.items() for g, n in c.items()]
            yield pd.DataFrame(rows, columns=["declared", "gram", "n"])
            del batch, held, rows
        give_back()

    sums = picked.select("declared", "text").mapInPandas(count, "declared string, gram string, n long").groupBy("declared", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("declared").orderBy(F.desc("n"), "gram")
    most = sums.withColumn("at", F.row_number().over(order)).where(F.col("at") <= grams)
    counts: dict[str, dict[str, int]] = {}
    with small_batches(docs.sparkSession):
        rows = most.collect()  # at most `grams` rows a declared language
    for r in rows:
        counts.setdefault(r["declared"], {})[r["gram"]] = r["n"]
    return Model(counts)


def _posterior(logs: Column, more: list[Column]) -> Column:
    """Normalised probabilities from an array of log-likelihoods and further arrays to add."""
    total = logs
    for m in more:
        total = F.zip_with(total, m, lambda a, b: a + b)
    top = F.transform(F.array(total), lambda t: F.transform(t, lambda x: F.exp(x - F.array_max(t))))[0]
    return F.transform(F.array(top), lambda t: F.transform(t, lambda x: x / F.aggregate(t, F.lit(0.0), lambda a, b: a + b)))[0]


def identify(docs: DataFrame, text_weight: float = TEXT_WEIGHT, sure: float = SURE, per_language: int = PER_LANGUAGE) -> DataFrame:
    """`_row` of `docs` (_row, text, declared, suffix, host, domain) with _id: struct(language, confidence, kept)."""
    model = fit(docs, per_language)
    names = [*model.languages, "und"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value, text_weight)
        batch = None
        for batch in texts:
            yield pd.Series([scorer(t) for t in batch])
        del scorer, batch
        give_back()

    scored = F.pandas_udf(score, "array<double>")
    known = F.lit(names)

    def said(language: Column, right: float) -> Column:
        wrong = float(np.log((1 - right) / max(1, len(names) - 1)))
        heard = F.coalesce(language.isin(model.languages), F.lit(False))
        return F.transform(known, lambda k: F.when(heard, F.when(k == language, float(np.log(right))).otherwise(wrong)).otherwise(0.0))

    of_suffix = F.coalesce(*[F.when(F.col("suffix") == k, v) for k, v in SUFFIXES.items()])
    # Whatever was scored is stored, with a number for each row, and read from there from now on.
    rows = docs.select(
        "_row", "declared", "suffix", key_of("host").alias("_h"), key_of("domain").alias("_d"), scored("text").alias("_l"), F.monotonically_increasing_id().alias("_n"),
    )
    with small_batches(docs.sparkSession):
        rows = cut(rows)
    evidence = [said(F.col("declared"), DECLARED), said(of_suffix, SUFFIX)]
    first = rows.select("_h", "_d", _posterior(F.col("_l"), evidence).alias("p"))
    sums = [F.sum(F.get("p", F.lit(i))).alias(f"n{i}") for i in range(len(names))]
    counts = cut(first.groupBy("_h", "_d").agg(*sums, F.count("*").alias("m")))
    everything = counts.agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))], F.count("*").alias("hosts"), F.sum("m").alias("rows")).first()
    total = [float(everything[f"n{i}"] or 0) + 1.0 for i in range(len(names))]
    base = F.lit([x / sum(total) for x in total])
    vector = F.array(*[F.col(f"n{i}") for i in range(len(names))])
    smooth = lambda v, prior, k: F.zip_with(v, prior, lambda n, p: (n + k * p) / (F.aggregate(v, F.lit(0.0), lambda a, b: a + b) + k))
    domains = counts.groupBy("_d").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))]).select("_d", smooth(vector, base, DOMAIN_COUNT).alias("_dp"))
    hosts = counts.join(domains, "_d").select("_h", "_d", smooth(vector, F.col("_dp"), HOST_COUNT).alias("_hp"))
    hosts = hosts.select("_h", "_d", F.transform("_hp", lambda p: F.log(p)).alias("_prior"))
    if everything["hosts"] <= _HOSTS:
        rows = rows.join(F.broadcast(hosts), ["_h", "_d"])
    else:
        rows = joined(rows, hosts, ["_h", "_d"], F.col("_n"), hot_keys(counts, ["_h", "_d"], everything["rows"]))
    rows = computed_once(rows.select("_row", "_l", _posterior(F.col("_l"), [*evidence, F.col("_prior")]).alias("_p")))
    place = F.array_position("_p", F.array_max("_p")).cast("int")
    silent = F.aggregate("_l", F.lit(0.0), lambda a, b: a + F.abs(b)) == 0
    language = F.when(silent, "und").otherwise(F.element_at(known, place))
    confidence = F.when(silent, 0.0).otherwise(F.array_max("_p"))
    kept = (language != "und") & (confidence >= sure)
    return rows.select("_row", F.struct(language.alias("language"), F.round(confidence, 9).alias("confidence"), kept.alias("kept")).alias("_id"))


def from_documents(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The documents table as evidence: `lang` is the declared language, `source` the host; it has no addresses."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.col("source").alias("host"), F.regexp_replace("source", r"\d+$", "").alias("domain"),
    )


def from_pages(pages: DataFrame, carried: list[str]) -> DataFrame:
    """Raw web pages as evidence: the html element's lang, the host's suffix, the host and its domain."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/:?#]+)", 1))
    body = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    lang = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r'(?i)<html[^>]*\blang="?([a-zA-Z]+)', 1))
    return pages.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"), F.regexp_replace(body, r"<[^>]*>|&\w+;", " ").alias("text"),
        F.nullif(lang, F.lit("")).alias("declared"), F.regexp_extract(host, r"\.([a-z]+)$", 1).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+\.[a-z]+|[^.]+\.[a-z]+)$", 1).alias("domain"),
    )


def scan(evidence: DataFrame) -> DataFrame:
    """The carried columns with language, confidence and kept."""
    return identify(evidence).select("_row.*", "_id.*")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is determined, with the columns of `docs`."""
    return identify(from_documents(docs, docs.columns)).where("_id.kept").select("_row.*")
