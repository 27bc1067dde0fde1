"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word has a sparse random index vector: four entries of 1 or -1, whose places and signs are bits of the word's own
hash, so no table of them is needed. The word vector of each of the `VOCABULARY` most frequent words is the sum of the
index vectors of the words up to two places away, over the whole corpus: whole numbers, added up per task and
then by one grouped sum of bounded size. (The frequent words are those that reach a count that at most `VOCABULARY`
words reach; words of more than 64 characters are not among them.) A document is pooled to the mean and the spread of
its normalised word vectors and the share of its words that are new in it. A two-layer numpy network is fitted on about
`fit_rows` labelled rows of each class (a share by a seeded hash), weighted to the classes' own shares, and its
probabilities are calibrated by a temperature on every fifth of them.

Words are the runs between ASCII spaces; each word stands beside its shape (letters, capitals,
digits and symbols by kind, hashed to 512 rows), which has a vector too, so that rare words are not featureless.

Cases: null and empty texts have the zero vector and get a score like others; very long texts are pooled whole, in memory
of their own size; labels of null doc_id or another quality than 0 or 1 are not used, labels of one doc_id that
contradict one another neither, repeated ones count once; of rows that share a labelled doc_id the text with the
least hash is learned from; one class only, or no labels, gives the share of label 1 (0.5 without any) as score; repeated
rows are scored alike; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.llm.common import settled

VOCABULARY, DIM, ONES, REACH = 16_000, 32, 4, 2
FIT_ROWS, HIDDEN, EPOCHS, SEED = 4000, 24, 60, 20260101
CUTOFF = 0.7
_WORDS_KEPT, _TOKENS, _LONGEST = 600_000, 200_000, 64
_SHAPES = 512
#: Word counts are told apart in steps of a tenth when the least count of the vocabulary is chosen.
_STEP = math.log(1.1)


class _Kinds(dict):
    """Characters to their kinds: A capital, a other letter, 0 digit, others themselves."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


_KINDS, _TWICE = _Kinds(), re.compile(r"(.)\1+")


class Words(dict):
    """A number for each word, remembered in bounded memory: the row of its vector plus one (0 without), the row of its shape's, its hash.

    The first _SHAPES rows are those of shapes, the next those of the vocabulary.
    """

    def __init__(self, rows: dict[str, int]):
        self.rows = rows

    def __missing__(self, word: str) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        shape = b"a" if word.isascii() and word.isalpha() and word.islower() else _TWICE.sub(r"\1", word.translate(_KINDS)).encode("utf-8", "surrogatepass")
        value = (self.rows.get(word, -1) + 1) << 41 | zlib.crc32(shape) % _SHAPES << 32 | zlib.crc32(word.encode("utf-8", "surrogatepass"))
        if len(word) <= _LONGEST:
            self[word] = value
        return value


def tokens(text: str | None, words: Words) -> np.ndarray:
    """The numbers of the words of a text."""
    found = (text or "").split()
    return np.fromiter(map(words.__getitem__, found), np.int64, len(found))


def parts(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word rows (-1 without), shape rows and hashes of words' numbers."""
    return (numbers >> 41) - 1, numbers >> 32 & (_SHAPES - 1), numbers & 0xFFFFFFFF


def index_entries(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places and signs (n, ONES) of the index vectors of words with these 32-bit hashes."""
    k = np.arange(ONES)
    places = hashes[:, None] >> (5 * k)[None, :] & (DIM - 1)
    return places, 1 - 2 * (hashes[:, None] >> (20 + k)[None, :] & 1)


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> dict[str, int]:
    """The rows of the frequent words: all that occur at least as often as the least count that at most `size` words reach."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                held.update((text or "").split())
                if len(held) > _WORDS_KEPT:
                    yield pd.DataFrame([(w, n) for w, n in held.items() if len(w) <= _LONGEST], columns=["word", "n"])
                    held = Counter()
        yield pd.DataFrame([(w, n) for w, n in held.items() if len(w) <= _LONGEST], columns=["word", "n"])

    counts = docs.select("text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("step", F.floor(F.log("n") / _STEP)).persist()
    least, room = None, size
    for r in sorted(counts.groupBy("step").agg(F.count("*").alias("words")).collect(), reverse=True):  # one row a step
        room -= r["words"]
        if room < 0:
            break
        least = r["step"]
    found = [] if least is None else [r["word"] for r in counts.where(F.col("step") >= least).select("word").collect()]  # at most `size` rows
    counts.unpersist()
    return {w: _SHAPES + i for i, w in enumerate(sorted(found))}


def corpus_vectors(docs: DataFrame, rows: dict[str, int]) -> np.ndarray:
    """Vectors (rows of shapes and words, DIM) by random indexing over all texts of `docs`."""
    size = _SHAPES + len(rows)
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, table = Words(shared.value), np.zeros((size, DIM), np.int64)

        def add(ids: list[np.ndarray]) -> None:
            # Numbers of -1 between texts, whose index vectors are zero, keep them apart.
            pad = np.full(REACH, -1)
            flat = np.concatenate([pad, *[x for a in ids for x in (a, pad)]])
            rows, shapes, hashes = parts(flat)
            places, signs = index_entries(hashes)
            word, n = flat >= 0, len(flat)
            entries, at = np.zeros((n, DIM), np.int16), np.arange(n)
            for k in range(ONES):
                entries[at, places[:, k]] += (signs[:, k] * word).astype(np.int16)
            near = sum(entries[REACH + d : n - REACH + d] for d in range(-REACH, REACH + 1) if d)
            inner = slice(REACH, n - REACH)
            for row, ok in ((rows[inner], word[inner] & (rows[inner] >= 0)), (shapes[inner], word[inner])):
                order = np.argsort(row[ok], kind="stable")
                if len(order):
                    ranked = row[ok][order]
                    first = np.flatnonzero(np.diff(ranked, prepend=-1))
                    table[ranked[first]] += np.add.reduceat(near[ok][order], first, axis=0, dtype=np.int64)

        held, n = [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = tokens(text, words)
                for i in range(0, len(ids), _TOKENS):
                    held.append(ids[max(0, i - REACH) : i + _TOKENS])
                    n += len(held[-1])
                    if n >= _TOKENS:
                        add(held)
                        held, n = [], 0
        if held:
            add(held)
        used = np.flatnonzero(table.any(axis=1))
        out = pd.DataFrame(table[used], columns=[f"v{i}" for i in range(DIM)])
        out.insert(0, "row", used)
        yield out

    schema = "row long, " + ", ".join(f"v{i} long" for i in range(DIM))
    sums = docs.select("text").mapInPandas(run, schema).groupBy("row").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM)])
    out = np.zeros((size, DIM))
    for r in sums.collect():  # at most `size` rows
        out[r["row"]] = r[1:]
    out = np.sign(out) * np.sqrt(np.abs(out))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out


def pooled(text: str | None, vectors: np.ndarray, words: Words) -> np.ndarray:
    """A document's features."""
    ids = tokens(text, words)
    out = np.zeros(4 * DIM + 2)
    if not len(ids):
        return out
    different, count = np.unique(ids, return_counts=True)
    rows, shapes, _ = parts(different)
    known = rows >= 0
    of_shape = np.bincount(shapes, weights=count, minlength=_SHAPES)
    seen = np.flatnonzero(of_shape)
    for k, (used, n) in enumerate(((rows[known], count[known]), (seen, of_shape[seen]))):
        weight = n / len(ids)
        held = vectors[used]
        mean = weight @ held
        out[2 * k * DIM : (2 * k + 1) * DIM] = mean
        out[(2 * k + 1) * DIM : (2 * k + 2) * DIM] = np.sqrt(np.maximum(weight @ (held * held) - mean * mean, 0))
    out[4 * DIM] = len(different) / (len(ids) + 10)
    out[4 * DIM + 1] = np.sum(weight * weight)
    return out


class Network:
    """A two-layer network with a calibrated output."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, hidden: int = HIDDEN, epochs: int = EPOCHS):
        weight = np.ones(len(y)) if weight is None or not len(y) else weight / max(weight.mean(), 1e-12)
        self.base = float(np.average(y, weights=weight)) if len(y) else 0.5
        self.fitted = len(y) >= 20 and 0 < y.sum() < len(y)
        if not self.fitted:
            return
        rng = np.random.default_rng(SEED)
        held = np.arange(len(y)) % 5 == 4
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        fit_x, fit_y, fit_w = x[~held], y[~held], weight[~held]
        d = x.shape[1]
        p = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(epochs):
            order = rng.permutation(len(fit_y))
            for i in range(0, len(order), 128):
                rows = order[i : i + 128]
                a = fit_x[rows]
                h = np.tanh(a @ p[0] + p[1])
                z = h @ p[2] + p[3]
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - fit_y[rows]) * fit_w[rows] / len(rows)
                gh = np.outer(g, p[2]) * (1 - h * h)
                grads = [a.T @ gh + 1e-4 * p[0], gh.sum(axis=0), h.T @ g + 1e-4 * p[2], np.array([g.sum()])]
                step += 1
                for j, grad in enumerate(grads):
                    m[j] = 0.9 * m[j] + 0.1 * grad
                    v[j] = 0.999 * v[j] + 0.001 * grad * grad
                    p[j] = p[j] - 0.003 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        z, t, w = np.tanh(x[held] @ p[0] + p[1]) @ p[2] + p[3], y[held], weight[held]
        if 0 < t.sum() < len(t):
            q = lambda temperature: 1 / (1 + np.exp(-np.clip(z / temperature, -30, 30)))
            loss = lambda temperature: -np.sum(w * (t * np.log(q(temperature) + 1e-12) + (1 - t) * np.log(1 - q(temperature) + 1e-12)))
            self.temperature = float(min(np.geomspace(0.25, 8, 121), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.base)
        z = self.logit((x - self.mean) / self.scale)
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document are kept from training."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[dict[str, int], np.ndarray, Network]:
    """The vocabulary and vectors over all of `docs`, and the network fitted on a bounded sample of labelled rows."""
    known = vocabulary(docs)
    vectors = corpus_vectors(docs, known)
    usable = settled(labels, "quality").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long"), F.col("quality").alias("q"))
    classes = {r["q"]: r["n"] for r in usable.groupBy("q").agg(F.count("*").alias("n")).collect()}
    place = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id"), 11) / F.lit(2.0**53)
    share = F.when(F.col("q") == 1, fit_rows / max(1, classes.get(1, 0))).otherwise(fit_rows / max(1, classes.get(0, 0)))
    chosen = {r["doc_id"]: r["q"] for r in usable.where(place < share).collect()}  # about 2 * fit_rows rows, whatever the number of labels
    few = docs.sparkSession.createDataFrame(list(chosen.items()), "doc_id long, q int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(known)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [pooled(t, vectors, words) for t in batch["text"]]})

    found = rows.mapInPandas(features, "doc_id long, x array<double>").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    x, y = np.array([r["x"] for r in found]), np.array([chosen[r["doc_id"]] for r in found], float)
    # Each class weighs as much as it has usable labels, so that the score holds for the labels as they come.
    of = {q: classes.get(q, 0) / max(1, int((y == q).sum())) for q in (0, 1)}
    return known, vectors, Network(x, y, np.where(y == 1, of[1], of[0]))


def scan(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, fit_rows))

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, vectors, network = shared.value
        words = Words(known)
        for batch in batches:
            yield pd.Series(network(np.array([pooled(t, vectors, words) for t in batch]).reshape(len(batch), -1)))

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.pandas_udf(score, "double")("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
