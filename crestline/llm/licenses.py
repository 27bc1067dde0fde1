"""License scans: TF-IDF cosine to licence templates, then inheritance along directories.

A text's statements are its lines, its paragraphs, its leading comment block, and the whole of it. Each gets the cosine
between its TF-IDF vector (1 + ln count, times the inverse document frequency) and those of the templates; document
frequencies of the templates' terms are counted over all documents, and each different term no template has weighs as one
seen nowhere that stands once.
The whole text decides if it reaches `file_score`, then the leading comments if they do, then the best line or
paragraph if it reaches `line_score`. A row is a licence file if its file name is one of FILE_NAMES and its text says a
licence, or if its whole text is one, and speaks for its directory. Rows without a licence of their own take
that of the nearest directory above them that has one, by joins on paths. A notice of reserved rights
(RESERVED) is a licence of its own, so its row inherits nothing; it yields to any grant the text states.

Most statements need no cosine. By the Cauchy-Schwarz inequality a statement's cosine to a template is at most the length of
the template's unit vector over the terms they share, times the share of the statement's own length that lies in
terms of templates. So where the squared weights of its terms, each the greatest of any template, add up to less than
`line_score` squared, no template is within reach: that is asked of a document first. Of its statements it is asked
with the second factor as well. The bounds leave out nothing that could score.

Everything is built from DataFrame functions; vectors are sparse and local to a row, so no text
is shuffled. The templates are a fixed list, so what each row is held against is bounded. Directories with many rows are
dealt to many tasks.

Cases: null text has no licence; null path has no directory and inherits nothing; very long texts are one row's work;
between equally good templates the first by name wins, between statements of one text the highest score, then the last
name, between licence files of one directory the best score, then the first by name; repeated rows are judged alike;
an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.llm.common import computed_once, cut, hot_keys, joined, text_of
from crestline.llm.licence_texts import RESERVED, templates

#: The names of licence files, and how comment lines start.
FILE_NAMES = ["license", "licence", "copying", "notice", "copyright", "unlicense"]
COMMENT = r"\A(?:[ \t]*(?:#|//|/?\*|--|;|%)[^\n]*(?:\n|\z)|[ \t]*\n)+"
LINE_SCORE, FILE_SCORE = 0.6, 0.9
TERM = r"[a-z0-9+]+(?:[.-]+[a-z0-9+]+)*"
#: What stands between paragraphs: a line without letters or digits.
_GAP = r"\n[^a-zA-Z0-9\n]*\n"


def terms(text: str) -> list[str]:
    return re.findall(TERM, text.lower())


def terms_of(text: Column) -> Column:
    """The terms of a text, as `terms` has them."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


TEMPLATES = [(k, terms(t)) for k, t in templates()]
NAMES = sorted({k for k, _ in TEMPLATES})
VOCABULARY = sorted({t for _, ts in TEMPLATES for t in ts})


def frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """The number of documents, and of those that have each term of VOCABULARY: a bounded number of rows."""
    found = F.filter(F.array_distinct(terms_of(text_of())), lambda t: t.isin(VOCABULARY))
    # The empty term stands for the document itself.
    rows = docs.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    counts = {r["term"]: r["n"] for r in rows.collect()}
    return counts.pop("", 0), counts


def weights(n: int, df: dict[str, int]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Inverse document frequencies, that of a term seen nowhere, and the templates' unit vectors."""
    idf = {t: math.log((1 + n) / (1 + df.get(t, 0))) + 1 for t in VOCABULARY}
    unit = []
    for _, ts in TEMPLATES:
        v = {t: (1 + math.log(c)) * idf[t] for t, c in Counter(ts).items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        unit.append({t: x / length for t, x in v.items()})
    return idf, math.log(1 + n) + 1, unit


def _constant(values: list, kind: str) -> Column:
    """A constant array, whatever its length."""
    return F.split(F.lit(" ".join(map(repr if kind == "double" else str, values))), " ").cast(f"array<{kind}>")


def _stats(found: Column, places: Column) -> Column:
    """Of an array of terms: (place, weight of the count) of those in VOCABULARY, and the number of different others."""
    known = F.filter(found, lambda t: t.isin(VOCABULARY))
    weighed = lambda ts: F.transform(
        F.array_distinct(ts),
        lambda t: F.struct(F.array_position(places, t).cast("int").alias("at"), (1 + F.log(F.size(F.filter(ts, lambda u: u == t)))).alias("tf")),
    )
    others = F.size(F.array_distinct(F.filter(found, lambda t: ~t.isin(VOCABULARY))))
    return F.struct(F.transform(F.array(known), weighed)[0].alias("known"), others.alias("others"))


def _best(stats: Column, idf: dict[str, float], unseen: float, unit: list[dict[str, float]]) -> Column:
    """struct(score, licence) of the best template for the stats of some terms."""
    order = sorted(range(len(TEMPLATES)), key=lambda i: (TEMPLATES[i][0], i))
    scale = _constant([idf[t] for t in VOCABULARY], "double")
    table = F.array(*[_constant([unit[i].get(t, 0.0) * idf[t] for t in VOCABULARY], "double") for i in order])
    zero, known = F.lit(0.0), stats["known"]
    square = F.aggregate(known, zero, lambda a, e: a + F.pow(e["tf"] * F.element_at(scale, e["at"]), F.lit(2.0)))
    length = F.sqrt(square + stats["others"] * (unseen * unseen))
    scores = F.transform(
        table,
        lambda row, i: F.struct(
            F.round(F.aggregate(known, zero, lambda a, e: a + e["tf"] * F.element_at(row, e["at"])) / length, 9).alias("score"), (-i).alias("order")
        ),
    )
    names = _constant([TEMPLATES[i][0] for i in order], "string")
    top = F.transform(F.array(F.array_max(scores)), lambda m: F.struct(m["score"].alias("score"), F.element_at(names, 1 - m["order"]).alias("licence")))
    return F.when(F.size(known) > 0, top[0])


def scan(files: DataFrame, ids: list[str], line_score: float = LINE_SCORE, file_score: float = FILE_SCORE) -> DataFrame:
    """`ids`, path, licence, score, via ('file', 'header', 'inherited', 'none') and inherited_from of every row.

    `files` has the columns `ids`, path and text.
    """
    idf, unseen, unit = weights(*frequencies(files))
    most = {t: max(u.get(t, 0.0) ** 2 for u in unit) for t in VOCABULARY}
    places, greatest = _constant(VOCABULARY, "string"), _constant([most[t] for t in VOCABULARY], "double")

    def reach(shared: Column, table: Column) -> Column:
        return F.aggregate(shared, F.lit(0.0), lambda a, t: a + F.element_at(table, F.array_position(places, t).cast("int")))

    def can_score(text: Column) -> Column:
        """Whether the squared weights of a text's terms add up to the least score: if not, no template is within reach."""
        shared = F.array_distinct(F.filter(terms_of(text), lambda t: t.isin(VOCABULARY)))
        return reach(shared, greatest) >= line_score * line_score - 1e-9

    def may_score(text: Column) -> Column:
        """Whether a statement can reach the least score, given the different terms it has that no template has."""
        squares = _constant([idf[t] ** 2 for t in VOCABULARY], "double")

        def judge(found: Column) -> Column:
            shared = F.array_distinct(F.filter(found, lambda t: t.isin(VOCABULARY)))
            own = F.pow(1 + F.log(F.greatest(F.size(found), F.lit(1))), F.lit(2.0)) * reach(shared, squares)
            others = F.size(F.array_distinct(found)) - F.size(shared)
            return reach(shared, greatest) * own >= (line_score * line_score - 1e-9) * (own + others * (unseen * unseen))

        return F.transform(F.array(terms_of(text)), judge)[0]

    rows = files.select(*ids, "path", F.when(can_score(text_of()), text_of()).alias("_t"))
    rows = computed_once(rows)
    parts = F.concat(F.split("_t", "\n"), F.filter(F.split("_t", _GAP), lambda p: p.contains("\n")))
    said = F.when(F.col("_t").isNotNull(), F.filter(parts, may_score))
    head = F.regexp_extract("_t", COMMENT, 0)
    measure = lambda text: _stats(terms_of(text), places)
    rows = rows.withColumns({
        "_said": F.transform(said, measure), "_all": F.when(may_score(F.col("_t")), measure(F.col("_t"))),
        "_lead": F.when((F.length(head) > 0) & may_score(head), measure(head)),
    })
    best = lambda stats: _best(stats, idf, unseen, unit)
    rows = rows.withColumn("_said", F.transform("_said", best))
    granted = F.filter("_said", lambda b: (b["score"] >= line_score) & (b["licence"] != RESERVED))
    line = F.coalesce(F.array_max(granted), F.array_max("_said"))
    scored = lambda c: F.when(F.col(c).isNotNull(), best(F.col(c)))
    rows = computed_once(rows.select(*ids, "path", line.alias("_line"), scored("_all").alias("_whole"), scored("_lead").alias("_lead")))
    name = F.lower(F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1))
    named = F.regexp_replace(name, r"[.-].*$", "").isin(FILE_NAMES)
    reaches = lambda c, s: F.coalesce(F.col(f"{c}.score") >= s, F.lit(False))
    whole, lead, says = reaches("_whole", file_score), reaches("_lead", file_score), reaches("_line", line_score)
    is_file = whole | (named & (lead | says | reaches("_whole", line_score)))
    own = F.when(whole, F.col("_whole")).when(lead, F.col("_lead")).when(says, F.col("_line")).when(is_file, F.col("_whole"))
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    rows = cut(rows.select(*ids, "path", own.alias("_own"), is_file.alias("_is_file"), folder.alias("_dir"), F.monotonically_increasing_id().alias("_n")))
    held = rows.where(F.col("_is_file") & F.col("_dir").isNotNull()).groupBy(F.col("_dir").alias("_up")).agg(
        F.max_by("_own", F.struct(F.col("_own.score"), -F.array_position(F.lit(NAMES), F.col("_own.licence")))).alias("_given")
    )
    steps = F.split("_dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("up")))
    counts = rows.where("_dir is not null").groupBy("_dir").agg(F.count("*").alias("m"))
    dirs = counts.select("_dir", F.inline(F.array_distinct(above)))
    near = dirs.join(held, dirs["up"] == held["_up"]).groupBy("_dir").agg(F.max_by(F.struct("_given", "up"), "depth").alias("_near"))
    placed = rows.where("_dir is not null")
    found = joined(placed, near, ["_dir"], F.col("_n"), hot_keys(counts, ["_dir"], rows.count()), "left").drop("_n")
    lost = rows.where("_dir is null").drop("_n").withColumn("_near", F.lit(None).cast(found.schema["_near"].dataType))
    found = found.unionByName(lost)
    via = F.when(F.col("_own").isNotNull() & F.col("_is_file"), "file").when(F.col("_own").isNotNull(), "header").when(F.col("_near").isNotNull(), "inherited").otherwise("none")
    taken = F.coalesce(F.col("_own"), F.col("_near._given"))
    return found.select(*ids, "path", taken["licence"].alias("licence"), taken["score"].alias("score"), via.alias("via"), F.when(via == "inherited", F.col("_near.up")).alias("inherited_from"))
