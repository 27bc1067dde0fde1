"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm import bpe, chat, fingerprints, langid, licenses, mixing, near_dedup, quality_model, quality_rules, sharding
from crestline.llm.common import read

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.scan(read(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: source/lang/doc_id, "_" for what is null."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang", "doc_id")])
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"), ["doc_id"])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.scan(langid.from_documents(read(spark, sf_dir, "documents"), ["doc_id"]))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.scan(langid.from_pages(read(spark, sf_dir, "pages"), ["page_id"]))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.linked(read(spark, sf_dir, "documents"), width=2, percent=80)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op10_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_fingerprints, op2_license_scan, op3_language_id, op4_quality_classifier, op5_bpe, op6_quality_rules,
        op7_near_dedup, op8_mixing, op9_sharding, op10_chat_rotation, page_language_id,
    ]
    return {f.__name__: f for f in own}


_CHAT_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE role END AS name, coalesce(text, '') AS text
  FROM conversations
), who AS (SELECT DISTINCT conv_id AS c, name AS speaker FROM said WHERE name <> 'system' AND conv_id IS NOT NULL),
seen AS (
  SELECT s.*, w.speaker FROM said s JOIN who w ON s.conv_id = w.c
  UNION ALL SELECT *, name FROM said WHERE conv_id IS NULL AND name <> 'system'
), seated AS (
  SELECT conv_id, turn, name, speaker, replace(text, '<|', '<\|') AS text,
    CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant' ELSE 'user' END AS seat
  FROM seen
), headed AS (
  SELECT *, '<|im_start|>' || seat || CASE WHEN seat = 'user' THEN ' name=' || translate(replace(name, '<|', '<\|'), chr(10) || chr(13), '  ') ELSE '' END || chr(10) AS head
  FROM seated
)
SELECT conv_id, speaker, turn, seat, name, head || text || '<|im_end|>' || chr(10) AS segment, name = speaker AS learned,
  length(head)::BIGINT AS span_start,
  (length(head) + CASE WHEN name = speaker THEN length(text) + 10 ELSE 0 END)::BIGINT AS span_end
FROM headed
"""

_RULES_SQL_GRID = ", ".join(f"('{m}', {c!r})" for m, cs in quality_rules.GRID.items() for c in cs)
_RULES_SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), win AS (
  SELECT doc_id, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS x
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) > 2)
), twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS r FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper, len(l)::BIGINT AS n_lines
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id
), b AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols / greatest(word_chars, 1) AS symbol_share, n_repeat_words / greatest(n_words, 1) AS repeat_share,
    n_dup_lines / greatest(n_lines, 1) AS dup_line_share, n_upper / greatest(word_chars, 1) AS caps_share,
    word_chars / greatest(n_words, 1) AS mean_word
  FROM m
), u AS (SELECT doc_id, lang, base_failed, measure, value FROM b UNPIVOT (value FOR measure IN (symbol_share, repeat_share, dup_line_share, caps_share, mean_word))),
sure AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
held AS (SELECT u.*, quality FROM u JOIN sure USING (doc_id) WHERE NOT base_failed AND lang IS NOT NULL),
tried AS (
  SELECT lang, h.measure, cutoff, count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality = 1 AND value > cutoff) AS lost,
    count(*) FILTER (quality = 0 AND value > cutoff) AS caught
  FROM held h JOIN (VALUES {_RULES_SQL_GRID}) g(measure, cutoff) ON h.measure = g.measure GROUP BY ALL
), tested AS (
  SELECT *, CASE WHEN lost > good * {quality_rules.RISK} THEN 1.0 ELSE list_sum(list_transform(range(0, lost + 1), lambda i:
    exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({quality_rules.RISK}) + (good - i) * ln(1 - {quality_rules.RISK})))) END AS tail,
    (SELECT count(DISTINCT lang) FROM held) AS strata
  FROM tried WHERE good > 0
), best AS (
  SELECT lang, measure, cutoff FROM tested WHERE tail <= {quality_rules.DELTA} / (strata * {len(quality_rules.GRID)}) AND caught > 0
  QUALIFY row_number() OVER (PARTITION BY lang, measure ORDER BY caught DESC, lost, cutoff DESC) = 1
), bad AS (SELECT DISTINCT u.doc_id FROM u JOIN best ON u.lang = best.lang AND u.measure = best.measure WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM b
"""

_NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1]) END) AS x FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.doc_id WHERE r.c < u.b),
c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op10_chat_rotation": _CHAT_SQL, "op6_quality_rules": _RULES_SQL, "op7_near_dedup": _NEAR_SQL}
