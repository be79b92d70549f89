"""The operators applied to the test tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm import decontamination, extraction, host_rules, language_model, lexical_search, mixing, prefix_trie, quality, simhash, surrogates, token_files, toxicity, url_filter
from pairwright.llm.common import crc_fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Where the tokenizer file lies; the folder is a parameter of the operators.
TOKENIZER = "word_bpe_49k.json"


def register(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return keep


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''))) AS o FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT source, n, 2.0::DOUBLE * n AS cap, CASE r % 3 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
-- Sources reach their caps in the order of cap / weight; before the first that does not, all earlier ones are full.
f AS (SELECT *, coalesce(sum(cap) OVER q, 0) AS full_before, (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER q, 0) AS free,
  1.5::DOUBLE * (SELECT sum(n) FROM w) AS total FROM w
  WINDOW q AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT min_by((total - full_before) / free, cap / weight) FILTER (WHERE (total - full_before) / free * weight <= cap) AS level FROM f),
t AS (SELECT source, n, CASE WHEN level IS NULL OR level * weight > cap THEN cap ELSE level * weight END AS target FROM w, l),
p AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE CAST(floor(target / n) AS BIGINT) END AS whole FROM t),
q AS (SELECT *, CAST(floor(target - whole * n + 0.5) AS BIGINT) AS part FROM p)
SELECT d.doc_id, d.size, d.source, q.n AS source_size, round(q.target, 4) AS target,
 CAST(q.whole * d.size + greatest(0, least(d.size, q.part - coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, d.size
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
"""


@register("op1_mix_sources", MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn("target", F.round("target", 4))


@register("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@register("op6_simhash_classes")
def op6_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


# Each text's windows and lines are numbered and grouped by document, as the rule says it.
HOST_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rn, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT rn, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
dup AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT rn, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT rn, i, lead(i) OVER (PARTITION BY rn ORDER BY i) AS nxt FROM dup) GROUP BY rn),
lines AS (SELECT rn, l FROM (SELECT rn, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dl AS (SELECT rn, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY rn),
c AS (SELECT rn, doc_id, host, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dl USING (rn) LEFT JOIN cov USING (rn)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
h AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f FROM j GROUP BY host),
a AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS k, sum(f * f / n) AS ff, sum(n * n) AS nn FROM h),
m AS (SELECT f / n AS m, f / n * (1 - f / n) AS ch, (ff - f * (f / n) - (k - 1) * (f / n) * (1 - f / n)) / greatest(n - nn / n, 1) AS sp FROM a),
p AS (SELECT m, CASE WHEN ch > 0 THEN greatest(ch / greatest(sp, ch * 1e-6) - 1, 1) ELSE 1 END AS st FROM m),
v AS (SELECT host, (f + m * st) / (n + st) AS host_rate FROM h, p)
SELECT doc_id, j.host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(host_rate, 9) AS host_rate,
  NOT base_failed AND NOT host_rate > 0.5 AS kept
FROM j JOIN v ON j.host IS NOT DISTINCT FROM v.host
"""


@register("op5_host_rules", HOST_SQL)
def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(table(spark, sf_dir, "documents"))


# Verdict and host with path, as the task fixes them.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


@register("op9_redirect_filter")
def op9_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, URL_RULES))


@register("op8_toxicity_scores")
def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "toxic", fold=5)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op2_quality_scores")
def op2_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", fold=5)
    scored = quality.with_score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))


@register("op10_benchmark_leaks")
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_lm_scores")
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_corpus(table(spark, sf_dir, "documents"), fold=7, holdout=2)


# A key for the test tables; a real one is kept apart from code and data.
PII_KEY = "test-key"


@register("op3_pii_surrogates")
def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(table(spark, sf_dir, "documents"), PII_KEY)


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (SELECT it, item_id, t, count(*) AS repeats FROM (SELECT row_number() OVER () AS it, item_id,
  unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY it, item_id, t),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
tf AS (SELECT rn, doc_id, n, t, count(*) AS tf FROM (SELECT rn, doc_id, len(ts) AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY rn, doc_id, n, t),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s GROUP BY t, nd),
x AS (SELECT it, item_id, rn, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
  FROM tf JOIN w USING (t) JOIN q USING (t), s GROUP BY it, item_id, rn, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY it ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0) WHERE rank <= 20
"""


@register("op13_lexical_search", SEARCH_SQL)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# crc32 bit by bit: a byte is added (a number from 0), then eight steps (-1) follow.
TRIE_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, left(sha256(concat(CAST(strlen(r) AS VARCHAR), ':', r, x)), 32) AS dg, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM t),
c AS (SELECT conv_id, list({'d': dg, 'w': w} ORDER BY turn NULLS FIRST, dg, w) AS l FROM k GROUP BY conv_id),
h AS (SELECT conv_id, l, CAST(xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
  lambda s: [ord(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END), 4294967295::BIGINT) % 4 AS INT) AS h FROM c),
b AS (SELECT h.conv_id, list_concat(coalesce(p.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN c p ON p.conv_id = h.conv_id - h.conv_id % 20),
e AS (SELECT conv_id, len(l) AS n, l, unnest(range(0, len(l) + 1)) AS depth FROM b),
p AS (SELECT conv_id, n, depth, md5(array_to_string(list_transform(l[1:depth], lambda x: x.d), '')) AS path,
  md5(array_to_string(list_transform(l[1:depth - 1], lambda x: x.d), '')) AS above, CASE WHEN depth > 0 THEN l[depth].w ELSE 0 END AS w FROM e),
n AS (SELECT path, any_value(above) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends FROM p GROUP BY path, depth),
ch AS (SELECT above AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above, depth),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (path, depth)),
m AS (SELECT path, depth, any_value(l) AS l FROM (SELECT p.path, p.depth, e.l FROM p JOIN e USING (conv_id, depth)) GROUP BY path, depth),
u AS (SELECT f.path, f.depth, n_convs, w, n_children, l, unnest(range(0, f.depth + 1)) AS up FROM f JOIN m USING (path, depth)),
s AS (SELECT md5(array_to_string(list_transform(l[1:up], lambda x: x.d), '')) AS path, up AS depth, sum((n_convs - 1) * w) AS saved, sum(CAST(n_children = 0 AS INT)) AS leaves FROM u GROUP BY ALL)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s ON s.path = f.path AND s.depth = f.depth LEFT JOIN f a ON f.depth > 0 AND a.path = f.above AND a.depth = f.depth - 1
"""


@register("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_nodes(table(spark, sf_dir, "conversations"))


@register("op12_extract_text")
def op12_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract_text(pages, extraction.train(pages))
