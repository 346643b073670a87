"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import bpe, conversations, divergence, exact, fingerprint, language, mixing, near, ngram_lm, pieces, repeats, secrets, urls
from tidewright.llm.common import documents
from tidewright.session import scratch_path



def public_file(name: str, variable: str) -> str:
    """A public tokenizer's file: the one that ``variable`` names, else the installed one."""
    if variable in os.environ:
        return os.environ[variable]
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return f"/opt/tokenizers/{name}"
    return public_tokenizers.path(name)


#: tokenizer files, installed at the same place on every machine
TOKENIZER = public_file("word_bpe_49k.json", "WORD_BPE_FILE")
PIECES = public_file("piece_bpe_32k.model", "PIECE_BPE_FILE")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_exact_dedup(spark, sf_dir):
    return exact.copy_groups(documents(spark, sf_dir))


SQL["op7_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM d
"""


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op3_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.judge_urls(pages, urls.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


SQL["op3_url_filter"] = """
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT h || p FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY length(h) DESC, length(p) DESC LIMIT 1) AS rule,
       coalesce((SELECT v FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
                 ORDER BY length(h) DESC, length(p) DESC LIMIT 1), 'allow') AS verdict
FROM u
"""


@query
def op4_secrets(spark, sf_dir):
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    of = lambda kind: F.filter("secrets", lambda x: x["kind"] == kind)
    spelled = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "random")],
        F.sha2(spelled(F.filter("secrets", lambda x: x["kind"] != "random")).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("secrets")).alias("spans"),
    )


#: Sources are flattened until one is seen four times as often as another; blocks of a million tokens.
MAX_REPEAT, BLOCK_TOKENS = 4.0, 1 << 20


@query
def op2_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.token_count().alias("tokens"))
    return mixing.mix(docs, text_col=None, tokens=F.col("tokens"), max_repeat=MAX_REPEAT, block_tokens=BLOCK_TOKENS)


SQL["op2_mixing"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS k, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')), 1) AS tokens FROM documents),
s AS (SELECT k, count(*) AS docs, sum(tokens)::BIGINT AS t FROM d GROUP BY k),
p AS (SELECT *, t / sum(t) OVER () AS share FROM s),
e AS (SELECT max(share) / min(share) AS spread FROM p),
a AS (SELECT CASE WHEN spread <= {MAX_REPEAT} THEN 0.0 ELSE 1 - ln({MAX_REPEAT}) / ln(spread) END AS a FROM e),
w AS (SELECT k, docs, t, pow(share, a) AS power FROM p, a),
q AS (SELECT k, docs, t, round(max(t / power) OVER () * power)::BIGINT AS quota FROM w),
n AS (SELECT greatest(1, round(sum(quota) / {BLOCK_TOKENS}.0))::BIGINT AS blocks FROM q),
x AS (SELECT d.*, q.t, q.quota, unnest(range(ceil(q.quota / q.t)::BIGINT)) AS epoch FROM d JOIN q USING (k)),
y AS (SELECT *, epoch * t + coalesce(sum(tokens) OVER (PARTITION BY k, epoch ORDER BY md5('0|' || epoch || '|' || id), tokens
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM x),
z AS (SELECT y.*, (start * blocks) // quota AS block FROM y, n WHERE start < quota)
SELECT doc_id, source, tokens, epoch, block::BIGINT AS block,
       row_number() OVER (PARTITION BY block ORDER BY md5('0|block|' || epoch || '|' || id), tokens) AS position
FROM z
"""


@query
def op1_bpe(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", bpe.round_trip(F.col("text"), TOKENIZER).alias("coded"))
    return docs.select("doc_id", "coded.ids", "coded.decoded").select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op10_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", language.held_out("doc_id", 4, 2).alias("held_out"))
    model = language.train(docs.where("not held_out").select("text", "lang"))
    return docs.select("doc_id", "held_out", language.predict(F.col("text"), model).alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


@query
def op9_near_dedup(spark, sf_dir):
    return near.near_classes(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op5_fingerprints(spark, sf_dir):
    found = fingerprint.edited_fingerprints(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query
def op8_lm_scores(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = language.held_out("doc_id", 7, 2)
    trie = ngram_lm.train(docs.where(~out), min_count=1)
    return ngram_lm.score(docs, trie).select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(trie.total).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op6_repeats(spark, sf_dir):
    done = repeats.drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_sentencepiece(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", pieces.round_trip(F.col("text"), PIECES).alias("coded"))
    return docs.select("doc_id", "coded.ids", "coded.decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_repair(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = conversations.damage(given)
    path = scratch_path(spark, "repair-report")
    conversations.report(rows, given).write.parquet(path)
    reports = spark.read.parquet(path)
    return reports.alias("r").join(conversations.digests(rows, reports).alias("d"), F.expr("r.conv_id <=> d.conv_id")).select("r.*", "d.repaired_sha256")


@query
def op13_divergence(spark, sf_dir):
    return divergence.audit(documents(spark, sf_dir))


SQL["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS tokens
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, row, unnest(tokens) AS term FROM d),
k AS (SELECT lang, term, count(*) AS whole FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
v AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, count(*) AS cnt FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY t.lang, t.source, t.term),
gn AS (SELECT g.lang, g.source, coalesce(sum(cnt), 0) AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.cnt, 0) AS cnt,
         1 + (1000000000::HUGEINT * (coalesce(c.cnt, 0) + 2)) // (gn.n + 2 * v.v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (k.whole + 2)) // (v.n + 2 * v.v)::HUGEINT AS q
  FROM gn JOIN v ON gn.lang = v.lang JOIN k ON k.lang = gn.lang
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
tops AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE cnt > 0 AND p > q),
r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM tops) AS both_parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
