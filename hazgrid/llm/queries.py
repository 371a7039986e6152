"""The registered query of each operator, with its production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import audit, bitslice, bpe, conversations, gridjoin, linededup, mixing, quality, rules, secrets, simhash, tokenfile, toxicity
from .common import in_fold, stored, table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        (in_fold() == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op3_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s.kind != "markov")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.KINDS],
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER).drop("text")
    return bpe.decoded(ids, TOKENIZER).select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    named = docs.withColumn("topic", mixing.topic()).withColumn("tokens", mixing.tokens()).drop("text")
    # read twice, so texts are looked through once
    return mixing.chances(stored(named, "mix-documents"), size="tokens").select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "tokens",
        F.round("chance", 6).alias("chance"),
        (mixing.draw() < F.col("chance")).alias("kept"),
    )


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gridjoin.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id",
        (in_fold() == 0).alias("held_out"),
        "expected_grade",
        F.element_at("tails", 1).alias("tail"),
        (F.element_at("tails", 1) >= 0.5).alias("kept"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    tokenfile.write(table(spark, sf_dir, "documents"), out, TOKENIZER)
    rows = tokenfile.checksums(tokenfile.read(spark, out))
    found = tokenfile.starts(rows, tokenfile.read(spark, out).select("shard", "n_tokens"))
    return found.select("doc_id", "start", F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids_crc32")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judged(docs, rules.fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", *rules.COUNTS, "base_failed", "kept", "score"
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damaged(rows))


QUERIES: tuple[Query, ...] = (
    op1_simhash_near_dedup,
    op2_toxicity,
    op3_top_k_search,
    op4_secret_scan,
    op5_bpe_encoding,
    op6_source_mixing,
    op7_embedding_near_dedup,
    op8_quality_classifier,
    op9_line_dedup,
    op10_token_files,
    op11_quality_rules,
    op12_filter_audit,
    op13_conversation_repair,
)

OP9_SQL = """
WITH docs AS (SELECT doc_id, text, coalesce(md5(text), '') AS m FROM documents),
lines AS (SELECT DISTINCT doc_id, m, string_split(text, chr(10)) AS l FROM docs WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, m, i, md5(array_to_string(l[i:i + 2], chr(10))) AS h
  FROM (SELECT doc_id, m, l, unnest(range(1, len(l) - 1)) AS i FROM lines WHERE len(l) >= 3)
  WHERE regexp_matches(array_to_string(l[i:i + 2], chr(10)), '[^ \t-\r]')
),
later AS (
  SELECT doc_id, m, i
  FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST, m, i) AS n FROM windows)
  WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, m, i + step AS i FROM later, (SELECT unnest([0, 1, 2]) AS step)),
each_line AS (SELECT doc_id, m, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM lines),
kept AS (
  SELECT e.doc_id, e.m, string_agg(e.line, chr(10) ORDER BY e.i) AS text FROM each_line e
  ANTI JOIN gone g ON e.doc_id IS NOT DISTINCT FROM g.doc_id AND e.m = g.m AND e.i = g.i GROUP BY ALL
),
counts AS (SELECT doc_id, m, count(*) AS n FROM gone GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS INTEGER) AS n_removed,
  CASE WHEN c.n IS NULL THEN sha256(d.text) ELSE sha256(coalesce(k.text, '')) END AS text_sha256
FROM docs d
LEFT JOIN counts c ON d.doc_id IS NOT DISTINCT FROM c.doc_id AND d.m = c.m
LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id AND d.m = k.m
"""


OP3_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS own, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, q.own, c.vec_id,
    CAST(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.own <> c.own WHERE q.vec_id % 20 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
first AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
said AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(
      CASE WHEN len(words) < 100 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END,
      CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 10 * length(w.text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(w.text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN first < w.doc_id THEN 'E' ELSE '' END
    ) AS fails
  FROM w JOIN first ON w.text = first.text LEFT JOIN said ON w.doc_id = said.doc_id
),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
s AS (SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT c.*, s.*, contains(fails, own) AS failing,
    len(list_filter(string_split(earlier, ''), lambda e: e <> '' AND contains(fails, e))) > 0 AS gone
  FROM c, s
),
g AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failing AND NOT gone THEN n * good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND NOT gone THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_top_k_search": OP3_SQL, "op9_line_dedup": OP9_SQL, "op12_filter_audit": OP12_SQL}
