"""One registered query per operator, on its whole table with production settings."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from revrank.llm.common import table
from revrank.llm.language_id import held_out, identify, train_filters
from revrank.llm.license_scan import labelled_paragraphs, scan_licenses, train_license_model
from revrank.llm.mixing import mix_sources
from revrank.llm.near_dedup import near_duplicates
from revrank.llm.order_minhash import fingerprints
from revrank.llm.periodic_runs import longest, periodic_runs, repeated_tail
from revrank.llm.pii import scan_pii, span_text
from revrank.llm.registry import query
from revrank.llm.secret_scan import labelled_findings, scan_secrets, train_secret_forest
from revrank.llm.sentencepiece_bpe import encoding_digests
from revrank.llm.token_alignment import align_tokenizers
from revrank.llm.token_files import token_file_digests, write_token_files
from revrank.llm.topk_search import top_k
from revrank.llm.url_filter import judge_urls, labelled_urls, train_url_filter

URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


@query("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, URL_RULES, train_url_filter(labelled_urls(spark)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


OP8_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix|' || doc_id::VARCHAR), 1, 13))::BIGINT AS k
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w FROM totals),
grown AS (
  SELECT *, 3 * source_size AS most,
         sum(3 * source_size) OVER o - 3 * source_size AS capped, sum(w) OVER o - w AS gone,
         sum(source_size) OVER () AS total, sum(w) OVER () AS weights, row_number() OVER o AS place
  FROM weighted WINDOW o AS (ORDER BY 3.0 * source_size / w, source IS NULL, source ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT arg_min(CAST(total - capped AS DOUBLE) / CAST(weights - gone AS DOUBLE), place) AS level FROM grown
  WHERE CAST(most AS DOUBLE) > CAST(total - capped AS DOUBLE) / CAST(weights - gone AS DOUBLE) * w),
targets AS (
  SELECT source, source_size, least(CAST(most AS DOUBLE), coalesce((SELECT level FROM levels), 0) * w) AS target
  FROM weighted JOIN (SELECT source AS s2, most FROM grown) ON source IS NOT DISTINCT FROM s2),
placed AS (
  SELECT doc_id, size, source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start,
         CAST(floor(target + 0.5) AS BIGINT) AS budget
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END::BIGINT AS taken
FROM placed
"""

OP5_SQL = r"""
WITH parts AS (
  SELECT vec_id, len(embedding) AS n, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
usable AS (SELECT vec_id FROM parts GROUP BY vec_id, n HAVING count(CASE WHEN isfinite(v) THEN 1 END) = n),
x AS (SELECT vec_id, i, floor(v * 256)::BIGINT AS v FROM parts SEMI JOIN usable USING (vec_id)),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.v * c.v)::BIGINT AS score
  FROM x q JOIN x c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, r::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores) WHERE r <= 5
"""

OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
numbered AS (SELECT doc_id, s, count(*) OVER (PARTITION BY s) AS docs FROM shingles),
-- Two sets that are 0.8 alike share one of the rarest floor(n / 5) + 1 shingles of either.
rare AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY docs, s) AS r FROM numbered)
  JOIN sizes USING (doc_id) WHERE r <= n // 5 + 1),
pairs AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b ON a.s = b.s AND a.doc_id < b.doc_id),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  JOIN shingles f ON f.doc_id = p.a JOIN shingles g ON g.doc_id = p.b AND g.s = f.s
  GROUP BY p.a, p.b, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON l.a = r.b)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id, d.doc_id = least_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reached GROUP BY a) USING (doc_id)
"""


@query("op8_mix_sources", OP8_SQL)
def op8_mix_sources(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_license_scan")
def op2_license_scan(spark, sf_dir):
    model = train_license_model(labelled_paragraphs(spark))
    return scan_licenses(table(spark, sf_dir, "documents"), model)


@query("op3_secret_scan")
def op3_secret_scan(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"), train_secret_forest(labelled_findings(spark)))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    filters = train_filters(docs.filter(~held_out()))
    return identify(docs, filters).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "evidence")


@query("op5_topk_search", OP5_SQL)
def op5_topk_search(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


@query("op6_pii")
def op6_pii(spark, sf_dir):
    found = scan_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "terms"))).alias("spans"),
    )


@query("op7_near_duplicates", OP7_SQL)
def op7_near_duplicates(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_sentencepiece")
def op9_sentencepiece(spark, sf_dir):
    return encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op10_fingerprints")
def op10_fingerprints(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH bits AS (SELECT range(8) AS eight),
hashed AS (
  SELECT doc_id, text, xor(list_reduce(
      list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, c: list_reduce(list_transform(eight, lambda b: b::BIGINT),
        lambda a, b: xor(a >> 1, (a & 1) * 3988292384), xor(crc, c)), 4294967295), 4294967295) AS h
  FROM documents, bits),
words AS (
  SELECT doc_id, h, h // 10 AS g, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM hashed),
tails AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM words),
texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
         list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS w
  FROM tails),
placed AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
matches AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM placed x JOIN placed y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l),
gone AS (SELECT DISTINCT r.doc_id, p.i FROM runs r JOIN placed p ON p.doc_id = r.doc_id AND p.i >= r.s + r.q AND p.i < r.s + r.l),
collapsed AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = p.doc_id AND g.i = p.i) GROUP BY doc_id),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY l DESC, s, q) AS r FROM runs) WHERE r = 1)
SELECT d.doc_id, coalesce(t.n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.l::BIGINT AS length, b.q::BIGINT AS period,
       (1000 * b.l // b.q)::BIGINT AS exponent_milli,
       sha256(coalesce(t.t, '')) AS runs_sha256, sha256(coalesce(c.t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN told t USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN collapsed c USING (doc_id)
"""


@query("op11_periodic_runs", OP11_SQL)
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), rewrite=repeated_tail)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", longest("runs"))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


@query("op12_token_alignment")
def op12_token_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_token_files")
def op13_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_file_digests(write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
