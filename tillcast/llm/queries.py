"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.decontaminate import contaminated
from tillcast.llm.filter_audit import filter_audit
from tillcast.llm.fingerprints import fingerprints
from tillcast.llm.html_main import extract_main_text, fit_labeller, page_sample
from tillcast.llm.language import fit_languages, language_sample, predict_languages
from tillcast.llm.licenses import licenses_of
from tillcast.llm.mixing import mix_sources
from tillcast.llm.near_dedup import near_duplicates
from tillcast.llm.neighbours import nearest
from tillcast.llm.prefix_trie import prefix_trie
from tillcast.llm.quality import fit_quality, quality_sample, score_quality
from tillcast.llm.revisits import captures, resolve_revisits
from tillcast.llm.sampling import crc_of
from tillcast.llm.sharding import shard_documents

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_minhash_near_dedup(spark, sf_dir):
    """doc_id, n_shingles, component_id, kept of every document (4-word shingles, 80 %)."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@query
def op7_language_id(spark, sf_dir):
    """doc_id, held_out, lang_pred, score of every document; rows of remainder 2 are never learnt from."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_of("doc_id") % 4 == 2, F.lit(False))
    model = fit_languages(language_sample(docs.where(~held)))
    return predict_languages(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op1_benchmark_decontamination(spark, sf_dir):
    """One row per document and test item found in it, with the closest occurrence."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_mix_sources(spark, sf_dir):
    """Place of every document in the mix of the sources."""
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op5_balanced_sharding(spark, sf_dir):
    """Shard 0 to 15 and slot of every document, counts at most one apart."""
    return shard_documents(table(spark, sf_dir, "documents"))


@query
def op2_warc_revisits(spark, sf_dir):
    """Every not-modified revisit derived from the pages, with the response it refers to."""
    r = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    h = F.col("headers")
    return r.select("record_id", "canonical_url", "status", "response_id", "captured", "response_captured",
                    h["etag"].alias("etag"), h["last-modified"].alias("last_modified"),
                    h["cache-control"].alias("cache_control"), h["content-length"].alias("content_length"),
                    F.md5("payload").alias("payload_md5"))


@query
def op4_license_scan(spark, sf_dir):
    """One row per document and license notice found in it."""
    return licenses_of(table(spark, sf_dir, "documents"))


@query
def op8_html_main_text(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract_main_text(pages, fit_labeller(page_sample(pages))).select("page_id", "url", "text", "n_chars")


@query
def op9_nearest_vectors(spark, sf_dir):
    """The five nearest vectors of every fiftieth vector."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op10_compression_quality(spark, sf_dir):
    """Quality score of every document; rows of remainder 0 are never learnt from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(crc_of("doc_id") % 5 == 0, F.lit(False))
    sample, share = quality_sample(docs.where(~held), labels.where(~held))
    return score_quality(docs, fit_quality(sample, share)).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op11_document_fingerprints(spark, sf_dir):
    """Threshold-scaled fingerprint of every document and of its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op12_conversation_prefix_trie(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_filter_interaction_audit(spark, sf_dir):
    """What each of the five filters removes at each step of all their 120 orders, by source."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op2_warc_revisits"] = r"""
WITH cut AS (
  SELECT page_id, html, regexp_replace(trim(url, ' '), '#.*$', '') AS u FROM pages
), part AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)),
                                          ':(80|443)$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
         regexp_replace(regexp_replace(regexp_extract(u, '\?(.*)$', 1),
                                       '(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '', 'g'), '^&', '') AS q,
         '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag, 'day-' || (page_id % 97) AS day
  FROM cut
), page AS (
  SELECT *, CASE WHEN host = '' THEN u ELSE 'https://' || host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical_url
  FROM part
), response AS (
  SELECT page_id * 3 AS id, canonical_url, page_id * 10 AS captured, CASE WHEN page_id % 5 <> 3 THEN tag END AS etag,
         day AS lm, 'max-age=60' AS cc, CAST(strlen(html) AS VARCHAR) AS cl, md5(coalesce(html, '')) AS body
  FROM page WHERE page_id % 11 <> 5
), revisit AS (
  SELECT page_id * 3 + 1 AS record_id, canonical_url, page_id * 10 + 7 AS captured,
         CASE WHEN page_id % 4 <> 1 THEN 'W/' || tag END AS etag, CASE WHEN page_id % 7 <> 2 THEN day END AS lm,
         'max-age=' || (page_id % 600) AS cc FROM page
  UNION ALL
  SELECT page_id * 3 + 2, canonical_url, page_id * 10 + 14,
         CASE WHEN page_id % 6 = 0 THEN '"other"' WHEN page_id % 6 < 4 THEN tag END,
         CASE WHEN page_id % 3 <> 0 THEN 'day-x' END, 'no-cache' FROM page
), met AS (
  SELECT r.*, s.id, s.captured AS s_captured, s.etag AS s_etag, s.lm AS s_lm, s.cc AS s_cc, s.cl AS s_cl, s.body,
         CASE WHEN s.id IS NULL THEN 'missing'
              WHEN r.etag IS NOT NULL AND s.etag IS NOT NULL
                THEN CASE WHEN regexp_replace(r.etag, '^W/', '') = regexp_replace(s.etag, '^W/', '') THEN 'resolved' ELSE 'changed' END
              WHEN r.lm IS NOT NULL AND s.lm IS NOT NULL THEN CASE WHEN r.lm = s.lm THEN 'resolved' ELSE 'changed' END
              ELSE 'unchecked' END AS status
  FROM revisit r ASOF LEFT JOIN response s ON r.canonical_url = s.canonical_url AND r.captured > s.captured
)
SELECT record_id, canonical_url, status, id AS response_id, captured, s_captured AS response_captured,
       CASE WHEN status = 'resolved' THEN coalesce(etag, s_etag) ELSE etag END AS etag,
       CASE WHEN status = 'resolved' THEN coalesce(lm, s_lm) ELSE lm END AS last_modified, cc AS cache_control,
       CASE WHEN status = 'resolved' THEN s_cl ELSE '0' END AS content_length,
       CASE WHEN status = 'resolved' THEN body END AS payload_md5
FROM met
"""

LOWER_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SKETCH = """list_sort(list_filter(list_distinct(CASE WHEN len({w}) = 0 THEN [] WHEN len({w}) < 3 THEN [substr(md5(array_to_string({w}, ' ')), 1, 12)]
         ELSE list_transform(range(1, len({w}) - 1), lambda i: substr(md5({w}[i] || ' ' || {w}[i + 1] || ' ' || {w}[i + 2]), 1, 12)) END), lambda x: x < '2'))"""
LIKENESS = """CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN CASE WHEN {same} THEN 1.0 ELSE 0.0 END
         ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE) / least(len({a}), len({b})) END"""

ORACLES["op11_document_fingerprints"] = f"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(coalesce(text, ''))) AS pos FROM documents
), cut AS (
  SELECT a.doc_id, a.pos, a.t, b.t AS nt, left(a.t, length(a.t) - length(a.t) // 2) || left(b.t, length(a.t) // 2) AS e, b.pos AS npos
  FROM doc a JOIN doc b ON b.pos = CASE WHEN a.pos = (SELECT max(pos) FROM doc) THEN 1 ELSE a.pos + 1 END
), words AS (
  SELECT *, {LOWER_WORDS.format(text='t')} AS w, {LOWER_WORDS.format(text='e')} AS ew FROM cut
), sketch AS (
  SELECT *, {SKETCH.format(w='w')} AS f, {SKETCH.format(w='ew')} AS ef FROM words
)
SELECT s.doc_id, length(s.t) AS n_chars, sha256(s.e) AS edited_sha256, array_to_string(s.f, '') AS fingerprint,
  array_to_string(s.ef, '') AS edited_fingerprint, {LIKENESS.format(a='s.f', b='s.ef', same='s.t = s.e')} AS near_edited,
  {LIKENESS.format(a='s.f', b='n.f', same='s.t = n.t')} AS near_next
FROM sketch s JOIN sketch n ON n.pos = s.npos
"""

ORACLES["op12_conversation_prefix_trie"] = """
WITH RECURSIVE crc AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS v
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
  UNION ALL
  SELECT conv_id, s, k + 1, xor(w >> 1, CASE WHEN w % 2 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(v, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE v END AS w
        FROM crc WHERE k < 8 * length(s))
), h AS (
  SELECT conv_id, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = 8 * length(s)
), own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), conv AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS seq
  FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefix AS (
  SELECT conv_id, d, seq[1:d] AS p, len(seq) AS size FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM conv)
), node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n, max(size) = d AS leaf,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(p[d].t) END AS saved FROM prefix GROUP BY p, d
), below AS (
  SELECT a AS d, p[1:a] AS p, sum(saved) AS saved, count(*) FILTER (leaf) AS leaves, count(*) FILTER (d = a + 1) AS children
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM node) GROUP BY ALL
), ends AS (
  SELECT seq AS p, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest FROM conv GROUP BY seq
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, CAST(b.children AS BIGINT) AS n_children,
  CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM node n JOIN below b ON n.d = b.d AND n.p = b.p LEFT JOIN ends e ON e.p = n.p
LEFT JOIN node u ON n.d > 0 AND u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""

ORACLES["op13_filter_interaction_audit"] = r"""
WITH label AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
), failed AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM doc d LEFT JOIN label l ON d.doc_id = l.doc_id
), met AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), ord AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), step AS (SELECT o, s, substr(o, s, 1) AS x FROM ord, (SELECT unnest(range(1, 6)) AS s)
), gone AS (
  SELECT met.*, o, s, x, contains(fails, x) AS bad, length(translate(fails, substr(o, 1, s - 1), '')) < length(fails) AS before
  FROM met, step
), row AS (
  SELECT part, o, s, x, sum(CASE WHEN NOT bad AND NOT before THEN n ELSE 0 END) AS kept, sum(CASE WHEN bad AND NOT before THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN bad AND before THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN bad AND NOT before THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN bad AND NOT before THEN toxic ELSE 0 END) AS toxic_lost
  FROM gone GROUP BY ALL
)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM row
"""
