"""Registered queries of this subpackage, with their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .bpe import token_digests
from .common import table
from .conversation_trie import conversation_trie
from .decontaminate import benchmark_hits
from .fingerprint import edited_fingerprints
from .hard_negatives import mine_hard_negatives
from .html_extraction import extract_pages
from .sharding import shard_documents
from .simhash_dedup import simhash_groups
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import fit_toxicity, score_documents
from .url_filter import derived_captures, derived_events, filter_urls
from .warc import archive_round_trip

#: The vocabulary of op5 and of the pipeline's last stage.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=200) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), min_words=5, extend=True)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), VOCABULARY)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=40)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"), radius=3)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(derived_captures(pages), derived_events(pages))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_sharding": op4_sharding,
    "op5_bpe": op5_bpe,
    "op6_warc": op6_warc,
    "op7_fingerprints": op7_fingerprints,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_html_extraction": op11_html_extraction,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
}

# Words are runs of ASCII letters, digits and non-ASCII characters.
_SHINGLES = """
  SELECT DISTINCT {id}, unnest(CASE WHEN len(ws) = 0 THEN []
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM (SELECT {id}, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws
        FROM {table})"""

SQL: dict[str, str] = {
    "op2_url_filter": r"""
WITH c AS (
  SELECT page_id, url, regexp_replace(regexp_extract(lower(coalesce(url, '')),
           '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.$', '') AS host,
         DATE '2024-01-01' + CAST(('0x' || substr(md5('f' || url), 1, 7))::BIGINT % 366 AS INTEGER) AS fetch_date
  FROM pages),
h AS (SELECT DISTINCT host FROM c WHERE url IS NOT NULL AND host <> ''),
a AS (SELECT host, DATE '2024-01-01' + CAST(('0x' || substr(md5('a' || host), 1, 7))::BIGINT % 200 AS INTEGER) AS d
      FROM h WHERE ('0x' || substr(md5('c' || host), 1, 7))::BIGINT % 3 = 0),
i AS (
  SELECT 'hosts' AS list_name, 'host:' || host AS pattern, d AS valid_from, d + 60 AS valid_to FROM a
  UNION ALL SELECT 'hosts', 'host:' || host, d + 120, NULL FROM a
  UNION ALL SELECT 'paths', 'path:' || host || '/en',
         DATE '2024-01-01' + CAST(('0x' || substr(md5('q' || host), 1, 7))::BIGINT % 300 AS INTEGER), NULL
  FROM h WHERE ('0x' || substr(md5('p' || host), 1, 7))::BIGINT % 10 = 0),
u AS (SELECT DISTINCT url, host, fetch_date FROM c WHERE url IS NOT NULL),
x AS (
  SELECT url, fetch_date, unnest(list_concat(
      list_transform(range(1, len(string_split(host, '.')) + 1),
                     lambda k: 'host:' || array_to_string(string_split(host, '.')[k:], '.')),
      list_transform(range(1, len(p) + 1), lambda k: 'path:' || host || '/' || array_to_string(p[1:k], '/')))) AS pattern
  FROM (SELECT *, list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/'),
                              lambda s: s <> '') AS p FROM u)),
m AS (
  SELECT url, fetch_date, count(DISTINCT list_name) AS n_lists,
         min(struct_pack(list_name := list_name, pattern := i.pattern, valid_from := valid_from)) AS hit
  FROM x JOIN i ON x.pattern = i.pattern AND valid_from <= fetch_date AND (valid_to IS NULL OR fetch_date < valid_to)
  GROUP BY url, fetch_date)
SELECT c.page_id, c.host, c.fetch_date, CASE WHEN hit IS NULL THEN 'allowed' ELSE 'blocked' END AS verdict,
       coalesce(n_lists, 0) AS n_lists, hit.list_name AS list_name, hit.pattern AS pattern,
       hit.valid_from AS valid_from
FROM c LEFT JOIN m ON c.url = m.url AND c.fetch_date = m.fetch_date""",
    "op10_decontaminate": f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id),
p AS (SELECT d.doc_id, b.item_id, count(*) AS shared_shingles FROM d JOIN b USING (g) GROUP BY ALL)
SELECT doc_id, item_id, item_shingles, shared_shingles,
       CAST(shared_shingles AS DOUBLE) / item_shingles AS containment
FROM p JOIN n USING (item_id) WHERE shared_shingles >= ceil(round(0.8 * item_shingles, 9))""",
    "op12_hard_negatives": """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS positive_id, list_dot_product(a.v, b.v)::BIGINT AS positive_score
  FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, b.vec_id) <= 5),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS negative_id, list_dot_product(a.v, b.v)::BIGINT AS negative_score
  FROM e a JOIN e b ON a.label <> b.label WHERE a.vec_id % 100 = 0)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM p JOIN s USING (anchor_id)
WHERE 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
QUALIFY rank <= 10""",
    # CRC-32 by its table: eight shifts for each byte, then one look-up a digit
    "op13_conversation_trie": r"""
WITH steps AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(struct_pack(role := role, text := text)
                 ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS path
  FROM turns GROUP BY c),
convs AS (
  SELECT c, path, c - c % 20 AS base, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) % 4 AS h
  FROM own, steps),
paths AS (
  SELECT a.c, list_concat(coalesce(b.path[1:h], []), a.path[h + 1:]) AS path
  FROM convs a LEFT JOIN own b ON b.c = a.base),
steps_of AS (SELECT c, path, len(path) AS n_turns, unnest(range(len(path) + 1)) AS d FROM paths),
keyed AS (
  SELECT c, d, n_turns, CASE WHEN d > 0 THEN sha256(path[1:d]::JSON::VARCHAR) ELSE '' END AS k,
         CASE WHEN d > 1 THEN sha256(path[1:d - 1]::JSON::VARCHAR) ELSE '' END AS up,
         CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
  FROM steps_of),
nodes AS (
  SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN d = n_turns THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM keyed GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT a.d, a.k, count(*) FILTER (WHERE kids.k IS NULL) AS n_leaves, sum((n.n - 1) * n.words) AS saved
  FROM nodes n LEFT JOIN kids USING (d, k) JOIN keyed a ON a.c = n.conv_id AND a.d <= n.d GROUP BY a.d, a.k)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s USING (d, k) LEFT JOIN kids USING (d, k)
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up""",
}
