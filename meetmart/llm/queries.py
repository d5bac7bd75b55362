"""Queries over the given tables for the operators of this package, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meetmart.llm import ann, audit, hmm, jaccard, langid, lexicon, licenses, packing, pii, quality_rff, simhash, trie, warc
from meetmart.llm.texts import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(read_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer)


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(read_table(spark, sf_dir, "pages"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(read_table(spark, sf_dir, "documents"))


def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_digest(read_table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours_of_every_20th(read_table(spark, sf_dir, "embeddings"))


#: Stands in for a secret from the run's own key store.
PII_KEY = "example key, replace in production"


def op8_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"), PII_KEY)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_digest(read_table(spark, sf_dir, "documents"))


def op10_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return lexicon.encode_digest(read_table(spark, sf_dir, "documents"), tokenizer)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interaction_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rff.quality_digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_packing, op3_warc_revisits, op4_ngram_jaccard, op5_language_mixture, op6_hidden_markov,
        op7_nearest_neighbours, op8_pii_pseudonyms, op9_simhash, op10_bpe_lexicon, op11_filter_audit,
        op12_quality_rff, op13_prefix_trie,
    )
}

# SQL for the operators whose whole result it can express

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32_sql(digest: str) -> str:
    """Four letters from every five hex digits."""

    def digit(at: int) -> str:
        return f"(strpos('0123456789abcdef', substr({digest}, {at}, 1)) - 1)"

    letters = []
    for k in range(0, 40, 5):
        bits = "0"
        for at in range(k + 1, k + 6):
            bits = f"({bits} * 16 + {digit(at)})"
        letters += [f"substr('{_BASE32}', (({bits} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(letters)


SQL: dict[str, str] = {
    "op3_warc_revisits": f"""
WITH r AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, strlen(payload) AS payload_bytes, {_base32_sql("h")} AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS last
  FROM r)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM d""",
    "op4_ngram_jaccard": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
    lambda i: array_to_string(words[i:i + 4], ' '))) AS grams
  FROM w WHERE len(words) > 0),
s AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM g),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
near AS (
  SELECT x, y, shared = nx AND shared = ny AS same FROM p
  WHERE shared >= 0.8 * (nx + ny - shared) - 1e-9),
copies AS (
  SELECT d.doc_id, least(d.doc_id, coalesce(min(near.y), d.doc_id)) AS copy_id, count(near.y) + 1 AS n_copies
  FROM documents d LEFT JOIN near ON near.x = d.doc_id AND near.same GROUP BY d.doc_id),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y),
classes AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
links AS (
  SELECT near.x, count(*) AS n_links, count(DISTINCT c.copy_id) FILTER (WHERE NOT near.same) AS n_link_classes
  FROM near JOIN copies c ON c.doc_id = near.y GROUP BY near.x)
SELECT copies.doc_id, class_id, copy_id, n_copies, coalesce(n_links, 0) AS n_links,
  coalesce(n_link_classes, 0) AS n_link_classes
FROM copies JOIN classes ON classes.x = copies.doc_id LEFT JOIN links ON links.x = copies.doc_id""",
    "op11_filter_audit": """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copy
  FROM documents),
m AS (
  SELECT doc_id, part,
    (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(copy, false)::INT AS mask
  FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM m LEFT JOIN l ON l.doc_id = m.doc_id GROUP BY part, mask),
p AS (
  SELECT '' AS o UNION ALL
  SELECT o || f FROM p, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) AS v(f) WHERE strpos(o, f) = 0),
s AS (
  SELECT o AS filter_order, step::INT AS step, substr(o, step, 1) AS letter, 1 << (ord(substr(o, step, 1)) - 65) AS bit,
    list_sum(list_transform(range(1, step + 1), lambda i: 1 << (ord(substr(o, i, 1)) - 65)))::INT AS after
  FROM p, range(1, 6) AS r(step) WHERE length(o) = 5),
x AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN mask & after = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & after = bit THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & after <> bit THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & after = bit THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & after = bit THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM x""",
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(x ORDER BY k) AS own FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, own, xor(list_reduce(flatten(list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda i: [ord(substr(conv_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
    4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h
  FROM o),
r AS (
  SELECT h.conv_id, coalesce(o.own, [])[1:h] || h.own[h + 1:] AS turns
  FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, turns[1:d] AS key, d, d = len(turns) AS ends FROM r, range(0, 100000) AS g(d) WHERE d <= len(turns)),
n AS (
  SELECT key, d, count(*) AS n_convs, min(conv_id) AS conv_id, (n_convs - 1) * coalesce(strlen(key[d].text), 0) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY key, d),
c AS (SELECT key[1:d - 1] AS key, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
e AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c ON c.key = n.key AND c.d = n.d),
b AS (
  SELECT v.key, v.d, sum(u.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
  FROM e v JOIN e u ON u.d >= v.d AND u.key[1:v.d] = v.key GROUP BY v.key, v.d)
SELECT e.conv_id, e.d AS depth, q.conv_id AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens, e.ends_sha256
FROM e JOIN b ON b.key = e.key AND b.d = e.d LEFT JOIN e q ON q.d = e.d - 1 AND q.key = e.key[1:e.d - 1]""",
}
