"""The operators as queries over the given tables, with their results in SQL where SQL has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import table
from . import (
    char_perplexity,
    cover_tree,
    disclosure,
    golay_simhash,
    pareto_mix,
    path_ratios,
    piece_codec,
    prefix_trie,
    recompression,
    subword_toxicity,
    topk_products,
    url_rules,
    whitening,
)

# Fixed values of the contract.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MODEL = "piece_bpe_32k.model"


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op1_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = pareto_mix.mix_report(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_golay_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return golay_simhash.near_duplicates(table(spark, folder, "documents"))


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    judged = url_rules.judge_pages(table(spark, folder, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.digests(table(spark, folder, "documents"), model_path())


def op5_topk_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk_products.top_products(table(spark, folder, "embeddings"))


def op6_subword_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return subword_toxicity.score(docs, subword_toxicity.fit(docs, table(spark, folder, "labels")))


def op7_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.find(table(spark, folder, "documents"))


def op8_path_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return path_ratios.extract(table(spark, folder, "pages"))


def op9_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, folder, "documents")).drop("kept")


def op10_char_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    judged = char_perplexity.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pareto_mix,
        op2_golay_simhash,
        op3_url_rules,
        op4_piece_codec,
        op5_topk_products,
        op6_subword_toxicity,
        op7_disclosure,
        op8_path_ratios,
        op9_recompression,
        op10_char_perplexity,
        op11_cover_tree,
        op12_prefix_trie,
        op13_whitening,
    )
}

# The rules as literals: both are the contract's, not read from each other.
_OP3 = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN regexp_replace(substr(url, strpos(url, '://') + 3), '(?s)[?#].*$', '') ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id, coalesce(rest, '') AS rest,
    translate(split_part(coalesce(rest, ''), '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(coalesce(rest, ''), length(split_part(coalesce(rest, ''), '/', 1)) + 1) AS path
  FROM parts
), judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

_OP5 = """
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 10
"""

# For tables whose vec_ids are their own, as the given ones.
_OP11 = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS size FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) / (a.size * b.size) >= 0.95
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT r.vec_id, coalesce(any_value(c.n), 0) AS n_links, min(r.other) AS component_id, min(r.other) = r.vec_id AS kept
FROM reach r LEFT JOIN counts c USING (vec_id) GROUP BY r.vec_id
"""

# crc32 bit by bit, then prefixes as lists of turns; a node's subtree is found through its own conversation's prefixes.
_OP12 = r"""
WITH given AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM given)
), turns AS (
  SELECT c.conv_id, g.place, 0 AS late, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.base AND g.place <= c.h
  UNION ALL
  SELECT c.conv_id, g.place, 1, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.conv_id AND g.place > c.h
), built AS (
  SELECT c.conv_id, coalesce(list({'r': t.role, 't': t.text} ORDER BY t.late, t.place) FILTER (t.place IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN turns t USING (conv_id) GROUP BY c.conv_id
), prefixes AS (
  SELECT conv_id, depth, path[1:depth] AS node, depth = len(path) AS last FROM built, unnest(range(len(path) + 1)) AS d(depth)
), nodes AS (
  SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN min(depth) = 0 THEN 0 ELSE len(regexp_extract_all(node[-1].t, '[^\x20\x09-\x0D]+')) END AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), trie AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children, p.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN children c ON c.node = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
), sums AS (
  SELECT p.node, sum((t.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((t.n_convs - 1) * t.words)::BIGINT AS saved_tokens
  FROM trie t JOIN prefixes p ON p.conv_id = t.conv_id AND p.depth <= t.depth GROUP BY p.node
)
SELECT t.conv_id, t.depth, t.parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
FROM trie t JOIN sums s USING (node)
"""

ORACLE: dict[str, str] = {
    "op3_url_rules": _OP3,
    "op5_topk_products": _OP5,
    "op11_cover_tree": _OP11,
    "op12_prefix_trie": _OP12,
}
