"""The queries of this subpackage on the given tables, and the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    decontaminate,
    divergence,
    grid_join,
    license_scan,
    line_dedup,
    minhash,
    mixing,
    pii,
    prefix_trie,
    site_quality,
    token_count,
    token_output,
    top_products,
)
from terrace.plans.registry import table
from terrace.session import scratch_path

Build = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test items in documents."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_items(docs, benchmark)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed so that a source weighs its size to the power 0.7."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, and the occurrence that stays of its group."""
    return line_dedup.line_decisions(table(spark, sf_dir, "documents")).drop("row")


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; its source is the host and its language the path."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = site_quality.classify(docs, labels)
    return found.select(F.col("doc.doc_id").alias("doc_id"), *found.columns[1:])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_count.count_tokens(table(spark, sf_dir, "documents"), model)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document among its near copies."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("spans")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written and read back."""
    path = scratch_path(spark, "op8")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_output.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary, end_id=1)
    return token_output.token_digest(spark, path)


def op9_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest five of every fiftieth vector by inner product."""
    return top_products.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.report(table(spark, sf_dir, "documents"))


def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.9."""
    return grid_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    turns = prefix_trie.turn_table(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.rebuilt(turns)).drop("key")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the words of each source differ from other sources and from its language."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Build] = {
    "op1_decontamination": op1_decontamination,
    "op2_mixing": op2_mixing,
    "op3_line_dedup": op3_line_dedup,
    "op4_site_quality": op4_site_quality,
    "op5_token_counts": op5_token_counts,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_license_scan": op7_license_scan,
    "op8_token_output": op8_token_output,
    "op9_top_products": op9_top_products,
    "op10_pii": op10_pii,
    "op11_embedding_duplicates": op11_embedding_duplicates,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_source_divergence": op13_source_divergence,
}

_OP2 = """
WITH counts AS (SELECT source, count(*) AS n, pow(count(*), 0.7) AS weight FROM documents GROUP BY source),
rates AS (
    SELECT source, (sum(n) OVER ()) * weight / (sum(weight) OVER ()) / n AS rate FROM counts
),
drawn AS (SELECT *, greatest(ceil(rate / 256), 1) AS draws FROM rates),
below AS (
    SELECT source, draws, sum(exp(k * ln(rate / draws) - rate / draws - lgamma(k + 1)))
        OVER (PARTITION BY source ORDER BY k) AS c
    FROM drawn, range(0, 500) AS steps(k)
),
uniform AS (
    SELECT d.doc_id, d.source, j,
        ('0x' || substr(md5('0|' || d.doc_id || '|' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents d JOIN drawn USING (source), LATERAL (SELECT unnest(range(1, draws::BIGINT + 1)) AS j)
),
copies AS (
    SELECT doc_id, sum((SELECT count(*) FROM below b WHERE b.source = u.source AND b.c <= u.u)) AS n
    FROM uniform u GROUP BY doc_id
),
exploded AS (SELECT doc_id, unnest(range(1, n::BIGINT + 1))::INTEGER AS copy FROM copies)
SELECT d.*, e.copy, md5('0|order|' || d.doc_id || '|' || e.copy) AS mix_key
FROM documents d JOIN exploded e USING (doc_id)
"""

_OP9 = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""

_OP6 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(
        string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'),
        lambda w: w <> '') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(
            range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b USING (shingle)
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.other = links.x
)
SELECT doc_id, len(s) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM sets JOIN reached USING (doc_id) GROUP BY doc_id, s
"""

_OP11 = r"""
WITH RECURSIVE whole AS (
    SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v FROM embeddings
),
good AS (
    SELECT row, vec_id, v FROM whole
    WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.row AS x, b.row AS y FROM good a JOIN good b
        ON a.row <> b.row AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reached(row, other) AS (
    SELECT row, row FROM whole
    UNION
    SELECT reached.row, links.y FROM reached JOIN links ON reached.other = links.x
),
named AS (SELECT r.row, min(w.vec_id) AS component_id FROM reached r JOIN whole w ON w.row = r.other GROUP BY r.row),
counts AS (SELECT x AS row, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM whole JOIN named USING (row) LEFT JOIN counts USING (row)
"""

_OP12 = r"""
WITH RECURSIVE numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, b: list_reduce(range(8), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
            xor(crc, b)),
        4294967295), 4294967295) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM numbered)
),
turns AS (
    SELECT c.conv_id, n.place, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.place <= c.h
    UNION ALL
    SELECT c.conv_id, n.place, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.place > c.h
),
rebuilt AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, text,
        sha256(length(role) || '|' || role || text) AS symbol
    FROM turns
),
prefixes AS (
    SELECT conv_id, 0::BIGINT AS depth, '' AS path, '' AS parent, '' AS text FROM convs
    UNION ALL
    SELECT conv_id, depth, string_agg(symbol, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path,
        coalesce(string_agg(symbol, '') OVER (
            PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS parent, text
    FROM rebuilt
),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent,
        any_value(strlen(text)) AS bytes
    FROM prefixes GROUP BY path, depth
),
children AS (SELECT parent AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
above AS (
    SELECT path AS top, path, parent, depth FROM nodes
    UNION ALL
    SELECT n.path, a.path, a.parent, a.depth FROM above a JOIN nodes n ON a.top <> '' AND n.path = substr(a.top, 1, length(a.top) - 64)
),
sums AS (
    SELECT top AS path, sum(CASE WHEN c.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
        sum((c.n_convs - 1) * c.bytes) AS saved_tokens
    FROM above JOIN counted c ON c.path = above.path GROUP BY top
),
lasts AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM prefixes JOIN lasts USING (conv_id, depth) GROUP BY path
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves::BIGINT AS n_leaves,
    s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN sums s USING (path) LEFT JOIN ends e USING (path)
    LEFT JOIN nodes p ON c.depth > 0 AND p.path = c.parent
"""

_OP13 = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
        coalesce(source, '') AS source
    FROM documents
),
occurrences AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
),
cells AS (SELECT lang, source, term, doc, count(*) AS n FROM occurrences GROUP BY ALL),
kept AS (
    SELECT lang, term, sum(n) AS lang_count FROM cells GROUP BY lang, term HAVING count(*) >= 10
),
langs AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, sum(n) AS n FROM cells JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n,
        (1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (coalesce(total, 0) + 2 * v))::HUGEINT AS p,
        (1 + 1000000000::HUGEINT * (lang_count + 2) // (lang_total + 2 * v))::HUGEINT AS q
    FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
        LEFT JOIN counts USING (lang, source, term) LEFT JOIN totals USING (lang, source)
),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
),
terms AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
    FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value,
    (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
FROM pairs
UNION ALL
SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
        (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
    FROM terms
) WHERE rank <= 10
"""

ORACLE: dict[str, str] = {
    "op11_embedding_duplicates": _OP11,
    "op12_conversation_trie": _OP12,
    "op13_source_divergence": _OP13,
    "op6_near_duplicates": _OP6,
    "op9_top_products": _OP9,
    "op2_mixing": _OP2,
}
