"""Registered queries of this package and the SQL that expresses some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from stationflow.llm import (
    html, lexical, lines, merkle, mixing, packing, quality, search, simhash, token_files, toxicity, urls, vectors,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in Huffman-coded blocks and read back."""
    return token_files.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 1)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.main_text(_table(spark, sf_dir, "pages"))


def op4_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of every embedding."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of 4096 ids."""
    return packing.packed_pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), 2)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth embedding among all others."""
    return search.top_k(_table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urls.judge_urls(_table(spark, sf_dir, "pages"))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has."""
    return lines.line_report(_table(spark, sf_dir, "documents"), from_files=True)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and version of every document."""
    return merkle.manifest_report(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_token_files, op3_html, op4_vector_duplicates, op5_packing, op6_top_k, op7_simhash, op8_mixing,
        op9_url_filter, op10_lines, op11_lexical_search, op12_merkle, op13_quality,
    )
} | {"pipeline": corpus_pipeline.run}

_SPACE = r"[\x20\x09-\x0D]"
_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: CRC-32 of the decimal doc_id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295], [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))
))"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


#: SQL for DuckDB, where it expresses the query.
CORPUS_ORACLE: dict[str, str] = {
    # all pairs by brute force, and all that they reach
    "op4_vector_duplicates": """
        WITH RECURSIVE v AS (
            SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e
            FROM embeddings
            WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
              AND len([x FOR x IN embedding IF x <> 0]) > 0
        ), l AS (
            SELECT p.vec_id AS a, q.vec_id AS b
            FROM v AS p JOIN v AS q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e)
            WHERE list_cosine_similarity(p.e, q.e) >= 0.95
        ), reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT r.a, l.b FROM reach AS r JOIN l ON r.b = l.a
        )
        SELECT r.a AS vec_id, (SELECT count(*) FROM l WHERE l.a = r.a) AS n_links, min(r.b) AS component_id,
            r.a = min(r.b) AS kept
        FROM reach AS r GROUP BY r.a
    """,
    # whole vectors by brute force
    "op6_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    # clauses with the white space behind them, and from each the run of 30 words or more
    "op10_lines": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(text, '(?s).*?[.!?,;][\x20\x09-\x0D]+|(?s).+$') AS u FROM documents),
        l AS (SELECT doc_id, unnest(u) AS piece, generate_subscripts(u, 1) AS i FROM d),
        c AS (
            SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop,
                trim(regexp_replace(translate(piece, {_ASCII}), '{_SPACE}+', ' ', 'g')) AS norm FROM l
        ), w AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
                CAST(sum(length(norm) - length(replace(norm, ' ', '')) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto
            FROM c WHERE norm <> ''
        ), p AS (
            SELECT w.doc_id, w.k, min(v.k) AS last FROM w
            JOIN w AS v ON v.doc_id = w.doc_id AND v.k BETWEEN w.k AND w.k + 30
                AND v.upto >= w.upto - (length(w.norm) - length(replace(w.norm, ' ', '')) + 1) + 30
            GROUP BY w.doc_id, w.k
        ), n AS (
            SELECT p.doc_id, p.k, p.last, string_agg(v.norm, ' ' ORDER BY v.k) AS passage
            FROM p JOIN w AS v ON v.doc_id = p.doc_id AND v.k BETWEEN p.k AND p.last GROUP BY p.doc_id, p.k, p.last
        ), r AS (SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, k) > 1 AS again FROM n),
        g AS (
            SELECT DISTINCT w.doc_id, w.i FROM r JOIN w ON w.doc_id = r.doc_id AND w.k BETWEEN r.k AND r.last WHERE again
        ), m AS (
            SELECT c.doc_id, c.i, c.piece, c.stop - length(c.piece) AS start, c.stop, g.i IS NOT NULL AS gone
            FROM c LEFT JOIN g ON g.doc_id = c.doc_id AND g.i = c.i
        ), s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - row_number() OVER (PARTITION BY doc_id, gone ORDER BY i) AS run FROM m),
        x AS (SELECT doc_id, min(start) AS a, max(stop) AS b FROM s WHERE gone GROUP BY doc_id, run),
        y AS (SELECT doc_id, count(*) AS n_removed, string_agg(a || ':' || b, ',' ORDER BY a) AS removed FROM x GROUP BY doc_id),
        t AS (SELECT doc_id, string_agg(piece, '' ORDER BY i) AS text FROM m WHERE NOT gone GROUP BY doc_id)
        SELECT documents.doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
            coalesce(y.n_removed, 0) AS n_removed, coalesce(y.removed, '') AS removed
        FROM documents LEFT JOIN t ON t.doc_id = documents.doc_id LEFT JOIN y ON y.doc_id = documents.doc_id
    """,
    # every document against every item
    "op11_lexical_search": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, {_ASCII}), '{_TERM}') AS t FROM documents),
        s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS length FROM d WHERE len(t) > 0),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_ASCII}), '{_TERM}')) AS term FROM benchmark),
        f AS (
            SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d)
            WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term
        ), w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term, n_docs),
        p AS (
            SELECT doc_id, f.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // length))) AS part
            FROM f JOIN w ON f.term = w.term, s
        ), r AS (
            SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN p ON q.term = p.term
            GROUP BY item_id, doc_id HAVING sum(part) > 0
        ), k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
    """,
    # the trees node by node, and each document's path
    "op12_merkle": rf"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(f"translate(text, {_ASCII})")} AS other,
                {_CRC32} % 3 = 0 AS tampered,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
            FROM documents
        ), tree AS (
            SELECT lang, 0 AS level, i, leaf AS node, n FROM leaves
            UNION ALL
            SELECT lang, level + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8
            FROM tree WHERE n > 1 GROUP BY lang, level, i // 8, n
        ), subroots AS (
            SELECT lang, node, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1
        ), top AS (
            SELECT 0 AS level, i, node, n FROM subroots
            UNION ALL
            SELECT level + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8
            FROM top WHERE n > 1 GROUP BY level, i // 8, n
        ), beside AS (
            SELECT l.doc_id, t.level, t.i, t.node, t.i < l.i // CAST(pow(8, t.level) AS BIGINT) AS before
            FROM leaves AS l JOIN tree AS t ON l.lang IS NOT DISTINCT FROM t.lang AND t.n > 1
                AND t.i // 8 = l.i // CAST(pow(8, t.level + 1) AS BIGINT) AND t.i <> l.i // CAST(pow(8, t.level) AS BIGINT)
            UNION ALL
            SELECT l.doc_id, s.height + t.level, t.i, t.node, t.i < s.i // CAST(pow(8, t.level) AS BIGINT)
            FROM leaves AS l JOIN subroots AS s ON l.lang IS NOT DISTINCT FROM s.lang
                JOIN top AS t ON t.n > 1
                AND t.i // 8 = s.i // CAST(pow(8, t.level + 1) AS BIGINT) AND t.i <> s.i // CAST(pow(8, t.level) AS BIGINT)
        ), paths AS (
            SELECT doc_id, level, coalesce(string_agg(node, '' ORDER BY i) FILTER (WHERE before), '') AS lefts,
                coalesce(string_agg(node, '' ORDER BY i) FILTER (WHERE NOT before), '') AS rights
            FROM beside GROUP BY doc_id, level
        ), steps AS (
            SELECT l.doc_id, g.level, coalesce(p.lefts, '') AS lefts, coalesce(p.rights, '') AS rights, g.level + 1 = g.height AS last
            FROM (
                SELECT l.doc_id, s.height + t.height AS height, unnest(range(s.height + t.height)) AS level
                FROM leaves AS l JOIN subroots AS s ON l.lang IS NOT DISTINCT FROM s.lang, (SELECT max(level) AS height FROM top) AS t
            ) AS g JOIN leaves AS l ON l.doc_id = g.doc_id LEFT JOIN paths AS p ON p.doc_id = g.doc_id AND p.level = g.level
        ), folded AS (
            SELECT doc_id, 0 AS level, CASE WHEN tampered THEN other ELSE leaf END AS node FROM leaves
            UNION ALL
            SELECT f.doc_id, f.level + 1, sha256(s.lefts || f.node || s.rights)
            FROM folded AS f JOIN steps AS s ON s.doc_id = f.doc_id AND s.level = f.level
        ), proofs AS (SELECT doc_id, sha256(coalesce(string_agg(lefts || rights, '' ORDER BY level), '')) AS proof FROM steps GROUP BY doc_id),
        ends AS (SELECT doc_id, max_by(node, level) AS node FROM folded GROUP BY doc_id)
        SELECT l.doc_id, l.leaf, s.node AS subroot, r.node AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
            e.node AS folded_root, e.node = r.node AS verified
        FROM leaves AS l JOIN subroots AS s ON l.lang IS NOT DISTINCT FROM s.lang JOIN ends AS e ON e.doc_id = l.doc_id
            LEFT JOIN proofs AS p ON p.doc_id = l.doc_id, (SELECT node FROM top WHERE n = 1) AS r
    """,
}
