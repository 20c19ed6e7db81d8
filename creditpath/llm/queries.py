"""One registered query per operator, over its whole table, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditpath.llm import alignment, ann, bpe, ctw, hard_negatives, html_extract, langid, near_dups, packing, pii, quality, suffix_dedup, url_filters
from creditpath.llm.common import id_remainder, read_table

#: Folder of the public tokenizers; their files are parameters and never copied here.
TOKENIZERS = "/opt/tokenizers"


def vocabulary_path(name: str) -> str:
    return f"{TOKENIZERS}/{name}"


RANKS = vocabulary_path("byte_bpe_50k.tiktoken")
PIECES = vocabulary_path("piece_bpe_32k.model")


def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every vector whose id is divisible by 50."""
    return ann.search(read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op2_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's crc32 isn't 0 modulo 10, scores all."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 10) == 0
    return ctw.score_documents(docs.select("doc_id", "text", held_out.alias("held_out")), docs.where(~held_out).select("text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge_documents(docs, read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose id's crc32 isn't 0 modulo 5, predicts all from their texts alone."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 5) == 0
    model = langid.learn(docs.where(~held_out).select("text", "lang"))
    found = langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents")).drop("redacted")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), RANKS)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(read_table(spark, sf_dir, "documents"), RANKS)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are rows whose id is divisible by 100; where it is divisible by 7, the label is the next one of ten."""
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("id") % 100 == 0)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by a 100-byte string that also starts earlier in the corpus go."""
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), RANKS, PIECES).documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest_vectors": op1_nearest_vectors,
    "op2_ctw_score": op2_ctw_score,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_url_filters": op5_url_filters,
    "op6_personal_data": op6_personal_data,
    "op7_html_text": op7_html_text,
    "op8_packing": op8_packing,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLES: dict[str, str] = {
    "op5_url_filters": """
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(verdict, h, p) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
           ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), best AS (
    SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
    FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (n)
""",
    "op9_near_duplicates": r"""
WITH RECURSIVE cut AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
                    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM cut WHERE len(w) > 0
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL
), links AS (
    SELECT a, b, c = x.n AND c = y.n AS same
    FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
    WHERE 10 * c >= 8 * (x.n + y.n - c)
), reach(r, o) AS (
    SELECT r, r FROM cut
    UNION
    SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.o
), classes AS (
    SELECT reach.r, min(cut.doc_id) AS class_id FROM reach JOIN cut ON cut.r = reach.o GROUP BY reach.r
), counted AS (
    SELECT a AS r, count(*) AS n_links, count(*) FILTER (WHERE same) AS n_same FROM links GROUP BY a
)
SELECT doc_id, class_id, coalesce(n_same, 0) + 1 AS n_copies, coalesce(n_links, 0) AS n_links
FROM cut JOIN classes USING (r) LEFT JOIN counted USING (r)
""",
    "op11_hard_negatives": """
WITH vectors AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
    SELECT anchor, other AS positive, score AS p FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5
), ranked AS (
    SELECT anchor, positive, p, other, score,
           row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, other) AS n
    FROM positives JOIN scored USING (anchor)
    WHERE NOT same AND 30 * p <= 100 * score AND 100 * score <= 90 * p
)
SELECT anchor AS anchor_id, positive AS positive_id, n::INTEGER AS rank, other AS negative_id,
       p AS positive_score, score AS negative_score
FROM ranked WHERE n <= 10
""",
    "op12_suffix_dedup": r"""
WITH texts AS (
    SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS k, encode(coalesce(text, '')) AS t,
           octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
), starts AS (
    SELECT k, unnest(range(n - 99)) AS p, unnest(list_transform(range(n - 99), lambda i: array_slice(t, i + 1, i + 100))) AS s
    FROM texts WHERE n >= 100
), strings AS (
    SELECT k, p, row_number() OVER (PARTITION BY s ORDER BY k, p) > 1 AS late FROM starts
), runs AS (  -- late starts whose strings overlap or touch
    SELECT k, p, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY p) AS run
    FROM (SELECT k, p, lag(p, 1, -1000) OVER (PARTITION BY k ORDER BY p) AS before FROM strings WHERE late)
), spans AS (
    SELECT k, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY k, run
), cuts AS (
    SELECT k, a, b, coalesce(lag(b) OVER (PARTITION BY k ORDER BY a), 0) AS c,
           lead(a) OVER (PARTITION BY k ORDER BY a) IS NULL AS last
    FROM spans
), summed AS (
    SELECT k, sum(b - a) AS n_removed, count(*) AS n_spans,
           string_agg(hex(array_slice(t, c + 1, a)) || CASE WHEN last THEN hex(array_slice(t, b + 1, n)) ELSE '' END, '' ORDER BY a) AS rest
    FROM cuts JOIN texts USING (k) GROUP BY k
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN rest IS NULL THEN t ELSE unhex(rest) END) AS kept_sha256
FROM texts LEFT JOIN summed USING (k)
""",
}
