"""Queries ``opN_*``: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, embeddings_itq, katz, licenses, mixing, ngram_join, pieces, quality, repair, spelling, substrings, topk, urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.substring_dedup(table(spark, sf_dir, "documents")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return chat.read_back(chat.format_conversations(rows.union(extra)))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: Domains are families of sources: the first ten are crawled, the others collected.
MIX = mixing.Mix(
    domain="CASE WHEN length(source) = 4 THEN 'crawled' ELSE 'collected' END",
    domain_weights={"crawled": 2, "collected": 3},
    lang_weights={"en": 4, "de": 2, "fr": 2, "es": 2},
    source_weights={"src0": 2},
)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), MIX).withColumnRenamed("id", "doc_id")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.encode(table(spark, sf_dir, "documents"), tokenizer()))


def op8_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.katz_scores(table(spark, sf_dir, "documents"), "crc32(cast(id AS string)) % 5 <> 1")
    return scored.select(F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings_itq.embedding_dedup(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.with_lost(repair.digest(repair.repair(repair.damage(rows))), rows)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_substring_dedup, op2_url_filter, op3_chat_format, op4_exact_top_k, op5_source_mixing, op6_ngram_jaccard_join, op7_sentencepiece, op8_katz_lm, op9_quality_classifier,
    op10_embedding_near_dedup, op11_conversation_repair, op12_spelling_variants, op13_license_scan,
)}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        win AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50),
        keyed AS (SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS key FROM win),
        owned AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY key) AS owner FROM keyed),
        gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (
            SELECT doc_id, unnest(range(p, p + 50)) AS i FROM owned WHERE owner < doc_id) GROUP BY doc_id),
        marked AS (SELECT w.doc_id, ws, coalesce(gone, []) AS gone FROM w LEFT JOIN gone USING (doc_id)),
        word AS (SELECT doc_id, gone, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM marked WHERE len(gone) > 0),
        cut AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM word WHERE NOT list_contains(gone, i) GROUP BY doc_id)
        SELECT doc_id, len(ws)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
            sha256(CASE WHEN len(gone) > 0 THEN coalesce(kept, '') ELSE array_to_string(ws, ' ') END) AS kept_sha256
        FROM marked LEFT JOIN cut USING (doc_id)
    """,
    "op6_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        g AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM w WHERE len(ws) > 0),
        s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS gram FROM g),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s AS a JOIN s AS b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS MATERIALIZED (SELECT x, y FROM pair JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
            WHERE 100 * common >= 85 * (p.n + q.n - common)),
        edge AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
        reach AS (SELECT x AS start, y AS node FROM edge UNION SELECT start, y FROM reach JOIN edge ON node = x),
        low AS (SELECT start, min(node) AS low FROM reach GROUP BY start)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON start = w.doc_id
    """,
    "op4_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS terms FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.terms, c.terms) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op5_source_mixing": mixing.oracle(MIX),
    "op13_license_scan": licenses.oracle(),
}
