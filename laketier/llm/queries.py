"""Registered queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laketier.llm.alignment import align_documents
from laketier.llm.common import table
from laketier.llm.decontamination import contaminated
from laketier.llm.exact_dedup import exact_duplicates
from laketier.llm.language import language_id
from laketier.llm.log_bilinear import language_model_scores
from laketier.llm.packing import pack_documents
from laketier.llm.pieces import encode_documents
from laketier.llm.ranking import search
from laketier.llm.repeats import remove_repeats
from laketier.llm.simhash import near_duplicates
from laketier.llm.token_counts import token_counts
from laketier.llm.token_files import token_documents
from laketier.llm.toxicity import toxicity


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_documents(table(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents")).drop("spans")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_documents(table(spark, sf_dir, "documents"), decoded=True)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))[0]


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_toxicity, op3_log_bilinear, op4_token_files, op5_pack,
    op6_repeated_strings, op7_exact_dedup, op8_language_id, op9_token_counts, op10_simhash, op11_pieces,
    op12_ranked_search, op13_alignment)}

ORACLE_SQL = {
    "op7_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
                                                 '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        s AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length
              FROM d WHERE len(terms) > 0),
        q AS (
            SELECT i, item_id, term, count(*) AS times FROM (
                SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark)
            GROUP BY i, item_id, term),
        p AS (
            SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
        w AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
            FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
        scored AS (
            SELECT i, item_id, r, doc_id, CAST(sum(times * weight * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // length)))) AS BIGINT) AS score
            FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY i, item_id, r, doc_id)
        SELECT item_id, rank, doc_id, score FROM (
            SELECT item_id, doc_id, score, CAST(row_number() OVER (
                PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
            FROM scored WHERE score > 0)
        WHERE rank <= 10""",
}
