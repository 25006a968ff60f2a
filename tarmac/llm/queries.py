"""The registered queries of the text operators, and their oracles where SQL can state them.

Each query applies its operator with production parameters to its whole table. Learned,
hashed or iterative results have no SQL; tests hold those against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import alignment, bpe, graphann, langid, mixing, packing, periodic, pii, quality, rules, sharding, simhash, warc
from tarmac.llm.common import remainder, table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
LETTER_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
NEIGHBOURS, QUERY_STEP = 20, 20


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms in every document."""
    told = pii.protect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.sha2(pii.joined_spans(F.col("pii.base")), 256).alias("base_sha256")
    return told.select("doc_id", *pii.counted(), base, pii.joined_spans(pii.all_spans()).alias("spans"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    told = langid.identify(docs, langid.train(docs), ["doc_id"])
    return told.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and the verdict on every document."""
    docs = table(spark, sf_dir, "documents")
    return rules.judge(docs, rules.train(docs, table(spark, sf_dir, "labels")), ["doc_id"])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    return warc.archive(table(spark, sf_dir, "pages"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return graphann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0, NEIGHBOURS)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, and where they would be in 17."""
    return sharding.shard_by_key(table(spark, sf_dir, "documents"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    told = quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return told.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", predicted)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = public_tokenizers.path(BYTE_VOCABULARY)
    return bpe.round_trip(table(spark, sf_dir, "documents"), ["doc_id"], path, public_tokenizers.PATTERN)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenisations of every document aligned, and how common their links are."""
    a, b = map(public_tokenizers.path, (LETTER_VOCABULARY, PIECE_VOCABULARY))
    return alignment.compare(table(spark, sf_dir, "documents"), a, b)


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, with repetitions planted in one of ten."""
    return periodic.summarise(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_pii, op3_language, op4_quality_rules, op5_warc, op6_neighbours, op7_simhash, op8_sharding,
        op9_quality_model, op10_bpe, op11_alignment, op12_mixing, op13_periodic_runs,
    )
}

ORACLES = {
    "op5_warc": """
        WITH payload AS (
          SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
        ), told AS (
          SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM payload
        ), origin AS (
          SELECT payload_digest, min(page_id) AS least FROM told WHERE payload_bytes >= 100 GROUP BY 1
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN page_id IS DISTINCT FROM least AND least IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
        FROM told LEFT JOIN origin USING (payload_digest)
    """,
    "op12_mixing": r"""
        WITH found AS (
          SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
          FROM documents
        ), sized AS (
          SELECT doc_id, source, id, CAST(len(words) AS BIGINT) AS size,
                 (CAST(CAST('0x' || substr(md5('mix:' || id), 1, 13) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) / pow(2, 52) AS u,
                 CAST(len(list_distinct(words)) + 1 AS DOUBLE) / CAST(len(words) + 1 AS DOUBLE) AS quality
          FROM found
        ), keyed AS (
          SELECT doc_id, source, size,
                 sum(size) OVER (PARTITION BY source ORDER BY -ln(u) / quality, id, size ROWS UNBOUNDED PRECEDING) - size AS before
          FROM sized
        ), sources AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
          FROM sized GROUP BY source
        ), weighed AS (
          SELECT *, CAST([3, 1, 2][(place - 1) % 3 + 1] AS BIGINT) AS weight FROM sources
        ), levels AS (
          SELECT *, CAST(2 * source_size AS DOUBLE) / CAST(weight AS DOUBLE) AS level FROM weighed
        ), tried AS (
          SELECT *,
                 (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
                  - CAST(sum(2 * source_size) OVER o - 2 * source_size AS DOUBLE))
                 / CAST(sum(weight) OVER () - (sum(weight) OVER o - weight) AS DOUBLE) AS reached
          FROM levels WINDOW o AS (ORDER BY level, source NULLS LAST ROWS UNBOUNDED PRECEDING)
        ), aims AS (
          SELECT source, source_size,
                 least(CAST(2 * source_size AS DOUBLE),
                       coalesce(CAST(weight AS DOUBLE) * (SELECT max(reached) FROM tried WHERE reached <= level), CAST(2 * source_size AS DOUBLE))) AS target
          FROM tried
        ), budgets AS (
          SELECT *, CAST(floor(target + CAST(0.5 AS DOUBLE)) AS BIGINT) AS budget FROM aims
        )
        SELECT k.doc_id, k.size, b.source_size, b.target, k.source,
               CAST(CASE WHEN b.source_size = 0 THEN 0 ELSE
                 (b.budget // b.source_size) * k.size
                 + least(k.size, greatest(b.budget % b.source_size - k.before, 0)) END AS BIGINT) AS taken
        FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
    """,
}
