"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import (
    bilinear_lm,
    byte_bpe,
    chunk_dedup,
    hard_negatives,
    jaccard_join,
    licenses,
    line_crf,
    mixing,
    neighbours,
    periodic_runs,
    secrets,
    spotsigs,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def on(*tables: str) -> Callable:
    """Register a query on driver tables, under its function name."""

    def register(build: Callable[[DataFrame], DataFrame]) -> Callable:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            return build(*(spark.read.parquet(f"{folder.rstrip('/')}/{t}.parquet") for t in tables))

        QUERIES[build.__name__] = query
        return build

    return register


@on("documents")
def op1_mixing(docs):
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@on("documents")
def op2_spotsigs(docs):
    return spotsigs.fingerprint_edits(docs)


@on("documents")
def op3_licenses(docs):
    return licenses.scan_licenses(docs).drop("matches")


@on("documents")
def op4_byte_bpe(docs):
    return byte_bpe.round_trip(docs)


@on("documents")
def op5_jaccard_join(docs):
    return jaccard_join.jaccard_components(docs)


@on("documents")
def op6_chunk_dedup(docs):
    return chunk_dedup.repeated_passages(docs)


@on("documents", "labels")
def op7_toxicity(docs, labels):
    return toxicity.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


@on("documents")
def op8_secrets(docs):
    return secrets.scan_secrets(docs)


@on("documents", "labels")
def op9_line_crf(docs, labels):
    return line_crf.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


@on("embeddings")
def op10_neighbours(embeddings):
    return neighbours.nearest_neighbours(embeddings)


#: Rows whose id is divisible by the first number move to the next of so many labels.
MOVED, LABELS, ANCHORS = 7, 10, 50


@on("embeddings")
def op11_hard_negatives(embeddings):
    label = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    moved = hard_negatives.quantised(embeddings.withColumn("label", label), "embedding")
    return hard_negatives.hard_negatives(moved, F.col("vec_id") % ANCHORS == 0)


ORACLES["op11_hard_negatives"] = """
WITH numbers AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
           CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
    FROM numbers a JOIN numbers o ON a.vec_id <> o.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, CAST(row_number() OVER (
               PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM ranked WHERE rank <= 3
"""


@on("documents")
def op12_bilinear_lm(docs):
    return bilinear_lm.score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 10 == 0)


@on("documents")
def op13_periodic_runs(docs):
    return periodic_runs.digest(docs)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
