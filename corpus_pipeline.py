"""From raw documents to token ids: five stages, each a table that the next one reads.

1. toxicity: documents the network rejects go;
2. n-gram Jaccard join on 5 words at 80 percent: one document of each group of linked texts stays;
3. secret scans: live credentials are covered, every document stays;
4. mixing: documents are repeated or left out so that sources come to their target weights;
5. byte-level BPE: ids of every whole text, and the bytes they decode to, as digests.

Every stage works on all that the stage before kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import byte_bpe, jaccard_join, mixing, secrets, toxicity
from lodestrata.sources.staging import drop_folder, drop_unread, staged_run, staging_into

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Words of a shingle and percent of likeness from which two documents are near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Rows that go to a Python worker at once. Spark fills such a batch outside the heap, in a buffer that doubles, and the
#: worker holds it whole beside what it makes of it: with Spark's 10,000 rows each would be all texts of a task.
BATCH_ROWS = "1000"
#: Columns that stages use; others have names of their own meanwhile, which clash with nothing.
USED = ("doc_id", "text", "source")


def _staged(build: Stage) -> Stage:
    """Of what a stage has staged on its way, only what its result still reads stays.

    The session keeps ``BATCH_ROWS``, as the result is computed later.
    """

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        others = {c: f"other {k}" for k, c in enumerate(docs.columns) if c not in USED}
        with staging_into(spark) as folder:
            result = build(spark, docs.withColumnsRenamed(others), sf_dir)
        drop_unread(result, folder)
        return result.withColumnsRenamed({name: c for c, name in others.items()})

    return run


@_staged
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    network = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, network, output="_toxicity")
    return scored.filter(F.col("_toxicity") < toxicity.THRESHOLD).select(*docs.columns)


@_staged
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


@_staged
def cover_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


@_staged
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(docs).filter(F.col(mixing.COPIES) > 0)
    repeated = mixed.withColumn(mixing.COPIES, F.explode(F.sequence(F.lit(1), F.col(mixing.COPIES).cast("int"))))
    return repeated.select(*docs.columns)


@_staged
def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, public_tokenizers.path(byte_bpe.VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("jaccard_join", keep_one_of_each),
    ("secrets", cover_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", encode_bytes),
]

#: SQL cannot express the network, the hashes that choose documents, or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for _, build in STAGES:
        with staging_into(spark) as folder:
            pass
        with staged_run(spark):
            result = build(spark, docs, sf_dir)
            result.write.parquet(f"{folder}/result")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/result")
        if before is not None:
            drop_folder(spark, before)
        before = folder
    return docs
