"""Columns named like those that operators add on their way stay what they are."""

import public_tokenizers
import pytest

import corpus_pipeline
from lodestrata.llm import byte_bpe, chunk_dedup, jaccard_join, line_crf, mixing, periodic_runs, secrets, toxicity
from lodestrata.llm.names import own_names

ROWS = [(1, "a b c d e f", "s"), (2, "token=Pm4Vc8Xz1Nb6Qw here", "t"), (3, None, None), (None, "x y z", "s"), (4, "a b c d e f", "t")]


def operators(spark):
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    return {
        "mix": mixing.mix,
        "encode": lambda docs: byte_bpe.encode(docs, path),
        "encode_decode": lambda docs: byte_bpe.encode_decode(docs, path),
        "without_repeats": lambda docs: chunk_dedup.without_repeats(docs.filter("doc_id IS NOT NULL")),
        "toxicity": lambda docs: toxicity.classify(docs, none),
        "line_crf": lambda docs: line_crf.classify(docs, none),
        "redact": secrets.redact,
        "one_of_each": jaccard_join.one_of_each,
        "collapse_runs": periodic_runs.collapse_runs,
    }


@pytest.mark.parametrize("name", ["mix", "encode", "encode_decode", "without_repeats", "toxicity", "line_crf", "redact", "one_of_each", "collapse_runs"])
def test_columns_of_the_rows_stay(spark, clashing, name):
    docs = clashing(ROWS)
    out = operators(spark)[name](docs)
    own = [c for c in docs.columns if c.startswith("_") or c == "kept_id"]
    assert [c for c in out.columns if c in own] == own
    rows = out.collect()
    assert rows and all(r[c] == c for r in rows for c in docs.columns if c.startswith("_") or c == "kept_id")


def test_a_column_that_an_argument_names_may_have_any_name(clashing):
    docs = clashing(ROWS).drop("_text").withColumnRenamed("text", "_text")
    out = secrets.redact(docs, text="_text")
    assert out.columns == docs.columns
    assert "token=Pm4" not in {r["doc_id"]: r for r in out.collect()}[2]["_text"]
    assert own_names(lambda docs, name: docs.select(name))(docs, "_text").columns == ["_text"]


def test_stages_of_the_pipeline(spark, clashing, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(9, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = clashing(ROWS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert all(r["_key"] == "_key" and r["_text"] == "_text" for r in out.collect())
