"""The registered queries on the smallest tables; SQL where there is some."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, difference
from retailmill.llm.queries import LLM_ORACLE, LLM_QUERIES

CONTRACTS = {
    "op2_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_merkle_fingerprints": [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ],
    "op9_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op11_fill_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
}


def test_names():
    assert [int(n[2:].split("_")[0]) for n in LLM_QUERIES] == list(range(1, 14))
    assert {*LLM_QUERIES, "pipeline"} <= set(entry.queries()) and set(LLM_ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract_columns_and_rows(spark, sf_dir, name):
    df = LLM_QUERIES[name](spark, sf_dir)
    assert df.columns[: len(CONTRACTS[name])] == CONTRACTS[name]
    assert df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, sf_dir, name):
    assert difference(LLM_QUERIES[name](spark, sf_dir), connect(sf_dir), LLM_ORACLE[name]) is None


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == n
