"""The registered text queries: against SQL where there is any, else row by row and by type."""

import os

import pytest
from check_oracle import compare

import __spark_entry__ as entry
from ledgerlane.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")

COLUMNS = {
    "op1_url_verdicts": "page_id long, host string, path string, rule string, verdict string",
    "op2_word_bpe": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    "op3_scaled_fingerprints": "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double",
    "op4_chat_format": "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    "op5_backoff_scores": "doc_id long, n_words long, score double",
    "op6_benchmark_passages": "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    "op7_page_text": "page_id long, url string, text string, n_chars long",
    "op8_personal_data": "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    "op9_quality_discriminant": "doc_id long, held_out boolean, score double, predicted int",
    "op10_near_duplicates": "doc_id long, n_shingles long, component_id long, kept boolean",
    "op11_collocations": "lang string, rank long, phrase string, a long, l long, r long, n long, score long",
    "op12_conversation_repair": "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string",
    "op13_sentence_pieces": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
}
SIZES = {"op1_url_verdicts": "pages", "op7_page_text": "pages", "op4_chat_format": None, "op11_collocations": None, "op12_conversation_repair": None}


def test_all_operators_and_the_pipeline_are_registered():
    assert set(COLUMNS) == set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    assert compare(spark, FOLDER, name).startswith("ok")


@pytest.mark.parametrize("name", COLUMNS)
def test_query_has_its_columns_and_all_rows(spark, name):
    found = QUERIES[name](spark, FOLDER)
    kinds = dict(found.dtypes)
    for column in COLUMNS[name].split(", "):
        wanted, kind = column.split(" ")
        assert kinds[wanted] == {"long": "bigint"}.get(kind, kind)
    source = SIZES.get(name, "documents")
    if source:
        assert found.count() == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
