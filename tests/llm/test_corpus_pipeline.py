import public_tokenizers
import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, rows_of, shingles, space_words, story
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlane.llm.quality import run_quality

PASSAGE = " ".join(f"p{i}" for i in range(14))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    for i in range(60):
        good = i % 3 > 0
        words = [f"{'abcdefgh'[(i * j) % 8]}{'lmnopqrst'[(i + j * j) % 9]}o{i}e" for j in range(30 + i)]
        rows.append((i, " ".join(words) + "." if good else "!!! ".join(words).upper(), "en", "s", 5))
        labels.append((i, int(good), 0))
    rows.append((100, rows[1][1], "en", "s", 5))
    rows.append((101, rows[2][1].replace(".", " more."), "en", "t", 5))
    rows.append((102, rows[4][1] + f" Then {PASSAGE} and on. " + rows[5][1], "en", "t", 5))
    rows.append((103, rows[7][1] + " Mail bob@host.org or 10.0.0.1. " + rows[8][1], "en", "t", 5))
    rows.append(rows[10])
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([("q", PASSAGE)], "item_id string, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_stages_take_effect_in_order(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "BPE encoding and decoding",
    ]
    scores = run_quality(documents, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    good = {r.doc_id for r in scores if r.predicted}
    texts = {r.doc_id: r.text for r in documents.collect()}
    kept = set()
    sets = {i: shingles(space_words(texts[i]), 5) for i in good}
    for i in sorted(good):  # here every group is a star around its least id
        if not any(100 * len(sets[i] & sets[k]) >= 80 * len(sets[i] | sets[k]) for k in kept):
            kept.add(i)
    assert {100, 101} <= good and not {100, 101} & kept
    expected = {}
    for i in kept:
        text = texts[i].replace(PASSAGE, "").replace("bob@host.org", "[EMAIL]").replace("10.0.0.1", "[IP]")
        expected[i] = text
    found = corpus_pipeline.run(spark, folder)
    rows = found.collect()
    assert sorted(r.doc_id for r in rows) == sorted(kept)
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    for row in rows:
        assert row.text == expected[row.doc_id]
        assert row.n_chars == (len(row.text) if row.text != texts[row.doc_id] else 5)
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and bytes(row.ids) == b"".join(i.to_bytes(4, "little") for i in ids)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_each_stage_bears_awkward_rows(spark, folder, stage):
    documents = clashing(odd_documents(spark))
    found = stage[1](spark, documents, folder)
    last = stage is corpus_pipeline.STAGES[-1]
    if not last:
        assert found.dtypes == documents.dtypes
        if stage[0] != "quality classifier":
            assert rows_of(found.distinct(), "doc_id", "text") == rows_of(documents.distinct(), "doc_id", "text")
    else:
        assert {"doc_id", "n_tokens", "ids", "decoded_sha256"} <= set(found.columns) and found.count() == 9
    assert stage[1](spark, empty(spark), folder).collect() == []


def test_one_document_of_a_group_stays(spark, folder):
    rows = [(i, story((3, "x")) if i % 2 else story(), "en", "s", 1) for i in (4, 2, 9)] + [(2, story(), "en", "s", 1)]
    found = corpus_pipeline.keep_one(spark, spark.createDataFrame(rows, DOCUMENTS), folder)
    assert rows_of(found, "doc_id") == [(2,), (9,)]
