from helpers import DOCUMENTS, rows_of

import corpus_pipeline


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " more", " ".join(f"x{i}" for i in range(40))
    rows = [(3, text), (5, near), (5, other), (5, other), (5, None), (None, near), (6, other)]
    documents = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS)
    found = corpus_pipeline.keep_one(spark, documents, "")
    assert found.columns == documents.columns
    assert rows_of(found, "doc_id", "text") == sorted([(3, text), (5, other), (5, None), (None, near)], key=repr)
