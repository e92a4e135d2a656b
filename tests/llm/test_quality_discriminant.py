import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import DOCUMENTS, clashing, empty, odd_documents, rows_of

from ledgerlane.llm.quality import FEATURES, fit, run_fit, run_keep_good, run_quality, statistics_table, text_statistics

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, count=400):
    rng = random.Random(8)
    words = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 9))) for _ in range(900)]
    rows, labels = [], []
    for i in range(count):
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        good = i % 4 > 0
        if not good:
            text = [w.upper() + "!!" for w in text] if i % 8 else [text[0]] * len(text)
        rows.append((i, " ".join(text) + ".", "en", "s", None))
        labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame(labels, LABELS)


def test_held_out_labels_are_met_and_not_learned(spark):
    documents, labels = corpus(spark)
    found = run_quality(documents, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = found.collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rows if r.held_out]) > 0.97
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    assert rows_of(run_quality(documents, flipped), "*") == rows_of(found, "*")
    kept = run_keep_good(documents, labels)
    assert rows_of(kept, "doc_id") == rows_of(found.where("predicted = 1"), "doc_id")


def test_scores_equal_the_densities(spark):
    rng = np.random.default_rng(1)
    rows = [rng.normal(k, 1 + k, (500, len(FEATURES))) for k in (0, 1)]
    counts = np.array([len(r) for r in rows], float)
    model = fit(counts, np.array([r.sum(0) for r in rows]), np.array([r.T @ r for r in rows]))
    points = rng.normal(0, 2, (20, len(FEATURES)))
    logs = []
    for mean, factor in zip(model.means, model.factors):
        covariance = np.linalg.inv(factor.T @ factor)
        gap = points - mean
        logs.append(-0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(covariance), gap) - 0.5 * np.linalg.slogdet(covariance)[1])
    assert np.allclose(model.score(points), 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))))


def test_awkward_rows(spark):
    documents, labels = corpus(spark, 120)
    odd = clashing(odd_documents(spark))
    wide = labels.selectExpr("*", "1 as score").union(spark.createDataFrame([(None, 1, None, 1), (3, None, None, 1), (4, 7, 0, 1)], "a long, b int, c int, d int"))
    both = clashing(documents).union(odd)
    found = run_quality(both, wide)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == 129 and found.where("score is null").count() == 0
    assert run_keep_good(both, wide).dtypes == both.dtypes
    assert run_quality(empty(spark), labels).collect() == []
    alone = run_quality(odd, empty(spark, LABELS)).collect()
    assert {(r.score, r.predicted) for r in alone} == {(0.5, 1)}
    ones = run_quality(odd, spark.createDataFrame([(i, 1, 0) for i in range(1, 8)], LABELS)).collect()
    assert {r.score for r in ones} == {1.0}


def test_statistics_do_not_depend_on_the_batch():
    texts = ["One two.\nTwo!", "", None, "é" * 10, "A B C " * 50, "x" * 100_000]
    whole = text_statistics(pa.array(texts))
    assert np.allclose(whole, np.concatenate([text_statistics(pa.array([t], pa.string())) for t in texts]))
    assert (whole[1] == 0).all() and (whole[2] == 0).all()


def test_an_id_that_repeats_in_both_tables_is_met_once_by_each_row(spark):
    documents = spark.createDataFrame([(9, f"text number {k} of many words") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(9, k % 2) for k in range(500)] + [(9, None), (9, 7), (None, 1)], "doc_id long, quality int")
    statistics = statistics_table(documents, "doc_id", "text")
    model = run_fit(statistics, labels)
    twice = run_fit(statistics, spark.createDataFrame([(9, 0), (9, 1)], "doc_id long, quality int"))
    assert np.allclose(model.means, twice.means) and np.allclose(model.factors, twice.factors, atol=1e-3)
    assert np.allclose(model.offsets, twice.offsets)
