import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, plain_words

from ledgerlane.llm import lm
from ledgerlane.llm.lm import run_backoff_scores


def brute(rows):
    """Scores by id from dictionaries."""
    words, pairs = (Counter(), Counter()), (Counter(), Counter())
    half = lambda i: 0 if i is None else zlib.crc32(str(i).encode()) % 2
    for number, text in rows:
        found = plain_words(text)
        words[half(number)].update(found)
        pairs[half(number)].update(zip(found, found[1:]))
    totals = [max(sum(w.values()), 1) for w in words]
    result = {}
    for number, text in rows:
        found, other, score, matched = plain_words(text), 1 - half(number), 0.0, 0
        for place, word in enumerate(found):
            before = (found[place - 1], word) if place else None
            if before and pairs[other][before]:
                score += math.log(pairs[other][before] / words[other][before[0]])
                matched += 1
            else:
                score += math.log(max(words[other][word], 1) / totals[other]) + (math.log(0.4) if place else 0)
        result[number] = (len(found), matched, score)
    return result


@pytest.mark.parametrize("shard", [1 << 22, 100])
def test_scores_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(lm, "SHARD_WORDS", shard)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(0.08)), 79)] for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(200 + i, "the same two lines. The same two lines!") for i in range(40)]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    expected = brute(rows)
    found = run_backoff_scores(frame).collect()
    assert len(found) == len(expected)
    for row in found:
        size, matched, score = expected[row.doc_id]
        assert (row.n_words, row.n_matched) == (size, matched)
        assert abs(row.score - score) < 1e-3 and abs(row.score_per_word - score / max(size, 1)) < 1e-5


def test_awkward_rows(spark):
    documents = clashing(odd_documents(spark))
    found = {r.doc_id: r for r in run_backoff_scores(documents).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, None}
    assert found[1].n_words == 2 * 19 and found[5].n_words == 80_000 and found[None].n_words == 19
    assert all((found[i].n_words, found[i].score, found[i].score_per_word) == (0, 0.0, 0.0) for i in (2, 3, 4))
    assert all(r.score is not None and r.score <= 0 for r in found.values())
    assert run_backoff_scores(empty(spark)).collect() == []


def refuse(*_):
    raise AssertionError("a slow sort of places")


@pytest.mark.parametrize("spread", [True, False])
def test_words_of_texts_are_ordered_by_plain_numbers(monkeypatch, spread):
    """Keys that differ in their last bits only are told apart as well."""
    rng = np.random.default_rng(8)
    rows = np.sort(rng.integers(0, 43, 5000))
    keys = rng.integers(0, 1 << 63, 60).astype(np.uint64)[rng.integers(0, 60, 5000)]
    if spread:
        for name in ("argsort", "lexsort", "union1d"):
            monkeypatch.setattr(lm.np, name, refuse)
    else:
        keys = keys & ~np.uint64(3) | rng.integers(0, 4, 5000).astype(np.uint64)
    order, starts = lm._by_row(rows, keys)
    wanted = sorted(zip(rows.tolist(), keys.tolist()))
    found = list(zip(rows[order].tolist(), keys[order].tolist()))
    assert sorted(order.tolist()) == list(range(5000)) and sorted(found) == wanted
    runs = [found[k] for k in starts.tolist()]
    assert len(runs) == len(set(runs)) == len(set(wanted))
    assert [found[a:b] for a, b in zip(starts.tolist(), [*starts.tolist()[1:], 5000])] == [[r] * wanted.count(r) for r in runs]


def test_no_words_have_an_order():
    order, starts = lm._by_row(np.zeros(0, np.int64), np.zeros(0, np.uint64))
    assert not len(order) and not len(starts)
