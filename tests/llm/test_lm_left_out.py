import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, plain_words

from ledgerlane.llm import tables
from ledgerlane.llm.lm import run_backoff_scores
from ledgerlane.llm.queries import QUERIES


def brute(rows):
    """Scores by id from the counts of all documents less the document's own."""
    own_words, own_pairs, texts = defaultdict(Counter), defaultdict(Counter), defaultdict(list)
    for number, text in rows:
        found = plain_words(text)
        texts[number].append(found)
        own_words[number].update(found)
        own_pairs[number].update(zip(found, found[1:]))
    words, pairs = sum(own_words.values(), Counter()), sum(own_pairs.values(), Counter())
    result = {}
    for number, found in texts.items():
        w, p = words - own_words[number], pairs - own_pairs[number]
        total, size, matched, score = max(sum(w.values()), 1), 0, 0, 0.0
        for text in found:
            size += len(text)
            for before in zip(text, text[1:]):
                matched += p[before] > 0
                if p[before]:
                    score += math.log(p[before] / w[before[0]])
                else:
                    score += math.log(max(w[before[1]], 1) / total) + math.log(0.4)
            if text:  # the first word of a further part takes the factor, as it does by halves
                score += math.log(max(w[text[0]], 1) / total) + (math.log(0.4) if text is not next(t for t in found if t) else 0)
        result[number] = (size, matched, score)
    return result


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)


def check(spark, rows, tolerance=1e-4):
    expected = brute(rows)
    found = run_backoff_scores(frame_of(spark, rows), left_out="document").collect()
    assert len(found) == len(expected)
    for row in found:
        size, matched, score = expected[row.doc_id]
        assert (row.n_words, row.n_matched) == (size, matched)
        assert abs(row.score - score) < tolerance and abs(row.score_per_word - score / max(size, 1)) < 1e-5


def mixed_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(words[min(int(rng.expovariate(0.08)), 79)] for _ in range(rng.randint(0, 60)))) for i in range(80)]
    return rows + [(200 + i, "the same two lines. The same two lines!") for i in range(40)]


def test_all_other_documents_count(spark):
    check(spark, mixed_rows())


def test_rows_that_repeat_an_id_leave_out_all_their_parts(spark):
    rows = mixed_rows()
    rows += [(i, t) for i, t in rows[:10]] + [(None, rows[11][1]), (None, rows[11][1]), (3, "only here only here")]
    check(spark, rows)


def test_many_repetitions_in_one_text(spark):
    rows = [(1, "a b " * 6000), (2, "a b c " * 300), (3, "b a"), (4, "c c c")]
    check(spark, rows)


def test_query_counts_pairs_of_the_own_half(spark, tmp_path):
    rows = [(i, f"shared pair x{i}") for i in (1, 2)]  # one holder besides, whatever half it is in
    rows += [(i, f"other y{i}") for i in range(3, 30)]
    for both in range(6):
        place = f"{tmp_path}/{both}"
        frame_of(spark, [(i + both * 100, t) for i, t in rows]).write.parquet(f"{place}/documents.parquet")
        found = {r.doc_id: r.n_matched for r in QUERIES["op5_backoff_scores"](spark, place).collect()}
        assert found[1 + both * 100] == found[2 + both * 100] == 1


def test_awkward_rows(spark):
    documents = clashing(odd_documents(spark))
    found = {r.doc_id: r for r in run_backoff_scores(documents, left_out="document").collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, None}
    assert found[1].n_words == 2 * 19 and found[5].n_words == 80_000 and found[None].n_words == 19
    assert all((found[i].n_words, found[i].score, found[i].score_per_word) == (0, 0.0, 0.0) for i in (2, 3, 4))
    assert all(r.score is not None and r.score <= 0 for r in found.values())
    assert run_backoff_scores(empty(spark), left_out="document").collect() == []
    with pytest.raises(ValueError):
        run_backoff_scores(documents, left_out="nothing")


def test_scores_hold_four_decimals_on_long_texts(spark):
    from test_lm import brute as by_halves

    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(30_000))) for i in range(6)]
    for row in run_backoff_scores(frame_of(spark, rows)).collect():
        assert abs(row.score - by_halves(rows)[row.doc_id][2]) < 1e-4
    check(spark, rows)


@pytest.mark.parametrize(("keys", "bits"), [(0, 64), (7, 1 << 27), (40, 128)])
def test_bounded_tables_change_nothing(spark, monkeypatch, keys, bits):
    """Few counts at hand, or bits that exclude next to nothing: the joins do the rest."""
    monkeypatch.setattr(tables, "KEYS", keys)
    monkeypatch.setattr(tables, "BITS", bits)
    rows = mixed_rows()
    check(spark, rows + [(3, "only here only here"), (5, rows[11][1])])


def test_very_long_texts_and_clashing_names(spark):
    rng = random.Random(8)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(60_000))
    rows = [(1, long), (2, long[:5000]), (3, "w1 w2 w3")]
    expected = brute(rows)
    for row in run_backoff_scores(clashing(frame_of(spark, rows)), left_out="document").collect():
        assert (row.n_words, row.n_matched) == expected[row.doc_id][:2]
        assert abs(row.score_per_word - expected[row.doc_id][2] / row.n_words) < 1e-5
