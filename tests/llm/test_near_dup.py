import random
import time

import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, shingles, space_words, story

from ledgerlane.llm import near_dup
from ledgerlane.llm.graph import run_components
from ledgerlane.llm.near_dup import run_near_duplicates


def brute(rows, width):
    sets = {i: shingles(space_words(t), width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    names = sorted(sets)
    for a in names:
        for b in names:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in names}


@pytest.mark.parametrize("width", [4, 5])
def test_groups_equal_brute_force(spark, width):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 30, 80, 150]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    common = " ".join(rng.choice(words) for _ in range(12))
    rows += [(5000 + i, common + " " + " ".join(rng.choice(words) for _ in range(40))) for i in range(30)]
    documents = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in run_near_duplicates(documents, width=width).collect()}
    assert found == brute(rows, width)


def test_a_chain_of_links_is_one_group(spark):
    words = [f"w{i}" for i in range(103)]
    rows = []
    for step in range(10):  # each text differs from the next in one shingle more
        rows.append((step, " ".join([*(f"n{i}" for i in range(step * 4)), *words[step * 4 :]]), None, None, None))
    documents = spark.createDataFrame(rows, DOCUMENTS)
    expected = brute([(r[0], r[1]) for r in rows], 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run_near_duplicates(documents, width=4).collect()} == expected


def test_awkward_rows(spark):
    documents = clashing(odd_documents(spark))
    found = run_near_duplicates(documents)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in found.collect()), key=repr)
    assert rows == sorted(
        [(i, i, True) for i in (1, 1, 2, 3, 4, 5, 6, 7)] + [(None, None, True)], key=repr
    )
    sizes = {r.doc_id: r.n_shingles for r in found.collect()}
    assert sizes[2] == sizes[3] == sizes[4] == 0 and sizes[6] == sizes[7] == 1


def test_empty_table_and_equal_texts(spark):
    assert run_near_duplicates(empty(spark)).collect() == []
    rows = [(i, story(), None, None, None) for i in (9, 4, 6)]
    found = run_near_duplicates(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(4, 4, True), (6, 4, False), (9, 4, False)]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7), (None, 3), (250, 240), (250, 240)]
    found = run_components(spark.createDataFrame(edges, "u long, v long")).collect()
    labels = {r.node: r.label for r in found if r.node is not None}
    assert len(found) == len(labels)
    assert {labels[i] for i in range(31)} == {0}
    assert {labels[100 + i] for i in range(20)} == {100}
    assert labels[250] == labels[240] == 240


def test_an_id_that_most_rows_have(spark):
    """Each row of it is judged by its own text, in time that grows with the rows only."""
    rng = random.Random(3)
    texts = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(30)) for _ in range(900)]
    texts += [t.replace(t.split()[0], "other") for t in texts[:300]]
    own = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    same = spark.createDataFrame([(5, t) for t in texts], "doc_id long, text string")
    seconds = []
    for documents in (own, own, same):
        started = time.time()
        found = run_near_duplicates(documents, width=4, digests=True).collect()
        seconds.append(time.time() - started)
    assert len(found) == 1200 and {r.component_id for r in found} == {5} and {r.kept for r in found} == {True}
    assert seconds[2] < 2 * seconds[1] + 2


def test_documents_of_one_template_do_not_all_meet(spark, monkeypatch):
    """They share seven tenths and have the rest for themselves; two of them are near copies of others."""
    rng = random.Random(4)
    template = [f"p{i}" for i in range(170)]
    rows = [(i, " ".join(template + [f"d{i}x{k}" for k in range(45)])) for i in range(300)]
    rows += [(1000 + i, rows[i][1].replace("p5 ", "q ")) for i in (7, 8)]
    tried = []
    confirm = near_dup._confirmed

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return confirm(pairs, *rest)

    monkeypatch.setattr(near_dup, "_confirmed", counted)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in run_near_duplicates(documents, width=4).collect()}
    assert found == brute(rows, 4)
    assert sum(tried) < 3000
