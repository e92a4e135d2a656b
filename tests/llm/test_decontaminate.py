import random

import numpy as np
import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, plain_words, rows_of, story

from ledgerlane.llm import decontaminate
from ledgerlane.llm.decontaminate import run_contamination, run_decontaminate
from ledgerlane.llm.fm_index import FmIndex, suffix_array

ITEMS = "item_id string, text string"


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_place(seed):
    rng = np.random.default_rng(seed)
    runs = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(40)]
    runs += [runs[0]] * 20  # copies
    text = np.concatenate([np.append(r, 0) for r in runs])
    assert sorted(suffix_array(text).tolist()) == list(range(len(text)))
    patterns = [rng.integers(1, 6, rng.integers(1, 7)) for _ in range(60)]
    symbols = np.concatenate(patterns)
    lengths = np.array([len(p) for p in patterns])
    index = FmIndex(text)
    first, last = index.search(symbols, np.cumsum(lengths) - lengths, lengths)
    for pattern, a, b in zip(patterns, first, last):
        expected = [i for i in range(len(text)) if text[i : i + len(pattern)].tolist() == pattern.tolist()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def brute(documents, items, width=10):
    result = []
    for number, text in documents:
        words = plain_words(text)
        hit, found = set(), set()
        for item, item_text in items:
            own = plain_words(item_text)
            size = min(width, len(own))
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for at in range(len(words) - size + 1):
                if tuple(words[at : at + size]) in windows:
                    hit.update(range(at, at + size))
                    if item is not None:
                        found.add(item)
        result.append((number, len(words), len(hit), sorted(found)))
    return sorted(result, key=repr)


def found_rows(df):
    return sorted(((r.doc_id, r.n_words, sum(h.last - h.first for h in r.hits), r["items"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_hits_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = [(f"i{k}", " ".join(rng.choice(words) for _ in range(rng.choice([1, 4, 9, 10, 14, 30])))) for k in range(25)]
    items += [("i3", "W1, w2;w3"), ("empty", "..."), (None, "w5 w6 w7 w8"), ("null", None), ("i0", items[0][1])]
    documents = []
    for number in range(120):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            own = plain_words(rng.choice(items)[1])
            cut = rng.randint(0, len(own))
            at = rng.randint(0, len(parts))
            parts[at:at] = own[max(0, cut - 12) : cut]
        documents.append((number, rng.choice([" ", ", ", "\n"]).join(parts)))
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in documents], DOCUMENTS)
    found = run_contamination(frame, spark.createDataFrame(items, ITEMS))
    assert found_rows(found) == brute(documents, items)


def test_awkward_rows(spark):
    documents = clashing(odd_documents(spark))
    items = spark.createDataFrame([("a", story()), ("b", "é"), ("c", None), (None, None)], ITEMS)
    found = run_contamination(documents, items)
    expected = brute([(r.doc_id, r.text) for r in documents.collect()], [("a", story()), ("b", "é")])
    assert found_rows(found) == expected
    assert found_rows(run_contamination(documents, empty(spark, ITEMS))) == [(*r[:2], 0, []) for r in expected]
    assert run_contamination(empty(spark), items).collect() == []


def test_passages_are_cut_out_of_texts(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [f"Keep this. {passage}! And {passage} that, too", passage, "nothing here", None]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCUMENTS)
    cleaned = run_decontaminate(frame, spark.createDataFrame([("x", passage)], ITEMS))
    assert cleaned.dtypes == frame.dtypes
    assert rows_of(cleaned, "doc_id", "text", "n_chars") == [
        (0, "Keep this. ! And  that, too", 27), (1, "", 0), (2, "nothing here", 12), (3, None, 0),
    ]
    wide = clashing(odd_documents(spark))
    kept = run_decontaminate(wide, spark.createDataFrame([("x", passage)], ITEMS))
    assert kept.dtypes == wide.dtypes and rows_of(kept, "*") == rows_of(wide, "*")


@pytest.mark.parametrize("block", [8 << 20, 6000])
def test_items_that_share_a_passage(spark, monkeypatch, block):
    """Thousands of items times thousands of places are two lists, not their product."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    passage = " ".join(f"p{i}" for i in range(25))
    items = [(f"i{k:04}", f"{passage} own{k % 40} " + " ".join(f"o{k % 40}x{j}" for j in range(10))) for k in range(3000 if block > 6000 else 300)]
    documents = [(n, f"a {passage} b" if n % 3 else f"own{n % 40} " + " ".join(f"o{n % 40}x{j}" for j in range(10))) for n in range(600)]
    frame = spark.createDataFrame(documents, "doc_id long, text string").coalesce(1)
    found = found_rows(run_contamination(frame, spark.createDataFrame(items, ITEMS)))
    whole = [item for item, _ in items]
    for number, words, hits, listed in found:
        mine = whole if number % 3 else [item for k, item in enumerate(whole) if k % 40 == number % 40]
        assert listed == mine and hits == (25 if number % 3 else 11) and words == (27 if number % 3 else 11)
