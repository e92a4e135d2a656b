"""Phrases and scores against counting in plain Python, with ranges of the order cut in awkward places."""

import random
import re
from collections import Counter

import pytest
from helpers import clashing, empty, folded, odd_documents
from pyspark.sql import functions as F

from ledgerlane.llm import collocations
from ledgerlane.llm.collocations import run_collocations


def brute(rows, least, longest, top=2000, covered=50):
    """{lang: [(phrase, a, l, r, n, score)]} of (text, lang) rows."""
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded(text)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for width in range(1, longest + 1):
                for i in range(len(words) - width + 1):
                    counts[lang, words[i : i + width]] += 1
    frequent = {k: f for k, f in counts.items() if f >= least}
    found = {}
    for (lang, words), a in frequent.items():
        if len(words) == 1:
            continue
        inside = [
            f
            for (other, more), f in frequent.items()
            if other == lang and len(more) > len(words) and any(more[i : i + len(words)] == words for i in range(len(more)))
        ]
        if any(100 * f >= covered * a for f in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((" ".join(words), a, l, r, totals[lang], score))
    return {k: sorted(v, key=lambda x: (-x[5], -x[1], x[0].encode()))[:top] for k, v in found.items()}


def collected(df):
    found = {}
    for row in sorted(df.collect(), key=lambda r: (r["lang"], r["rank"])):
        assert row["rank"] == len(found.setdefault(row["lang"], [])) + 1
        found[row["lang"]].append(tuple(row[c] for c in ("phrase", "a", "l", "r", "n", "score")))
    return found


def some_rows(seed, documents=60):
    """Few words, so that phrases repeat; one of them begins a third of all phrases."""
    pick = random.Random(seed)
    words = ["the", "The", "a", "é", "big", "cat", "sat", "mat x", "日本", "x-y"]
    rows = []
    for _ in range(documents):
        text = ""
        for _ in range(pick.randrange(60)):
            text += pick.choice(words if pick.random() < 0.66 else words[:1]) + pick.choice([" "] * 6 + ["\t", "  ", ". ", "\n", ",", "!?"])
        rows.append((text, pick.choice(["en", "en", "fr", None])))
    return rows + [(None, "en"), ("", "de"), ("one two", "de"), (" . \n", None)]


@pytest.fixture
def narrow(spark):
    """Many ranges of a few phrases each, left as they are."""
    settings = {"spark.sql.shuffle.partitions": "29", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 10, 2000), (4, 4, 9), (2, 10, 2000)])
def test_equals_counting(spark, narrow, longest, least, top):
    rows = some_rows(longest)
    found = run_collocations(spark.createDataFrame(rows, "text string, lang string"), least=least, longest=longest, top=top)
    wanted = brute(rows, least, longest, top)
    assert wanted and collected(found) == wanted


def test_equals_counting_in_one_range(spark):
    rows = some_rows(7)
    found = run_collocations(spark.createDataFrame(rows, "text string, lang string"), covered_percent=80, top=None)
    assert collected(found) == brute(rows, 10, 3, covered=80, top=10**9)


def test_filter_that_knows_every_phrase_changes_nothing(spark, monkeypatch):
    """Few bits are soon all set; counts stay exact."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 64)
    rows = some_rows(11)
    assert collected(run_collocations(spark.createDataFrame(rows, "text string, lang string"))) == brute(rows, 10, 3)


def test_scores_are_exact_beyond_64_bits(spark):
    many = 900_000_000_000_007
    a, l, r = many - 6, many, many - 1
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    product = collocations._exact("a") * collocations._exact("a") * F.lit(10**6).cast("decimal(7,0)")
    score = F.call_function("div", product, collocations._exact("l") * collocations._exact("r"))
    assert df.select(score).first()[0] == 10**6 * a * a // (l * r)


def test_odd_repeated_and_long_rows_and_clashing_columns(spark):
    docs = odd_documents(spark)
    docs = docs.union(docs).union(docs)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    extra = clashing(docs).withColumns({n: F.lit(1) for n in ("phrase", "f", "n", "rank", "a", "l", "r")})
    assert collected(run_collocations(extra, least=4)) == brute(rows, 4, 3)


def test_empty_table(spark):
    found = run_collocations(empty(spark))
    assert found.count() == 0 and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def joined_rows(plan):
    """The rows that all joins of an executed plan made."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return joined_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return joined_rows(plan.plan())
    children = plan.children()
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    return own + sum(joined_rows(children.apply(k)) for k in range(children.size()))


def test_only_phrases_at_seams_meet_a_join(spark, narrow):
    phrases = [("en", [f"w{i:03}", *rest], 20 - len(rest)) for i in range(300) for rest in ([], ["a"], ["a", "b"], ["b"])]
    df = spark.createDataFrame(phrases, "lang string, words array<string>, f long")
    walked = collocations._walked(df, 3, "left")
    found = {tuple(r["words"]): (r["left_1"], r["left_2"], r["left_most"]) for r in walked.collect()}
    assert 0 < joined_rows(walked._jdf.queryExecution().executedPlan()) < len(phrases) / 2
    wanted = {(): (None, None, 19), ("a",): (20, None, 18), ("a", "b"): (20, 19, 0), ("b",): (20, None, 0)}
    assert found == {tuple(words): wanted[tuple(words[1:])] for _, words, _ in phrases}
