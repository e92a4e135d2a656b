"""The operators that are column expressions only: urls, fingerprints, chats."""

import hashlib
import random
import re

import pytest
import xxhash
from helpers import DOCUMENTS, clashing, empty, odd_documents, rows_of
from pyspark.sql import functions as F

from ledgerlane.llm.chat import PARTS, format_chat, read_content, read_loss, read_role, text_parts
from ledgerlane.llm.fingerprints import as_text, containment, likeness, repeated, run_fingerprints, with_sketch
from ledgerlane.llm.queries import RULES
from ledgerlane.llm.url_filter import Rule, run_judge

PAGES = "page_id long, url string"
MESSAGES = "conv_id long, turn int, role string, text string"


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame(list(enumerate(urls)), PAGES)
    return [tuple(r)[1:] for r in run_judge(pages, rules).orderBy("page_id").collect()]


def test_rules_by_host_and_path(spark):
    found = judged(
        spark,
        [
            "https://WWW.Example.ORG/en/1x?q#f", "http://example.org/en/2", "x://a.com/fr/1", "x://a.com/de/", "x://org", "x://notorg/",
            "http://example.org/es", "http://example.org/es/", "no scheme", None, "a://b.org?x=/y", "a://b.org/c://d.com/de/", "://h.org/p\nq#z",
        ],
    )
    assert [r[:3] for r in found] == [
        ("www.example.org", "/en/1x", "example.org/en/1"), ("example.org", "/en/2", "org/"), ("a.com", "/fr/1", "com/fr/"),
        ("a.com", "/de/", "com/de/"), ("org", "", None), ("notorg", "/", None), ("example.org", "/es", "org/"),
        ("example.org", "/es/", "example.org/es/"), ("", "", None), ("", "", None), ("b.org", "", None),
        ("b.org", "/c://d.com/de/", "org/"), ("h.org", "/p\nq", "org/"),
    ]
    assert [r[3] for r in found][:4] == ["block", "allow", "allow", "block"]
    assert all(r[3] in ("allow", "block") for r in found)


def test_reputation_shrinks_hosts_to_their_domain(spark):
    rules = (Rule("allow", "net/good/"), Rule("block", "net/bad/"))
    urls = [f"http://a{i}.fine.net/good/{k}" for i in range(5) for k in range(30)]
    urls += [f"http://b{i}.poor.net/bad/{k}" for i in range(5) for k in range(30)]
    asked = ["http://a0.fine.net/", "http://new.fine.net/", "http://b0.poor.net/", "http://new.poor.net/"]
    verdicts = [r[3] for r in judged(spark, asked + urls, rules)][:4]
    assert verdicts == ["allow", "allow", "block", "block"]
    asked.append("http://mixed.fine.net/")
    urls += [f"http://mixed.fine.net/bad/{k}" for k in range(40)]
    verdicts = [r[3] for r in judged(spark, asked + urls, rules)][:5]
    # One host that differs makes the domain say less about a host nobody knows.
    assert verdicts == ["allow", "block", "block", "block", "block"]


def test_awkward_pages(spark):
    rows = [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://b.net/"), (2, None), (3, "")]
    pages = spark.createDataFrame([(*r, "h", "p", 1, 2, 3) for r in rows], PAGES + ", host string, path string, good int, labelled int, prior int")
    found = run_judge(pages, RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert rows_of(found, "page_id", "host", "path", "rule") == sorted(
        [(1, "a.org", "/x", "org/"), (1, "a.org", "/x", "org/"), (None, "b.net", "/", None), (2, "", "", None), (3, "", "", None)], key=repr
    )
    assert {r.verdict for r in run_judge(pages, []).collect()} == {"block"}
    assert run_judge(empty(spark, PAGES), RULES).collect() == []


def edits(rows):
    """Edited text and the next document's text by id, and the plain shingle sets."""
    ordered = sorted(rows, key=lambda r: -r[0])
    for place, (number, text) in enumerate(ordered):
        following = ordered[(place + 1) % len(ordered)][1] or ""
        text = text or ""
        cut = len(text) // 3
        yield number, text, text[: len(text) - cut] + following[:cut], following


def test_fingerprints_of_edited_texts(spark):
    rows = [(i * 7 % 101, " ".join(f"é{(i // 2 * j) % 53}" for j in range(i % 40))) for i in range(60)]
    frame = spark.createDataFrame([(i, t or None, None, None, None) for i, t in rows], DOCUMENTS)
    found = run_fingerprints(frame).select("*", likeness("sketch", "edited_sketch").alias("near"), as_text("sketch").alias("print"))
    found = {r.doc_id: r for r in found.collect()}
    assert len(found) == 60
    prints = {}
    for number, text, edited, following in edits(rows):
        row = found[number]
        assert (row.n_chars, row.edited) == (len(text), edited)
        assert prints.setdefault(text, row.print) == row.print
        assert len(row.sketch) * 16 == len(row.print) and (row.sketch or not text.strip())
        assert row.near == 1 if text == edited else 0 <= row.near <= 1


def test_sketches_merge_and_estimate_containment(spark):
    words = [f"w{i}" for i in range(6000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:600]))]
    frame = with_sketch(spark.createDataFrame(rows, "i int, text string"), "text", "s").drop("text")
    both = frame.where("i = 1").select(F.col("s").alias("a")).join(frame.where("i = 2").select(F.col("s").alias("b")))
    row = both.select(likeness("a", "b").alias("j"), containment("b", "a").alias("c"), F.size("a").alias("n")).first()
    assert row.c == 1 and abs(row.j - 0.1) < 0.02 and abs(row.n - 1500) < 150


def test_awkward_documents(spark):
    documents = clashing(odd_documents(spark))
    found = repeated(run_fingerprints(documents).drop("next_sketch"))
    assert rows_of(found, "doc_id") == rows_of(documents, "doc_id")
    by_id = {r.doc_id: r for r in found.collect()}
    assert by_id[2].n_chars == 0 and by_id[2].edited == "" and by_id[2].sketch == []
    assert by_id[1].edited.endswith(odd_documents(spark).where("doc_id is null").first().text[: by_id[1].n_chars // 3])
    assert by_id[None].edited[-3:] == "aaa"  # around the end to the greatest id
    assert run_fingerprints(empty(spark)).collect() == []
    alone = spark.createDataFrame([(1, "abcdef", None, None, None)] * 3, DOCUMENTS)
    assert [tuple(r) for r in repeated(run_fingerprints(alone).select("doc_id", "edited", "copies")).collect()] == [(1, "abcdab")] * 3


@pytest.mark.parametrize("copies", [1, 4096, 9000])
def test_copies_are_all_put_out(spark, copies):
    rows = spark.createDataFrame([(5, copies)], "doc_id long, copies long")
    assert repeated(rows).count() == copies


def said(spark, rows):
    messages = spark.createDataFrame(rows, MESSAGES)
    return format_chat(messages.withColumn("parts", text_parts(F.col("text"))))


def test_chats_read_back(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|>user<|says|>x<|end|>", "\\", "\\<|", "<\\|end|>", "a<", "|>", "", None, "é\n👍", "<<||>>\\\\"]
    rows = [(c, t, "assistant" if (t + c) % 2 else "<|user|>", texts[(t * 3 + c) % len(texts)]) for c in range(6) for t in range(9)]
    found = said(spark, rows).select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(read_role(t["text"]), read_content(t["text"]), read_loss(t))).alias("back"),
        "formatted",
        "turns",
    )
    for row in found.collect():
        expected = [(r, t or "") for c, _, r, t in rows if c == row.conv_id]
        assert [tuple(b)[:2] for b in row.back] == expected
        assert [tuple(b)[2] for b in row.back] == [t if r == "assistant" else "" for r, t in expected]
        assert row.formatted == "".join(t.text for t in row.turns)
        assert row.formatted.count("<|turn|>") == 9 and len(re.findall(r"<\|end\|>", row.formatted)) == 9


def test_parts_become_placeholders(spark):
    schema = f"conv_id long, turn int, role string, parts {PARTS}"
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [
        (1, 0, "user", [text("see <|image|> "), ("image", None, "s3://i", 56, 29, None, None), text("!"), ("audio", None, "a.wav", None, None, 1.5, None)]),
        (1, 1, "assistant", [text("ok"), ("document", None, "d.pdf", None, None, None, 2), ("other", "y", None, None, None, None, None)]),
        (1, 2, None, None),
        (2, 0, "user", [("image", None, None, None, 5, None, None)]),
    ]
    found = {r.conv_id: r for r in format_chat(spark.createDataFrame(rows, schema)).collect()}
    one = found[1]
    assert one.formatted == (
        "<|turn|>user<|says|>see <\\|image|> <|image|>!<|audio|><|end|>"
        "<|turn|>assistant<|says|>ok<|document|>y<|end|><|turn|><|says|><|end|>"
    )
    assert [tuple(a) for a in one.attachments] == [
        (0, 0, "image", "s3://i", 4), (0, 1, "audio", "a.wav", 38), (1, 2, "document", "d.pdf", 2048),
    ]
    assert one.attachment_tokens == 2090 and [t.loss_length for t in one.turns] == [0, 15, 0]
    assert found[2].attachment_tokens == 0 and found[2].attachments[0].ref is None


def test_awkward_chats(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "first"), (None, 0, "user", "b"), (None, 0, "user", "c"), (2, 0, None, "x" * 100_000)]
    messages = spark.createDataFrame([(*r, "z", 1) for r in rows], MESSAGES + ", formatted string, turns int")
    found = format_chat(messages.withColumn("parts", text_parts(F.col("text"))))
    sizes = sorted(((r.conv_id, len(r.turns), len(r.formatted)) for r in found.collect()), key=repr)
    assert sizes == sorted([(1, 3, 3 * 23 + 4 + 1 + 4 + 1 + 9 + 5), (2, 1, 100_023), (None, 1, 28), (None, 1, 28)], key=repr)
    assert found.where("conv_id = 1").first().turns[0].text == "<|turn|>assistant<|says|>first<|end|>"
    assert said(spark, [(9, 0, "user", "q")]).where("false").collect() == []
    assert format_chat(empty(spark, f"conv_id long, turn int, role string, parts {PARTS}")).collect() == []
    digest = hashlib.sha256(b"user\nq\n").hexdigest()
    one = said(spark, [(9, 0, "user", "q")])
    assert one.select(F.sha2(F.concat(read_role(F.col("turns")[0]["text"]), F.lit("\n"), read_content(F.col("turns")[0]["text"]), F.lit("\n")), 256).alias("d")).first().d == digest


def test_equal_turns_and_roles_are_ordered_by_what_they_say(spark):
    rows = [(1, 0, "user", t) for t in ("ab", "ab c", "a<|b", "a\\b", "a", "a b")]
    messages = spark.createDataFrame(rows, MESSAGES).withColumn("parts", text_parts(F.col("text")))
    turns = format_chat(messages).select(F.transform("turns", lambda t: read_content(t["text"])).alias("said")).first()["said"]
    assert turns == sorted(r[3] for r in rows)


def plain_sketch(text):
    """The sketch with the public hash of the xxhash library, chained over the words of a shingle as Spark does."""

    def chained(words):
        value = 42
        for word in words:
            value = xxhash.xxh64_intdigest(word.encode(), value)
        return value - (1 << 64) if value >> 63 else value

    words = re.findall(r"[^ \t\n\x0B\f\r]+", text)
    runs = [words[i : i + 5] for i in range(len(words) - 4)] or ([words] if words else [])
    hashes = [chained(run) for run in runs]
    return sorted({h for h in hashes if h < -(2**63) + 2**64 // 4}) or sorted(hashes)[:1]


def test_fingerprints_and_likeness_equal_plain_counting(spark):
    pick = random.Random(6)
    rows = []
    for i in range(70):
        words = [f"w{pick.randrange(40)}" for _ in range(pick.choice([0, 1, 4, 5, 9, 60, 200]))]
        rows.append((i, pick.choice([" ", "\n", "  "]).join(words)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies under other ids
    found = {r["doc_id"]: r for r in run_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "sketch", "edited_sketch", likeness("sketch", "edited_sketch").alias("near"), likeness("sketch", "next_sketch").alias("after")
    ).collect()}

    def alike(a, b):
        return len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0

    for number, text, edited, following in edits(rows):
        own, changed = plain_sketch(text), plain_sketch(edited)
        row = found[number]
        assert row["sketch"] == own and row["edited_sketch"] == changed
        assert row["near"] == pytest.approx(alike(own, changed)) and row["after"] == pytest.approx(alike(own, plain_sketch(following)))
