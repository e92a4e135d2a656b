import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCUMENTS, clashing, empty, odd_documents, rows_of, story
from tokenizers import Tokenizer

from ledgerlane.llm import bpe
from ledgerlane.llm.bpe import WordBpe, run_decode, run_encode
from ledgerlane.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(11)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "'s", "'LL", "don't", "İ", "Σ", "ΑΣ", "ß", "H̱", "É", "é",
             "́", " ", "　", "\xa0", "\x85", "\x0b", "\x1c", "\x00", "👍🏽", "日本語", "한국어", "½", "Ⅷ", "ﬁ", "Å", "ǅ", "९", "a" * 300, "ab" * 400]
    return ["".join(rng.choice(parts + list(" abcTHE12.,!?\n\t")) for _ in range(rng.randint(0, 25))) for _ in range(400)]


def test_ids_and_decoded_texts_are_those_of_the_library(spark, library):
    texts = [*odd_texts(), story(), "The the THE", "", None]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = run_encode(spark.createDataFrame(rows, DOCUMENTS), PATH, decoded=True, words=40).collect()
    assert len(found) == len(texts)
    for row in found:
        ids, decoded = expected(library, texts[row.doc_id])
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert (row.n_tokens, row.decoded) == (len(ids), decoded)


def test_awkward_rows(spark, library):
    documents = clashing(odd_documents(spark))
    encoded = run_encode(documents, PATH, words=50)
    assert encoded.columns == [c for c in documents.columns if c != "ids"] + ["n_tokens", "ids"]
    decoded = run_decode(encoded, PATH)
    assert rows_of(decoded, "doc_id", "n_tokens", "decoded") == sorted(
        ((r.doc_id, len(ids), text) for r in documents.collect() for ids, text in [expected(library, r.text)]), key=repr
    )
    assert rows_of(encoded, *documents.drop("ids").columns) == rows_of(documents, *documents.drop("ids").columns)
    assert run_encode(empty(spark), PATH, decoded=True).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert run_decode(nothing, PATH).first().decoded == ""


def test_compiled_words_are_bounded_in_bytes(spark, library, monkeypatch):
    compiled = []
    monkeypatch.setattr(bpe, "compile_lexicon", lambda entries: compiled.extend(entries) or compile_lexicon(entries))
    rng = random.Random(5)
    texts = ["".join(rng.choice("日本語文章、。") for _ in range(2000)) + " the the cat" for _ in range(20)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    for row in run_encode(spark.createDataFrame(rows, DOCUMENTS), PATH).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == expected(library, texts[row.doc_id])[0]
    assert sorted(w for w, _ in compiled) == [b"cat", b"the"]
    compiled.clear()
    monkeypatch.setattr(bpe, "LEXICON_BYTES", 5)
    run_encode(spark.createDataFrame(rows, DOCUMENTS), PATH).collect()
    assert [w for w, _ in compiled] == [b"the"]


def test_long_pieces_merge_as_short_ones():
    model, rng = WordBpe(PATH), random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("thineraé") for _ in range(rng.randint(1, 60)))
        assert model.merge(piece) == model.merge_long(piece)


@pytest.mark.parametrize("seed", range(4))
def test_lexicon_finds_its_words_only(tmp_path, seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("ab日") for _ in range(rng.randint(1, 8))).encode() for _ in range(300)})
    entries = [(w, [rng.randrange(1000) for _ in range(rng.randint(0, 4))]) for w in words]
    path = tmp_path / "lexicon"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(path))
    asked = words + [w + b"x" for w in words] + [w[:-1] or b"z" for w in words]
    data = np.frombuffer(b"".join(asked), np.uint8)
    ends = np.cumsum([len(w) for w in asked])
    numbers = lexicon.numbers(data, ends - [len(w) for w in asked], ends)
    known = dict(entries)
    for word, number in zip(asked, numbers.tolist()):
        assert (number >= 0) == (word in known)
        if number >= 0:
            assert lexicon.ids[lexicon.ends[number] : lexicon.ends[number + 1]].tolist() == known[word]
    assert len(lexicon.final) < sum(map(len, words))  # suffixes are shared
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).numbers(data, ends - 1, ends).tolist() == [-1] * len(asked)


def test_forgetting_pieces_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    model = WordBpe(PATH)
    for text in odd_texts()[:100]:
        assert [i for w in text.split(" ") for i in model.encode_word(w)] == [
            i for w in text.split(" ") for i in expected(library, w)[0]
        ]


def test_a_word_of_a_quarter_megabyte(spark, library):
    """Merged whole, in time that grows little faster than its length."""
    pick = random.Random(2)
    long = "".join(pick.choice("abcdefghij") for _ in range(1 << 18))
    rows = [(1, long), (2, f"short {long[:5000]} end"), (3, None)]
    found = run_encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH, decoded=True)
    found = {r["doc_id"]: (np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found.collect()}
    assert found == {number: expected(library, text) for number, text in rows}


def test_taking_needs_little_more_than_what_is_taken():
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 256, 1 << 16).astype(np.uint8)
    lengths = rng.integers(0, 30, 200_000)
    lengths[[5, 100_000]] = 60_000
    starts = rng.integers(0, len(flat) - lengths + 1)
    tracemalloc.start()
    try:
        taken = bpe._take(flat, starts, lengths)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert taken.tobytes() == b"".join(flat[a : a + n].tobytes() for a, n in zip(starts, lengths))
    assert most < 4 * len(taken)
    assert not len(bpe._take(flat, starts[:0], lengths[:0])) and not len(bpe._take(flat, starts[:2], lengths[:2] * 0))
