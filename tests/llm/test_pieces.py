"""Sentence pieces against the library that the model file belongs to."""

import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from helpers import clashing, empty, odd_documents
from pyspark.sql import functions as F

from ledgerlane.llm import pieces
from ledgerlane.llm.pieces import CharacterMap, PieceModel, decode_pieces, encode_chunk, encode_pieces, normalized, normalized_chunk
from ledgerlane.llm.wordspace import text_chunks

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "",
    "  ",
    " a",
    "a  b   ",
    "é 🙂 \x00 x▁y",
    "▁▁ a▁b",
    "a\n\nb\t c",
    " " * 300 + "x" * 300 + " é" * 3,
    "aaaa" * 100,
    "<s> <0x41> </s><unk>",
    "á�ﬁ Å",
    "ab" * 3000 + "日本語" * 200,
    "🙂" * 3,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def test_ids_texts_and_spans_are_the_librarys(model, library):
    decoder = pieces.PieceDecoder(model)
    for first, offsets, data in text_chunks(pa.array(TEXTS), 4096):
        ids, begin, end, bounds = encode_chunk(model, data, offsets)
        texts = decoder.texts(ids, bounds)
        for r in range(len(offsets) - 1):
            text, at = TEXTS[first + r], slice(bounds[r], bounds[r + 1])
            wanted = library.encode(text, num_threads=1)
            assert ids[at].tolist() == wanted and texts[r] == library.decode(wanted)
            proto = library.encode(text, return_type="proto")
            assert list(zip(begin[at].tolist(), end[at].tolist())) == [(p.begin, p.end) for p in proto.pieces]


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = encode_pieces(docs, PATH, spans=True, decoded=True).collect()
    assert len(found) == docs.count()
    for row, text in zip(sorted(found), [r["text"] for r in sorted(docs.collect())]):
        wanted = library.encode(text or "", num_threads=1)
        assert row["ids"] == wanted and row["n_tokens"] == len(wanted) and row["decoded"] == library.decode(wanted)
        spans = np.frombuffer(row["spans"], "<u4").reshape(-1, 2)
        whole = (text or "").encode()
        assert b"".join(whole[a:b] for a, b in spans.tolist()) == whole


def test_odd_rows_repeated_rows_and_clashing_columns(spark, library):
    docs = odd_documents(spark)
    extra = clashing(docs).withColumns({n: F.lit(n) for n in ("decoded", "spans", "n_tokens", "source_text", "a.b")})
    found = encode_pieces(extra, PATH, decoded=True)
    assert set(extra.columns) <= set(found.columns) and len(found.columns) == len(set(found.columns))
    got = sorted(((r["doc_id"], r["text"], tuple(r["ids"]), r["decoded"], r["copies"]) for r in found.collect()), key=repr)
    wanted = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", num_threads=1)
        wanted.append((r["doc_id"], r["text"], tuple(ids), library.decode(ids), "copies"))
    assert got == sorted(wanted, key=repr)


def test_empty_table(spark):
    assert encode_pieces(empty(spark), PATH, spans=True, decoded=True).count() == 0


def test_decoding_any_ids(spark, library):
    lists = [[], None, [28705, 28705, 264], [3 + 0xE9, 264], [3 + 0xE2, 3 + 0x96, 3 + 0x81, 264], [1, 264, 0, 2], [264, 3 + 0xFF, 3 + 0xC3, 3 + 0xA9]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n int, ids array<int>")
    found = {r["n"]: r["decoded"] for r in decode_pieces(df, PATH).collect()}
    assert found == {i: library.decode(x or []) for i, x in enumerate(lists)}


def _trie(replacements):
    """A compiled character map, placed by trying every base in turn."""
    texts, at = b"", {}
    for source, target in sorted(replacements.items()):
        at[source] = len(texts)
        texts += target + b"\0"
    units, used, bases = {0: 0}, {0}, set()

    def place(node, prefix):
        nexts = sorted({s[len(prefix)] for s in replacements if s.startswith(prefix) and len(s) > len(prefix)})
        labels = ([0] if prefix in replacements else []) + nexts
        base = next(b for b in range(1, 1 << 20) if b not in bases and all((b ^ x) not in used for x in labels))
        bases.add(base)
        used.update(base ^ x for x in labels)
        units[node] = units.get(node, 0) | (base ^ node) << 10 | (0x100 if prefix in replacements else 0)
        if prefix in replacements:
            units[base] = 0x80000000 | at[prefix]
        for x in nexts:
            units[base ^ x] = x
        for x in nexts:
            place(base ^ x, prefix + bytes([x]))

    place(0, b"")
    array = [units.get(i, 0x7F) for i in range(max(used) + 256)]
    return struct.pack("<I", 4 * len(array)) + struct.pack(f"<{len(array)}I", *array) + texts


def test_longest_prefixes_of_a_character_map(model):
    mapped = {"ﬁ".encode(): b"fi", b"a": b"b", b"abc": b"xy", "é".encode(): b"e", b"\t": b" ", b"\r": b""}
    characters = CharacterMap(_trie(mapped))
    assert characters.longest(b"abc", 0) == (3, b"xy") and characters.longest(b"abd", 0) == (1, b"b")
    assert characters.longest(b"zabc", 0) is None and characters.longest(b"zabc", 1) == (3, b"xy")

    other = PieceModel(PATH)
    other.characters = characters
    text, places = normalized(other, "ﬁ\tabcé\rz".encode())
    assert text.decode() == "▁fi▁xyez"
    assert places == [0, 0, 0, 0, 0, 3, 3, 3, 4, 4, 7, 10, 11]
    other.trimmed = True
    text, places = normalized(other, b"  a\t z  ")
    assert text.decode() == "▁b▁z" and places == [2, 2, 2, 2, 3, 3, 3, 5, 6]
    assert normalized(other, b" \t ") == (b"", [0])


def test_both_ways_of_normalising_agree(model):
    for _, offsets, data in text_chunks(pa.array(TEXTS), 4096):
        made, bounds, places = normalized_chunk(model, data, offsets)
        for r in range(len(offsets) - 1):
            text, at = normalized(model, data[offsets[r] : offsets[r + 1]].tobytes())
            assert made[bounds[r] : bounds[r + 1]].tobytes() == text
            # Within a character the plain way counts on, the other stays at its start.
            starts = [k for k, byte in enumerate(text) if byte & 0xC0 != 0x80]
            found = places[bounds[r] + r : bounds[r + 1] + r + 1]
            assert found[starts].tolist() == [at[k] for k in starts] and found[-1] == at[-1]
