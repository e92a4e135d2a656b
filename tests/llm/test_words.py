import random

import numpy as np
import pyarrow as pa
from helpers import folded, plain_words, shingles, space_words

from ledgerlane.llm.wordspace import ALPHANUMERIC, FOLD_ASCII, NOT_ASCII_SPACE, shingle_sets, text_chunks, words_of


def texts(count=300, seed=5):
    rng = random.Random(seed)
    made = ["".join(rng.choice("aBé \n\t0!中'") for _ in range(rng.randint(0, 40))) for _ in range(count)]
    return [*made, "", None, "x", " x", "x "]


def test_words_are_those_of_the_pattern_in_every_chunking():
    rows = texts()
    for table, reference in ((NOT_ASCII_SPACE, space_words), (ALPHANUMERIC, plain_words)):
        seen = {}
        for limit in (1, 64, 1 << 20):
            found = []
            for first, offsets, data in text_chunks(pa.array(rows), limit):
                assert first == len(found)
                data = FOLD_ASCII[data]
                words = words_of(data, offsets, table)
                for a, b in zip(words.bounds[:-1], words.bounds[1:]):
                    spelled = [bytes(data[s:e]).decode() for s, e in zip(words.starts[a:b], words.ends[a:b])]
                    for word, value in zip(spelled, words.hashes[a:b]):
                        assert seen.setdefault(word, value) == value
                    found.append(spelled)
            assert found == [reference(t) for t in rows]
        assert len(set(seen.values())) == len(seen)


def test_shingle_sets_have_the_sizes_of_sets():
    rows = texts(100, 6) + ["a b a b a b a b", "a b c", "a"]
    found = []
    for _, offsets, data in text_chunks(pa.array(rows)):
        found += list(shingle_sets(words_of(FOLD_ASCII[data], offsets, NOT_ASCII_SPACE), 4))
    expected = [shingles(space_words(t), 4) for t in rows]
    assert [len(s) for s in found] == [len(s) for s in expected]
    for i in range(len(rows)):
        for j in range(i):
            assert len(np.intersect1d(found[i], found[j])) == len(expected[i] & expected[j])
    assert folded("AÉ") == "aÉ"
