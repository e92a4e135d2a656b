"""Small tables that hold the awkward rows every text operator has to bear."""

import re
import string

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

STORY = "the quick brown fox jumps over the lazy dog while nine grey geese cross one narrow river at dawn".split()


def story(*changes):
    """The story with some words replaced: (place, word) pairs."""
    words = list(STORY)
    for place, word in changes:
        words[place] = word
    return " ".join(words)


def odd_documents(spark):
    """Nulls in every column, blank, short and very long texts, repeated rows."""
    long_text = " ".join(f"w{i % 977} x{i}" for i in range(40_000))
    rows = [
        (1, story(), "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \n\t", "en", None, 3),
        (5, long_text, "en", "a", len(long_text)),
        (6, "é", "fr", "a", 1),
        (None, story((0, "A")), None, None, None),
        (1, story(), "en", "a", 10),
        (7, "a" * 70_000, "en", "a", 70_000),
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark, schema=DOCUMENTS):
    return spark.createDataFrame([], schema)


def clashing(documents):
    """The same rows with more columns, named like those that operators make."""
    from pyspark.sql import functions as F

    names = "id words score hits items spans label class size u v c0 digest statistics changed packed ids copies key half found".split()
    return documents.select("*", *(F.lit(n).alias(n) for n in names))


def folded(text):
    return (text or "").translate(FOLD)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", folded(text))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))


def shingles(words, width):
    if len(words) >= width:
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)
