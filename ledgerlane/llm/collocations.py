"""Phrases whose words stand together more often than apart, from counts kept as two sorted streams.

Frequent phrases of all lengths are one stream. In prefix order a phrase follows the phrases that it
continues, so one walk sees the count of every left part and the most frequent extension to the right.
In suffix order, by words from the last to the first, the same walk sees right parts and extensions to
the left. No count is looked up by hash. The streams are cut into ranges of the order, so a word that
very many phrases begin with is walked by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut, discard, share_file
from ledgerlane.llm.wordspace import FOLD_ASCII, Words, distinct_spans, gathered, mixed, text_chunks, words_of

#: Text whose phrases are counted before they are shuffled.
CHUNK_BYTES = 1 << 20
#: Bits that say which phrases may be frequent. Beyond that many phrases it leaves out less, never too much.
FILTER_BITS = 1 << 26
SCALE = 1_000_000
#: Walked rows: all counts known, some perhaps in other ranges, or the most frequent extension that a range begins with.
WHOLE, SEAM, LEAD = range(3)
UNKNOWN_LANGUAGE = "und"

IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[0x20, 0x09]] = False


def _language_hash(language: str) -> int:
    return zlib.crc32(language.encode()) * 0x9E3779B97F4A7C15 & (2**64 - 1)


def _run_hashes(words: Words, languages: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` words from each word on; what passes the end of a text is never asked for."""
    found = mixed(words.hashes ^ languages)
    for k in range(1, width):
        found = mixed(found[:-1] * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k:])
    return found


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunks of folded texts; texts that are longer than a chunk come in parts that end where a piece of text does."""
    for start, offsets, data in text_chunks(column, CHUNK_BYTES):
        data = FOLD_ASCII[data]
        if len(offsets) > 2 or len(data) <= 2 * CHUNK_BYTES:
            yield start, offsets, data
            continue
        ends, at = np.append(np.flatnonzero(IS_BREAK[data]), len(data)), 0
        while at < len(data):
            later = np.searchsorted(ends, at + CHUNK_BYTES, side="right")
            end = int(ends[max(later - 1, np.searchsorted(ends, at + 1))])
            yield start, np.array([0, end - at]), data[at:end]
            at = end


def _counts(rows: DataFrame, width: int, filtered: str | None) -> DataFrame:
    """(lang, phrase, f) of phrases of `width` words, and of a null phrase for all words if that is one.

    `filtered` is the shared file with the bits of those one word shorter; phrases of which a part is
    not in it can't be frequent.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.memmap(SparkFiles.get(filtered), dtype=np.uint8, mode="r") if filtered else None
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            names = coded.dictionary.to_pylist()
            hashes = np.array([_language_hash(name) for name in names], dtype=np.uint64)
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for start, offsets, data in _parts(batch.column("text")):
                words = words_of(data, offsets, IS_WORD)
                if not len(words.starts):
                    continue
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.bounds))
                language = codes[start:][row]
                # Words that follow each other within a piece of text.
                breaks = np.concatenate([[0], np.cumsum(IS_BREAK[data], dtype=np.int32)])
                linked = (row[1:] == row[:-1]) & (breaks[words.starts[1:]] == breaks[words.ends[:-1]])
                linked = np.append(linked, False)
                at = np.arange(len(row))
                for k in range(1, width):
                    at = at[linked[at + k - 1]]
                if bits is not None:
                    slots = _run_hashes(words, hashes[language], width - 1) & np.uint64(FILTER_BITS - 1)
                    known = bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 1
                    at = at[known[at] & known[at + 1]]
                first, member = distinct_spans(data, words.starts, words.ends)
                runs, values = language[at], len(names)
                for k in range(width):
                    if values * len(first) >= 1 << 62:
                        _, runs = np.unique(runs, return_inverse=True)
                        values = len(at)
                    runs, values = runs * len(first) + member[at + k], values * len(first)
                _, which, found = np.unique(runs, return_index=True, return_counts=True)
                at = at[which]
                # The words of each phrase, with a space after each of them but the last.
                places = (at[:, None] + np.arange(width)).ravel()
                lengths = words.ends[places] - words.starts[places]
                spaced = np.append(data, np.uint8(0x20))
                last = np.arange(len(places)) % width == width - 1
                sizes = np.stack([lengths, np.where(last, 0, 1)], axis=1).ravel()
                begins = np.stack([words.starts[places], np.full(len(places), len(data))], axis=1).ravel()
                text = gathered(spaced, begins, sizes)
                ends = np.concatenate([[0], np.cumsum(sizes.reshape(-1, 2 * width).sum(axis=1))])
                phrases = pa.Array.from_buffers(
                    pa.large_string(), len(at), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())]
                ).cast(pa.string())
                owners, found = language[at], found.astype(np.int64)
                if width == 1:
                    present, total = np.unique(language, return_counts=True)
                    phrases = pa.concat_arrays([phrases, pa.nulls(len(present), pa.string())])
                    owners, found = np.concatenate([owners, present]), np.concatenate([found, total])
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary.take(pa.array(owners)), phrases, pa.array(found)], names=["lang", "phrase", "f"]
                )

    return rows.mapInArrow(count, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _run_filter(phrases: DataFrame, width: int) -> str:
    """Shares the bits of frequent phrases; at most FILTER_BITS / 64 rows come to the driver."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = np.array([_language_hash(x) for x in batch.column("lang").to_pylist()], dtype=np.uint64)
            for start, offsets, data in text_chunks(batch.column("phrase"), CHUNK_BYTES):
                words = words_of(data, offsets, IS_WORD)
                row = np.repeat(np.arange(len(offsets) - 1), np.diff(words.bounds))
                found = _run_hashes(words, languages[start:][row], width)[words.bounds[:-1]] & np.uint64(FILTER_BITS - 1)
                bit = np.uint64(1) << (found & np.uint64(63))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((found >> np.uint64(6)).astype(np.int32)), pa.array(bit.view(np.int64))], names=["block", "bits"]
                )

    blocks = phrases.select("lang", "phrase").mapInArrow(slots, "block int, bits long")
    found = blocks.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, dtype="<i8")
    bits[found.column("block").to_numpy()] = found.column("bits").to_numpy()
    return share_file(phrases.sparkSession, "frequent", bits.tobytes())


def _walked(phrases: DataFrame, longest: int, side: str) -> DataFrame:
    """`phrases` with the counts of their first words and of their most frequent extension by one word.

    Sorted by language and words, a phrase comes after those that it continues. The open ones are a stack;
    a phrase leaves it, with the most frequent extension, when another begins. Columns {side}_1, {side}_2
    ... are the counts of the first word, of the first two and so on, as far as a phrase is longer;
    {side}_most is 0 without extension. A range that begins within extensions of earlier phrases lacks
    at most longest - 1 of them. These few are found, per range, and put in by a broadcast of as many rows.
    Only rows that stand at the seam of two ranges meet it: those that lack a count of their first words, and
    those still open at the end of a range, whose extensions may go on in the next.
    """
    columns = ["lang", "words", "f", *(c for c in phrases.columns if c not in ("lang", "words", "f"))]
    heads = [f"{side}_{k}" for k in range(1, longest)]
    names = [*columns, *heads, f"{side}_most", "kind"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # [language and words, count, most frequent extension, whole row]
        leads: dict[tuple, int] = {}
        out: list[tuple] = []

        def put(entry: list, ended: bool = True) -> None:
            lacking = None in entry[3][len(columns) : len(columns) + len(entry[0]) - 2]
            out.append((*entry[3], entry[2], WHOLE if ended and not lacking else SEAM))

        def made(schema: pa.Schema) -> pa.RecordBatch:
            kinds = [*(schema.field(c).type for c in columns), *[pa.int64()] * (len(heads) + 1), pa.int8()]
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out.clear()
            return rows

        schema = None
        for batch in batches:
            schema = batch.schema
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                key, f = (row[0], *row[1]), row[2]
                while stack and stack[-1][0] != key[: len(stack[-1][0])]:
                    put(stack.pop())
                found = [None] * len(heads)
                for above in stack:
                    found[len(above[0]) - 2] = above[1]
                if len(key) > 2:
                    if stack and len(stack[-1][0]) == len(key) - 1:
                        stack[-1][2] = max(stack[-1][2], f)
                    else:
                        leads[key[:-1]] = max(leads.get(key[:-1], 0), f)
                stack.append([key, f, 0, (*row, *found)])
            if out:
                yield made(schema)
        while stack:
            put(stack.pop(), ended=False)
        for key, most in leads.items():
            out.append((key[0], list(key[1:]), *[None] * (len(names) - 4), most, LEAD))
        if out:
            yield made(schema)

    ordered = phrases.select(*columns).repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
    kinds = dict(phrases.dtypes)
    fields = [f"{n} {kinds[n]}" for n in columns] + [f"{n} long" for n in (*heads, f"{side}_most")]
    walked = cut(ordered.mapInArrow(walk, ", ".join([*fields, "kind byte"])))

    leads = walked.where(F.col("kind") == LEAD).groupBy("lang", "words").agg(F.max(f"{side}_most").alias("lead_most"))
    seam = walked.where(F.col("kind") == SEAM).drop("kind")
    asked = cut(phrases.select("lang", "words", "f").join(F.broadcast(leads), ["lang", "words"]))
    later = F.broadcast(asked.select("lang", "words", "lead_most"))
    seam = seam.join(later, ["lang", "words"], "left")
    seam = seam.withColumn(f"{side}_most", F.greatest(f"{side}_most", F.coalesce("lead_most", F.lit(0)))).drop("lead_most")
    for k, head in enumerate(heads, 1):
        parts = F.broadcast(asked.where(F.size("words") == k).select(F.col("lang").alias("l"), F.col("words").alias("w"), F.col("f").alias("head_f")))
        lacking = (F.size("words") > k) & F.col(head).isNull()
        part = F.when(lacking, F.slice("words", 1, k))
        seam = seam.join(parts, (seam["lang"] == F.col("l")) & (part == F.col("w")), "left")
        seam = seam.withColumn(head, F.coalesce(head, "head_f")).drop("l", "w", "head_f")
    return walked.where(F.col("kind") == WHOLE).drop("kind").unionByName(seam)


def _exact(column: Column | str) -> Column:
    """A count of up to 15 digits, so that the products below have at most 38."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(15,0)")


def run_collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 10,
    longest: int = 3,
    top: int | None = 2000,
    covered_percent: int = 50,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of 2 to `longest` words by score, best first.

    Texts, A-Z folded, are split at `.,;:!?` and line ends into pieces, these at spaces and tabs into
    words. a is the number of times a phrase occurs within pieces, n that of all words of its language.
    Cut after its first words, a phrase has the score floor(10^6 a a / (l r)), with l and r the counts of
    both parts; the cut with the lowest score counts, of equal ones the one with fewer words before it.
    Phrases that occur `least` times are candidates. One that a longer candidate contains, with
    `covered_percent` of its count or more, is left out. `top` bounds the phrases of a language; None
    returns all. Equal scores are ordered by a, then by the bytes of the phrase.

    Arithmetic is exact up to counts of 15 digits. Rows without language are of `und`. Null and empty
    texts have no words, repeated rows are counted each, texts of any length are counted whole, other
    columns are not read, and an empty table gives an empty result.
    """
    rows = documents.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"),
        F.col(f"`{text}`").cast("string").alias("text"),
    ).where(F.col("text").isNotNull())
    levels, bits = [], None
    for width in range(1, longest + 1):
        frequent = (F.col("f") >= least) | F.col("phrase").isNull()
        levels.append(cut(_counts(rows, width, bits).where(frequent)))
        if width < longest:
            bits = _run_filter(levels[-1].where(F.col("phrase").isNotNull()), width)
    totals = levels[0].where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    streams = [level.where(F.col("phrase").isNotNull()) for level in levels]
    phrases = streams[0]
    for stream in streams[1:]:
        phrases = phrases.union(stream)
    phrases = phrases.select("lang", F.split("phrase", " ").alias("words"), "f")

    by_prefix = _walked(phrases, longest, "left")
    reversed_words = by_prefix.withColumn("words", F.reverse("words"))
    both = _walked(cut(reversed_words), longest, "right")
    size = F.size("words")
    rights = F.array(*[F.col(f"right_{k}") for k in range(1, longest)])
    cuts = []
    for k in range(1, longest):
        left, right = F.col(f"left_{k}"), F.element_at(rights, size - k)
        product = _exact("f") * _exact("f") * F.lit(SCALE).cast("decimal(7,0)")
        score = F.call_function("div", product, _exact(left) * _exact(right))
        cuts.append(F.when(size > k, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))))
    longer = F.greatest("left_most", "right_most")
    candidates = both.where((size > 1) & (100 * longer < covered_percent * F.col("f"))).select(
        "lang", F.array_join(F.reverse("words"), " ").alias("phrase"), F.col("f").alias("a"), F.array_min(F.array(*cuts)).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    discard(*levels[1:])
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
