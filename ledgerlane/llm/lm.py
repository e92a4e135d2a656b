"""Stupid-backoff scores of documents by word-pair counts of the other documents."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut, discard
from ledgerlane.llm.tables import Bits, Counts, run_bits, run_counts
from ledgerlane.llm.wordspace import ALPHANUMERIC, FOLD_ASCII, text_chunks, words_of

BACKOFF = 0.4
#: Counts are put together over so many words of a task before they are shuffled.
SHARD_WORDS = 1 << 22
#: Words that occur so often are worth a place in the table of counts that tasks have at hand.
FREQUENT = 16
#: Pairs of all texts go through the shuffle in so many turns (a power of two), by their keys, so that less
#: lies on disk at a time.
TURNS = 2
_FOLD = np.uint64(0xA0761D6478BD642F)


def half(id_column: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 2, F.lit(0)).cast("int")


def _rows_of(bounds: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def _chunk_words(offsets: np.ndarray, data: np.ndarray, folds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of every word; words of rows of fold 1 are others than those of fold 0."""
    words = words_of(FOLD_ASCII[data], offsets, ALPHANUMERIC)
    rows = _rows_of(words.bounds)
    return rows, words.hashes ^ folds[rows].astype(np.uint64) * _FOLD


def _pair_places(rows: np.ndarray) -> np.ndarray:
    """Where the second word of every two consecutive words of a row stands."""
    return np.flatnonzero(rows[1:] == rows[:-1]) + 1 if len(rows) else np.zeros(0, np.int64)


def _key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for two words, or the word itself where the first is 0."""
    return (first * np.uint64(0x9E3779B97F4A7C15) ^ (first >> np.uint64(29))) + second


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    fresh = np.ones(len(ordered), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(fresh)


def _order(leading: np.ndarray, bits: int) -> np.ndarray:
    """An order by the leading bits of the numbers, all but the last `bits`, which hold any place in them: places are
    sorted along in these bits, as a sort of plain numbers takes a fraction of the time of one of places."""
    last = np.uint64((1 << bits) - 1)
    found = leading & ~last | np.arange(len(leading), dtype=np.uint64)
    found.sort()
    return (found & last).view(np.int64)


def _by_row(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by row and key, and where each run of one key of a row begins in it."""
    # By row, then by the leading bits of the key: one sort of plain numbers, unless keys agree in these bits.
    row_bits, place_bits = max(1, int(rows[-1]).bit_length() if len(rows) else 1), len(rows).bit_length()
    if row_bits + place_bits < 40:
        shift = np.uint64(64 - row_bits)
        order = _order(rows.astype(np.uint64) << shift | keys >> np.uint64(row_bits), place_bits)
        own, sorted_rows = keys[order], rows[order]
        fresh = np.ones(len(order), dtype=bool)
        other = own[1:] != own[:-1]
        fresh[1:] = other | (sorted_rows[1:] != sorted_rows[:-1])
        cut_off = np.uint64(row_bits + place_bits)
        alike = (own[1:] ^ own[:-1]) >> cut_off == 0
        if not np.any(alike & other & (sorted_rows[1:] == sorted_rows[:-1])):
            return order, np.flatnonzero(fresh)
    order = np.lexsort((keys, rows))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    return order, np.flatnonzero(fresh)


def _times_in_row(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each key occurs in its row."""
    order, at = _by_row(rows, keys)
    times = np.diff(np.append(at, len(keys)))
    found = np.empty(len(keys), dtype=np.int64)
    found[order] = np.repeat(times, times)
    return found


def _counts(documents: DataFrame, pairs: bool) -> DataFrame:
    """(first, word, c): how often each word or pair occurs in rows of the same fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def put_out() -> pa.RecordBatch:
            first, second = (np.concatenate(x) for x in zip(*held))
            keys = _key(first, second)
            # Keys that agree in the bits that are sorted by may come in several runs, which are summed later.
            order = _order(keys, len(keys).bit_length())
            starts = _starts(keys[order])
            at = order[starts]
            columns = [first[at].view(np.int64), second[at].view(np.int64), np.diff(np.append(starts, len(order)))]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["first", "word", "c"])

        for batch in batches:
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            for start, offsets, data in text_chunks(batch.column("text")):
                rows, words = _chunk_words(offsets, data, folds[start:])
                if pairs:
                    places = _pair_places(rows)
                    first, second = words[places - 1], words[places]
                else:
                    first, second = np.zeros(len(words), np.uint64), words
                held.append((first, second))
                size += len(first)
                if size >= SHARD_WORDS:
                    yield put_out()
                    held.clear()
                    size = 0
        if size:
            yield put_out()

    found = documents.mapInArrow(count, "first long, word long, c long")
    # Tasks have put their rows together, so Spark need not try before it shuffles.
    return found.repartition("first", "word").groupBy("first", "word").agg(F.sum("c").alias("c"))


def _exploded(documents: DataFrame) -> DataFrame:
    """(id, key, times): the words of every text with their number."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, folds = batch.column("id"), batch.column("fold").to_numpy(zero_copy_only=False)
            for start, offsets, data in text_chunks(batch.column("text")):
                rows, words = _chunk_words(offsets, data, folds[start:])
                order, at = _by_row(rows, words)
                owners, times = rows[order][at] + start, np.diff(np.append(at, len(rows)))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owners)), pa.array(words[order][at].view(np.int64)), pa.array(times)],
                    names=["id", "key", "times"],
                )

    kind = dict(documents.dtypes)["id"]
    return documents.mapInArrow(explode, f"id {kind}, key long, times long")


def _scored_words(documents: DataFrame, table: str, seldom: str, less_own: bool) -> DataFrame:
    """(id, key, times, value): of every text one row without key, with the number of its words and the sum of
    the logarithms of the counts in the table, and those other words as `_exploded` that the shared bits don't exclude."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, looked_up = Counts(table), Bits(seldom)
        for batch in batches:
            ids, folds = batch.column("id"), batch.column("fold").to_numpy(zero_copy_only=False)
            for start, offsets, data in text_chunks(batch.column("text")):
                rows, words = _chunk_words(offsets, data, folds[start:])
                if not len(rows):
                    continue
                order, at = _by_row(rows, words)
                owners, times, keys = rows[order][at], np.diff(np.append(at, len(rows))), words[order][at]
                found = counts.of(keys)
                value = times * np.log(np.maximum(found - times * less_own, 1))
                size = len(offsets) - 1
                whole = np.bincount(rows, minlength=size)
                total = np.bincount(owners, weights=value, minlength=size)
                texts = np.flatnonzero(whole)
                rest = (found == 0) & looked_up.maybe(keys)
                columns = [
                    ids.take(pa.array(np.concatenate([texts, owners[rest]]) + start)),
                    pa.concat_arrays([pa.nulls(len(texts), pa.int64()), pa.array(keys[rest].view(np.int64))]),
                    pa.array(np.concatenate([whole[texts], times[rest]])),
                    pa.array(np.concatenate([total[texts], np.zeros(int(rest.sum()))])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "times", "value"])

    kind = dict(documents.dtypes)["id"]
    return documents.mapInArrow(score, f"id {kind}, key long, times long, value double")


def _exploded_pairs(documents: DataFrame, bits: str, turn: int | None = None, spelled: bool = False) -> DataFrame:
    """(id, key, own, wide): the pairs of every text, but those that the shared bits exclude; `spelled`, with both words.

    `own` holds the numbers of the pair, of its first and of its second word in that text in 8, 12 and
    12 bits, as the shuffled rows are many and mostly hashes; where they don't fit, `wide` has them.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bits(bits)
        for batch in batches:
            ids, folds = batch.column("id"), batch.column("fold").to_numpy(zero_copy_only=False)
            for start, offsets, data in text_chunks(batch.column("text")):
                word_rows, words = _chunk_words(offsets, data, folds[start:])
                in_row = _times_in_row(word_rows, words)
                places = _pair_places(word_rows)
                rows, first, second = word_rows[places], words[places - 1], words[places]
                keys = _key(first, second)
                kept = known.maybe(keys)
                if turn is not None:
                    kept &= keys & np.uint64(TURNS - 1) == np.uint64(turn)
                rows, first, second, places, keys = (x[kept] for x in (rows, first, second, places, keys))
                order, at = _by_row(rows, keys)
                at_pair = order[at]
                times = np.diff(np.append(at, len(keys)))
                a, b = in_row[places[at_pair] - 1], in_row[places[at_pair]]
                fits = (times < 1 << 8) & (a < 1 << 12) & (b < 1 << 12)
                own = np.where(fits, times | a << 8 | b << 20, 0).astype(np.uint32).view(np.int32)
                columns = {
                    "id": ids.take(pa.array(rows[at_pair] + start)),
                    "key": pa.array(keys[at_pair].view(np.int64)),
                    "own": pa.array(own),
                    "wide": _where_not(fits, times, a, b),
                }
                if spelled:
                    columns |= {"first": pa.array(first[at_pair].view(np.int64)), "word": pa.array(second[at_pair].view(np.int64))}
                yield pa.RecordBatch.from_pydict(columns)

    kind = dict(documents.dtypes)["id"]
    return documents.mapInArrow(explode, f"id {kind}, key long, own int, wide array<long>" + ", first long, word long" * spelled)


def _where_not(fits: np.ndarray, *numbers: np.ndarray) -> pa.Array:
    """Lists of the numbers where they don't fit, else null."""
    rows = np.flatnonzero(~fits)
    if not len(rows):
        return pa.nulls(len(fits), pa.list_(pa.int64()))
    wide = [None] * len(fits)
    for row in rows.tolist():
        wide[row] = [int(n[row]) for n in numbers]
    return pa.array(wide, pa.list_(pa.int64()))


def _unpacked() -> tuple[Column, Column, Column]:
    """The three numbers in `own` and `wide`."""
    packed = (F.col("own").bitwiseAND(255), F.expr("own >> 8 & 4095"), F.expr("own >>> 20"))
    return tuple(F.coalesce(F.col("wide")[k], p.cast("long")) for k, p in enumerate(packed))


def _parts_together(parts: DataFrame, bits: str) -> DataFrame:
    """(id, key, own, wide) like those of `_exploded_pairs`, for documents that have several rows."""
    words = cut(_exploded(parts).groupBy("id", "key").agg(F.sum("times").alias("n")))
    times = _unpacked()[0]
    pairs = _exploded_pairs(parts, bits, spelled=True).groupBy("id", "key", "first", "word").agg(F.sum(times).alias("times"))
    for place in ("first", "word"):
        own = words.toDF("i", "w", f"n_{place}")
        pairs = pairs.join(own, F.col("id").eqNullSafe(F.col("i")) & (F.col(place) == F.col("w"))).drop("i", "w")
    return pairs.select("id", "key", F.lit(0).alias("own"), F.array("times", "n_first", "n_word").alias("wide"))


#: What a document is not scored with: its own words, or the half of the corpus it is in.
LEFT_OUT = ("document", "half")


def run_backoff_scores(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", left_out: str = "half"
) -> DataFrame:
    """id, n_words, n_matched, score and score_per_word (natural logarithms) per id.

    Words are runs of 0-9, letters (A-Z folded) and code points above 127. With `left_out` "document"
    each document is scored with the counts of all documents less its own. With "half" the corpus is split
    into halves by the crc32 of the id as text, and each document reads only the half it is not in. A
    word scores count(pair) / count(word before) if these counts have the pair, else 0.4 times its share
    of all their words; words they lack count as if they had them once. The first word has no factor.
    Counts are tables by hash, joined to the distinct words and pairs of every document and summed per
    document; common ones are summed in their tasks first, and a pair that very many documents have is
    split by the join. The counts of the most frequent words, a bounded number, go to the tasks, and
    pairs that no other document has are told by a bounded set of bits; both leave the result as it is.

    Null and empty texts have no words and score 0, per word too. Rows that repeat an id are parts of
    one document; rows without id are one document of their own. Texts of any length are scored whole,
    other columns are not read, and an empty table gives an empty result.
    """
    if left_out not in LEFT_OUT:
        raise ValueError(f"left_out is one of {LEFT_OUT}")
    by_document = left_out == "document"
    fold = F.lit(0) if by_document else half(id_column)
    rows = documents.select(F.col(id_column).alias("id"), fold.alias("fold"), F.col(text).cast("string").alias("text"))
    # Counts are of the fold of those who read them.
    counted = rows if by_document else rows.withColumn("fold", 1 - F.col("fold"))
    ids = cut(rows.groupBy("id").agg(F.count(F.lit(1)).alias("parts")))

    def rest(count: str, own: str) -> Column:
        return F.col(count) - F.col(own) if by_document else F.col(count)

    whole, parts = rows, None
    if by_document and ids.where("parts > 1").head(1):
        several = ids.where("parts > 1").select(F.col("id").alias("i"))
        whole, parts = (rows.join(several, F.col("id").eqNullSafe(F.col("i")), how) for how in ("left_anti", "left_semi"))

    # The largest shuffles are told apart by smaller ones, so that their files never lie side by side.
    words = cut(_counts(counted, False).select("word", "c"))
    table = run_counts(words.where(F.col("c") >= FREQUENT), "word", "c")
    # Words that no other text has, and in most corpora these are most words, need not be looked up.
    scored = cut(_scored_words(whole, table, run_bits(words.where("c > 1").select("word")), by_document))
    others = scored.where(F.col("key").isNotNull()).select("id", "key", "times", F.lit(0).alias("number"))
    if parts is not None:
        own = _exploded(parts).groupBy("id", "key").agg(F.sum("times").alias("times"))
        others = others.union(own.withColumn("number", F.col("times")))
    looked_up = others.join(words.withColumnRenamed("word", "key"), "key", "left")
    value = F.col("times") * F.log(F.greatest(F.coalesce(rest("c", "times"), F.lit(1)), F.lit(1)))
    read = looked_up.select("id", F.col("number").alias("times"), value.alias("value")).union(
        scored.where(F.col("key").isNull()).select("id", "times", "value")
    )
    single = cut(read.groupBy("id").agg(F.sum("times").alias("n_words"), F.sum("value").alias("words")))
    discard(scored)
    # A pair that occurs once is left by its own document only.
    shared = cut(_counts(counted, True).where(F.col("c") > int(by_document)))
    pairs = _with_word_counts(shared, words, table)
    discard(shared, words)
    # Of the pairs of all texts, the largest table here, only those go on that another text may have.
    bits = run_bits(pairs.select("key"))
    sums = []
    for turn in range(TURNS):
        now = F.col("key").bitwiseAND(TURNS - 1) == turn
        own_pairs = _exploded_pairs(whole, bits, turn).select("id", "key", "own", "wide")
        if parts is not None:
            own_pairs = own_pairs.union(_parts_together(parts, bits).where(now))
        read = own_pairs.join(pairs.where(now).hint("shuffle_hash"), "key")
        read = read.withColumns(dict(zip(("times", "n_first", "n_word"), _unpacked()))).where(rest("c", "times") > 0)
        gain = F.log(rest("c", "times")) - F.log(rest("c_first", "n_first")) - F.log(rest("c_word", "n_word"))
        sums.append(cut(read.groupBy("id").agg(F.sum("times").alias("n_matched"), F.sum(F.col("times") * gain).alias("matched"))))
    double = reduce(DataFrame.union, sums).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("n_matched", "matched")])
    discard(pairs)
    known = ids.join(single.withColumnRenamed("id", "i"), F.col("id").eqNullSafe(F.col("i")), "left").drop("i")
    known = known.join(double.withColumnRenamed("id", "j"), F.col("id").eqNullSafe(F.col("j")), "left").drop("j")
    known = known.fillna(0, ["n_words", "n_matched"]).fillna(0.0, ["words", "matched"])
    sizes = dict(single.groupBy(half("id")).agg(F.sum("n_words")).collect())
    totals = sizes.get(0, 0), sizes.get(1, 0)
    if by_document:
        total = F.lit(sum(totals)) - F.col("n_words")
    else:
        total = F.when(half("id") == 0, F.lit(totals[1])).otherwise(F.lit(totals[0]))
    score = (
        F.col("words")
        + F.col("matched")
        - (F.col("n_words") - F.col("n_matched")) * F.log(F.greatest(total, F.lit(1)))
        + (F.col("n_words") - 1 - F.col("n_matched")) * math.log(BACKOFF)
    )
    return known.withColumn("score", F.when(F.col("n_words") > 0, score).otherwise(0.0)).select(
        F.col("id").alias(id_column),
        "n_words",
        "n_matched",
        F.round("score", 4).alias("score"),
        F.round(F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).otherwise(0.0), 6).alias("score_per_word"),
    )


def _with_word_counts(pairs: DataFrame, words: DataFrame, table: str) -> DataFrame:
    """(key, c, c_first, c_word) of pairs: counts of frequent words from the table, of others by joins."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(table)
        for batch in batches:
            first, word = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "word"))
            found = [counts.of(x.view(np.uint64)) for x in (first, word)]
            key = pa.array(_key(first.view(np.uint64), word.view(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [key, pa.array(first), pa.array(word), batch.column("c"), *map(pa.array, found)],
                names=["key", "first", "word", "c", "c_first", "c_word"],
            )

    found = cut(pairs.mapInArrow(look_up, "key long, first long, word long, c long, c_first long, c_word long"))
    lacking = found.where("c_first = 0 or c_word = 0").drop("c_first", "c_word")
    joined = lacking.join(words.toDF("first", "c_first"), "first").join(words.toDF("word", "c_word"), "word")
    columns = ("key", "c", "c_first", "c_word")
    whole = cut(found.where("c_first > 0 and c_word > 0").select(*columns).union(joined.select(*columns)))
    discard(found)
    return whole
