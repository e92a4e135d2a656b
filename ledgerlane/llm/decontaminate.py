"""Passages of benchmark items in documents, found with a full-text index per shard of documents."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.fm_index import FmIndex
from ledgerlane.llm.storage import cut as write_out
from ledgerlane.llm.storage import discard
from ledgerlane.llm.wordspace import ALPHANUMERIC, FOLD_ASCII, mixed, text_chunks, words_of

#: Benchmark texts go to the tasks in blocks of about so many code points, one pass over the documents each.
BLOCK_CHARS = 8 << 20
#: An index is built once so many words of a shard wait for it.
SHARD_WORDS = 1 << 20

#: Rows that a task puts out at a time.
ROWS_AT_ONCE = 1000

_BITMAP_BITS = 22


class Phrases:
    """The windows of a block of items as word numbers, and what words and word pairs they have.

    A window that several items have is one, with the set of its items; sets are numbered, as the
    windows of a passage that many items share all have the same.
    """

    def __init__(self, items: list[tuple[str | None, str]], width: int):
        self.items = [item for item, _ in items]
        texts = pa.array([text for _, text in items], pa.large_string())
        per_item = []
        for _, offsets, data in text_chunks(texts):
            words = words_of(FOLD_ASCII[data], offsets, ALPHANUMERIC)
            per_item += [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        hashes = np.concatenate(per_item) if per_item else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(hashes)
        self.symbols = np.searchsorted(self.vocabulary, hashes) + 1
        starts, lengths, owners, pairs, at = [], [], [], [], 0
        for owner, found in enumerate(per_item):
            count = len(found)
            if count:
                windows = max(1, count - width + 1)
                starts.append(np.arange(at, at + windows))
                lengths.append(np.full(windows, min(count, width)))
                owners.append(np.full(windows, owner))
                pairs.append(self.pair(self.symbols[at : at + count - 1], self.symbols[at + 1 : at + count]))
            at += count
        none = [np.zeros(0, np.int64)]
        self._distinct(*(np.concatenate(x or none) for x in (starts, lengths, owners)))
        self.pairs = np.unique(np.concatenate(pairs or none))
        self.shortest = int(self.lengths.min(initial=width))
        self.word_map = self._bitmap(self.vocabulary)
        self.pair_map = self._bitmap(mixed(self.pairs.astype(np.uint64)))

    def _distinct(self, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> None:
        code = np.zeros(len(starts), dtype=np.int64)
        for step in range(int(lengths.max(initial=0))):
            inside = lengths > step
            word = np.zeros(len(starts), dtype=np.int64)
            word[inside] = self.symbols[starts[inside] + step]
            _, code = np.unique(code * (len(self.vocabulary) + 2) + word, return_inverse=True)
        order = np.lexsort((owners, code))
        first = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0])) if len(order) else order
        self.starts, self.lengths = starts[order[first]], lengths[order[first]]
        known: dict[bytes, int] = {}
        self.owner_sets: list[np.ndarray] = []
        self.sets = np.zeros(len(first), dtype=np.int64)
        for window, (a, b) in enumerate(zip(first.tolist(), [*first[1:].tolist(), len(order)])):
            found = np.unique(owners[order[a:b]])
            number = known.setdefault(found.tobytes(), len(known))
            if number == len(self.owner_sets):
                self.owner_sets.append(found)
            self.sets[window] = number

    def items_of(self, sets: tuple[int, ...]) -> list[str]:
        """The ids of the items of some sets, sorted."""
        return sorted({self.items[owner] for number in sets for owner in self.owner_sets[number].tolist()} - {None})

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left * (len(self.vocabulary) + 1) + right

    @staticmethod
    def _bitmap(hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(1 << _BITMAP_BITS, dtype=bool)
        found[hashes >> np.uint64(64 - _BITMAP_BITS)] = True
        return found

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words that no item has."""
        found = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.word_map[hashes >> np.uint64(64 - _BITMAP_BITS)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[maybe]
        found[maybe[same]] = at[same] + 1
        return found

    def has_pairs(self, codes: np.ndarray) -> np.ndarray:
        found = self.pair_map[mixed(codes.astype(np.uint64)) >> np.uint64(64 - _BITMAP_BITS)]
        maybe = np.flatnonzero(found)
        if len(maybe):
            at = np.searchsorted(self.pairs, codes[maybe])
            at[at == len(self.pairs)] = 0
            found[maybe] = self.pairs[at] == codes[maybe]
        return found


class Shard:
    """The words of some documents that can be part of a phrase, waiting for their index.

    A word of a phrase has a phrase's word beside it, so a text is kept in runs of words whose
    neighbours form pairs that some item has; everything else only separates runs.
    """

    def __init__(self, phrases: Phrases):
        self.phrases, self.size = phrases, 0
        self.symbols: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.places: list[np.ndarray] = []

    def add(self, hashes: np.ndarray, bounds: np.ndarray, first_row: int) -> None:
        numbers = self.phrases.numbers(hashes)
        known = numbers > 0
        joined = np.zeros(len(numbers) + 1, dtype=bool)  # with the word before
        both = np.flatnonzero(known[:-1] & known[1:])
        joined[both + 1] = self.phrases.has_pairs(self.phrases.pair(numbers[both], numbers[both + 1]))
        joined[bounds] = False
        firsts = np.flatnonzero(known & ~joined[:-1])
        lasts = np.flatnonzero(known & ~joined[1:]) + 1
        long_enough = lasts - firsts >= self.phrases.shortest
        firsts, lasts = firsts[long_enough], lasts[long_enough]
        if not len(firsts):
            return
        lengths = lasts - firsts + 1  # with the end of the run
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) - np.repeat(ends - lengths - firsts, lengths)
        symbols = numbers[np.minimum(places, len(numbers) - 1)]
        symbols[ends - 1] = 0
        rows = np.repeat(np.searchsorted(bounds, firsts, side="right") - 1, lengths)
        self.symbols.append(symbols)
        self.rows.append(rows + first_row)
        self.places.append(places - bounds[rows])
        self.size += len(symbols)

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows, places) of hit words, row by row in order, and the distinct (rows, item sets) found."""
        none = np.zeros(0, dtype=np.int64)
        if not self.size:
            return none, none, none, none
        text, rows, places = (np.concatenate(x) for x in (self.symbols, self.rows, self.places))
        index, phrases = FmIndex(text), self.phrases
        first, last = index.search(phrases.symbols, phrases.starts, phrases.lengths)
        counts = last - first
        windows = np.repeat(np.arange(len(counts)), counts)
        ranks = np.arange(len(windows)) - np.repeat(np.cumsum(counts) - counts, counts) + first[windows]
        found = index.locate(ranks)
        change = np.zeros(len(text) + 1, dtype=np.int64)
        np.add.at(change, found, 1)
        np.add.at(change, found + phrases.lengths[windows], -1)
        hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        count = len(phrases.owner_sets)
        owned = np.unique(rows[found] * count + phrases.sets[windows])
        return rows[hit], places[hit], owned // count, owned % count


def _spans(places: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of consecutive numbers as (first, after last)."""
    cuts = np.flatnonzero(np.diff(places) != 1) + 1
    return list(zip(places[np.concatenate([[0], cuts])].tolist(), (places[np.concatenate([cuts - 1, [len(places) - 1]])] + 1).tolist()))


def _run_block_count(benchmark: DataFrame) -> int:
    chars = benchmark.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    return max(1, math.ceil(chars / BLOCK_CHARS))


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    return rows.where("text is not null").distinct()


def _run_block(items: DataFrame, number: int, count: int) -> list[tuple[str | None, str]]:
    """One block of items that fits into a task."""
    block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == number)
    return [tuple(row) for row in block.orderBy("item", "text").collect()]


_FOUND = "n_words long, hits array<struct<first:int,last:int>>, items array<string>"


def _marked(documents: DataFrame, text: str, shared: Broadcast, cut: bool) -> DataFrame:
    """`documents` with the hits and items of one more block of phrases; with `cut`, the texts without the hits."""
    columns = documents.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = len(batch)
            counts = np.zeros(rows, dtype=np.int64)
            hits: dict[int, np.ndarray] = {}
            sets: dict[int, list] = {}
            listed: dict[tuple, list] = {}  # rows with the same passages share their list
            shard = Shard(known)

            def gather() -> None:
                hit_rows, hit_places, set_rows, found_sets = shard.matches()
                for row in np.unique(hit_rows).tolist():
                    hits[row] = hit_places[np.searchsorted(hit_rows, row) : np.searchsorted(hit_rows, row, side="right")]
                for row, number in zip(set_rows.tolist(), found_sets.tolist()):
                    sets.setdefault(row, []).append(number)

            for first, offsets, data in text_chunks(batch.column(text)):
                words = words_of(FOLD_ASCII[data], offsets, ALPHANUMERIC)
                counts[first : first + len(offsets) - 1] = np.diff(words.bounds)
                if len(known.starts):
                    shard.add(words.hashes, words.bounds, first)
                if shard.size >= SHARD_WORDS:
                    gather()
                    shard = Shard(known)
            gather()
            old_hits, old_items = batch.column("hits"), batch.column("items")
            all_hits: list = [[]] * rows
            all_items: list = [[]] * rows
            for row in range(rows):
                earlier = old_hits[row].as_py() if old_hits[row].is_valid and len(old_hits[row]) else []
                if row in hits or earlier:
                    places = hits.get(row, np.zeros(0, np.int64))
                    places = np.unique(np.concatenate([places, *(np.arange(x["first"], x["last"]) for x in earlier)]))
                    all_hits[row] = [{"first": a, "last": b} for a, b in _spans(places)]
                    key = tuple(sets.get(row, ()))
                    if key not in listed:
                        listed[key] = known.items_of(key)
                    before = old_items[row].as_py()
                    all_items[row] = sorted({*before, *listed[key]}) if before else listed[key]
            replaced = {
                "n_words": pa.array(counts),
                "hits": pa.array(all_hits, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                "items": pa.array(all_items, pa.list_(pa.string())),
            }
            whole = pa.RecordBatch.from_arrays([replaced.get(c, batch.column(c)) for c in columns], names=columns)
            place = columns.index(text)
            for first in range(0, rows, ROWS_AT_ONCE):
                part = whole.slice(first, ROWS_AT_ONCE)
                if cut:
                    part = part.set_column(place, text, _cut_out(part.column(place), part.column("hits")))
                yield part

    return documents.mapInArrow(mark, documents.schema)


def run_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 10,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The `keep` columns of every document with the benchmark passages it holds.

    Words are runs of 0-9, letters (A-Z folded) and code points above 127. A window is `width`
    consecutive words of an item; an item of fewer words is one window, one without words none.
    Adds n_words, hits (merged word ranges [first, last) inside occurrences of windows, in order)
    and items (ids of items with an occurring window, as strings, sorted and distinct).

    Each shard of documents is indexed (Burrows-Wheeler transform, wavelet ranks); the windows are
    searched backwards, all at once, and located by sampled suffix positions. The benchmark is the
    query set: it goes to the tasks in blocks of a bounded size, with a pass over the documents
    for each, and one block as a rule.

    Null and empty texts have no words. A passage of an item without id is found but not listed.
    Repeated rows of either table change nothing for the others. Empty tables are allowed.
    """
    kept = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)]
    marked = _run_marks(documents, kept, benchmark, text, item, item_text, width, cut=False)
    return marked.select(*(F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)), "n_words", "hits", "items")


def _run_marks(documents, kept: list, benchmark, text: str, item: str, item_text: str, width: int, cut: bool) -> DataFrame:
    marked = documents.select(
        *kept,
        F.col(text).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<first:int,last:int>>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    items = _items(benchmark, item, item_text)
    count = _run_block_count(items)
    context = documents.sparkSession.sparkContext
    for number in range(count):
        shared = context.broadcast(Phrases(_run_block(items, number, count), width))
        last = number == count - 1
        before, marked = marked, _marked(marked, "text", shared, cut and last)
        if not last:
            # Driver and tasks hold one block at a time.
            marked = write_out(marked)
            shared.destroy()
            if number:
                discard(before)
    return marked


def _cut_out(texts: pa.Array, hits: pa.Array) -> pa.Array:
    """Texts without the hit words and what stands between the words of one range."""
    result = texts.to_pylist()
    wanted = [row for row in range(len(hits)) if hits[row].is_valid and len(hits[row])]
    for row in wanted:
        data = np.frombuffer(result[row].encode(), dtype=np.uint8)
        words = words_of(FOLD_ASCII[data], np.array([0, len(data)]), ALPHANUMERIC)
        parts, at = [], 0
        for span in hits[row].as_py():
            parts.append(bytes(data[at : words.starts[span["first"]]]))
            at = int(words.ends[span["last"] - 1])
        parts.append(bytes(data[at:]))
        result[row] = b"".join(parts).decode()
    return pa.array(result, pa.string())


def run_decontaminate(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", n_chars: str | None = "n_chars", width: int = 10
) -> DataFrame:
    """`documents` without the benchmark passages in their texts, all rows and columns kept.

    The words that `run_contamination` marks are cut out, range by range; `n_chars`, where there
    is such a column, is counted anew for texts that changed. See there for nulls and ties.
    """
    columns, types = documents.columns, dict(documents.dtypes)
    kept = [F.col(c).alias(f"keep_{k}") for k, c in enumerate(columns) if c != text]
    cleaned = _run_marks(documents, kept, benchmark, text, "item_id", "text", width, cut=True)
    counted = F.when(F.size("hits") > 0, F.length("text"))

    def result(place: int, name: str) -> Column:
        if name == text:
            return F.col("text").cast(types[name]).alias(name)
        own = F.col(f"keep_{place}")
        return (F.coalesce(counted.cast(types[name]), own) if name == n_chars else own).alias(name)

    return cleaned.select(*(result(k, c) for k, c in enumerate(columns)))
