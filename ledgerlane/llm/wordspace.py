"""Words of a batch of texts as numpy arrays: places, and 64-bit hashes without a Python loop.

Texts are handled as their UTF-8 bytes. Word classes are sets of bytes, which is exact for classes
that treat all code points above 127 alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}
_POWERS_KEPT = 1 << 22

FOLD_ASCII = np.arange(256, dtype=np.uint8)
FOLD_ASCII[65:91] += 32

NOT_ASCII_SPACE = np.ones(256, dtype=bool)
NOT_ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: [0-9a-z] and everything above 127; for texts whose A-Z are folded.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) for runs of whole texts of about `limit` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    rows = len(column)
    if not rows:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, offsets[first : last + 1] - offsets[first], data[offsets[first] : offsets[last]]
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one, so that their order is random."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _powers(base: np.uint64, count: int) -> np.ndarray:
    """base ** 0 .. count - 1, kept for the usual size only."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < count:
        size = max(count, CHUNK_BYTES + 1)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= _POWERS_KEPT:
            _POWERS[int(base)] = known
    return known[:count]


@dataclass
class Words:
    starts: np.ndarray  # byte places in the chunk
    ends: np.ndarray
    bounds: np.ndarray  # words of row r: bounds[r] up to bounds[r + 1]
    hashes: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes that stay within a row, with a hash of each run's bytes."""
    inside = is_word[data]
    size = len(data)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < size]
    opens[row_starts] = inside[row_starts]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    row_ends = offsets[1:][offsets[1:] > 0] - 1
    closes[row_ends] = inside[row_ends]
    ends = np.flatnonzero(closes) + 1
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, size), dtype=np.uint64, out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, size + 1)[starts])
    return Words(starts, ends, np.searchsorted(starts, offsets), hashes)


def run_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` consecutive values."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    factor = 0xD6E8FEB86659FD93
    for k in range(width):
        factor = (factor * 0xA0761D6478BD642F + 0xE7037ED1A0B428DB) & (2**64 - 1)
        total += hashes[k : k + count] * np.uint64(factor | 1)
    return mixed(total)


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its runs of `width` words; shorter rows are one run; no words, none."""
    runs = run_hash(words.hashes, width)
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if last - first >= width:
            yield np.unique(runs[first : last - width + 1])
        elif last > first:
            yield run_hash(words.hashes[first:last], last - first)
        else:
            yield runs[:0]


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of all pairs, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(data) + 1)[starts])


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a span of each different content, which of these each span is like). Contents are compared, not hashes only."""
    _, first, member = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    lengths, like = ends - starts, first[member]
    same = np.array_equal(lengths, lengths[like])
    if same and np.array_equal(gathered(data, starts, lengths), gathered(data, starts[like], lengths)):
        return first, member
    known: dict[bytes, int] = {}
    found, chosen = [], []
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        number = known.setdefault(data[a:b].tobytes(), len(known))
        if number == len(chosen):
            chosen.append(k)
        found.append(number)
    return np.array(chosen, dtype=np.int64), np.array(found, dtype=np.int64)
