"""Byte-pair encoding into sentence pieces that keeps the place of every piece in its source text.

A text is normalised by the longest prefixes that the file's compiled character map knows, and every
normalised byte remembers the source byte it came from. Merging then works on normalised bytes, and
the ends of a piece are read off that record.
"""

from __future__ import annotations

import codecs
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.wordspace import distinct_spans, gathered, text_chunks

#: Text of which each different unit is merged once.
CHUNK_BYTES = 1 << 19
#: Units of more characters are merged one by one, with a queue.
LONG_UNIT = 48
NO_RANK = np.int64(1) << 40
NO_PAIR = -1

# Field numbers and kinds of the public model file format, and its space symbol.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, SUFFIX_SPACE, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 24, 35, 44
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
BPE = 2
SPACE = "▁".encode()


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _text(raw: bytes) -> str:
    """The text of some bytes; each byte that is not part of a character becomes U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        codecs.register_error("each-byte", _one_byte)
        return raw.decode(errors="each-byte")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, raw[at : at + size]
        at += size


class CharacterMap:
    """Replacements of source prefixes: a double-array trie over bytes, and texts that end in zero bytes."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.texts = blob[4 + size :] if size else b""

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes and replacement of the longest known prefix of source[at:]."""
        if not self.units:
            return None
        found, node = None, self._offset(self.units[0])
        for place in range(at, len(source)):
            node ^= source[place]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != source[place]:
                break
            node ^= self._offset(unit)
            if unit & 0x100:
                found = place + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


class PieceModel:
    """A model file: its normalisation, its pieces and their order of merging."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        trainer = dict(_fields(dict(message)[TRAINER]))
        normalizer = dict(_fields(dict(message)[NORMALIZER]))
        if trainer.get(MODEL_TYPE, 1) != BPE or trainer.get(SUFFIX_SPACE, 0) or not normalizer.get(ESCAPE_SPACES, 1):
            raise ValueError(f"{path} is no BPE model with escaped spaces before words")
        self.characters = CharacterMap(normalizer.get(CHARACTER_MAP, b""))
        self.prefixed = bool(normalizer.get(DUMMY_PREFIX, 1))
        self.trimmed = bool(normalizer.get(REMOVE_SPACES, 1))
        self.fallback = bool(trainer.get(BYTE_FALLBACK, 0))
        self.unknown_surface = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.texts: list[bytes] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        for number, value in message:
            if number == PIECES:
                piece = dict(_fields(value))
                self.texts.append(piece[1])
                self.kinds.append(piece.get(3, NORMAL))
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"{path} has user-defined or unused pieces")
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = np.full(256, self.unknown, dtype=np.int64)
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                self.bytes[int(self.texts[i][3:5], 16)] = i
        self._merges(scores)

    def _merges(self, scores: list[float]) -> None:
        """Sorted pairs of symbols with the piece they make and its rank; symbols beyond the pieces are characters."""
        symbols = {t: i for i, (t, kind) in enumerate(zip(self.texts, self.kinds)) if kind == NORMAL}
        normal = dict(symbols)
        for text in normal:
            for character in text.decode():
                symbols.setdefault(character.encode(), len(self.texts) + len(symbols))
        #: A character that no piece has.
        self.stranger = len(self.texts) + len(symbols) + 1
        points = sorted((ord(t.decode()), i) for t, i in symbols.items() if len(t.decode()) == 1)
        self.points, self.point_symbols = (np.array(x, dtype=np.int64) for x in zip(*points))
        ranks = {s: r for r, s in enumerate(sorted({-scores[i] for i in normal.values()}))}
        pairs = []
        for text, made in normal.items():
            letters = text.decode()
            for cut in range(1, len(letters)):
                left, right = symbols.get(letters[:cut].encode()), symbols.get(letters[cut:].encode())
                if left is not None and right is not None:
                    pairs.append((left << 32 | right, made, ranks[-scores[made]]))
        self.pairs, self.made, self.ranks = (np.array(x, dtype=np.int64) for x in zip(*pairs or [(NO_PAIR - 1, 0, NO_RANK)]))
        self._index()
        #: No merge goes from another character to a space, so what stands between is merged on its own.
        self.by_words = not any(SPACE in t.lstrip(SPACE) for t in normal if not t.startswith(SPACE) or SPACE in _unspaced(t))

    def _index(self) -> None:
        """A table with a place for each pair, the first free one from where its scrambled number points."""
        bits = max(4, (4 * len(self.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, NO_PAIR, dtype=np.int64)
        self.slot_of = np.zeros(1 << bits, dtype=np.int64)
        for number, (pair, slot) in enumerate(zip(self.pairs.tolist(), self._first_slots(self.pairs).tolist())):
            while self.slots[slot] != NO_PAIR:
                slot = (slot + 1) & (len(self.slots) - 1)
            self.slots[slot], self.slot_of[slot] = pair, number

    def _first_slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of pairs of symbols; NO_RANK where they make none."""
        wanted = left << 32 | right
        slot = self._first_slots(wanted)
        held = self.slots[slot]
        asked = np.flatnonzero((held != wanted) & (held != NO_PAIR))
        while len(asked):
            slot[asked] = (slot[asked] + 1) & (len(self.slots) - 1)
            now = self.slots[slot[asked]]
            asked = asked[(now != wanted[asked]) & (now != NO_PAIR)]
        number = self.slot_of[slot]
        return np.where(self.slots[slot] == wanted, self.ranks[number], NO_RANK), self.made[number]


def _unspaced(text: bytes) -> bytes:
    while text.startswith(SPACE):
        text = text[len(SPACE) :]
    return text


def normalized(model: PieceModel, source: bytes) -> tuple[bytes, list[int]]:
    """The normalised text and, for each of its bytes and its end, the source byte it stands for."""

    def prefix(at: int) -> tuple[int, bytes]:
        found = model.characters.longest(source, at)
        if found is not None:
            return found
        size = 1
        while at + size < len(source) and source[at + size] & 0xC0 == 0x80:
            size += 1
        return size, source[at : at + size]

    at = 0
    while model.trimmed and at < len(source) and (step := prefix(at))[1] == b" ":
        at += step[0]
    if at == len(source):
        return b"", [0]
    made, places = bytearray(), []
    if model.prefixed:
        made += SPACE
        places += [at] * len(SPACE)
    after_space = model.trimmed
    while at < len(source):
        size, text = prefix(at)
        if after_space:
            text = text.lstrip(b" ")
        if text:
            spelled = text.replace(b" ", SPACE)
            made += spelled
            places += [at] * len(spelled)
            after_space = model.trimmed and text.endswith(b" ")
        at += size
    end = at
    while model.trimmed and made.endswith(SPACE):
        del made[-len(SPACE) :]
        end = places[len(made)]
        del places[len(made) :]
    return bytes(made), [*places, end]


def normalized_chunk(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of many texts, where each text's begin, and the source byte of each byte.

    A text with a place after its last byte, so places has one more for each text: text r has
    places[bounds[r] + r : bounds[r + 1] + r + 1].
    """
    if model.characters.units or model.trimmed:
        rows = [normalized(model, data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        bounds = np.cumsum([0, *(len(made) for made, _ in rows)])
        places = np.array([p for _, places in rows for p in places], dtype=np.int64)
        return np.frombuffer(b"".join(made for made, _ in rows), dtype=np.uint8), bounds, places
    # No map: only spaces change. A marker byte before each text that has any, and one after it, carry the
    # space before the text and its end.
    sizes = np.diff(offsets)
    filled = sizes > 0
    space = data == 0x20
    width = np.where(space, len(SPACE), 1)
    total = np.concatenate([[0], np.cumsum(width)])
    before = np.where(filled, len(SPACE) * model.prefixed, 0)
    lengths = total[offsets[1:]] - total[offsets[:-1]] + before
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = total[:-1] - total[offsets[:-1]][row] + bounds[:-1][row] + before[row]
    out = np.zeros(bounds[-1], dtype=np.uint8)
    out[starts] = data
    opens = np.concatenate([starts[space], bounds[:-1][filled] if model.prefixed else starts[:0]])
    for k, byte in enumerate(SPACE):
        out[opens + k] = byte
    places = np.zeros(bounds[-1] + len(sizes), dtype=np.int64)
    local = np.arange(len(data)) - offsets[:-1][row]
    places[starts + row] = local
    for k in range(1, len(SPACE)):
        places[(starts + row)[space] + k] = local[space]
    places[bounds[1:] + np.arange(len(sizes))] = sizes
    return out, bounds, places


def _units(model: PieceModel, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the parts begin that are merged on their own."""
    if not model.by_words or not len(data):
        return np.unique(bounds[:-1][bounds[:-1] < bounds[-1]])
    spaces = np.zeros(len(data), dtype=bool)
    spaces[:-2] = (data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])
    opens = spaces.copy()
    opens[3:] &= ~spaces[:-3]
    opens[bounds[:-1][bounds[:-1] < bounds[-1]]] = True
    return np.flatnonzero(opens)


def _code_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code points of the characters that begin at `starts`."""
    first = data[starts].astype(np.int64)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    tail = [padded[starts + k] & 0x3F for k in (1, 2, 3)]
    two = (first & 0x1F) << 6 | tail[0]
    three = (first & 0x0F) << 12 | tail[0] << 6 | tail[1]
    four = (first & 0x07) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]
    return np.select([first < 0x80, first < 0xE0, first < 0xF0], [first, two, three], four)


def _merge_together(model: PieceModel, symbols: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols, starts and owners after all merges, for many units at once.

    A round joins in each unit its best pair, the leftmost of equal ones, until no unit has any.
    """
    done: list[tuple] = []
    ranks = np.full(len(symbols), NO_RANK)
    made = np.zeros(len(symbols), dtype=np.int64)

    def refresh(at: np.ndarray) -> None:
        at = at[(at >= 0) & (at < len(symbols) - 1)]
        at = at[owner[at] == owner[at + 1]]
        ranks[at], made[at] = model.lookup(symbols[at], symbols[at + 1])

    refresh(np.arange(len(symbols)))
    while len(symbols):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best = np.minimum.reduceat(ranks << 22 | np.arange(len(symbols)), first)
        open_units = best >> 22 < NO_RANK
        if not open_units.all():
            sizes = np.diff(np.append(first, len(symbols)))
            kept = np.repeat(open_units, sizes)
            done.append((symbols[~kept], starts[~kept], owner[~kept]))
            shift = np.cumsum(~kept) - ~kept
            at = (best & ((1 << 22) - 1))[open_units]
            at = at - shift[at]
            symbols, starts, owner, ranks, made = (x[kept] for x in (symbols, starts, owner, ranks, made))
        else:
            at = best & ((1 << 22) - 1)
        if not len(at):
            break
        symbols[at] = made[at]
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        symbols, starts, owner, ranks, made = (x[stays] for x in (symbols, starts, owner, ranks, made))
        at = at - np.arange(len(at))
        ranks[at] = NO_RANK
        refresh(at)
        refresh(at - 1)
    symbols, starts, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (list(zip(*done)) or [(), (), ()]))
    order = np.lexsort((starts, owner))
    return symbols[order], starts[order], owner[order]


def _merge_long(model: PieceModel, symbols: np.ndarray) -> list[tuple[int, int]]:
    """(symbol, place of its first character) after all merges of one unit: a queue of pairs and links."""
    signs = symbols.tolist()
    count = len(signs)
    right, left = list(range(1, count + 1)), list(range(-1, count - 1))
    ranks, made = (x.tolist() for x in model.lookup(symbols[:-1], symbols[1:]))
    queue = [(r, i, signs[i], signs[i + 1], m) for i, (r, m) in enumerate(zip(ranks, made)) if r < NO_RANK]
    heapq.heapify(queue)
    known: dict[tuple[int, int], tuple[int, int]] = {}
    while queue:
        _, i, a, b, piece = heapq.heappop(queue)
        j = right[i]
        if signs[i] != a or j >= count or signs[j] != b:
            continue
        signs[i], signs[j] = piece, -1
        right[i] = right[j]
        if right[i] < count:
            left[right[i]] = i
        for x, y in ((left[i], i), (i, right[i])):
            if x >= 0 and y < count:
                pair = signs[x], signs[y]
                if pair not in known:
                    rank, becomes = model.lookup(np.array([pair[0]]), np.array([pair[1]]))
                    known[pair] = int(rank[0]), int(becomes[0])
                if known[pair][0] < NO_RANK:
                    heapq.heappush(queue, (known[pair][0], x, *pair, known[pair][1]))
    return [(s, i) for i, s in enumerate(signs) if s >= 0]


def encode_chunk(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(ids, first source bytes, source bytes after, bounds) of the pieces of all texts of a chunk."""
    text, bounds, places = normalized_chunk(model, data, offsets)
    unit_starts = _units(model, text, bounds)
    unit_ends = np.append(unit_starts[1:], len(text))
    first, member = distinct_spans(text, unit_starts, unit_ends)
    # The characters of each different unit.
    sizes = (unit_ends - unit_starts)[first]
    letters = gathered(text, unit_starts[first], sizes)
    owner_of_byte = np.repeat(np.arange(len(first)), sizes)
    starts = np.flatnonzero(letters & 0xC0 != 0x80)
    points = _code_points(letters, starts)
    at = np.searchsorted(model.points, points)
    at[at == len(model.points)] = 0
    symbols = np.where(model.points[at] == points, model.point_symbols[at], model.stranger)
    owner = owner_of_byte[starts] if len(starts) else np.zeros(0, np.int64)
    # Short units step together, long ones go through a queue each.
    counts = np.bincount(owner, minlength=len(first))
    short = counts[owner] <= LONG_UNIT
    merged = [_merge_together(model, symbols[short], starts[short], owner[short])]
    begins = np.concatenate([[0], np.cumsum(counts)])
    for unit in np.flatnonzero(counts > LONG_UNIT).tolist():
        found = _merge_long(model, symbols[begins[unit] : begins[unit + 1]])
        places_in = np.array([p for _, p in found]) + begins[unit]
        merged.append((np.array([s for s, _ in found]), starts[places_in], np.full(len(found), unit)))
    symbols, starts, owner = (np.concatenate(x) for x in zip(*merged))
    if len(merged) > 1:
        order = np.lexsort((starts, owner))
        symbols, starts, owner = symbols[order], starts[order], owner[order]
    unit_begin = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.append(starts[1:], len(letters))
    # Characters without a piece become their bytes. Like the library, the last of them has the source span.
    bare = symbols >= len(model.texts)
    pieces = np.where(bare & model.fallback, ends - starts, 1)
    ids = np.repeat(np.where(bare, model.unknown, symbols), pieces)
    last = np.cumsum(pieces)
    inside = np.arange(len(ids)) - np.repeat(last - pieces, pieces)
    piece_starts, piece_ends = np.repeat(starts, pieces), np.repeat(ends, pieces)
    if model.fallback:
        split = np.repeat(bare, pieces)
        ids[split] = model.bytes[letters[piece_starts[split] + inside[split]]]
        early = split & (inside < np.repeat(pieces, pieces) - 1)
        piece_ends[early] = piece_starts[early]
    piece_owner = np.repeat(owner, pieces)
    piece_starts -= unit_begin[piece_owner]
    piece_ends -= unit_begin[piece_owner]
    # All units, in the order of the texts.
    per_unit = np.bincount(piece_owner, minlength=len(first))
    from_piece = np.concatenate([[0], np.cumsum(per_unit)])[:-1]
    lengths = per_unit[member]
    shift = np.repeat(unit_starts, lengths)
    chosen = gathered(np.arange(len(ids)), from_piece[member], lengths)
    row_of_unit = np.searchsorted(bounds, unit_starts, side="right") - 1
    row = np.repeat(row_of_unit, lengths)
    begin = places[piece_starts[chosen] + shift + row]
    end = places[piece_ends[chosen] + shift + row]
    totals = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])
    return ids[chosen], begin, end, totals


class PieceDecoder:
    def __init__(self, model: PieceModel):
        spelled = {NORMAL: lambda t: t.replace(SPACE, b" "), BYTE: lambda t: bytes([int(t[3:5], 16)]), CONTROL: lambda t: b""}
        spelled[UNKNOWN] = lambda t: model.unknown_surface
        texts = [spelled[kind](t) for t, kind in zip(model.texts, model.kinds)]
        self.flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        opens = (model.prefixed or model.trimmed) * np.array([t.startswith(SPACE) for t in model.texts])
        self.opens = opens & (np.array(model.kinds) == NORMAL)
        self.all_spaces = model.trimmed

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of rows of ids; the space before a text is left out."""
        lengths = self.lengths[ids]
        joined = gathered(self.flat, self.starts[ids], lengths)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        filled = np.flatnonzero(lengths)
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            raw = joined[ends[a] : ends[b]].tobytes()
            at = np.searchsorted(filled, a)
            if at < len(filled) and filled[at] < b and self.opens[ids[filled[at]]]:
                raw = raw.lstrip(b" ") if self.all_spaces else raw[1:]
            found.append(_text(raw))
        return found


def encode_pieces(
    documents: DataFrame, path: str, text: str = "text", spans: bool = False, decoded: bool = False
) -> DataFrame:
    """`documents` with n_tokens and ids, the ids of the pieces that the model file's own library gives.

    No begin or end ids, no sampling. With `spans`, a column of that name holds for every piece its
    first byte in the UTF-8 source text and the byte after it, as packed little-endian unsigned 32-bit
    integers; spans follow each other without gaps, except where normalisation removes spaces at the ends,
    and a piece for a space before the text, or for one of several bytes but the last, is empty. With
    `decoded`, a column of that name has the text that the ids decode to.

    Null and empty texts have no pieces and decode to an empty text. Texts of any length are encoded
    whole. Columns named like the new ones are replaced. Repeated rows are encoded each; an empty table
    gives an empty result.
    """
    model = documents.sparkSession.sparkContext.broadcast(PieceModel(path))
    added = {"n_tokens": "long", "ids": "array<int>"} | ({"spans": "binary"} if spans else {}) | ({"decoded": "string"} if decoded else {})
    columns = [c for c in documents.columns if c not in added]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = PieceDecoder(model.value) if decoded else None
        for batch in batches:
            # Rows go out chunk by chunk, so that a task holds the pieces of one chunk only.
            for first, offsets, data in text_chunks(batch.column("source_text"), CHUNK_BYTES):
                ids, begin, end, bounds = encode_chunk(model.value, data, offsets)
                part = batch.slice(first, len(offsets) - 1)
                made = [
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                ]
                if spans:
                    both = np.stack([begin, end], axis=1).astype("<u4")
                    made.append(pa.array([both[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()))
                if decoder:
                    made.append(pa.array(decoder.texts(ids, bounds), pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*part.schema.names[:-1], *added])

    rows = documents.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), F.col(text).cast("string").alias("source_text")
    )
    fields = [f"{n} {t}" for n, t in rows.dtypes[:-1]] + [f"{n} {t}" for n, t in added.items()]
    return rows.mapInArrow(encode, ", ".join(fields)).toDF(*columns, *added)


def decode_pieces(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the texts of ids; null ids, like none, give an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(PieceModel(path))
    columns = [c for c in encoded.columns if c != into]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = PieceDecoder(model.value)
        for batch in batches:
            lists = [x or [] for x in batch.column("found_ids").to_pylist()]
            flat = np.array([i for x in lists for i in x], dtype=np.int64)
            texts = decoder.texts(flat, np.cumsum([0, *map(len, lists)]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    rows = encoded.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), F.col(ids).alias("found_ids"))
    fields = ", ".join([*(f"{n} {t}" for n, t in rows.dtypes[:-1]), "text string"])
    return rows.mapInArrow(decode, fields).toDF(*columns, into)
