"""Byte-pair encoding with word ends, and decoding, by a compiled lexicon of frequent words."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.lexicon import Lexicon, compile_lexicon
from ledgerlane.llm.storage import cut, discard, share_file
from ledgerlane.llm.wordspace import NOT_ASCII_SPACE, text_chunks, words_of

#: Most frequent words that are compiled; all others are merged when they are met.
LEXICON_WORDS = 200_000
#: Bytes of the longest word that is compiled, and of all compiled words together.
LEXICON_WORD_BYTES = 48
LEXICON_BYTES = 16 * LEXICON_WORDS
#: Classes of counts per doubling; a class is compiled as a whole.
COUNT_STEPS = 16
#: Text in which each different word is looked up once.
CHUNK_BYTES = 1 << 19
#: Values whose places are worked out at a time.
TAKEN = 1 << 16
#: Pieces of unseen words that a task remembers at a time.
REMEMBERED = 50_000
#: Greater than the rank of any pair.
NO_RANK = 1 << 60

_PLAIN_KINDS = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(byte if byte in plain else next(spare)) for byte in range(256)]


class WordBpe:
    """A vocabulary file: NFC, lower case, white space dropped, words split by its pattern, then merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        for part, kinds in _PLAIN_KINDS.items():
            found = spec[part].get("normalizers") or spec[part].get("pretokenizers")
            if [step["type"] for step in found] != kinds:
                raise ValueError(f"Unexpected {part} in {path}")
        if spec["decoder"] is not None or spec["model"]["type"] != "BPE":
            raise ValueError(f"Unexpected model or decoder in {path}")
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._prepare()

    def _prepare(self) -> None:
        self.letters = _byte_letters()
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.pieces = regex.compile(self.pattern)
        self.remembered: dict[str, list[int]] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("letters", "splitter", "pieces", "remembered")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._prepare()

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece: the pair that was learned first is joined, from the left, until none is known."""
        symbols = [self.letters[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        rank = self.merges.get
        ranks = [rank(pair, NO_RANK) for pair in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) != NO_RANK:
            place = ranks.index(best)
            symbols[place] += symbols.pop(place + 1)
            del ranks[place]
            if place < len(ranks):
                ranks[place] = rank((symbols[place], symbols[place + 1]), NO_RANK)
            if place:
                ranks[place - 1] = rank((symbols[place - 1], symbols[place]), NO_RANK)
        return [self.vocabulary[s] for s in symbols if s in self.vocabulary]

    def _ordinary(self, text: str) -> list[int]:
        if text.isascii():
            text = text.lower()
        else:
            text = "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        ids: list[int] = []
        for piece in self.pieces.findall(text):
            known = self.remembered.get(piece)
            if known is None:
                known = self.merge(piece) if len(piece) <= 200 else self.merge_long(piece)
                if len(self.remembered) >= REMEMBERED:
                    self.remembered.clear()
                if len(piece) <= 200:
                    self.remembered[piece] = known
            ids += known
        return ids

    def merge_long(self, piece: str) -> list[int]:
        """As `merge`, for very long pieces: a queue of pairs and links between symbols."""
        symbols = [self.letters[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        count = len(symbols)
        right, left = list(range(1, count + 1)), list(range(-1, count - 1))
        queue = [(r, i) for i in range(count - 1) if (r := self.merges.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = right[i] if symbols[i] else count
            if j >= count or self.merges.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            right[i] = right[j]
            if right[i] < count:
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < count and (r := self.merges.get((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(queue, (r, a))
        return [self.vocabulary[s] for s in symbols if s and s in self.vocabulary]

    def encode_word(self, word: str) -> list[int]:
        """Ids of text without ASCII white space; special tokens are found in it as it stands."""
        ids, at = [], 0
        if "<" in word or not self.special:
            for match in self.splitter.finditer(word):
                ids += [*self._ordinary(word[at : match.start()]), self.special[match[0]]]
                at = match.end()
        return ids + self._ordinary(word[at:])

    def token_texts(self) -> list[str]:
        texts = {i: t for t, i in (*self.vocabulary.items(), *self.special.items())}
        return [texts.get(i, "") for i in range(max(texts) + 1)]


def _take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of all pairs, one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    taken = np.empty(ends[-1], flat.dtype)
    # Places take 8 bytes for each value, so they are made block by block.
    cuts = np.searchsorted(ends, np.arange(TAKEN, ends[-1], TAKEN)).tolist()
    begin = 0
    for a, b in zip([0, *cuts], [*cuts, len(ends)]):
        if a < b:
            end = int(ends[b - 1])
            taken[begin:end] = flat[np.arange(begin, end) + np.repeat(starts[a:b] - ends[a:b] + lengths[a:b], lengths[a:b])]
            begin = end
    return taken


class Encoder:
    def __init__(self, model: WordBpe, lexicon: Lexicon):
        self.model, self.lexicon = model, lexicon

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk and where each text's begin."""
        words = words_of(data, offsets, NOT_ASCII_SPACE)
        _, first, member = np.unique(words.hashes, return_index=True, return_inverse=True)
        starts, ends = words.starts[first], words.ends[first]
        numbers = self.lexicon.numbers(data, starts, ends)
        seen = numbers >= 0
        id_starts, id_ends = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        id_starts[seen] = self.lexicon.ends[numbers[seen]]
        id_ends[seen] = self.lexicon.ends[numbers[seen] + 1]
        merged: list[int] = []
        base = len(self.lexicon.ids)
        for place in np.flatnonzero(~seen).tolist():
            id_starts[place] = base + len(merged)
            merged += self.model.encode_word(bytes(data[starts[place] : ends[place]]).decode())
            id_ends[place] = base + len(merged)
        flat = np.concatenate([self.lexicon.ids, np.array(merged, dtype=np.uint32)])
        lengths = (id_ends - id_starts)[member]
        ids = _take(flat, id_starts[member], lengths)
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, before[words.bounds]


class Decoder:
    """Token texts joined by one space, as a vocabulary without a decoder does."""

    def __init__(self, model: WordBpe):
        texts = [t.encode() + b" " for t in model.token_texts()]
        self.flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        lengths = self.lengths[ids]
        joined = _take(self.flat, self.starts[ids], lengths)
        places = np.concatenate([[0], np.cumsum(lengths)])[bounds].tolist()
        return [joined[a : max(a, b - 1)].tobytes() for a, b in zip(places[:-1], places[1:])]


def _word_counts(documents: DataFrame, text: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, offsets, data in text_chunks(batch.column("text"), CHUNK_BYTES):
                words = words_of(data, offsets, NOT_ASCII_SPACE)
                hashes, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
                spelled = _take(data, words.starts[first], words.ends[first] - words.starts[first])
                ends = np.concatenate([[0], np.cumsum(words.ends[first] - words.starts[first])])
                column = pa.Array.from_buffers(
                    pa.binary(), len(hashes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(spelled.tobytes())]
                )
                yield pa.RecordBatch.from_arrays([column, pa.array(counts.astype(np.int64))], names=["word", "found"])

    rows = documents.select(F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "word binary, found long").groupBy("word").agg(F.sum("found").alias("found"))


def run_lexicon(
    documents: DataFrame, path: str, text: str = "text", words: int = LEXICON_WORDS, model: Broadcast | None = None
) -> str:
    """Counts the words of all documents, compiles the most frequent ones and returns the name of the shared file.

    A word is what ASCII white space separates, in some scripts a sentence. Words of more than
    LEXICON_WORD_BYTES are not compiled. The least count is found from a histogram of counts, so that at
    most `words` of them with at most LEXICON_BYTES are taken, without sorting them. These numbers bound
    the driver's work, not the result: words that are not compiled are merged exactly. `model` is the
    vocabulary of that path, if the executors have it.
    """
    model = model or documents.sparkSession.sparkContext.broadcast(WordBpe(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.encode_word(w.decode()) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(found, pa.list_(pa.int32()))], names=["word", "ids"])

    counted = cut(_word_counts(documents, text).withColumn("size", F.floor(F.log2("found") * COUNT_STEPS)))
    short = counted.where(F.octet_length("word") <= LEXICON_WORD_BYTES)
    sums = F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes")
    sizes = short.groupBy("size").agg(*sums).orderBy(F.desc("size")).collect()
    least, taken, length = None, 0, 0
    for row in sizes:
        taken, length = taken + row["words"], length + row["bytes"]
        if taken > words or length > LEXICON_BYTES:
            break
        least = row["size"]
    chosen = short.where(F.col("size") >= least) if least is not None else counted.where("false")
    entries = chosen.select("word").mapInArrow(encode, "word binary, ids array<int>").toArrow()
    entries = sorted(zip(entries.column("word").to_pylist(), entries.column("ids").to_pylist()))
    discard(counted)
    return share_file(documents.sparkSession, "lexicon", compile_lexicon(entries))


def run_encode(
    documents: DataFrame,
    path: str,
    text: str = "text",
    lexicon: str | None = None,
    decoded: bool = False,
    words: int = LEXICON_WORDS,
) -> DataFrame:
    """`documents` with n_tokens and ids, the token ids as packed little-endian unsigned 32-bit integers.

    The ids are those of the vocabulary file's own library, special tokens in texts included, none
    added, nothing cut off or padded. With `decoded`, a column of that name has the token texts of
    the ids joined by spaces, as the file has no decoder. Words of the lexicon (a file name that
    `run_lexicon` gave, else it is called first) are looked up in the mapped transducer, all others
    are merged once per chunk.

    Null and empty texts have no ids. Texts of any length are encoded whole; a word of megabytes is merged
    through a queue, in time that grows little faster than its length. Columns named like the new ones are replaced. Repeated rows are
    encoded each; an empty table gives an empty result.
    """
    context = documents.sparkSession.sparkContext
    model = context.broadcast(WordBpe(path))
    lexicon = lexicon or run_lexicon(documents, path, text, words, model)
    added = {"n_tokens": pa.int64(), "ids": pa.binary()} | ({"decoded": pa.string()} if decoded else {})
    columns = [c for c in documents.columns if c not in added]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value, Lexicon(SparkFiles.get(lexicon)))
        decoder = Decoder(model.value) if decoded else None
        for batch in batches:
            # Rows go out chunk by chunk, so that a task holds the ids and texts of one chunk only.
            for first, offsets, data in text_chunks(batch.column("source_text"), CHUNK_BYTES):
                ids, bounds = encoder.chunk(data, offsets)
                part = batch.slice(first, len(offsets) - 1)
                packed = [ids[a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                made = [pa.array(np.diff(bounds), pa.int64()), pa.array(packed, pa.binary())]
                if decoder:
                    made.append(pa.array(decoder.texts(ids, bounds), pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*part.schema.names[:-1], *added])

    rows = documents.select(
        *(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col(text).cast("string").alias("source_text")
    )
    fields = [f"{n} {t}" for n, t in rows.dtypes[:-1]] + ["n_tokens long", "ids binary"] + ["decoded string"] * decoded
    return rows.mapInArrow(encode, ", ".join(fields)).toDF(*columns, *added)


def run_decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`encoded` with the texts of packed ids; null ids give an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(WordBpe(path))
    columns = [c for c in encoded.columns if c != into]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model.value)
        for batch in batches:
            packed = [p or b"" for p in batch.column("packed").to_pylist()]
            bounds = np.cumsum([0, *(len(p) // 4 for p in packed)])
            texts = decoder.texts(np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64), bounds)
            made = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*batch.schema.names[:-1], "decoded"])

    rows = encoded.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)), F.col(ids).alias("packed"))
    fields = ", ".join([*(f"{n} {t}" for n, t in rows.dtypes[:-1]), "decoded string"])
    return rows.mapInArrow(decode, fields).toDF(*columns, into)
