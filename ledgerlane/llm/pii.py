"""Personal data: exact patterns, and a conditional random field that adds what they miss."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.crf import LABELS, Crf, luhn, train
from ledgerlane.llm.wordspace import FOLD_ASCII, NOT_ASCII_SPACE, text_chunks, words_of

KINDS = ("email", "ip", "card", "phone")

# What counts as personal data. Each pattern also consumes what can't start a match,
# so that long runs without one take linear time; only matches with the named group count.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?P<match>@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
_IP = re.compile(r"[0-9]++(?P<match>(?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?P<match>(?:[\x20-]?[0-9])++)?")
_PHONE = re.compile(r"(?P<match>\+[0-9][\x20().0-9-]+[0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]+")

#: Sequences for the random field: words this close to one that has a digit, @ or +, or is an "[at]" in any case.
CONTEXT = 3
#: Rows with their texts that a task holds twice.
ROWS_AT_ONCE = 1000
#: Sequences that are decoded together.
SEQUENCES = 4096

_TRIGGERS = np.zeros(256, dtype=bool)
_TRIGGERS[[*range(48, 58), ord("@"), ord("+")]] = True


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the exact patterns, by kind and place; code points."""
    found = []
    if "@" in text:
        found += [(0, m.start(), m.end()) for m in _EMAIL.finditer(text) if m["match"]]
    for m in _IP.finditer(text):
        if m["match"] and all(len(p) < 4 and int(p or 0) <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m["match"] and len(m[0]) >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return found


def labelled_table(sentences: int = 700, seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """A small labelled table: sentences made from templates, with numbers that are no personal data too."""
    rng = random.Random(seed)

    def digits(count: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(count))

    def word() -> str:
        made = "".join(rng.choice("abcdefghilmnoprstuväéñ") for _ in range(rng.randint(2, 9)))
        return rng.choice([made, made, made.capitalize(), made.upper()]) + rng.choice(["", "", "", ",", ".", "!!", "%%%"])

    def card(valid: bool) -> str:
        body = digits(15)
        check = next(d for d in "0123456789" if luhn(body + d) == valid)
        number = body + (check if valid else rng.choice([d for d in "0123456789" if not luhn(body + d)]))
        style = rng.choice(["", "", " ", "-"])
        return style.join(number[i : i + 4] for i in range(0, 16, 4))

    def name() -> str:
        return "".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(3, 8)))

    def host() -> str:
        return f"{name()}{rng.choice(['', digits(1)])}.{rng.choice(['com', 'example.com', 'org', 'de'])}"

    makers = {
        1: [
            lambda: f"{name()}.{digits(2)}@{host()}",
            lambda: f"{name()}@{host()}",
            lambda: f"{name()} [at] {name()} [dot] com",
            lambda: f"{name()}(at){name()}.com",
            lambda: f"{name()}ü{name()}@{name()}ß.de",
        ],
        2: [lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4))],
        3: [lambda: card(True)],
        4: [
            lambda: f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"+{rng.randint(1, 99)} {digits(3)} {digits(7)}",
            lambda: f"tel ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"phone {digits(3)}-{digits(3)}-{digits(4)}",
        ],
        0: [
            lambda: card(False),
            lambda: f"{digits(1)}.{digits(1)}",
            lambda: f"{digits(1)}.{digits(2)}.{digits(1)}",
            lambda: str(rng.randint(1900, 2030)),
            lambda: digits(rng.randint(1, 6)),
            lambda: f"{rng.randint(300, 999)}.{digits(3)}.{digits(2)}.{digits(3)}",
            lambda: f'token = "{rng.getrandbits(160):040x}"',
            lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1990, 2030)}",
            lambda: f"{digits(4)}-{digits(2)}-{digits(2)}",
            lambda: f"order no {digits(10)}",
            lambda: f"isbn {digits(3)}-{digits(10)}",
            lambda: digits(rng.randint(20, 40)),
            lambda: f"{digits(2)} + {digits(2)}",
            lambda: f"@{name()}",
            lambda: f"{digits(3)} {digits(3)} {digits(3)}",
            lambda: f"{rng.randint(1, 9)}@{rng.randint(1, 9)}",
            lambda: " ".join(f"{name()}{digits(rng.randint(1, 4))}" for _ in range(rng.randint(1, 5))),
            lambda: " ".join(f"{name()}{digits(1)}{name()}" for _ in range(rng.randint(1, 5))),
            lambda: " ".join(digits(rng.randint(1, 6)) for _ in range(rng.randint(2, 8))),
        ],
    }
    table = []
    for _ in range(sentences):
        words, labels = [], []
        for _ in range(rng.randint(1, 2)):
            plain = [word() for _ in range(rng.randint(0, 4))]
            words, labels = words + plain, labels + [0] * len(plain)
            label = rng.choice([0, 0, 0, 0, 1, 1, 2, 3, 4, 4])
            made = rng.choice(makers[label])().split(" ")
            lead = int(made[0] in ("tel", "phone"))
            made[-1] += rng.choice(["", "", ".", ",", "!!", "###"])
            words, labels = words + made, labels + [0] * lead + [label] * (len(made) - lead)
            plain = [word() for _ in range(rng.randint(1, 4))]
            words, labels = words + plain, labels + [0] * len(plain)
        table.append((words, labels))
    return table


def _near(triggers: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges around triggers, within their rows; ranges that touch are one."""
    if not len(triggers):
        return []
    low = np.maximum(triggers - CONTEXT, bounds[rows])
    high = np.minimum(triggers + CONTEXT + 1, bounds[rows + 1])
    fresh = np.concatenate([[True], (low[1:] > high[:-1]) | (rows[1:] != rows[:-1])])
    firsts = low[fresh]
    lasts = np.maximum.reduceat(high, np.flatnonzero(fresh))
    return list(zip(firsts.tolist(), lasts.tolist()))


_LEADING = re.compile(r"^[^0-9A-Za-z+(\x80-\U0010ffff]+")
_TRAILING = re.compile(r"[^0-9A-Za-z)\x80-\U0010ffff]+$")


_LETTER = re.compile(r"[A-Za-z\x80-\U0010ffff]")
_SPELLED_AT = re.compile(r"@|[\[(]at[\])]", re.IGNORECASE)


def _plausible(kind: int, text: str) -> bool:
    """Whether a labelled run can be what its label says; the field sees shapes, not values."""
    digits = _NOT_DIGIT.sub("", text)
    if KINDS[kind] == "email":
        return bool(_SPELLED_AT.search(text)) and len(text.split()) <= 6
    if _LETTER.search(text):
        return False
    if KINDS[kind] == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdecimal() and len(p) < 4 and int(p) <= 255 for p in parts)
    if KINDS[kind] == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _field_spans(model: Crf, text_of: dict[int, str], sequences: list) -> dict[int, list[tuple[int, int, int]]]:
    """Per row the spans of runs of equally labelled words, without punctuation around them."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    for at in range(0, len(sequences), SEQUENCES):
        block = sequences[at : at + SEQUENCES]
        words = [[text_of[row][a:b] for a, b in places] for row, places in block]
        for (row, places), labels in zip(block, model.decode(words)):
            place = 0
            while place < len(labels):
                last = place
                while last + 1 < len(labels) and labels[last + 1] == labels[place]:
                    last += 1
                if labels[place]:
                    start, end = places[place][0], places[last][1]
                    start += len(text_of[row][start:end]) - len(_LEADING.sub("", text_of[row][start:end]))
                    end -= len(text_of[row][start:end]) - len(_TRAILING.sub("", text_of[row][start:end]))
                    if start < end and _plausible(int(labels[place]) - 1, text_of[row][start:end]):
                        found.setdefault(row, []).append((int(labels[place]) - 1, start, end))
                place = last + 1
    return found


def spans_of(column: pa.Array, model: Crf) -> list[list[tuple[int, int, int, bool]]]:
    """Per text (kind, start, end, by rule) in the order of kind and start."""
    result: list[list[tuple[int, int, int, bool]]] = []
    for first, offsets, data in text_chunks(column):
        words = words_of(data, offsets, NOT_ASCII_SPACE)
        flags = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(_TRIGGERS[data], out=flags[1:])
        points = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        wanted = flags[words.ends] > flags[words.starts]
        if len(data) > 3:
            # "[at]" and "(at)", in any case, stand alone and are rare: look for their bytes.
            match = (FOLD_ASCII[data[1:-2]] == ord("a")) & (FOLD_ASCII[data[2:-1]] == ord("t"))
            opened, closed = np.isin(data[:-3], [ord("["), ord("(")]), np.isin(data[3:], [ord("]"), ord(")")])
            at = np.flatnonzero(match & opened & closed)
            if len(at):
                owner = np.searchsorted(words.starts, at, side="right") - 1
                wanted[owner[(owner >= 0) & (words.ends[owner] >= at + 4)]] = True
        triggers = np.flatnonzero(wanted)
        rows = np.searchsorted(words.bounds, triggers, side="right") - 1
        ranges = _near(triggers, words.bounds, rows)
        text_of = {row: bytes(data[offsets[row] : offsets[row + 1]]).decode() for row in np.unique(rows).tolist()}
        base = {row: rule_spans(text) for row, text in text_of.items()}
        sequences = []
        for low, high in ranges:
            row = int(np.searchsorted(words.bounds, low, side="right")) - 1
            start = points[offsets[row]]
            places = zip((points[words.starts[low:high]] - start).tolist(), (points[words.ends[low:high]] - start).tolist())
            sequences.append((row, list(places)))
        added = _field_spans(model, text_of, sequences)
        for row in range(len(offsets) - 1):
            known = base.get(row, [])
            spans = [(*s, True) for s in known]
            for kind, start, end in added.get(row, []):
                if all(end <= a or b <= start for _, a, b in known):
                    spans.append((kind, start, end, False))
            result.append(sorted(spans))
    return result


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("by_rule", pa.bool_())]))


def _as_arrow(spans: list[list[tuple[int, int, int, bool]]]) -> pa.Array:
    rows = [[{"kind": KINDS[k], "start": a, "end": b, "by_rule": r} for k, a, b, r in row] for row in spans]
    return pa.array(rows, _SPANS)


def run_find_personal_data(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) per row: kind, start, end (code points, end exclusive) and whether a pattern found it.

    Spans of the patterns are exact and always there. A conditional random field over word shapes,
    trained here from a small labelled table, labels the words around digits, @, + and "[at]"; runs
    of a label that touch no pattern's span are added. Words further from those are not decoded: a run
    without any of them is no personal data of these kinds, whatever its label. Spans are ordered by kind (email, ip, card,
    phone), then start.

    Null and empty texts have no spans, very long ones are searched whole and in linear time.
    Repeated rows are searched each. An empty table gives an empty result.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(labelled_table()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                found = _as_arrow(spans_of(part.column("text"), model.value))
                yield pa.RecordBatch.from_arrays([part.column("id"), found], names=["id", "spans"])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    found = rows.mapInArrow(find, f"id {kind}, spans array<struct<kind:string,start:long,end:long,by_rule:boolean>>")
    return found.withColumnRenamed("id", id_column)


def redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """`text` with a marker such as [EMAIL] for every span; spans that overlap share the first one's."""
    parts, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b, _ in spans):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def run_redact(documents: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns of `documents` with personal data replaced in the texts.

    `n_chars`, where there is such a column, is counted anew for texts that changed; null texts stay. Texts of
    any length are cleaned whole, repeated rows each, other columns stay whatever their names, and an empty
    table gives an empty result.
    """
    model = documents.sparkSession.sparkContext.broadcast(train(labelled_table()))
    columns, types = documents.columns, dict(documents.dtypes)
    place = columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                old = part.column(place).cast(pa.string())
                spans, new, changed = spans_of(old, model.value), old.to_pylist(), []
                for row, found in enumerate(spans):
                    if found:
                        new[row] = redacted(new[row], found)
                    changed.append(bool(found))
                arrays = [*part.columns, pa.array(changed)]
                arrays[place] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "changed"])

    named = documents.select(
        *(F.col(c).cast("string").alias(f"c{i}") if c == text else F.col(c).alias(f"c{i}") for i, c in enumerate(columns))
    )
    fields = ", ".join(f"{n} {t}" for n, t in named.dtypes)
    result = named.mapInArrow(clean, f"{fields}, changed boolean")
    counted = F.length(f"c{place}")
    return result.select(
        *(
            F.when(F.col("changed"), counted.cast(types[c])).otherwise(F.col(f"c{i}")).alias(c)
            if c == n_chars
            else F.col(f"c{i}").alias(c)
            for i, c in enumerate(columns)
        )
    )
