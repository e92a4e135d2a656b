"""Text quality by a regularised quadratic discriminant over statistics of the whole text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut, discard
from ledgerlane.llm.wordspace import FOLD_ASCII, NOT_ASCII_SPACE, text_chunks, words_of

#: Share of the pooled covariance in that of a class, and of the mean variance added to each variance.
TOWARDS_POOLED = 0.3
RIDGE = 0.05
#: Code points that are added to a text's length in shares, so that one capital says little in a short text.
SMOOTHING = 30

#: Rows with their texts that a filtering task holds twice.
ROWS_AT_ONCE = 1000

FEATURES = (
    "words", "word_length", "length_spread", "words_per_line", "distinct_words", "distinct_lines",
    "repeated_words", "capitals", "digits", "symbols", "marks", "stops", "beyond_ascii", "short_words",
)


def _bytes(*members: int | range) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    for member in members:
        found[member if isinstance(member, int) else list(member)] = True
    return found


_CAPITALS = _bytes(range(65, 91))
_DIGITS = _bytes(range(48, 58))
_SYMBOLS = _bytes(*b"#$%&*+/<=>@\\^_`{|}~")
_MARKS = _bytes(*b"!?")
_STOPS = _bytes(*b".,;:'\"()-")
_NOT_NEWLINE = ~_bytes(10, 13)


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist())
    return np.array([len(np.unique(hashes[a:b])) for a, b in pairs], dtype=np.int64)


def text_statistics(column: pa.Array) -> np.ndarray:
    """A row of FEATURES per text, transformed so that their spread is about even; zeros for no words."""
    found = [np.zeros((0, len(FEATURES)))]
    for _, offsets, data in text_chunks(column):
        words = words_of(FOLD_ASCII[data], offsets, NOT_ASCII_SPACE)
        lines = words_of(data, offsets, _NOT_NEWLINE)
        points = (data & 0xC0) != 0x80
        places = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(points, out=places[1:])
        n_points = np.maximum(places[offsets[1:]] - places[offsets[:-1]], 1)
        n_words, n_lines = np.diff(words.bounds), np.diff(lines.bounds)
        at_least_one = np.maximum(n_words, 1)
        lengths = (places[words.ends] - places[words.starts]).astype(float)
        mean = _per_row(lengths, words.bounds) / at_least_one
        squares = _per_row(lengths**2, words.bounds) / at_least_one
        same = np.zeros(len(words.hashes), dtype=bool)
        same[1:] = words.hashes[1:] == words.hashes[:-1]
        first = words.bounds[:-1][n_words > 0]
        same[first] = False

        def share(members: np.ndarray) -> np.ndarray:
            return np.sqrt(_per_row(members[data], offsets) / (n_points + SMOOTHING))

        table = np.column_stack(
            [
                np.log1p(n_words) / 2,
                np.log1p(mean) * 2,
                np.sqrt(np.maximum(squares - mean**2, 0)) / np.maximum(mean, 1) * 2,
                np.log1p(n_words / np.maximum(n_lines, 1)),
                # The share of new words falls with the length of a text; its exponent hardly does.
                4 * np.log1p(_distinct(words.hashes, words.bounds)) / np.log1p(at_least_one),
                2 * np.sqrt(_distinct(lines.hashes, lines.bounds) / np.maximum(n_lines, 1)),
                4 * np.sqrt(_per_row(same, words.bounds) / at_least_one),
                4 * share(_CAPITALS),
                4 * share(_DIGITS),
                4 * share(_SYMBOLS),
                4 * share(_MARKS),
                4 * share(_STOPS),
                2 * np.sqrt(_per_row(data >= 0xC0, offsets) / n_points),
                2 * np.sqrt(_per_row(lengths <= 3, words.bounds) / at_least_one),
            ]
        )
        table[n_words == 0] = 0
        found.append(table)
    return np.concatenate(found)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors, log determinants and priors of label 0 and 1; or a constant score."""

    constant: float | None = None
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    offsets: np.ndarray | None = None

    def score(self, statistics: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(statistics), self.constant)
        logs = [
            offset - 0.5 * (((statistics - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """From the row count, sums and sums of products of the statistics per label."""
    if (counts < 2).any():
        return Discriminant(constant=float(counts[1] / counts.sum()) if counts.sum() else 0.5)
    means = sums / counts[:, None]
    scatter = products - np.einsum("ki,kj->kij", means, means) * counts[:, None, None]
    pooled = scatter.sum(axis=0) / counts.sum()
    factors, offsets = [], []
    for label in (0, 1):
        covariance = (1 - TOWARDS_POOLED) * scatter[label] / counts[label] + TOWARDS_POOLED * pooled
        covariance += np.eye(len(covariance)) * max(RIDGE * np.trace(pooled) / len(pooled), 1e-6)
        lower = np.linalg.cholesky(covariance)
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(counts[label] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(None, means, np.array(factors), np.array(offsets))


def held_out(id_column: str = "doc_id"):
    """Rows whose label is never learned from; rows without id are not held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def statistics_table(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = text_statistics(batch.column("text"))
            ends = np.arange(len(table) + 1, dtype=np.int32) * len(FEATURES)
            values = pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), values], names=["id", "statistics"])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(measure, f"id {kind}, statistics array<double>")


def run_fit(statistics: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality") -> Discriminant:
    """Learns from all labelled rows that are not held out: one join on the id and one sum per label.

    Labels are counted by id first, so an id that repeats on both sides is met once by each of its rows.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where(
        ~held_out("id") & F.col("label").isin(0, 1)
    )
    counted = known.groupBy("id").agg(*[F.count_if(F.col("label") == k).alias(f"times_{k}") for k in (0, 1)])
    times = F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.col(f"times_{k}").alias("times")) for k in (0, 1)]))
    rows = statistics.join(counted, "id").select("statistics", times.alias("known")).select("statistics", "known.*").where("times > 0")
    size = len(FEATURES)
    values = [F.col("statistics")[i] for i in range(size)]
    cells = [(i, j) for i in range(size) for j in range(i + 1)]
    sums = rows.groupBy("label").agg(
        F.sum("times").alias("rows"),
        F.array(*(F.sum(v * F.col("times")) for v in values)).alias("sums"),
        F.array(*(F.sum(values[i] * values[j] * F.col("times")) for i, j in cells)).alias("products"),
    )
    counts, totals, products = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
    for row in sums.collect():
        counts[row["label"]] = row["rows"]
        totals[row["label"]] = row["sums"]
        for (i, j), value in zip(cells, row["products"]):
            products[row["label"], i, j] = products[row["label"], j, i] = value
    return fit(counts, totals, products)


def run_quality(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, held_out, score and predicted for every row of `documents`.

    The score is the probability of label 1 under a Gaussian per label with its own covariance,
    shrunk towards the pooled one. It depends on the text only. Labels of rows whose crc32 of the id
    as text leaves 1 when divided by 3 are not learned from (held_out).

    Null and empty texts have zeros for statistics and get a score too; texts of any length are measured
    whole. Repeated documents are scored each, other columns, whatever their names, are not read, and an
    empty table gives an empty result. Labels other than 0 and 1 and those without id are ignored;
    repeated labels count each. With fewer than two rows of a label
    every score is the share of label 1, or 0.5 without labels. predicted is 1 from 0.5 on.
    """
    statistics = cut(statistics_table(documents, id_column, text))
    model = run_fit(statistics, labels, id_column)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("statistics").flatten().to_numpy(zero_copy_only=False)
            scores = pa.array(model.score(values.reshape(-1, len(FEATURES))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), scores], names=["id", "score"])

    kind = dict(statistics.dtypes)["id"]
    return statistics.mapInArrow(score, f"id {kind}, score double").select(
        F.col("id").alias(id_column),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def run_keep_good(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `documents` with predicted = 1, all columns; see `run_quality`, also for nulls and repeated rows."""
    statistics = cut(statistics_table(documents, id_column, text))
    model = run_fit(statistics, labels, id_column)
    discard(statistics)
    columns = documents.columns
    place = columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                good = model.score(text_statistics(part.column(place).cast(pa.string()))) >= 0.5
                yield part.filter(pa.array(good))

    named = documents.toDF(*(f"c{i}" for i in range(len(columns))))
    return named.mapInArrow(keep, named.schema).toDF(*columns)
