"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.graph import run_components
from ledgerlane.llm.storage import cut, discard
from ledgerlane.llm.wordspace import FOLD_ASCII, NOT_ASCII_SPACE, mixed, shingle_sets, text_chunks, words_of

COORDINATES = 64
#: Equal coordinates that two documents need before their sets are compared. Of 64, a pair with a
#: similarity of 0.8 has 51 on average and fewer than 32 once in 50 million times, at 0.81 once in 300
#: million. Such a pair is not linked, unless other links join it.
MATCHES = 32
#: Bits of the longer sketch that open pairs are tested with. Sets of similarity s agree in a bit with
#: probability (1 + s) / 2; a similar pair falls six deviations below that once in a billion times.
BITS = 4096
DEVIATIONS = 6
#: Sizes of sets are told apart in steps of this ratio, so that pairs of unlike sizes need not meet.
SIZE_STEP = 1.02

_VALUES_AT_ONCE = 1 << 18


def _multipliers(count: int = COORDINATES) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _least_hashes(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least scrambled hash per multiplier."""
    least = np.full(len(multipliers), 2**64 - 1, dtype=np.uint64)
    rows = max(1, _VALUES_AT_ONCE // len(multipliers))
    for first in range(0, len(shingles), rows):
        block = shingles[first : first + rows, None] * multipliers[None, :]
        np.minimum(least, block.min(axis=0), out=least)
    return least


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least hash per coordinate; its six lowest bits name the coordinate."""
    least = _least_hashes(shingles, multipliers)
    return (least & ~np.uint64(63) | np.arange(COORDINATES, dtype=np.uint64)).view(np.int64)


def bit_sketch(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """One bit of each of BITS least hashes."""
    bits = (mixed(_least_hashes(shingles, multipliers)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _sets(batch: pa.RecordBatch, text: str, width: int) -> Iterator[np.ndarray]:
    for _, offsets, data in text_chunks(batch.column(text)):
        yield from shingle_sets(words_of(FOLD_ASCII[data], offsets, NOT_ASCII_SPACE), width)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def text_sha256(text: Column) -> Column:
    """A digest of a text that tells rows of one id apart; null for null."""
    return F.unhex(F.sha2(text.cast("string").cast("binary"), 256))


def sketches(documents: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """(id, digest of the text, n_shingles, digest of the set, signature) per row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for shingles in _sets(batch, "text", width):
                sizes.append(len(shingles))
                digests.append(_digest(shingles))
                signatures.append(signature(shingles, multipliers) if len(shingles) else np.zeros(0, np.int64))
            lengths = np.array([0, *map(len, signatures)], dtype=np.int32)
            values = np.concatenate(signatures) if signatures else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("text_sha256"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(values)),
                ],
                names=["id", "text_sha256", "n_shingles", "digest", "signature"],
            )

    rows = documents.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(text).cast("string").alias("text"),
        text_sha256(F.col(text)).alias("text_sha256"),
    )
    return rows.mapInArrow(sketch, "id long, text_sha256 binary, n_shingles long, digest binary, signature array<long>")


def _classes(sketched: DataFrame) -> DataFrame:
    """One row per different set: a number of its own, its least id and its signature."""
    grouped = (
        sketched.where("n_shingles > 0 and id is not null")
        .groupBy("digest")
        .agg(F.min(F.struct("id", "text_sha256")).alias("least"), F.first("n_shingles").alias("size"), F.first("signature").alias("signature"))
        .withColumns({"least_id": F.col("least.id"), "least_sha256": F.col("least.text_sha256")})
        .drop("least")
    )
    return cut(grouped.withColumn("class", F.monotonically_increasing_id()))


def _posted(classes: DataFrame, matches: int) -> DataFrame:
    """Classes that can have a partner, each with the coordinate values under which it is posted.

    Values are ordered from rare to frequent. Two classes with `matches` equal values share one of
    the first `COORDINATES - matches + 1` of either; values nobody else has can't be shared, so
    they need no posting and a class with too many of them needs none at all.
    """
    tokens = classes.select("class", F.explode("signature").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    ordered = (
        tokens.join(shared, "token")
        .groupBy("class")
        .agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("found"))
        .withColumn("common", F.size("found"))
        .where(F.col("common") >= matches)
        .select("class", "common", F.slice("found.token", F.lit(1), F.col("common") - (matches - 1)).alias("prefix"))
    )
    kept = classes.select("class", "least_id", "least_sha256", "digest", "size", "signature")
    return cut(ordered.join(kept, "class"))


def _full_sets(documents: DataFrame, posted: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """(class, shingles) from the whole texts of the documents that stand for the classes."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, names, found = batch.column("digest").to_pylist(), batch.column("class").to_pylist(), []
            for row, shingles in enumerate(_sets(batch, "text", width)):
                if _digest(shingles) == wanted[row]:
                    found.append((names[row], shingles.view(np.int64)))
                if len(found) == 500:
                    yield as_batch(found)
                    found = []
            yield as_batch(found)

    def as_batch(found: list) -> pa.RecordBatch:
        ends = np.cumsum([0, *(len(s) for _, s in found)], dtype=np.int32)
        values = np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
            names=["class", "shingles"],
        )

    # By id and text: an id that very many rows have brings each class its own row only.
    rows = documents.select(
        F.col(id_column).cast("long").alias("least_id"), text_sha256(F.col(text)).alias("least_sha256"), F.col(text).cast("string").alias("text")
    )
    owners = rows.join(posted.select("least_id", "least_sha256", "digest", "class"), ["least_id", "least_sha256"])
    # Rows that repeat an id and a text would give the same set again.
    return cut(owners.mapInArrow(shingled, "class long, shingles array<long>").dropDuplicates(["class"]))


def _confirmed(pairs: DataFrame, posted: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs (u, v) with enough equal coordinates whose whole sets are similar."""
    one = posted.select(F.col("class").alias("u"), F.col("signature").alias("signature_u"), F.col("size").alias("size_u"))
    two = posted.select(F.col("class").alias("v"), F.col("signature").alias("signature_v"), F.col("size").alias("size_v"))
    close = (
        pairs.join(one, "u")
        .join(two, "v")
        .where("100 * least(size_u, size_v) >= {0} * greatest(size_u, size_v)".format(percent))
        .where(F.size(F.array_intersect("signature_u", "signature_v")) >= matches)
        .select("u", "v")
    )
    one = sets.select(F.col("class").alias("u"), F.col("shingles").alias("set_u"))
    two = sets.select(F.col("class").alias("v"), F.col("shingles").alias("set_v"))
    both = F.size(F.array_intersect("set_u", "set_v"))
    return (
        close.join(one, "u")
        .join(two, "v")
        .select("u", "v", both.alias("both"), (F.size("set_u") + F.size("set_v")).alias("total"))
        .where(f"100 * both >= {percent} * (total - both)")
        .select("u", "v")
    )


def _lists(posted: DataFrame) -> DataFrame:
    return posted.select("class", "common", F.explode("prefix").alias("token"))


def _star_pairs(lists: DataFrame) -> DataFrame:
    """Each class of a posting list with one of them: the one with the fewest values of its own.

    In a group of near copies that is the class most like the others, and the same in all lists.
    """
    rank = F.struct(-F.col("common"), F.xxhash64("class"), "class")
    leaders = lists.groupBy("token").agg(F.min(rank).alias("leader"))
    return (
        lists.join(leaders, "token")
        .where("class <> leader.class")
        .select(F.least("class", "leader.class").alias("u"), F.greatest("class", "leader.class").alias("v"))
        .distinct()
    )


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, class, label) of lists whose classes are not all known to be connected."""
    named = lists.join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("token", "class", F.coalesce("label", "class").alias("label"))
    several = named.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b")
    return named.join(several.select("token"), "token")


def _partner_sizes(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(class, size, least, most): the sizes that a similar set can have, for classes that can have one.

    What a set shares with any other in these lists is at most the number of its shingles that occur
    in another one, `shared`. With an intersection i the sizes add up to (1 + 1 / similarity) * i at most.
    """
    found = sets.join(lists.select("class").distinct(), "class")
    single = found.select("class", F.explode("shingles").alias("shingle"))
    several = single.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    shared = single.join(several.select("shingle"), "shingle").groupBy("class").agg(F.count(F.lit(1)).alias("shared"))
    sizes = found.select("class", F.size("shingles").cast("long").alias("size")).join(shared, "class")
    return sizes.select(
        "class",
        "size",
        F.expr(f"({percent} * size + 99) div 100").alias("least"),
        F.expr(f"least(shared * {100 + percent} div {percent} - size, 100 * size div {percent})").alias("most"),
    ).where("least <= most")


def _with_bits(sets: DataFrame, partners: DataFrame) -> DataFrame:
    """`partners` with the bit sketches of their sets."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = _multipliers(BITS)
        for batch in batches:
            made = [bit_sketch(s.values.to_numpy().view(np.uint64), multipliers) for s in batch.column("shingles")]
            bits = pa.array([m.tolist() for m in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], bits], names=[*batch.schema.names[:-1], "bits"])

    rows = partners.join(sets, "class")
    return rows.mapInArrow(sketch, "class long, size long, least long, most long, prefix array<long>, bits array<long>")


def _open_pairs(lists: DataFrame, partners: DataFrame, percent: int) -> DataFrame:
    """All pairs of a list that are not known to be connected and may be similar.

    Classes of the most frequent label in a list meet only those of other labels, so that a large
    group which is already connected costs nothing. A pair is met in the first of its lists only,
    only if their sizes allow the similarity, and only if their bit sketches do.
    """
    rows = lists.join(partners.select("class"), "class")
    counted = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("rows"))
    largest = counted.groupBy("token").agg(F.max(F.struct("rows", "label")).alias("found"))
    known = rows.join(largest.select("token", F.col("found.label").alias("main")), "token").join(partners, "class")
    others = known.where("label <> main").drop("main")
    others = others.toDF(*(c if c == "token" else f"{c}_u" for c in others.columns))

    def step(size: str) -> Column:
        return F.floor(F.log(F.col(size)) / math.log(SIZE_STEP)).cast("int")

    # Sets that are too small or large to be similar are in other steps, so that, say, documents made from
    # one template, each with too much of its own, do not meet at all.
    others = others.withColumn("step", F.explode(F.sequence(step("least_u") - 1, step("most_u") + 1)))
    known = known.withColumn("step", step("size"))
    first_list = F.array_min(F.array_intersect("prefix", "prefix_u")) == F.col("token")
    unequal = F.aggregate(
        F.zip_with("bits", "bits_u", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k
    )
    share = (1 - percent / 100) / 2  # of unequal bits, for a pair that is just similar
    most = BITS * share + DEVIATIONS * math.sqrt(BITS * share * (1 - share))
    fitting = (
        F.expr("label_u <> label and (label = main or class_u < class)")
        & F.expr("size between least_u and most_u and size_u between least and most")
        & first_list
        & (unequal <= math.ceil(most))
    )
    return (
        others.join(known, ["token", "step"])
        .where(fitting)
        .select(F.least("class_u", "class").alias("u"), F.greatest("class_u", "class").alias("v"))
    )


def run_near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    matches: int = MATCHES,
    digests: bool = False,
) -> DataFrame:
    """Groups of documents that are linked by similar sets of word shingles.

    Words are what ASCII white space separates, A-Z folded. A document's set holds its distinct runs
    of `width` words, the whole sequence if it is shorter. Two documents are linked if
    100 * intersection >= percent * union. Returns id, n_shingles, component_id (the least id that
    links lead to) and kept (id = component_id), one row per row of `documents`, other columns are
    not looked at. With `digests`, text_sha256 of each row's text besides, which tells to what row of
    an id the verdict belongs.

    Signatures of 64 MinHash values are posted under each coordinate and value; pairs with enough
    equal values are confirmed on the sets of the whole texts. Equal sets are one class from the
    start. Classes of one posting list first meet a single class of the list; what that connects
    need not be paired any more. All remaining pairs of every list are then tried, without a limit,
    except those that their sizes, the shingles nobody else has, or a longer sketch rule out.

    Texts of any length are shingled whole. Empty, blank and null texts have no shingles and are linked
    with nothing. A row without id is
    linked with nothing, has no component and is kept. Rows that repeat an id are rows of one
    document if their sets are equal; otherwise each has the least id of its own group, so two of
    them can be kept. An empty table gives an empty result.
    """
    sketched = cut(sketches(documents, id_column, text, width))
    classes = _classes(sketched)
    posted = _posted(classes, matches)
    sets = _full_sets(documents, posted, id_column, text, width)
    lists = _lists(posted)
    links = cut(_confirmed(_star_pairs(lists), posted, sets, percent, matches))
    labels = run_components(links)
    open_lists = cut(_open_lists(lists, labels))
    partners = _partner_sizes(open_lists, sets, percent).join(posted.select("class", "prefix"), "class")
    pairs = _open_pairs(open_lists, cut(_with_bits(sets, partners)), percent)
    more = cut(_confirmed(pairs, posted, sets, percent, matches))
    discard(links, open_lists, sets)
    if more.head(1):
        labels = run_components(more.union(labels.toDF("u", "v")))
    named = classes.select("class", "digest", "least_id").join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("label", F.coalesce("label", "class"))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    groups = cut(named.join(least, "label").select("digest", "component_id"))
    discard(classes, posted, more)
    whole = sketched.select("id", "text_sha256", "n_shingles", "digest").join(groups, "digest", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.col("component_id"))
    return whole.select(
        F.col("id").alias(id_column),
        "n_shingles",
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        *(["text_sha256"] if digests else []),
    )
