"""Threshold-scaled sketches of documents, and of documents edited with their neighbours' text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut

WIDTH = 5
#: One of so many shingle hashes is kept.
SCALE = 4
#: Copies of one row that a task puts out at a time.
COPIES_AT_ONCE = 4096

_KEPT_BELOW = -(2**63) + 2**64 // SCALE


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """A 64-bit hash of every run of `width` words; of all words if there are fewer, nothing for none."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width)))
    )
    few = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<long>"))
    return F.when(F.size(words) >= width, runs).otherwise(few)


def scaled(hashes: Column) -> Column:
    """The distinct hashes below the threshold, sorted; the least one if none is."""
    kept = F.filter(hashes, lambda h: h < _KEPT_BELOW)
    least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<long>"))
    return F.when(F.size(kept) > 0, F.sort_array(F.array_distinct(kept))).otherwise(least)


def with_sketch(rows: DataFrame, text: str, into: str) -> DataFrame:
    """`rows` with the sketch of a text column: sorted hashes, equal for equal texts.

    The union of sketches is the sketch of the union only where all of them hold hashes below the
    threshold. A text with none there (24 % of texts of 5 shingles, 6 % of 10) has its least hash, which
    the sketch of a longer text seldom holds: likeness and containment then read 0.

    Words are separated by ASCII white space. Each step is a column of its own, so that none is
    computed twice.
    """
    words, hashes = f"{into}_words", f"{into}_hashes"
    return (
        rows.withColumn(words, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+"), F.lit(0)))
        .withColumn(hashes, shingle_hashes(F.col(words)))
        .withColumn(into, scaled(F.col(hashes)))
        .drop(words, hashes)
    )


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles, intersection by union; 1 for two empty sketches."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / F.greatest(either, F.lit(1)))


def containment(a: str, b: str) -> Column:
    """Estimated share of the shingles of `a` that `b` has; 1 for an empty `a`."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1)))


def as_text(sketch: str) -> Column:
    """A fingerprint: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def run_neighbours(keys: DataFrame, order: list[str], carried: list[str]) -> DataFrame:
    """`keys` with next_<c> for the carried columns of the row that follows in `order`, around the end.

    Rows are dealt by ranges of the order; only the first row of each range, a row per partition,
    comes together to link the ranges. `order` must tell all rows apart.
    """
    ranged = cut(keys.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*order)
    names = [f"next_{c}" for c in carried]
    first = ranged.groupBy("range").agg(F.min(F.struct(*order, *[c for c in carried if c not in order])).alias("first"))
    ranges = Window.orderBy("range")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = first.select(
        "range", F.coalesce(F.lead("first").over(ranges), F.first("first").over(whole)).alias("following")
    )
    return (
        ranged.withColumn("lead", F.lead(F.struct(*carried)).over(inside))
        .join(following, "range")
        .select(
            *keys.columns,
            *(
                F.when(F.col("lead").isNotNull(), F.col(f"lead.{c}")).otherwise(F.col(f"following.{c}")).alias(n)
                for c, n in zip(carried, names)
            ),
        )
    )


def run_fingerprints(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Sketches of every document and of its edited text, and how alike neighbours are.

    The next document is the one that follows by descending id; after the last comes the first. In
    the edited text the last third of the code points, rounded down, is replaced by as many of the
    first ones of the next document's text, or all it has. Returns the id, n_chars, edited (the text),
    sketch, edited_sketch, next_id, next_sketch and copies: how many rows have this id and text.

    Null texts are empty; rows without id come last; rows of one id and different texts come in a
    fixed order. Rows that repeat an id and a text are one document: they have the same next one and the
    same result each. A single document follows itself. An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    number = F.col(id_column).cast("long")
    rows = documents.select(
        number.alias("id"),
        whole.alias("text"),
        F.xxhash64(F.lit(1), number, number.isNull(), whole).alias("a"),
        F.xxhash64(whole, number.isNull(), number, F.lit(2)).alias("b"),
    )
    keys = cut(
        rows.groupBy("id", "a", "b", F.length("text").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    )
    ordered = keys.select("a", "b", "n_chars", "copies", F.col("id").isNull().alias("o1"), F.bitwise_not("id").alias("o2"))
    links = cut(run_neighbours(ordered, ["o1", "o2", "a", "b"], ["a", "b"]))
    # Both uses below need the same columns, so that the texts are shuffled once for both.
    known = rows.groupBy("a", "b").agg(F.first("id").alias("id"), F.first("text").alias("text"))
    # What the next document gives: keyed by itself, asked for by the one before it.
    wanted = links.select(
        F.col("next_a").alias("a"),
        F.col("next_b").alias("b"),
        F.col("a").alias("for_a"),
        F.col("b").alias("for_b"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
        "copies",
    )
    given = with_sketch(known.join(wanted, ["a", "b"]), "text", "next_sketch").select(
        F.col("for_a").alias("a"),
        F.col("for_b").alias("b"),
        F.col("id").alias("next_id"),
        F.substring("text", F.lit(1), F.col("wanted")).alias("given"),
        "next_sketch",
        "wanted",
        "copies",
    )
    edited = (
        known.withColumn("n_chars", F.length("text").cast("long"))
        .join(given, ["a", "b"])
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - F.col("wanted")).cast("int")), "given"))
    )
    sketched = with_sketch(with_sketch(edited, "text", "sketch"), "edited", "edited_sketch")
    return sketched.select(
        F.col("id").alias(id_column), "n_chars", "edited", "sketch", "edited_sketch", "next_id", "next_sketch", "copies"
    )


def repeated(rows: DataFrame) -> DataFrame:
    """`rows` as often as their copies say; many copies of one row are made by several tasks."""
    once = rows.where("copies = 1").drop("copies")
    several = rows.where("copies > 1").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES_AT_ONCE}")))
    )
    here = F.least(F.lit(COPIES_AT_ONCE).cast("long"), F.col("copies") - F.col("block") * COPIES_AT_ONCE)
    dealt = several.repartition(F.col("block"), *(F.col(c) for c in rows.columns if c != "copies"))
    made = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), here)))
    return once.unionByName(made.drop("block", "copies", "copy"))
