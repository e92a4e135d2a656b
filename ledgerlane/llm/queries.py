"""One query per operator, over its whole table, with the columns that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.bpe import run_encode
from ledgerlane.llm.chat import format_chat, read_content, read_loss, read_role, text_parts
from ledgerlane.llm.collocations import run_collocations
from ledgerlane.llm.decontaminate import run_contamination
from ledgerlane.llm.fingerprints import as_text, containment, likeness, repeated, run_fingerprints
from ledgerlane.llm.html_text import extract_text
from ledgerlane.llm.lm import run_backoff_scores
from ledgerlane.llm.near_dup import run_near_duplicates
from ledgerlane.llm.pieces import encode_pieces
from ledgerlane.llm.pii import KINDS, run_find_personal_data
from ledgerlane.llm.quality import run_quality
from ledgerlane.llm.repair import conversation_counts, conversation_digests, run_repair
from ledgerlane.llm.repair_sql import REPAIRS
from ledgerlane.llm.url_filter import LONG_SUFFIXES, Rule, run_judge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return run_near_duplicates(table(spark, folder, "documents"), width=4)


ORACLE["op10_near_duplicates"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, list_slice(words, start, start + 3) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS start FROM words WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 100 * common >= 80 * (x.size + y.size - common)
), edges AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached(doc_id, root) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT e.v, r.root FROM reached r JOIN edges e ON e.u = r.doc_id
)
SELECT r.doc_id, any_value(coalesce(size, 0))::BIGINT AS n_shingles, min(root) AS component_id, min(root) = r.doc_id AS kept
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op6_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = run_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda n, hit: n + hit.last - hit.first).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE["op6_benchmark_passages"] = r"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS width,
        list_slice(words, start, start + least(len(words), 10) - 1) AS phrase
    FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS start
          FROM item_words WHERE len(words) > 0)
), document_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), places AS (
    SELECT doc_id, width, start, list_slice(words, start, start + width - 1) AS phrase
    FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS start
          FROM document_words, (SELECT DISTINCT width FROM windows) WHERE len(words) >= width)
), found AS (
    SELECT doc_id, item_id, start, p.width FROM places p JOIN windows w ON p.width = w.width AND p.phrase = w.phrase
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + width)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM document_words d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op9_quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    return run_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _span_list(spans) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string")))
    return F.array_join(texts, ",")


@query
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = run_find_personal_data(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s.by_rule)

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_span_list(base), 256).alias("base_sha256"), _span_list("spans").alias("spans")
    )


@query
def op2_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    encoded = run_encode(documents, public_tokenizers.path("word_bpe_49k.json"), decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op7_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)


# Words that mark a page nobody wants to read.
BAD_WORDS = ("adult", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")


def page_outcome() -> Column:
    """The label of a page, from the page itself: bad if its url or title has a bad word; none without both."""
    title = F.regexp_extract(F.coalesce("html", F.lit("")), "(?is)<title[^>]*>(.*?)</title>", 1)
    said = F.lower(F.concat_ws(" ", "url", title))
    bad = said.rlike("(^|[^a-z])(" + "|".join(BAD_WORDS) + ")([^a-z]|$)")
    return F.when(F.trim(said) != "", ~bad)


@query
def op1_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return run_judge(table(spark, folder, "pages"), RULES, good=page_outcome())


ORACLE["op1_url_verdicts"] = r"""
WITH split AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
        lower(concat_ws(' ', url, regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1))) AS said
    FROM pages
), rules(action, pattern, rule_host, rule_path) AS (
    VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
        ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
        ('block', 'com/de/', 'com', '/de/')
), ruled AS (
    SELECT s.*, (SELECT max({'size': length(pattern), 'pattern': pattern, 'action': action}) FROM rules
        WHERE (s.host = rule_host OR ends_with(s.host, '.' || rule_host)) AND starts_with(s.path, rule_path)) AS found
    FROM split s
), plain AS (
    SELECT host, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name,
        sum((NOT regexp_matches(said, '(^|[^a-z])(BAD_WORDS)([^a-z]|$)'))::INT) AS good, count(*) AS labelled
    FROM ruled WHERE trim(said) <> '' GROUP BY host
), suffixed AS (
    SELECT *, CASE WHEN regexp_matches(name, '(^|[.])(LONG_SUFFIXES)$')
        THEN array_to_string(string_split(name, '.')[-2:], '.') ELSE string_split(name, '.')[-1] END AS suffix
    FROM plain
), hosts AS (
    SELECT host, coalesce(good, 0) AS good, labelled, suffix,
        array_to_string(string_split(name, '.')[-(len(string_split(suffix, '.')) + 1):], '.') AS domain
    FROM suffixed
), suffix_sums AS (
    SELECT suffix, sum(good) AS good, sum(labelled) AS labelled,
        (SELECT (sum(good) + 0.5) / (sum(labelled) + 1) FROM hosts) AS prior
    FROM hosts GROUP BY suffix
), suffix_weight AS (
    SELECT coalesce(round(1 / least(greatest((sum(labelled * pow(good / labelled - prior, 2)) - sum(prior * (1 - prior)))
        / nullif(sum(prior * (1 - prior) * (labelled - 1)), 0), 0.001), 0.999) - 1, 9), 1) AS weight
    FROM suffix_sums WHERE labelled > 0
), domain_sums AS (
    SELECT domain, h.suffix, sum(h.good) AS good, sum(h.labelled) AS labelled,
        any_value((s.good + weight * s.prior) / (s.labelled + weight)) AS prior
    FROM hosts h JOIN suffix_sums s USING (suffix), suffix_weight GROUP BY domain, h.suffix
), domain_weight AS (
    SELECT coalesce(round(1 / least(greatest((sum(labelled * pow(good / labelled - prior, 2)) - sum(prior * (1 - prior)))
        / nullif(sum(prior * (1 - prior) * (labelled - 1)), 0), 0.001), 0.999) - 1, 9), 1) AS weight
    FROM domain_sums WHERE labelled > 0
), units AS (
    SELECT h.host, h.good, h.labelled, (d.good + weight * d.prior) / (d.labelled + weight) AS prior
    FROM hosts h JOIN domain_sums d USING (domain, suffix), domain_weight
), host_weight AS (
    SELECT coalesce(round(1 / least(greatest((sum(labelled * pow(good / labelled - prior, 2)) - sum(prior * (1 - prior)))
        / nullif(sum(prior * (1 - prior) * (labelled - 1)), 0), 0.001), 0.999) - 1, 9), 1) AS weight
    FROM units WHERE labelled > 0
), posterior AS (
    SELECT host, good + weight * prior AS a, labelled - good + weight * (1 - prior) AS b FROM units, host_weight
), reputation AS (
    SELECT host, round(a / (a + b) - 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))), 9) AS bound FROM posterior
)
SELECT page_id, host, path, found.pattern AS rule,
    coalesce(found.action, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled JOIN reputation USING (host)
"""
ORACLE["op1_url_verdicts"] = ORACLE["op1_url_verdicts"].replace("BAD_WORDS", "|".join(BAD_WORDS)).replace(
    "LONG_SUFFIXES", "|".join(LONG_SUFFIXES).replace(".", "[.]")
)


@query
def op3_scaled_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = run_fingerprints(table(spark, folder, "documents"))
    return repeated(
        found.select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            as_text("sketch").alias("fingerprint"),
            as_text("edited_sketch").alias("edited_fingerprint"),
            likeness("sketch", "edited_sketch").alias("near_edited"),
            likeness("sketch", "next_sketch").alias("near_next"),
            containment("sketch", "edited_sketch").alias("contained_in_edited"),
            F.col("next_id").alias("next_doc_id"),
            "copies",
        )
    )


#: A conversation whose texts look like another template's control strings.
CONTROL = "SELECT * FROM VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


@query
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(CONTROL)
    messages = said.union(control.select(*(F.col(c).cast(t) for c, t in said.dtypes)))
    chats = format_chat(messages.withColumn("parts", text_parts(F.col("text"))))
    newline = F.lit("\n")
    loss = F.array_join(F.transform("turns", read_loss), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(
                F.transform("turns", lambda t: F.concat(read_role(t["text"]), newline, read_content(t["text"]), newline)), ""
            ),
            256,
        ).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
    )


ORACLE["op4_chat_format"] = r"""
WITH messages AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    sum(23 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT
        AS formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS attachment_tokens
FROM messages GROUP BY conv_id
"""


@query
def op5_backoff_scores(spark: SparkSession, folder: str) -> DataFrame:
    return run_backoff_scores(table(spark, folder, "documents"), left_out="document")


@query
def op13_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    encoded = encode_pieces(documents, public_tokenizers.path("piece_bpe_32k.model"), spans=True, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2("spans", 256).alias("spans_sha256"),
    )


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return run_collocations(table(spark, folder, "documents"))


ORACLE["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), word_lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
    SELECT lang, width, list_slice(words, start, start + width - 1) AS words
    FROM (SELECT lang, words, width, unnest(range(1, len(words) - width + 2)) AS start
          FROM word_lists, (VALUES (1), (2), (3)) AS widths(width) WHERE len(words) >= width)
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE width = 1 GROUP BY lang
), counts AS (
    SELECT lang, width, words, array_to_string(words, ' ') AS phrase, count(*) AS f
    FROM grams GROUP BY lang, width, words HAVING count(*) >= 10
), parts AS (
    SELECT lang, phrase, width, f, cut, array_to_string(list_slice(words, 1, cut), ' ') AS first_part,
        array_to_string(list_slice(words, cut + 1, width), ' ') AS rest
    FROM (SELECT *, unnest(range(1, width)) AS cut FROM counts WHERE width > 1)
), scored AS (
    SELECT p.lang, p.phrase, p.width, p.f AS a, cut, x.f AS l, y.f AS r,
        (1000000::HUGEINT * p.f::HUGEINT * p.f::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = first_part JOIN counts y ON y.lang = p.lang AND y.phrase = rest
), lowest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored
), covered AS (
    SELECT lang, array_to_string(list_slice(words, side, side + 1), ' ') AS phrase, max(f) AS most
    FROM counts, (VALUES (1), (2)) AS sides(side) WHERE width = 3 GROUP BY ALL
), ranked AS (
    SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
    FROM lowest w LEFT JOIN covered c ON c.lang = w.lang AND c.phrase = w.phrase AND w.width = 2
    WHERE place = 1 AND NOT coalesce(100 * most >= 50 * a, false)
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def damaged(messages: DataFrame) -> DataFrame:
    """Rows (nulls are one space) that their conversation and turn let go, empty, cut short, repeat or turn into user rows."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = named
    fate = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return messages.where(fate != 0).select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 3, 2).otherwise(1).alias("copies"),
    )


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    edited = run_repair(damaged(said), copies="copies")
    counts, digests = conversation_counts(edited), conversation_digests(edited)
    found = counts.join(digests.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    known = said.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(b""), 256)
    return known.select(
        "conv_id",
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


ORACLE["op12_conversation_repair"] = REPAIRS
