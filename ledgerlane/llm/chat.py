"""Chat conversations as one marked text each, with a loss mask and attachments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template. All control strings begin with OPEN, which no escaped text holds.
OPEN, TURN, SAYS, END = "<|", "<|turn|>", "<|says|>", "<|end|>"
PART_KINDS = ("image", "audio", "document")
#: What an attachment is expanded to when it is fed in: tokens per image patch, second and page.
PATCH, TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 1024

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"


def escaped(text: Column) -> Column:
    """`text` without control strings: \\ becomes \\\\ and <| becomes <\\|."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(OPEN), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """The parts of a message that is only text."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            none.cast("string").alias("ref"),
            none.cast("int").alias("width"),
            none.cast("int").alias("height"),
            none.cast("double").alias("seconds"),
            none.cast("int").alias("pages"),
        )
    )


def _visited(part: Column) -> Column:
    """One visit of a part: what it is in the text, and for an attachment its kind, ref and expanded tokens."""

    def steps(size: Column, step: int) -> Column:
        return F.ceil(F.coalesce(size, F.lit(0)) / step)

    expanded = {
        "image": steps(part["width"], PATCH) * steps(part["height"], PATCH),
        "audio": F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND),
        "document": F.coalesce(part["pages"], F.lit(0)) * TOKENS_PER_PAGE,
    }

    def seen(shown: Column, kind: Column, ref: Column, tokens: Column) -> Column:
        return F.struct(
            shown.alias("shown"), kind.cast("string").alias("kind"), ref.cast("string").alias("ref"), tokens.cast("long").alias("tokens")
        )

    none = F.lit(None)
    found = seen(escaped(part["text"]), none, none, none)
    for kind in PART_KINDS:
        tokens = F.greatest(expanded[kind].cast("long"), F.lit(0).cast("long"))
        found = F.when(part["kind"] == kind, seen(F.lit(f"<|{kind}|>"), F.lit(kind), part["ref"], tokens)).otherwise(found)
    return found


def format_chat(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per conversation: its marked text, its turns, and its attachments.

    `parts` is an array of typed parts (see PARTS); every kind but text, image, audio and document
    is read as text. A message is <|turn|>role<|says|>content<|end|>; its content are its parts in
    order, texts escaped, attachments as placeholders. Returns the conversation, turns (text of each
    message, and loss_start and loss_length: the code points of it that count for the loss, the
    content of assistants), formatted (all messages in one), attachments (turn, place among all
    attachments, kind, ref, tokens) and attachment_tokens.

    Messages are ordered by turn, null first, then by role and content, unescaped. Null roles, parts and texts are
    empty. A row without conversation is a conversation of its own. Repeated rows are turns of their
    own. An empty table gives an empty result; other columns are not looked at.
    """
    listed = F.coalesce(F.col(parts), F.array().cast(PARTS))
    visited = messages.withColumn("__visited", F.transform(listed, _visited))
    rows = visited.select(
        F.col(conversation).alias("conversation"),
        F.when(F.col(conversation).isNull(), F.monotonically_increasing_id()).alias("alone"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.array_join(F.transform("__visited", lambda v: v["shown"]), "").alias("content"),
        F.transform(
            F.filter("__visited", lambda v: v["kind"].isNotNull()),
            lambda v: F.struct(v["kind"].alias("kind"), v["ref"].alias("ref"), v["tokens"].alias("tokens")),
        ).alias("attached"),
    )
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(SAYS))
    message = F.struct(
        "turn",
        "role",
        unescaped(F.col("content")).alias("said"),
        F.concat(head, "content", F.lit(END)).alias("text"),
        F.length(head).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length("content")).otherwise(0).alias("loss_length"),
        "attached",
    )
    found = rows.groupBy("conversation", "alone").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    flat = F.flatten(
        F.transform(
            "messages",
            lambda m: F.transform(
                m["attached"],
                lambda a: F.struct(m["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
            ),
        )
    )
    turns = F.transform(
        "messages",
        lambda m: F.struct(m["text"].alias("text"), m["loss_start"].alias("loss_start"), m["loss_length"].alias("loss_length")),
    )
    return (
        found.select("conversation", turns.alias("turns"), flat.alias("flat"))
        .select(
            F.col("conversation").alias(conversation),
            "turns",
            F.array_join("turns.text", "").alias("formatted"),
            F.transform(
                "flat",
                lambda a, i: F.struct(a["turn"].alias("turn"), i.alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")),
            ).alias("attachments"),
            F.aggregate("flat.tokens", F.lit(0).cast("long"), lambda n, t: n + t).alias("attachment_tokens"),
        )
    )


def read_role(turn_text: Column) -> Column:
    return unescaped(F.substring_index(F.substring(turn_text, len(TURN) + 1, 1 << 30), SAYS, 1))


def read_content(turn_text: Column) -> Column:
    """What a turn says; attachments are still placeholders, so this is for turns of text only."""
    after = F.split(turn_text, r"<\|says\|>", 2)[1]
    return unescaped(F.substring_index(after, END, 1))


def read_loss(turn: Column) -> Column:
    """The text under the loss mask of a turn."""
    return unescaped(F.substring(turn["text"], turn["loss_start"] + 1, turn["loss_length"]))
