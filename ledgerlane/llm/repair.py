"""Repairs conversations by the cheapest edits that give them a legal order of roles.

The rows of a conversation and the roles that may stand before each of them span a lattice whose arcs
are edits with whole-number costs. An auction finds the cheapest way through: every node has a price,
a path grows from its end along the arc with the least cost plus price, and where that is more than the
end's own price, the price is raised and the path drawn back by one node. When the path arrives, prices
differ along cheapest ways by exactly the costs of their arcs. Such arcs are tight; the repair is traced
along them, the least letter first.

The lattice is cut into blocks of a few rows, from the last to the first, each with the entry prices of
the one behind it as its exit prices. Rows are dealt by ranges of (conversation, turn), so a conversation
of any length is spread over tasks: its pieces give their costs between entry and exit roles, a row per
piece, and the prices and roles at the seams follow from these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import cut, discard

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: Rows of a block. Prices are raised step by step, so a block's work grows with its square.
BLOCK_ROWS = 8
#: Characters of role and text that decide between the ranges of equal turns.
RANGE_CHARACTERS = 64
WHITE_SPACE = " \t\n\x0b\x0c\r"

# What a conversation ended with so far: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)
INITIALS = {"s": 0, "u": 1, "a": 2}
_KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: At the end of a conversation rows are inserted until an assistant row is the last.
END_INSERTS = (0, 2, 1, 0)
END = tuple(COSTS[INSERT] * n for n in END_INSERTS)
FAR = 1 << 50


def _arcs(code: int) -> list[list[tuple[str, int, int, int]]]:
    """By state: (letter, cost, rows consumed, next state), for a row of this initial that may be truncated."""
    initial, extra = code >> 1, TRUNCATED * (code & 1)
    found = []
    for state in STATES:
        arcs = [(DELETE, COSTS[DELETE], 1, state), (INSERT, COSTS[INSERT], 0, NEXT[state])]
        if state in _KEPT[initial]:
            arcs.append((KEEP, COSTS[KEEP] + extra, 1, _KEPT[initial][state]))
        arcs.append((REROLE, COSTS[REROLE] + extra, 1, NEXT[state]))
        found.append(sorted(arcs))
    return found


ARCS = [_arcs(code) for code in range(8)]


def row_code(initial: str, truncated: bool) -> int:
    return INITIALS.get(initial, 3) << 1 | truncated


def auction(codes: list[int], exits: list[int]) -> list[int]:
    """Prices of the nodes 4 * row + state of a block: at its entry the least costs to get out.

    `exits` are the prices behind the block, the least of them 0. One path starts from each entry
    state in turn and finds the prices that those before it left.
    """
    end = 4 * len(codes)
    prices = [0] * (end + 4)
    for origin in STATES:
        path = [origin]
        while True:
            node = path[-1]
            level, state = node & ~3, node & 3
            if level == end:
                least, target = exits[state], None
            else:
                least = FAR << 1
                for _, cost, down, new in ARCS[codes[level >> 2]][state]:
                    to = level + 4 * down + new
                    if cost + prices[to] < least:
                        least, target = cost + prices[to], to
            if prices[node] < least:
                prices[node] = least
                if len(path) > 1:
                    path.pop()
            elif target is None:
                break
            else:
                path.append(target)
    return prices


def trace(codes: list[int], prices: list[int], exits: list[int], entry: int) -> tuple[int, list[str]]:
    """(exit state, edits of each row, with the inserts before it) of the least tight way from an entry state.

    Prices off the cheapest ways may still be low, so a tight arc can lead nowhere; then the next is taken.
    """
    end, nowhere = 4 * len(codes), set()
    edits: list[tuple[int, str]] = []

    def follow(level: int, state: int) -> int | None:
        node = level + state
        if level == end:
            return state if prices[node] == exits[state] else None
        if node in nowhere:
            return None
        for letter, cost, down, new in ARCS[codes[level >> 2]][state]:
            if prices[node] == cost + prices[level + 4 * down + new]:
                edits.append((level >> 2, letter))
                if (found := follow(level + 4 * down, new)) is not None:
                    return found
                edits.pop()
        nowhere.add(node)
        return None

    left = follow(0, entry)
    by_row = [""] * len(codes)
    for row, letter in edits:
        by_row[row] += letter
    return left, by_row


def block_prices(codes: list[int], exits: list[int]) -> tuple[list[tuple], list[int], int]:
    """(first row, prices, exits) of the blocks in order, the prices at the entry, and what these lack."""
    blocks, lacking = [], min(exits)
    exits = [x - lacking for x in exits]
    for first in reversed(range(0, len(codes), BLOCK_ROWS)):
        prices = auction(codes[first : first + BLOCK_ROWS], exits)
        blocks.append((first, prices, exits))
        least = min(prices[:4])
        lacking += least
        exits = [x - least for x in prices[:4]]
    return blocks[::-1], exits, lacking


def repair_codes(codes: list[int], blocks: list[tuple], entry: int) -> tuple[int, list[str], list[int]]:
    """(exit state, edits of each row, state before each row)."""
    edits: list[str] = []
    before: list[int] = []
    state = entry
    for first, prices, exits in blocks:
        state_in = state
        state, found = trace(codes[first : first + BLOCK_ROWS], prices, exits, state_in)
        edits += found
        for letters, code in zip(found, codes[first : first + BLOCK_ROWS]):
            before.append(state_in)
            for letter in letters:
                state_in = next(new for a, _, _, new in ARCS[code][state_in] if a == letter)
    return state, edits, before


def _piece(table: pa.Table) -> pa.Table:
    """What a piece of a conversation costs between entry and exit states.

    Nothing or a system row alone can only stay so by deletions; all else is asked of the auction.
    """
    table = table.sort_by("seq")
    live = [row_code(i, t) for i, t, x in zip(*(table.column(c).to_pylist() for c in ("initial", "truncated", "live"))) if x]
    size = len(live)
    costs = [FAR] * 16
    costs[4 * START + START] = costs[4 * SYSTEM + SYSTEM] = COSTS[DELETE] * size
    kept = [TRUNCATED * (code & 1) for code in live if code >> 1 == INITIALS["s"]]
    if kept:
        costs[4 * START + SYSTEM] = COSTS[DELETE] * (size - 1) + min(kept)
    for state in (USER, ASSISTANT):
        exits = [FAR] * 4
        exits[state] = 0
        _, prices, lacking = block_prices(live, exits)
        for entry in STATES:
            costs[4 * entry + state] = min(FAR, prices[entry] + lacking)
    first = table.slice(0, 1).select(["conv", "part"])
    return first.append_column("costs", pa.array([costs], pa.list_(pa.int64()))).append_column(
        "last_initial", table.column("initial").slice(table.num_rows - 1)
    )


def _seam_prices(table: pa.Table) -> pa.Table:
    """The exit prices of all pieces of a conversation, from its end on, and the role before each piece."""
    table = table.sort_by("part")
    exits, found = list(END), []
    for costs in reversed(table.column("costs").to_pylist()):
        least = min(exits)
        exits = [x - least for x in exits]
        found.append(exits)
        exits = [min(costs[4 * entry + x] + exits[x] for x in STATES) for entry in STATES]
    parts = table.num_rows
    initials = table.column("last_initial").to_pylist()
    return pa.table(
        {
            "conv": table.column("conv"),
            "part": table.column("part"),
            "exits": pa.array(found[::-1], pa.list_(pa.int64())),
            "initial_before": pa.array([None, *initials[:-1]], pa.string()),
            "last": pa.array([k == parts - 1 for k in range(parts)]),
        }
    )


def _seam_states(table: pa.Table) -> pa.Table:
    """The state at the entry of every piece of a conversation."""
    table = table.sort_by("part")
    state, entries = START, []
    for after in table.column("after").to_pylist():
        entries.append(state)
        state = after[state]
    return table.select(["conv", "part"]).append_column("entry", pa.array(entries, pa.int32()))


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_TRACED = "seq long, edits array<string>, before array<int>, after array<int>, illegal long"


def _trace_part(table: pa.Table) -> pa.Table:
    """Edits of all rows of a range; for a piece of a longer conversation one way per entry state."""
    table = table.sort_by("seq")
    names = ("seq", "conv", "initial", "truncated", "live", "copies", "exits", "initial_before", "last")
    rows = list(zip(*(table.column(c).to_pylist() for c in names)))
    seqs, all_edits, all_before, all_after, all_illegal = [], [], [], [], []
    start = 0
    while start < len(rows):
        stop = start + 1
        while stop < len(rows) and rows[stop][1] == rows[start][1]:
            stop += 1
        piece = rows[start:stop]
        whole = piece[0][6] is None
        exits, last = (list(END), True) if whole else (piece[0][6], piece[0][8])
        codes = [row_code(r[2], r[3]) for r in piece if r[4]]
        blocks, _, _ = block_prices(codes, exits)
        ways = []
        for entry in (START,) if whole else STATES:
            state, found, before = repair_codes(codes, blocks, entry)
            edits, befores, now, k = [], [], entry, 0
            for row in piece:
                if row[4]:
                    edits.append(found[k] + DELETE * (row[5] - 1))
                    befores.append(before[k])
                    k += 1
                    now = before[k] if k < len(before) else state
                else:
                    edits.append(DELETE * row[5])
                    befores.append(now)
            if last:
                edits[-1] += INSERT * END_INSERTS[state]
            ways.append((edits, befores, state))
        previous = piece[0][7]
        for k, row in enumerate(piece):
            seqs.append(row[0])
            all_edits.append([w[0][k] for w in ways])
            all_before.append([w[1][k] for w in ways])
            all_after.append([w[2] for w in ways] if not whole and k == len(piece) - 1 else None)
            all_illegal.append(row[5] - 1 + (previous is not None and (previous, row[2]) not in _LEGAL))
            previous = row[2]
        start = stop
    columns = (
        (seqs, pa.int64()),
        (all_edits, pa.list_(pa.string())),
        (all_before, pa.list_(pa.int32())),
        (all_after, pa.list_(pa.int32())),
        (all_illegal, pa.int64()),
    )
    return pa.table([pa.array(x, kind) for x, kind in columns], names=["seq", "edits", "before", "after", "illegal"])


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & left[name].eqNullSafe(right[name])
    return same


def _letters(edits: str, *letters: str) -> Column:
    left = F.translate(edits, "".join(letters), "")
    return (F.length(edits) - F.length(left)).cast("long")


def run_repair(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """One row per different message of a conversation, with its first fault and its edits.

    (conv, seq, turn, role, text, copies, fault, edits, before, illegal, cost). Rows of a conversation are
    taken by turn, nulls first, those of one turn by role and text; `seq` grows in that order. Equal rows
    are one with the number of its `copies` (summed from the column of that name, if given).

    fault: "blank" without a character other than ASCII white space; "duplicate" if an earlier row, or a
    copy in the same row, has its role and text; "truncated" if its last such character is not one of
    `.!?`; else null. `edits` holds D, I, K and R, for rows inserted before the row, the row and its
    copies, and at the end of a conversation rows inserted after it. All edits in order are the cheapest
    that give role initials `(s?(ua)+)?`, of equally cheap ones the least by ASCII: K keeps a row, R gives
    it the role user or assistant (3), D deletes it (4; blank and duplicate rows must go), I inserts an
    empty user or assistant row (3); a truncated row that stays costs 3 more. `before` is the state before
    the edits: 0 nothing yet, 1 system, 2 user, 3 assistant. `illegal` counts how often the row or a copy
    follows a row, deleted or not, whose initial and its own are not su, ua or au; an empty role has none.

    Null roles and texts are one space. Rows without conversation are one conversation. An empty table
    gives an empty result; further columns are not read. Very long conversations are spread over tasks;
    no task holds more rows than a range.
    """

    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    number = F.sum(column(copies)) if copies else F.count(F.lit(1))
    rows = messages.groupBy(
        column(conv).alias("conv"),
        column(turn).alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(column(text).cast("string"), F.lit(" ")).alias("text"),
    ).agg(number.cast("long").alias("copies"))
    ranges = [F.col("conv"), F.col("turn"), *(F.substring(c, 1, RANGE_CHARACTERS) for c in ("role", "text"))]
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    shown = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    ordered = cut(
        rows.repartitionByRange(*ranges)
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select(
            F.monotonically_increasing_id().alias("seq"),
            F.spark_partition_id().alias("part"),
            "*",
            F.substring("role", 1, 1).alias("initial"),
            (shown == "").alias("blank"),
            (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
            said.alias("said"),
        )
    )
    # The first row of equal ones is found by its number, so that nothing is joined on what may be said often.
    firsts = ordered.where("not blank").groupBy("conv", "said").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("live"))
    narrow = ordered.select("seq", "part", "conv", "initial", "truncated", "copies", "blank")
    narrow = cut(narrow.join(firsts, "seq", "left").withColumn("live", F.coalesce("live", F.lit(False))))

    # Conversations of several ranges; there are fewer than ranges, so what follows about them is small.
    seams = narrow.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b")
    seams = seams.select(F.col("conv").alias("c"))
    kind = dict(narrow.dtypes)["conv"]
    long_ones = narrow.join(F.broadcast(seams), narrow["conv"].eqNullSafe(F.col("c")), "left_semi")
    pieces = long_ones.groupBy("conv", "part").applyInArrow(_piece, f"conv {kind}, part int, costs array<long>, last_initial string")
    exits = pieces.groupBy("conv").applyInArrow(
        _seam_prices, f"conv {kind}, part int, exits array<long>, initial_before string, last boolean"
    )
    exits = cut(exits)
    both = narrow.join(F.broadcast(exits), _same(narrow, exits, "conv", "part"), "left").drop(exits["conv"]).drop(exits["part"])
    traced = cut(both.groupBy("part").applyInArrow(_trace_part, _TRACED))
    # The piece of a row is told by its number.
    joints = traced.where("after is not null").join(narrow.select("seq", "conv", "part"), "seq")
    entries = cut(joints.groupBy("conv").applyInArrow(_seam_states, f"conv {kind}, part int, entry int"))

    found = ordered.join(traced.drop("after"), "seq").join(narrow.select("seq", "live"), "seq")
    found = found.join(F.broadcast(entries), _same(found, entries, "conv", "part"), "left").drop(entries["conv"]).drop(entries["part"])
    way = F.coalesce("entry", F.lit(START))
    found = found.withColumns({"edits": F.get("edits", way), "before": F.get("before", way)})
    stays = F.col("live") & F.col("truncated") & (_letters("edits", KEEP, REROLE) > 0)
    cost = sum((COSTS[x] * _letters("edits", x) for x in (DELETE, INSERT, REROLE)), F.lit(0)) + F.when(stays, TRUNCATED).otherwise(0)
    fault = (
        F.when(F.col("blank"), "blank").when(~F.col("live"), "duplicate").when(F.col("truncated"), "truncated")
    )
    columns = ("conv", "seq", "turn", "role", "text", "copies", fault.alias("fault"), "edits", "before", "illegal", cost.cast("long").alias("cost"))
    edited = cut(found.select(*columns))
    discard(ordered, narrow, exits, traced, entries)
    return edited


def repaired_messages(edited: DataFrame) -> DataFrame:
    """(conv, seq, place, role, text, inserted): the rows that the edits of `run_repair` leave, ordered by seq and place."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, places, roles, kept = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("edits", "before", "role"))
            for row, (edits, state, role) in enumerate(zip(*columns)):
                for place, letter in enumerate(edits):
                    if letter == DELETE:
                        continue
                    if letter == KEEP:
                        state = _KEPT[INITIALS[role[0]]][state]
                        roles.append(role)
                    else:
                        state = NEXT[state]
                        roles.append(ROLES[state])
                    at.append(row)
                    places.append(place)
                    kept.append(letter != INSERT)
            rows = pa.array(at, pa.int64())
            kept = pa.array(kept, pa.bool_())
            text = pa.compute.if_else(kept, batch.column("text").take(rows), pa.scalar("", batch.schema.field("text").type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv").take(rows),
                    batch.column("seq").take(rows),
                    pa.array(places, pa.int64()),
                    pa.array(roles, pa.string()),
                    text,
                    pa.compute.invert(kept),
                ],
                names=["conv", "seq", "place", "role", "text", "inserted"],
            )

    kind = dict(edited.dtypes)["conv"]
    narrow = edited.select("conv", "seq", "edits", "before", "role", "text")
    return narrow.mapInArrow(apply, f"conv {kind}, seq long, place long, role string, text string, inserted boolean")


def conversation_counts(edited: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost) per conversation; gaps are turns that no row has."""
    turns = edited.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    single = (F.col("fault").isNull() | (F.col("fault") == "truncated")).cast("long")
    counts = edited.groupBy("conv").agg(
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault").eqNullSafe("blank"), 0).otherwise(F.col("copies") - single)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
    )
    joined = counts.join(turns.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    return joined.withColumn("gaps", F.coalesce(F.col("gaps").cast("long"), F.lit(0)))


def conversation_digests(edited: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): all edits in order, and the digest of `role:text` of what they leave, a line each.

    A digest runs over a conversation from its first byte to its last, so its rows pass through one task
    one after the other, sorted by Spark; the task holds a batch of them and the letters of the audit.
    """
    kind = dict(edited.dtypes)["conv"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, digested, lines = None, [], None, 0
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (schema.field("conv").type, pa.string(), pa.string()))],
                names=["conv", "audit", "repaired_sha256"],
            )
            out.clear()
            return made

        schema = None
        for batch in batches:
            schema = batch.schema
            for conv, edits, state, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edits", "before", "role", "text"))):
                if digested is None or conv != now:
                    if digested is not None:
                        out.append((now, "".join(audit), digested.hexdigest()))
                    now, audit, digested, lines = conv, [], hashlib.sha256(), 0
                audit.append(edits)
                for letter in edits:
                    if letter == DELETE:
                        continue
                    kept_role = role
                    if letter == KEEP:
                        state = _KEPT[INITIALS[role[0]]][state]
                    else:
                        state = NEXT[state]
                        kept_role = ROLES[state]
                    line = f"{kept_role}:{'' if letter == INSERT else text}"
                    digested.update((("\n" if lines else "") + line).encode())
                    lines += 1
            if out:
                yield batch_of()
        if digested is not None:
            out.append((now, "".join(audit), digested.hexdigest()))
            yield batch_of()

    rows = edited.select("conv", "seq", "edits", "before", "role", "text").repartition("conv").sortWithinPartitions("conv", "seq")
    return rows.mapInArrow(digest, f"conv {kind}, audit string, repaired_sha256 string")
