"""Repair of conversations to a strict alternation of roles at the least cost.

Roles have to read ``(s?(ua)+)?`` by their initials. A turn is kept, given the role that is due, or
deleted, and missing turns are inserted; turns that are blank or repeat an earlier one have to go.
The state after a turn is one of four (start, system, user, assistant), and the vector of what the
rest of the conversation costs from each of them, less its least entry, is one of a few. Tables say
for every such vector and every block of ``BLOCK`` turns which vector stands before the block, so
costs run over a conversation from its end by one lookup a block. The trace then goes forward: each
block is expanded backward from the vector behind it, and of all edits that cost the least the one
whose initial comes first is taken, which gives the least string of initials among ties.

Turns of all conversations are sorted by range and cut into chunks of a fixed number of turns.
Conversations within a chunk are repaired at once. Those that reach a chunk's border are summarised
chunk by chunk, for every vector that may stand behind and every state before; the summaries of one
conversation are folded, and then its chunks are repaired apart. No task holds a whole conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import own_store, partitions
from demandcast.llm.runs import starts_of, whole_runs
from demandcast.operators.joins import lookup_join
from demandcast.sources.storage import Storage

# costs of the edits, and of a truncated turn that stays
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 20
#: Turns in a block of the tables; the tables have 9 ** BLOCK entries a vector.
BLOCK = 4
#: Turns in a chunk, as a power of two.
CHUNK_BITS = 12
WHITE = " \t\n\x0b\x0c\r"
# states: 0 start, 1 after system, 2 after user, 3 after assistant; the turn that is due in each leads to this state
DUE = (2, 2, 3, 2)
INITIALS = "sua"
# a turn as a symbol: 2 * (place of its initial in INITIALS, 3 for others) + whether it is truncated
NOTHING = 8
SYMBOLS = 9
FAULTS = ("blank", "duplicate", "truncated")


def _after(state: int, initial: int) -> int | None:
    """State after a turn that is kept; None where it is out of place."""
    if initial == 0:
        return 1 if state == 0 else None
    due = DUE[state]
    return due if initial == due - 1 else None


def _inserted(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state where turns may be inserted first."""
    for _ in range(3):
        costs = tuple(min(c, INSERT + costs[DUE[q]]) for q, c in enumerate(costs))
    return costs


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs before a turn from the costs after it."""
    initial, truncated = divmod(symbol, 2)
    out = []
    for q in range(4):
        kept = _after(q, initial)
        stays = min(REROLE + costs[DUE[q]], costs[kept] if kept is not None else FAR) + truncated * TRUNCATED
        out.append(min(DELETE + costs[q], stays))
    return _inserted(tuple(out))


def _edits(costs: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
    """The first of the cheapest edits up to and with one turn, and the state after it."""
    initial, truncated = divmod(symbol, 2)
    before, done = _before(costs, symbol), ""
    while True:
        least, kept = before[state], _after(state, initial)
        if DELETE + costs[state] == least:
            return done + "D", state
        if INSERT + before[DUE[state]] == least:
            done, state = done + "I", DUE[state]
        elif kept is not None and costs[kept] + truncated * TRUNCATED == least:
            return done + "K", kept
        else:
            return done + "R", DUE[state]


class Tables(NamedTuple):
    """Everything about vectors (less their least entry) by number; vector 0 is that of the end."""

    vectors: list[tuple[int, ...]]
    before: np.ndarray  # vector x symbol -> vector before the turn
    block: np.ndarray  # vector x block -> vector before the block
    edit: np.ndarray  # vector behind x state x symbol -> place in ``strings``
    after: np.ndarray  # vector behind x state x symbol -> state after
    strings: list[str]


@cache
def tables(block: int = BLOCK) -> Tables:
    vectors = [_inserted((0, FAR, FAR, 0))]
    number, at = {vectors[0]: 0}, 0
    moves: list[list[int]] = []
    while at < len(vectors):
        row = []
        for symbol in range(NOTHING):
            costs = _before(vectors[at], symbol)
            plain = tuple(c - min(costs) for c in costs)
            if plain not in number:
                number[plain] = len(vectors)
                vectors.append(plain)
            row.append(number[plain])
        moves.append([*row, at])
        at += 1
    before = np.array(moves, dtype=np.int16)
    blocks = before
    for _ in range(block - 1):
        # one more turn in front of the block
        blocks = before[blocks].swapaxes(1, 2).reshape(len(vectors), -1)
    strings = [""]
    edit = np.zeros((len(vectors), 4, SYMBOLS), dtype=np.int16)
    after = np.tile(np.arange(4, dtype=np.int8)[None, :, None], (len(vectors), 1, SYMBOLS))
    for v, costs in enumerate(vectors):
        for state in range(4):
            for symbol in range(NOTHING):
                text, after[v, state, symbol] = _edits(costs, symbol, state)
                if text not in strings:
                    strings.append(text)
                edit[v, state, symbol] = strings.index(text)
    return Tables(vectors, before, blocks, edit, after, strings)


def repair(symbols: np.ndarray, lengths: np.ndarray, behind: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits of many runs of turns at once.

    ``symbols`` holds the runs one after the other, ``behind`` the vector behind each, ``state`` the state before it.
    Returns the edits of each turn (places in ``Tables.strings``), the vector before each run and the state after it.
    """
    t = tables()
    edits = np.zeros(len(symbols), dtype=np.int16)
    first_vector, last_state = behind.astype(np.int16), state.astype(np.int8)
    start = np.cumsum(lengths) - lengths
    blocks = -(-lengths // BLOCK)
    # runs of about the same length together, so that at most half of a table is filled up
    size_class = np.ceil(np.log2(np.maximum(blocks, 1))).astype(np.int64)
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    for one in np.unique(size_class[lengths > 0]):
        runs = np.flatnonzero((size_class == one) & (lengths > 0))
        width = int(blocks[runs].max())
        inside = np.arange(width * BLOCK)[None, :] < lengths[runs][:, None]
        at = np.where(inside, start[runs][:, None] + np.arange(width * BLOCK), 0)
        held = np.where(inside, symbols[at], NOTHING)
        codes = held.reshape(len(runs), width, BLOCK) @ weights
        vector = np.empty((len(runs), width + 1), dtype=np.int16)
        vector[:, width] = behind[runs]
        for b in range(width - 1, -1, -1):
            vector[:, b] = t.block[vector[:, b + 1], codes[:, b]]
        first_vector[runs] = vector[:, 0]
        now = state[runs].astype(np.int64)
        found = np.zeros(held.shape, dtype=np.int16)
        for b in range(width):
            own = held[:, b * BLOCK : (b + 1) * BLOCK]
            inner = [vector[:, b + 1]]
            for i in range(BLOCK - 1, 0, -1):
                inner.append(t.before[inner[-1], own[:, i]])
            for i, after in enumerate(reversed(inner)):
                found[:, b * BLOCK + i] = t.edit[after, now, own[:, i]]
                now = t.after[after, now, own[:, i]].astype(np.int64)
        last_state[runs] = now
        edits[at[inside]] = found[inside]
    return edits, first_vector, last_state


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: turns spoilt by a hash of their place, for tests of the repair.

    crc32 of ``conv_id:turn`` modulo 20 drops a turn (0), empties its text (1), takes its ``.!?`` (2), doubles it (3) or gives
    it to the user (4). Nulls count as one space, in that text too.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rule = F.crc32(F.encode(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")), "UTF-8")) % 20
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), rule.alias("rule"),
    ).where("rule <> 0")
    text = F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("rule") == 3, 2).otherwise(1).cast("long").alias("times"),
    )


PLACE = ["no_conv", "conv", "no_turn", "at_turn", "said"]


def _placed(turns: DataFrame) -> DataFrame:
    """Turns with what orders them: conversation, turn (nulls first) and a 128-bit digest of role and text."""
    said = F.md5(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), "UTF-8"))
    return turns.withColumns(
        {
            "no_conv": F.col("conv_id").isNull(),
            "conv": F.coalesce("conv_id", F.lit(0)),
            "no_turn": F.col("turn").isNull(),
            "at_turn": F.coalesce("turn", F.lit(0)),
            "said": F.unhex(said),
        }
    )


def ordered_turns(turns: DataFrame, store: Storage) -> DataFrame:
    """Distinct turns in order: PLACE, times, symbol, fault and ``place``, a number that grows in that order.

    ``fault`` is a place in FAULTS or null. Turns that occur more than once are one row with ``times``; all but the
    first are duplicates.
    """
    rows = _placed(turns)
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    small = rows.select(
        *PLACE, "times", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"), kind.alias("kind")
    )
    small = small.groupBy(*PLACE, "blank", "cut", "kind").agg(F.sum("times").alias("times"))
    small = store.table("small", small)
    again = small.where("not blank").groupBy("no_conv", "conv", "said").agg(
        F.min(F.struct(~F.col("no_turn"), "at_turn")).alias("first"), F.count("*").alias("turns")
    )
    again = again.where("turns > 1").select("no_conv", "conv", "said", "first")
    small = lookup_join(small, again, ["no_conv", "conv", "said"], ["at_turn"])
    seen = F.coalesce(F.col("first") != F.struct(~F.col("no_turn"), "at_turn"), F.lit(False))
    fault = F.when(F.col("blank"), 0).when(seen, 1).when(F.col("cut"), 2)
    cut = F.col("cut").cast("int")
    out = small.select(*PLACE, "times", (2 * F.col("kind") + cut).cast("int").alias("symbol"), fault.cast("int").alias("fault"))
    order = [F.desc("no_conv"), "conv", F.desc("no_turn"), "at_turn", "said"]
    out = out.repartitionByRange(partitions(turns.sparkSession), *order).sortWithinPartitions(*order)
    return store.table("ordered", out.withColumn("place", F.monotonically_increasing_id()))


SOLVED = "chunk long, place long, no_conv boolean, conv long, symbol int, edits string"
RUN = ["chunk", "no_conv", "conv"]


def _solved(ordered: DataFrame, store: Storage) -> DataFrame:
    """(place, edits) of every turn that does not have to go."""
    n = partitions(ordered.sparkSession)
    open_ = ordered.where("fault is null or fault = 2").select(
        F.shiftright("place", CHUNK_BITS).alias("chunk"), "place", "no_conv", "conv", "symbol"
    )
    names = [c.split()[0] for c in SOLVED.split(", ")]

    def chunks(rows: DataFrame) -> DataFrame:
        return rows.repartition(n, "chunk").sortWithinPartitions("chunk", "place")

    def runs_of(held: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        starts = np.flatnonzero(starts_of(held, RUN))
        lengths = np.diff(np.append(starts, held.num_rows))
        return starts, lengths, held.column("symbol").to_numpy(), held.column("chunk").to_numpy()[starts]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edits of conversations that touch no chunk's border; those of the others are null."""
        strings = np.array(tables().strings, dtype=object)
        for held in whole_runs(batches, ["chunk"]):
            starts, lengths, symbols, chunk = runs_of(held)
            zero = np.zeros(len(starts), dtype=np.int16)
            edits = strings[repair(symbols, lengths, zero, zero)[0]]
            border = np.ones(len(starts), dtype=bool)
            border[1:-1] = (chunk[1:-1] != chunk[:-2]) | (chunk[1:-1] != chunk[2:])
            edits[np.repeat(border, lengths)] = None
            columns = [held.column(c).combine_chunks() for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(edits, pa.string())], names=names)

    traced = store.table("traced", chunks(open_).mapInArrow(within, SOLVED))
    border = traced.where("edits is null").drop("edits")

    def summarise(batches):
        """For each run and every vector behind it: the vector before; for every state before: the state after."""
        count = len(tables().vectors)
        for held in whole_runs(batches, ["chunk"]):
            starts, lengths, symbols, chunk = runs_of(held)
            befores, afters = [], []
            for s, length in zip(starts, lengths):
                own = np.tile(symbols[s : s + length], 4 * count)
                behind, state = np.repeat(np.arange(count), 4), np.tile(np.arange(4), count)
                _, before, after = repair(own, np.full(4 * count, length), behind, state)
                befores.append(before[::4].tolist())
                afters.append(after.tolist())
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chunk), held.column("no_conv").combine_chunks().take(at), held.column("conv").combine_chunks().take(at),
                    pa.array(befores, pa.list_(pa.int32())), pa.array(afters, pa.list_(pa.int32())),
                ],
                names=[*RUN, "before", "after"],
            )

    summary = store.table("summary", chunks(border).mapInArrow(summarise, "chunk long, no_conv boolean, conv long, before array<int>, after array<int>"))

    def fold(held: pa.Table) -> pa.Table:
        """One conversation's chunks: the vector behind each from the last on, then the state before each."""
        held = held.sort_by("chunk")
        before, after = held.column("before").to_pylist(), held.column("after").to_pylist()
        behind, vector = [0] * len(before), 0
        for k in range(len(before) - 1, -1, -1):
            behind[k], vector = vector, before[k][vector]
        states, state = [], 0
        for k, v in enumerate(behind):
            states.append(state)
            state = after[k][4 * v + state]
        return held.select(RUN).append_column("behind", pa.array(behind, pa.int32())).append_column("state", pa.array(states, pa.int32()))

    folded = summary.groupBy("no_conv", "conv").applyInArrow(fold, "chunk long, no_conv boolean, conv long, behind int, state int")
    known = border.join(store.table("folded", folded), RUN)

    def across(batches):
        strings = np.array(tables().strings, dtype=object)
        for held in whole_runs(batches, ["chunk"]):
            starts, lengths, symbols, _ = runs_of(held)
            behind, state = (held.column(c).to_numpy()[starts] for c in ("behind", "state"))
            edits = strings[repair(symbols, lengths, behind, state)[0]]
            yield pa.RecordBatch.from_arrays([held.column("place").combine_chunks(), pa.array(edits, pa.string())], names=["place", "edits"])

    apart = chunks(known).mapInArrow(across, "place long, edits string")
    return traced.where("edits is not null").select("place", "edits").unionByName(apart)


REPAIRED = "conv_id long, turn long, edit string, times long, fault int, was string, role string, text string"


def repair_conversations(turns: DataFrame, store: Storage, original: DataFrame | None = None) -> DataFrame:
    """The repaired conversations, edit by edit: conv_id, turn, edit, times, fault, was, role, text.

    ``turns`` has conv_id, turn, role, text, and ``times`` where rows stand for several copies. Edits are K (kept),
    R (given the role that is due), I (an inserted turn without text, ``turn`` null) and D (deleted; ``times`` at once).
    ``fault`` is a place in FAULTS, the first fault of the turn's first copy; its other copies are duplicates. ``was`` is the role
    before, ``role`` and ``text`` are those of the repaired turn, null for deleted ones. Every conversation of ``original`` (``turns`` by default) has
    one more row first, with a null edit. Rows of a conversation are together in one partition and in order, sorted by
    turn (nulls first), then by a digest of role and text.

    Null roles and texts count as one space, a null conv_id is a conversation, and a null turn comes first.
    An empty table gives no rows. Other columns are ignored. Conversations of any length: costs are computed in chunks, and the rows
    stream in order.
    """
    store = own_store(store)
    if "times" not in turns.columns:
        turns = turns.withColumn("times", F.lit(1).cast("long"))
    turns = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.col("times").cast("long").alias("times"),
    )
    ordered = ordered_turns(turns, store)
    solved = store.table("solved", _solved(ordered, store))
    marks = ordered.join(solved, "place", "left").select(
        *PLACE, F.lit(1).alias("kind"), "times", "fault", F.coalesce("edits", F.lit("D")).alias("edits"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    nothing = {"times": F.lit(0).cast("long"), "fault": F.lit(None).cast("int"), "edits": F.lit(None).cast("string")}
    said = _placed(turns).drop("times").withColumns({"kind": F.lit(2), **nothing}).select(marks.columns)
    ids = (turns if original is None else original).select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    heads = ids.select(F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0)).alias("conv")).withColumns(
        {"no_turn": F.lit(True), "at_turn": F.lit(0).cast("long"), "said": F.lit(b""), "kind": F.lit(0), **nothing,
         "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    ).select(marks.columns)
    both = heads.unionByName(marks).unionByName(said).repartition(partitions(turns.sparkSession), "no_conv", "conv")
    both = both.sortWithinPartitions("no_conv", "conv", F.desc(F.col("kind") == 0), F.desc("no_turn"), "at_turn", "said", "kind")
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("times", pa.int64()), ("fault", pa.int32()),
                        ("was", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_conv = mark = None
        state = 0
        for batch in batches:
            out: list[tuple] = []

            def insert(out=out):
                nonlocal state
                state = DUE[state]
                out.append((open_conv, None, "I", 1, None, None, "assistant" if state == 3 else "user", ""))

            for no_conv, conv, no_turn, at_turn, _, kind, times, fault, edits, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    while state in (1, 2):
                        insert()
                    open_conv, state = None if no_conv else conv, 0
                    out.append((open_conv, None, None, 0, None, None, None, None))
                elif kind == 1:
                    mark = (None if no_turn else at_turn, times, fault, edits)
                elif mark is not None:
                    turn, times, fault, edits = mark
                    mark = None
                    for edit in edits:
                        if edit == "I":
                            insert()
                        elif edit == "D":
                            out.append((open_conv, turn, "D", times, fault, role, None, None))
                        else:
                            if edit == "K":
                                state = _after(state, INITIALS.find(role[:1]))
                                now = role
                            else:
                                state = DUE[state]
                                now = "assistant" if state == 3 else "user"
                            out.append((open_conv, turn, edit, 1, fault, role, now, text))
                            if times > 1:
                                out.append((open_conv, turn, "D", times - 1, 1, role, None, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        end: list[tuple] = []
        while state in (1, 2):
            state = DUE[state]
            end.append((open_conv, None, "I", 1, None, None, "assistant" if state == 3 else "user", ""))
        if end:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*end), schema.types)], schema=schema)

    return both.mapInArrow(merge, REPAIRED)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``: counts of faults, cost, edits and a digest of what is left.

    ``repaired`` has to come from there as it is: rows are read in its order, and a text is hashed as it passes.
    """
    import hashlib

    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def closed(c: dict) -> tuple:
            gaps = c["last"] - c["low"] + 1 - c["turns"] if c["turns"] else 0
            return (c["conv"], gaps, *c["faults"], c["illegal"], c["cost"], "".join(c["audit"]), c["hash"].hexdigest())

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            out = []
            for conv, turn, edit, times, fault, was, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if edit is None:
                    if now is not None:
                        out.append(closed(now))
                    now = {"conv": conv, "turns": 0, "low": None, "last": None, "faults": [0, 0, 0], "illegal": 0, "cost": 0,
                           "audit": [], "hash": hashlib.sha256(), "lines": 0, "initial": None}
                    continue
                now["audit"].append(edit * times)
                now["cost"] += {"K": 0, "R": REROLE, "D": DELETE * times, "I": INSERT}[edit]
                if edit != "D":
                    now["cost"] += TRUNCATED if fault == 2 else 0
                    now["hash"].update(f"{chr(10) if now['lines'] else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    now["lines"] += 1
                if edit == "I":
                    continue
                # copies after the first of a row that is not blank are duplicates
                every = times if fault in (0, 1) else 1
                if fault is not None:
                    now["faults"][fault] += every
                now["faults"][1] += times - every
                if now["initial"] is not None and now["initial"] + was[:1] not in ("su", "ua", "au"):
                    now["illegal"] += 1
                now["illegal"] += times - 1
                now["initial"] = was[:1]
                if turn is not None and turn != now["last"]:
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["last"], now["turns"] = turn, now["turns"] + 1
            if out:
                yield batch_of(out)
        if now is not None:
            yield batch_of([closed(now)])

    return repaired.mapInArrow(
        run,
        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string",
    )
