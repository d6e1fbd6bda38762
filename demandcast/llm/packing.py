"""Best-fit packing of token sequences by a configuration linear program over the length histogram.

Documents are cut into pieces of at most ``capacity`` tokens. Only the number of pieces of each
length matters for packing them, so the program has one constraint per length, however many
documents there are. A configuration is a set of lengths that fit in one sequence. In each phase a
knapsack dynamic program prices configurations under the lengths' weights; for every length the best
one that holds it is used a little if it is near the best of all, and the weights of lengths fall
exponentially with how far they are covered. When all lengths are covered a round ends; the next
starts from the weights of the best dual bound so far, with finer steps. It ends within a stated gap
to that bound or after a stated amount of work. The fractional counts are rounded down, and the
pieces that this leaves are placed by best fit. Pieces are then numbered within their length, and a
lookup in the table of configurations gives each its sequence and place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import own_store, partitions, whole_text, with_row_id
from demandcast.llm.tokens import KEEP_CHUNKS, encoder
from demandcast.sources.storage import Storage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: How far the number of sequences of a fractional solution may be above the bound, as a share of the bound.
GAP = 0.01
#: Phases a length, and phases times lengths, at most. What is not solved to the gap by then is rounded like any other solution.
PHASES, WORK = 25, 800_000
#: How fast weights fall with coverage in the first round, what one phase changes in their exponent, and growth by round.
RATE, CHANGE, FASTER = 60.0, 0.5, 1.6
#: Phases between two looks at the bound of the mean weights.
LOOK = 20
#: Shares of the program's solution that are tried.
SHARES = (1.0, 0.75, 0.5, 0.25)
TEXTS_AT_ONCE = 2_000


class Knapsack:
    """Configurations of largest weight for every room up to ``capacity``, by unbounded knapsack."""

    def __init__(self, weights: np.ndarray, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.best = best = np.zeros(capacity + 1)
        self.pick = np.full(capacity + 1, -1, dtype=np.int64)
        fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
        for c in range(int(lengths[0]), capacity + 1):
            k = fitting[c]
            value = weights[:k] + best[c - lengths[:k]]
            at = int(value.argmax())
            best[c] = best[c - 1]
            if value[at] > best[c]:
                best[c], self.pick[c] = value[at], at

    def trace(self, room: int) -> Counter[int]:
        """Places of the lengths in the best configuration for this room."""
        found: Counter[int] = Counter()
        while room > 0:
            at = int(self.pick[room])
            if at < 0:
                room -= 1
                continue
            found[at] += 1
            room -= int(self.lengths[at])
        return found


def price(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of largest weight: length -> copies."""
    return {int(lengths[i]): k for i, k in Knapsack(weights, lengths, capacity).trace(capacity).items()}


def solve_program(
    demand: dict[int, int], capacity: int, gap: float = GAP, work: int = WORK
) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Fractional solution by multiplicative weights, configurations and how often each is used, and a lower bound of any solution.

    The solution covers the demand. It uses at most 1 + ``gap`` times as many sequences as the bound, or is the best that
    ``PHASES`` phases a length or ``work`` phases times lengths have found.
    """
    lengths = np.array(sorted(demand), dtype=np.int64)
    need = np.array([demand[n] for n in lengths.tolist()], dtype=float)
    bound = float(lengths @ need) / capacity
    if not len(lengths):
        return [], 0.0
    # one configuration per length covers everything, if badly
    solution = {((i, int(capacity // n)),): need[i] / (capacity // n) for i, n in enumerate(lengths)}
    fewest = sum(solution.values())
    phases, rate, prior, dual = max(1, min(PHASES * len(lengths), work // len(lengths))), RATE, lengths / capacity, lengths / capacity
    done = 0
    while done < phases and fewest > (1 + gap) * bound:
        covered, used, mean, step = np.zeros(len(need)), {}, np.zeros(len(need)), CHANGE / rate
        low = 0.0
        while done < phases and low < 1 - 1e-9:
            done += 1
            weights = np.where(covered < need * (1 + 1e-12), prior * np.exp(-rate * (covered / need - low)), 0)
            weights /= weights @ need
            priced = Knapsack(weights, lengths, capacity)
            value = priced.best[-1]
            if 1 / value > bound:
                bound, dual = 1 / value, weights
            mean += weights
            if done % LOOK == 0:
                most = float(mean @ need) / Knapsack(mean, lengths, capacity).best[-1]
                if most > bound:
                    bound, dual = most, mean / (mean @ need)
            grown = np.zeros(len(need))
            near = weights + priced.best[capacity - lengths] >= (1 - CHANGE / 4) * value
            for n in np.argsort(covered / need):
                if not near[n] or not weights[n] or grown[n] >= 0.99 * step:
                    continue
                parts = priced.trace(capacity - int(lengths[n]))
                parts[int(n)] += 1
                times = min((step - grown[i]) * need[i] / k for i, k in parts.items())
                if times > 0:
                    key = tuple(sorted(parts.items()))
                    used[key] = used.get(key, 0.0) + times
                    for i, k in parts.items():
                        covered[i] += times * k
                        grown[i] += times * k / need[i]
            low = float((covered / need).min())
            if done % LOOK == 0 and low > 0 and sum(used.values()) / low <= (1 + gap) * bound:
                break
        if low > 0 and sum(used.values()) / low < fewest:
            fewest, solution = sum(used.values()) / low, {c: x / low for c, x in used.items()}
        prior, rate = dual, rate * FASTER
    return [({int(lengths[i]): k for i, k in c}, float(x)) for c, x in solution.items()], bound


def best_fit(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Pieces in falling order, each into the fullest sequence that has room for it; equal sequences are counted."""
    room: list[list[tuple[dict[int, int], int]]] = [[] for _ in range(capacity + 1)]
    free = np.zeros(capacity + 1, dtype=bool)

    def keep(space: int, held: dict[int, int], times: int) -> None:
        if times:
            room[space].append((held, times))
            free[space] = True

    for n in sorted(demand, reverse=True):
        left = demand[n]
        while left:
            fits = np.flatnonzero(free[n:])
            space = n + int(fits[0]) if len(fits) else capacity
            most = space // n  # a sequence stays the fullest with room until no more of them fit
            held, times = room[space].pop() if len(fits) else ({}, -(-left // most))
            free[space] = bool(room[space])
            whole = min(times, left // most)
            keep(space - most * n, {**held, n: most}, whole)
            left -= whole * most
            if whole < times and left:
                keep(space - left * n, {**held, n: left}, 1)
                whole, left = whole + 1, 0
            if len(fits):
                keep(space, held, times - whole)
    return [some for held in room for some in held]


def round_down(solution: list[tuple[dict[int, int], float]], demand: dict[int, int], share: float) -> list[tuple[dict[int, int], int]]:
    """Whole counts of the most used configurations, ``share`` of the solution, within the demand."""
    left, found = dict(demand), []
    for parts, times in sorted(solution, key=lambda x: -x[1]):
        whole = min(int(share * times + 1e-6), *(left[n] // k for n, k in parts.items()))
        if whole:
            found.append((parts, whole))
            for n, k in parts.items():
                left[n] -= k * whole
    return found


def plan(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations with whole counts that hold exactly the demand.

    The program's solution is rounded down and best fit places what that leaves. Rounding many small counts leaves awkward
    remainders, so smaller shares of the solution are tried until a plan is no worse than best fit alone; else that is taken.
    """
    full = demand.get(capacity, 0)
    found: list[tuple[dict[int, int], int]] = [({capacity: 1}, full)] if full else []
    wanted = {n: k for n, k in demand.items() if n < capacity and k}
    solution, _ = solve_program(wanted, capacity)
    plain = best_fit(wanted, capacity)
    for share in SHARES:
        rounded, left = round_down(solution, wanted, share), dict(wanted)
        for parts, times in rounded:
            for n, k in parts.items():
                left[n] -= k * times
        rounded += best_fit({n: k for n, k in left.items() if k}, capacity)
        if sum(times for _, times in rounded) <= sum(times for _, times in plain):
            return found + rounded
    return found + plain


@dataclass
class Places:
    """Where the n-th piece of a length goes: ranges of n, by length, with their sequences and offsets."""

    start: np.ndarray
    base: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(found: list[tuple[dict[int, int], int]]) -> Places:
        rows, used, sequence = [], {}, 0
        for parts, times in found:
            offset = 0
            for n, k in sorted(parts.items(), reverse=True):
                first = used.get(n, 0)
                rows.append(((n << 48) + first, sequence, k, offset))
                used[n] = first + k * times
                offset += n * k
            sequence += times
        held = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
        return Places(held[:, 0], held[:, 1], held[:, 2], held[:, 3])

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and ranks."""
        key = (length << 48) + rank
        at = np.searchsorted(self.start, key, side="right") - 1
        nth, slot = np.divmod(key - self.start[at], self.copies[at])
        return self.base[at] + nth, self.offset[at] + slot * length


PIECES = "row long, doc_id long, piece int, start long, length int, ids binary, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, spaces: bool, keep: int) -> DataFrame:
    """Token pieces of every row: ids as little-endian unsigned 16-bit integers and their crc32 as 32-bit ones."""
    import zlib

    tail = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
         ("ids", pa.binary()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaces, keep).encode
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                rows, ids, out = some.column(0).to_pylist(), some.column(1).to_pylist(), []
                for row, doc_id, found in zip(rows, ids, encode(some.column(2).to_pylist())):
                    found += tail
                    for piece, first in enumerate(range(0, len(found), 4 * capacity)):
                        own = found[first : first + 4 * capacity]
                        long = np.frombuffer(own, dtype="<u4")
                        if long.max() > 0xFFFF:
                            raise ValueError(f"{tokenizer} has ids beyond 65,535")
                        short = long.astype("<u2").tobytes()
                        out.append((row, doc_id, piece, first // 4, len(own) // 4, short, zlib.crc32(own)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), schema.types)], schema=schema
                )

    rows = with_row_id(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), "row")
    return rows.select("row", "doc_id", "text").mapInArrow(run, PIECES)


def pack_documents(
    docs: DataFrame,
    store: Storage,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = 0,
    spaces: bool = False,
    keep: int = KEEP_CHUNKS,
) -> DataFrame:
    """Every piece of every row of ``docs`` with its place: doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. Rows that
    repeat are packed as often as they occur. Only documents longer than ``capacity`` are cut. An
    empty table gives no rows. ``ids`` holds 16-bit integers, so the vocabulary may have 65,536
    ids at most. What the driver holds is one count per length and the table of configurations,
    which is bounded by ``capacity`` and not by the number of documents. ``keep`` bounds the encoded chunks
    that a worker remembers; it changes speed and memory only.
    """
    store = own_store(store)
    pieces = store.table("pieces", cut_pieces(docs, tokenizer, capacity, end_id, spaces, keep))
    demand = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places.of(plan(demand, capacity)))
    # the n-th piece of a length: counted within salted parts of it, so that a frequent length is no one task's work
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row", "piece"), F.lit(partitions(docs.sparkSession))))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("held"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "salt", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "piece")) - 1
    ranked = (
        salted.withColumn("within", within)
        .join(store.table("offsets", offsets), ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("within"))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        sequence, offset = places.value.find(length.to_numpy(dtype=np.int64), rank.to_numpy(dtype=np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("place", place(F.col("length"), F.col("rank"))).select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids",
        "ids_crc32",
        F.col("place.sequence_id").alias("sequence_id"),
        F.col("place.offset").alias("offset"),
    )
