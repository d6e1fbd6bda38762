import hashlib
import heapq
import itertools
import re
import zlib

import numpy as np
import pytest

from demandcast.llm import conversations as C
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import SF_DIR

SCHEMA = "conv_id long, turn long, role string, text string, place long, fault string, kind string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_text, turn_text = (" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        rule = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        if rule == 0:
            continue
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        out += [(conv, turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    return out


def faults_of(turns):
    seen, out = set(), []
    for _, role, text in turns:
        held = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not held else "d" if (role, text) in seen else "t" if held[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns, faults):
    """Least cost and least string of edits by Dijkstra over (turn, state), strings ordered as the cost ties."""
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, n, last = heapq.heappop(queue)
        if n == len(turns) and last in ("", "a"):
            return cost, audit
        if (n, last) in done:
            continue
        done.add((n, last))
        heapq.heappush(queue, (cost + 2, audit + "I", n, due[last]))
        if n < len(turns):
            heapq.heappush(queue, (cost + 3, audit + "D", n + 1, last))
            if faults[n] not in ("b", "d"):
                more, initial = faults[n] == "t", turns[n][1][:1]
                if initial and (initial == due[last] or (initial == "s" and last == "")):
                    heapq.heappush(queue, (cost + more, audit + "K", n + 1, initial))
                heapq.heappush(queue, (cost + 2 + more, audit + "R", n + 1, due[last]))


def by_hand(rows, damaged=True):
    held = {}
    for conv, turn, role, text in spoil(rows) if damaged else rows:
        held.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(held.get(conv, []), key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
        faults = faults_of(turns)
        cost, audit = cheapest(turns, faults)
        lines, n, initials = [], 0, ""
        for edit in audit:
            role = "assistant" if initials[-1:] == "u" else "user"
            if edit == "I":
                lines.append(f"{role}:")
                initials += role[0]
                continue
            if edit != "D":
                role = turns[n][1] if edit == "K" else role
                lines.append(f"{role}:{turns[n][2]}")
                initials += role[0]
            n += 1
        assert LEGAL.match(initials) and n == len(turns)
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(turns)]
        out.append((conv, gaps, *[faults.count(f) for f in "bdt"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def random_rows(seed, conversations, turns):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "cut off", "", "  \n", "Why? \t", None, "one two.", "long " * 50, "é. ü"]
    rows = []
    for c in range(conversations):
        for t in range(int(rng.integers(1, turns))):
            turn = None if rng.random() < 0.05 else t + int(rng.integers(0, 2))
            role = roles[rng.choice(7, p=[0.38, 0.38, 0.1, 0.06, 0.03, 0.03, 0.02])]
            text = texts[rng.integers(0, 10)] if rng.random() < 0.5 else f"text {t}{rng.choice(['.', '', '!'])}"
            rows.append((None if c == 3 else c - 1, turn, role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "f", "k") for r in rows], SCHEMA).repartition(3)


def test_query_against_a_shortest_path(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_conversations"](spark, SF_DIR)) == by_hand(rows)


@pytest.mark.parametrize("bits", [12, 2, 1])
def test_awkward_conversations(spark, store, monkeypatch, bits):
    """Chunks of a few turns cut nearly every conversation."""
    monkeypatch.setattr(C, "CHUNK_BITS", bits)
    rows = random_rows(bits, 40, 30) + [(500, n, "user", "Same.") for n in range(25)] + [(501, 1, "assistant", "Same.")] * 30
    table = frame(spark, rows)
    assert got(C.conversation_digests(C.repair_conversations(C.damage(table), store, table))) == by_hand(rows)
    assert got(C.conversation_digests(C.repair_conversations(table, store))) == by_hand(rows, damaged=False)


def test_repaired_turns(spark, store):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "So?"), (1, 2, "user", "So?")]
    held = C.repair_conversations(frame(spark, rows), store).collect()
    assert [(r.edit, r.turn, r.was, r.role, r.text) for r in held] == [
        (None, None, None, None, None),
        ("I", None, None, "user", ""),
        ("K", 0, "assistant", "assistant", "Hi."),
        ("K", 1, "user", "user", "So?"),
        ("D", 2, "user", None, None),
        ("I", None, None, "assistant", ""),
    ]


def test_no_conversations(spark, store):
    none = spark.createDataFrame([], SCHEMA)
    assert C.conversation_digests(C.repair_conversations(C.damage(none), store, none)).count() == 0


def test_tables_agree_with_single_turns():
    t, rng = C.tables(), np.random.default_rng(0)
    for v in range(len(t.vectors)):
        for _ in range(20):
            symbols, now = rng.integers(0, C.SYMBOLS, C.BLOCK), v
            for s in symbols[::-1]:
                now = t.before[now, s]
            assert t.block[v, int(symbols @ C.SYMBOLS ** np.arange(C.BLOCK - 1, -1, -1))] == now
