"""Likelihood of words over all their segmentations into the pieces of a vocabulary.

A word begins with the vocabulary's word mark, which only its first piece may hold. Pieces that
begin a word and pieces (or single bytes) that go on share one distribution, so the words'
probabilities sum to at most 1. Sums run in log space; many words of one length go together.
"""

from __future__ import annotations

import copy
import math
from array import array
from dataclasses import dataclass, field

import numpy as np

MARK = "▁"
#: Stands for the mark inside a word, so that no piece matches there.
NO_MATCH = 0x1FFFFF
CELLS_AT_ONCE = 200_000
LONG_WORD = 256
HASH_BITS = 19
MIX = np.uint64(0x9E3779B97F4A7C15)


def read_vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """Pieces, the 256 bytes first, with starting weights from the vocabulary's own scores.

    The scores of a byte-pair vocabulary are the negative rank of the merge. A piece of rank r
    weighs 1 / (r + 100); bytes and single characters weigh as the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, weights = [f"<0x{b:02X}>" for b in range(256)], [1.0 / (model.get_piece_size() + 100)] * 256
    for n in range(model.get_piece_size()):
        piece, score = model.id_to_piece(n), model.get_score(n)
        if model.is_byte(n) or model.is_control(n) or model.is_unknown(n) or MARK in piece[1:]:
            continue
        pieces.append(piece)
        weights.append(1.0 / (max(0.0, -score) + 100))
    return pieces, np.array(weights) / sum(weights)


@dataclass
class Lattice:
    """A vocabulary as a trie, with the logarithm of each piece's probability in each of some classes.

    ``logp`` has a row per class. Words get one probability per class; the walk through the trie is shared.
    """

    pieces: list[str]
    logp: np.ndarray
    step: dict[int, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        ends: dict[int, int] = {}
        count = 1
        for n, piece in enumerate(self.pieces[256:], start=256):
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                if key not in self.step:
                    self.step[key] = count
                    count += 1
                node = self.step[key]
            ends[node] = n
        self.piece_of = np.full(count, -1, dtype=np.int64)
        self.piece_of[list(ends)] = list(ends.values())
        self.keys = np.full(1 << HASH_BITS, -1, dtype=np.int64)
        self.values = np.full(1 << HASH_BITS, -1, dtype=np.int64)
        for key, value in self.step.items():
            at = int(self._slot(np.array([key], dtype=np.int64))[0])
            while self.keys[at] >= 0:
                at = (at + 1) % len(self.keys)
            self.keys[at], self.values[at] = key, value

    def of_class(self, k: int) -> Lattice:
        """One class alone, over the same trie."""
        own = copy.copy(self)
        own.logp = self.logp[k : k + 1]
        return own

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - HASH_BITS)).astype(np.int64)

    def _next(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Nodes after one more character, -1 where there is none."""
        keys = nodes << 21 | codes
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        rest = np.flatnonzero((found != keys) & (found >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(self.keys)
            found = self.keys[at[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (found >= 0)]
        return out

    def _bytes_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Per character its number among the distinct ones; by class their log probability in bytes; those bytes."""
        distinct, at = np.unique(codes, return_inverse=True)
        spelled = [list((MARK if c == NO_MATCH else chr(c)).encode("utf-8")) for c in distinct.tolist()]
        return at.reshape(codes.shape), np.array([self.logp[:, b].sum(axis=1) for b in spelled]).T, spelled

    def run(self, words: list[str], counts: np.ndarray | None = None) -> np.ndarray:
        """Natural log probabilities, a row per class and a column per word.

        With a single class, adds the expected uses of each piece to ``counts``.
        """
        out = np.zeros((len(self.logp), len(words)))
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            length = int(lengths[order[at]])
            if length >= LONG_WORD:
                for n in order[at:].tolist():
                    out[:, n] = [self._long(words[n], logp, counts) for logp in self.logp]
                break
            end = int(np.searchsorted(lengths[order], length, side="right"))
            for low in range(at, end, max(1, CELLS_AT_ONCE // (length + 1))):
                some = order[low : min(end, low + max(1, CELLS_AT_ONCE // (length + 1)))]
                out[:, some] = self._equal([words[n] for n in some.tolist()], counts)
            at = end
        return out

    def _equal(self, words: list[str], counts: np.ndarray | None) -> np.ndarray:
        n, size = len(words), len(words[0]) + 1
        codes = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), dtype="<u4").reshape(n, size).astype(np.int64)
        inner = codes[:, 1:]
        inner[inner == ord(MARK)] = NO_MATCH
        char, by_bytes, spelled = self._bytes_of(inner) if size > 1 else (inner, np.zeros((len(self.logp), 0)), [])
        alpha = np.full((size + 1, len(self.logp), n), -np.inf)
        alpha[0] = 0.0
        edges = []
        every = np.arange(n)
        for i in range(size):
            if i:
                alpha[i + 1] = np.logaddexp(alpha[i + 1], alpha[i] + by_bytes[:, char[:, i - 1]])
            rows, nodes = every, np.zeros(n, dtype=np.int64)
            for j in range(i, size):
                nodes = self._next(nodes, codes[rows, j])
                keep = nodes >= 0
                rows, nodes = rows[keep], nodes[keep]
                if not len(rows):
                    break
                piece = self.piece_of[nodes]
                whole = piece >= 0
                if whole.any():
                    own, used = (rows, piece) if whole.all() else (rows[whole], piece[whole])
                    alpha[j + 1][:, own] = np.logaddexp(alpha[j + 1][:, own], alpha[i][:, own] + self.logp[:, used])
                    if counts is not None:
                        edges.append((i, j + 1, own, used))
        if counts is not None:
            self._count(alpha[:, 0], edges, char, by_bytes[0], spelled, counts)
        return alpha[size]

    def _count(self, alpha, edges, char, by_bytes, spelled, counts) -> None:
        beta = np.full(alpha.shape, -np.inf)
        last = len(alpha) - 1
        beta[last] = 0.0
        total, logp = alpha[last], self.logp[0]
        by_start: dict[int, list] = {}
        for edge in edges:
            by_start.setdefault(edge[0], []).append(edge)
        uses = np.zeros(len(by_bytes))
        for i in range(last - 1, -1, -1):
            if i:
                lp = by_bytes[char[:, i - 1]] + beta[i + 1]
                beta[i] = lp
                uses += np.bincount(char[:, i - 1], np.exp(alpha[i] + lp - total), len(uses))
            for _, j, rows, piece in by_start.get(i, []):
                lp = logp[piece] + beta[j][rows]
                beta[i][rows] = np.logaddexp(beta[i][rows], lp)
                counts += np.bincount(piece, np.exp(alpha[i][rows] + lp - total[rows]), len(counts))
        for k, spelling in enumerate(spelled):
            for b in spelling:
                counts[b] += uses[k]

    def _long(self, word: str, logp: np.ndarray, counts: np.ndarray | None) -> float:
        """The same for one word, in memory that grows with its length alone."""
        text = MARK + word
        codes = [ord(c) if c != MARK else NO_MATCH for c in text]
        codes[0] = ord(MARK)
        size, step, piece_of = len(codes), self.step, self.piece_of
        spelled = {c: list((MARK if c == NO_MATCH else chr(c)).encode("utf-8")) for c in set(codes)}
        by_bytes = {c: float(logp[b].sum()) for c, b in spelled.items()}

        def add(a: float, b: float) -> float:
            if a < b:
                a, b = b, a
            return a if b == -math.inf else a + math.log1p(math.exp(b - a))

        alpha = array("d", [-math.inf]) * (size + 1)
        alpha[0] = 0.0
        starts, ends, used = array("l"), array("l"), array("l")
        for i in range(size):
            if i:
                alpha[i + 1] = add(alpha[i + 1], alpha[i] + by_bytes[codes[i]])
            node, j = 0, i
            while j < size:
                node = step.get(node << 21 | codes[j], -1)
                if node < 0:
                    break
                j += 1
                piece = int(piece_of[node])
                if piece >= 0:
                    alpha[j] = add(alpha[j], alpha[i] + float(logp[piece]))
                    starts.append(i)
                    ends.append(j)
                    used.append(piece)
        total = alpha[size]
        if counts is not None:
            beta = array("d", [-math.inf]) * (size + 1)
            beta[size] = 0.0
            at = len(starts) - 1
            for i in range(size - 1, -1, -1):
                if i:
                    lp = by_bytes[codes[i]] + beta[i + 1]
                    beta[i] = add(beta[i], lp)
                    for b in spelled[codes[i]]:
                        counts[b] += math.exp(alpha[i] + lp - total)
                while at >= 0 and starts[at] == i:
                    lp = float(logp[used[at]]) + beta[ends[at]]
                    beta[i] = add(beta[i], lp)
                    counts[used[at]] += math.exp(alpha[i] + lp - total)
                    at -= 1
        return total
