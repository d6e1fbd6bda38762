import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from demandcast.llm import language_model as lm
from demandcast.llm.lattice import MARK, Lattice, read_vocabulary
from demandcast.llm.tokens import tokenizer_path
from tests.llm.conftest import AWKWARD

BYTES = [f"<0x{b:02X}>" for b in range(256)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(seed=0, classes=1):
    pieces = [*BYTES, MARK, MARK + "a", MARK + "ab", "a", "b", "c", "ab", "bc", "abc", "é"]
    p = np.random.default_rng(seed).dirichlet(np.ones(len(pieces)), classes)
    return Lattice(pieces, np.log(p))


def segmentations(lattice, word, k=0):
    """Every way to build the word, with its probability and pieces."""
    place = {p: n for n, p in enumerate(lattice.pieces)}

    def go(at):
        if at == len(word):
            yield 1.0, []
            return
        for end in range(at + 1, len(word) + 1):
            options = []
            if word[at:end] in place and place[word[at:end]] >= 256:
                options.append([place[word[at:end]]])
            if end == at + 1:
                options.append(list(word[at].encode()))
            for o in options:
                for p, rest in go(end):
                    yield math.exp(lattice.logp[k][o].sum()) * p, o + rest

    for start in (MARK, MARK + "a", MARK + "ab"):
        if (MARK + word).startswith(start):
            own = word
            word = (MARK + own)[len(start) :]
            for p, rest in go(0):
                yield math.exp(lattice.logp[k][place[start]]) * p, [place[start], *rest]
            word = own


WORDS = ["", "a", "ab", "abc", "abcabc", "é", "aéb", "xyz", "a漢b", "bbbbb", "abab"]


def test_sums_over_all_segmentations():
    lattice = small(classes=3)
    found = lattice.run(WORDS)
    for n, w in enumerate(WORDS):
        for k in range(3):
            assert found[k, n] == pytest.approx(math.log(sum(p for p, _ in segmentations(lattice, w, k))))


def test_expected_uses():
    lattice = small(1)
    counts = np.zeros(len(lattice.pieces))
    lattice.run(WORDS, counts)
    want = np.zeros_like(counts)
    for w in WORDS:
        every = list(segmentations(lattice, w))
        total = sum(p for p, _ in every)
        for p, pieces in every:
            for x in pieces:
                want[x] += p / total
    assert counts == pytest.approx(want)


def test_long_words_agree_with_short_ones(monkeypatch):
    from demandcast.llm import lattice as module

    lattice, short, long = small(2), None, None
    short = np.zeros(len(lattice.pieces))
    a = lattice.run(WORDS, short)
    monkeypatch.setattr(module, "LONG_WORD", 0)
    long = np.zeros(len(lattice.pieces))
    assert lattice.run(WORDS, long) == pytest.approx(a)
    assert long == pytest.approx(short)


def test_mark_inside_a_word_begins_nothing():
    lattice = small(3)
    by_bytes = sum(lattice.logp[0][b] for b in MARK.encode())
    assert lattice.run([MARK])[0, 0] == pytest.approx(lattice.logp[0][256] + by_bytes)


def test_vocabulary_of_the_public_model():
    pieces, weights = read_vocabulary(tokenizer_path(lm.VOCABULARY))
    assert len(pieces) == len(set(pieces)) == len(weights) and weights.sum() == pytest.approx(1.0)
    assert not any(MARK in p[1:] for p in pieces)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def test_scores_of_awkward_rows(awkward, store):
    rows = lm.score_documents(awkward, store, rounds=1).collect()
    assert len(rows) == len(AWKWARD)
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in AWKWARD]
    seen = Counter(w for (_, t), h in zip(AWKWARD, held) if not h for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    want = sorted(
        (str(i), h, len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), n,
         round(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)), 6))
        for (i, t), h in zip(AWKWARD, held)
    )
    ours = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert ours == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_chunks_do_not_change_scores(awkward, store, monkeypatch):
    one = sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lm.score_documents(awkward, store, rounds=1).collect())
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2_000)
    many = sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lm.score_documents(awkward, store, rounds=1).collect())
    assert one == many


def test_probabilities_of_known_words_and_the_rest_sum_to_one():
    totals = lm.Totals(np.array([2.0]), np.array([10.0]), np.array([3.0]), np.array([0.6]))
    uses = np.array([[5, 3]])
    known = 10 ** totals.log10(uses, np.full((1, 2), -np.inf))
    end = 10 ** totals.log10(np.array([[2]]), np.array([[-np.inf]]))
    unknown = 10 ** totals.log10(np.array([[0]]), np.array([[0.0]]))
    assert known.sum() + end.sum() + unknown.sum() == pytest.approx(1.0)


def test_empty_table_and_no_training(no_docs, make_docs, store):
    assert lm.score_documents(no_docs, store, rounds=1).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = lm.score_documents(make_docs([(held, "some words")]), store, rounds=1).collect()[0]
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0.0 and row.score < 0
