import zlib

import numpy as np
import pytest

from demandcast.llm import token_files as tf
from demandcast.llm.queries import QUERIES
from demandcast.llm.tokens import ChunkEncoder, tokenizer_path
from tests.llm.conftest import AWKWARD, SF_DIR

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def plain(name):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path(name))
    found.encode_special_tokens = True
    return found


@pytest.mark.parametrize("bits", range(1, 33))
def test_packed_ids_come_back(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 7, 8, 1001):
        ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4")
        packed = tf.pack(ids, bits)
        assert len(packed) == (n * bits + 7) // 8
        assert np.array_equal(tf.unpack(packed, bits, n), ids)


@pytest.mark.parametrize(("vocabulary", "bits"), [(1, 1), (2, 1), (3, 2), (50_257, 16), (65_537, 17)])
def test_fewest_bits(vocabulary, bits):
    assert tf.bits_for(vocabulary) == bits


@pytest.mark.parametrize("bits", [13, 16])
def test_file_round_trip_and_random_access(tmp_path, monkeypatch, bits):
    monkeypatch.setattr(tf, "BLOCK", 64)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << bits, n).astype("<u4") for n in (0, 5, 0, 64, 500, 1, 0)]
    out = tf.Writer(str(tmp_path / "a.tok"), bits)
    out.add([3, None, 4], docs[:3])
    out.add([4, 9, 9, 10], docs[3:])
    out.close()
    back = tf.Reader(str(tmp_path / "a.tok"))
    assert back.ids.tolist() == [3, 0, 4, 4, 9, 9, 10] and back.nulls.tolist() == [0, 1, 0, 0, 0, 0, 0]
    for n, ids in enumerate(docs):
        assert np.array_equal(back.document(n), ids)
    joined = [np.concatenate([p for at, p in back.parts() if at == n] or [np.zeros(0, "<u4")]) for n in range(7)]
    assert all(np.array_equal(a, b) for a, b in zip(joined, docs))
    assert [p.name for p in tmp_path.iterdir()] == ["a.tok"]


@pytest.mark.parametrize(("name", "spaces"), [(BYTE, True), (WORD, False)])
def test_chunks_give_the_ids_of_whole_texts(name, spaces):
    texts = [t or "" for _, t in AWKWARD] + [
        "a  b", " \n a\n\n\nb ", "x  y", "x  y", "  z", "I'LL it's they're 12 345 6", "Á é", "naïve Σς ΑΣ", "\0 \0x y",
        "tab\tand\x0bvt \x1c \x85 end　", "!?!? ...a.b.c, (d)e'f", "MiXeD CaSe İstanbul", "🙂🙂 🙂", "'s 's", "under_score ___ __a",
    ]
    encode, own = plain(name), ChunkEncoder(name, spaces)
    for at in range(2):  # the second time everything is known
        for text, found in zip(texts, own.encode(texts)):
            assert np.frombuffer(found, "<u4").tolist() == encode.encode(text, add_special_tokens=False).ids, (at, text[:80])


def expected(rows):
    encode, start = plain(BYTE), 0
    for i, t in rows:
        ids = [*encode.encode(t or "", add_special_tokens=False).ids, 0]
        yield i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)


def test_files_in_id_order(awkward, store):
    files = store.table("files", tf.write_token_files(awkward, f"{store.folder}/tokens", BYTE))
    rows = tf.read_token_files(files).collect()
    ours = [(r.doc_id, r.start, len(r.ids) // 4, tf.checksum(r.ids)) for r in sorted(rows, key=lambda r: (r.part, r.at))]
    order = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    assert ours == list(expected(order))


def test_empty_table(no_docs, store):
    files = store.table("files", tf.write_token_files(no_docs, f"{store.folder}/tokens", BYTE))
    assert tf.read_token_files(files).count() == 0


def test_query_against_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = {r.doc_id: (r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_token_files"](spark, SF_DIR).collect()}
    assert [rows[d.doc_id] for d in docs] == list(expected((d.doc_id, d.text) for d in docs))
