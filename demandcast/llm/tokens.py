"""Encoding of whole texts by a public tokenizer, with each distinct chunk of text encoded once per worker.

Byte-pair tokenizers never merge across the border between a non-space and the white space after
it. Texts are therefore cut there, all texts of a batch in one column operation, and the chunks of
the batch are numbered. Only distinct chunks are looked up, and the texts' ids are gathered from
theirs by number. This gives exactly the ids of the whole text, at a small part of the time.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from demandcast.llm.common import slices

CHUNK = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
#: Two white-space characters in a row: the cut has to take the whole run.
RUN = re.compile(r"\s\s")
#: Any other white space before a cut may belong to the same run: such texts are encoded whole.
UNUSUAL = re.compile(r"[^\S \t\r\n][ \t\r\n]")
#: ASCII punctuation.
PUNCTUATION = r"[!-/:-@\[-`{-~]"
ENCODE_AT_ONCE = 4096
#: Chunks that a worker keeps, at about 160 bytes each; beyond it starts anew.
KEEP_CHUNKS = 800_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers in ``bytes``.

    ``spaces`` tells whether the tokenizer keeps white space (byte level) or drops it (word level).
    """

    def __init__(self, name: str, spaces: bool, keep: int = KEEP_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.tokenizer.encode_special_tokens = True
        self.spaces, self.keep = spaces, keep
        self.known: dict[str, bytes] = {"": b""}

    def chunks(self, texts: list[str]) -> pa.ListArray:
        """Each text's chunks. Letters and the punctuation that ends a chunk never merge either and are cut, too."""
        if not self.spaces:
            apart = pc.replace_substring_regex(pa.array(texts, pa.large_string()), rf"(\pL)({PUNCTUATION}+)([ \t\r\n]|$)", r"\1 \2\3")
            return pc.ascii_split_whitespace(apart)
        # a single blank opens the chunk after it
        plain = [RUN.search(t) is None and "\0" not in t for t in texts]
        column = pa.array([t if p else "" for t, p in zip(texts, plain)], pa.large_string())
        marked = pc.replace_substring(pc.replace_substring(column, " ", "\0 "), "\n", "\0\n")
        apart = pc.replace_substring_regex(marked, rf"(\pL)({PUNCTUATION}+)(\x00|$)", "\\1\0\\2\\3")
        cut = pc.split_pattern(apart, "\0")
        if all(plain):
            return cut
        others = [[t] if UNUSUAL.search(t) else CHUNK.findall(t) for t, p in zip(texts, plain) if not p]
        both = pa.concat_arrays([cut, pa.array(others, cut.type)])
        place, more = np.arange(len(texts)), np.flatnonzero(~np.array(plain))
        place[more] = len(texts) + np.arange(len(more))
        return both.take(pa.array(place))

    def learn(self, new: list[str]) -> None:
        for some in slices(new, ENCODE_AT_ONCE):
            for chunk, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[chunk] = array("I", found.ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        cut = self.chunks(texts)
        coded = cut.flatten().dictionary_encode()
        if len(self.known) > self.keep:
            self.known.clear()
            self.known[""] = b""
        known, distinct = self.known, coded.dictionary.to_pylist()
        new = [c for c in distinct if c not in known]
        if self.spaces:
            self.learn(new)
        else:
            # word-level ids ignore the case
            plain = [c.lower() if c.isascii() else c for c in new]
            self.learn(list(set(plain).difference(known)))
            known.update(zip(new, map(known.__getitem__, plain)))
        held = [known[c] for c in distinct]
        ids = np.frombuffer(b"".join(held), dtype="<u4")
        size = np.fromiter(map(len, held), dtype=np.int64, count=len(held)) // 4
        first = np.cumsum(size) - size
        chunk = coded.indices.to_numpy()
        count = size[chunk]
        ends = np.cumsum(count)
        flat = ids[np.repeat(first[chunk] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        lengths = cut.value_lengths().to_numpy(zero_copy_only=False)
        text_ends = np.concatenate([[0], ends])[np.cumsum(lengths)].tolist()
        return [flat[a:b].tobytes() for a, b in zip([0, *text_ends[:-1]], text_ends)]


@cache
def encoder(name: str, spaces: bool, keep: int = KEEP_CHUNKS) -> ChunkEncoder:
    """One encoder per worker process."""
    return ChunkEncoder(name, spaces, keep)


def vocabulary_size(name: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name)).get_vocab_size()
