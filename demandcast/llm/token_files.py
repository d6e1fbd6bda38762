"""Token ids in fixed-width bit-packed files.

A file holds the documents of one range of ids, in ascending order:

    payload   blocks of ``BLOCK`` ids (the last may be shorter), each id in ``bits`` bits, lowest bit first
    documents per document: id, whether it is null, number of ids in the file before it (int64, uint8, int64)
    offsets   byte offset of each block, and of the end of the payload (int64)
    trailer   ``TRAILER``: magic, bits, ids in a block, documents, ids, blocks

All numbers are little-endian. ``bits`` is the fewest that hold the largest id, so a block's place
is known and a block unpacks with a few numpy operations; a document is read by seeking to the
blocks that hold it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandcast.llm.common import partitions, whole_text
from demandcast.llm.tokens import encoder, vocabulary_size

MAGIC = b"TOKBITS1"
TRAILER = struct.Struct("<8sIIQQQ")
BLOCK = 1 << 16
TEXTS_AT_ONCE = 2_000
ROWS_OUT = 20_000
MANIFEST = "file string, part int, documents long, ids long"


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (uint32) in ``bits`` bits each, the last byte filled with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    low_first = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(low_first[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The inverse of ``pack``: ``count`` ids as uint32."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count).astype("<u4")
    first = np.arange(count, dtype=np.int64) * bits
    held = np.concatenate([np.frombuffer(data, dtype=np.uint8), np.zeros(5, dtype=np.uint8)])
    value = np.zeros(count, dtype=np.uint64)
    for k in range(5):
        value |= held[(first >> 3) + k].astype(np.uint64) << np.uint64(8 * k)
    return ((value >> (first & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype("<u4")


class Writer:
    """Writes one file under another name and moves it into place when it is whole.

    A task that runs twice writes the same bytes, so whichever attempt comes last does no harm.
    """

    def __init__(self, path: str, bits: int):
        self.system, self.path = fs.FileSystem.from_uri(path)
        self.partial = f"{self.path}.{uuid.uuid4().hex}"
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.system.open_output_stream(self.partial)
        self.bits, self.count, self.at = bits, 0, 0
        self.rest = np.zeros(0, dtype="<u4")
        self.ids: list[int] = []
        self.nulls: list[bool] = []
        self.starts: list[int] = []
        self.offsets = [0]

    def _block(self, ids: np.ndarray) -> None:
        self.at += self.out.write(pack(ids, self.bits))
        self.offsets.append(self.at)

    def add(self, doc_ids: list[int | None], each: list[np.ndarray]) -> None:
        """Documents with their ids."""
        for doc_id, ids in zip(doc_ids, each):
            self.ids.append(doc_id or 0)
            self.nulls.append(doc_id is None)
            self.starts.append(self.count)
            self.count += len(ids)
        held = np.concatenate([self.rest, *each])
        whole = len(held) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._block(held[at : at + BLOCK])
        self.rest = held[whole:]

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        self.out.write(np.array(self.ids, dtype="<i8").tobytes())
        self.out.write(np.array(self.nulls, dtype=np.uint8).tobytes())
        self.out.write(np.array(self.starts, dtype="<i8").tobytes())
        self.out.write(np.array(self.offsets, dtype="<i8").tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, BLOCK, len(self.ids), self.count, len(self.offsets) - 1))
        self.out.close()
        self.system.move(self.partial, self.path)


class Reader:
    """Random access to one file; only its index is held in memory."""

    def __init__(self, path: str):
        system, inner = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(inner)
        end = self.file.size() - TRAILER.size
        magic, self.bits, self.block, documents, self.count, blocks = TRAILER.unpack(self.file.read_at(TRAILER.size, end))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        index = self.file.read_at(17 * documents + 8 * (blocks + 1), end - 17 * documents - 8 * (blocks + 1))
        self.ids = np.frombuffer(index, dtype="<i8", count=documents)
        self.nulls = np.frombuffer(index, dtype=np.uint8, count=documents, offset=8 * documents)
        self.starts = np.frombuffer(index, dtype="<i8", count=documents, offset=9 * documents)
        self.offsets = np.frombuffer(index, dtype="<i8", count=blocks + 1, offset=17 * documents)
        self.ends = np.append(self.starts[1:], self.count)

    def read_block(self, n: int) -> np.ndarray:
        start, end = int(self.offsets[n]), int(self.offsets[n + 1])
        count = min(self.block, self.count - n * self.block)
        return unpack(self.file.read_at(end - start, start), self.bits, count)

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        """(document's place in the file, some of its ids), each block read once, in order."""
        for n in range(len(self.offsets) - 1):
            low = n * self.block
            held = self.read_block(n)
            first = int(np.searchsorted(self.ends, low, side="right"))
            for at in range(first, len(self.ids)):
                a, b = max(int(self.starts[at]), low), min(int(self.ends[at]), low + len(held))
                if a >= low + len(held):
                    break
                if b > a:
                    yield at, held[a - low : b - low]

    def document(self, at: int) -> np.ndarray:
        """All ids of the document at one place, from its blocks alone."""
        a, b = int(self.starts[at]), int(self.ends[at])
        if a == b:
            return np.zeros(0, dtype="<u4")
        first, last = a // self.block, (b - 1) // self.block
        held = np.concatenate([self.read_block(n) for n in range(first, last + 1)])
        return held[a - first * self.block : b - first * self.block]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, spaces: bool = True, end_id: int | None = 0, files: int | None = None
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write one file per range of ids; returns the files.

    Null texts count as empty, null ids come first, rows of one id are ordered by text. Columns
    other than the two are ignored. An empty table gives files without documents, or none.
    ``folder`` has to be one that all executors and the driver reach.
    """
    bits = bits_for(vocabulary_size(tokenizer))
    tail = np.array([] if end_id is None else [end_id], dtype="<u4").tobytes()

    def write(batches):
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:08d}.tok"
        out, encode = Writer(name, bits), encoder(tokenizer, spaces).encode
        for batch in batches:
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                each = [np.frombuffer(x + tail, dtype="<u4") for x in encode(some.column(1).to_pylist())]
                out.add(some.column(0).to_pylist(), each)
        out.close()
        yield pa.RecordBatch.from_pylist(
            [{"file": name, "part": part, "documents": len(out.ids), "ids": out.count}],
            schema=pa.schema([("file", pa.string()), ("part", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64())]),
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    ordered = rows.repartitionByRange(files or partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(write, MANIFEST)


def read_token_files(files: DataFrame) -> DataFrame:
    """One row per document of ``files`` as (doc_id, part, at, start, ids): ids as little-endian uint32.

    ``start`` counts the ids of all documents before it, over all files.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
    )

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                reader, rows, size = Reader(row["file"]), [], 0

                def row_of(at, ids, reader=reader, row=row):
                    return {
                        "doc_id": None if reader.nulls[at] else int(reader.ids[at]),
                        "part": row["part"],
                        "at": at,
                        "start": row["before"] + int(reader.starts[at]),
                        "ids": ids,
                    }

                done, held = 0, []
                for at, ids in reader.parts():
                    for whole in range(done, at):
                        rows.append(row_of(whole, b"".join(held)))
                        held = []
                    done = at
                    held.append(ids.tobytes())
                    size += len(held[-1])
                    if len(rows) >= ROWS_OUT or size >= 32 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                for whole in range(done, len(reader.ids)):
                    rows.append(row_of(whole, b"".join(held)))
                    held = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return placed.repartitionByRange(partitions(files.sparkSession), "part").mapInArrow(
        read, "doc_id long, part int, at long, start long, ids binary"
    )


def checksum(ids: bytes) -> int:
    return zlib.crc32(ids)
