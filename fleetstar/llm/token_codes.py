"""Token ids in directly addressable codes: random access without block decoding.

An id is split into 8-bit chunks. Level 0 holds the lowest chunk of every
id; a bit of the level's continuation bitmap says that the id goes on, and
the next level holds the next chunks of just those ids. A rank directory
(ones before each 512-bit stretch) turns a position into the position one
level up, so any single token is read in at most four steps.

A segment is one file record: whole documents in ascending order of id.
Segments are written through Spark as rows of Parquet files in the shared
folder, so any file system that Spark writes to will do and a lost executor
repeats only its own range of documents. Only text is shuffled, once, to put
documents in order; ids never are.

Edge cases: a null or empty text is just its end token; a document id that
occurs again follows the first, ordered by text hash; a null id comes first;
an empty table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .tokens import BLOCK_BYTES, batch_blocks, encoder

MAGIC = b"DAC1"
STRETCH = 512                 # bits between entries of the rank directory
SEGMENT_TOKENS = 1 << 18      # a segment closes after this many tokens
END_ID = 2
SEGMENTS = "shard int, segment int, shard_start long, n_docs long, n_tokens long, codes binary"


def pack_codes(ids: np.ndarray) -> bytes:
    """Levels of 8-bit chunks with continuation bitmaps and rank directories."""
    out, values = [], ids.astype(np.uint32)
    while True:
        low, rest = (values & 0xFF).astype(np.uint8), values >> 8
        more = rest != 0
        bits = np.packbits(np.pad(more, (0, -len(more) % STRETCH)), bitorder="little")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).reshape(-1, STRETCH // 8).sum(1))]).astype("<u4")
        out.append((low.tobytes(), bits.tobytes(), ones.tobytes()))
        values = rest[more]
        if not len(values):
            break
    head = struct.pack("<4sIB", MAGIC, len(ids), len(out))
    sizes = b"".join(struct.pack("<III", *map(len, level)) for level in out)
    return head + sizes + b"".join(part for level in out for part in level)


class Codes:
    """Reads packed ids: ``get(i)`` one token, ``slice(a, b)`` a run of them."""

    def __init__(self, data: bytes):
        magic, self.n, levels = struct.unpack_from("<4sIB", data)
        if magic != MAGIC:
            raise ValueError("not a segment of token codes")
        at, self.levels = 9 + 12 * levels, []
        for k in range(levels):
            parts = []
            for size, kind in zip(struct.unpack_from("<III", data, 9 + 12 * k), (np.uint8, np.uint8, np.dtype("<u4"))):
                parts.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at))
                at += size
            self.levels.append(parts)

    @staticmethod
    def _rank(bits: np.ndarray, ones: np.ndarray, i: int) -> int:
        """Ones before position ``i``."""
        block = i // STRETCH
        first, last = block * STRETCH // 8, i // 8
        whole = int(ones[block]) + int(np.bitwise_count(bits[first:last]).sum())
        return whole + ((int(bits[last]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else 0)

    def get(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (low, bits, ones) in enumerate(self.levels):
            value |= int(low[i]) << 8 * k
            if not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(bits, ones, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        out = np.zeros(stop - start, "<u4")
        where = np.arange(stop - start)
        for k, (low, bits, ones) in enumerate(self.levels):
            out[where] |= low[start:stop].astype(np.uint32) << np.uint32(8 * k)
            more = np.unpackbits(bits[start // 8:-(-stop // 8)], bitorder="little")[start % 8:start % 8 + stop - start]
            where = where[more.astype(bool)]
            if not len(where):
                break
            start = self._rank(bits, ones, start)
            stop = start + len(where)
        return out


def pack_segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """Document ids and ends, then the codes of all their tokens."""
    ends = np.cumsum([len(x) // 4 for x in ids]).astype("<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    docs = np.array([d or 0 for d in doc_ids], "<i8")
    return (struct.pack("<I", len(doc_ids)) + docs.tobytes() + known.tobytes() + ends.tobytes()
            + pack_codes(np.frombuffer(b"".join(ids), "<u4")))


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, Codes]:
    (n,) = struct.unpack_from("<I", data)
    docs = np.frombuffer(data, "<i8", n, 4)
    known = np.frombuffer(data, np.uint8, n, 4 + 8 * n)
    ends = np.frombuffer(data, "<u8", n, 4 + 9 * n)
    return [int(d) if k else None for d, k in zip(docs, known)], ends.astype(np.int64), Codes(data[4 + 17 * n:])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID, shards: int | None = None,
                 segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Encode, order by document id and write; returns the segment table as read back.

    ``shards`` (one per write task) defaults to the session's shuffle partitions.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = end_id.to_bytes(4, "little")
    schema = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("shard_start", pa.int64()),
                        ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("codes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        number, start, held, size = 0, 0, ([], []), 0

        def close() -> pa.RecordBatch:
            row = (shard, number, start, len(held[0]), size, pack_segment(*held))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for block in batch_blocks(batch, 1, BLOCK_BYTES):
                for doc, ids in zip(block.column(0).to_pylist(), enc.encode(block.column(1))):
                    held[0].append(doc)
                    held[1].append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= segment_tokens:
                        yield close()
                        number, start, held, size = number + 1, start + size, ([], []), 0
        if held[0]:
            yield close()

    ordered = (docs.select("doc_id", "text")
               .repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    return materialise(ordered.mapInArrow(run, SEGMENTS), "token-codes")


def read_tokens(segments: DataFrame) -> DataFrame:
    """One row per document read back from the files: doc_id, start (tokens before it), n_tokens, ids_crc32.

    Shard starts come from one row per shard (at most the number of write
    tasks), which bounds both the running sum and the broadcast.
    """
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    starts = totals.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("before"))
    schema = pa.schema([("shard", pa.int32()), ("in_shard", pa.int64()), ("doc_id", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, shard_start, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                docs, ends, codes = read_segment(data)
                begins = np.concatenate([[0], ends[:-1]])
                crcs = [zlib.crc32(codes.slice(int(a), int(b)).tobytes()) for a, b in zip(begins, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), shard), pa.int32()), pa.array(begins + shard_start, pa.int64()),
                     pa.array(docs, pa.int64()), pa.array(ends - begins, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    rows = (segments.select("shard", "shard_start", "codes")
            .mapInArrow(run, "shard int, in_shard long, doc_id long, n_tokens long, ids_crc32 long"))
    return (rows.join(F.broadcast(starts), "shard")
            .select("doc_id", (F.col("in_shard") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def token(segments: DataFrame, position: int) -> int:
    """The single token at a global position, read without decoding its neighbours."""
    totals = segments.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")
    at = F.col("shard_start") + F.col("before")
    row = (segments.join(F.broadcast(totals.select("shard", before.alias("before"))), "shard")
           .where((at <= position) & (F.lit(position) < at + F.col("n_tokens"))).select(at.alias("at"), "codes").first())
    if row is None:
        raise IndexError(position)
    return read_segment(bytes(row["codes"]))[2].get(position - row["at"])

