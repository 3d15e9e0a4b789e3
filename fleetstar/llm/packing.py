"""Best-fit packing of tokenised documents into fixed-length sequences.

Bounded-space online best fit: each packer keeps at most ``open_bins`` bins
open, indexed by a bitset whose bit ``f`` says that some open bin has ``f``
free tokens. A piece goes to the open bin with the least free space that
still holds it (the lowest set bit at or above its length); if none does, a
new bin opens, and when too many are open the fullest closes first. Pieces
arrive in an order of hashes; a packer looks ahead at ``LOOKAHEAD`` of them and
places the longest first, then sees the next ones, so it holds no more than
these pieces and its open bins.

Documents longer than a sequence are cut into whole sequences plus one
shorter first piece. Whole-sequence pieces need no search and get a sequence
each without leaving their scan task; only the short pieces' lengths (never
their tokens) are shuffled, into groups of a bounded number of rows, one
packer per group, which streams through its group.

Edge cases: a null or empty text is just its end token; repeated rows are
packed once each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokens import BLOCK_BYTES, batch_blocks, encoder

SEQUENCE = 1024          # tokens of a sequence
END_ID = 2               # closes each document
OPEN_BINS = 2048         # open bins of one packer
LOOKAHEAD = 2048         # pieces that a packer sees at once
GROUP_ROWS = 60_000      # short pieces per packer
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row_key long"


class BestFit:
    """One packer: ``place(length)`` gives the piece's (bin number, offset)."""

    def __init__(self, capacity: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits = 0                                  # bit f: an open bin has f free tokens
        self.bins: dict[int, list[int]] = {}           # free tokens -> open bins
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            del self.bins[free]
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if free:
            self.bins.setdefault(free, []).append(number)
            self.bits |= 1 << free
            self.n_open += 1

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            free, number = self.capacity, self.n_bins
            self.n_bins += 1
            if self.n_open >= self.open_bins:          # the fullest closes first
                self._take((self.bits & -self.bits).bit_length() - 1)
        self._put(number, free - length)
        return number, self.capacity - free


def place_all(packer: BestFit, lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """(bin numbers, offsets) of pieces seen at once, placed longest first."""
    numbers, offsets = [0] * len(lengths), [0] * len(lengths)
    for i in np.argsort(-lengths, kind="stable").tolist():
        numbers[i], offsets[i] = packer.place(int(lengths[i]))
    return numbers, offsets


def cut(total: int, capacity: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: a shorter first one, then whole sequences."""
    head = total % capacity or min(total, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, total, capacity)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: its place in the document, length and checksum."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for block in batch_blocks(batch, 1, BLOCK_BYTES):
                ids_of, keys = (block.column(i).to_pylist() for i in (0, 2))
                rows = []
                for doc, key, ids in zip(ids_of, keys, enc.encode(block.column(1))):
                    ids = memoryview(ids + end)
                    for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                        rows.append((doc, n, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), key))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)

    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row_key")).mapInArrow(run, PIECES)


ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("row_key", pa.int64())])
PLACED = ARROW.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))


def pack(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID,
         open_bins: int = OPEN_BINS, group_rows: int = GROUP_ROWS, lookahead: int = LOOKAHEAD) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; sequences are at most ``capacity`` tokens.

    Pieces are written to the shared folder once, so texts are tokenised once
    and a lost executor repeats only the packing.
    """
    cut_up = materialise(pieces(docs, tokenizer, capacity, end_id), "pieces")
    short = cut_up.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_rows))
    spread = short.withColumn("packer", F.pmod(F.xxhash64("row_key", "piece"), F.lit(groups)).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, packer, held, size = None, None, [], 0

        def place(rows: pa.Table) -> pa.RecordBatch:
            numbers, offsets = place_all(packer, rows["length"].to_numpy())
            columns = [rows[f.name].combine_chunks() for f in ARROW]
            ids = (np.int64(current) << 40) | np.array(numbers, np.int64)
            return pa.RecordBatch.from_arrays([*columns, pa.array(ids), pa.array(offsets, pa.int64())], schema=PLACED)

        for batch in batches:
            key = batch.column(batch.schema.get_field_index("packer")).to_numpy()
            cuts = np.flatnonzero(np.diff(key)) + 1
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(key)).tolist()):
                if a < b and key[a] != current:
                    if held:
                        yield place(pa.Table.from_batches(held))
                    current, packer, held, size = key[a], BestFit(capacity, open_bins), [], 0
                while a < b:
                    stop = min(b, a + lookahead - size)
                    held.append(batch.slice(a, stop - a))
                    size, a = size + stop - a, stop
                    if size == lookahead:
                        yield place(pa.Table.from_batches(held))
                        held, size = [], 0
        if held:
            yield place(pa.Table.from_batches(held))

    arriving = spread.repartition("packer").sortWithinPartitions("packer", F.xxhash64("piece", "row_key"), "row_key", "piece")
    packed = arriving.mapInArrow(run, f"{PIECES}, sequence_id long, offset long")
    whole = (cut_up.where(F.col("length") == capacity)
             .withColumn("sequence_id", -1 - F.monotonically_increasing_id())
             .withColumn("offset", F.lit(0).cast("long")))
    return packed.unionByName(whole).drop("row_key")
