"""Fill-in-middle: prefix, middle and suffix of each text, cut between units, in sentinel order.

Units are runs of ASCII letters or single other code points. Each document's
units stand in an indexable skip list: an express lane holds a random quarter
of the lane below, and every link carries its width in units and in code
points. A cut at unit ``r`` descends from the top lane, going on while the
accumulated units do not pass ``r``; the accumulated code points are the cut.

Cuts, form and coins come from the sha256 of ``<seed>:<doc_id>``, so reruns
agree and rows of one id are cut by the same numbers. A text that is empty or
holds a sentinel, and a share of the others, stays plain.

Edge cases: a null text counts as empty; a null id is written as an empty
string in the hashed text; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import mix
from .tokens import text_blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90          # of 100: h3 remainders from here on leave the text plain
SPM_BELOW = 20           # of 100: h4 remainders below put the suffix first
LANE_BITS = 2            # a lane holds one of 4 nodes of the lane below
_LANES = np.zeros(0, np.uint8)


def lanes_of(n: int) -> np.ndarray:
    """How many express lanes each of the first ``n`` nodes stands in: fixed coins, the head in all."""
    global _LANES
    if n > 1 << 20:
        return _toss(n)
    if len(_LANES) < n:
        _LANES = _toss(max(n, 1 << 14))
    return _LANES[:n]


def _toss(n: int) -> np.ndarray:
    coins = mix(np.arange(n, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    lowest = coins & (~coins + np.uint64(1))
    return (np.bitwise_count(lowest - np.uint64(1)) // LANE_BITS).astype(np.uint8)


class SkipList:
    """Units of known code-point widths; ``chars_before(r)`` is the width of the first ``r`` units."""

    def __init__(self, starts: np.ndarray, total: int):
        self.n, self.total = len(starts), total
        lanes = lanes_of(self.n)
        nodes = np.arange(self.n)
        self.lanes = []                                  # (units, code points, place in the lane below), lowest first
        below = None
        while len(nodes):
            down = np.searchsorted(below, nodes) if below is not None else nodes
            self.lanes.append((np.diff(nodes, append=self.n), np.diff(starts[nodes], append=total), down))
            if len(nodes) == 1:
                break
            below = nodes
            taller = lanes[nodes] >= len(self.lanes)
            taller[0] = True
            nodes = nodes[taller]
            if len(nodes) == len(below):
                break

    def chars_before(self, rank: int) -> int:
        if rank >= self.n:
            return self.total
        units = chars = at = 0
        for width, code_points, down in reversed(self.lanes):
            while units + width[at] <= rank:
                units += int(width[at])
                chars += int(code_points[at])
                at += 1
            at = int(down[at])
        return chars


def unit_starts(text: str) -> np.ndarray:
    """First code point of every unit."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    inside = np.append(False, letter[1:] & letter[:-1]) if len(codes) else np.zeros(0, bool)
    return np.flatnonzero(~inside)


def arrange(text: str, doc_id: int | None, seed: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    starts = unit_starts(text)
    n = len(starts)
    if not text or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(starts, len(text))
    a, b = (units.chars_before(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output, one row per row of ``docs``."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            texts = texts.to_pylist()
            for a, b in text_blocks(texts):
                rows = [(d, *arrange(t or "", d, seed)) for d, t in zip(ids[a:b], texts[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    second = F.when(form == "psm", F.locate(SUFFIX, output)).otherwise(F.locate(PREFIX, output))
    last = F.locate(MIDDLE, output)
    one = F.substring(output, F.lit(4), second - 4)
    two = F.substring(output, second + 3, last - second - 3)
    middle = F.substring(output, last + 3, F.length(output))
    return (F.when(form == "psm", F.concat(one, middle, two)).when(form == "spm", F.concat(two, middle, one)).otherwise(output))
