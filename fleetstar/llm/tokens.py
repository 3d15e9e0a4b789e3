"""Whole texts to token ids through the ``tokenizers`` library.

Encoding a document piece by piece is exact for the two public vocabularies
used here: neither merges across a single space or line feed that stands
between two other characters (the byte-level one starts a token with that
space and gives the line feed a token of its own, the word-level one drops
all white space), so a text is split there. A block of texts is split and its
distinct pieces are found as Arrow columns; pieces not yet known go through
the library's whole pipeline, many in one text, whose ids are parted
again where a piece must begin or end. Pieces that do not tell this by
their ids go through it one by one. Known pieces and their ids are two
bounded columns: when they are full, only those seen since the last time stay.
So memory stays bounded, frequent pieces stay known and the ids never depend
on it. Special-token strings inside a text are ordinary text. Null and empty
texts have no ids.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPLIT = re.compile(r"(?<=\S) (?=\S)")
MAX_PIECES = 500_000    # remembered pieces per worker, about 40 bytes each
MAX_PIECE_BYTES = 48    # longer pieces are encoded each time
BLOCK_BYTES = 8 << 20   # text split at once
JOINED = 1024           # pieces of one text given to the library
TEXT, IDS = pa.large_string(), pa.large_binary()
SPACES = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Byte level: white space beyond single spaces and line feeds between words.
UNEVEN = rf"[\t\x0b-\r\x1c-\x1f{SPACES}]|[ \n][ \n]|\A[ \n]|[ \n]\z"
INNER = rf"(?s)\A.+[\t-\r \x1c-\x1f{SPACES}]"
# Word level: letters make one word, marks behind them another.
LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}]+"
MARKS = r"[!-&(-/:-@\[-`{-~]"
WORD = rf"\A{LETTERS}{MARKS}*\z"
_ENCODERS: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    """Encodes texts with one vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        model = self.tokenizer.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # pieces are remembered here; the model's own cache would only be filled and missed
        self.by_word = self.tokenizer.normalizer is not None  # lower case, white space dropped
        self.line_end = b"" if self.by_word else self._whole(["a\nb"])[0][4:-4]
        # Ids that close a word, or that begin with the space or line feed before a piece.
        edge = (lambda t: t.endswith("</w>")) if self.by_word else (lambda t: t[0] in "ĠĊ")
        vocabulary = self.tokenizer.get_vocab()
        self.edges = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edges[[i for t, i in vocabulary.items() if edge(t)]] = True
        # Pieces, their ids and whether they were met again; the first, that of an empty text, always stays.
        self.known, self.ids = pa.array(["" if self.by_word else "\n"], TEXT), pa.array([self.line_end], IDS)
        self.seen = np.ones(1, bool)

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _one_by_one(self, pieces: pa.Array) -> pa.Array:
        """A piece that begins with a line feed opens a line; any other follows a space."""
        out = []
        for at in range(0, len(pieces), JOINED):
            part = pieces.slice(at, JOINED).to_pylist()
            ids = self._whole([p[1:] if p[0] == "\n" else " " + p for p in part])
            out += [self.line_end + x if p[0] == "\n" else x for p, x in zip(part, ids)]
        return pa.array(out, IDS)

    def _joined(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces without white space inside, as one text of many; parted at the ids that tell their edges."""
        out = []
        for at in range(0, len(pieces), JOINED):
            part = pieces.slice(at, JOINED)
            text = " " + " ".join(part.to_pylist())
            ids = np.array(self.tokenizer.encode_batch_fast([text.replace(" \n", "\n")], add_special_tokens=False)[0].ids, "<u4")
            found = np.flatnonzero(self.edges[ids])
            if self.by_word:
                marked = pc.match_substring_regex(part, MARKS).to_numpy(zero_copy_only=False)
                words = np.cumsum(1 + marked)
                ends = found[words - 1] + 1 if len(found) == words[-1] else None
            else:
                ends = np.append(found[1:], len(ids)) if len(found) == len(part) else None
            if ends is None:
                out.append(self._one_by_one(part))
            else:
                cuts = pa.py_buffer(np.append(0, ends).astype("<i8") * 4)
                out.append(pa.Array.from_buffers(IDS, len(part), [None, cuts, pa.py_buffer(ids)]))
        return pa.concat_arrays(out) if out else pa.array([], IDS)

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(number of pieces of each text, all pieces); at the byte level a piece that opens a line starts with its line
        feed, and the first piece of a text with one that the text does not have."""
        if self.by_word:
            lists = pc.split_pattern(pc.replace_substring_regex(texts, rf"[\t-\r{SPACES}]", " "), " ")
            return pc.list_value_length(lists).to_numpy(), lists.flatten()
        uneven = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        opened = pc.binary_join_element_wise(pa.scalar("", TEXT), pc.replace_substring(texts.filter(pa.array(~uneven)), "\n", " \n"), pa.scalar("\n", TEXT))
        lists = pc.split_pattern(opened, " ")
        if uneven.any():
            parts = [["\n" + p[0], *p[1:]] for p in map(SPLIT.split, texts.filter(pa.array(uneven)).to_pylist())]
            places = np.argsort(np.argsort(uneven, kind="stable"))
            lists = pa.concat_arrays([lists, pa.array(parts, lists.type)]).take(pa.array(places))
        return pc.list_value_length(lists).to_numpy(), lists.flatten()

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; those not yet known are encoded and the short ones remembered."""
        if len(self.known) > MAX_PIECES:
            keep = pa.array(self.seen)
            self.known, self.ids = self.known.filter(keep), self.ids.filter(keep)
            self.seen = np.arange(len(self.known)) == 0
        at = pc.index_in(pieces, value_set=self.known)
        unknown = at.is_null()
        new, unknown = pieces.filter(unknown), unknown.to_numpy(zero_copy_only=False)
        alone = (pc.invert(pc.match_substring_regex(new, WORD)) if self.by_word else pc.match_substring_regex(new, INNER)).to_numpy(zero_copy_only=False)
        order = np.argsort(alone, kind="stable")
        new, joined = new.take(pa.array(order)), len(new) - int(alone.sum())
        ids = pa.concat_arrays([self._joined(new.slice(0, joined)), self._one_by_one(new.slice(joined))])
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        self.seen[at[~unknown]] = True
        at[unknown] = len(self.known) + np.argsort(order)
        all_ids = pa.concat_arrays([self.ids, ids])
        short = pc.less_equal(pc.binary_length(new), MAX_PIECE_BYTES)
        self.known = pa.concat_arrays([self.known, new.filter(short)])
        self.ids = pa.concat_arrays([self.ids, ids.filter(short)])
        self.seen = np.append(self.seen, np.zeros(len(self.known) - len(self.seen), bool))
        return all_ids.take(pa.array(at))

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        column = texts.cast(TEXT) if isinstance(texts, pa.Array) else pa.array(texts, TEXT)
        counts, pieces = self._pieces(column.fill_null(""))
        coded = pieces.dictionary_encode()
        ids = self._learn(coded.dictionary).take(coded.indices)
        _, cuts, data = ids.buffers()
        ends = np.append(0, np.frombuffer(cuts, np.int64)[ids.offset:ids.offset + len(ids) + 1][np.cumsum(counts)])
        drop, data = len(self.line_end), memoryview(data or b"")
        return [bytes(data[a + drop:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def text_blocks(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters, so that a block's pieces stay few."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


def batch_blocks(batch: pa.RecordBatch, at: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of the text in column ``at``, so that few texts are held as strings."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
