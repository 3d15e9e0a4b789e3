"""Substring dedup: words covered by passages that also start earlier.

A window is ``words`` consecutive words of one document. Every document is cut
into segments, runs of windows that share one minimizer (the ``GRAM``-word
gram of least hash in the window), so equal windows always have one minimizer
whatever stands around them. Only segments whose minimizer occurs again are
candidates; equal segments are one member, represented by the first of them
in order of (doc_id, start) - all windows of the others start earlier there.

Members are dealt by minimizer into shards of about ``SHARD_WORDS`` words, and
a compressed FM-index is built of each: the Burrows-Wheeler transform of its
segments in order of place, as a wavelet matrix of packed bits with rank
directories. Each member is streamed through the index of its shard: backward
search from a window's end gives the matching statistic, the longest suffix
that occurs twice; one shorter than the window rules out every window that
holds it, so the search skips ahead. Of a window found twice the earliest
place is the least suffix position in its interval.

Nothing is gathered by key without a bound: equal segments of a batch leave
one row, the others are dealt by their own place; a minimizer with more than
``HOT`` different segments is split into its windows, counted by content.

Words are runs of anything but ASCII white space, compared by 64-bit hashes.
Edge cases: a null, empty or blank text has no words; rows with one id are
ordered by text hash, rows of one id and text are one document, answered once
per row; a null id comes last; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .shingles import _chain, _power_tables, mix, word_hashes

WORDS = 20
GRAM = 5
SHARD_WORDS = 400_000
HOT = 20_000
BLOCK_BYTES = 1 << 20
LAST = 2**63 - 1                       # stands for a null id
COPY, LEAD, SPLIT = 0, 1, 2            # kinds of marks


class FMIndex:
    """Counts and places of word sequences in separated texts, by backward search.

    ``text`` holds symbols from 1 up; 0 closes each segment. Rows are suffixes
    in sorted order, equal ones in order of place.
    """

    def __init__(self, text: np.ndarray, depth: int):
        self.n, self.separators = len(text), int((text == 0).sum())
        counts = np.bincount(text)
        self.starts = np.concatenate([[0], np.cumsum(counts)])       # rows of suffixes by first symbol
        self.sa = suffix_order(text, depth)
        sequence = text[self.sa - 1]                                 # the symbol before each suffix
        self.levels = []
        for bit in reversed(range(max(1, int(len(counts) - 1).bit_length()))):
            ones = (sequence >> bit) & 1 == 1
            packed = np.packbits(np.pad(ones, (0, 64 - len(ones) % 64)), bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]).astype(np.uint32)
            self.levels.append((bit, packed, before, int(self.n - ones.sum())))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        symbols = np.arange(len(counts))
        self.offsets = self.starts[:-1] - self._descend(symbols, np.zeros(len(symbols), np.int64))
        self.least: list[np.ndarray] = []

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, packed, before, zeros in self.levels:
            word = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(packed[word] & low).astype(np.int64)
            at = np.where((symbols >> bit) & 1, zeros + ones, at - ones)
        return at

    def rows(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that start with each symbol."""
        return self.starts[symbols], self.starts[symbols + 1]

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more symbol in front."""
        ends = self._descend(np.concatenate([symbols, symbols]), np.concatenate([lo, hi])).reshape(2, -1)
        return ends[0] + self.offsets[symbols], ends[1] + self.offsets[symbols]

    def earliest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least place of each interval's suffixes (a sparse table of range minima)."""
        if not self.least:
            table, step = [self.sa.astype(np.int32)], 1
            while 2 * step <= self.n:
                table.append(np.minimum(table[-1][:-step], table[-1][step:]))
                step *= 2
            self.least = table
        out = np.empty(len(lo), np.int64)
        power = np.frexp((hi - lo).astype(float))[1] - 1
        for k in np.unique(power):
            chosen = power == k
            row = self.least[k]
            out[chosen] = np.minimum(row[lo[chosen]], row[hi[chosen] - (1 << int(k))])
        return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in sorted order by prefix doubling; no segment is longer than ``depth`` symbols."""
    closing = text == 0
    rank = np.where(closing, np.cumsum(closing) - 1, text + int(closing.sum())).astype(np.int64)
    reach, order = 1, np.argsort(rank, kind="stable")
    while reach < depth + 1:
        key = rank * (len(text) + int(rank.max()) + 2)
        key[:-reach] += rank[reach:] + 1
        order = np.argsort(key)
        key = key[order]
        fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank[order] = fresh
        reach *= 2
        if fresh[-1] == len(text) - 1:
            break
    return order


def repeated_windows(index: FMIndex, text: np.ndarray, first: np.ndarray, windows: np.ndarray, words: int) -> np.ndarray:
    """(member, window) pairs of the windows that also start earlier in the index.

    ``first`` is each member's place in ``text``, ``windows`` its number of
    windows. All members advance together, one backward step at a time.
    """
    found = [np.zeros((0, 2), np.int64)]
    member = np.arange(len(first))
    window = np.zeros(len(first), np.int64)
    at = first + words - 1
    lo, hi = index.rows(text[at])
    while len(member):
        twice = hi - lo >= 2
        start = first[member] + window
        whole = twice & (at == start)
        if whole.any():
            places = index.earliest(lo[whole], hi[whole])
            earlier = places < start[whole]
            found.append(np.stack([member[whole][earlier], window[whole][earlier]], 1))
        # A suffix that occurs once rules out every window that holds it.
        window = np.where(whole, window + 1, np.where(twice, window, at - first[member] + 1))
        done, fresh = window >= windows[member], whole | ~twice
        if done.any():
            member, window, at, lo, hi, fresh = (x[~done] for x in (member, window, at, lo, hi, fresh))
        at = np.where(fresh, first[member] + window + words - 1, at - 1)
        lo, hi = lo.copy(), hi.copy()
        if fresh.any():
            lo[fresh], hi[fresh] = index.rows(text[at[fresh]])
        if not fresh.all():
            lo[~fresh], hi[~fresh] = index.extend(text[at[~fresh]], lo[~fresh], hi[~fresh])
    return np.concatenate(found)


def cut_segments(texts: list[bytes], words: int = WORDS, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of a block of texts: text number, first word, number of windows, minimizer, content hash."""
    hashes, bounds = word_hashes(texts)
    n = len(hashes) - words + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    valid = owner[:n] == owner[words - 1:]
    least, place = _chain(hashes, gram), np.arange(len(hashes) - gram + 1)
    span = words - gram + 1                                    # grams of a window
    width = 1
    while width < span:                                        # leftmost least gram, by doubling
        step = min(width, span - width)
        right = least[step:] < least[:-step]
        least = np.where(right, least[step:], least[:-step])
        place = np.where(right, place[step:], place[:-step])
        width += step
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    begin = np.flatnonzero(begins)
    passed = np.concatenate([[0], np.cumsum(valid)])
    windows = np.diff(np.append(passed[begin], passed[-1]))
    power, inverse = _power_tables(len(hashes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:len(hashes)], dtype=np.uint64)])
    content = mix((sums[begin + windows + words - 1] - sums[begin]) * inverse[begin] + windows.astype(np.uint64))
    return owner[begin], begin - bounds[owner[begin]], windows, least[begin], content


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > BLOCK_BYTES:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _batch(columns: list, names: str, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names.split())


def segments(documents: DataFrame, words: int) -> DataFrame:
    """(m, seg, doc, key, at) of every segment. ``at`` holds first word, windows - 1 (6 bits),
    "an equal one stands before it in its batch" and "its minimizer occurs again in the batch"."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = (batch.column(i).to_numpy() for i in range(2))
            texts = batch.column(2).to_pylist()
            parts = []
            for a, b in _blocks([len(t) for t in texts]):
                owner, first, windows, m, seg = cut_segments(texts[a:b], words)
                parts.append((m.view(np.int64), seg.view(np.int64), docs[a + owner], keys[a + owner], first << 6 | windows - 1))
            if not parts:
                continue
            m, seg, doc, key, at = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((at, key, doc, seg, m))
            m, seg, doc, key, at = (c[order] for c in (m, seg, doc, key, at))
            same_m, same_seg = m[1:] == m[:-1], (m[1:] == m[:-1]) & (seg[1:] == seg[:-1])
            twin = same_seg & (doc[1:] == doc[:-1]) & (key[1:] == key[:-1]) & (at[1:] == at[:-1])
            again = np.append(same_m, False) | np.append(False, same_m)
            at = at << 2 | np.append(False, same_seg).astype(np.int64) << 1 | again
            once = ~np.append(False, twin)[:len(m)]
            yield _batch([c[once] for c in (m, seg, doc, key, at)], "m seg doc key at", [pa.int64()] * 5)

    return documents.mapInArrow(run, "m long, seg long, doc long, key long, at long")


def marks(found: DataFrame) -> DataFrame:
    """(doc, key, mark) of the candidates: first word, windows - 1 (6 bits) and kind (2 bits).

    Rows come sorted by minimizer, content and place, so the first of equal
    segments leads; a minimizer seen once is dropped.
    """
    schema = "doc long, key long, mark long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []       # leads of the current minimizer, not yet given out
        n_held, rows, state = 0, 0, None   # its leads held, rows seen, (m, seg, doc, key, place) of the last lead
        hot = False

        def out(doc, key, place, kind) -> pa.RecordBatch:
            return _batch([doc, key, place << 2 | kind], "doc key mark", [pa.int64()] * 3)

        def close() -> Iterator[pa.RecordBatch]:
            if held and rows > 1:
                doc, key, place = (np.concatenate(c) for c in zip(*held))
                yield out(doc, key, place, SPLIT if hot else LEAD)

        for batch in batches:
            m, seg, doc, key, at = (batch.column(i).to_numpy() for i in range(5))
            if not len(m):
                continue
            place, copied, again = at >> 2, at >> 1 & 1 == 1, at & 1 == 1
            new_m = np.append(state is None or m[0] != state[0], m[1:] != m[:-1])
            new_seg = new_m | np.append(state is None or seg[0] != state[1], seg[1:] != seg[:-1])
            lead = new_seg & ~copied
            # The lead before each row; rows of the lead's own place are the same document again.
            last = np.maximum.accumulate(np.where(lead, np.arange(len(m)), -1))
            known = state if state is not None else (0, 0, 0, 0, -1)
            own = [np.where(last >= 0, c[last], k) for c, k in zip((doc, key, place), known[2:])]
            twin = ~lead & ~copied & (own[0] == doc) & (own[1] == key) & (own[2] == place)
            copy = ~lead & ~twin
            if copy.any():
                yield out(doc[copy], key[copy], place[copy], COPY)
            starts = np.flatnonzero(new_m)
            bounds = np.append(starts, len(m)) if len(starts) else np.array([len(m)])
            head = int(bounds[0])
            if head:                                            # goes on with the minimizer held
                rows += head + int(again[:head].any())
                chosen = np.flatnonzero(lead[:head])
                if len(chosen):
                    held.append((doc[chosen], key[chosen], place[chosen]))
                    n_held += len(chosen)
            if len(starts):
                yield from close()
                sizes = np.diff(bounds)
                sizes = sizes + np.add.reduceat(again.astype(np.int64), starts)
                leads = np.add.reduceat(lead.astype(np.int64), starts)
                wanted = np.repeat(sizes > 1, np.diff(bounds))
                big = np.repeat(leads > HOT, np.diff(bounds))
                body = np.arange(len(m)) < starts[-1]
                body &= np.arange(len(m)) >= head
                chosen = body & lead & np.concatenate([np.zeros(head, bool), wanted])
                if chosen.any():
                    kind = np.where(np.concatenate([np.zeros(head, bool), big]), SPLIT, LEAD)[chosen]
                    yield out(doc[chosen], key[chosen], place[chosen], kind)
                tail = np.flatnonzero(lead & (np.arange(len(m)) >= starts[-1]))
                held, n_held, rows, hot = [(doc[tail], key[tail], place[tail])], len(tail), int(sizes[-1]), False
            if n_held > HOT:                                    # too many to hold: given out as they come
                hot = True
                yield from close()
                held, n_held = [], 0
            if lead.any():
                i = int(np.flatnonzero(lead)[-1])
                state = (m[-1], seg[-1], doc[i], key[i], place[i])
            else:
                state = (m[-1], seg[-1], *known[2:])
        yield from close()

    home = F.when(F.col("at").bitwiseAND(2) == 2, F.xxhash64("m", "doc", "key", "at")).otherwise(F.col("m"))
    ordered = found.repartition(home).sortWithinPartitions("m", "seg", "doc", "key", "at")
    return ordered.mapInArrow(run, schema)


def _words_at(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after it."""
    codes = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~((codes == 32) | ((codes >= 9) & (codes <= 13))), [False]])
    return np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])


def members(marked: DataFrame, words: int, shards: int) -> DataFrame:
    """(shard, doc, key, at, body) of every leading segment; ``body`` is its stretch of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = (batch.column(i).to_numpy() for i in range(2))
            texts, every = (batch.column(i).to_pylist() for i in (2, 3))
            for a, b in _blocks([len(t) for t in texts]):
                rows: list[list] = [[], [], [], [], []]
                for i in range(a, b):
                    places = sorted(x >> 2 for x in every[i] if x & 3 == LEAD)
                    if not places:
                        continue
                    begin, end = _words_at(texts[i])
                    grams = _chain(word_hashes([texts[i]])[0], GRAM)
                    for place in places:
                        first, last = place >> 6, (place >> 6) + (place & 63) + words - 1
                        rows[0].append(int(grams[first:first + words - GRAM + 1].min().view(np.int64)))
                        rows[3].append(place)
                        rows[4].append(texts[i][begin[first]:end[last]])
                    rows[1] += [docs[i]] * len(places)
                    rows[2] += [keys[i]] * len(places)
                yield _batch(rows, "m doc key at body", [pa.int64()] * 4 + [pa.binary()])

    out = marked.mapInArrow(run, "m long, doc long, key long, at long, body binary")
    return out.select(F.pmod(F.xxhash64("m"), F.lit(shards)).cast("int").alias("shard"), "doc", "key", "at", "body")


def search_shard(bodies: list[bytes], windows: np.ndarray, words: int) -> np.ndarray:
    """Bit masks of each member's windows that also start earlier in the shard (members in order of place)."""
    hashes, bounds = word_hashes(bodies)
    known, codes = np.unique(hashes, return_inverse=True)
    sizes = np.diff(bounds)
    text = np.zeros(len(hashes) + len(bodies), np.int64)
    first = bounds[:-1] + np.arange(len(bodies))
    text[np.arange(len(hashes)) + np.repeat(np.arange(len(bodies)), sizes)] = codes + 1
    found = repeated_windows(FMIndex(text, int(sizes.max())), text, first, windows, words)
    masks = np.zeros(len(bodies), np.int64)
    np.bitwise_or.at(masks, found[:, 0], np.int64(1) << found[:, 1])
    return masks


def search(indexed: DataFrame, words: int, shards: int) -> DataFrame:
    """(doc, key, at, mask) of the members with windows that also start earlier, a shard's index at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts)
            place = np.stack([table[c].to_numpy() for c in ("doc", "key", "at")])
            table = table.filter(pa.array(np.append(True, (place[:, 1:] != place[:, :-1]).any(0))))  # rows of one document
            at = table["at"].to_numpy()
            masks = search_shard(table["body"].to_pylist(), (at & 63) + 1, words)
            hit = masks != 0
            return _batch([table["doc"].to_numpy()[hit], table["key"].to_numpy()[hit], at[hit], masks[hit]],
                          "doc key at mask", [pa.int64()] * 4)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(shard))):
                if b > a:
                    if held and held[0].column(0)[0].as_py() != shard[a]:
                        yield answer(held)
                        held = []
                    held.append(batch.slice(a, b - a))
        if held:
            yield answer(held)

    ordered = indexed.repartition(shards, "shard").sortWithinPartitions("shard", "doc", "key", "at")
    return ordered.mapInArrow(run, "doc long, key long, at long, mask long")


def split_windows(marked: DataFrame, words: int) -> DataFrame:
    """(doc, key, at, mask) of windows under hot minimizers that also start earlier: counted by content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = (batch.column(i).to_numpy() for i in range(2))
            texts, every = (batch.column(i).to_pylist() for i in (2, 3))
            for doc, key, text, found in zip(docs, keys, texts, every):
                starts = [s for x in found if x & 3 == SPLIT for s in range(x >> 8, (x >> 8) + (x >> 2 & 63) + 1)]
                if starts:
                    content = _chain(word_hashes([text])[0], words).view(np.int64)
                    yield _batch([content[starts], np.full(len(starts), doc), np.full(len(starts), key), starts],
                                 "content doc key start", [pa.int64()] * 4)

    rows = materialise(marked.mapInArrow(run, "content long, doc long, key long, start long"), "split-windows")
    place = F.struct("doc", "key", "start")
    first = rows.groupBy(F.col("content").alias("_content")).agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (rows.join(first, rows["content"] == first["_content"]).where(place != F.col("least"))
            .select("doc", "key", F.shiftleft("start", 6).alias("at"), F.lit(1).cast("long").alias("mask")))


def identity(docs: DataFrame) -> tuple[Column, Column]:
    """Order of documents: id (null last), then text hash where an id occurs more than once."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    return F.coalesce("doc_id", F.lit(LAST)), F.lit(0).cast("long") if repeated else F.xxhash64("text")


def repeated_words(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, text (binary) and ``cover``, marks of the stretches to remove as
    first word (from bit 6 on) and words - 1 beyond a window (low 6 bits)."""
    doc, key = identity(docs)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    documents = docs.select(doc.alias("doc"), key.alias("key"), text.alias("text"))
    per_doc = (marks(segments(documents, words)).groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key"))
               .agg(F.collect_list("mark").alias("marks")))
    per_doc = materialise(per_doc, "repeat-marks")
    kinds = lambda k: F.sum(F.size(F.filter("marks", lambda x: x.bitwiseAND(3) == k)))
    n_leads, n_split = per_doc.agg(F.coalesce(kinds(LEAD), F.lit(0)), F.coalesce(kinds(SPLIT), F.lit(0))).first()
    # Both joins below shuffle the documents alike, so that exchange is made once.
    joined = documents.join(per_doc, (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key"))).select("doc", "key", "text", "marks")
    shards = max(1, -(-n_leads * (words + 9) // SHARD_WORDS))
    hits = search(members(joined, words, shards), words, shards)
    if n_split:
        hits = hits.unionByName(split_windows(joined, words))
    # A run of windows is one stretch; a mask's bits are windows of their own.
    bits = F.filter(F.sequence(F.lit(0), F.lit(words - GRAM)), lambda i: F.getbit("mask", i) == 1)
    single = hits.select("doc", "key", F.transform(bits, lambda i: F.shiftleft(F.shiftright("at", 6) + i, 6)).alias("cover"))
    copies = per_doc.select("_doc", "_key", F.transform(F.filter("marks", lambda x: x.bitwiseAND(3) == COPY),
                                                        lambda x: F.shiftright(x, 2)).alias("cover"))
    cover = (single.unionByName(copies.toDF("doc", "key", "cover")).groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key"))
             .agg(F.flatten(F.collect_list("cover")).alias("cover")))
    return documents.join(cover, (F.col("doc") == F.col("_doc")) & (F.col("key") == F.col("_key")), "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "text", "cover")


def remove_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, kept (the words left, joined by one space), n_words and n_removed, one row per row of ``docs``."""
    schema = "doc_id long, kept string, n_words long, n_removed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, covers = (batch.column(i).to_pylist() for i in range(3))
            for a, b in _blocks([len(t) for t in texts]):
                rows: list[list] = [[], [], []]
                for text, cover in zip(texts[a:b], covers[a:b]):
                    found = text.split()                       # bytes: ASCII white space only
                    n = len(found)
                    if cover:
                        at = np.array(cover)
                        change = np.zeros(n + 1, np.int64)
                        np.add.at(change, at >> 6, 1)
                        np.add.at(change, (at >> 6) + (at & 63) + words, -1)
                        keep = np.cumsum(change[:n]) == 0
                        found = [found[i] for i in np.flatnonzero(keep).tolist()]
                    rows[0].append(b" ".join(found).decode())
                    rows[1].append(n)
                    rows[2].append(n - len(found))
                yield _batch([ids[a:b], *rows], "doc_id kept n_words n_removed", [pa.int64(), pa.string(), pa.int64(), pa.int64()])

    return repeated_words(docs, words).mapInArrow(run, schema)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
