import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetstar.llm import packing, token_codes
from fleetstar.llm.tokens import PieceEncoder

FILES = {name: public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def reference(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module", params=sorted(FILES))
def pair(request):
    return PieceEncoder(FILES[request.param]), reference(FILES[request.param])


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t.,'aesZéß0\x1c\x85 ")), max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(pair, text):
    encoder, whole = pair
    assert memoryview(encoder.encode([text])[0]).cast("I").tolist() == whole(text)


def test_known_pieces_do_not_change_ids(pair, monkeypatch):
    from fleetstar.llm import tokens

    encoder, whole = pair
    text = "Straße, the end... <|endoftext|> don't 'S  two\n three " + "x" * 100 + " again " + "x" * 100
    monkeypatch.setattr(tokens, "MAX_PIECES", 1)
    for _ in range(3):
        assert memoryview(encoder.encode([text, None])[0]).cast("I").tolist() == whole(text)


@given(st.lists(st.integers(0, 2**32 - 1), max_size=1500), st.data())
@settings(max_examples=60, deadline=None)
def test_codes_give_any_token(ids, data):
    codes = token_codes.Codes(token_codes.pack_codes(np.array(ids, "<u4")))
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.slice(a, b).tolist() == ids[a:b]
    for i in {a, b, len(ids) // 2} & set(range(len(ids))):
        assert codes.get(i) == ids[i]


def test_codes_keep_ranks_across_stretches():
    ids = np.arange(5000, dtype="<u4") * 37 % 70_000
    codes = token_codes.Codes(token_codes.pack_codes(ids))
    assert [codes.get(i) for i in range(5000)] == ids.tolist()
    with pytest.raises(IndexError):
        codes.get(5000)
    with pytest.raises(ValueError):
        token_codes.Codes(b"XXXX" + bytes(9))


def test_token_files_hold_every_document_in_order(edge_docs, edge_rows, no_docs):
    ids = reference(FILES["word_bpe_49k.json"])
    segments = token_codes.write_tokens(edge_docs, FILES["word_bpe_49k.json"], shards=3, segment_tokens=500)
    rows = sorted(token_codes.read_tokens(segments).collect(), key=lambda r: r["start"])
    want = defaultdict(list)
    for doc_id, text, *_ in edge_rows:
        want[doc_id].append(ids(text) + [2])
    start, stream = 0, []
    for row in rows:
        match = next(x for x in want[row["doc_id"]] if zlib.crc32(np.array(x, "<u4").tobytes()) == row["ids_crc32"])
        want[row["doc_id"]].remove(match)
        assert (row["start"], row["n_tokens"]) == (start, len(match))
        start += len(match)
        stream += match
    assert not any(want.values())
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d))
    for position in (0, len(stream) // 2, len(stream) - 1):
        assert token_codes.token(segments, position) == stream[position]
    with pytest.raises(IndexError):
        token_codes.token(segments, len(stream))
    assert token_codes.read_tokens(token_codes.write_tokens(no_docs, FILES["word_bpe_49k.json"], shards=2)).count() == 0


def test_packing_places_every_piece_once(edge_docs, edge_rows, no_docs):
    ids = reference(FILES["byte_bpe_50k.json"])
    rows = packing.pack(edge_docs, FILES["byte_bpe_50k.json"], group_rows=4).collect()
    total = sum(len(ids(t)) + 1 for _, t, *_ in edge_rows)
    assert sum(r["length"] for r in rows) == total
    texts = defaultdict(list)
    for doc_id, text, *_ in edge_rows:
        texts[doc_id].append(ids(text) + [2])
    for r in rows:
        parts = [x[r["start"]:r["start"] + r["length"]] for x in texts[r["doc_id"]]]
        assert r["ids_crc32"] in [zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts]
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    assert packing.pack(no_docs, FILES["byte_bpe_50k.json"]).count() == 0


@given(st.integers(1, 5000))
def test_cut_leaves_only_the_first_piece_short(total):
    pieces = packing.cut(total)
    assert sum(n for _, n in pieces) == total and [s for s, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces])[:-1])
    assert all(n == packing.SEQUENCE for _, n in pieces[1:]) and len(pieces) == -(-total // packing.SEQUENCE)


@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 8))
def test_best_fit_matches_a_plain_search(lengths, open_bins):
    packer, bins, n = packing.BestFit(64, open_bins), [], 0
    for length in lengths:
        fitting = [b for b in bins if b[1] >= length]
        least = min((b[1] for b in fitting), default=None)
        number, offset = packer.place(length)
        if least is None:
            assert (number, offset) == (n, 0)
            n += 1
            if len(bins) >= open_bins:
                fullest = min(b[1] for b in bins)
                closed = next(i for i in range(len(bins) - 1, -1, -1) if bins[i][1] == fullest)
                bins.pop(closed)
            bins.append([number, 64 - length])
        else:
            chosen = next(b for b in bins if b[0] == number)
            assert chosen[1] == least and offset == 64 - least
            bins.remove(chosen)
            bins.append([number, least - length])
        bins = [b for b in bins if b[1]]
        assert sorted(b[1] for b in bins) == sorted(f for f, s in packer.bins.items() for _ in s)


def test_bounded_bins_stay_near_the_least():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.gamma(1.6, 320, 30_000).astype(np.int64) + 1, 1023)
    packer, most = packing.BestFit(), 0
    for at in range(0, len(lengths), packing.LOOKAHEAD):
        packing.place_all(packer, lengths[at:at + packing.LOOKAHEAD])
        most = max(most, packer.n_open)
    assert most <= packing.OPEN_BINS
    assert packer.n_bins <= 1.01 * -(-lengths.sum() // packing.SEQUENCE)


def test_packers_share_a_task_and_look_ahead_in_parts(spark):
    path = FILES["byte_bpe_50k.json"]
    docs = spark.createDataFrame([(i, "word " * (i * 37 % 900)) for i in range(300)], "doc_id long, text string")
    rows = packing.pack(docs, path, group_rows=40, lookahead=7, open_bins=5).collect()
    assert sorted(r["doc_id"] for r in rows if r["piece"] == 0) == list(range(300))
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for got in places.values():
        got.sort()
        assert [o for o, _ in got] == np.cumsum([0] + [n for _, n in got])[:-1].tolist() and sum(n for _, n in got) <= packing.SEQUENCE


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", sorted(FILES))
def test_distinct_pieces_reach_the_library_many_at_once(name):
    encoder, whole = PieceEncoder(FILES[name]), reference(FILES[name])
    words = [f"{a}{b}{c}" for a in ("re", "tion", "Straß", "é") for b in "bcdfghklmn" for c in ("ing", "ou,", "ed.", "x!!", "\nend", "öst")]
    texts = [" ".join(words[i:] + words[:i]) for i in range(0, len(words), 7)] + ["", None]
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    assert [memoryview(x).cast("I").tolist() for x in encoder.encode(pa.array(texts).slice(0))] == [whole(t) for t in texts]
    assert counting.texts <= 2
    encoder.encode(texts)
    assert counting.texts <= 2  # known by now


def test_uneven_texts_keep_their_places_among_even_ones(pair, monkeypatch):
    from fleetstar.llm import tokens

    encoder, whole = pair
    monkeypatch.setattr(tokens, "JOINED", 2)
    texts = ["one two\nthree", " led", "a\n\nb c", "", "x" * 60 + " y", None, "tab\tbed end \n", "don't\x01 2nd 日本 ª́ é", "\n", "plain"] * 2
    for batch in (texts, pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        assert [memoryview(x).cast("I").tolist() for x in encoder.encode(batch)] == [whole(t) for t in texts]
