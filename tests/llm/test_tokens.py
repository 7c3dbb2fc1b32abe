"""Operators 2 and 8 against the tokenizers library, and their defined results."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradeflow.llm.bpe import Transducer, encode_decode, op8_bpe_transducer
from tradeflow.llm.packing import MOST_ROOMS, HarmonicPacker, pack
from tradeflow.llm.tokens import default_tokenizer, library_ids

LIB = Tokenizer.from_file(default_tokenizer())
OWN = Transducer(default_tokenizer())
FAST = library_ids(default_tokenizer())
PARTS = ["a", "the ", "'s", " ", "\n", "  ", "\t", "é", "😀", "1", "..", " ", "\x1c", "\x85", "<|endoftext|>",
         "ing", "\r\n", "aaaa", "=====", "'re", "　", "中", "́", "²", "thering"]


def lib(text):
    return LIB.encode(text, add_special_tokens=False).ids


def own(text):
    return np.frombuffer(OWN.encoder.encode(text), "<u4").tolist()


@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_ids_and_text_as_the_library(text):
    ids = lib(text)
    assert own(text) == ids == np.frombuffer(FAST(text), "<u4").tolist()
    assert "".join(OWN.decode(ids)) == LIB.decode(ids, skip_special_tokens=False) == text


@given(st.lists(st.integers(0, 50256), max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_ids_decode_as_the_library(ids):
    assert "".join(OWN.decode(ids, block=3)) == LIB.decode(ids, skip_special_tokens=False)


def test_code_points():
    """All code points where their class decides: before 're, after a digit, between letters and blanks."""
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000:
            text = f"1{chr(c)}'s a{chr(c)}'re{chr(c)}1 {chr(c)}"
            assert OWN.encode_piece(text) == lib(text), hex(c)


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\u3000"])
def test_long_runs_of_blanks(blank):
    text = blank * 2_000_000 + "x"
    assert FAST(text) == np.array(lib(text), "<u4").tobytes()
    assert own(text[-200_000:]) == lib(text[-200_000:])


def test_long_texts_in_parts():
    text = "One two  three\nfour. " * 20_000 + "x" * 300_000 + " end <|endoftext|> of it" * 9000
    assert own(text) == lib(text) == np.frombuffer(FAST(text), "<u4").tolist()
    assert len(list(OWN.encoder.stream(text))) > 5
    assert "".join(OWN.decode(iter(lib(text)))) == text


@pytest.mark.parametrize("text", ["ab" * 40_000, "=-" * 30_000, "a" * 50_000, "中" * 20_000, "thering" * 9000])
def test_buffer_is_bounded(text, monkeypatch):
    """The transducer holds a few lookaheads of positions, not the pretoken."""
    most, stable = 0, OWN._stable

    def seen(held):
        nonlocal most
        most = max(most, len(held))
        return stable(held)

    monkeypatch.setattr(OWN, "_stable", seen)
    assert sum(OWN.transduce(text.encode()), []) == lib(text)
    assert OWN.lookahead < most <= 5 * OWN.lookahead


def test_lookahead_is_of_the_merge_list():
    assert all(len(OWN.bytes_of[k]) <= OWN.lookahead for k in OWN.made if OWN._reachable(k))


@pytest.mark.parametrize("text", ["a" * 3000, "=-" * 2000, "thering" * 700, "中文" * 900, "ab" * 64 + "c" * 700])
def test_long_pretokens_stream(text):
    assert list(OWN.encode_piece(text)) == lib(text)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, ids string")


ROWS = [(1, "the cat", "x", None), (2, None, None, "y"), (3, "", "", ""), (None, "the cat", "x", "x"), (1, "the cat", "x", None),
        (4, "word " * 9000, "", ""), (5, " \n ", "", "")]


def test_encode_decode_rows(spark):
    got = encode_decode(frame(spark, ROWS)).collect()
    want = []
    for doc_id, text, *_ in ROWS:
        ids = lib(text or "")
        h = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), h(",".join(map(str, ids))), h(text or "")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert encode_decode(frame(spark, [])).count() == 0


@given(st.lists(st.one_of(st.integers(1, 300), st.integers(1, 9000)), max_size=200), st.sampled_from([256, 2048]))
@settings(max_examples=150, deadline=None)
def test_any_lengths_fill_bins(lengths, capacity):
    """Each id lies in one piece, sequences are gapless and full, and bins of a class hold its number of documents."""
    packer = HarmonicPacker(3, capacity)
    docs = [np.arange(1000 * d, 1000 * d + n, dtype="<u4").tobytes() for d, n in enumerate(lengths)]
    early = [p for d, ids in enumerate(docs) for p in packer.add(d, ids)]
    assert len(packer.rooms) <= MOST_ROOMS and all(sum(len(p[2]) for p in b) < 4 * capacity for b in packer.open.values())
    pieces = early + list(packer.finish())
    bins, parts = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset in pieces:
        assert crc == zlib.crc32(docs[doc_id][4 * start : 4 * (start + length)]) and total == lengths[doc_id] and length
        bins[sequence].append((offset, length))
        parts[doc_id].append((start, length))
    for own, total in [(v, None) for v in bins.values()] + [(v, lengths[d]) for d, v in parts.items()]:
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[0][0] == 0 and total in (None, own[-1][0] + own[-1][1])
    used = [b[-1][0] + b[-1][1] for b in bins.values()]
    assert len(parts) == len(lengths) and all(u <= capacity and u & (u - 1) == 0 for u in used)
    assert min(bins, default=3 << 40) >= 3 << 40


def check_packing(rows, pieces):
    docs, bins = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        bins[p.sequence_id].append(p)
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[doc_id].append(lib(text or "") + [1])
    for doc_id, ids in texts.items():
        if len(ids) == 1:
            at = 0
            for p in sorted(docs[doc_id], key=lambda p: p.start):
                part = np.array(ids[0][p.start : p.start + p.length], "<u4").tobytes()
                assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(part), len(ids[0]))
                at += p.length
            assert at == len(ids[0])
    assert sum(map(len, sum(texts.values(), []))) == sum(p.length for p in pieces)
    used = padded = 0
    for b in bins.values():
        at = 0
        for p in sorted(b, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used, padded = used + at, padded + (0 if at & (at - 1) == 0 else 2048 - at)
    return padded / max(1, used)


def test_pack_rows(spark):
    check_packing(ROWS, pack(frame(spark, ROWS)).collect())
    assert pack(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        pack(frame(spark, []), capacity=1000)


def test_pack_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    pieces = pack(docs.coalesce(1)).collect()
    assert check_packing(rows, pieces) < 0.001
    count = Counter(p.doc_id for p in pieces)
    fit = {p.doc_id for p in pieces if p.doc_tokens <= 2048}
    assert len(fit) > 800 and sum(count[d] > 1 for d in fit) < 0.1 * len(fit)  # documents that fit stay whole
    assert check_packing(rows, pack(docs.repartition(7)).collect()) < 0.01


def test_pack_long_blanks(spark):
    rows = [(1, " " * 1_000_750 + "x"), (2, "\n" * 500_000), (3, None)]
    assert check_packing(rows, pack(frame(spark, [(*r, "", "") for r in rows])).collect()) == 0


def test_query_over_documents(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in op8_bpe_transducer(spark, "/root/testdata/sf0.01").collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in docs.collect():
        ids = lib(r.text or "")
        assert got.pop(r.doc_id) == (len(ids), h(",".join(map(str, ids))), h(LIB.decode(ids, skip_special_tokens=False)))
    assert not got
