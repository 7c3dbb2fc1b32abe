"""Operator 11 against a brute-force reading of its contract, and its filters and blocks."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tradeflow.llm import collocations as m

from .conftest import EDGE


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text or ""))]


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, top=2000, least=30):
    f, n = counted(rows)
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in found.items():
        longer = [b for (other, q), b in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -score) for lang, rows_ in out.items()
                  for r, (score, a, p, left, right) in enumerate(sorted(rows_)[:top], 1))


def result(spark, rows, parts=3, **given):
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    return sorted(map(tuple, m.collocations(docs, **given).collect()))


WORDS = "the of and a b c d é Ünï x1 'q  n The OF".split(" ")


def texts(seed, count, pool=WORDS):
    rng = random.Random(seed)
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!", " ; ", "\x0b"]
    return [("".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(0, 90))), rng.choice(["en", "fr", "und", None])) for _ in range(count)]


@pytest.mark.parametrize("seed,least,top", [(1, 30, 2000), (2, 3, 2000), (3, 8, 20), (4, 1, 50)])
def test_random_texts(spark, seed, least, top):
    rows = texts(seed, 60 if least < 30 else 300)
    assert result(spark, rows, top=top, least=least) == brute(rows, top, least)


def test_edge_rows(spark, edge, no_rows):
    assert sorted(map(tuple, m.collocations(edge, least=2).collect())) == brute([r[1:3] for r in EDGE], least=2)
    assert m.collocations(no_rows).count() == 0
    assert result(spark, [(None, None), ("", "en"), (" .\n", None)]) == []


def test_a_copy_in_a_third_of_all_rows(spark):
    rows = texts(5, 80) + [("The same text in many rows; of the same kind. The same text.", "en")] * 40
    assert result(spark, rows) == brute(rows)


def test_a_text_longer_than_a_block(spark):
    """One text is cut between pieces, one has no place to cut."""
    rows = [("one two three. Four five, " * 900_000, "en"), ("no end here " * 1_500_000, "fr"), ("one two three", "en")]
    assert len(rows[0][0]) > 2 * m.BLOCK_BYTES
    got = {(r[0], r[2]): r[3:7] for r in result(spark, rows, 1)}
    assert got["en", "one two three"] == (900_001, 900_001, 900_001, 4_500_003) and got["en", "four five"] == (900_000, 900_000, 900_000, 4_500_003)
    assert ("en", "three four") not in got and got["fr", "no end here no"][0] == 1_499_999


def test_sections_cut_where_pieces_end(monkeypatch):
    monkeypatch.setattr(m, "BLOCK_BYTES", 10)
    raw = np.frombuffer(b"aa bb cc. dd ee, ff gg hh ii jj kk ll mm; nn. oo", np.uint8)
    parts = [p.tobytes() for p, _, _ in m.sections(raw, np.array([0, len(raw)]))]
    assert b"".join(parts) == raw.tobytes() and len(parts) > 2 and all(p[-1:] in b".,;" for p in parts[:-1])


def test_tokens_are_the_contracts_words():
    rows = [t for t, _ in texts(9, 40)] + ["", "  ", "Ends here."]
    (_, _, raw, starts), = m.blocks(pa.array(rows))
    tokens = m.Tokens(raw, starts, np.zeros(len(rows), np.uint64))
    want = [(k, len(p) - i) for k, t in enumerate(rows) for p in pieces(t) for i in range(len(p))]
    assert list(zip(tokens.row.tolist(), tokens.left.tolist())) == want
    ids, words = tokens.ids()
    assert [words[i].as_py().decode() for i in ids.tolist()] == [w for t in rows for p in pieces(t) for w in p]


def test_filter_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5000, np.int64)
    found = m.bit_filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), 20)
    assert found(keys.astype(np.uint64)).all() and found.data.nbytes == 1 << 17
    other = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 5000, np.int64)
    assert found(other.astype(np.uint64)).mean() < 0.02
    ends = np.array([0, (1 << 64) - 1], np.uint64)
    assert m.bit_filter(spark.createDataFrame([(0,), (-1,)], "key long"), 20)(ends).all()


def test_scores_pass_64_bits(spark):
    """Counts near 10^18: products of 10^24 stay exact."""
    big = 10**18
    rows = [("en", "a", 1, 3 * big), ("en", "b", 1, 4 * big + 1), ("en", "a b", 2, big + 7), ("en", "a b a", 3, 4 * big // 5 + 6), ("en", "b a", 2, big)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, n_words int, f long")
    got = {r.phrase: (r.a, r.l, r.r, r.score) for r in m.scored(counts).collect()}
    assert got["a b"] == (big + 7, 3 * big, 4 * big + 1, 2_000_000 * (big + 7) // (7 * big + 1))
    assert {r.phrase for r in m.covered(counts).collect()} == {"a b", "b a"}


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert sorted(map(tuple, m.op11_son_collocations(spark, "/root/testdata/sf0.001").collect())) == brute(rows)
