"""Operator 1 against brute force."""

import hashlib
import random
import re

import pytest

from tradeflow.llm.queries import QUERIES
from tradeflow.llm.substrings import cut, dedup_substrings

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n):
    first = {}
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if doc_id is not None:
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - n + 1):
            if doc_id is not None and first[tuple(w[i : i + n])] < doc_id:
                gone.update(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = QUERIES["op1_debruijn_substrings"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 13)


@pytest.mark.parametrize("n,gram", [(3, 2), (5, 5), (13, 5)])
def test_edge_rows(edge, no_rows, n, gram):
    assert result(dedup_substrings(edge, n, gram)) == brute(EDGE, n)
    assert dedup_substrings(no_rows, n, gram).count() == 0


def test_random_small_alphabet(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(40), " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for _ in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(dedup_substrings(df, 6, 3)) == brute(rows, 6)


def test_kept_text_holds_the_kept_words():
    text = " a b\tc d\n e f g "
    n_words, removed, _, kept = cut(text, [2, 1], 2)
    assert (n_words, removed, kept.split(), kept) == (7, 3, ["a", "e", "f", "g"], " a e f g ")


def test_all_columns_stay(edge):
    r = dedup_substrings(edge).where("row.doc_id = 7").first()
    assert (r.row.lang, r.row.bucket, r.row.row) == ("en", "c", 5)
