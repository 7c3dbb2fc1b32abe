"""Operator 5 against brute force over all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from tradeflow.llm.neardup import bag_min_hash, near_classes, shingle_counts
from tradeflow.llm.queries import QUERIES
from tradeflow.llm.shingles import blocks

from .conftest import EDGE


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0


def brute(rows):
    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    texts = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            if (text or "") in texts:
                join(doc_id, texts[text or ""][0])
            else:
                texts[text or ""] = (doc_id, bag(text))
    by = {}
    for doc_id, b in texts.values():
        for s in b:
            by.setdefault(s, []).append((doc_id, b))
    done = set()
    for group in by.values():
        for i, (x, bx) in enumerate(group):
            for y, by_ in group[i + 1 :]:
                if (x, y) not in done:
                    done.add((x, y))
                    if similarity(bx, by_) >= 0.8:
                        join(x, y)
    return {d: find(d) for d in parent}, texts


def test_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = brute(rows)
    got = {r.doc_id: r.class_id for r in QUERIES["op5_bagminhash"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want
    assert len(set(got.values())) < len(got)


def test_edge_rows(edge, no_rows):
    want, texts = brute(EDGE)
    got = near_classes(edge).collect()
    assert len(got) == len(EDGE)
    for r in got:
        assert r.class_id == (want[r.doc_id] if r.doc_id is not None else want[1])
    assert near_classes(no_rows).count() == 0


def test_one_id_on_two_texts(spark):
    """Both texts keep their own links, and the id does not tie them together."""
    one, other = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    rows = [(9, one), (9, other), (10, f"{one} end"), (2, f"{other} end"), (11, other), (None, f"{one} and")]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.class_id) for r in got) == [(0, 9), (2, 2), (9, 2), (9, 9), (10, 9), (11, 2)]


def test_chains_and_big_groups(spark):
    """Copies of one text that differ in place, so that many pairs are just below or above 0.8."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, " ".join(f"z{rng.randrange(50)}" for _ in range(60))) for k in range(30)]
    want, _ = brute(rows)
    got = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("texts", [("a b c d e f g h " * 30, "a b c d e f g h " * 20), ("x y " * 100 + "p q r s t " * 40, "x y " * 60 + "p q r s t u " * 45)])
def test_signatures_estimate_weighted_similarity(texts):
    import pyarrow as pa

    (_, _, raw, starts), = blocks(pa.array(list(texts)))
    signatures = bag_min_hash(2, *shingle_counts(raw, starts), places=4000)
    assert abs(np.mean(signatures[0] == signatures[1]) - similarity(*map(bag, texts))) < 0.04
