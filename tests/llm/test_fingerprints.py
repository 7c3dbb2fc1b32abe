"""Operator 10: the exact columns against brute force, the estimate against generalised Jaccard."""

import hashlib
from collections import Counter

from tradeflow.llm import fingerprints as fp
from tradeflow.llm.queries import QUERIES

from .conftest import EDGE


def want(rows):
    """Rows in descending id (null last), ties by text; the edited text's hash."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, after))
    return out


def jaccard(a, b):
    a, b = Counter(a.encode().split()), Counter(b.encode().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_documents(spark, docs):
    rows = want([(r.doc_id, r.text or "") for r in docs.collect()])
    got = {r.doc_id: r for r in QUERIES["op10_weighted_sampling"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    errors = []
    for doc_id, n, sha, text, edited, after in rows:
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        if len(text.split()) > 30 and len(after.split()) > 30:
            errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
        if text == edited:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
    assert abs(sum(errors) / len(errors)) < 0.02
    assert sum(e * e for e in errors) / len(errors) < 0.06**2
    same = {}
    for doc_id, _, _, text, *_ in rows:
        assert same.setdefault(text, got[doc_id].fingerprint) == got[doc_id].fingerprint


def test_edge_rows(edge, no_rows):
    rows = want([(r[0], r[1] or "") for r in EDGE])
    got = fp.fingerprints(edge).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted((r[:3] for r in rows), key=key)
    assert fp.fingerprints(no_rows).count() == 0


def test_far_apart_ids_and_one_row(spark):
    ids = [-(2**62), -5, 0, 1023, 1024, 1025, 2**40, 2**62]
    rows = [(i, f"text number {k} of some words") for k, i in enumerate(ids)]
    for part in (rows, rows[:1], rows[:2], rows + [(None, "null one"), (2**62, "a tie")]):
        got = fp.fingerprints(spark.createDataFrame(part, "doc_id long, text string")).collect()
        key = lambda r: tuple(map(str, r))
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=key) == sorted((r[:3] for r in want(part)), key=key)
