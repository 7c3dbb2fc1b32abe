"""Operator 13 against a brute-force reading of its contract, its keep bitmaps and its plan."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tradeflow.llm import lines as m

from .conftest import EDGE

BLANKS = " \t\n\x0b\x0c\r"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept text) of each (doc_id, text)."""
    key = lambda x: lower(x.strip(BLANKS))
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [doc_id is not None and key(x) in holders and doc_id > min(holders[key(x)]) for x in lines]
        out.append((doc_id, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def result(df):
    rows = m.dedup_lines(df).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted(map(tuple, rows), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


CASES = [
    (3, "A first Line of it\n short\nanother whole line\n\n"), (1, " a FIRST line of it\x0b\nshort"), (2, "another whole line\nanother whole line"),
    (5, "another whole line\nown line number five\nANOTHER WHOLE LINE \na first line of it"), (7, "a first line of it"), (7, "a first line of it"),
    (7, "unlike the other row of id 7\nown line number five"), (None, "a first line of it\nx"), (None, None), (8, None), (9, ""), (10, "\n\n"),
    (11, "Ärgerliche Zeile"), (12, "ärgerliche Zeile"), (13, "Ärgerliche zeile"), (14, "123456789"), (15, "123456789"), (16, "1234567890"), (17, "1234567890"),
]


def test_cases(spark, edge, no_rows):
    assert result(frame(spark, CASES)) == brute(CASES)
    assert result(edge) == brute([r[:2] for r in EDGE])
    assert m.dedup_lines(edge).select("row.*").dtypes == edge.dtypes
    assert m.dedup_lines(no_rows).count() == 0 and m.keep_bitmaps(no_rows).count() == 0


@pytest.mark.parametrize("least", [1, 10])
def test_random_texts_with_a_hot_line(spark, least):
    rng = random.Random(least)
    pool = ["the line that nearly every text holds", "Second shared line", "x", "", "  "] + [f"line number {k} of the pool" for k in range(60)]
    rows = []
    for d in rng.sample(range(-500, 5000), 400):
        body = [rng.choice(pool[:1] * 20 + pool) for _ in range(rng.randrange(0, 12))] + [f"own {d}" for _ in range(rng.randrange(2))]
        rows.append((d, "\n".join(x.upper() if rng.random() < 0.3 else x + " " * rng.randrange(2) for x in body)))
    rows.append((9999, "\n".join(["another line of a very long text"] * 30_000 + pool)))
    got = m.dedup_lines(frame(spark, rows).repartition(7), least).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, least)


def test_hot_keys_do_not_change_the_result(spark, monkeypatch):
    rows = [(d, f"one line for all of them\n{'a second line' if d % 2 else 'own ' * d}") for d in range(1, 60)]
    want = brute(rows)
    for hot in (lambda found: [], lambda found: [r.hash for r in found.select("hash").distinct().collect()]):
        monkeypatch.setattr(m, "hot_hashes", hot)
        assert result(frame(spark, rows)) == want


def test_sketch_finds_the_hot_line(spark):
    found = m.entries(frame(spark, [(d, "one line for all of them\n" + "\n".join(f"own line {d} {k}" for k in range(9))) for d in range(3000)]))
    hot = m.hot_hashes(found)
    assert spark.range(1).select(F.xxhash64(F.lit("one line for all of them"))).first()[0] in hot and len(hot) <= m.HOT_ONE_IN


def test_bitmaps_are_runs(spark):
    rows = [(1, "\n".join(f"shared line {k}" for k in range(9))), (2, "\n".join(["own"] + [f"shared line {k}" for k in (0, 1, 5)] + ["end", "shared line 8"]))]
    got = m.keep_bitmaps(frame(spark, rows)).collect()
    assert [(r.id, r.n_dropped, [tuple(x) for x in r.kept_runs]) for r in got] == [(2, 4, [(0, 1), (4, 5), (6, None)])]


def test_one_range_exchange_and_no_python(spark, docs):
    """The stream reads the range exchange: no second one for its window; nothing runs in Python."""
    plan = m.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    stream = m.W.partitionBy("hash", "check", "range").orderBy("id", "at").rowsBetween(m.W.unboundedPreceding, 0)
    for keys, salt in ((["hash", "range"], F.when(F.col("hash") % 7 == 0, F.col("id") % 4).otherwise(-1)), (["hash"], F.lit(-1))):
        seen = m.entries(docs).withColumn("range", salt).repartitionByRange(*keys).withColumn("first", F.first("id").over(stream))
        plan = seen._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = m.op13_line_dedup(spark, "/root/testdata/sf0.001").collect()
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(d, n, g, h(t)) for d, n, g, t in brute([(r.doc_id, r.text) for r in docs.collect()])]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
