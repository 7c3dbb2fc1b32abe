"""Operator 12 against a plain recursive tree: values, proofs, tampering and edge rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tradeflow.llm import manifest as m

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(s):
    return None if s is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def tree(nodes, fan):
    """(root, path of (left, right) for each leaf) of one tree."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            run = at[k] - at[k] % fan
            path.append(("".join(nodes[run : at[k]]), "".join(nodes[at[k] + 1 : run + fan])))
        nodes = [H("".join(nodes[k : k + fan])) for k in range(0, len(nodes), fan)]
        at = [a // fan for a in at]
    return nodes[0], paths


def brute(rows, fan=16):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    grown = {}
    for s in names:
        rows_ = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        grown[s] = rows_, *tree([leaf(r) for r in rows_], fan)
    root, tops = tree([grown[s][1] for s in names], fan)
    out = []
    for s, top in zip(names, tops):
        rows_, subroot, paths = grown[s]
        for r, path in zip(rows_, paths):
            tampered = zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], lower(r[4]))) if tampered else leaf(r)
            for left, right in path + top:
                node = H(left + node + right)
            out.append((r[0], leaf(r), subroot, root, H("".join(a + b for a, b in path + top)), node, node == root))
    return sorted(out, key=str)


def result(spark, rows, monkeypatch, schema=COLUMNS):
    monkeypatch.setattr(m, "table", lambda *_: spark.createDataFrame(rows, schema).repartition(5))
    return sorted(map(tuple, m.op12_merkle_manifest(spark, "").collect()), key=str)


EDGE = [
    (1, "b", "en", 3, "The Cat"), (1, "b", "en", 3, "The Cat"), (2, None, None, None, None), (None, "a", "fr", 0, ""), (None, None, "", 2, "Ça"),
    (3, "", "en", 1, "X"), (-5, "é", "de", 4, "Ünï"), (7, "b", None, 9, "LONG " * 30_000), (1, "b", "en", 3, "other"), (10, "é", "de", 4, None),
]


def test_edge_rows(spark, monkeypatch):
    assert result(spark, EDGE, monkeypatch) == brute(EDGE)
    assert result(spark, EDGE[:1], monkeypatch) == brute(EDGE[:1])
    assert result(spark, [], monkeypatch) == []


def test_extra_columns_with_clashing_names(spark, monkeypatch):
    rows = [(*r, "x", "y", "z") for r in EDGE]
    assert result(spark, rows, monkeypatch, COLUMNS + ", tree string, `rank` string, path string") == brute(EDGE)


@pytest.mark.parametrize("sizes", [(1, 2, 15, 16, 17), (255, 256, 257, 1), (1000, *[1] * 40)])
def test_sizes_of_sources(spark, monkeypatch, sizes):
    rng = random.Random(1)
    ids = iter(rng.sample(range(100_000), sum(sizes)))
    rows = [(next(ids), f"s{k}", "en", k, f"Text {k}") for k, n in enumerate(sizes) for _ in range(n)]
    assert result(spark, rows, monkeypatch) == brute(rows)


def test_many_tiers(spark, monkeypatch):
    """A small fan-out gives the depth that large tables have; one source holds most rows."""
    monkeypatch.setattr(m, "FAN", 2)
    monkeypatch.setattr(m, "BLOCK", 4)
    rows = [(d, "hot" if d % 10 else f"s{d}", "en", 1, f"Text {d}") for d in range(150)]
    assert result(spark, rows, monkeypatch) == brute(rows, 2)


def test_each_field_is_sealed(spark):
    """A change of any field, also a shift of characters between fields, changes leaf and folded root."""
    docs = spark.createDataFrame(EDGE[:3] + [(9, "ab", "c", 1, "t")], COLUMNS)
    altered = {"doc_id": F.lit(8), "source": F.lit("a"), "lang": F.lit("bc"), "n_chars": F.lit(11), "text": F.lit("T")}
    other = [m.leaf([altered.get(c) if c == x else F.col(c) for c in m.FIELDS]).alias(f"with_{x}") for x in m.FIELDS]
    rows = m.manifest(docs, payload=tuple(other)).where("doc_id = 9")
    checks = [(m.fold(F.col(f"with_{x}"), F.col("path")) != F.col("root")).alias(x) for x in m.FIELDS]
    assert all(rows.select(*checks).first()) and rows.select(m.fold(F.col("leaf"), F.col("path")) == F.col("root")).first()[0]


def test_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*m.FIELDS).collect()
    assert sorted(map(tuple, m.op12_merkle_manifest(spark, "/root/testdata/sf0.001").collect()), key=str) == brute([tuple(r) for r in rows])
