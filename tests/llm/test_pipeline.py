"""The pipeline's stages against brute force, and the package's place in the library."""

import os
import re
import subprocess
import sys
import tempfile

import corpus_pipeline as p
from tradeflow.llm import language, quality
from tradeflow.session import checkpoint_root
from tradeflow.llm.tokens import default_tokenizer  # noqa: F401  (the stages need the installed vocabulary)

from .conftest import EDGE
from .test_neardup import brute as near
from .test_substrings import brute as substrings
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {r.doc_id: r for r in docs.collect()}

    spoken = p.language_id(spark, docs, SF)
    assert spoken.columns == docs.columns
    first = {r.doc_id: r for r in spoken.collect()}
    assert all(given[d] == r for d, r in first.items())
    gone = set(given) - set(first)
    assert all(len(given[d].text or "") < 40 for d in gone)  # only texts with hardly a word
    assert all(any(c.isalpha() for c in r.text) for r in first.values())

    good = p.quality_rules(spark, spoken, SF)
    second = {r.doc_id: r for r in good.collect()}
    rated = {r.row.doc_id: r.kept for r in quality.rate(spoken).collect()}
    assert set(second) == {d for d, kept in rated.items() if kept}

    apart = p.near_duplicates(spark, good, SF)
    third = {r.doc_id: r for r in apart.collect()}
    classes, _ = near([(d, r.text) for d, r in second.items()])
    assert set(third) == {d for d, c in classes.items() if d == c}
    assert all(second[d] == r for d, r in third.items())

    cut = p.substring_dedup(spark, apart, SF)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    fourth = {r.doc_id: r for r in cut.collect()}
    want = {d: (n, removed) for d, n, removed, _ in substrings([(d, r.text) for d, r in third.items()], 13)}
    for d, r in fourth.items():
        n, removed = want[d]
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == n - removed
        assert r.n_chars == len(r.text) and (removed or r.text == third[d].text)
    assert set(fourth) == set(third)

    pieces = p.harmonic_packing(spark, cut, SF).collect()
    assert check_packing([(d, r.text) for d, r in fourth.items()], pieces) < 0.01


def test_run_is_its_stages(spark):
    assert [name for name, _ in p.STAGES] == ["language_id", "quality_rules", "near_duplicates", "substring_dedup", "packing"]
    before = scratch_tables(spark)
    rows = p.run(spark, SF)
    assert {t.rsplit("-", 1)[0] for t in scratch_tables(spark) - before} == {"substring_dedup"}  # the last stage reads it
    assert rows.count() > 0 and {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows.columns)


def scratch_tables(spark):
    root = f"{checkpoint_root(spark)}/llm"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_stages_free_what_their_predecessors_left(spark):
    """As the driver calls them: each stage's rows are written elsewhere before the next stage starts."""
    docs, folder = spark.read.parquet(f"{SF}/documents.parquet"), tempfile.mkdtemp(prefix="stages-")
    p.free(spark, p._SCRATCH)
    for name, work in p.STAGES:
        before = scratch_tables(spark)
        out = work(spark, docs, SF)
        left = scratch_tables(spark)
        assert {os.path.basename(t) for t in p._SCRATCH} <= left
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert not {os.path.basename(t) for t in p._SCRATCH} & before  # those of the stage before are gone
    assert p._SCRATCH == []  # packing leaves none


def test_edge_rows(spark, edge, no_rows):
    """Null and repeated rows, empty texts and clashing names pass every stage."""
    for docs in (edge, no_rows):
        for _, stage in p.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0
    assert language.predict(edge, {}).count() == edge.count()


def test_one_row_of_each_class(spark, edge, no_rows):
    """Null and repeated ids: copies and near copies go, and nothing else."""
    key = lambda r: tuple(map(str, r))
    got = p.near_duplicates(spark, edge, SF)
    assert got.dtypes == edge.dtypes
    assert sorted(map(tuple, got.collect()), key=key) == sorted([EDGE[k] for k in (0, 2, 5, 6, 7, 9)], key=key)
    one, other, third = (" ".join(f"{c}{k}" for k in range(40)) for c in "xyz")
    rows = [(None, one), (None, one), (None, f"{one} end"), (None, other), (5, f"{other} end"), (5, third), (5, third)]
    got = p.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sum(r.doc_id is None for r in got) == 1 and next(r.text for r in got if r.doc_id is None) in (one, f"{one} end")
    assert sorted(r.text for r in got if r.doc_id == 5) == sorted([f"{other} end", third]) and len(got) == 3
    assert p.near_duplicates(spark, no_rows, SF).count() == 0


def test_the_library_does_not_need_this_package():
    code = (
        "import sys, builtins\n"
        "real = builtins.__import__\n"
        "def no(name, *a, **k):\n"
        "    if name == 'corpus_pipeline' or name.startswith('tradeflow.llm'):\n"
        "        raise ModuleNotFoundError(name, name=name)\n"
        "    return real(name, *a, **k)\n"
        "builtins.__import__ = no\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert names and not any(n.startswith('op') and n[2].isdigit() for n in names) and 'pipeline' not in names\n"
        "assert not [m for m in sys.modules if m.startswith('tradeflow.llm')]\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=p.__file__.rsplit("/", 1)[0])
