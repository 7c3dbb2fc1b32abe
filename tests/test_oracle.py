"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate).

All core queries have SQL.  A training-data query without SQL must be held against brute force by a
named test (``tests/llm/brute_force.py``).  Set TRADEFLOW_ORACLE=0 to skip (it runs every query once).
"""

import importlib.util
import os

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_harness import compare, duck
from tradeflow.catalog import ORACLE, QUERIES

NAMES = sorted(set(E.queries()) & set(E.oracle_sql()))
pytestmark = pytest.mark.skipif(os.environ.get("TRADEFLOW_ORACLE") == "0", reason="oracle run disabled")
HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def brute_force_tests() -> dict[str, str]:
    path = f"{HERE}/llm/brute_force.py"
    if not os.path.exists(path):
        return {}
    spec = importlib.util.spec_from_file_location("brute_force", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.TESTS


def test_every_core_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(E.oracle_sql())


def test_every_other_query_has_an_oracle_or_a_brute_force_test():
    named = brute_force_tests()
    assert set(E.queries()) - set(E.oracle_sql()) == set(named)
    for name, where in named.items():
        file, test = where.split("::")
        with open(f"{HERE}/llm/{file}", encoding="utf-8") as f:
            assert f"def {test}(" in f.read(), (name, where)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF001, con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year", "state", "isic_section_desc", "country_name", "fob_value", "cif_value", "kg"]
    assert E.entry(spark).schema == df.schema
