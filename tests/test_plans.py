"""Plan properties of the headline operators (regression guards for PLANS.md)."""

import re

import pytest

from conftest import SF0001
from planutil import plan_text
from tradeflow.fixtures import Fixtures
from tradeflow.operators.enrich import add_isic_description, add_units
from tradeflow.operators.summaries import total_by_year
from tradeflow.plans.refresh import available_years, latest_period, refresh_plan
from tradeflow.plans.reports import imports_by_section
from tradeflow.plans.store import flow_path, open_store, write_store
from tradeflow.sources.lookups import load_lookup, save_lookup


@pytest.fixture(scope="module")
def env(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    fx = Fixtures(spark, SF0001)
    write_store(fx.imports_fine(), flow_path(base, "import"), "import")
    write_store(fx.exports(), flow_path(base, "export"), "export")
    for name, df in (("product", fx.product_lookup()), ("isic", fx.isic_lookup()), ("country", fx.country_lookup()),
                     ("unit", fx.unit_lookup())):
        save_lookup(df, base + "/lk", name)
    lk = {n: load_lookup(spark, base + "/lk", n) for n in ("product", "isic", "country", "unit")}
    return open_store(spark, flow_path(base, "import"), "import"), open_store(spark, flow_path(base, "export"), "export"), lk


def shuffles(plan: str) -> int:
    """Shuffle exchanges in the operator tree (broadcasts are not shuffles)."""
    return len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", plan.split("\n\n\n")[0]))


def test_flagship_one_shuffle_all_broadcast(env):
    imports, _, lk = env
    df = imports_by_section(imports, lk["product"], lk["isic"], lk["country"])
    plan = plan_text(df)
    tree = plan.split("\n\n\n")[0]
    assert tree.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan
    assert shuffles(plan) == 1
    assert "PushedFilters: [In(state" in plan
    df.collect()
    final = plan_text(df)  # after AQE, the joins stay broadcast
    assert "SortMergeJoin" not in final


def test_enrichment_does_not_shuffle_trade_rows(env):
    imports, _, lk = env
    plan = plan_text(add_isic_description(add_units(imports, lk["product"], lk["unit"]), lk["product"], lk["isic"],
                                          level="all"))
    assert shuffles(plan) == 0
    assert plan.split("\n\n\n")[0].count("BroadcastHashJoin") == 4


def test_totals_read_one_column(env):
    _, exports, _ = env
    plan = plan_text(total_by_year(exports))
    assert "ReadSchema: struct<fob_value:bigint>" in plan
    assert plan.count("HashAggregate") >= 2


def test_latest_period_reads_footers(env):
    """A plain store handle: no row is read, the month comes from footers, and no job runs before."""
    imports, exports, _ = env
    plan = plan_text(latest_period(imports))
    assert "PushedAggregation: [MAX(month)]" in plan and "BatchScan parquet" in plan and not re.search(r"(?<!Batch)Scan parquet", plan)
    years = available_years(imports)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in years and "BatchScan" not in years
    plan = plan_text(refresh_plan(exports, imports, "2002-01", current_year=2002))
    assert "Scan" not in plan  # years are missing whatever the last months are


def test_latest_period_of_other_frames_is_a_hash_aggregate_over_month(env):
    imports = env[0].where("month < 6")
    plan = plan_text(latest_period(imports))
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert "ReadSchema: struct<month:int>" in plan
    assert latest_period(imports).first().period == "2001-05" and [r.year for r in available_years(imports).collect()][-1] == 2001



def test_refresh_plan_does_not_rescan_the_store(env):
    imports, exports, _ = env
    plan = plan_text(refresh_plan(exports, imports, "2001-11", 2001))
    assert not re.search(r"(?<!Batch)Scan parquet", plan)  # no row of the store is read
    assert plan.count("BatchScan parquet") and plan.count("PushedAggregation: [MAX(month)]") >= 2
