"""Refresh rules: scenarios (a)-(g) of the survey, D2-D5, D9, D14."""

import pytest

from conftest import SF0001
from tradeflow.fixtures import Fixtures
from tradeflow.plans.refresh import (
    available_years,
    is_current,
    latest_period,
    official_period,
    refresh_plan,
    update_store,
)
from tradeflow.plans.store import create_store, flow_path, open_store, write_store
from tradeflow.sources.raw import write_raw_files


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("stores"))
    fx = Fixtures(spark, SF0001)
    write_store(fx.exports(), flow_path(base, "export"), "export")
    write_store(fx.imports(), flow_path(base, "import"), "import")
    return base


def _open(spark, base):
    return open_store(spark, flow_path(base, "export"), "export"), open_store(spark, flow_path(base, "import"), "import")


def plan(spark, e, i, official, current, start=None):
    return [(r.year, r.reason) for r in refresh_plan(e, i, official, current, start).orderBy("year").collect()]


def test_available_and_latest(spark, stores):
    e, i = _open(spark, stores)
    assert [r.year for r in available_years(e).collect()] == list(range(1995, 2002))
    assert latest_period(i).first().period == "2001-11"


def test_current_store_has_empty_plan(spark, stores):  # (a), D9
    e, i = _open(spark, stores)
    assert plan(spark, e, i, "2001-11", 2001) == []


def test_calendar_ahead_of_official(spark, stores):  # (g): capped at the official year
    e, i = _open(spark, stores)
    assert plan(spark, e, i, "2001-11", 2026) == []


def test_new_month_reloads_last_year(spark, stores):  # (b)
    e, i = _open(spark, stores)
    assert plan(spark, e, i, "2001-12", 2001) == [(2001, "refresh")]


def test_new_year(spark, stores):  # (c)
    e, i = _open(spark, stores)
    assert plan(spark, e, i, "2002-01", 2002) == [(2001, "refresh"), (2002, "missing")]


def test_year_in_one_flow_only_and_lag(spark, stores):  # (e), D14
    fx = Fixtures(spark, SF0001)
    e = fx.exports().where("year NOT IN (1997, 2001)")
    _, i = _open(spark, stores)
    assert plan(spark, e, i, "2001-11", 2001) == [(1997, "missing"), (2000, "refresh"), (2001, "missing")]


def test_start_year_bounds(spark, stores):  # (d), (f), D4
    e, i = _open(spark, stores)
    assert plan(spark, e, i, "2001-11", 2001, start=1990) == []  # 1997 is the lower bound; nothing is missing
    assert plan(spark, e, i, "2001-12", 2001, start=2001) == [(2001, "refresh")]


def test_backfill_earlier_start(spark):  # (d)
    fx = Fixtures(spark, SF0001)
    e = fx.exports().where("year >= 1999")
    i = fx.imports().where("year >= 1999")
    # the last local year is loaded again whenever a plan runs (it may be incomplete)
    assert plan(spark, e, i, "2001-11", 2001, start=1997) == [(1997, "missing"), (1998, "missing"), (2001, "refresh")]


def test_official_payload_and_is_current(spark, stores):
    feed = spark.createDataFrame(
        [(1, '{"data":{"year":"2001","monthNumber":"11"}}'), (2, '{"data":{"year":"2002","monthNumber":"3"}}')],
        "id int, payload string",
    )
    off = official_period(feed)
    assert [tuple(r) for r in off.orderBy("id").collect()] == [(1, "2001-11"), (2, "2002-03")]
    odd = spark.createDataFrame([(1, '{"data":{"year":2024,"monthNumber":6}}'), (2, '{"error":"x"}'), (3, "not json")],
                                "id int, payload string")
    assert [r.period for r in official_period(odd).orderBy("id").collect()] == ["2024-06", None, None]
    _, i = _open(spark, stores)
    got = [(r.id, r.is_current) for r in is_current(i, off).orderBy("id").collect()]
    assert got == [(1, True), (2, False)]
    e, _ = _open(spark, stores)
    assert plan(spark, e, i, off, 2002) == [(2001, "refresh"), (2002, "missing")]


def test_update_store_end_to_end(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    landing = tmp_dir + "/landing"
    write_raw_files(fx.raw_files("export"), landing, "export")
    write_raw_files(fx.raw_files("import"), landing, "import")
    base = tmp_dir + "/db"
    with pytest.raises(RuntimeError, match="cannot be read"):
        update_store(spark, landing, base, "2001-11", 2001)
    create_store(spark, landing, base, start_year=1999)
    r1 = update_store(spark, landing, base, "2001-11", 2001, start_year=1997)
    assert r1["status"] == "updated" and r1["years"] == [1997, 1998, 2001]
    r2 = update_store(spark, landing, base, "2001-11", 2001)
    assert r2["status"] == "current" and r2["years"] == []
    r3 = update_store(spark, landing, base, "2002-02", 2002)  # 2002 is planned, but no file has come yet
    assert r3["years"] == [2001, 2002] and r3["missing_files"] == {"export": [2002], "import": [2002]}
    e, i = _open(spark, base)
    assert e.exceptAll(fx.exports().where("year >= 1997")).count() == 0
    assert fx.imports().where("year >= 1997").exceptAll(i).count() == 0


def test_bad_official_period_raises(spark, stores):
    e, i = _open(spark, stores)
    with pytest.raises(ValueError, match="yyyy-mm"):
        refresh_plan(e, i, "2001-13", 2001)
    feed = spark.createDataFrame([(1, '{"error": "unavailable"}')], "id int, payload string")
    with pytest.raises(Exception, match="official period missing"):
        refresh_plan(e, i, official_period(feed), 2001).collect()
