"""The facade with the R package's names, end to end on sf0.001."""

from conftest import SF0001
from tradeflow.api import TradeDB
from tradeflow.fixtures import Fixtures
from tradeflow.sources.lookups import save_lookup
from tradeflow.sources.raw import write_raw_files


def test_tradedb_end_to_end(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    landing = tmp_dir + "/raw"
    for flow in ("export", "import"):
        write_raw_files(fx.raw_files(flow, coarse=False), landing, flow)
    db = TradeDB(spark, tmp_dir + "/db")
    for name, df in (("country", fx.country_lookup()), ("state", fx.state_lookup()), ("product", fx.product_lookup()),
                     ("isic", fx.isic_lookup()), ("unit", fx.unit_lookup())):
        save_lookup(df, db.lookup_dir, name)
    db.create_cs_db(landing, start_year=1997)
    assert sorted(r.year for r in db.total_exports_by_year().collect()) == [1997, 1998, 1999, 2000, 2001]
    assert db.update_cs_db(landing, official="2001-11")["status"] == "current"
    assert [r.year for r in db.available_years().collect()] == [1997, 1998, 1999, 2000, 2001]
    assert db.latest_period().first().period == "2001-11"
    assert [tuple(r) for r in db.refresh_plan("2001-12", 2001).collect()] == [(2001, "refresh")]
    q = db.add_country_name(db.filter_states(db.imports).groupBy("year", "country_code").count(), lang="es")
    assert q.columns == ["year", "count", "country_name_es"]
    n = db.imports.count()
    assert db.add_isic_description(db.add_units(db.add_ncm_description(db.imports)), level="all").count() == n
    assert db.add_state_name(db.imports).columns[-1] == "state_name"
    assert db.total_imports_by_year_month().count() == 59


def test_build_lookups_from_published_files(spark, tmp_dir):
    fx = Fixtures(spark, SF0001)
    sources = {}
    for name, df in (("country", fx.published_country()), ("product", fx.published_product()),
                     ("isic", fx.published_isic()), ("unit", fx.published_unit()), ("state", fx.published_state()),
                     ("bec", fx.published_bec()), ("cuci", fx.published_cuci())):
        path = f"{tmp_dir}/published/{name}"
        df.write.options(sep=";", header="true", encoding="ISO-8859-1").csv(path)
        sources[name] = path
    db = TradeDB(spark, tmp_dir + "/db")
    saved = db.build_lookups(sources)
    assert set(saved) == set(sources)
    assert db.lookup("product").count() == fx.table("part").count()
    assert dict(db.lookup("country").dtypes)["country_code"] == "int"
    assert db.lookup("unit").where("unit_description = 'Net kilogram'").count() > 0


def test_cli_create_update_totals(spark, tmp_dir):
    from tradeflow.cli import main

    fx = Fixtures(spark, SF0001)
    raw = tmp_dir + "/raw"
    write_raw_files(fx.raw_files("export"), raw, "export")
    write_raw_files(fx.raw_files("import"), raw, "import")
    dest = tmp_dir + "/db"
    out = main(["create", "--raw", raw, "--dest", dest], spark=spark)
    assert out["files"] == {"export": 5, "import": 5}  # the published data begin in 1997
    out = main(["update", "--raw", raw, "--dest", dest, "--official", "2001-11", "--current-year", "2001"], spark=spark)
    assert out["status"] == "current"
    with open(tmp_dir + "/updated.json", "w") as f:
        f.write('{"data": {"year": "2001", "monthNumber": "11"}}')
    out = main(["update", "--raw", raw, "--dest", dest, "--official", tmp_dir + "/updated.json",
                "--current-year", "2001"], spark=spark)
    assert out["status"] == "current"
    out = main(["totals", "--dest", dest, "--flow", "import", "--by", "year"], spark=spark)
    assert [r["year"] for r in out["rows"]] == list(range(1997, 2002))


def test_cli_build_lookups(spark, tmp_dir):
    from tradeflow.cli import main

    fx = Fixtures(spark, SF0001)
    args = ["build-lookups", "--dest", tmp_dir + "/db"]
    for name, df in (("country", fx.published_country()), ("unit", fx.published_unit())):
        path = f"{tmp_dir}/published/{name}"
        df.write.options(sep=";", header="true", encoding="ISO-8859-1").csv(path)
        args += ["--source", f"{name}={path}"]
    out = main(args, spark=spark)
    assert set(out["saved"]) == {"country", "unit"}
    assert TradeDB(spark, tmp_dir + "/db").lookup("unit").count() == fx.table("part").count()
