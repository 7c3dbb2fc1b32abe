"""Enrichment joins and the state filter (D1, D7, D15-D18, D22)."""

import pytest

from planutil import plan_text
from tradeflow.operators.enrich import (
    add_country_name,
    add_isic_description,
    add_product_description,
    add_state_name,
    add_units,
    filter_states,
)

COUNTRY = "country_code int, country_name_pt string, country_name string, country_name_es string"


@pytest.fixture()
def country(spark):
    return spark.createDataFrame(
        [(20, "Bahamas pt", "Bahamas", "Bahamas es"), (23, "Alemanha", "Germany", "Alemania"),
         (None, "sem pais", "no country", "sin pais")],
        COUNTRY,
    )


def test_reference_example_country_pt(spark, country):
    df = spark.createDataFrame([(20,), (23,), (40,)], "country_code int")
    out = add_country_name(df, country, lang="pt")
    assert out.columns == ["country_name_pt"]
    assert sorted(r[0] or "" for r in out.collect()) == ["", "Alemanha", "Bahamas pt"]


def test_null_key_matches_null_key(spark, country):
    df = spark.createDataFrame([(None, 1), (20, 2)], "country_code int, v int")
    out = add_country_name(df, country, drop_key=False)
    got = {r.v: r.country_name for r in out.collect()}
    assert got == {1: "no country", 2: "Bahamas"}
    assert out.columns == ["country_code", "v", "country_name"]


def test_broadcast_join_no_shuffle_of_input(spark, country, tmp_dir):
    from tradeflow.sources.lookups import load_lookup, save_lookup

    save_lookup(country, tmp_dir, "country")
    country = load_lookup(spark, tmp_dir, "country")  # a saved lookup has a known size
    df = spark.range(1000).selectExpr("CAST(id % 30 AS INT) AS country_code", "id AS v")
    plan = plan_text(add_country_name(df, country))
    assert "BroadcastHashJoin" in plan
    assert "LeftOuter" in plan


def test_missing_key_column_raises(spark, country):
    df = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(ValueError, match="'country_code' column does not exist"):
        add_country_name(df, country)


def test_name_clash_raises(spark, country):
    df = spark.createDataFrame([(20, "x")], "country_code int, country_name string")
    with pytest.raises(ValueError, match="already exist"):
        add_country_name(df, country)


def test_lang_is_exact(spark, country):
    df = spark.createDataFrame([(20,)], "country_code int")
    with pytest.raises(ValueError):
        add_country_name(df, country, lang="p")
    with pytest.raises(ValueError):
        add_units(df, country, country, lang="es")


def test_filter_states_reference_example(spark):
    df = spark.createDataFrame([("SP", 1), ("RJ", 2), ("ND", 3), (None, 4)], "state string, value int")
    assert sorted(r.state for r in filter_states(df).collect()) == ["RJ", "SP"]
    with pytest.raises(ValueError, match="'state' column does not exist"):
        filter_states(df.drop("state"))


def test_filter_states_pushed_to_parquet(spark, tmp_dir):
    spark.createDataFrame([("SP", 1), ("ND", 2)], "state string, v int").write.parquet(tmp_dir + "/t")
    plan = plan_text(filter_states(spark.read.parquet(tmp_dir + "/t")))
    assert "PushedFilters: [In(state" in plan or "In(state" in plan


def test_state_name(spark):
    state = spark.createDataFrame([("SP", "Sao Paulo")], "state string, state_name string")
    df = spark.createDataFrame([("SP", 1), ("XX", 2)], "state string, v int")
    out = add_state_name(df, state)
    assert out.columns == ["v", "state_name"]
    assert {r.v: r.state_name for r in out.collect()} == {1: "Sao Paulo", 2: None}


PRODUCT = ("ncm string, unit_code int, co_cuci_item string, bec_n3_code int, co_siit int, isic_class_code int, "
           "ncm_description string, ncm_description_pt string, ncm_description_es string")


@pytest.fixture()
def product(spark):
    return spark.createDataFrame(
        [("00000001", 10, "Q1", 100, 1, 5, "one", "um", "uno"), ("00000002", 11, "Q2", 101, 2, None, "two", "dois", "dos")],
        PRODUCT,
    )


def test_product_description_joins_on_ncm(spark, product):
    df = spark.createDataFrame([("00000001", 7), ("00000009", 8)], "ncm string, v int")
    out = add_product_description(df, product, lang="es")
    assert out.columns == ["ncm", "v", "ncm_description_es"]
    assert {r.v: r.ncm_description_es for r in out.collect()} == {7: "uno", 8: None}
    assert add_product_description(df, product, drop_key=True).columns == ["v", "ncm_description"]


def test_units_two_joins(spark, product):
    unit = spark.createDataFrame([(10, "Quilograma liquido", "KG", "Net kilogram")],
                                 "unit_code int, unit_description_pt string, sg_unid string, unit_description string")
    df = spark.createDataFrame([("00000001", 7), ("00000002", 8)], "ncm string, v int")
    out = add_units(df, product, unit)
    assert out.columns == ["ncm", "v", "unit_description"]
    assert {r.v: r.unit_description for r in out.collect()} == {7: "Net kilogram", 8: None}
    assert add_units(df, product, unit, lang="pt", drop_key=False).columns == ["ncm", "v", "unit_code", "unit_description_pt"]


def test_isic_levels(spark, product):
    cols = []
    for lv in ("class", "group", "division", "section"):
        cols += [f"isic_{lv}_code {'string' if lv == 'section' else 'int'}", f"isic_{lv}_desc_pt string",
                 f"isic_{lv}_desc string", f"isic_{lv}_desc_es string"]
    isic = spark.createDataFrame(
        [(5, "c5pt", "c5", "c5es", 1, "g1pt", "g1", "g1es", 0, "d0pt", "d0", "d0es", "A", "sApt", "sA", "sAes"),
         (None, "ncpt", "nc", "nces", None, "ngpt", "ng", "nges", None, "ndpt", "nd", "ndes", None, "nspt", "ns", "nses")],
        ", ".join(cols),
    )
    df = spark.createDataFrame([("00000001", 7), ("00000002", 8), ("99999999", 9)], "ncm string, v int")
    all_ = add_isic_description(df, product, isic, level="all")
    assert all_.columns == ["ncm", "v", "isic_class_desc", "isic_group_desc", "isic_division_desc", "isic_section_desc"]
    got = {r.v: r.isic_section_desc for r in all_.collect()}
    # a null class, and an unknown product (null class after the first join), find the null-key row
    assert got == {7: "sA", 8: "ns", 9: "ns"}
    pt = add_isic_description(df, product, isic, lang="pt", level="group", drop_key=False)
    assert pt.columns == ["ncm", "v", "isic_class_code", "isic_group_desc_pt"]
    with pytest.raises(ValueError):
        add_isic_description(df, product, isic, level="sector")


def test_row_count_kept(spark, product, country):
    from tradeflow.fixtures import Fixtures
    from tradeflow.operators.normalise import normalise_imports
    from conftest import SF0001

    fx = Fixtures(spark, SF0001)
    imp = normalise_imports(fx.raw())
    n = imp.count()
    out = add_isic_description(add_units(imp, fx.product_lookup(), fx.unit_lookup()), fx.product_lookup(), fx.isic_lookup(), level="all")
    assert out.count() == n
    assert out.agg({"fob_value": "sum"}).first()[0] == imp.agg({"fob_value": "sum"}).first()[0]


def test_lookup_beyond_the_size_bound_is_not_broadcast(spark, country):
    import tradeflow.operators.enrich as enrich

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("CAST(id % 30 AS INT) AS country_code", "id AS v")
        out = enrich.add_country_name(df, country, drop_key=False)
        plan = plan_text(out)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("\n\n\n")[0]
        assert out.count() == 100
        assert {r.country_code: r.country_name for r in out.collect()}[20] == "Bahamas"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_building_an_enrichment_starts_no_job(spark, country):
    import tradeflow.operators.enrich as enrich

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job is expected")
    try:
        enrich.add_country_name(spark.range(9).selectExpr("CAST(id AS INT) AS country_code"), country, drop_key=False)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_null_key_is_split_by_aqe_on_the_shuffle_path(spark):
    from pyspark.sql import functions as F

    import tradeflow.operators.enrich as enrich

    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        # a third of the trade rows carry a null country code
        df = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("int")).alias("country_code"),
            F.col("id").alias("v"))
        country = spark.range(50).select(F.col("id").cast("int").alias("country_code"),
                                         F.concat(F.lit("c"), F.col("id").cast("string")).alias("country_name"))
        country = country.unionByName(spark.createDataFrame([(None, "none")], "country_code int, country_name string"))
        out = enrich.add_country_name(df, country, drop_key=False)
        rows = out.collect()
        assert len(rows) == 60000 and sum(r.country_name == "none" for r in rows) == 20000
        final = plan_text(out, "simple")
        assert "isFinalPlan=true" in final and "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
