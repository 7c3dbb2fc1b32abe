"""Registered queries that read or write files: raw CSV, lookups, the store and its refresh.

Each query lays out its input below a new folder of the session's shared
checkpoint folder (raw files as the portal publishes them, a store written by
``write_store``), runs the operator, and returns a lazy frame over the result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tradeflow.catalog import EXP, IMP, register
from tradeflow.fixtures import Fixtures
from tradeflow.oracle_sql import _normalised, with_views
from tradeflow.plans.ledger import files_digest
from tradeflow.plans.refresh import (
    available_years,
    is_current,
    latest_period,
    official_period,
    refresh_plan,
    update_store,
)
from tradeflow.plans.store import create_store, delete, flow_path, open_store, rows_of_code, stored_years, write_store
from tradeflow.schemas import BRAZILIAN_STATES, LOOKUP_RENAMES, RAW_RENAMES, UNIT_TRANSLATIONS
from tradeflow.session import scratch_dir
from tradeflow.sources.links import discover_files, find_table_links
from tradeflow.sources.lookups import (
    build_bec_lookup,
    build_country_lookup,
    build_cuci_lookup,
    build_isic_lookup,
    build_product_lookup,
    build_state_lookup,
    build_unit_lookup,
    load_lookup,
    read_lookup,
    save_lookup,
)
from tradeflow.sources.names import clean_column_names, rename_known_columns
from tradeflow.sources.raw import list_files, read_raw, route_of, with_file_route, write_raw_files

RAW_SQL = {
    "export": "year AS CO_ANO, month AS CO_MES, ncm AS CO_NCM, state AS SG_UF_NCM, country_code AS CO_PAIS, "
    "kg AS KG_LIQUIDO, qty AS QT_ESTAT, fob_value AS VL_FOB",
}
RAW_SQL["import"] = RAW_SQL["export"] + ", freight AS VL_FRETE, insurance AS VL_SEGURO"


def _landing(spark, d, flows=("export", "import"), mixed: bool = True):
    """Raw files written from the fixture rows; returns the landing folder.

    With ``mixed`` the files before 1998 have a legacy column order and the
    later ones the published order with extra columns, so a load reads two
    header layouts and must pick columns by name.
    """
    fx = Fixtures(spark, d)
    landing = scratch_dir(spark, "landing")
    for flow in flows:
        if mixed:
            write_raw_files(fx.raw_files(flow, layout="legacy").where("CO_ANO < 1998"), landing, flow)
            write_raw_files(fx.raw_files(flow, layout="published").where("CO_ANO >= 1998"), landing, flow)
        else:
            write_raw_files(fx.raw_files(flow), landing, flow)
    return landing


# ---------------------------------------------------------------- raw files
for _flow in ("import", "export"):
    def _q(spark, d, _flow=_flow):
        return read_raw(spark, _landing(spark, d, (_flow,)), _flow)

    register("read_raw" + ("" if _flow == "import" else "_exports"),
             with_views(f"SELECT {RAW_SQL[_flow]} FROM raw_coarse", "raw_coarse"))(_q)


@register("read_raw_shared_layout", with_views(f"SELECT {RAW_SQL['import']} FROM raw_coarse", "raw_coarse"))
def q_read_raw_shared(spark, d):
    return read_raw(spark, _landing(spark, d, ("import",), mixed=False), "import", layout="shared")


@register(
    "file_route",
    with_views(
        "SELECT flow, file_year, count(*) AS n_rows FROM ("
        "SELECT 'imp' AS flow, year AS file_year FROM raw_coarse UNION ALL "
        "SELECT 'exp' AS flow, year AS file_year FROM raw_coarse) t GROUP BY flow, file_year",
        "raw_coarse",
    ),
)
def q_file_route(spark, d):
    landing = _landing(spark, d)
    parts = [
        with_file_route(read_raw(spark, landing, flow, keep_file=True)).select("flow", "file_year")
        for flow in ("import", "export")
    ]
    rows = parts[0].unionByName(parts[1])
    return rows.groupBy("flow", "file_year").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "clean_columns",
    with_views(f"SELECT {RAW_SQL['import'].replace(' AS ', ' AS _').lower()} FROM raw_coarse", "raw_coarse"),
)
def q_clean_columns(spark, d):
    fx = Fixtures(spark, d)
    # Mixed-style header names, as some published files have.
    styled = fx.raw_files("import").toDF(
        "CO_ANO", "CoMes", "co ncm", "SG_UF_NCM", "CO_PAIS", "KG_LIQUIDO", "QT.ESTAT", "VL_FOB", "VL_FRETE",
        "VL_SEGURO",
    )
    return clean_column_names(styled).withColumnsRenamed({c: "_" + c for c in (
        "co_ano", "co_mes", "co_ncm", "sg_uf_ncm", "co_pais", "kg_liquido", "qt_estat", "vl_fob", "vl_frete",
        "vl_seguro")})


@register("rename_known", with_views("SELECT * FROM raw_coarse", "raw_coarse"))
def q_rename_known(spark, d):
    raw = clean_column_names(Fixtures(spark, d).raw_files("import"))
    return rename_known_columns(rename_known_columns(raw, RAW_RENAMES), LOOKUP_RENAMES)


# ---------------------------------------------------------------- lookups
def _csv(df, path):
    df.write.mode("overwrite").options(sep=";", header="true", encoding="ISO-8859-1", nullValue="NA").csv(path)
    return path


@register("read_lookup", with_views("SELECT * FROM country_lookup", "country_lookup"))
def q_read_lookup(spark, d):
    path = _csv(Fixtures(spark, d).published_country(), scratch_dir(spark, "lookup-csv"))
    return read_lookup(spark, path, "country")


@register(
    "read_lookup_quoted",
    """SELECT CAST(p_partkey AS INT) AS country_code, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_name END AS country_name_pt,
  p_name || ' "' || p_brand || '"; ' || p_type || chr(10) || 'end' AS country_name,
  CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS country_name_es FROM part""",
)
def q_read_lookup_quoted(spark, d):
    """Doubled quotes, separators and line breaks in text, NA and blanks."""
    p = Fixtures(spark, d).table("part")
    df = p.select(
        F.col("p_partkey").alias("CO_PAIS"),
        F.when(F.col("p_size") % 7 == 0, "NA").otherwise(F.col("p_name")).alias("NO_PAIS"),
        F.concat("p_name", F.lit(' "'), "p_brand", F.lit('"; '), "p_type", F.lit("\nend")).alias("NO_PAIS_ING"),
        F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_brand")).alias("NO_PAIS_ESP"),
    )
    path = scratch_dir(spark, "lookup-csv")
    df.write.options(sep=";", header="true", encoding="ISO-8859-1", escape='"', emptyValue="").csv(path)
    return read_lookup(spark, path, "country")


def _prepared(df):
    return rename_known_columns(clean_column_names(df), LOOKUP_RENAMES)


@register("lookup_state", "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS state, s_name AS state_name FROM supplier")
def q_lookup_state(spark, d):
    return build_state_lookup(_prepared(Fixtures(spark, d).published_state()))


@register("lookup_country", with_views("SELECT * FROM country_lookup", "country_lookup"))
def q_lookup_country(spark, d):
    return build_country_lookup(_prepared(Fixtures(spark, d).published_country()))


PRODUCT_ALL_SQL = """
SELECT DISTINCT lpad(CAST(p_partkey AS VARCHAR),8,'0') AS ncm, CAST(10 + p_size % 16 AS INT) AS unit_code,
  'Q' || CAST(p_size AS VARCHAR) AS co_cuci_item, CAST(100 + p_size % 19 AS INT) AS bec_n3_code,
  CAST(1000 + p_size AS INT) AS co_siit, CAST(p_size AS INT) AS isic_class_code, p_name AS ncm_description,
  'pt ' || p_name AS ncm_description_pt, 'es ' || p_name AS ncm_description_es
FROM part"""


@register("lookup_product", PRODUCT_ALL_SQL)
def q_lookup_product(spark, d):
    return build_product_lookup(_prepared(Fixtures(spark, d).published_product()))


@register("lookup_isic", with_views("SELECT * FROM isic_lookup", "isic_lookup"))
def q_lookup_isic(spark, d):
    return build_isic_lookup(_prepared(Fixtures(spark, d).published_isic()))


@register("lookup_bec", with_views("SELECT * FROM bec_lookup", "bec_lookup"))
def q_lookup_bec(spark, d):
    return build_bec_lookup(_prepared(Fixtures(spark, d).published_bec()))


_SENTENCE = "upper(substr(no_unid,1,1)) || lower(substr(no_unid,2))"
_TRANSLATE = " ".join(f"WHEN '{pt}' THEN '{en}'" for pt, en in UNIT_TRANSLATIONS.items())


@register(
    "lookup_unit",
    with_views(
        f"SELECT CAST(co_unid AS INT) AS unit_code, {_SENTENCE} AS unit_description_pt, "
        r"trim(regexp_replace(sg_unid, '\s+', ' ', 'g')) AS sg_unid, "
        f"CASE {_SENTENCE} {_TRANSLATE} END AS unit_description FROM unit_raw",
        "unit_raw",
    ),
)
def q_lookup_unit(spark, d):
    return build_unit_lookup(Fixtures(spark, d).published_unit())


@register(
    "lookup_cuci",
    """SELECT DISTINCT 'Q' || CAST(p_size AS VARCHAR) AS co_cuci_item, 'item ' || CAST(p_size AS VARCHAR) AS no_cuci_item,
  'sub ' || CAST(CAST(floor(p_size / 2.0) AS INT) AS VARCHAR) AS no_cuci_sub,
  'grupo ' || CAST(CAST(floor(p_size / 5.0) AS INT) AS VARCHAR) AS no_cuci_grupo,
  'divisao ' || CAST(CAST(floor(p_size / 10.0) AS INT) AS VARCHAR) AS no_cuci_divisao,
  'secao ' || CAST(CAST(floor(p_size / 25.0) AS INT) AS VARCHAR) AS no_cuci_sec FROM part""",
)
def q_lookup_cuci(spark, d):
    return build_cuci_lookup(_prepared(Fixtures(spark, d).published_cuci()))


@register("lookup_roundtrip", with_views("SELECT * FROM product_lookup", "product_lookup"))
def q_lookup_roundtrip(spark, d):
    base = scratch_dir(spark, "lookups")
    save_lookup(Fixtures(spark, d).product_lookup(), base, "product")
    return load_lookup(spark, base, "product")


@register(
    "lookup_key_check",
    with_views("SELECT count(*) AS n_rows, count(DISTINCT ncm) AS n_keys FROM product_lookup", "product_lookup"),
)
def q_lookup_key_check(spark, d):
    from tradeflow.sources.lookups import duplicate_keys

    p = Fixtures(spark, d).product_lookup()
    dup = duplicate_keys(p, "product").agg(F.count(F.lit(1)).alias("n_dup")).scalar()
    return p.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ncm").alias("n_keys")).where(dup == 0)


# ---------------------------------------------------------------- links
@register(
    "discover_files",
    r"""SELECT page_id, url, href,
  CAST(nullif(regexp_extract(regexp_extract(href, '([^/?#]*)([?#].*)?$', 1), '[0-9]{4}', 0), '') AS INT) AS link_year
FROM (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages) t
WHERE regexp_matches(href, '^/[a-z]') AND NOT regexp_matches(href, 'tion|ment')""",
)
def q_discover_files(spark, d):
    pages = Fixtures(spark, d).table("pages")
    return discover_files(pages, include="^/[a-z]", exclude="tion|ment")


def _portal(spark, d):
    """A portal page for each order: a link to its year's file in a table cell, and links that do not count."""
    o = Fixtures(spark, d).table("orders").select(F.col("o_orderkey").cast("string").alias("k"), F.year("o_orderdate").cast("string").alias("y"))
    html = F.concat(
        F.lit("<p><a href='/ncm/EXP_1900.csv'>no cell</a></p><TABLE class=x><TR><TD><A title=y HREF = '/ncm/EXP_"), "y", F.lit("_"), "k",
        F.lit(".csv?a=1&amp;b=2'>file</A><!-- <a href=\"/ncm/EXP_"), "y", F.lit("_0.csv\">old</a> --></TD><td><a data-href=no href=/ncm/IMP_"),
        "y", F.lit("_COMPLETA.csv>all</a> <a href=\"/tab/PAIS.csv\">countries</a></td></TR></TABLE>"),
    )
    return o.select(F.col("k").cast("bigint").alias("page_id"), html.alias("html"))


def _portal_sql(where: str) -> str:
    return f"""SELECT CAST(o_orderkey AS BIGINT) AS page_id, '/ncm/EXP_' || year(o_orderdate) || '_' || o_orderkey || '.csv?a=1&b=2' AS href,
  CAST(year(o_orderdate) AS INT) AS link_year FROM orders WHERE {where}"""


@register("discover_files_portal", _portal_sql("TRUE"))
def q_discover_files_portal(spark, d):
    return discover_files(_portal(spark, d), css_scope="table tr td a")


@register("discover_files_years", _portal_sql("year(o_orderdate) IN (1993, 1996)"))
def q_discover_files_years(spark, d):
    return discover_files(_portal(spark, d), years=[1993, 1996], css_scope="table tr td a")


@register("discover_files_planned", with_views(_portal_sql("year(o_orderdate) IN (SELECT year FROM exports)"), "exports"))
def q_discover_files_planned(spark, d):
    planned = Fixtures(spark, d).exports().select("year").distinct()
    return discover_files(_portal(spark, d), years=planned, css_scope="table tr td a")


@register(
    "discover_files_selector",
    """SELECT CAST(o_orderkey AS BIGINT) AS page_id, '/ncm/' || f || '_' || year(o_orderdate) || '.csv?n=' || o_orderkey AS href,
  CAST(year(o_orderdate) AS INT) AS link_year FROM orders, (VALUES ('EXP'), ('IMP')) v(f)""",
)
def q_discover_files_selector(spark, d):
    """List items without end tags in the wanted division; scripts, comments, other divisions and deeper anchors do not count."""
    o = Fixtures(spark, d).table("orders").select(F.col("o_orderkey").cast("string").alias("k"), F.year("o_orderdate").cast("string").alias("y"))
    link = lambda flow, kind: F.concat(F.lit(f"<a class={kind} href=\"&#47;ncm/{flow}_"), "y", F.lit(".csv?n="), "k", F.lit("\">file</a>"))
    html = F.concat(
        F.lit("<div class='box files'><ul><li>"), link("EXP", "raw"), F.lit("<li>"), link("IMP", "'new raw'"), F.lit("<li><b>"), link("EXP", "raw"),
        F.lit("</b></ul></div><script>'<div class=files><li>"), link("OLD", "raw"), F.lit("'</script><!-- <div class=files><li>"), link("GONE", "raw"),
        F.lit(" --><div class=old><li>"), link("EXP", "raw"), F.lit("</div><div class=files><ol><li>"), link("IMP", "other"), F.lit("</ol></div>"),
    )
    return discover_files(o.select(F.col("k").cast("bigint").alias("page_id"), html.alias("html")), css_scope="div.files li > a.raw")


@register("find_table_links", "SELECT CAST(o_orderkey AS BIGINT) AS page_id, '/tab/PAIS.csv' AS href, CAST(NULL AS INT) AS link_year FROM orders")
def q_find_table_links(spark, d):
    return find_table_links(_portal(spark, d), "PAIS")


# ---------------------------------------------------------------- store
def _store(spark, d, exports=None, imports=None):
    base = scratch_dir(spark, "store")
    fx = Fixtures(spark, d)
    write_store(exports if exports is not None else fx.exports(), flow_path(base, "export"), "export")
    write_store(imports if imports is not None else fx.imports(), flow_path(base, "import"), "import")
    return base


@register("open_store", with_views(f"SELECT {EXP} FROM exports", "exports"))
def q_open_store(spark, d):
    base = _store(spark, d)
    return open_store(spark, flow_path(base, "export"), "export")


@register("store_rows_of_code", with_views(f"SELECT {IMP} FROM imports WHERE ncm IN ('00000007', '00000100', '90000053')", "imports"))
def q_store_rows_of_code(spark, d):
    """Point lookups by product code in a store with Bloom filters on it."""
    path = flow_path(scratch_dir(spark, "store"), "import")
    write_store(Fixtures(spark, d).imports(), path, "import", bloom={"ncm": 20_000})
    return rows_of_code(open_store(spark, path, "import"), "7", "100", "90000053")


@register("open_store_checked", with_views(f"SELECT {EXP} FROM exports", "exports"))
def q_open_store_checked(spark, d):
    return open_store(spark, flow_path(_store(spark, d), "export"), "export", check=True)


@register(
    "store_schema_problems",
    with_views("SELECT DISTINCT e.year, p.column, p.problem FROM exports e JOIN (VALUES (1995, 'qty', 'missing'), (1995, 'quantity', 'unknown'), "
               "(1997, 'month', 'type string'), (1998, 'kg', 'missing')) p(year, column, problem) ON p.year = e.year", "exports")
    .replace("p(year, column, problem)", 'p(year, "column", problem)').replace("p.column", 'p."column"'),
)
def q_store_schema_problems(spark, d):
    """Three years written by other tools: a renamed column, another type, a column left out."""
    from tradeflow.plans.store import schema_problems

    path = flow_path(_store(spark, d), "export")
    rows = Fixtures(spark, d).exports()
    for year, odd in (
        (1995, rows.withColumnRenamed("qty", "quantity")), (1997, rows.withColumn("month", F.col("month").cast("string"))), (1998, rows.drop("kg")),
    ):
        odd.where(F.col("year") == year).drop("year").write.mode("overwrite").parquet(f"{path}/year={year}")
    return schema_problems(spark, path, "export")


@register("store_replace_year", with_views(f"SELECT {IMP} FROM imports WHERE year <> 1995 OR month = 1", "imports"))
def q_store_replace_year(spark, d):
    fx = Fixtures(spark, d)
    base = _store(spark, d)
    path = flow_path(base, "import")
    write_store(fx.imports().where("year = 1995 AND month = 1"), path, "import")
    write_store(fx.imports().where(F.lit(False)), path, "import")  # an empty frame replaces nothing
    return open_store(spark, path, "import")


for _flow, _view, _cols in (("import", "imports", IMP), ("export", "exports", EXP)):
    def _q(spark, d, _flow=_flow):
        landing = _landing(spark, d)
        base = scratch_dir(spark, "store")
        create_store(spark, landing, base)
        return open_store(spark, flow_path(base, _flow), _flow)

    register("create_store" + ("" if _flow == "import" else "_exports"),
             with_views(f"SELECT {_cols} FROM {_view}", _view))(_q)


@register("create_store_start_year", with_views(f"SELECT {EXP} FROM exports WHERE year >= 1998", "exports"))
def q_create_store_start_year(spark, d):
    landing = _landing(spark, d)
    base = scratch_dir(spark, "store")
    create_store(spark, landing, base, start_year=1998)
    return open_store(spark, flow_path(base, "export"), "export")


@register("available_years", with_views("SELECT DISTINCT year FROM exports", "exports"))
def q_available_years(spark, d):
    base = _store(spark, d)
    return available_years(open_store(spark, flow_path(base, "export"), "export"))


_LATEST = "max(CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0'))"


@register("latest_period", with_views(f"SELECT {_LATEST} AS period FROM imports", "imports"))
def q_latest_period(spark, d):
    base = _store(spark, d)
    return latest_period(open_store(spark, flow_path(base, "import"), "import"))


_OFFICIAL = (
    "SELECT id, json_extract_string(payload, '$.data.year') || '-' || "
    "lpad(json_extract_string(payload, '$.data.monthNumber'), 2, '0') AS period FROM official_feed"
)


@register("official_period", with_views(_OFFICIAL, "official_feed"))
def q_official_period(spark, d):
    return official_period(Fixtures(spark, d).official_feed())


@register(
    "is_current",
    with_views(
        f"SELECT o.id, o.period, l.local_period, o.period = l.local_period AS is_current "
        f"FROM ({_OFFICIAL}) o, (SELECT {_LATEST} AS local_period FROM imports) l",
        "official_feed", "imports",
    ),
)
def q_is_current(spark, d):
    base = _store(spark, d)
    store = open_store(spark, flow_path(base, "import"), "import")
    return is_current(store, official_period(Fixtures(spark, d).official_feed()))


def _plan_sql(official: str, current_year: int, exports_where: str = "TRUE", views=(), start: str | None = None) -> str:
    """The year plan in SQL; ``official`` is a SQL expression giving 'yyyy-mm', ``start`` the first year wanted."""
    start = start or "least((SELECT min(year) FROM e), (SELECT min(year) FROM i))"
    download = f"""
SELECT year FROM (SELECT CAST(y AS INT) AS year FROM range(1997, {current_year + 1}) t(y)) r, p
WHERE year BETWEEN p.start_y AND p.stop_y
EXCEPT
SELECT year FROM b, p WHERE NOT (year BETWEEN p.local_last AND p.off_y)"""
    params = f"""
SELECT greatest({start}, 1997) AS start_y,
  least({current_year}, CAST(substr(o.period, 1, 4) AS INT)) AS stop_y,
  least((SELECT max(year) FROM e), (SELECT max(year) FROM i)) AS local_last,
  CAST(substr(o.period, 1, 4) AS INT) AS off_y, o.period AS off_period
FROM (SELECT {official} AS period) o"""
    return with_views(
        """
SELECT dl.year, CASE WHEN b.year IS NULL THEN 'missing' ELSE 'refresh' END AS reason
FROM dl LEFT JOIN b ON dl.year = b.year, p
WHERE NOT (
  coalesce((SELECT period FROM le) = p.off_period AND (SELECT period FROM li) = p.off_period, false)
  AND NOT coalesce((SELECT bool_or(year <> p.off_y) FROM dl), false))""",
        "exports", "imports", *views,
        extra=(
            ("ex", f"SELECT * FROM exports WHERE {exports_where}"),
            ("e", "SELECT DISTINCT year FROM ex"),
            ("i", "SELECT DISTINCT year FROM imports"),
            ("b", "SELECT year FROM e INTERSECT SELECT year FROM i"),
            ("le", f"SELECT {_LATEST} AS period FROM ex"),
            ("li", f"SELECT {_LATEST} AS period FROM imports"),
            ("p", params),
            ("dl", download),
        ),
    )


@register("refresh_plan", _plan_sql("'2002-03'", 2002, "year <> 1997"))
def q_refresh_plan(spark, d):
    fx = Fixtures(spark, d)
    base = _store(spark, d, exports=fx.exports().where("year <> 1997"))
    e = open_store(spark, flow_path(base, "export"), "export")
    i = open_store(spark, flow_path(base, "import"), "import")
    return refresh_plan(e, i, "2002-03", current_year=2002)


for _name, _start in (("refresh_plan_start_year", 2000), ("refresh_plan_start_before_data", 1990)):
    def _q(spark, d, _start=_start):
        fx = Fixtures(spark, d)
        base = _store(spark, d, exports=fx.exports().where("year <> 1997"))
        e = open_store(spark, flow_path(base, "export"), "export")
        i = open_store(spark, flow_path(base, "import"), "import")
        years = {flow: stored_years(spark, flow_path(base, flow)) for flow in ("export", "import")}
        return refresh_plan(e, i, "2002-03", current_year=2002, start_year=_start, years=years)

    register(_name, _plan_sql("'2002-03'", 2002, "year <> 1997", start=str(_start)))(_q)


@register("refresh_plan_current", _plan_sql(f"(SELECT max(period) FROM ({_OFFICIAL}) f)", 2001, views=("official_feed",)))
def q_refresh_plan_current(spark, d):
    base = _store(spark, d)
    e = open_store(spark, flow_path(base, "export"), "export")
    i = open_store(spark, flow_path(base, "import"), "import")
    official = official_period(Fixtures(spark, d).official_feed())
    return refresh_plan(e, i, official, current_year=2001)


def _updated(spark, d):
    fx = Fixtures(spark, d)
    landing = _landing(spark, d)
    base = scratch_dir(spark, "store")
    # Exports stopped early: 1997 never loaded and 2001 only to June.
    create_store(spark, landing, base, flows=("import",))
    write_store(fx.exports().where("year <> 1997 AND (year < 2001 OR month <= 6)"),
                flow_path(base, "export"), "export")
    official = official_period(fx.official_feed())
    result = update_store(spark, landing, base, official, current_year=2001)
    if result["status"] != "updated":
        raise AssertionError(f"unexpected update: {result}")
    return base


@register("update_store", with_views(f"SELECT {EXP} FROM exports", "exports"))
def q_update_store(spark, d):
    return open_store(spark, flow_path(_updated(spark, d), "export"), "export")


@register("update_store_imports", with_views(f"SELECT {IMP} FROM imports", "imports"))
def q_update_store_imports(spark, d):
    return open_store(spark, flow_path(_updated(spark, d), "import"), "import")


# ---------------------------------------------------------------- streaming
@register("stream_ingest", with_views(f"SELECT {IMP} FROM imports", "imports"))
def q_stream_ingest(spark, d):
    from tradeflow.streaming.landing import run_ingest_once

    landing = _landing(spark, d, ("import",))
    base = scratch_dir(spark, "store")
    run_ingest_once(spark, landing, base, scratch_dir(spark, "stream-checkpoint"))
    return open_store(spark, flow_path(base, "import"), "import")


@register("stream_ingest_republished", with_views(f"SELECT {IMP} FROM imports", "imports"))
def q_stream_ingest_republished(spark, d):
    """The files of all years are published with half of their months, loaded, and published again whole."""
    from tradeflow.streaming.landing import run_ingest_once

    raw = Fixtures(spark, d).raw_files("import")
    landing, base, seen = (scratch_dir(spark, x) for x in ("landing", "store", "stream-checkpoint"))
    write_raw_files(raw.where("CO_MES <= 6"), landing, "import")
    run_ingest_once(spark, landing, base, seen)
    folder = spark._jvm.org.apache.hadoop.fs.Path(landing)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    write_raw_files(raw, landing, "import")
    run_ingest_once(spark, landing, base, seen)
    return open_store(spark, flow_path(base, "import"), "import")


# ---------------------------------------------------------------- the documented queries, over a created store
def _created_store(spark, d):
    landing = _landing(spark, d)
    base = scratch_dir(spark, "store")
    create_store(spark, landing, base)
    return base


@register(
    "store_total_exports_by_year",
    with_views("SELECT year, CASE WHEN count(fob_value) = count(*) THEN CAST(sum(fob_value) AS BIGINT) END AS value "
               "FROM exports GROUP BY year", "exports"),
)
def q_store_total_exports_by_year(spark, d):
    from tradeflow.operators.summaries import total_by_year

    base = _created_store(spark, d)
    return total_by_year(open_store(spark, flow_path(base, "export"), "export"))


@register(
    "store_total_imports_by_year_month",
    with_views("SELECT year, month, CASE WHEN count(fob_value) = count(*) THEN CAST(sum(fob_value) AS BIGINT) END "
               "AS value FROM imports GROUP BY year, month", "imports"),
)
def q_store_total_imports_by_year_month(spark, d):
    from tradeflow.operators.summaries import total_by_year_month

    base = _created_store(spark, d)
    return total_by_year_month(open_store(spark, flow_path(base, "import"), "import"))


# ---------------------------------------------------------------- the ledger beside the store
def _ledger_sql(flow: str) -> str:
    cif = "CAST(sum(cif_value) AS BIGINT)" if flow == "import" else "CAST(NULL AS BIGINT)"
    return f'''SELECT '{flow}' AS flow, s.year, r.raw_rows, s.n_rows, s.last_month, s.fob_value, s.cif_value, s.kg, s.qty FROM (
  SELECT year, count(*) AS n_rows, CAST(max(month) AS INT) AS last_month, CAST(sum(fob_value) AS BIGINT) AS fob_value, {cif} AS cif_value,
    CAST(sum(kg) AS BIGINT) AS kg, CAST(sum(qty) AS BIGINT) AS qty FROM {flow}s GROUP BY year) s
JOIN (SELECT year, count(*) AS raw_rows FROM raw_coarse GROUP BY year) r ON r.year = s.year'''


@register("store_ledger", with_views(f"{_ledger_sql('export')} UNION ALL {_ledger_sql('import')}", "exports", "imports"))
def q_store_ledger(spark, d):
    from tradeflow.plans.ledger import MEASURES, valid

    base = _created_store(spark, d)
    return valid(spark, base).select("flow", "year", "raw_rows", "n_rows", "last_month", *[F.col(m).cast("bigint").alias(m) for m in MEASURES])


_REVISED = "(year <> 1996 OR month <> 12) AND (year <> 1994 OR kg < 40)"


def _revised_store(spark, d):
    """A store whose landing was published again: all files anew in another column order, two years with rows left out."""
    fx, flows = Fixtures(spark, d), ("export", "import")
    landing, base = scratch_dir(spark, "landing"), scratch_dir(spark, "store")
    for flow in flows:
        write_raw_files(fx.raw_files(flow), landing, flow, compression="gzip")
    create_store(spark, landing, base)
    before = {(flow, y): files_digest(spark, base, flow, y) for flow in flows for y in stored_years(spark, flow_path(base, flow))}
    again = scratch_dir(spark, "landing")
    for flow in flows:
        kept = F.expr(_REVISED.replace("year", "CO_ANO").replace("month", "CO_MES").replace("kg", "KG_LIQUIDO"))
        write_raw_files(fx.raw_files(flow, layout="legacy").where(kept), again, flow, compression="gzip")
    create_store(spark, again, base)
    return base, before


@register(
    "store_unchanged_years",
    with_views("SELECT flow, year, year IN (1994, 1996) AS rewritten FROM (SELECT DISTINCT year FROM raw_coarse) t, (VALUES ('export'), ('import')) v(flow)",
               "raw_coarse"),
)
def q_store_unchanged_years(spark, d):
    """Years published again with equal content keep their files; those with other rows get new ones."""
    base, before = _revised_store(spark, d)
    rows = [(flow, y, files_digest(spark, base, flow, y) != digest) for (flow, y), digest in before.items()]
    return spark.createDataFrame(rows, "flow string, year int, rewritten boolean")


_TOTAL = "CASE WHEN count(fob_value) = count(*) THEN CAST(sum(fob_value) AS BIGINT) END AS value"


def _revised_sql(select: str, group: str) -> str:
    return with_views(f"{select} FROM revised GROUP BY {group}", "raw_coarse", extra=(
        ("kept", f"SELECT * FROM raw_coarse WHERE {_REVISED}"), ("revised", _normalised("kept", cif=True))))


@register("ledger_total_by_year", _revised_sql(f"SELECT year, {_TOTAL}", "year"))
def q_ledger_total_by_year(spark, d):
    from tradeflow.plans.ledger import total_by_year

    return total_by_year(spark, _revised_store(spark, d)[0], "import")


@register("ledger_total_by_year_month", _revised_sql(f"SELECT year, month, {_TOTAL}", "year, month"))
def q_ledger_total_by_year_month(spark, d):
    from tradeflow.plans.ledger import total_by_year_month

    return total_by_year_month(spark, _revised_store(spark, d)[0], "import")


@register(
    "landing_withdrawn_years",
    with_views("SELECT 'export' AS flow, year, count(*) AS n_rows FROM exports WHERE year <> 1995 GROUP BY year "
               "UNION ALL SELECT 'import', year, count(*) FROM imports WHERE year NOT IN (1995, 1997) GROUP BY year", "exports", "imports"),
)
def q_landing_withdrawn_years(spark, d):
    """All files of a year are withdrawn from the landing folder, for one year in both flows, for another in one."""
    from tradeflow.streaming.landing import run_ingest_once

    landing, base, seen = _landing(spark, d), scratch_dir(spark, "store"), scratch_dir(spark, "stream-checkpoint")
    run_ingest_once(spark, landing, base, seen)
    for name in list_files(spark, landing):
        if route_of(name) in (("export", 1995), ("import", 1995), ("import", 1997)):
            delete(spark, name)
    run_ingest_once(spark, landing, base, seen)
    parts = [open_store(spark, flow_path(base, flow), flow).groupBy(F.lit(flow).alias("flow"), "year").agg(F.count(F.lit(1)).alias("n_rows"))
             for flow in ("export", "import")]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- more CSV chains and store queries
@register("read_lookup_product", PRODUCT_ALL_SQL)
def q_read_lookup_product(spark, d):
    path = _csv(Fixtures(spark, d).published_product(), scratch_dir(spark, "lookup-csv"))
    return build_product_lookup(read_lookup(spark, path))


@register(
    "read_lookup_unit",
    with_views(
        f"SELECT CAST(co_unid AS INT) AS unit_code, {_SENTENCE} AS unit_description_pt, "
        r"trim(regexp_replace(sg_unid, '\s+', ' ', 'g')) AS sg_unid, "
        f"CASE {_SENTENCE} {_TRANSLATE} END AS unit_description FROM unit_raw",
        "unit_raw",
    ),
)
def q_read_lookup_unit(spark, d):
    path = _csv(Fixtures(spark, d).published_unit(), scratch_dir(spark, "lookup-csv"))
    return build_unit_lookup(read_lookup(spark, path))


@register(
    "store_filter_states",
    with_views(f"SELECT {IMP} FROM imports WHERE state IN ({', '.join(repr(s) for s in BRAZILIAN_STATES)})",
               "imports"),
)
def q_store_filter_states(spark, d):
    from tradeflow.operators.enrich import filter_states

    base = _store(spark, d)
    return filter_states(open_store(spark, flow_path(base, "import"), "import"))
