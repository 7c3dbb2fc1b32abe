"""Registered queries (one per operator and variant) and their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]`` is
the DuckDB statement with the same columns.  Queries that write (store, CSV
round trips) do so below the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeflow.fixtures import Fixtures
from tradeflow.operators.enrich import (
    add_country_name,
    add_isic_description,
    add_product_description,
    add_state_name,
    add_units,
    filter_states,
)
from tradeflow.operators.normalise import conform, normalise_exports, normalise_imports
from tradeflow.operators.summaries import total_by_year, total_by_year_month
from tradeflow.oracle_sql import with_views
from tradeflow.schemas import BRAZILIAN_STATES, isic_columns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


IMP = "year, month, ncm, state, country_code, fob_value, cif_value, kg, qty"
EXP = "year, month, ncm, state, country_code, fob_value, kg, qty"
_STATES_SQL = ", ".join(f"'{s}'" for s in BRAZILIAN_STATES)


def _sum(m: str, name: str) -> str:
    return f"CASE WHEN count({m}) = count(*) THEN CAST(sum({m}) AS BIGINT) END AS {name}"


# ---------------------------------------------------------------- normalisation
@register("normalise_exports", with_views(f"SELECT {EXP} FROM exports", "exports"))
def q_normalise_exports(spark, d):
    return normalise_exports(Fixtures(spark, d).raw_coarse().drop("freight", "insurance"))


@register("normalise_imports", with_views(f"SELECT {IMP} FROM imports", "imports"))
def q_normalise_imports(spark, d):
    return normalise_imports(Fixtures(spark, d).raw_coarse())


@register("normalise_imports_fine", with_views(f"SELECT {IMP} FROM imports_fine", "imports_fine"))
def q_normalise_imports_fine(spark, d):
    return normalise_imports(Fixtures(spark, d).raw())


@register("conform", with_views(f"SELECT {IMP} FROM imports", "imports"))
def q_conform(spark, d):
    from pyspark.sql import functions as F

    # Measures arrive as doubles, columns out of order: conform casts them back exactly.
    n = normalise_imports(Fixtures(spark, d).raw_coarse())
    loose = n.select("qty", "kg", "state", *[F.col(c).cast("double").alias(c) for c in ("fob_value", "cif_value")],
                     "ncm", "country_code", "month", "year")
    return conform(loose, "import")


@register("strict_null_cif", with_views(f"SELECT {IMP} FROM imports WHERE cif_value IS NULL", "imports"))
def q_strict_null(spark, d):
    return normalise_imports(Fixtures(spark, d).raw_coarse()).where("cif_value IS NULL")


# ---------------------------------------------------------------- summaries
@register("total_by_year", with_views(f"SELECT year, {_sum('fob_value', 'value')} FROM exports GROUP BY year", "exports"))
def q_total_by_year(spark, d):
    return total_by_year(normalise_exports(Fixtures(spark, d).raw_coarse()))


@register(
    "total_by_year_month",
    with_views(f"SELECT year, month, {_sum('fob_value', 'value')} FROM imports GROUP BY year, month", "imports"),
)
def q_total_by_year_month(spark, d):
    return total_by_year_month(normalise_imports(Fixtures(spark, d).raw_coarse()))


# ---------------------------------------------------------------- enrichment
@register("filter_states", with_views(f"SELECT {IMP} FROM imports WHERE state IN ({_STATES_SQL})", "imports"))
def q_filter_states(spark, d):
    return filter_states(normalise_imports(Fixtures(spark, d).raw_coarse()))


def _country_sql(name: str, drop_key: bool) -> str:
    cols = IMP.replace("country_code, ", "") if drop_key else IMP
    cols = ", ".join(f"x.{c.strip()}" for c in cols.split(","))
    return with_views(
        f"SELECT {cols}, l.{name} FROM imports x "
        f"LEFT JOIN country_lookup l ON x.country_code IS NOT DISTINCT FROM l.country_code",
        "imports", "country_lookup",
    )


for _lang, _suffix in (("en", ""), ("pt", "_pt"), ("es", "_es")):
    for _drop in (True, False):
        _name = "add_country_name" + ("" if _lang == "en" else f"_{_lang}") + ("" if _drop else "_keep_key")

        def _q(spark, d, _lang=_lang, _drop=_drop):
            fx = Fixtures(spark, d)
            return add_country_name(normalise_imports(fx.raw_coarse()), fx.country_lookup(), _lang, _drop)

        register(_name, _country_sql("country_name" + _suffix, _drop))(_q)


def _state_sql(drop_key: bool) -> str:
    cols = IMP.replace("state, ", "") if drop_key else IMP
    cols = ", ".join(f"x.{c.strip()}" for c in cols.split(","))
    return with_views(
        f"SELECT {cols}, l.state_name FROM imports x LEFT JOIN state_lookup l ON x.state IS NOT DISTINCT FROM l.state",
        "imports", "state_lookup",
    )


for _drop in (True, False):
    def _q(spark, d, _drop=_drop):
        fx = Fixtures(spark, d)
        return add_state_name(normalise_imports(fx.raw_coarse()), fx.state_lookup(), _drop)

    register("add_state_name" + ("" if _drop else "_keep_key"), _state_sql(_drop))(_q)


def _product_sql(name: str, drop_key: bool) -> str:
    cols = IMP.replace("ncm, ", "") if drop_key else IMP
    cols = ", ".join(f"x.{c.strip()}" for c in cols.split(","))
    return with_views(
        f"SELECT {cols}, p.{name} FROM imports_fine x "
        f"LEFT JOIN (SELECT ncm AS k, {name} FROM product_lookup) p ON x.ncm IS NOT DISTINCT FROM p.k",
        "imports_fine", "product_lookup",
    )


for _lang, _suffix in (("en", ""), ("pt", "_pt"), ("es", "_es")):
    for _drop in (False, True):
        _name = "add_product_description" + ("" if _lang == "en" else f"_{_lang}") + ("_drop_key" if _drop else "")

        def _q(spark, d, _lang=_lang, _drop=_drop):
            fx = Fixtures(spark, d)
            return add_product_description(normalise_imports(fx.raw()), fx.product_lookup(), _lang, _drop)

        register(_name, _product_sql("ncm_description" + _suffix, _drop))(_q)


def _units_sql(name: str, drop_key: bool) -> str:
    cols = ", ".join(f"x.{c.strip()}" for c in IMP.split(","))
    key = "" if drop_key else "p.unit_code, "
    return with_views(
        f"SELECT {cols}, {key}u.{name} FROM imports_fine x "
        f"LEFT JOIN (SELECT ncm AS k, unit_code FROM product_lookup) p ON x.ncm IS NOT DISTINCT FROM p.k "
        f"LEFT JOIN (SELECT unit_code AS uk, {name} FROM unit_lookup) u ON p.unit_code IS NOT DISTINCT FROM u.uk",
        "imports_fine", "product_lookup", "unit_lookup",
    )


for _lang, _suffix in (("en", ""), ("pt", "_pt")):
    for _drop in (True, False):
        _name = "add_units" + ("" if _lang == "en" else f"_{_lang}") + ("" if _drop else "_keep_key")

        def _q(spark, d, _lang=_lang, _drop=_drop):
            fx = Fixtures(spark, d)
            return add_units(normalise_imports(fx.raw()), fx.product_lookup(), fx.unit_lookup(), _lang, _drop)

        register(_name, _units_sql("unit_description" + _suffix, _drop))(_q)


def _isic_sql(lang: str, level: str, drop_key: bool) -> str:
    names = isic_columns(lang, level)
    cols = ", ".join(f"x.{c.strip()}" for c in IMP.split(","))
    key = "" if drop_key else "p.isic_class_code, "
    picked = ", ".join(f"i.{n}" for n in names)
    return with_views(
        f"SELECT {cols}, {key}{picked} FROM imports_fine x "
        f"LEFT JOIN (SELECT ncm AS k, isic_class_code FROM product_lookup) p ON x.ncm IS NOT DISTINCT FROM p.k "
        f"LEFT JOIN (SELECT isic_class_code AS ik, {', '.join(names)} FROM isic_lookup) i "
        f"ON p.isic_class_code IS NOT DISTINCT FROM i.ik",
        "imports_fine", "product_lookup", "isic_lookup",
    )


for _lang in ("en", "pt", "es"):
    for _level in ("class", "group", "division", "section", "all"):
        for _drop in ((True, False) if (_lang, _level) == ("en", "all") else (True,)):
            _name = (
                "add_isic_description" + ("" if _lang == "en" else f"_{_lang}") + f"_{_level}"
                + ("" if _drop else "_keep_key")
            )

            def _q(spark, d, _lang=_lang, _level=_level, _drop=_drop):
                fx = Fixtures(spark, d)
                return add_isic_description(
                    normalise_imports(fx.raw()), fx.product_lookup(), fx.isic_lookup(), _lang, _level, _drop
                )

            register(_name, _isic_sql(_lang, _level, _drop))(_q)


# ---------------------------------------------------------------- flagship
def _flagship_sql(suffix: str = "", source: str = "imports_fine") -> str:
    sec, name = f"isic_section_desc{suffix}", f"country_name{suffix}"
    ms = ["fob_value", "cif_value", "kg"] if source == "imports_fine" else ["fob_value", "kg"]
    outer = ", ".join(f"f.{m}" for m in ms)
    sums = ", ".join(_sum(f"a.{m}", m) for m in ms)
    return with_views(
        f"""
SELECT f.year, f.state, f.{sec}, c.{name}, {outer}
FROM (
  SELECT a.year, a.state, i.{sec}, a.country_code, {sums}
  FROM {source} a
  LEFT JOIN (SELECT ncm AS k, isic_class_code FROM product_lookup) p ON a.ncm IS NOT DISTINCT FROM p.k
  LEFT JOIN (SELECT isic_class_code AS ik, {sec} FROM isic_lookup) i
    ON p.isic_class_code IS NOT DISTINCT FROM i.ik
  WHERE a.state IN ({_STATES_SQL})
  GROUP BY a.year, a.state, i.{sec}, a.country_code
) f
LEFT JOIN country_lookup c ON f.country_code IS NOT DISTINCT FROM c.country_code
""",
        source, "product_lookup", "isic_lookup", "country_lookup",
    )


FLAGSHIP_SQL = _flagship_sql()


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Imports of valid states by year, state and ISIC section, with country names."""
    from tradeflow.plans.reports import imports_by_section

    fx = Fixtures(spark, d)
    return imports_by_section(
        normalise_imports(fx.raw()), fx.product_lookup(), fx.isic_lookup(), fx.country_lookup()
    )


register("flagship_imports_by_section", FLAGSHIP_SQL)(flagship)


@register("flagship_imports_by_section_pt", _flagship_sql("_pt"))
def flagship_pt(spark: SparkSession, d: str) -> DataFrame:
    from tradeflow.plans.reports import imports_by_section

    fx = Fixtures(spark, d)
    return imports_by_section(
        normalise_imports(fx.raw()), fx.product_lookup(), fx.isic_lookup(), fx.country_lookup(), lang="pt"
    )


# Queries over files (raw CSV, lookups, store, refresh) register themselves on import.
import tradeflow.catalog_io  # noqa: E402,F401


@register("flagship_exports_by_section", _flagship_sql(source="exports_fine"))
def flagship_exports(spark: SparkSession, d: str) -> DataFrame:
    from tradeflow.plans.reports import trade_by_section

    fx = Fixtures(spark, d)
    exports = normalise_exports(fx.raw().drop("freight", "insurance"))
    return trade_by_section(exports, fx.product_lookup(), fx.isic_lookup(), fx.country_lookup())


@register(
    "add_country_name_unmatched",
    with_views(
        f"SELECT {', '.join('x.' + c.strip() for c in IMP.split(','))}, l.country_name FROM imports x "
        "LEFT JOIN country_lookup l ON x.country_code IS NOT DISTINCT FROM l.country_code "
        "WHERE l.country_name IS NULL",
        "imports", "country_lookup",
    ),
)
def q_add_country_name_unmatched(spark, d):
    fx = Fixtures(spark, d)
    named = add_country_name(normalise_imports(fx.raw_coarse()), fx.country_lookup(), drop_key=False)
    return named.where("country_name IS NULL")


@register(
    "add_isic_null_class",
    with_views(
        "SELECT DISTINCT i.isic_class_desc, i.isic_group_desc, i.isic_division_desc, i.isic_section_desc "
        "FROM imports_fine x "
        "LEFT JOIN (SELECT ncm AS k, isic_class_code FROM product_lookup) p ON x.ncm IS NOT DISTINCT FROM p.k "
        "LEFT JOIN (SELECT isic_class_code AS ik, isic_class_desc, isic_group_desc, isic_division_desc, "
        "isic_section_desc FROM isic_lookup) i ON p.isic_class_code IS NOT DISTINCT FROM i.ik "
        "WHERE p.isic_class_code IS NULL",
        "imports_fine", "product_lookup", "isic_lookup",
    ),
)
def q_add_isic_null_class(spark, d):
    fx = Fixtures(spark, d)
    out = add_isic_description(normalise_imports(fx.raw()), fx.product_lookup(), fx.isic_lookup(), level="all",
                               drop_key=False)
    return out.where("isic_class_code IS NULL").select(*isic_columns("en", "all")).distinct()
