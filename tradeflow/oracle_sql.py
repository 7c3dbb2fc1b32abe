"""DuckDB text of the fixture views, for the correctness oracle.

Each view mirrors one builder of ``tradeflow.fixtures``.  ``with_views`` turns a
final SELECT into one statement that carries the views it needs as CTEs, since
only the base tables are registered in the oracle's DuckDB.
"""

from __future__ import annotations

from tradeflow.fixtures import STATE_BY_FLAGS, STATE_NAMES, UNIT_RAW_NAMES

_STATE_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_BY_FLAGS.items())
_STATE_VALUES = ",".join(f"('{k}','{v}')" for k, v in STATE_NAMES.items())
_UNIT_CASE = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(UNIT_RAW_NAMES))

_MEASURES_IMP = ("fob_value", "insurance", "freight", "kg", "qty")
_MEASURES_EXP = ("fob_value", "kg", "qty")


def _strict(m: str) -> str:
    return f"CASE WHEN count({m}) = count(*) THEN CAST(sum({m}) AS BIGINT) END AS {m}"


def _normalised(src: str, cif: bool) -> str:
    ms = _MEASURES_IMP if cif else _MEASURES_EXP
    inner = (
        "SELECT year, month, lpad(ncm,8,'0') AS ncm, state, country_code, "
        + ", ".join(_strict(m) for m in ms)
        + f" FROM {src} GROUP BY year, month, lpad(ncm,8,'0'), state, country_code"
    )
    if cif:
        outer = "year, month, ncm, state, country_code, fob_value, fob_value + insurance + freight AS cif_value, kg, qty"
    else:
        outer = "year, month, ncm, state, country_code, fob_value, kg, qty"
    return f"SELECT {outer} FROM ({inner}) AS g"


def _isic_level(level: str, div: float) -> str:
    code = f"CAST(floor(k / {div}) AS INT)"
    return (
        f"{code} AS isic_{level}_code, 'pt {level} ' || CAST({code} AS VARCHAR) AS isic_{level}_desc_pt, "
        f"'{level} ' || CAST({code} AS VARCHAR) AS isic_{level}_desc, "
        f"'es {level} ' || CAST({code} AS VARCHAR) AS isic_{level}_desc_es"
    )


_SEC = "chr(65 + CAST(floor(k / 25.0) AS INT))"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), f"""
SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
  CASE WHEN l_partkey % 53 = 0 THEN '9' || lpad(CAST(l_partkey AS VARCHAR),7,'0') ELSE CAST(l_partkey AS VARCHAR) END AS ncm,
  CASE l_returnflag || l_linestatus {_STATE_CASE} ELSE 'XX' END AS state,
  CASE WHEN l_suppkey % 40 = 39 THEN NULL WHEN s_nationkey >= 22 THEN CAST(s_nationkey + 900 AS INT) ELSE CAST(s_nationkey AS INT) END AS country_code,
  CAST(l_quantity AS BIGINT) AS kg, CAST(l_linenumber AS BIGINT) AS qty,
  CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS fob_value,
  CASE WHEN l_linenumber = 7 AND l_partkey % 50 = 0 THEN NULL ELSE CAST(floor(l_extendedprice * l_tax) AS BIGINT) END AS freight,
  CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS insurance
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""),
    "raw_coarse": (("raw",), """
SELECT year, month, ncm, state, country_code, kg, qty, fob_value, freight, insurance
FROM raw"""),
    "exports": (("raw_coarse",), _normalised("raw_coarse", cif=False)),
    "imports": (("raw_coarse",), _normalised("raw_coarse", cif=True)),
    "imports_fine": (("raw",), _normalised("raw", cif=True)),
    "exports_fine": (("raw",), _normalised("raw", cif=False)),
    "country_lookup": ((), """
SELECT CAST(n_nationkey AS INT) AS country_code, lpad(CAST(n_nationkey AS VARCHAR),3,'0') AS country_code_ison3,
  'N' || lpad(CAST(n_nationkey AS VARCHAR),2,'0') AS country_code_isoa3, 'pt ' || n_name AS country_name_pt,
  n_name AS country_name, 'es ' || n_name AS country_name_es
FROM nation
UNION ALL SELECT CAST(NULL AS INT), NULL, NULL, 'sem pais', 'no country', 'sin pais'"""),
    "state_lookup": ((), f"SELECT * FROM (VALUES {_STATE_VALUES}) AS t(state, state_name)"),
    "product_lookup": ((), """
SELECT lpad(CAST(p_partkey AS VARCHAR),8,'0') AS ncm, CAST(10 + p_size % 17 AS INT) AS unit_code,
  'Q' || CAST(p_size AS VARCHAR) AS co_cuci_item, CAST(100 + p_size % 19 AS INT) AS bec_n3_code,
  CAST(1000 + p_size AS INT) AS co_siit,
  CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_size = 50 THEN 950 ELSE CAST(p_size AS INT) END AS isic_class_code,
  p_name AS ncm_description, 'pt ' || p_name AS ncm_description_pt, 'es ' || p_name AS ncm_description_es
FROM part"""),
    "isic_lookup": ((), f"""
SELECT CAST(k AS INT) AS isic_class_code, 'pt class ' || CAST(k AS VARCHAR) AS isic_class_desc_pt,
  'class ' || CAST(k AS VARCHAR) AS isic_class_desc, 'es class ' || CAST(k AS VARCHAR) AS isic_class_desc_es,
  {_isic_level('group', 5.0)}, {_isic_level('division', 10.0)},
  {_SEC} AS isic_section_code, 'pt section ' || {_SEC} AS isic_section_desc_pt,
  'section ' || {_SEC} AS isic_section_desc, 'es section ' || {_SEC} AS isic_section_desc_es
FROM (SELECT DISTINCT p_size AS k FROM part) AS d
UNION ALL SELECT NULL, 'sem classe', 'no class', 'sin clase', NULL, 'sem grupo', 'no group', 'sin grupo',
  NULL, 'sem divisao', 'no division', 'sin division', NULL, 'sem secao', 'no section', 'sin seccion'"""),
    "unit_lookup": ((), """
SELECT CAST(10 + i AS INT) AS unit_code, 'Unidade ' || CAST(i AS VARCHAR) AS unit_description_pt,
  'U' || CAST(i AS VARCHAR) AS sg_unid, 'Unit ' || CAST(i AS VARCHAR) AS unit_description
FROM (SELECT DISTINCT p_size % 16 AS i FROM part) AS u"""),
    "bec_lookup": ((), """
SELECT CAST(100 + i AS INT) AS bec_n3_code, 'pt n3 ' || CAST(i AS VARCHAR) AS bec_n3_desc_pt,
  'n3 ' || CAST(i AS VARCHAR) AS bec_n3_desc, 'es n3 ' || CAST(i AS VARCHAR) AS bec_n3_desc_es,
  CAST(floor(i / 5.0) AS INT) AS bec_n2_code, 'pt n2 ' || CAST(floor(i / 5.0) AS INT) AS bec_n2_desc_pt,
  'n2 ' || CAST(floor(i / 5.0) AS INT) AS bec_n2_desc, 'es n2 ' || CAST(floor(i / 5.0) AS INT) AS bec_n2_desc_es,
  CAST(floor(i / 10.0) AS INT) AS bec_n1_code, 'pt n1 ' || CAST(floor(i / 10.0) AS INT) AS bec_n1_desc_pt,
  'n1 ' || CAST(floor(i / 10.0) AS INT) AS bec_n1_desc, 'es n1 ' || CAST(floor(i / 10.0) AS INT) AS bec_n1_desc_es
FROM (SELECT DISTINCT p_size % 19 AS i FROM part) AS b"""),
    "unit_raw": ((), f"""
SELECT CAST(p_partkey AS INT) AS co_unid, CASE p_size % 16 {_UNIT_CASE} END AS no_unid,
  '  ' || replace(p_brand, '#', '   ') || ' ' AS sg_unid
FROM part"""),
    "official_feed": (("raw",), """
SELECT CAST(year AS INT) AS id,
  '{"data":{"year":"' || CAST(year AS VARCHAR) || '","monthNumber":"' || CAST(max(month) AS VARCHAR) || '"}}' AS payload
FROM raw GROUP BY year"""),
}


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(select: str, *names: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH <needed views>, <extra CTEs> <select>``."""
    ctes = [f"{n} AS ({VIEWS[n][1].strip()})" for n in _order(names)]
    ctes += [f"{n} AS ({body.strip()})" for n, body in extra]
    if not ctes:
        return select.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()
