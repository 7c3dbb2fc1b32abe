"""Schemas, code lists and name maps of the trade store and its lookups.

Everything here is a constant.  The store schemas are enforced on every write
(`operators.normalise.conform`); the lookup schemas are applied when a lookup is
built or loaded, so that join keys have the same type on both sides of a join.
"""

from __future__ import annotations

from pyspark.sql import types as T

FLOWS = ("export", "import")

# Grain of the store: one row per these keys.
GRAIN = ("year", "month", "ncm", "state", "country_code")

EXPORT_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("ncm", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country_code", T.IntegerType()),
        T.StructField("fob_value", T.LongType()),
        T.StructField("kg", T.LongType()),
        T.StructField("qty", T.LongType()),
    ]
)

IMPORT_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("ncm", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("country_code", T.IntegerType()),
        T.StructField("fob_value", T.LongType()),
        T.StructField("cif_value", T.LongType()),
        T.StructField("kg", T.LongType()),
        T.StructField("qty", T.LongType()),
    ]
)

STORE_SCHEMAS = {"export": EXPORT_SCHEMA, "import": IMPORT_SCHEMA}


def store_schema(flow: str) -> T.StructType:
    if flow not in STORE_SCHEMAS:
        raise ValueError(f"flow must be one of {FLOWS}, got {flow!r}")
    return STORE_SCHEMAS[flow]


# Raw file columns (header names).  Their types once read are ours:
# codes that carry leading zeros (product, state) stay strings.
RAW_TYPES = {
    "CO_ANO": T.IntegerType(),
    "CO_MES": T.IntegerType(),
    "CO_NCM": T.StringType(),
    "SG_UF_NCM": T.StringType(),
    "CO_PAIS": T.IntegerType(),
    "KG_LIQUIDO": T.LongType(),
    "QT_ESTAT": T.LongType(),
    "VL_FOB": T.LongType(),
    "VL_FRETE": T.LongType(),
    "VL_SEGURO": T.LongType(),
}

RAW_COLUMNS = {
    "export": ("CO_ANO", "CO_MES", "CO_NCM", "SG_UF_NCM", "CO_PAIS", "KG_LIQUIDO", "QT_ESTAT", "VL_FOB"),
    "import": (
        "CO_ANO", "CO_MES", "CO_NCM", "SG_UF_NCM", "CO_PAIS",
        "KG_LIQUIDO", "QT_ESTAT", "VL_FOB", "VL_FRETE", "VL_SEGURO",
    ),
}

# Raw trade-file column names (after lower-casing) -> store names.
RAW_RENAMES = {
    "co_ano": "year",
    "co_mes": "month",
    "co_ncm": "ncm",
    "sg_uf_ncm": "state",
    "co_pais": "country_code",
    "kg_liquido": "kg",
    "qt_estat": "qty",
    "vl_fob": "fob_value",
    "vl_frete": "freight",
    "vl_seguro": "insurance",
}

# First year published by the trade portal.
FIRST_DATA_YEAR = 1997

# The 27 valid state codes, in the reference's order.
BRAZILIAN_STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA",
    "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO",
    "RR", "RS", "SC", "SE", "SP", "TO",
)

# Column names of the published lookup files (after lower-casing)
# and the names they get in our lookups.  Names that are absent are skipped.
LOOKUP_RENAMES = {
    "co_pais": "country_code",
    "co_pais_ison3": "country_code_ison3",
    "co_pais_isoa3": "country_code_isoa3",
    "no_pais": "country_name_pt",
    "no_pais_ing": "country_name",
    "no_pais_esp": "country_name_es",
    "co_uf": "state_code",
    "sg_uf": "state",
    "no_uf": "state_name",
    "co_ncm": "ncm",
    "no_ncm_ing": "ncm_description",
    "no_ncm_por": "ncm_description_pt",
    "no_ncm_esp": "ncm_description_es",
    "co_isic_classe": "isic_class_code",
    "no_isic_classe": "isic_class_desc_pt",
    "no_isic_classe_ing": "isic_class_desc",
    "no_isic_classe_esp": "isic_class_desc_es",
    "co_isic_grupo": "isic_group_code",
    "no_isic_grupo": "isic_group_desc_pt",
    "no_isic_grupo_ing": "isic_group_desc",
    "no_isic_grupo_esp": "isic_group_desc_es",
    "co_isic_divisao": "isic_division_code",
    "no_isic_divisao": "isic_division_desc_pt",
    "no_isic_divisao_ing": "isic_division_desc",
    "no_isic_divisao_esp": "isic_division_desc_es",
    "co_isic_secao": "isic_section_code",
    "no_isic_secao": "isic_section_desc_pt",
    "no_isic_secao_ing": "isic_section_desc",
    "no_isic_secao_esp": "isic_section_desc_es",
    "co_cgce_n3": "bec_n3_code",
    "no_cgce_n3": "bec_n3_desc_pt",
    "no_cgce_n3_ing": "bec_n3_desc",
    "no_cgce_n3_esp": "bec_n3_desc_es",
    "co_cgce_n2": "bec_n2_code",
    "no_cgce_n2": "bec_n2_desc_pt",
    "no_cgce_n2_ing": "bec_n2_desc",
    "no_cgce_n2_esp": "bec_n2_desc_es",
    "co_cgce_n1": "bec_n1_code",
    "no_cgce_n1": "bec_n1_desc_pt",
    "no_cgce_n1_ing": "bec_n1_desc",
    "no_cgce_n1_esp": "bec_n1_desc_es",
    "co_unid": "unit_code",
}

# Portuguese unit name (after sentence case) -> English name.
UNIT_TRANSLATIONS = {
    "Quilograma liquido": "Net kilogram",
    "Numero (unidade)": "Number (unit)",
    "Milheiro": "Thousand units",
    "Pares": "Pairs",
    "Metro": "Meter",
    "Metro quadrado": "Square meter",
    "Metro cubico": "Cubic meter",
    "Litro": "Liter",
    "Mil quilowatt hora": "Thousand kilowatt hour",
    "Quilate": "Carat",
    "Duzia": "Dozen",
    "Tonelada metrica liquida": "Net metric ton",
    "Grama liquido": "Net gram",
    "Bilhoes de unidades internacionais": "Billion international units",
    "Quilograma bruto": "Gross kilogram",
}

LANGS = ("en", "pt", "es")
_LANG_SUFFIX = {"en": "", "pt": "_pt", "es": "_es"}


def lang_suffix(lang: str, allowed: tuple[str, ...] = LANGS) -> str:
    if lang not in allowed:
        raise ValueError(f"lang must be one of {allowed}, got {lang!r}")
    return _LANG_SUFFIX[lang]


ISIC_LEVELS = ("class", "group", "division", "section")


def isic_columns(lang: str, level: str) -> list[str]:
    """Description columns of the ISIC lookup for a language and a level."""
    suffix = lang_suffix(lang)
    if level == "all":
        levels = ISIC_LEVELS
    elif level in ISIC_LEVELS:
        levels = (level,)
    else:
        raise ValueError(f"level must be one of {ISIC_LEVELS + ('all',)}, got {level!r}")
    return [f"isic_{lv}_desc{suffix}" for lv in levels]


_TYPES = {"INT": T.IntegerType(), "STRING": T.StringType()}


def _fields(spec: str) -> T.StructType:
    """'a INT, b STRING' -> StructType (only the two types the lookups use)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ]))
    return T.StructType(fields)


_ISIC = ", ".join(
    f"isic_{lv}_code {'STRING' if lv == 'section' else 'INT'}, "
    f"isic_{lv}_desc_pt STRING, isic_{lv}_desc STRING, isic_{lv}_desc_es STRING"
    for lv in ISIC_LEVELS
)
_BEC = ", ".join(
    f"bec_{lv}_code INT, bec_{lv}_desc_pt STRING, bec_{lv}_desc STRING, bec_{lv}_desc_es STRING"
    for lv in ("n3", "n2", "n1")
)

# One explicit schema per lookup; key columns have the store's type.
LOOKUP_SCHEMAS = {
    "state": _fields("state STRING, state_name STRING"),
    "country": _fields(
        "country_code INT, country_code_ison3 STRING, country_code_isoa3 STRING, "
        "country_name_pt STRING, country_name STRING, country_name_es STRING"
    ),
    "product": _fields(
        "ncm STRING, unit_code INT, co_cuci_item STRING, bec_n3_code INT, co_siit INT, "
        "isic_class_code INT, ncm_description STRING, ncm_description_pt STRING, "
        "ncm_description_es STRING"
    ),
    "isic": _fields(_ISIC),
    "bec": _fields(_BEC),
    "unit": _fields("unit_code INT, unit_description_pt STRING, sg_unid STRING, unit_description STRING"),
    "cuci": _fields(
        "co_cuci_item STRING, no_cuci_item STRING, no_cuci_sub STRING, no_cuci_grupo STRING, "
        "no_cuci_divisao STRING, no_cuci_sec STRING"
    ),
}

LOOKUP_KEYS = {
    "state": "state",
    "country": "country_code",
    "product": "ncm",
    "isic": "isic_class_code",
    "bec": "bec_n3_code",
    "unit": "unit_code",
    "cuci": "co_cuci_item",
}

# Documented row counts of the published lookups; the broadcast guard allows a
# wide margin above them (`operators.enrich`).
LOOKUP_DOCUMENTED_ROWS = {
    "product": 13724,
    "cuci": 2971,
    "isic": 420,
    "country": 281,
    "state": 34,
    "bec": 19,
    "unit": 15,
}
