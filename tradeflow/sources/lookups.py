"""Code lookups: read the published tables, build our seven lookups, save and load them.

Lookups are small (at most 13,724 published rows), but they are still plain
DataFrames: building one is a scan plus projections.  Saving checks that the
key is unique, so that enrichment joins never multiply trade rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.functions import pad_code, sentence_case, squish
from tradeflow.schemas import LOOKUP_KEYS, LOOKUP_RENAMES, LOOKUP_SCHEMAS, UNIT_TRANSLATIONS
from tradeflow.sources.names import clean_column_names, rename_known_columns
from tradeflow.sources.raw import bare_names

LOOKUP_CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "encoding": "ISO-8859-1",
    "inferSchema": "false",
    "enforceSchema": "false",
    "mode": "FAILFAST",
    # The published dialect: doubled quotes, separators and line breaks inside quoted text, NA for missing.
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "emptyValue": "",
}
# Fixed value: the published files' mark for a missing value.
MISSING = "NA"


def _schema(name: str):
    if name not in LOOKUP_SCHEMAS:
        raise ValueError(f"unknown lookup {name!r}; one of {sorted(LOOKUP_SCHEMAS)}")
    return LOOKUP_SCHEMAS[name]


def typed(df: DataFrame, name: str) -> DataFrame:
    """Cast the columns the lookup's schema knows; other columns are kept as they are.

    Code columns read from text are trimmed and a blank becomes null before the
    cast (ANSI mode raises on a malformed number).
    """
    types = {f.name: f.dataType for f in _schema(name).fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in df.columns:
        t = types.get(c)
        if t is None or have[c] == t:
            cols.append(F.col(c))
        elif have[c].simpleString() == "string" and t.simpleString() != "string":
            cols.append(F.nullif(F.trim(F.col(c)), F.lit("")).cast(t).alias(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return df.select(*cols)


def read_lookup(spark: SparkSession, path: str, name: str | None = None, options: dict | None = None) -> DataFrame:
    """Scan a published lookup file (';', Latin-1), clean and rename its columns, type the known ones."""
    opts = dict(LOOKUP_CSV_OPTIONS)
    opts.update(options or {})
    missing = opts.pop("nullValue", MISSING)
    df = bare_names(spark.read.options(**opts).csv(path))  # a leading byte-order mark is not part of a name
    df = rename_known_columns(clean_column_names(df), LOOKUP_RENAMES)
    # A field without anything in it is empty text, quoted or not; only the mark is missing.
    df = df.select(*[F.when(F.col(f"`{c}`") == missing, None).otherwise(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in df.columns])
    return typed(df, name) if name else df


def _select(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lookup source lacks column(s) {missing}")
    return typed(df.select(*cols), name)


def build_state_lookup(raw: DataFrame) -> DataFrame:
    return _select(raw, "state", ["state", "state_name"])


def build_country_lookup(raw: DataFrame) -> DataFrame:
    return typed(raw, "country")


def build_product_lookup(raw: DataFrame) -> DataFrame:
    cols = [
        "ncm", "unit_code", "co_cuci_item", "bec_n3_code", "co_siit", "isic_class_code",
        "ncm_description", "ncm_description_pt", "ncm_description_es",
    ]
    df = _select(raw, "product", cols).distinct()
    return df.withColumn("ncm", pad_code(F.col("ncm").cast("string")))


def build_isic_lookup(raw: DataFrame) -> DataFrame:
    return typed(raw, "isic")


def build_bec_lookup(raw: DataFrame) -> DataFrame:
    return typed(raw, "bec")


def translate_unit(c: Column) -> Column:
    """English unit name for a sentence-cased Portuguese one; null when there is none."""
    out = None
    for pt, en in UNIT_TRANSLATIONS.items():
        out = F.when(c == pt, F.lit(en)) if out is None else out.when(c == pt, F.lit(en))
    return out.otherwise(F.lit(None).cast("string"))


def build_unit_lookup(raw: DataFrame) -> DataFrame:
    """From (unit_code | co_unid, no_unid, sg_unid): sentence-case the name, squish the
    abbreviation, add the English name, rename to the lookup's columns."""
    df = rename_known_columns(clean_column_names(raw), LOOKUP_RENAMES)
    for c in ("unit_code", "no_unid", "sg_unid"):
        if c not in df.columns:
            raise ValueError(f"unit lookup source lacks column {c!r}")
    name = sentence_case(F.col("no_unid"))
    out = df.select(
        "unit_code",
        name.alias("unit_description_pt"),
        squish(F.col("sg_unid")).alias("sg_unid"),
        translate_unit(name).alias("unit_description"),
    )
    return typed(out, "unit")


def build_cuci_lookup(raw: DataFrame) -> DataFrame:
    cols = ["co_cuci_item", "no_cuci_item", "no_cuci_sub", "no_cuci_grupo", "no_cuci_divisao", "no_cuci_sec"]
    return _select(raw, "cuci", cols)


BUILDERS = {
    "state": build_state_lookup,
    "country": build_country_lookup,
    "product": build_product_lookup,
    "isic": build_isic_lookup,
    "bec": build_bec_lookup,
    "unit": build_unit_lookup,
    "cuci": build_cuci_lookup,
}


def duplicate_keys(lookup: DataFrame, name: str) -> DataFrame:
    """Keys that occur more than once (a null key is a key too)."""
    key = LOOKUP_KEYS[name]
    return lookup.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def save_lookup(lookup: DataFrame, base: str, name: str, check_keys: bool = True) -> str:
    """Write a lookup as Parquet below ``base``; refuses a lookup whose key repeats."""
    _schema(name)
    if check_keys:
        dup = duplicate_keys(lookup, name).limit(5).collect()  # a few offending keys for the message
        if dup:
            raise ValueError(f"{name} lookup has repeated keys, e.g. {[tuple(r) for r in dup]}")
    path = f"{base.rstrip('/')}/{name}"
    lookup.hint("rebalance").write.mode("overwrite").parquet(path)
    return path


def load_lookup(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read a saved lookup, with its key and code columns in the lookup's types."""
    _schema(name)
    path = f"{base.rstrip('/')}/{name}"
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(
            f"no {name} lookup at {path}; build it from the published file with build_lookups / save_lookup"
        ) from exc
    return typed(df, name)


def build_lookups(spark: SparkSession, sources: dict[str, str], dest: str, options: dict | None = None) -> dict[str, str]:
    """Read each published lookup file, build our lookup from it and save it below ``dest``.

    ``sources`` maps a lookup name (state, country, product, isic, bec, unit,
    cuci) to the path of its published file.  Returns name -> saved path.
    """
    unknown = sorted(set(sources) - set(BUILDERS))
    if unknown:
        raise ValueError(f"unknown lookup(s) {unknown}; one of {sorted(BUILDERS)}")
    return {
        name: save_lookup(BUILDERS[name](read_lookup(spark, path, options=options)), dest, name)
        for name, path in sources.items()
    }
