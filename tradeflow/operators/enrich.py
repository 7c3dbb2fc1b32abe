"""Filtering valid states and adding descriptions from code lookups.

Every enrichment is a left join against a lookup with a null-safe equality, so
a null code finds the lookup's null-key row, as in the reference.  Lookups are
small (the largest published one has 13,724 rows), but no hint says so: the planner
broadcasts a lookup whose size in bytes is below ``spark.sql.autoBroadcastJoinThreshold``,
or finds out at run time (AQE), and otherwise joins by sort-merge, splitting hot keys.
No job runs while a frame is built.  The input's row count is kept as long as lookup
keys are unique (checked when a lookup is saved).

Output columns: the input columns (minus a dropped key), then the added ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.schemas import BRAZILIAN_STATES, isic_columns, lang_suffix

def _require(df: DataFrame, col: str) -> None:
    if col not in df.columns:
        raise ValueError(f"The '{col}' column does not exist.")


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, cols: list[str], left_key: str | None = None) -> DataFrame:
    """Left join ``lookup[cols]`` on ``df[left_key] <=> lookup[key]``; the lookup key is not kept."""
    left_key = left_key or key
    _require(df, left_key)
    for c in [key, *cols]:
        if c not in lookup.columns:
            raise ValueError(f"lookup has no column '{c}'")
    clash = [c for c in cols if c in df.columns]
    if clash:
        raise ValueError(f"column(s) {clash} already exist; rename or drop them before joining")
    tmp = f"__lookup_{key}"
    right = lookup.select(F.col(key).alias(tmp), *cols)
    joined = df.join(right, F.col(left_key).eqNullSafe(F.col(tmp)), "left")
    return joined.drop(tmp)


def filter_states(df: DataFrame) -> DataFrame:
    """Rows whose state is one of the 27 valid state codes (null state is dropped)."""
    _require(df, "state")
    return df.filter(F.col("state").isin(*BRAZILIAN_STATES))


def add_country_name(df: DataFrame, country: DataFrame, lang: str = "en", drop_key: bool = True) -> DataFrame:
    name = "country_name" + lang_suffix(lang)
    out = lookup_join(df, country, "country_code", [name])
    return out.drop("country_code") if drop_key else out


def add_state_name(df: DataFrame, state: DataFrame, drop_key: bool = True) -> DataFrame:
    out = lookup_join(df, state, "state", ["state_name"])
    return out.drop("state") if drop_key else out


def add_product_description(df: DataFrame, product: DataFrame, lang: str = "en", drop_key: bool = False) -> DataFrame:
    """Product (NCM) description joined on ``ncm``; by default the code is kept."""
    name = "ncm_description" + lang_suffix(lang)
    out = lookup_join(df, product, "ncm", [name])
    return out.drop("ncm") if drop_key else out


# The R name of the same operator.
add_ncm_description = add_product_description


def add_units(
    df: DataFrame, product: DataFrame, unit: DataFrame, lang: str = "en", drop_key: bool = True
) -> DataFrame:
    """Statistical unit of each product: ncm -> unit_code -> unit description (en or pt)."""
    name = "unit_description" + lang_suffix(lang, ("en", "pt"))
    _require(df, "ncm")
    out = lookup_join(df, product, "ncm", ["unit_code"])
    out = lookup_join(out, unit, "unit_code", [name])
    return out.drop("unit_code") if drop_key else out


def add_isic_description(
    df: DataFrame, product: DataFrame, isic: DataFrame, lang: str = "en", level: str = "class", drop_key: bool = True
) -> DataFrame:
    """ISIC description(s) of each product: ncm -> isic_class_code -> level column(s).

    ``level='all'`` adds class, group, division and section, in that order.

    The two joins stay chained; pre-joining product and ISIC into one lookup would
    save a hash probe per row but change results.  With null-safe matching, a trade
    row whose product is unknown gets a null class and so the ISIC null-key row, as
    in the reference; a pre-joined lookup would leave it without descriptions.
    """
    names = isic_columns(lang, level)
    _require(df, "ncm")
    out = lookup_join(df, product, "ncm", ["isic_class_code"])
    out = lookup_join(out, isic, "isic_class_code", names)
    return out.drop("isic_class_code") if drop_key else out
