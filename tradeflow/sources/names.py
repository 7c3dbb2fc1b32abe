"""Column-name cleaning and renaming (plan-only: no data is touched)."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


def clean_name(name: str) -> str:
    """Lower snake_case without accents: 'CO_ANO' -> 'co_ano', 'monthNumber' -> 'month_number',
    'No. País' -> 'no_pais'."""
    s = unicodedata.normalize("NFKD", name.strip()).encode("ascii", "ignore").decode("ascii")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    return s or "x"


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake_case; repeated results get a numeric suffix."""
    names: list[str] = []
    for c in df.columns:
        base = n = clean_name(c)
        k = 1
        while n in names:
            k += 1
            n = f"{base}_{k}"
        names.append(n)
    return df if names == df.columns else df.toDF(*names)


def rename_known_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename the columns found in ``mapping``; names that are absent are skipped."""
    present = {old: new for old, new in mapping.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df
