"""Finding raw-file links in crawled portal pages.

The pages are a DataFrame (one row per page, with its HTML); fetching them is
outside this library.  Links are the ``href`` values of the elements that a selector matches, found in one pass over each
page's tags (``sources/markup.py``, Arrow batches of pages); they are kept when
they match ``include`` and not ``exclude``, and, when years are given, when the
first 4-digit number of the link's file name is one of them (a semi join, so a
year plan DataFrame can be passed directly).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeflow.session import ship_package
from tradeflow.sources.markup import Reader, selector

ALL_LINKS = "a"
TABLE_CELL_SCOPE = "table tr td a"
# Raw-file links contain this path part, and complete/check files are left out.
RAW_INCLUDE = "/ncm/"
RAW_EXCLUDE = "COMPLETA|CONFERENCIA"


def extract_links(pages: DataFrame, html_col: str = "html", in_table_cells: bool = False, css_scope: str | None = None) -> DataFrame:
    """One row per matched element with an ``href``, with the page's other columns.

    ``css_scope`` is a selector (``markup.selector``); without it all anchors count, or with
    ``in_table_cells`` those in the cells of tables.
    """
    if html_col not in pages.columns:
        raise ValueError(f"The '{html_col}' column does not exist.")
    keep = [c for c in pages.columns if c != html_col]
    if "href" in keep:
        raise ValueError("pages must not have a column 'href': the links get it")
    chains = selector(css_scope if css_scope is not None else TABLE_CELL_SCOPE if in_table_cells else ALL_LINKS)
    ship_package(pages.sparkSession)

    def links(batches):
        import pyarrow as pa

        reader = Reader(chains)
        for batch in batches:
            found = [reader.select(html) for html in batch.column(0).to_pylist()]
            rows = pa.array([k for k, values in enumerate(found) for _ in values], pa.int64())
            columns = [batch.column(k + 1).take(rows) for k in range(len(keep))]
            href = pa.array([v.strip() for values in found for v in values], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, href], names=[*keep, "href"])

    rows = pages.select(F.col(f"`{html_col}`").cast("string"), *[F.col(f"`{c}`") for c in keep])
    return rows.mapInArrow(links, T.StructType([*rows.schema.fields[1:], T.StructField("href", T.StringType())]))


def link_year(href: str = "href"):
    name = F.regexp_extract(F.col(href), r"([^/?#]*)([?#].*)?$", 1)
    y = F.regexp_extract(name, "[0-9]{4}", 0)
    return F.when(y != "", y.cast("int"))


def discover_files(
    pages: DataFrame,
    years=None,
    include: str | None = RAW_INCLUDE,
    exclude: str | None = RAW_EXCLUDE,
    html_col: str = "html",
    in_table_cells: bool = False,
    css_scope: str | None = None,
) -> DataFrame:
    """Links to raw files: (page columns..., href, link_year).

    ``years`` is None (no year condition), a list of ints, or a DataFrame with a
    ``year`` column.  An empty list or an empty frame gives no links.
    ``css_scope`` is a selector of the elements whose ``href`` counts; ``'table tr td a'`` (the
    portal's scope) is the same as ``in_table_cells=True``.
    """
    links = extract_links(pages, html_col, in_table_cells, css_scope)
    if include:
        links = links.where(F.col("href").rlike(include))
    if exclude:
        links = links.where(~F.col("href").rlike(exclude))
    links = links.withColumn("link_year", link_year())
    if years is None:
        return links
    if isinstance(years, DataFrame):
        wanted = years.select(F.col("year").cast("int").alias("_year")).distinct()
        return links.join(wanted, links.link_year == wanted._year, "left_semi")
    return links.where(F.col("link_year").isin([int(y) for y in years]))


def find_table_links(pages: DataFrame, name: str, html_col: str = "html", in_table_cells: bool = True) -> DataFrame:
    """Links to a published lookup file ``<name>.csv`` (for example 'PAIS', 'NCM_UNIDADE')."""
    if not name or not isinstance(name, str):
        raise ValueError("name must be a non-empty string, e.g. 'PAIS'")
    pattern = "/" + re.escape(name) + r"\.csv"
    return discover_files(pages, include=pattern, exclude=None, html_col=html_col, in_table_cells=in_table_cells)
