"""Write PLANS.md: the physical plans of the headline operators, as Spark plans them.

For each operator: the operator tree of ``explain("formatted")`` and, for every
scan, its pushed filters, partition filters and read schema.  The store and the
lookups are written first (sf0.01), so the plans are those of real Parquet
tables.  Usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def condensed(text: str) -> str:
    """Operator tree, then the scan details worth reading."""
    tree, _, details = text.partition("\n\n\n")
    keep = []
    current = None
    for line in details.splitlines():
        m = re.match(r"\((\d+)\) (.+)", line)
        if m:
            current = m.group(0)
            continue
        if current and current.split(" ", 1)[1].startswith("Scan") and re.match(
            r"(PushedFilters|PartitionFilters|ReadSchema)", line
        ):
            keep.append(f"{current}: {line.strip()}")
    return tree.strip() + ("\n\n" + "\n".join(keep) if keep else "")


def main(sf_dir: str) -> None:
    from tradeflow.fixtures import Fixtures
    from tradeflow.operators.enrich import add_isic_description
    from tradeflow.operators.normalise import conform, normalise
    from tradeflow.operators.summaries import total_by_year
    from tradeflow.plans.refresh import latest_period
    from tradeflow.plans.reports import imports_by_section
    from tradeflow.plans.store import _rows_match_file_year, flow_path, open_store, write_store
    from tradeflow.schemas import GRAIN
    from tradeflow.session import local_session, scratch_dir
    from tradeflow.sources.lookups import load_lookup, save_lookup
    from tradeflow.sources.raw import list_files, read_raw, write_raw_files

    spark = local_session()
    fx = Fixtures(spark, sf_dir)
    landing = scratch_dir(spark, "plans-landing")
    write_raw_files(fx.raw_files("import", coarse=False, layout="published"), landing, "import")
    base = scratch_dir(spark, "plans-store")
    write_store(fx.imports_fine(), flow_path(base, "import"), "import")
    lk = scratch_dir(spark, "plans-lookups")
    for name, df in (("product", fx.product_lookup()), ("isic", fx.isic_lookup()), ("country", fx.country_lookup())):
        save_lookup(df, lk, name)
    imports = open_store(spark, flow_path(base, "import"), "import")
    product, isic, country = (load_lookup(spark, lk, n) for n in ("product", "isic", "country"))

    files = list_files(spark, landing)
    rows = _rows_match_file_year(read_raw(spark, files, "import", keep_file=True), files)  # as load_flow does
    load = conform(normalise(rows, "import"), "import")
    load = load.hint("rebalance", "year").sortWithinPartitions(*GRAIN)
    cases = [
        ("Load: raw CSV (published layout) -> file-year check -> grain aggregate -> year rebalance -> sorted write (create_store)", load),
        ("total_by_year over the store", total_by_year(imports)),
        ("Year and state filter over the store", imports.where("year = 1998 AND state = 'SP'").select("ncm", "fob_value")),
        ("add_isic_description(level='all')", add_isic_description(imports, product, isic, level="all")),
        ("Flagship: imports_by_section", imports_by_section(imports, product, isic, country)),
        ("latest_period", latest_period(imports)),
    ]
    print("# PLANS\n")
    print("Physical plans of the headline operators (`python tools/plans.py > PLANS.md`, sf0.01,")
    print("Spark " + spark.version + ", AQE on; plans before AQE re-optimisation).\n")
    for title, df in cases:
        print(f"## {title}\n\n```\n{condensed(formatted(df))}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
