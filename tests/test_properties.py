"""Property tests (hypothesis) against plain-Python models."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradeflow.functions import pad_code, strict_sum
from tradeflow.operators.enrich import add_country_name
from tradeflow.operators.normalise import normalise_exports, normalise_imports

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.tuples(st.sampled_from([2023, 2024]), st.integers(1, 2), st.sampled_from(["1", "01", "7", "123456789"]),
                 st.sampled_from(["SP", "RJ", None]), st.sampled_from([20, 23, None]))
measure = st.one_of(st.none(), st.integers(0, 10**12))
rows = st.lists(st.tuples(keys, measure, measure, measure, measure, measure), min_size=1, max_size=40)


def _model(rs):
    """Group on padded keys; strict sums; cif = fob + insurance + freight."""
    groups = defaultdict(list)
    for (y, m, ncm, s, c), fob, fr, ins, kg, qty in rs:
        groups[(y, m, ncm.rjust(8, "0"), s, c)].append((fob, ins, fr, kg, qty))

    def ssum(vals):
        return None if any(v is None for v in vals) else sum(vals)

    out = set()
    for k, vs in groups.items():
        fob, ins, fr, kg, qty = (ssum([v[i] for v in vs]) for i in range(5))
        cif = None if None in (fob, ins, fr) else fob + ins + fr
        out.add((*k, fob, cif, kg, qty))
    return out


@SETTINGS
@given(rows)
def test_normalise_matches_model_and_is_idempotent(spark, rs):
    data = [(y, m, n, s, c, kg, qty, fob, fr, ins) for (y, m, n, s, c), fob, fr, ins, kg, qty in rs]
    df = spark.createDataFrame(
        data, "year int, month int, ncm string, state string, country_code int, kg bigint, qty bigint, "
              "fob_value bigint, freight bigint, insurance bigint")
    once = normalise_imports(df)
    got = {tuple(r) for r in once.collect()}
    assert got == _model(rs)
    again = once.withColumn("freight", once.fob_value * 0).withColumn("insurance", once.fob_value * 0)
    assert {tuple(r)[:6] for r in normalise_imports(again).collect()} == {t[:6] for t in got}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789", min_size=0, max_size=11)), min_size=1, max_size=20))
def test_pad_code_model(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(pad_code("c")).collect()]
    assert got == [None if c is None else c.rjust(8, "0") for c in codes]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-10**9, 10**9))), min_size=1, max_size=30))
def test_strict_sum_model(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v bigint")
    got = {r.k: r.s for r in df.groupBy("k").agg(strict_sum("v").alias("s")).collect()}
    model = defaultdict(list)
    for k, v in pairs:
        model[k].append(v)
    assert got == {k: (None if None in vs else sum(vs)) for k, vs in model.items()}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([20, 23, 40, None]), st.integers(0, 1000)), min_size=1, max_size=30))
def test_enrichment_keeps_rows_and_sums(spark, pairs):
    country = spark.createDataFrame(
        [(20, "a", "A", "a"), (23, "b", "B", "b"), (None, "n", "N", "n")],
        "country_code int, country_name_pt string, country_name string, country_name_es string")
    df = spark.createDataFrame(pairs, "country_code int, v bigint")
    out = add_country_name(df, country, drop_key=False)
    assert out.count() == len(pairs)
    assert (out.agg({"v": "sum"}).first()[0] or 0) == sum(v for _, v in pairs)
    names = {(r.country_code, r.country_name) for r in out.collect()}
    assert all(n == {20: "A", 23: "B", None: "N"}.get(c) for c, n in names)


def test_create_again_keeps_older_years(spark, tmp_dir):
    from conftest import SF0001
    from tradeflow.fixtures import Fixtures
    from tradeflow.plans.store import create_store, flow_path, open_store
    from tradeflow.sources.raw import write_raw_files

    fx = Fixtures(spark, SF0001)
    land = tmp_dir + "/raw"
    write_raw_files(fx.raw_files("export"), land, "export")
    base = tmp_dir + "/db"
    create_store(spark, land, base, flows=("export",))
    create_store(spark, land, base, start_year=2000, flows=("export",))  # D24: older years stay
    years = sorted(r.year for r in open_store(spark, flow_path(base, "export"), "export").select("year").distinct().collect())
    assert years == list(range(1995, 2002))


def _plan_model(exp, imp, official, current, start):
    """SURVEY §3.2 with our decisions, in plain Python.  exp/imp: {year: last_month}."""
    off_year = int(official[:4])
    e, i = set(exp), set(imp)
    lo = min(e | i) if e | i else None
    s = max(start if start is not None else (lo if lo is not None else 1997), 1997)
    stop = min(current, off_year)
    desired = set(range(s, stop + 1))
    last_local = min(x for x in (max(e) if e else None, max(i) if i else None) if x is not None) if e | i else None
    both = e & i
    kept = {y for y in both if last_local is None or not (last_local <= y <= off_year)}
    download = desired - kept

    def last(d):
        if not d:
            return None
        y = max(d)
        return f"{y:04d}-{d[y]:02d}"

    current_ok = last(exp) == official and last(imp) == official
    other = any(y != off_year for y in download)
    if current_ok and not other:
        return []
    return sorted((y, "refresh" if y in both else "missing") for y in download)


years_months = st.dictionaries(st.integers(1995, 2003), st.integers(1, 12), max_size=6)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(years_months, years_months, st.integers(1996, 2004), st.integers(1, 12), st.integers(1998, 2006),
       st.one_of(st.none(), st.integers(1990, 2003)))
def test_refresh_plan_matches_model(spark, exp, imp, off_y, off_m, current, start):
    from tradeflow.plans.refresh import refresh_plan

    def store(d):
        return spark.createDataFrame([(y, m) for y, m in d.items()] or [(0, 0)], "year int, month int").where(
            "year > 0" if d else "false")

    official = f"{off_y:04d}-{off_m:02d}"
    got = sorted(tuple(r) for r in refresh_plan(store(exp), store(imp), official, current, start).collect())
    assert got == _plan_model(exp, imp, official, current, start)


csv_rows = st.lists(
    st.tuples(
        st.integers(1, 3),                                   # month
        st.sampled_from(["1", "01", "0001012100", "1012100", "123456789"]),   # product code as written
        st.sampled_from(["SP", "RJ", "ND", ""]),             # state ('' = quoted empty string)
        st.one_of(st.none(), st.integers(1, 300)),           # country
        st.one_of(st.none(), st.integers(0, 10**12)),        # kg
        st.one_of(st.none(), st.integers(0, 10**6)),         # qty
        st.one_of(st.none(), st.integers(0, 10**12)),        # fob
        st.booleans(),                                       # null written as NA (True) or as an empty field
    ),
    min_size=1, max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(csv_rows)
def test_csv_roundtrip_matches_model(spark, tmp_path_factory, rows):
    import os

    from tradeflow.sources.raw import read_raw

    folder = str(tmp_path_factory.mktemp("csvprop"))

    def cell(v, na):
        return ("NA" if na else "") if v is None else str(v)

    lines = ["CO_ANO;CO_MES;CO_NCM;SG_UF_NCM;CO_PAIS;KG_LIQUIDO;QT_ESTAT;VL_FOB"]
    for month, ncm, state, country, kg, qty, fob, na in rows:
        st_cell = '""' if state == "" else state
        lines.append(";".join(["2024", str(month), ncm, st_cell, cell(country, na), cell(kg, na), cell(qty, na),
                               cell(fob, na)]))
    with open(os.path.join(folder, "EXP_2024.csv"), "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")
    got = {tuple(r) for r in normalise_exports(read_raw(spark, folder, "export")).collect()}

    groups = defaultdict(list)
    for month, ncm, state, country, kg, qty, fob, _ in rows:
        groups[(2024, month, ncm.rjust(8, "0"), state, country)].append((fob, kg, qty))

    def ssum(vals):
        return None if any(v is None for v in vals) else sum(vals)

    want = {(*k, *(ssum([v[i] for v in vs]) for i in range(3))) for k, vs in groups.items()}
    assert got == want
