"""Raw files, lookups and link discovery (D19, D20, D25, D5, D16)."""

import os

import pytest
from pyspark.sql import functions as F

from tradeflow.sources.links import discover_files
from tradeflow.sources.lookups import build_product_lookup, build_unit_lookup, load_lookup, read_lookup, save_lookup
from tradeflow.sources.names import clean_name
from tradeflow.sources.raw import read_raw, route_of, with_file_route

EXP_HEADER = "CO_ANO;CO_MES;CO_NCM;SG_UF_NCM;CO_PAIS;KG_LIQUIDO;QT_ESTAT;VL_FOB"


def _write(path, text, enc="latin-1"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=enc) as f:
        f.write(text)


def test_extra_and_reordered_columns_by_name(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2023.csv", EXP_HEADER + "\n2023;1;01012100;SP;20;5;1;500\n")
    _write(f"{tmp_dir}/EXP_2024.csv",
           "CO_PAIS;CO_ANO;EXTRA;CO_MES;VL_FOB;CO_NCM;SG_UF_NCM;KG_LIQUIDO;QT_ESTAT;CO_VIA\n"
           "40;2024;zz;2;700;1012100;RJ;10;2;7\n")
    rows = sorted(tuple(r) for r in read_raw(spark, tmp_dir, "export").collect())
    assert rows == [(2023, 1, "01012100", "SP", 20, 5, 1, 500), (2024, 2, "1012100", "RJ", 40, 10, 2, 700)]


def test_null_tokens(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2024.csv", EXP_HEADER + '\n2024;1;1;"";NA;;1;NA\n2024;1;;NA;1;1;1;1\n')
    r, r2 = read_raw(spark, tmp_dir, "export").orderBy("CO_PAIS").collect()
    assert r.SG_UF_NCM == "" and r.CO_PAIS is None and r.KG_LIQUIDO is None and r.VL_FOB is None
    assert r2.CO_NCM is None and r2.SG_UF_NCM is None  # unquoted empty and NA are null


def test_html_error_page_is_refused(spark, tmp_dir):
    _write(f"{tmp_dir}/IMP_2024.csv", "<!DOCTYPE html><html><body>503 Service Unavailable</body></html>\n")
    with pytest.raises(ValueError, match="IMP_2024.csv: not a raw import file"):
        read_raw(spark, tmp_dir, "import")


def test_fractional_measure_raises(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2024.csv", EXP_HEADER + "\n2024;1;1;SP;20;1.5;1;10\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        read_raw(spark, tmp_dir, "export").collect()


def test_latin1_text(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2024.csv", EXP_HEADER + "\n2024;1;1;São;20;1;1;10\n")
    assert read_raw(spark, tmp_dir, "export").first().SG_UF_NCM == "São"


def test_other_flow_files_skipped_and_route(spark, tmp_dir):
    _write(f"{tmp_dir}/imp-data-1999/EXP_2024.csv", EXP_HEADER + "\n2024;1;1;SP;20;1;1;10\n")
    _write(f"{tmp_dir}/imp-data-1999/IMP_2024.csv", "x\n1\n")
    df = with_file_route(read_raw(spark, tmp_dir, "export", keep_file=True))
    r = df.first()
    assert (r.flow, r.file_year) == ("exp", 2024)  # directories are ignored
    assert route_of("s3://b/imp/1999/EXP_2024_3.csv") == ("export", 2024)


def test_shared_layout_detects_header_mismatch(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2023.csv", EXP_HEADER + "\n2023;1;1;SP;20;5;1;500\n")
    _write(f"{tmp_dir}/EXP_2024.csv",
           "CO_MES;CO_ANO;CO_NCM;SG_UF_NCM;CO_PAIS;KG_LIQUIDO;QT_ESTAT;VL_FOB\n2;2024;1;SP;20;5;1;500\n")
    with pytest.raises(Exception):
        read_raw(spark, tmp_dir, "export", layout="shared").collect()
    got = sorted((r.CO_ANO, r.CO_MES) for r in read_raw(spark, tmp_dir, "export").collect())
    assert got == [(2023, 1), (2024, 2)]


def test_clean_name():
    assert clean_name("CO_ANO") == "co_ano"
    assert clean_name("monthNumber") == "month_number"
    assert clean_name(" No. Pais ") == "no_pais"
    assert clean_name("Código_País") == "codigo_pais"


def test_read_lookup_and_unit_build(spark, tmp_dir):
    _write(f"{tmp_dir}/u/NCM_UNIDADE.csv",
           "CO_UNID;NO_UNID;SG_UNID\n10;QUILOGRAMA LIQUIDO;  KG  \n11;NUMERO (UNIDADE);UN\n"
           "12;METRO QUADRADO;M   2\n13;SEM TRADUCAO;X\n")
    raw = read_lookup(spark, f"{tmp_dir}/u")
    assert raw.columns == ["unit_code", "no_unid", "sg_unid"]
    got = sorted(tuple(r) for r in build_unit_lookup(raw).collect())
    assert got == [
        (10, "Quilograma liquido", "KG", "Net kilogram"),
        (11, "Numero (unidade)", "UN", "Number (unit)"),
        (12, "Metro quadrado", "M 2", "Square meter"),
        (13, "Sem traducao", "X", None),
    ]


def test_product_lookup_distinct_pad_and_key_check(spark, tmp_dir):
    cols = ("ncm string, unit_code string, co_cuci_item string, bec_n3_code string, co_siit string, "
            "isic_class_code string, ncm_description string, ncm_description_pt string, ncm_description_es string")
    rows = [("1012100", "10", "Q", "1", "1", "5", "a", "b", "c")] * 2 + [("123456789", "10", "Q", "1", "1", None, "d", "e", "f")]
    p = build_product_lookup(spark.createDataFrame(rows, cols))
    assert sorted(r.ncm for r in p.collect()) == ["01012100", "123456789"]
    assert dict(p.dtypes)["unit_code"] == "int"
    path = save_lookup(p, tmp_dir, "product")
    assert load_lookup(spark, tmp_dir, "product").count() == 2 and path.endswith("/product")
    dup = p.unionByName(p.where("ncm = '01012100'").withColumn("ncm_description", F.lit("other")))
    with pytest.raises(ValueError, match="repeated keys"):
        save_lookup(dup, tmp_dir, "product")


PAGE = """<html><body><table><tr><td><a href="https://x/ncm/EXP_2023.csv">e23</a></td>
<td><a href="https://x/ncm/IMP_2024.csv">i24</a></td><td><a href="https://x/ncm/EXP_COMPLETA.csv">all</a></td>
<td><a href="https://x/nbm/EXP_2024.csv">nbm</a></td></tr></table>
<a href="https://x/ncm/IMP_2023.csv">outside</a></body></html>"""


def test_discover_files(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    allr = discover_files(pages)
    assert sorted(r.href.rsplit("/", 1)[1] for r in allr.collect()) == ["EXP_2023.csv", "IMP_2023.csv", "IMP_2024.csv"]
    cells = discover_files(pages, in_table_cells=True)
    assert sorted(r.link_year for r in cells.collect()) == [2023, 2024]
    scoped = discover_files(pages, css_scope="table tr td a")
    assert sorted(r.link_year for r in scoped.collect()) == [2023, 2024]
    assert discover_files(pages, css_scope="div a").count() == 0
    with pytest.raises(ValueError, match="selector"):
        discover_files(pages, css_scope="a:hover")
    by_list = discover_files(pages, years=[2024])
    assert [r.href for r in by_list.collect()] == ["https://x/ncm/IMP_2024.csv"]
    plan = spark.createDataFrame([(2023,)], "year int")
    assert sorted(r.href for r in discover_files(pages, years=plan).collect()) == [
        "https://x/ncm/EXP_2023.csv", "https://x/ncm/IMP_2023.csv"]
    assert discover_files(pages, years=[]).count() == 0  # an empty plan finds nothing


def test_find_table_links(spark):
    from tradeflow.sources.links import find_table_links

    page = ('<table><tr><td><a href="https://x/tabelas/PAIS.csv">p</a></td>'
            '<td><a href="https://x/tabelas/PAIS_BLOCO.csv">b</a></td><td><a href="https://x/tabelas/UF.csv">u</a></td>'
            '</tr></table>')
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert [r.href for r in find_table_links(pages, "PAIS").collect()] == ["https://x/tabelas/PAIS.csv"]
    assert find_table_links(pages, "NCM").count() == 0
    with pytest.raises(ValueError):
        find_table_links(pages, "")


def test_compressed_and_plain_files_together(spark, tmp_dir):
    import gzip

    _write(f"{tmp_dir}/EXP_2023.csv", EXP_HEADER + "\n2023;1;1;SP;20;5;1;500\n")
    with gzip.open(f"{tmp_dir}/EXP_2024.csv.gz", "wt", encoding="latin-1") as f:
        f.write("CO_PAIS;" + EXP_HEADER.replace("CO_PAIS;", "") + "\n40;2024;2;7;RJ;10;2;700\n")
    rows = sorted(tuple(r) for r in read_raw(spark, tmp_dir, "export").collect())
    assert rows == [(2023, 1, "1", "SP", 20, 5, 1, 500), (2024, 2, "7", "RJ", 40, 10, 2, 700)]


def test_byte_order_mark(spark, tmp_dir):
    with open(f"{tmp_dir}/EXP_2024.csv", "wb") as f:
        f.write(b"\xef\xbb\xbf" + (EXP_HEADER + "\n2024;1;1;SP;20;5;1;500\n").encode("latin-1"))
    _write(f"{tmp_dir}/EXP_2023.csv", EXP_HEADER + "\n2023;1;1;SP;20;5;1;500\n")
    rows = sorted((r.CO_ANO, r.VL_FOB) for r in read_raw(spark, tmp_dir, "export").collect())
    assert rows == [(2023, 500), (2024, 500)]


def test_header_probe_is_bounded(spark, tmp_dir):
    from tradeflow.sources.raw import HEADER_PROBE_BYTES, header_lines

    with open(f"{tmp_dir}/EXP_2024.csv", "wb") as f:
        f.write(b"x" * (3 * HEADER_PROBE_BYTES))  # no newline at all
    _write(f"{tmp_dir}/EXP_2023.csv", EXP_HEADER + "\r\n2023;1;1;SP;20;5;1;500\r\n")
    got = header_lines(spark, [f"{tmp_dir}/EXP_2024.csv", f"{tmp_dir}/EXP_2023.csv"])
    assert got[f"{tmp_dir}/EXP_2024.csv"] is None  # no line end: Spark reads the header
    assert got[f"{tmp_dir}/EXP_2023.csv"] == EXP_HEADER
    with pytest.raises(ValueError, match="EXP_2024.csv: not a raw export file"):
        read_raw(spark, tmp_dir, "export")


def test_mixed_layout_landing_reads_like_plain(spark, tmp_dir):
    from conftest import SF0001
    from tradeflow.fixtures import Fixtures
    from tradeflow.sources.raw import group_by_header, list_files, write_raw_files

    fx = Fixtures(spark, SF0001)
    mixed, plain = tmp_dir + "/mixed", tmp_dir + "/plain"
    write_raw_files(fx.raw_files("import", layout="legacy").where("CO_ANO < 1998"), mixed, "import")
    write_raw_files(fx.raw_files("import", layout="published").where("CO_ANO >= 1998"), mixed, "import")
    write_raw_files(fx.raw_files("import"), plain, "import")
    assert len(group_by_header(spark, list_files(spark, mixed))) == 2
    a, b = read_raw(spark, mixed, "import"), read_raw(spark, plain, "import")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lookup_with_byte_order_mark(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/pais")
    with open(f"{tmp_dir}/pais/PAIS.csv", "wb") as f:
        f.write(b"\xef\xbb\xbf" + "CO_PAIS;NO_PAIS;NO_PAIS_ING;NO_PAIS_ESP\n20;Bahamas;Bahamas;Bahamas\n".encode("latin-1"))
    df = read_lookup(spark, f"{tmp_dir}/pais", "country")
    assert df.columns[0] == "country_code" and df.first().country_code == 20


def test_crlf_line_endings(spark, tmp_dir):
    with open(f"{tmp_dir}/EXP_2024.csv", "wb") as f:
        f.write((EXP_HEADER + "\r\n2024;1;1;SP;20;5;1;500\r\n2024;2;1;RJ;20;5;1;700\r\n").encode("latin-1"))
    rows = sorted((r.CO_MES, r.SG_UF_NCM, r.VL_FOB) for r in read_raw(spark, tmp_dir, "export").collect())
    assert rows == [(1, "SP", 500), (2, "RJ", 700)]


def test_missing_lookup_is_explained(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="no country lookup"):
        load_lookup(spark, tmp_dir, "country")


def test_header_longer_than_the_probe(spark, tmp_dir):
    from tradeflow.sources.raw import HEADER_PROBE_BYTES

    extra = ";".join(f"EXTRA_{k}" for k in range(HEADER_PROBE_BYTES // 10))
    n = extra.count(";") + 1
    _write(f"{tmp_dir}/EXP_2024.csv", f"{EXP_HEADER};{extra}\n2024;1;1;SP;20;5;1;500{';0' * n}\n")
    (row,) = read_raw(spark, tmp_dir, "export", options={"maxColumns": 20000}).collect()
    assert (row.CO_ANO, row.VL_FOB) == (2024, 500)


def test_text_codes_lose_their_blanks(spark, tmp_dir):
    _write(f"{tmp_dir}/EXP_2024.csv", EXP_HEADER + '\n2024;1; 1012100 ;SP ;20;5;1;500\n2024;1;"";RJ;20;5;1;7\n')
    rows = sorted(((r.CO_NCM, r.SG_UF_NCM) for r in read_raw(spark, tmp_dir, "export").collect()), key=str)
    assert rows == [("1012100", "SP"), (None, "RJ")]


def test_odd_folder_and_file_names(spark, tmp_dir):
    folder = f"{tmp_dir}/a b%20[x]"
    os.makedirs(folder)
    _write(f"{folder}/EXP 2024 {{1}}.csv", EXP_HEADER + "\n2024;1;1;SP;20;5;1;500\n")
    rows = read_raw(spark, folder.replace("[", "\\[").replace("]", "\\]"), "export", keep_file=True).collect()
    assert [(r.CO_ANO, r.VL_FOB) for r in rows] == [(2024, 500)]


def test_many_compressed_files_are_one_scan(spark, tmp_dir):
    import gzip

    from tradeflow.sources.raw import group_by_header, list_files

    for k in range(20):
        with gzip.open(f"{tmp_dir}/EXP_2024_{k}.csv.gz", "wb") as f:
            f.write((EXP_HEADER + f"\n2024;1;{k};SP;20;5;1;500\n").encode("latin-1"))
    assert len(group_by_header(spark, list_files(spark, tmp_dir))) == 1
    assert read_raw(spark, tmp_dir, "export").count() == 20


def test_lookup_dialect(spark, tmp_dir):
    """Doubled quotes, separators and line breaks in text, NA and blanks, as the published files write them."""
    text = (
        "CO_PAIS;NO_PAIS;NO_PAIS_ING;NO_PAIS_ESP\n"
        '1;"a ""b"" c";"tube ""1/2""; steel";"two\nlines"\n'
        '2;NA;"";\n'
        "NA;x;y;z\n"
    )
    _write(f"{tmp_dir}/PAIS.csv", text)
    rows = {r.country_code: tuple(r)[1:] for r in read_lookup(spark, f"{tmp_dir}/PAIS.csv", "country").collect()}
    assert rows == {1: ('a "b" c', 'tube "1/2"; steel', "two\nlines"), 2: (None, "", ""), None: ("x", "y", "z")}


def test_names_stay_unique(spark):
    from tradeflow.sources.names import clean_column_names

    assert clean_column_names(spark.createDataFrame([(1, 2, 3, 4)], ["a", "a_2", "A_", "a-2"])).columns == ["a", "a_2", "a_3", "a_2_2"]


HTML = """<TABLE class=x><TR><TD><A HREF="/ncm/EXP_2020.csv?a=1&amp;b=2">1</A></TD>
<td class="y"><a href='/ncm/EXP_2021.csv'>2</a><table><tr><td>inner</td></tr></table>
<a data-href="/ncm/EXP_1999.csv" href="/ncm/EXP_2022.csv">3</a></td>
<td><a class=z href = "/ncm/EXP_2023.csv" >4</a> <a href=/ncm/EXP_2024.csv>5</a></td>
<!-- <td><a href="/ncm/EXP_1998.csv">gone</a></td> --></TR></TABLE>
<p><a href="/ncm/EXP_2025.csv">outside</a></p><abbr href="/ncm/EXP_1997.csv"></abbr>"""


SELECTED = {
    "a": ["1", "2", "3", "4", "5", "6"], "div a": ["1", "2", "3"], "div.files > a": ["1"], ".files a, table a": ["1", "2", "4", "5"], "#old a": ["3"],
    "div div a": ["2"], "table tr td a": ["4", "5"], "tr > td > a": ["4", "5"], "a[rel]": ["2"], "a[rel='x y']": ["2"], "*.big": ["2"], "td td a": [],
    "div > a": ["1", "2", "3"], "table > tr a": ["4", "5"], "LI > A": ["6"],
}
NESTED = """<div class='new files'><a href=1>x</a><div><a rel="x y" class="big z" href=2></a></div></div><div id=old><a href=3></a></div>
<table><tr><td>1<td><a href=4></a><tr><td><a href=&#53;></a></table><script>document.write('<td><a href="9">');</script><style>a{}</style>
<ul><li>x<li><a href=6></a><img src=x><br/></ul><a>no address</a><!-- <a href=8> -->"""


@pytest.mark.parametrize("scope", list(SELECTED))
def test_selectors(scope):
    from tradeflow.sources.markup import select, selector

    assert select(NESTED, selector(scope)) == SELECTED[scope]


@pytest.mark.parametrize("scope", ["", " ", "a >", "> a", "a,,b", "a:hover", "a + b", "a[href^=x]", "a]"])
def test_other_selectors_raise(scope):
    from tradeflow.sources.markup import selector

    with pytest.raises(ValueError):
        selector(scope)


def test_a_page_is_read_in_linear_time():
    import time

    from tradeflow.sources.markup import select, selector

    def seconds(cells):
        page = "<table>" + "<tr><td><a href='/ncm/EXP_2001.csv'>x</a></td></tr>" * cells + "</table>"
        best = 1e9
        for _ in range(3):
            t = time.process_time()
            assert len(select(page, selector("table tr td a"))) == cells
            best = min(best, time.process_time() - t)
        return best

    assert seconds(16_000) < 6 * seconds(4_000)


def test_links_keep_page_columns(spark):
    from tradeflow.sources.links import extract_links

    rows = [(1, "<a href=' x '>", [1, 2], "p"), (2, None, None, "q"), (3, "<a href=y><a href=z>", [], None)]
    pages = spark.createDataFrame(rows, "id int, html string, tags array<int>, `odd name` string")
    got = extract_links(pages)
    assert got.columns == ["id", "tags", "odd name", "href"]
    assert sorted(map(tuple, got.collect())) == [(1, [1, 2], "p", "x"), (3, [], None, "y"), (3, [], None, "z")]
    with pytest.raises(ValueError, match="href"):
        extract_links(pages.withColumnRenamed("id", "href"))


def test_links_as_an_html_parser_sees_them(spark):
    from tradeflow.sources.links import discover_files

    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "<a name=x>no address</a>")], "id int, html string")
    years = lambda **kw: sorted(r.link_year for r in discover_files(pages, **kw).collect())
    assert years(in_table_cells=True) == [2020, 2021, 2022, 2023, 2024]
    assert years() == [2020, 2021, 2022, 2023, 2024, 2025]
    assert discover_files(pages).where("link_year = 2020").first().href == "/ncm/EXP_2020.csv?a=1&b=2"


def test_plain_pages_are_not_parsed_and_odd_ones_give_the_same(monkeypatch):
    """Pages of plainly written tags never reach the parser; on random pieces, plain or not, both readers agree."""
    import random

    from tradeflow.sources.markup import Matcher, Reader, selector

    pieces = ["<a href='x&amp;y'>", "<A HREF = u class='k raw'>", "<a href=1 href=2>", "</a>", "<ul class=files>", "<li>", "</ul >", "<br/>", "<td>", "<tr>", "<table>",
              "</table>", "<!-- <a href=9> -->", "<script>'<a href=8></a>'</script>", "<style>a{}</style>", "text &copy", "<div id=d>", "</div>", "<a b c=2 href>"]
    odd = ["<", "<!-- a -- b -->", "<!-->", "<a href=a/>", "<a href='&copy=1'>", "<a/href=q>", "<a href='m'class=k>", "<title>", "</title>", "<p", "<a href='", "<script>", "</script",
           "</style x>", "<script/>", "<![CDATA[x]]>", "<!DOCTYPE html>", "<?pi>", "<a \x0bhref=v>", "</>", "<svg>", "<a href=é>"]
    scopes = ["a", "ul.files > li a.raw, td a", "[href]", "table tr td a", "div#d a", "*.files *"]
    readers = {scope: Reader(selector(scope)) for scope in scopes}
    parse = Matcher.feed
    dice = random.Random(7)
    for k in range(4000):
        scope, page = dice.choice(scopes), "".join(dice.choices(pieces + odd if k % 2 else pieces, k=dice.randint(1, 12)))
        monkeypatch.undo()
        matcher = Matcher(selector(scope), "href")
        matcher.feed(page)
        matcher.close()
        if k % 2 == 0:
            monkeypatch.setattr(Matcher, "feed", lambda self, html: pytest.fail(f"parsed: {html}"))
        assert readers[scope].select(page) == [v for v in matcher.found if v is not None], (scope, page)
    monkeypatch.undo()
    assert Matcher.feed is parse
