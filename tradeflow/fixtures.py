"""Trade-shaped views over the driver's test tables.

The reference ships no data, so the test inputs are derived from the TPC-H-like
tables: a lineitem becomes a raw customs row, parts become products, nations
become countries.  Each builder mirrors one view of ``tradeflow.oracle_sql``
(the DuckDB text), so both engines see the same rows.  All builders are lazy
DataFrames over the parquet tables; their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.operators.normalise import normalise_exports, normalise_imports

# Fixed values of the fixture: flag pair -> state code.
STATE_BY_FLAGS = {"AF": "SP", "AO": "RJ", "NF": "MG", "NO": "ND", "RF": "EX"}
STATE_NAMES = {"SP": "Sao Paulo", "RJ": "Rio de Janeiro", "MG": "Minas Gerais", "ND": "Nao Declarada", "EX": "Exterior"}
# Raw unit names of the fixture (upper case, as published), by index.
UNIT_RAW_NAMES = (
    "QUILOGRAMA LIQUIDO", "NUMERO (UNIDADE)", "MILHEIRO", "PARES", "METRO",
    "METRO QUADRADO", "METRO CUBICO", "LITRO", "MIL QUILOWATT HORA", "QUILATE",
    "DUZIA", "TONELADA METRICA LIQUIDA", "GRAMA LIQUIDO",
    "BILHOES DE UNIDADES INTERNACIONAIS", "QUILOGRAMA BRUTO", "SEM TRADUCAO",
)


def _case(expr: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(expr == k, F.lit(v)) if out is None else out.when(expr == k, F.lit(v))
    return out.otherwise(F.lit(default))


def _s(c: Column) -> Column:
    return c.cast("string")


def _floor_div(c: Column, d: float) -> Column:
    return F.floor(c / F.lit(d)).cast("int")


class Fixtures:
    """Lazy fixture views for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ------------------------------------------------------------------ trade rows
    def raw(self) -> DataFrame:
        """Raw import rows with store column names (ncm unpadded); exports drop freight/insurance."""
        li = self.table("lineitem")
        su = self.table("supplier").select("s_suppkey", "s_nationkey")
        j = li.join(su, li.l_suppkey == su.s_suppkey)
        flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
        return j.select(
            F.year("l_shipdate").cast("int").alias("year"),
            F.month("l_shipdate").cast("int").alias("month"),
            # Every 53rd part is traded under a code that no lookup lists.
            F.when(F.col("l_partkey") % 53 == 0, F.concat(F.lit("9"), F.lpad(_s(F.col("l_partkey")), 7, "0")))
            .otherwise(_s(F.col("l_partkey")))
            .alias("ncm"),
            _case(flags, STATE_BY_FLAGS, "XX").alias("state"),
            F.when(F.col("l_suppkey") % 40 == 39, F.lit(None).cast("int"))
            .when(F.col("s_nationkey") >= 22, F.col("s_nationkey").cast("int") + 900)  # listed nowhere
            .otherwise(F.col("s_nationkey").cast("int"))
            .alias("country_code"),
            F.col("l_quantity").cast("bigint").alias("kg"),
            F.col("l_linenumber").cast("bigint").alias("qty"),
            F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("bigint").alias("fob_value"),
            F.when((F.col("l_linenumber") == 7) & (F.col("l_partkey") % 50 == 0), F.lit(None).cast("bigint"))
            .otherwise(F.floor(F.col("l_extendedprice") * F.col("l_tax")).cast("bigint"))
            .alias("freight"),
            F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("bigint").alias("insurance"),
        )

    def raw_coarse(self) -> DataFrame:
        """All rows with all their products (the name is older than that)."""
        return self.raw()

    def raw_files(self, flow: str, coarse: bool = True, layout: str = "plain") -> DataFrame:
        """The raw rows with the published header names, as found in the yearly files.

        ``layout='plain'``: just the columns the load needs.  ``'published'``: the
        portal's order with extra columns (unit, transport mode, customs office)
        interleaved.  ``'legacy'``: another order, as older files have.
        """
        r = self.raw_coarse() if coarse else self.raw()
        c = {
            "CO_ANO": F.col("year"), "CO_MES": F.col("month"), "CO_NCM": F.col("ncm"),
            "SG_UF_NCM": F.col("state"), "CO_PAIS": F.col("country_code"), "KG_LIQUIDO": F.col("kg"),
            "QT_ESTAT": F.col("qty"), "VL_FOB": F.col("fob_value"), "VL_FRETE": F.col("freight"),
            "VL_SEGURO": F.col("insurance"),
            "CO_UNID": F.col("qty") + 10, "CO_VIA": F.col("kg") % 9, "CO_URF": F.col("fob_value") % 1000,
        }
        orders = {
            "plain": ["CO_ANO", "CO_MES", "CO_NCM", "SG_UF_NCM", "CO_PAIS", "KG_LIQUIDO", "QT_ESTAT", "VL_FOB"],
            "published": ["CO_ANO", "CO_MES", "CO_NCM", "CO_UNID", "CO_PAIS", "SG_UF_NCM", "CO_VIA", "CO_URF",
                          "QT_ESTAT", "KG_LIQUIDO", "VL_FOB"],
            "legacy": ["CO_MES", "CO_ANO", "CO_PAIS", "CO_NCM", "VL_FOB", "SG_UF_NCM", "KG_LIQUIDO", "QT_ESTAT",
                       "CO_UNID"],
        }
        names = list(orders[layout])
        if flow == "import":
            names += ["VL_FRETE", "VL_SEGURO"] if layout != "legacy" else ["VL_SEGURO", "VL_FRETE"]
        return r.select(*[c[n].alias(n) for n in names])

    # ------------------------------------------------------------------ expected stores
    def exports(self) -> DataFrame:
        return normalise_exports(self.raw_coarse())

    def imports(self) -> DataFrame:
        return normalise_imports(self.raw_coarse())

    def imports_fine(self) -> DataFrame:
        return normalise_imports(self.raw())

    # ------------------------------------------------------------------ lookups
    def country_lookup(self) -> DataFrame:
        n = self.table("nation")
        k = _s(F.col("n_nationkey"))
        rows = n.select(
            F.col("n_nationkey").cast("int").alias("country_code"),
            F.lpad(k, 3, "0").alias("country_code_ison3"),
            F.concat(F.lit("N"), F.lpad(k, 2, "0")).alias("country_code_isoa3"),
            F.concat(F.lit("pt "), F.col("n_name")).alias("country_name_pt"),
            F.col("n_name").alias("country_name"),
            F.concat(F.lit("es "), F.col("n_name")).alias("country_name_es"),
        )
        none = self.spark.createDataFrame(
            [(None, None, None, "sem pais", "no country", "sin pais")], rows.schema
        )
        return rows.unionByName(none)

    def state_lookup(self) -> DataFrame:
        return self.spark.createDataFrame(list(STATE_NAMES.items()), "state STRING, state_name STRING")

    def product_lookup(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.lpad(_s(F.col("p_partkey")), 8, "0").alias("ncm"),
            (10 + F.col("p_size") % 17).cast("int").alias("unit_code"),  # code 26 is no unit
            F.concat(F.lit("Q"), _s(F.col("p_size"))).alias("co_cuci_item"),
            (100 + F.col("p_size") % 19).cast("int").alias("bec_n3_code"),
            (1000 + F.col("p_size")).cast("int").alias("co_siit"),
            F.when(F.col("p_partkey") % 97 == 0, F.lit(None).cast("int"))
            .when(F.col("p_size") == 50, F.lit(950))  # no such class
            .otherwise(F.col("p_size").cast("int"))
            .alias("isic_class_code"),
            F.col("p_name").alias("ncm_description"),
            F.concat(F.lit("pt "), F.col("p_name")).alias("ncm_description_pt"),
            F.concat(F.lit("es "), F.col("p_name")).alias("ncm_description_es"),
        )

    def isic_lookup(self) -> DataFrame:
        k = self.table("part").select(F.col("p_size").alias("k")).distinct()
        cols = [F.col("k").cast("int").alias("isic_class_code")]
        ks = _s(F.col("k"))
        cols += [
            F.concat(F.lit("pt class "), ks).alias("isic_class_desc_pt"),
            F.concat(F.lit("class "), ks).alias("isic_class_desc"),
            F.concat(F.lit("es class "), ks).alias("isic_class_desc_es"),
        ]
        for level, div in (("group", 5.0), ("division", 10.0)):
            code = _floor_div(F.col("k"), div)
            cols += [
                code.alias(f"isic_{level}_code"),
                F.concat(F.lit(f"pt {level} "), _s(code)).alias(f"isic_{level}_desc_pt"),
                F.concat(F.lit(f"{level} "), _s(code)).alias(f"isic_{level}_desc"),
                F.concat(F.lit(f"es {level} "), _s(code)).alias(f"isic_{level}_desc_es"),
            ]
        sec = F.chr(65 + _floor_div(F.col("k"), 25.0))
        cols += [
            sec.alias("isic_section_code"),
            F.concat(F.lit("pt section "), sec).alias("isic_section_desc_pt"),
            F.concat(F.lit("section "), sec).alias("isic_section_desc"),
            F.concat(F.lit("es section "), sec).alias("isic_section_desc_es"),
        ]
        rows = k.select(*cols)
        none = self.spark.createDataFrame(
            [(None, "sem classe", "no class", "sin clase", None, "sem grupo", "no group", "sin grupo",
              None, "sem divisao", "no division", "sin division", None, "sem secao", "no section", "sin seccion")],
            rows.schema,
        )
        return rows.unionByName(none)

    def unit_lookup(self) -> DataFrame:
        i = self.table("part").select((F.col("p_size") % 16).alias("i")).distinct()
        si = _s(F.col("i"))
        return i.select(
            (10 + F.col("i")).cast("int").alias("unit_code"),
            F.concat(F.lit("Unidade "), si).alias("unit_description_pt"),
            F.concat(F.lit("U"), si).alias("sg_unid"),
            F.concat(F.lit("Unit "), si).alias("unit_description"),
        )

    def bec_lookup(self) -> DataFrame:
        i = self.table("part").select((F.col("p_size") % 19).alias("i")).distinct()
        si = _s(F.col("i"))
        return i.select(
            (100 + F.col("i")).cast("int").alias("bec_n3_code"),
            F.concat(F.lit("pt n3 "), si).alias("bec_n3_desc_pt"),
            F.concat(F.lit("n3 "), si).alias("bec_n3_desc"),
            F.concat(F.lit("es n3 "), si).alias("bec_n3_desc_es"),
            *self._bec_level(2, 5.0),
            *self._bec_level(1, 10.0),
        )

    @staticmethod
    def _bec_level(level: int, width: float) -> list[Column]:
        code = _floor_div(F.col("i"), width)
        named = [F.concat(F.lit(f"{lang}n{level} "), _s(code)).alias(f"bec_n{level}_desc{suffix}") for lang, suffix in (("pt ", "_pt"), ("", ""), ("es ", "_es"))]
        return [code.alias(f"bec_n{level}_code"), *named]

    # ------------------------------------------------------------------ raw lookup files
    def unit_raw(self) -> DataFrame:
        """Published unit rows (co_unid, no_unid, sg_unid), one per part; the name comes from p_size."""
        p = self.table("part").select("p_partkey", "p_size", "p_brand")
        idx = (F.col("p_size") % 16).cast("int")
        names = F.array(*[F.lit(n) for n in UNIT_RAW_NAMES])
        return p.select(
            F.col("p_partkey").cast("int").alias("co_unid"),
            F.element_at(names, idx + 1).alias("no_unid"),
            F.concat(F.lit("  "), F.regexp_replace(F.col("p_brand"), "#", "   "), F.lit(" ")).alias("sg_unid"),
        )

    def official_feed(self) -> DataFrame:
        """One JSON payload per year of the import rows: the last month shipped that year."""
        r = self.raw().groupBy("year").agg(F.max("month").alias("m"))
        payload = F.concat(
            F.lit('{"data":{"year":"'), _s(F.col("year")), F.lit('","monthNumber":"'), _s(F.col("m")), F.lit('"}}')
        )
        return r.select(F.col("year").cast("int").alias("id"), payload.alias("payload"))

    # ------------------------------------------------------------------ published lookup tables
    # As read from the portal's files: upper-case names, every value a string.
    def _published(self, df: DataFrame, names: dict[str, str]) -> DataFrame:
        return df.select(*[_s(F.col(ours)).alias(theirs) for ours, theirs in names.items()])

    def published_state(self) -> DataFrame:
        su = self.table("supplier")
        return su.select(
            _s(F.col("s_suppkey")).alias("CO_UF"),
            F.concat(F.lit("S"), _s(F.col("s_suppkey"))).alias("SG_UF"),
            F.col("s_name").alias("NO_UF"),
            F.concat(F.lit("R"), _s(F.col("s_nationkey"))).alias("NO_REGIAO"),
        )

    def published_country(self) -> DataFrame:
        return self._published(self.country_lookup(), {
            "country_code": "CO_PAIS", "country_code_ison3": "CO_PAIS_ISON3", "country_code_isoa3": "CO_PAIS_ISOA3",
            "country_name_pt": "NO_PAIS", "country_name": "NO_PAIS_ING", "country_name_es": "NO_PAIS_ESP",
        })

    def published_product(self) -> DataFrame:
        """Every part, unpadded codes, extra columns, and every 7th part listed twice."""
        p = self.table("part")
        rows = p.unionByName(p.where(F.col("p_partkey") % 7 == 0))
        return rows.select(
            _s(F.col("p_partkey")).alias("CO_NCM"),
            _s(10 + F.col("p_size") % 16).alias("CO_UNID"),
            F.substring(_s(F.col("p_partkey")), 1, 6).alias("CO_SH6"),
            F.concat(F.lit("Q"), _s(F.col("p_size"))).alias("CO_CUCI_ITEM"),
            _s(100 + F.col("p_size") % 19).alias("CO_CGCE_N3"),
            _s(1000 + F.col("p_size")).alias("CO_SIIT"),
            _s(F.col("p_size")).alias("CO_ISIC_CLASSE"),
            F.col("p_type").alias("CO_EXP_SUBSET"),
            F.concat(F.lit("pt "), F.col("p_name")).alias("NO_NCM_POR"),
            F.concat(F.lit("es "), F.col("p_name")).alias("NO_NCM_ESP"),
            F.col("p_name").alias("NO_NCM_ING"),
        )

    def published_isic(self) -> DataFrame:
        names = {}
        for lv, pt in (("class", "CLASSE"), ("group", "GRUPO"), ("division", "DIVISAO"), ("section", "SECAO")):
            names[f"isic_{lv}_code"] = f"CO_ISIC_{pt}"
            names[f"isic_{lv}_desc_pt"] = f"NO_ISIC_{pt}"
            names[f"isic_{lv}_desc"] = f"NO_ISIC_{pt}_ING"
            names[f"isic_{lv}_desc_es"] = f"NO_ISIC_{pt}_ESP"
        return self._published(self.isic_lookup(), names)

    def published_bec(self) -> DataFrame:
        return self._published(self.bec_lookup(), {
            "bec_n3_code": "CO_CGCE_N3", "bec_n3_desc_pt": "NO_CGCE_N3", "bec_n3_desc": "NO_CGCE_N3_ING",
            "bec_n3_desc_es": "NO_CGCE_N3_ESP",
            **{f"bec_n{k}_{ours}": f"{theirs}" for k in (2, 1) for ours, theirs in (
                ("code", f"CO_CGCE_N{k}"), ("desc_pt", f"NO_CGCE_N{k}"), ("desc", f"NO_CGCE_N{k}_ING"), ("desc_es", f"NO_CGCE_N{k}_ESP"))},
        })

    def published_unit(self) -> DataFrame:
        u = self.unit_raw()
        return u.select(_s(F.col("co_unid")).alias("CO_UNID"), F.col("no_unid").alias("NO_UNID"),
                        F.col("sg_unid").alias("SG_UNID"))

    def published_cuci(self) -> DataFrame:
        p = self.table("part").select("p_size").distinct()
        ps = _s(F.col("p_size"))
        return p.select(
            F.concat(F.lit("Q"), ps).alias("CO_CUCI_ITEM"),
            F.concat(F.lit("item "), ps).alias("NO_CUCI_ITEM"),
            _s(_floor_div(F.col("p_size"), 2.0)).alias("CO_CUCI_SUB"),
            F.concat(F.lit("sub "), _s(_floor_div(F.col("p_size"), 2.0))).alias("NO_CUCI_SUB"),
            F.concat(F.lit("grupo "), _s(_floor_div(F.col("p_size"), 5.0))).alias("NO_CUCI_GRUPO"),
            F.concat(F.lit("divisao "), _s(_floor_div(F.col("p_size"), 10.0))).alias("NO_CUCI_DIVISAO"),
            F.concat(F.lit("secao "), _s(_floor_div(F.col("p_size"), 25.0))).alias("NO_CUCI_SEC"),
        )
