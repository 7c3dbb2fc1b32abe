"""Column helpers: the four places where the obvious built-in gives another answer."""

import pytest
from pyspark.sql import functions as F

from tradeflow.functions import exact_long, pad_code, period, sentence_case, squish, strict_sum


def test_strict_sum_null_poisons_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", 2), ("b", 5)], "k string, v bigint")
    got = {r.k: r.s for r in df.groupBy("k").agg(strict_sum("v").alias("s")).collect()}
    assert got == {"a": None, "b": 7}
    # plain sum would skip the null
    assert df.where("k = 'a'").agg(F.sum("v")).first()[0] == 4


def test_strict_sum_overflow_raises(spark):
    df = spark.createDataFrame([(2**62,), (2**62,)], "v bigint")
    with pytest.raises(Exception, match="(?i)overflow"):
        df.agg(strict_sum("v")).collect()


def test_pad_code_never_truncates(spark):
    df = spark.createDataFrame([("1234567",), ("12345678",), ("123456789",), (None,)], "c string")
    got = [r[0] for r in df.select(pad_code("c")).collect()]
    assert got == ["01234567", "12345678", "123456789", None]
    # lpad would cut the 9-digit code
    assert df.select(F.lpad("c", 8, "0")).collect()[2][0] == "12345678"


def test_exact_long_raises_on_fraction(spark):
    ok = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert [r[0] for r in ok.select(exact_long("v", "v", ok.schema["v"].dataType)).collect()] == [1, None, 3]
    bad = spark.createDataFrame([(1.5,)], "v double")
    with pytest.raises(Exception, match="not a whole number"):
        bad.select(exact_long("v", "v", bad.schema["v"].dataType)).collect()


def test_exact_long_string_malformed_raises(spark):
    df = spark.createDataFrame([("1.5",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        df.select(exact_long("v", "v", df.schema["v"].dataType)).collect()


def test_sentence_case_and_squish(spark):
    df = spark.createDataFrame([("METRO QUADRADO", "  M \t  2 "), ("numero (unidade)", "UN")], "n string, s string")
    got = [tuple(r) for r in df.select(sentence_case("n"), squish("s")).collect()]
    assert got == [("Metro quadrado", "M 2"), ("Numero (unidade)", "UN")]


def test_period(spark):
    df = spark.createDataFrame([(2024, 3), (1997, 12)], "y int, m int")
    assert [r[0] for r in df.select(period("y", "m")).collect()] == ["2024-03", "1997-12"]


def test_strict_sums_shared_mask(spark):
    from tradeflow.functions import strict_sums

    df = spark.createDataFrame(
        [("a", 1, 10), ("a", None, 20), ("b", 2, None), ("b", 3, 4), ("c", None, None)], "k string, x bigint, y bigint")
    aggs, finals = strict_sums(["x", "y"])
    got = {r.k: (r.x, r.y) for r in df.groupBy("k").agg(*aggs).select("k", finals["x"].alias("x"),
                                                                        finals["y"].alias("y")).collect()}
    assert got == {"a": (None, 30), "b": (5, None), "c": (None, None)}
