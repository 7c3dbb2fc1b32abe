"""Column expressions used across the library.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen.  Four exist because the obvious built-in gives a different answer:

* ``strict_sum`` - a group with one null measure sums to null (``sum`` skips it);
* ``pad_code`` - left-pads but never shortens (``lpad`` truncates);
* ``exact_long`` - casts to BIGINT and raises on a fractional value
  (``cast`` truncates 1.5 to 1 even with ANSI on);
* ``null_safe_eq`` (in ``operators.enrich``) - null keys match null keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_sum(c: str | Column) -> Column:
    """Sum that is null as soon as one value of the group is null.

    Both parts are algebraic aggregates, so the partial (map-side) aggregation
    still applies.  The sum is BIGINT and ANSI mode raises on overflow.
    """
    c = _col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def strict_sums(measures: list[str], flags: str = "_null_flags") -> tuple[list[Column], dict[str, Column]]:
    """Strict sums of several measures with one shared null bitmask.

    Returns the aggregate expressions (one ``sum`` per measure and one
    ``bit_or`` of per-row null bits, named ``flags``) and, per measure, the
    final column to select after the aggregation (the sum, or null when a
    value of the group was null).  Compared with one ``strict_sum`` per
    measure this keeps ``n + 1`` aggregate buffers instead of ``2n + 1``, so
    the partial aggregates that cross the shuffle are narrower.
    """
    if len(measures) > 62:
        raise ValueError("at most 62 measures share one bitmask")
    row_bits = None
    for i, m in enumerate(measures):
        bit = F.when(F.col(m).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        row_bits = bit if row_bits is None else row_bits.bitwiseOR(bit)
    aggs = [F.sum(m).alias(m) for m in measures] + [F.bit_or(row_bits.cast("bigint")).alias(flags)]
    finals = {
        m: F.when(F.col(flags).bitwiseAND(F.lit(1 << i)) == 0, F.col(m)) for i, m in enumerate(measures)
    }
    return aggs, finals


def pad_code(c: str | Column, width: int = 8, pad: str = "0") -> Column:
    """Left-pad a code to ``width``; longer codes are kept whole, null stays null."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, pad)).otherwise(c)


def sentence_case(c: str | Column) -> Column:
    """First character upper case, the rest lower case ('METRO QUADRADO' -> 'Metro quadrado')."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def squish(c: str | Column) -> Column:
    """Trim and collapse every run of white space (including Unicode spaces) to one space."""
    return F.trim(F.regexp_replace(_col(c), r"[\s\p{Z}]+", " "))


def period(year: str | Column, month: str | Column) -> Column:
    """'yyyy-mm' from an integer year and month."""
    return F.format_string("%04d-%02d", _col(year), _col(month))


def exact_integer(
    c: str | Column, target: str = "bigint", name: str | None = None, dtype: T.DataType | None = None
) -> Column:
    """Cast to an integer type (``target`` 'int' or 'bigint'), raising instead of rounding or wrapping."""
    c = _col(c)
    if isinstance(dtype, (T.IntegralType, T.StringType)):
        return c.cast(target)
    label = name or "value"
    integral = F.raise_error(F.format_string(f"{label} %s is not a whole number", c.cast("string")))
    return F.when(c.isNull() | (c == F.floor(c)), c.cast(target)).otherwise(integral.cast(target))


def exact_long(c: str | Column, name: str | None = None, dtype: T.DataType | None = None) -> Column:
    """Cast to BIGINT, raising instead of rounding or wrapping.

    Integral and string inputs are cast directly: ANSI mode raises on overflow
    and on malformed strings such as '1.5'.  Fractional inputs (``dtype`` a
    float, double or decimal, or unknown) are checked first, so that 1.5 raises
    where a plain cast would truncate it to 1.
    """
    return exact_integer(c, "bigint", name, dtype)
