"""Helpers shared by the operators: table reads, scratch tables and name-safe selection."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint_root, ship_package

#: The words of every word-based contract: maximal runs without these six ASCII blanks.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder (written tables survive lost executors)."""
    return f"{checkpoint_root(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


_COLLECTED: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, label)
    if (collector := _COLLECTED.get()) is not None:
        collector.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def collected(paths: list[str]) -> Iterator[None]:
    """The scratch tables written inside (but for those of an inner ``collected``) are noted in ``paths``."""
    token = _COLLECTED.set(paths)
    try:
        yield
    finally:
        _COLLECTED.reset(token)


def source_paths(df: DataFrame) -> list[str]:
    """The folders and files that ``df`` reads, from its plan: no listing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            roots = leaf.relation().location().rootPaths()
            out += [roots.apply(i).toString() for i in range(roots.size())]
    return out


def free(spark: SparkSession, paths: list[str], needed: DataFrame | None = None) -> None:
    """Delete scratch tables, and forget them, but for those that ``needed`` reads."""
    held = [r.split(":", 1)[-1] for r in source_paths(needed)] if needed is not None else []
    for path in list(paths):
        if not any(r == path.split(":", 1)[-1] for r in held):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            paths.remove(path)


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda's variable is never copied into its body."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sampled(docs: DataFrame, n_ids: int, by: str, n_each: int) -> DataFrame:
    """The rows of the ``n_ids`` ids of least hash, and of the ``n_each`` of each value of ``by``: a bounded list, so it is broadcast."""
    order = (F.xxhash64(F.col("doc_id")), F.col("doc_id"))
    ids = docs.where(F.col("doc_id").isNotNull()).select(by, "doc_id").distinct()
    # Two rounds, so that no task ranks all ids of a frequent value.
    each = ids
    for keys in ((by, F.pmod(F.xxhash64("doc_id"), F.lit(64))), (by,)):
        each = each.withColumn("k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("k") <= n_each).select(by, "doc_id")
    each = each.select("doc_id")
    ids = ids.select("doc_id").distinct().orderBy(*order).limit(n_ids).union(each)
    return docs.join(F.broadcast(ids), "doc_id", "left_semi")


__all__ = ["collected", "free", "let", "sampled", "BLANKS", "BLANK_CLASS", "table", "scratch", "written", "id_remainder"]
