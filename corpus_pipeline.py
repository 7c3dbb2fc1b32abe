"""The training-data pipeline over ``documents``.

Five stages, in order: language ID, quality rules, near duplicates, substring dedup, packing.  Each takes
all rows that its predecessor kept and is one of the operators of ``tradeflow.llm``; the first four
return the columns they were given, the last the packed pieces.  ``run`` writes every
stage's rows to the shared scratch folder and reads them back for the next.

A stage's scratch tables are deleted when the next stage starts: its rows are written by then.  Tables
that the next stage's documents still read (a stage called on another's lazy result) stay.  So the stages of
one application are called in order, one pipeline at a time.

The near-duplicate stage leaves exactly one row of each class, whether ids are null or repeated; all
other defined results are those of the operators.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeflow.llm import language, neardup, packing, quality, substrings
from tradeflow.llm.common import collected, free, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch tables of the stages called so far.
_SCRATCH: list[str] = []


def stage(work: Stage) -> Stage:
    """A stage that frees what the stages before it have left."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free(spark, _SCRATCH, docs)
        with collected(_SCRATCH):
            return work(spark, docs, sf_dir)

    return run_stage


#: A text whose cosine with every prototype is lower is in no learned language.
LEAST_COSINE = 0.05


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: a letter at least, and a prototype not far from orthogonal."""
    prototypes = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    rows = docs.select("text", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    found = language.predict(rows, prototypes, ("row",))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_COSINE)).select("row.*")


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good by the posterior."""
    return quality.rate(docs).where("kept").select("row.*")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that of smallest id, nulls last."""
    return neardup.one_of_each(docs)


@stage
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that a smaller document has in an equal window."""
    kept = substrings.dedup_substrings(docs)
    text = F.col("kept_text")
    new = {"text": text} | ({"n_chars": F.length(text).cast(dict(docs.dtypes)["n_chars"])} if "n_chars" in docs.columns else {})
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


@stage
def harmonic_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts in token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("packing", harmonic_packing),
]

#: Three stages are no SQL (learned models, a tokenizer): tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, outputs = table(spark, sf_dir, "documents"), []
    for name, work in STAGES[:-1]:
        with collected(outputs):
            docs = written(work(spark, docs, sf_dir), name)
        free(spark, outputs, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
