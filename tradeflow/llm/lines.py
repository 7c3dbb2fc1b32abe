"""Operator 13, line dedup: repeated lines stay only in the smallest document that holds them.

DataFrame functions alone; the texts are split once to find repeats and once to apply them.

1. Entries.  Each line whose key is long enough becomes (hash, check, document, position), written to the
   shared scratch folder: 128 hash bits stand for the key, and no text is shuffled.
2. Stream.  Entries are range-partitioned by hash and sorted by document and position inside it.  One
   pass over each partition sees a key's first document first; entries of later documents go.
3. Hot keys.  A sketch of bounded size over all entries names the keys that hold more than 1 in
   ``HOT_ONE_IN`` of them (at most so many).  These alone are spread over ``SALTS`` ranges; the first document of each
   range stays open, and the open entries, at most one document for each key and range, are settled by the key's least document.
   Any list of hot keys gives the same result.
4. Bitmaps.  The entries that go are gathered by document into its keep bitmap, compressed as run
   lengths: the runs (first line, line after the last) of kept lines, the last one open-ended.  Documents
   without a bitmap keep all.  The bitmaps, not texts, are the operator's result; ``dedup_lines`` applies them.

Defined results: a null or empty text is one empty line; rows with one id are one document (its lines
are never repeats of each other, whatever row they are in); rows with a null id are returned whole and
are no source; if no line is left the kept text is empty; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANKS, let, table, written

#: Shorter keys (in code points) are never repeats.
LEAST_CHARS = 10
#: A key with more than this share of the entries is hot, and is spread over so many ranges.
HOT_ONE_IN, SALTS = 4096, 256
#: Counters of the sketch: it finds every key above about 3.5 / 16,384 of the entries.
TRACKED = 12_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def entries(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(id, version, at, hash, check): the lines that can be repeats.  ``version`` tells texts of one id apart."""
    text = F.col("text").cast("string")
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    rows = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("version"), F.posexplode(lines_of(lower)).alias("at", "line")
    )
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= least)
    return rows.select("id", "version", "at", F.xxhash64("line").alias("hash"), F.xxhash64(F.lit("check"), "line").alias("check"))


def hot_hashes(found: DataFrame) -> list[int]:
    """Hashes that hold more than 1 in ``HOT_ONE_IN`` entries: at most so many, from a sketch of bounded size."""
    top = F.call_function("approx_top_k", F.col("hash"), F.lit(HOT_ONE_IN), F.lit(TRACKED))
    told = found.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [t["item"] for t in told["top"] or [] if t["count"] * HOT_ONE_IN > told["n"]]


def repeats(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(id, version, at): the lines whose key a document with a smaller id holds."""
    found = written(entries(docs, least), "line-entries")
    hot = hot_hashes(found)
    salt = F.when(F.col("hash").isin(hot), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(-1).cast("long"))
    # Without hot keys the range is constant: the planner drops it from the window's keys, so it must not be dealt by.
    found = found.withColumn("range", salt).repartitionByRange(*(["hash", "range"] if hot else ["hash"]))
    stream = W.partitionBy("hash", "check", "range").orderBy("id", "at").rowsBetween(W.unboundedPreceding, 0)
    seen = found.withColumn("open", F.col("id") == F.first("id").over(stream)).where("range >= 0 or not open")
    seen = written(seen, "line-repeats")
    undecided = seen.where("open")
    least_id = undecided.groupBy("hash", "check").agg(F.min("id").alias("least"))
    settled = undecided.join(least_id, ["hash", "check"]).where(F.col("id") > F.col("least"))
    return seen.where("not open").select("id", "version", "at").unionByName(settled.select("id", "version", "at"))


def keep_bitmaps(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(id, version, n_dropped, kept_runs) of each text that loses lines; ``kept_runs`` is its keep bitmap."""
    gathered = repeats(docs, least).groupBy("id", "version").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    gone = F.col("gone")
    starts = F.filter(gone, lambda x, k: F.coalesce(F.get(gone, k - 1) != x - 1, F.lit(True)))
    ends = F.filter(gone, lambda x, k: F.coalesce(F.get(gone, k + 1) != x + 1, F.lit(True)))
    first = F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x + 1))
    last = F.concat(starts, F.array(F.lit(None).cast("int")))
    runs = F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("end")))
    runs = F.filter(runs, lambda r: r["end"].isNull() | (r["first"] < r["end"]))
    return gathered.select("id", "version", F.size("gone").cast("long").alias("n_dropped"), runs.alias("kept_runs"))


def kept(lines: Column, runs: Column) -> Column:
    """The lines inside ``runs``, joined by line breaks."""
    part = lambda r: F.slice(lines, r["first"] + 1, F.coalesce(r["end"], F.size(lines)) - r["first"])
    return F.array_join(F.flatten(F.transform(runs, part)), "\n")


def dedup_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """All columns of ``docs`` as struct ``row``; n_lines, n_dropped and kept_text of every text."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("version"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    )
    joined = rows.join(keep_bitmaps(docs, least), ["id", "version"], "left")
    lines = lines_of(F.col("row.text").cast("string"))
    whole = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    runs = F.col("kept_runs")
    return joined.select(
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(runs.isNull(), whole).otherwise(let(lines, lambda x: kept(x, runs))).alias("kept_text"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_KEY = f"""translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"""

OP13_SQL = f"""
WITH parts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS k FROM parts),
keyed AS (SELECT r, doc_id, k, line, {_KEY} AS line_key FROM (SELECT r, doc_id, k, lines[k] AS line FROM places) t),
firsts AS (SELECT line_key, min(doc_id) AS least FROM keyed WHERE doc_id IS NOT NULL AND length(line_key) >= {LEAST_CHARS}
    GROUP BY line_key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT a.r, a.doc_id, a.k, a.line, coalesce(a.doc_id > f.least, false) AS gone
    FROM keyed a LEFT JOIN firsts f ON a.line_key = f.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

__all__ = ["entries", "repeats", "keep_bitmaps", "dedup_lines", "op13_line_dedup", "OP13_SQL", "LEAST_CHARS"]
