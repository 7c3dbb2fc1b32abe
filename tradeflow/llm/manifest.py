"""Operator 12, Merkle manifest of a dataset: levels as concatenated hex strings.

A tree joins ``FAN`` nodes to a parent, H of their hex digests laid end to end.  Every row is a leaf of its
source's tree; the sources' roots, in order, are the leaves of the top tree.

1. Ranks.  Leaves are range-partitioned by source and id and numbered inside each partition; partitions'
   counts give the rank inside the source.  A source may span any number of partitions.
2. Blocks.  ``BLOCK`` (FAN * FAN) consecutive nodes form an aligned block: one row that holds its lowest
   level as one hex string.  Fixed-width substrings of it hash to the parents, whose string
   hashes to the block's root.  Block roots are the nodes of the next tier, until one node is left: the number
   of tiers is log BLOCK of the largest source.
3. Siblings.  From the top tier down, each node's siblings are the substrings that flank it in its
   run; a tier's (left, right) segments are joined to the blocks below, one row for each block.  The lowest tier's
   blocks explode last, so no leaf is ever shuffled with its path.

Texts are read once and not shuffled; leaves are written and shuffled as digests, twice (ranks, blocks).  A block's row holds at most
BLOCK leaves whatever the source's size.

Defined results: each row is a leaf, also repeated rows and rows with null or repeated ids (ids ascend,
nulls first, equal ids by leaf); a null field is ``-``, an empty one ``0:``; a null id counts as the
empty text for the choice of tampered rows; a null text stays null; an empty table gives no rows.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_remainder, table, written

FAN = 16
BLOCK = FAN * FAN
#: Hex characters of a digest.
WIDTH = 64
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def parents(level: Column) -> Column:
    """The next level's string: H of each run of FAN digests."""
    run = FAN * WIDTH
    starts = F.sequence(F.lit(0), (F.length(level) - 1).cast("int").bitwiseAND(F.lit(~(run - 1))), F.lit(run))
    return F.array_join(F.transform(starts, lambda k: F.sha2(F.substring(level, k + 1, F.lit(run)), 256)), "")


def flanks(level: Column, k: Column) -> Column:
    """The segments left and right of node ``k`` inside its run."""
    inside = F.pmod(k, F.lit(FAN))
    left = F.substring(level, (k - inside) * WIDTH + 1, inside * WIDTH)
    return F.struct(left.alias("left"), F.substring(level, (k + 1) * WIDTH + 1, (FAN - 1 - inside) * WIDTH).alias("right"))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (``tree``, ...) with rank and size in their tree, numbered by ``order`` without one task for a tree."""
    placed = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), "merkle-ranks")
    counts = placed.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    size, upto = F.sum("_n").over(W.partitionBy("tree")), F.sum("_n").over(W.partitionBy("tree").orderBy("_part"))
    counts = counts.select("tree", "_part", size.alias("size"), (upto - F.col("_n") - F.col("_first")).alias("_offset"))
    joined = placed.join(counts, ["tree", "_part"])
    return joined.withColumn("rank", F.col("_at") + F.col("_offset")).drop("_part", "_at", "_offset")


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Block tables from the lowest tier up.  ``nodes``: tree, size, rank, node and, lowest tier only, ``payload``.

    A block: tree, size (nodes of its tree in this tier), block, payloads, low and high (its two level
    strings; ``high`` is null where the tree needs no second one) and root.
    """
    out = []
    while True:
        items = F.struct("rank", "node", *[c for c in nodes.columns if c == "payload"])
        grouped = nodes.groupBy("tree", "size", F.floor(F.col("rank") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(items)).alias("items"))
        low = grouped.select("tree", "size", "block", *([F.col("items.payload").alias("payloads")] if "payload" in nodes.columns else []),
                             F.array_join("items.node", "").alias("low"))
        high = low.withColumn("high", F.when(F.col("size") > 1, parents(F.col("low"))))
        root = F.when(F.col("size") > FAN, parents(F.col("high"))).otherwise(F.coalesce("high", "low"))
        blocks = written(high.withColumn("root", root), "merkle-blocks")
        out.append(blocks)
        if not blocks.where(F.col("size") > BLOCK).limit(1).count():
            return out
        # Trees with one block are done; the others' block roots are the next tier's nodes.
        nodes = blocks.where(F.col("size") > BLOCK).select(
            "tree", F.ceil(F.col("size") / BLOCK).alias("size"), F.col("block").alias("rank"), F.col("root").alias("node")
        )


def roots(found: list[DataFrame]) -> DataFrame:
    """(tree, root, top): the root of each tree and the tier that ends it."""
    done = [b.where(F.col("size") <= BLOCK).select("tree", "root", F.lit(k).alias("top")) for k, b in enumerate(found)]
    return reduce(DataFrame.unionByName, done)


def with_paths(found: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, rank, info, path, node[, payload]) of the lowest tier's nodes; ``tops``: tree, top, info and path of each tree's root."""
    above = None
    for k in reversed(range(len(found))):
        blocks = found[k]
        ends = tops.where(F.col("top") == k).select("tree", F.lit(0).cast("long").alias("block"), "info", "path")
        joined = blocks.join(ends if above is None else ends.unionByName(above), ["tree", "block"])
        at = F.explode(F.sequence(F.lit(0), (F.length("low") / WIDTH - 1).cast("int")))
        nodes = joined.withColumn("at", at)
        none = F.array().cast(PATH)
        own = F.concat(
            F.when(F.col("size") > 1, F.array(flanks(F.col("low"), F.col("at")))).otherwise(none),
            F.when(F.col("size") > FAN, F.array(flanks(F.col("high"), F.floor(F.col("at") / FAN).cast("int")))).otherwise(none),
        )
        rank = F.col("block") * BLOCK + F.col("at")
        path = F.concat(own, "path")
        if k:
            above = nodes.select("tree", rank.alias("block"), "info", path.alias("path"))
    payload = [F.get("payloads", F.col("at")).alias("payload")] if "payloads" in nodes.columns else []
    node = F.substring("low", F.col("at") * WIDTH + 1, F.lit(WIDTH))
    return nodes.select("tree", rank.alias("rank"), "info", path.alias("path"), node.alias("node"), *payload)


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings along its path give."""
    return F.aggregate(path, start, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def proof(path: Column) -> Column:
    """All siblings, level by level from the leaf to the root, each level left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, payload: tuple[Column, ...] = ()) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, payload columns) of every row; ``payload`` columns are computed beside the leaf."""
    source = F.col("source").cast("string")
    # Nulls first, then the sources bytewise, as a key without nulls.
    tree = F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    beside = F.struct(F.col("doc_id").alias("doc_id"), *payload)
    names = [f.name for f in docs.select(beside.alias("b")).schema["b"].dataType.fields]
    nodes = docs.select(tree.alias("tree"), leaf([F.col(f"`{c}`") for c in fields]).alias("node"), beside.alias("payload"), F.col("doc_id").alias("_id"))
    nodes = written(nodes, "merkle-leaves")  # dealing out by range reads its input twice: digests, not texts
    found = tiers(ranked(nodes, ["_id", "node"]).select("tree", "size", "rank", "node", "payload"))
    subroots = written(roots(found), "merkle-subroots")
    top = tiers(ranked(subroots.select(F.lit("").alias("tree"), F.col("root").alias("node"), F.struct("tree", "top").alias("payload"), F.col("tree").alias("_name")), ["_name"])
                .select("tree", "size", "rank", "node", "payload"))
    ends = roots(top).select("tree", "top", F.struct("root").alias("info"), F.array().cast(PATH).alias("path"))
    sources = with_paths(top, ends).select(
        F.col("payload.tree").alias("tree"), F.col("payload.top").alias("top"), F.struct(F.col("node").alias("subroot"), F.col("info.root").alias("root")).alias("info"), "path"
    )
    rows = with_paths(found, written(sources, "merkle-sources"))
    return rows.select("payload.doc_id", F.col("node").alias("leaf"), "info.subroot", "info.root", "path", *[f"payload.`{c}`" for c in names[1:]])


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(id_remainder(F.col("doc_id"), 5) == 0, leaf([F.col(c) if c != "text" else lower for c in FIELDS]))
    rows = manifest(docs, FIELDS, (tampered.alias("tampered"),))
    folded = fold(F.coalesce("tampered", "leaf"), F.col("path"))
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = r"""
WITH RECURSIVE
field AS (SELECT row_number() OVER () AS r, doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda x: ord(x))),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc
  FROM documents),
leaf AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN (4294967295 - crc) % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM field),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM leaf),
low AS (SELECT s, 0 AS lv, i, leaf AS h, n FROM placed
  UNION ALL SELECT s, lv + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM low WHERE n > 1 GROUP BY s, lv, i // 16, n),
sub AS (SELECT s, h AS subroot, lv AS depth FROM low WHERE n = 1),
high AS (SELECT 0 AS lv, s AS i, subroot AS h, (SELECT count(*) FROM sub) AS n FROM sub
  UNION ALL SELECT lv + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (n + 15) // 16 FROM high WHERE n > 1 GROUP BY lv, i // 16, n),
seg AS (SELECT a.s, a.lv, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS r
  FROM low a JOIN low b ON a.s = b.s AND a.lv = b.lv AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY a.s, a.lv, a.i
  UNION ALL
  SELECT t.s, t.depth + a.lv, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), ''),
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '')
  FROM sub t JOIN high a ON a.i = t.s // CAST(16 ** a.lv AS BIGINT) JOIN high b ON a.lv = b.lv AND a.i // 16 = b.i // 16
  WHERE a.n > 1 GROUP BY t.s, t.depth, a.lv, a.i),
walk AS (SELECT p.r, p.s, t.depth, 0 AS lv, p.i, coalesce(p.tampered, p.leaf) AS h, '' AS proof FROM placed p JOIN sub t ON p.s = t.s
  UNION ALL
  SELECT w.r, w.s, w.depth, w.lv + 1, CASE WHEN w.lv + 1 = w.depth THEN w.s ELSE w.i // 16 END, sha256(g.l || w.h || g.r), w.proof || g.l || g.r
  FROM (SELECT r, s, depth, lv, CASE WHEN lv = depth THEN s ELSE i END AS i, h, proof FROM walk) w JOIN seg g ON g.s = w.s AND g.lv = w.lv AND g.i = w.i),
ended AS (SELECT r, arg_max(h, lv) AS folded_root, sha256(arg_max(proof, lv)) AS proof_sha256 FROM walk GROUP BY r)
SELECT p.doc_id, p.leaf, t.subroot, (SELECT h FROM high WHERE n = 1) AS root, e.proof_sha256, e.folded_root,
  e.folded_root = (SELECT h FROM high WHERE n = 1) AS verified
FROM placed p JOIN sub t ON p.s = t.s JOIN ended e ON e.r = p.r
"""

__all__ = ["manifest", "ranked", "tiers", "roots", "with_paths", "fold", "proof", "leaf", "op12_merkle_manifest", "OP12_SQL", "FAN", "BLOCK"]
