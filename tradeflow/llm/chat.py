"""Operator 7, chat formatting with typed content parts, in DataFrame functions alone.

A turn's content is an ordered array of parts (kind, text, ref, units).  A visitor maps each
part to output text: a text part to its escaped text, any other part to a placeholder
of its kind, in order; the attachment's reference and the tokens that its placeholder
expands to are recorded beside the text.  A conversation becomes

    <|start|>role<|content|>parts<|end|>   for each turn, nothing between

Texts and roles cannot hold a control string of this or another template: ``\\``, ``<`` and
``[`` are written ``\\0``, ``\\1`` and ``\\2``.  A backslash in the output always starts such a
pair, so undoing ``\\2``, ``\\1``, ``\\0`` one after another restores any text.

Turns are put in order by one window over the conversation; the grouping reuses its
partitioning, so there is one shuffle.  One conversation is one training example, hence one row.

Defined results: null texts, roles and kinds count as empty text, empty role and
``attachment``; turns with equal number are ordered by role, then content (null numbers first),
repeated rows are turns of their own; rows with a null conv_id form one conversation;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, table

START, CONTENT, END = "<|start|>", "<|content|>", "<|end|>"
#: Kinds whose placeholder would be one of them.
RESERVED = ("start", "content", "end")
PART_TYPE = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
_ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))


def escape(text: Column) -> Column:
    for plain, safe in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(_ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _kind(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("attachment"))


def visit(part: Column) -> Column:
    """A part's output text: escaped text, or the placeholder of its kind.

    A kind that would read as a control string (``start``, ``content``, ``end``) gets a colon before it, and so
    does one that begins with a colon: placeholders differ from control strings and from each other.
    """
    kind = escape(_kind(part))
    named = F.when(kind.isin(*RESERVED) | kind.startswith(":"), F.concat(F.lit(":"), kind)).otherwise(kind)
    placeholder = F.concat(F.lit("<|"), named, F.lit("|>"))
    return F.when(_kind(part) == "text", escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)


def text_part(text: Column) -> Column:
    """The content of a turn that is one text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    )


def format_chat(turns: DataFrame, learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conversation of ``turns`` (conv_id, turn, role, parts).

    ``formatted``: the text.  ``loss_mask``: for each turn to learn its index, the start of its
    content inside the turn's segment and inside ``formatted``, and its length (code points).
    ``attachments``: turn index, kind, ref and expanded tokens in order; ``expanded_tokens`` their sum.
    """
    parts = F.coalesce(F.col("parts"), F.array().cast(PART_TYPE))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("content"),
        F.transform(
            F.filter(parts, lambda p: _kind(p) != "text"),
            lambda p: F.struct(_kind(p).alias("kind"), p["ref"].alias("ref"), F.coalesce(p["units"], F.lit(0)).alias("n_tokens")),
        ).alias("attached"),
    ).select(
        "*",
        F.concat(F.lit(START), escape(F.col("role")), F.lit(CONTENT)).alias("head"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "content")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    n_chars = F.length("head") + F.length("content") + F.lit(len(END))
    rows = rows.select(
        "*",
        F.row_number().over(order).alias("rn"),
        F.coalesce(F.sum(n_chars.cast("long")).over(before), F.lit(0)).alias("at"),
    )
    one = F.struct("rn", "at", "role", "head", "content", "attached")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("t"))
    learned = F.filter(F.col("t"), lambda t: t["role"].isin(*learn_roles))
    mask = F.transform(
        learned,
        lambda t: F.struct(
            (t["rn"] - 1).alias("turn"),
            F.length(t["head"]).cast("long").alias("turn_start"),
            (t["at"] + F.length(t["head"])).alias("start"),
            F.length(t["content"]).cast("long").alias("length"),
        ),
    )
    attachments = F.flatten(
        F.transform(
            F.col("t"),
            lambda t: F.transform(
                t["attached"],
                lambda a: F.struct((t["rn"] - 1).alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens")),
            ),
        )
    )
    text = F.array_join(F.transform(F.col("t"), lambda t: F.concat(t["head"], t["content"], F.lit(END))), "")
    return grouped.select(
        "conv_id",
        text.alias("formatted"),
        mask.alias("loss_mask"),
        attachments.alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("bigint"), lambda s, a: s + a["n_tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text of texts: array of (segment, role, text)."""
    segments = F.filter(F.split(formatted, r"<\|start\|>"), lambda s, k: k > 0)

    def turn(s: Column) -> Column:
        body = F.substring_index(F.substring_index(s, CONTENT, -1), END, 1)
        return F.struct(
            F.concat(F.lit(START), s).alias("segment"),
            unescape(F.substring_index(s, CONTENT, 1)).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(segments, turn)


def digests(chats: DataFrame) -> DataFrame:
    """What the formatted text and its mask say, read back from them."""

    def told(turns: Column) -> Column:
        lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
        learned = F.transform(
            F.col("loss_mask"),
            lambda m: unescape(F.substring(F.get(turns, m["turn"])["segment"], (m["turn_start"] + 1).cast("int"), m["length"].cast("int"))),
        )
        return F.struct(
            F.size(turns).cast("long").alias("n_turns"),
            F.array_join(lines, "").alias("all"),
            F.array_join(learned, "").alias("learned"),
        )

    read = chats.select("conv_id", "formatted", let(read_back(F.col("formatted")), told).alias("r"))
    return read.select(
        "conv_id",
        F.col("r.n_turns").alias("n_turns"),
        F.sha2(F.col("r.all").cast("binary"), 256).alias("turns_sha256"),
        F.length("r.learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("r.learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns whose text looks like another template's control strings."""
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )


def op7_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    turns = rows.unionByName(probe(spark)).select("conv_id", "turn", "role", text_part(F.col("text")).alias("parts"))
    return digests(format_chat(turns))


#: DuckDB: the digests do not depend on the template, but for formatted_chars, whose rule is written out.
OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS all_text,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned,
    sum(length('<|start|><|content|><|end|>') + length(role) + length(text)
        + length(regexp_replace(role || text, '[^\\<\[]', '', 'g'))) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(all_text) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM g
"""

__all__ = ["format_chat", "read_back", "digests", "text_part", "visit", "escape", "unescape", "op7_chat_parts", "OP7_SQL"]
