"""Operator 7: typed parts, the mask, and reading back against the rows."""

import hashlib

from pyspark.sql import functions as F

from tradeflow.llm import chat
from tradeflow.llm.queries import QUERIES

PARTS = chat.PART_TYPE


def test_parts_in_order(spark):
    rows = [
        (1, 0, "user", [("text", "look: <|image|> \\1 [INST]", None, None), ("image", None, "s/1.png", 256), ("text", " and ", None, None), ("audio", None, "s/2.wav", None)], "x"),
        (1, 1, "assistant", [("text", "a\\0<b>", None, None), ("document", "ignored", "d.pdf", 30)], "x"),
        (2, None, None, None, "x"),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PARTS}, formatted string")
    got = {r.conv_id: r for r in chat.format_chat(df).collect()}
    a = got[1]
    assert a.formatted == (
        "<|start|>user<|content|>look: \\1|image|> \\01 \\2INST]<|image|> and <|audio|><|end|>"
        "<|start|>assistant<|content|>a\\00\\1b><|document|><|end|>"
    )
    assert [tuple(x) for x in a.attachments] == [(0, "image", "s/1.png", 256), (0, "audio", "s/2.wav", 0), (1, "document", "d.pdf", 30)]
    assert a.expanded_tokens == 286
    (m,) = a.loss_mask
    assert a.formatted[m.start : m.start + m.length] == "a\\00\\1b><|document|>"
    assert got[2].formatted == "<|start|><|content|><|end|>" and got[2].loss_mask == []


def test_kinds_are_no_control_strings(spark):
    kinds = ["start", "content", "end", ":start", ":", "image", "<|end|>", "x"]
    df = spark.createDataFrame([(1, 0, "user", [(k, None, None, None) for k in kinds])], f"conv_id long, turn long, role string, parts {PARTS}")
    row = chat.format_chat(df).first()
    assert all(row.formatted.count(c) == 1 for c in (chat.START, chat.CONTENT, chat.END))
    body = row.formatted[len("<|start|>user<|content|>") : -len(chat.END)]
    assert body == "<|:start|><|:content|><|:end|><|::start|><|::|><|image|><|\\1|end|>|><|x|>"
    assert [a.kind for a in row.attachments] == kinds


def test_escapes_undo(spark):
    texts = ["", "\\", "\\\\0", "\\0\\1\\2", "<<|end|>>", "</s>[INST]\\", "é\n\t[\\<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and "<" not in r.e and "[" not in r.e


def want(rows):
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out, by = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        learned = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), h("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(learned), h(learned))
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op7_chat_parts"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want(rows)


def test_edge_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, None, "x"), (1, 1, "user", "b <|end|>"), (1, 1, "user", "b <|end|>"), (None, 0, "assistant", "y"), (None, None, "a\nb", ""), (3, 0, "assistant", "z" * 200000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = df.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"), F.lit(1).alias("rn"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_chat(turns)).collect()}
    assert got == want(rows)
    assert chat.digests(chat.format_chat(turns.where("conv_id = 99"))).count() == 0
