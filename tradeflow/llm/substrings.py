"""Operator 1, substring dedup: repeated word k-mers, found by minimiser pieces in place of a De Bruijn graph.

A window of ``WINDOW`` words of one document would be an edge between the word tuples at its ends; no
nodes, degrees or branches are computed, and no edges are joined on shared ends.  A word is removed if a window that covers it also starts in a document with a smaller id.

1. Pieces by minimiser.  Consecutive windows that share their least ``GRAM``-word gram (their
   anchor) form a piece.  Equal windows have equal anchors, so
   a piece can only repeat if its anchor does: one entry for a piece, not for each window, is
   shuffled, to find the anchors that several documents hold.
2. Windows.  The repeated anchors are joined back to their documents' texts.  The windows of those
   pieces alone are shuffled with 96 hash bits; each learns the smallest document that holds it.
3. Spans.  Joined back to the texts once more, windows with an earlier source that
   overlap or touch in their document form one span; its words are cut out.

Skew.  A task first reduces its own share: of equal keys only the entries of its smallest
document are shuffled, the others are settled on the spot.  A passage that a third of all
documents hold thus sends one document's entries from each chunk of text.

Entries travel as packed arrays, one row for each bucket and chunk; the number of buckets follows the size of
the texts, so a bucket stays small.

Defined results: null texts have no words; rows with a null id are returned whole and are
no source; rows with the same id are judged each on its own, and never against each
other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import blocks, mix, window_rows, windows_of, words_of

WINDOW, GRAM = 13, 5
#: Text bytes that a task reduces before it sends entries, and text bytes for each bucket.
CHUNK_BYTES, BUCKET_BYTES = 1 << 23, 1 << 24

PACKED = "bucket int, keys binary, checks binary, spots binary, marks binary, ids binary, crcs binary, counts binary"
FOUND = "id long, crc long, spot long"
_PACKED = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("keys", "checks", "spots", "marks", "ids", "crcs", "counts")]])
_FOUND = pa.schema([("id", pa.int64()), ("crc", pa.int64()), ("spot", pa.int64())])


def anchors(words: np.ndarray, first: np.ndarray, n: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its row, first word, and the hash and place of its least gram (leftmost of equals)."""
    rows, at = window_rows(first, n)
    if not len(at):
        return rows, at, np.zeros(0, np.uint64), at
    grams = windows_of(words, gram)
    least, place = grams[at], at
    for k in range(1, n - gram + 1):
        other = grams[at + k]
        less = other < least
        least, place = np.where(less, other, least), np.where(less, at + k, place)
    return rows, at, least, place


class Chunk:
    """Entries (key, check, row, spot) of consecutive texts, reduced and packed by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.size = 0
        self.ids: list[int] = []
        self.crcs: list[int] = []
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, size: int, ids: list[int], crcs: list[int], keys, checks, rows, spots) -> None:
        self.parts.append((keys, checks, rows + len(self.ids), spots))
        self.ids += ids
        self.crcs += crcs
        self.size += size

    def packed(self) -> Iterator[dict]:
        """Rows to send; settled entries (their key is in a smaller document of the chunk) have bucket -1 - n."""
        if not self.parts:
            return
        keys, checks, rows, spots = (np.concatenate(p) for p in zip(*self.parts))
        all_ids, all_crcs = np.array(self.ids, np.int64), np.array(self.crcs, np.int64)
        smallest, several = by_key(keys, checks, all_ids[rows])
        settled = all_ids[rows] > smallest
        bucket = ((keys >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)
        bucket[settled] = -1 - (all_ids[rows[settled]] % self.buckets)
        order = np.argsort(bucket, kind="stable")  # text order inside a bucket
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else np.zeros(0, int)
        for a, b in zip(cuts, np.r_[cuts[1:], len(order)]):
            e = order[a:b]
            runs = np.flatnonzero(np.r_[True, np.diff(rows[e]) != 0])
            done = bucket[e[0]] < 0
            yield {
                "bucket": int(bucket[e[0]]),
                "keys": b"" if done else keys[e].tobytes(),
                "checks": b"" if done else checks[e].tobytes(),
                "spots": spots[e].astype("<u4").tobytes(),
                "marks": b"" if done else np.packbits(several[e]).tobytes(),
                "ids": all_ids[rows[e[runs]]].tobytes(),
                "crcs": all_crcs[rows[e[runs]]].astype("<u4").tobytes(),
                "counts": np.diff(np.r_[runs, len(e)]).astype("<u4").tobytes(),
            }


def by_key(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the smallest id of its key and check, and whether they occur with several ids."""
    order = np.lexsort((ids, checks, keys))
    k, c, i = keys[order], checks[order], ids[order]
    starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, int)
    lengths = np.diff(np.r_[starts, len(k)])
    smallest, several = np.empty(len(k), np.int64), np.empty(len(k), bool)
    smallest[order] = np.repeat(i[starts], lengths)
    several[order] = np.repeat(i[starts] != i[starts + lengths - 1], lengths)
    return smallest, several


def settle(only_later: bool):
    """What a bucket finds: the entries of keys that several documents hold, or only those of later documents."""

    def work(bucket: pa.Table) -> pa.Table:
        columns = {c: bucket.column(c).to_pylist() for c in bucket.column_names}
        joined = lambda name, kind: np.frombuffer(b"".join(columns[name]), kind)
        counts = joined("counts", "<u4")
        ids, crcs = np.repeat(joined("ids", np.int64), counts), np.repeat(joined("crcs", "<u4").astype(np.int64), counts)
        hit = np.ones(len(ids), bool)
        if columns["bucket"][0] >= 0:
            sizes = [len(k) // 8 for k in columns["keys"]]
            marks = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(columns["marks"], sizes)]).astype(bool)
            smallest, several = by_key(joined("keys", np.uint64), joined("checks", "<u4"), ids)
            hit = ids > smallest if only_later else several | marks
        ids, crcs, spots = ids[hit], crcs[hit], joined("spots", "<u4")[hit].astype(np.int64)
        order = np.lexsort((spots, ids))
        return pa.Table.from_arrays([pa.array(x[order]) for x in (ids, crcs, spots)], schema=_FOUND)

    return work


def _entries(n: int, gram: int, buckets: int, flagged: bool):
    """Pieces (by anchor) of texts, or the single windows of flagged pieces, as packed rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(buckets)
        for b in batches:
            all_ids, all_crcs = b.column(0).fill_null(0).to_pylist(), b.column(1).to_pylist()  # null ids have no entries
            for start, end, raw, starts in blocks(b.column(2)):
                words, first = words_of(raw, starts)
                rows, at, least, place = anchors(words, first, n, gram)
                if flagged:
                    wanted = np.zeros(len(words), bool)
                    spots_of = b.column(3)[start:end]
                    for row in np.flatnonzero(spots_of.is_valid()):
                        wanted[first[row] + spots_of[int(row)].values.to_numpy()] = True
                    keep = np.flatnonzero(wanted[place])
                    keys = windows_of(words, n, seed=1)[at[keep]] if len(keep) else np.zeros(0, np.uint64)
                    second = windows_of(words, n, seed=2)[at[keep]] if len(keep) else keys
                    checks, spots = (second >> np.uint64(32)).astype(np.uint32), at[keep] - first[rows[keep]]
                else:
                    keep = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(rows) != 0)][: len(rows)])
                    keys, checks, spots = mix(least[keep]), np.zeros(len(keep), np.uint32), place[keep] - first[rows[keep]]
                chunk.add(len(raw), all_ids[start:end], all_crcs[start:end], keys, checks, rows[keep], spots)
                if chunk.size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist(list(chunk.packed()), schema=_PACKED)
                    chunk = Chunk(buckets)
        yield pa.RecordBatch.from_pylist(list(chunk.packed()), schema=_PACKED)

    return work


def cut(text: str | None, spots: list[int], n: int) -> tuple[int, int, str, str]:
    """(words, removed words, SHA-256 of the kept words, kept text) of a text whose windows at ``spots`` go."""
    raw = (text or "").encode()
    words = raw.split()
    if not spots:
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), text or ""
    starts = np.unique(np.array(spots, np.int64))
    # Overlapping or touching windows are one path.
    breaks = np.flatnonzero(np.diff(starts) > n) + 1
    paths = list(zip(starts[np.r_[0, breaks]].tolist(), (starts[np.r_[breaks - 1, len(starts) - 1]] + n).tolist()))
    kept, pieces, at, seen = [], [], 0, 0
    offsets = _offsets(raw)
    for a, b in paths:
        kept += words[seen:a]
        pieces.append(raw[at : offsets[a]])
        seen, at = b, (offsets[b] if b < len(words) else len(raw))
    kept += words[seen:]
    pieces.append(raw[at:])
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), b"".join(pieces).decode()


def _offsets(raw: bytes) -> np.ndarray:
    from .shingles import _BLANK

    solid = ~_BLANK[np.frombuffer(raw, np.uint8)]
    return np.flatnonzero(solid & np.r_[True, ~solid[:-1]])


def repeated_windows(docs: DataFrame, n: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, crc, spots): of each text the windows that also start in a document with a smaller id."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    buckets = max(16, math.ceil(size / BUCKET_BYTES))
    gathered = lambda df: df.groupBy("id", "crc").agg(F.collect_list("spot").alias("spots"))
    pieces = docs.where("id is not null").mapInArrow(_entries(n, gram, buckets, False), PACKED)
    pieces = gathered(pieces.groupBy("bucket").applyInArrow(settle(False), FOUND))
    # A left join, as the last one is: both then read one shuffle of the texts.
    windows = docs.join(pieces, ["id", "crc"], "left").select("id", "crc", "text", "spots")
    windows = windows.mapInArrow(_entries(n, gram, buckets, True), PACKED)
    return gathered(windows.groupBy("bucket").applyInArrow(settle(True), FOUND))


def dedup_substrings(docs: DataFrame, n: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All columns of ``docs`` but the text as struct ``row``; n_words, n_removed, kept_sha256 and kept_text (null for a null text) of every text."""
    if not 0 < gram <= n:
        raise ValueError("a gram must be shorter than the window")
    text = F.col("text").cast("string")
    key = (F.col("doc_id").cast("long").alias("id"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), text.alias("text"))
    keyed = docs.select(*key)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # The text travels once; without other columns the last join reads the shuffle of the first.
    wide = keyed if not others else docs.select(*key, F.struct("doc_id", *[docs[f"`{c}`"] for c in others]).alias("row"))
    joined = wide.join(repeated_windows(keyed, n, gram), ["id", "crc"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found = [cut(t, s or [], n) for t, s in zip(texts, b.column(2).to_pylist())]
            a, r, h, k = zip(*found) if found else ((), (), (), ())
            k = [None if t is None else x for t, x in zip(texts, k)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(a, pa.int64()), pa.array(r, pa.int64()), pa.array(h, pa.string()), pa.array(k, pa.string())],
                names=["row", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    kept = joined.select((F.struct(F.col("id").alias("doc_id")) if not others else F.col("row")).alias("row"), "text", "spots")
    schema = f"row {dict(kept.dtypes)['row']}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return kept.mapInArrow(work, schema)


def op1_debruijn_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
spot AS (SELECT r, doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS run
    FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM doc) t),
first AS (SELECT run, min(doc_id) AS least FROM spot GROUP BY run),
gone AS (SELECT r, unnest(range(i, i + {WINDOW})) AS k FROM spot s JOIN first f ON f.run = s.run WHERE s.doc_id > f.least),
cut AS (SELECT r, list(DISTINCT k) AS ks FROM gone GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(len(c.ks), 0) AS BIGINT) AS n_removed,
    sha256(coalesce(array_to_string(CASE WHEN c.ks IS NULL THEN d.words ELSE list_filter(d.words, lambda w, k: NOT list_contains(c.ks, k)) END, ' '), '')) AS kept_sha256
FROM doc d LEFT JOIN cut c ON c.r = d.r
"""

__all__ = ["OP1_SQL", "dedup_substrings", "repeated_windows", "anchors", "cut", "op1_debruijn_substrings", "WINDOW"]
