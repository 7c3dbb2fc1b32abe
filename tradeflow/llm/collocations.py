"""Operator 11, phrase collocations: SON partitioning, then exact counts of all candidates.

Documents are dealt to ``SHARDS`` shards.  A phrase found ``LEAST`` times in all is found at least LEAST * share times in some
shard, so mining every shard at that lowered support loses none.  A shard is mined by all
tasks: LEAST is a fixed number, so a shard as small as one task's input would have support 1 and prune nothing.

1. Words.  Exact counts of all words of each language; those below LEAST are in no candidate.
2. Pairs.  Each task counts its pairs of frequent words by shard (hashes, packed by bucket); a bucket
   adds them up and keeps those with local support.  The union of the shards is a bit filter.
3. Triples and quadruples whose pairs all pass, in the same way.
4. Exact counts.  Every phrase that passes the filters is counted over all documents as text: tasks
   compare words, not hashes, and Spark sums by language and phrase.
5. Scores.  Cuts are joined to the counts of their parts; candidates inside a longer one go; each
   language's best are ranked in two rounds, so that no task sorts a whole language.

A filter has no false negatives; a false positive costs a row in step 4 and nothing else.  Its
size follows the number of words up to ``MOST_BITS`` (32 MB), which bounds what is broadcast: beyond that, more phrases
are counted exactly and the result is the same.  Tasks hold one block of text at a time; texts longer
than a block are cut between pieces.

Defined results: null and empty texts have no words; repeated rows count as often as they occur; ids are
not read; a null language is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, written
from .shingles import blocks, mix, windows_of, words_of

LEAST, LONGEST, TOP, COVER_PERCENT = 30, 4, 2000, 80
#: Shards (a power of two), and groups of a language in the first round of its ranking.
SHARDS, GROUPS = 4, 64
#: Text bytes of a block, entries that a task reduces before it sends them, words for each bucket.
BLOCK_BYTES, CHUNK_ENTRIES, BUCKET_WORDS = 1 << 22, 1 << 21, 1 << 21
LEAST_BITS, MOST_BITS = 20, 28

#: Fixed values of the contract: bytes that end a piece, and all that end a word.
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[_ENDS_PIECE] = 32
_LOWER[9] = 32

_PACKED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


class Tokens:
    """The words of a block of texts: hashes with their language, places, and how many follow in their piece."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, tongue: np.ndarray):
        self.raw = _LOWER[raw]
        hashes, first = words_of(self.raw, starts)
        solid = self.raw != 32
        edge = np.zeros(len(raw) + 1, bool)
        edge[starts] = True
        self.begins = np.flatnonzero(solid & (edge[:-1] | np.r_[True, ~solid[:-1]])) if len(raw) else np.zeros(0, np.int64)
        self.ends = np.flatnonzero(solid & (edge[1:] | np.r_[~solid[1:], True])) + 1 if len(raw) else self.begins
        self.row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        with np.errstate(over="ignore"):
            self.keys = mix(hashes + tongue[self.row])
        piece = np.cumsum(_ENDS_PIECE[raw], dtype=np.int32)[self.begins] if len(raw) else self.row
        n = len(self.keys)
        last = np.flatnonzero(np.r_[(piece[1:] != piece[:-1]) | (self.row[1:] != self.row[:-1]), True]) if n else np.zeros(0, np.int64)
        self.left = np.repeat(last, np.diff(np.r_[-1, last])) - np.arange(n) + 1  # words from here to the piece's end

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words inside a piece."""
        at = np.flatnonzero(self.left >= n)
        return at, windows_of(self.keys, n)[at] if len(at) else self.keys[:0]

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """Exact numbers of the words in this block, and the words."""
        data = self.raw[self.raw != 32]
        offsets = np.r_[0, np.cumsum(self.ends - self.begins)]
        found = pa.Array.from_buffers(pa.large_binary(), len(self.begins), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _tongue(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def sections(raw: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
    """A block, or the parts of its one long text cut where pieces end: (bytes, starts, row of the block or None for all)."""
    if len(starts) > 2 or len(raw) <= 2 * BLOCK_BYTES:
        yield raw, starts, None
        return
    cuts = np.flatnonzero(_ENDS_PIECE[raw])
    at = 0
    while at < len(raw):
        k = int(np.searchsorted(cuts, at + BLOCK_BYTES))
        end = int(cuts[k]) + 1 if k < len(cuts) else len(raw)
        yield raw[at:end], np.array([0, end - at]), 0
        at = end


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tokens, np.ndarray, np.ndarray, pa.Array]]:
    """(tokens, shard of each row, language number of each row, languages) block by block."""
    for b in batches:
        tongues = b.column(1).dictionary_encode()
        number = tongues.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        hashed = np.array([_tongue(x) for x in tongues.dictionary.to_pylist()], np.uint64)
        shards = b.column(2).to_numpy(zero_copy_only=False)
        for a, z, raw, starts in blocks(b.column(0), BLOCK_BYTES):
            for part, part_starts, _ in sections(raw, starts):
                yield Tokens(part, part_starts, hashed[number[a:z]]), shards[a:z], number[a:z], tongues.dictionary


class BitFilter:
    """A set of hashes by their upper bits: no false negatives."""

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bit_filter(keys: DataFrame, bits: int) -> BitFilter:
    """The filter of the longs in column ``key``: Spark builds its slices of 32,768 bits, ``2 ** bits`` bits in all."""
    place = F.shiftrightunsigned("key", 64 - bits) + 1
    slices = keys.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    data = np.zeros(1 << bits - 3, np.uint8)
    for r in slices.toLocalIterator():
        data[(r.k - 1) * 4096 : r.k * 4096] = np.frombuffer(r.bits, np.uint8)[: len(data)]
    return BitFilter(bits, data)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tokens, _, number, tongues in read(batches):
        if len(tokens.keys):
            ids, words = tokens.ids()
            key, at, n = np.unique(number[tokens.row] * len(words) + ids, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [tongues.take(pa.array(key // len(words))).cast(pa.string()), words.take(pa.array(key % len(words))).cast(pa.large_string()).cast(pa.string()),
                 pa.array(tokens.keys[at].astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "phrase", "key", "f"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, key, f): every word's exact count; ``key`` is its hash."""
    found = docs.mapInArrow(_count_words, "lang string, phrase string, key long, f long")
    return found.groupBy("lang", "phrase", "key").agg(F.sum("f").alias("f"))


def _entries(find: Callable[[Tokens], Iterator[tuple[np.ndarray, np.ndarray]]], prefix: int):
    """Grams by bucket, counted inside the task; counts saturate far above any support.

    A bucket is the first ``prefix`` bits of the hash.  The next 32 travel, the shard in the lowest of them:
    buckets follow the number of words, so equal bits rarely mean different grams, and then only add a candidate.
    """
    low = np.uint64(SHARDS - 1)

    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        keys, counts = summed(keys, counts)
        bucket = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket) != 0]) if len(keys) else np.zeros(0, np.int64)
        ends = np.r_[cuts[1:], len(keys)]
        keys = keys.astype(np.uint32)
        rows = [{"bucket": int(bucket[a]), "keys": keys[a:z].tobytes(), "counts": counts[a:z].tobytes()} for a, z in zip(cuts, ends)]
        return pa.RecordBatch.from_pylist(rows, schema=_PACKED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for tokens, shards, _, _ in read(batches):
            for at, keys in find(tokens):
                keys = (keys >> np.uint64(32 - prefix)) & ~low | shards[tokens.row[at]].astype(np.uint64)
                held.append(summed(keys, np.ones(len(keys), np.uint8)))
                size += len(held[-1][0])
            if size >= CHUNK_ENTRIES:
                yield packed(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield packed(*map(np.concatenate, zip(*held)))

    return work


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order with their counts added up, 255 at most."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts, starts, dtype=np.int64) if len(starts) else counts
    return keys[starts], np.minimum(total, 255).astype(np.uint8)


def _frequent(support: list[int], prefix: int):
    """The grams of a bucket that have their shard's local support in some shard."""
    wanted = np.array(support, np.int64)

    def work(bucket: pa.Table) -> pa.Table:
        joined = lambda c, kind: np.frombuffer(b"".join(bucket.column(c).to_pylist()), kind)
        keys, counts = summed(joined("keys", np.uint32), joined("counts", np.uint8))
        keys = keys[counts >= wanted[keys & (SHARDS - 1)]]
        keys = np.unique(keys & np.uint32(0xFFFFFFFF - (SHARDS - 1))).astype(np.uint64)
        keys = (np.uint64(bucket.column("bucket")[0].as_py()) << np.uint64(32) | keys) << np.uint64(32 - prefix)
        return pa.table({"key": pa.array(keys.astype(np.int64))})

    return work


def mined(docs: DataFrame, find, support: list[int], prefix: int, bits: int) -> BitFilter:
    """The grams of ``find`` with local support in a shard."""
    sent = docs.mapInArrow(_entries(find, prefix), "bucket int, keys binary, counts binary")
    return bit_filter(sent.groupBy("bucket").applyInArrow(_frequent(support, prefix), "key long"), bits)


def _pairs(tokens: Tokens, common: BitFilter) -> tuple[np.ndarray, np.ndarray]:
    at, keys = tokens.grams(2)
    known = common(tokens.keys)
    both = known[at] & known[at + 1] if len(at) else np.zeros(0, bool)
    return at[both], keys[both]


def _longer(tokens: Tokens, common: BitFilter, pairs: BitFilter) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first word, hash) of the runs of 3 words and more whose pairs all pass."""
    at, keys = _pairs(tokens, common)
    good = np.zeros(len(tokens.keys) + LONGEST, bool)
    good[at[pairs(keys)]] = True
    for n in range(3, LONGEST + 1):
        at, keys = tokens.grams(n)
        whole = np.logical_and.reduce([good[at + k] for k in range(n - 1)]) if len(at) else np.zeros(0, bool)
        yield n, at[whole], keys[whole]


def _count_phrases(common: BitFilter, pairs: BitFilter, longer: BitFilter):
    """Counts of all phrases that pass the filters; equal hashes are told apart by their words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _, number, tongues in read(batches):
            if not len(tokens.keys):
                continue
            ids, _ = tokens.ids()
            text = tokens.raw.tobytes()
            at, keys = _pairs(tokens, common)
            found = [(2, at, keys, pairs)] + [(n, at, keys, longer) for n, at, keys in _longer(tokens, common, pairs)]
            for n, at, keys, passes in found:
                some = passes(keys)
                at, keys = at[some], keys[some]
                if not len(at):
                    continue
                order = np.argsort(keys, kind="stable")
                at, keys = at[order], keys[order]
                new = keys[1:] != keys[:-1]
                for column in (number[tokens.row[at]], *[ids[at + k] for k in range(n)]):
                    new |= column[1:] != column[:-1]
                starts = np.flatnonzero(np.r_[True, new])
                counts = np.diff(np.r_[starts, len(at)])
                first = at[starts]
                spans = zip(tokens.begins[first].tolist(), tokens.ends[first + n - 1].tolist())
                phrases = [b" ".join(text[a:z].split()).decode() for a, z in spans]
                yield pa.RecordBatch.from_arrays(
                    [tongues.take(pa.array(number[tokens.row[first]])).cast(pa.string()), pa.array(phrases, pa.string()),
                     pa.array(np.full(len(first), n, np.int32)), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "n_words", "f"])

    return work


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(counts, totals): (lang, phrase, n_words, f) of all phrases of 1 to 4 words found ``least`` times, and (lang, n)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(text), F.lit(SHARDS)).cast("int").alias("shard"))
    shares = {r.shard: r.n for r in docs.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    whole = max(1, sum(shares.values()))
    # Ceiling of least * share: exact in integers, 1 at least, and no more than a counter holds.
    support = [min(255, max(1, -(-least * shares.get(k, 0) // whole))) for k in range(SHARDS)]
    words = written(word_counts(docs), "collocation-words")
    size = words.agg(F.sum("f").alias("n")).first().n or 0
    bits = min(MOST_BITS, max(LEAST_BITS, size.bit_length() - 1))
    prefix = min(MOST_BITS, max(4, math.ceil(size / BUCKET_WORDS).bit_length()))
    share = docs.sparkSession.sparkContext.broadcast
    common = share(bit_filter(words.where(F.col("f") >= least).select("key"), bits))
    pairs = share(mined(docs, lambda t: iter([_pairs(t, common.value)]), support, prefix, bits))
    longer = share(mined(docs, lambda t: ((at, keys) for _, at, keys in _longer(t, common.value, pairs.value)), support, prefix, bits))
    exact = docs.mapInArrow(lambda batches: _count_phrases(common.value, pairs.value, longer.value)(batches), "lang string, phrase string, n_words int, f long")
    exact = exact.groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))
    single = words.select("lang", "phrase", F.lit(1).alias("n_words"), "f")
    counts = written(exact.unionByName(single).where(F.col("f") >= least), "collocation-counts")
    return counts, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", first, n), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of 2 words and more, by its lowest-scoring cut."""
    found = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("_left"), _part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("_right"))
    left = counts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.select("*", F.expr("2000000BD * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").alias("score"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame, percent: int = COVER_PERCENT) -> DataFrame:
    """(lang, phrase): phrases inside a longer one that has at least ``percent`` of their count."""
    longer = counts.where("n_words > 2").select("lang", "n_words", F.col("f").alias("cover"), F.split("phrase", " ").alias("words"))
    inner = longer.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("n") + 1)))
    cover = inner.groupBy("lang", _part(F.col("first"), F.col("n")).alias("phrase")).agg(F.max("cover").alias("cover"))
    exact = f"{percent}BD * cast(f as decimal(20,0)) <= 100BD * cast(cover as decimal(20,0))"
    return cover.join(counts.select("lang", "phrase", "f"), ["lang", "phrase"]).where(exact).select("lang", "phrase")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts, totals = frequent_phrases(docs, least)
    kept = scored(counts).join(covered(counts), ["lang", "phrase"], "left_anti")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    group = F.pmod(F.xxhash64("phrase"), F.lit(GROUPS))
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", group).orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


OP11_SQL = f"""
WITH piece AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[.,;:!?\\n\\x0b\\x0c\\r]')) AS piece FROM documents) t),
total AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM piece GROUP BY lang),
run AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM piece),
gram AS (SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, words, i, unnest(range(1, {LONGEST + 1})) AS m FROM run) t
    WHERE i + m - 1 <= len(words)),
f AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM gram GROUP BY lang, m, phrase HAVING count(*) >= {LEAST}),
cut AS (SELECT lang, phrase, f AS a, w, m, unnest(range(1, m)) AS k FROM f WHERE m > 1),
score AS (SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * c.a // (l.f + r.f) AS BIGINT) AS score
    FROM cut c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')),
best AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, f, w, m, n, unnest(range(1, m - n + 2)) AS i FROM (SELECT lang, f, w, m, unnest(range(2, m)) AS n FROM f WHERE m > 2) t),
cover AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(f) AS cover FROM part GROUP BY 1, 2),
kept AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score FROM best b LEFT JOIN cover c ON c.lang = b.lang AND c.phrase = b.phrase
    WHERE c.cover IS NULL OR 100::HUGEINT * c.cover < {COVER_PERCENT}::HUGEINT * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, CAST(r.rank AS BIGINT) AS rank, r.phrase, CAST(r.a AS BIGINT) AS a, CAST(r.l AS BIGINT) AS l, CAST(r.r AS BIGINT) AS r, t.n, r.score
FROM ranked r JOIN total t ON t.lang = r.lang WHERE r.rank <= {TOP}
"""

__all__ = ["collocations", "frequent_phrases", "scored", "covered", "op11_son_collocations", "OP11_SQL"]
