"""Operator 10, document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text's terms are its words, weighted by how often they occur.  A weight above ``PORTION`` is cut
into portions of that size and a rest, each a term of its own: sums of least and of
largest weights stay the same, and no term is heavy.  A term falls into one of ``BINS`` bins by
its hash.  In each bin the gamma-based sampler of Ioffe draws one (term, step) pair: with r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), all made from the term's hash,
step = floor(ln w / r + b) and the pair of least ln c - r * (step - b + 1) is drawn.  Two texts draw the
same pair in a bin with the probability of their generalised Jaccard similarity there, so
the share of equal pairs among the bins that either text uses estimates that of the texts.
One draw for each bin costs one evaluation for each term, not one for each term and place.

The fingerprint is 6 hex digits for each bin in use, in order: the bin (2) and a 16-bit hash
of the pair (4).  Texts with equal word counts have equal fingerprints.

The next document is found without one global sort: ids fall into blocks of consecutive ids
(at most ``MAX_BLOCKS``, so the list of their highest ids has a proven bound and is
broadcast); the highest document of a block also visits the block above it, after that block's
own, and one window over each block reads the neighbour.  The texts are shuffled once.

Defined results: a null text counts as empty; a text without a word has the empty
fingerprint, which is alike (1) to another empty one and unlike (0) to all others; rows of the same
id stand in the order of their texts; rows with a null id come last in descending
order; a single row is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANK_CLASS, let, table

BINS = 128
#: No term weighs more than this.
PORTION = 2
_MIN_BLOCK, MAX_BLOCKS = 1024, 1 << 17


def _uniform(h: Column, high: bool) -> Column:
    """A uniform number in (0, 1) from 32 of the hash's bits."""
    half = F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(0xFFFFFFFF))
    return (half.cast("double") + 0.5) / float(1 << 32)


def _draw(term: Column, weight: Column) -> Column:
    """(bin, ln a, pair) of one weighted term."""
    h1, h2, h3 = (F.xxhash64(term, F.lit(k)) for k in (1, 2, 3))

    def told(h: Column) -> Column:
        r = -F.log(_uniform(h[0], True) * _uniform(h[0], False))
        c = -F.log(_uniform(h[1], True) * _uniform(h[1], False))
        b = _uniform(h[2], True)

        def stepped(x: Column) -> Column:
            step = F.floor(F.log(weight.cast("double")) / x["r"] + b)
            return let(
                step,
                lambda s: F.struct(
                    F.pmod(h[2], F.lit(BINS)).cast("int").alias("bin"),
                    (F.log(x["c"]) - x["r"] * (s - b + 1)).alias("a"),
                    F.xxhash64(term, s).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("pair"),
                ),
            )

        return let(F.struct(r.alias("r"), c.alias("c")), stepped)

    return let(F.array(h1, h2, h3), told)


def codes(text: Column) -> Column:
    """The fingerprint as sorted integers bin * 65536 + pair."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_CLASS), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def drawn(s: Column) -> Column:
        marks = F.transform(s, lambda x, k: F.when((k == 0) | (F.get(s, k - 1) != x), k))
        starts = F.filter(marks, lambda k: k.isNotNull())

        def portions(term: Column, count: Column) -> Column:
            numbers = F.sequence(F.lit(0), F.floor((count - 1) / PORTION).cast("int"))
            return F.transform(numbers, lambda j: _draw(F.xxhash64(term, j), F.least(F.lit(PORTION), count - PORTION * j)))

        return let(
            starts,
            lambda p: F.flatten(F.transform(p, lambda at, k: portions(F.get(s, at), F.coalesce(F.get(p, k + 1), F.size(s)) - at))),
        )

    def least(d: Column) -> Column:  # sorted: the first of each bin is its least
        first = F.filter(d, lambda x, k: (k == 0) | (F.get(d, k - 1)["bin"] != x["bin"]))
        return F.transform(first, lambda x: x["bin"] * 65536 + x["pair"])

    return let(F.sort_array(let(hashes, drawn)), least)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Equal pairs among the bins that either uses; 1 for two empty fingerprints."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    used = F.size(F.array_union(bins(a), bins(b)))
    return F.when(used == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(used, F.lit(1)))


def with_next(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``docs`` (doc_id and ``columns``) with next_<column> of the next document in descending doc_id."""
    lowest = F.lit(-(2**63))
    key = F.coalesce(F.col("doc_id").cast("long"), lowest)
    ids = docs.select(key.alias("key"))
    span = ids.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.min(F.when(F.col("key") != lowest, F.col("key"))).alias("low_id")).first()
    low, high = (span.low_id if span.low_id is not None else 0), (span.high if span.high is not None else 0)
    width = max(_MIN_BLOCK, (high - low) // (MAX_BLOCKS - 2) + 1)
    # Null ids (the lowest key) make a block of their own below all others.
    block = F.when(F.col("key") == lowest, F.lit(-1).cast("long")).otherwise(
        F.floor((F.col("key").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("long")
    )
    tops = ids.groupBy(block.alias("block")).agg(F.max("key").alias("top"))
    # At most MAX_BLOCKS rows, ordered in one task; the lowest block is visited by the highest document.
    order = W.orderBy(F.col("block").asc())
    visits = tops.select("top", F.lead("block").over(order).alias("up"), F.min("block").over(W.partitionBy()).alias("lowest"))
    visits = visits.select("top", F.coalesce("up", "lowest").alias("up"))
    rows = docs.select("doc_id", key.alias("key"), *columns)
    rows = rows.join(F.broadcast(visits), F.col("key") == F.col("top"), "left").withColumn("block", block)
    place = F.array(
        F.struct(F.col("block").alias("block"), F.lit(False).alias("guest")),
        F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("block"), F.lit(True).alias("guest"))),
    )
    rows = rows.select("doc_id", "key", *columns, F.explode(F.filter(place, lambda p: p.isNotNull())).alias("place"))
    rows = rows.select("doc_id", "key", *columns, "place.block", "place.guest")
    within = W.partitionBy("block").orderBy("guest", F.desc("key"), *columns)
    after = rows.select("doc_id", *columns, "guest", *[F.lead(c).over(within).alias(f"next_{c}") for c in columns])
    return after.where(~F.col("guest")).drop("guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.select("doc_id", "text", codes(F.col("text")).alias("fp"))
    pairs = with_next(own, ("text", "fp"))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third), F.substring(F.col("next_text"), F.lit(1), third))
    pairs = pairs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "fp", "next_fp", let(edited, lambda e: F.struct(F.sha2(e.cast("binary"), 256).alias("sha"), codes(e).alias("fp"))).alias("e"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.col("e.sha").alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("e.fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("e.fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


__all__ = ["codes", "likeness", "as_text", "with_next", "fingerprints", "op10_weighted_sampling", "BINS"]
