"""Operator 5, near duplicates: BagMinHash signatures, bands, exact multiset overlap, classes.

A text is the multiset of its five-word shingles (a text of one to four words: one shingle of
all of them).  Two texts are near duplicates if the weighted Jaccard similarity of the
multisets, sum of least counts over sum of largest, is at least 0.8.

Signatures.  A shingle that occurs c times owns the weight levels [0, c), discretised at
0, 1, 2, 4, 8, ...  For each level interval a Poisson process, made from the shingle's hash and the
interval alone, scatters points in time over signature places and weights; a point counts
if its weight lies below c.  Place k keeps its earliest point.  So equal places estimate
weighted Jaccard without bias, and a shingle is left as soon as its next point is
later than the latest place of its text, which is why few points are drawn.

Candidates.  25 bands of 5 places: a pair at 0.8 shares a band with probability 0.99995.
Exact copies are collapsed to one text first; texts, not ids, are compared.  Then each group of equal bands is
worked off in two steps instead of pair by pair.  First its most connected text (the one in the
largest groups over all bands: the text that others are edits of) is compared with all others,
which costs one pair for each member and merges nearly all classes.  Groups that
still hold several classes are finished in blocks: packs of texts outside the group's
largest class against packs of all its texts, a whole pack pair by one inverted index.  So
every pair of texts in different classes that shares a band is verified.  Verification is
exact, on the shingle counts.

Tables that are read twice are written to the shared scratch folder; the driver holds none of them.

Defined results: texts without a word are in no class but that of their exact copies; a class's id is its
smallest doc_id, and null if all its ids are null (rows with a null id are compared as all others);
an id that stands on several texts has the class of each of them; repeated rows share a class; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .shingles import blocks, mix, uniform, window_rows, windows_of, words_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
PLACES = BANDS * ROWS
#: Texts, and bytes of shingles, in a pack of a group that is finished in blocks.
PACK_TEXTS, PACK_BYTES = 64, 1 << 22


def shingle_counts(raw: np.ndarray, starts: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count) of all distinct shingles of each row, in order."""
    words, first = words_of(raw, starts)
    rows, at = window_rows(first, n)
    hashes = windows_of(words, n)[at] if len(at) else np.zeros(0, np.uint64)
    sizes = np.diff(first)
    for k in range(1, n):  # short texts: all words are one shingle
        short = np.flatnonzero(sizes == k)
        if len(short):
            rows = np.r_[rows, short]
            hashes = np.r_[hashes, windows_of(words, k)[first[short]]]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])][: len(rows)])
    return rows[new], hashes[new], np.diff(np.r_[new, len(rows)])


def bag_min_hash(n_rows: int, rows: np.ndarray, hashes: np.ndarray, counts: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signatures (first arrival times) of ``n_rows`` bags; infinite for an empty bag."""
    out = np.full((n_rows, places), np.inf)
    latest = np.full(n_rows, np.inf)
    parts = []
    level, low, high = 0, 0, 1
    while True:  # the intervals [0, 1), [1, 2), [2, 4), ... that a count reaches
        reach = np.flatnonzero(counts > low)
        if not len(reach):
            break
        with np.errstate(over="ignore"):
            seed = mix(hashes[reach] + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))
        parts.append((rows[reach], seed, counts[reach], np.full(len(reach), low), np.full(len(reach), high - low)))
        level, low, high = level + 1, high, high * 2
    if not parts:
        return out
    row, seed, count, low, width = (np.concatenate(x) for x in zip(*parts))
    time, draw = np.zeros(len(row)), 0
    while len(row):
        draw += 1
        with np.errstate(over="ignore"):
            a = mix(seed + np.uint64(draw) * np.uint64(0xA0761D6478BD642F))
            b = mix(a + np.uint64(0xE7037ED1A0B428DB))
        time = time - np.log(uniform(a)) / (places * width)
        live = time < latest[row]
        row, seed, count, low, width, time, b = (x[live] for x in (row, seed, count, low, width, time, b))
        if not len(row):
            break
        place = (b & np.uint64(0xFFFFFFFF)).astype(np.int64) % places
        below = low + width * ((b >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32 < count
        np.minimum.at(out, (row[below], place[below]), time[below])
        touched = np.unique(row)
        latest[touched] = out[touched].max(axis=1)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key for each band (the band's number is part of it)."""
    bits = signatures.view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2])
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return keys.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        bands: list = []
        for first, last, raw, starts in blocks(b.column(2)):
            signatures = bag_min_hash(last - first, *shingle_counts(raw, starts))
            keys = band_keys(signatures)
            bands.extend(k if ok else None for k, ok in zip(keys, np.isfinite(signatures[:, 0])))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "copy", "bands"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, hashes, counts = [], [], []
        for first, last, raw, starts in blocks(b.column(1)):
            rows, h, c = shingle_counts(raw, starts)
            cuts = np.searchsorted(rows, np.arange(last - first + 1))
            for i, j in zip(cuts[:-1], cuts[1:]):
                sizes.append(int(c[i:j].sum()))
                hashes.append(h[i:j].tobytes())
                counts.append(c[i:j].astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())], names=["id", "n", "hashes", "counts"]
        )


def overlap(ha: bytes, ca: bytes, hb: bytes, cb: bytes) -> int:
    """Sum of the least counts of the shingles that two bags share (hashes ascend)."""
    a, b = np.frombuffer(ha, np.uint64), np.frombuffer(hb, np.uint64)
    at = np.minimum(np.searchsorted(a, b), max(0, len(a) - 1))
    both = np.flatnonzero(a[at] == b) if len(a) else np.zeros(0, int)
    return int(np.minimum(np.frombuffer(ca, "<u4")[at[both]], np.frombuffer(cb, "<u4")[both]).sum())


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        u, v, n, m, ha, ca, hb, cb = b.columns
        keep = []
        for i in range(b.num_rows):
            shared = overlap(ha[i].as_py(), ca[i].as_py(), hb[i].as_py(), cb[i].as_py())
            keep.append(shared >= SIMILARITY * (n[i].as_py() + m[i].as_py() - shared))
        yield pa.RecordBatch.from_arrays([u, v], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (u < v) whose similarity is at least 0.8, judged on all shingles."""
    side = lambda k, s: bags.select(F.col("id").alias(k), *[F.col(c).alias(c + s) for c in ("n", "hashes", "counts")])
    both = pairs.join(side("u", "_u"), "u").join(side("v", "_v"), "v")
    both = both.where(F.least("n_u", "n_v") >= SIMILARITY * F.greatest("n_u", "n_v"))
    columns = ("u", "v", "n_u", "n_v", "hashes_u", "counts_u", "hashes_v", "counts_v")
    return both.select(*columns).mapInArrow(_alike, "u long, v long")


def merged(links: DataFrame) -> DataFrame:
    """(old, new): for each class in ``links`` (u, v) the smallest class it hangs together with.

    Every pass moves each class to its smallest neighbour and contracts the links.
    """
    links = written(links.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    found = links.select(F.explode(F.array("u", "v")).alias("old")).distinct().select("old", F.col("old").alias("new"))
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = written(both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("to")).select("at", F.least("at", "to").alias("to")), "step")
        found = written(found.join(step, F.col("new") == F.col("at"), "left").select("old", F.coalesce("to", "new").alias("new")), "classes")
        left = links.join(step.select(F.col("at").alias("u"), F.col("to").alias("a")), "u")
        left = left.join(step.select(F.col("at").alias("v"), F.col("to").alias("b")), "v").where("a != b")
        links = written(left.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    return found


def _reclassed(classes: DataFrame, moved: DataFrame) -> DataFrame:
    """``classes`` (id, class) after the moves (old, new)."""
    after = classes.join(moved, F.col("class") == F.col("old"), "left")
    return written(after.select("id", F.coalesce("new", "class").alias("class")), "classes")


def _packs(members: DataFrame, bags: DataFrame) -> DataFrame:
    """(band, minor, pack): texts of a group, those outside its largest class apart, in packs of bounded size."""
    rows = members.join(bags, "id")
    sizes = rows.groupBy("band", "minor").agg(F.count("*").alias("texts"), F.sum(F.octet_length("hashes")).alias("bytes"))
    slots = F.greatest(F.ceil(F.col("texts") / PACK_TEXTS), F.ceil(F.col("bytes") / PACK_BYTES))
    rows = rows.join(sizes.select("band", "minor", slots.alias("slots")), ["band", "minor"])
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")))
    pack = F.collect_list(F.struct("id", "class", "n", "hashes", "counts")).alias("pack")
    return written(rows.groupBy("band", "minor", "slot").agg(pack), "packs")


def _alike_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (class, class) between the texts of two packs, by one index of the second."""
    for b in batches:
        links: set[tuple[int, int]] = set()
        for left, right in zip(b.column(0), b.column(1)):
            right = [x.as_py() for x in right]
            hashes = np.concatenate([np.frombuffer(x["hashes"], np.uint64) for x in right])
            owner = np.repeat(np.arange(len(right)), [len(x["hashes"]) // 8 for x in right])
            counts = np.concatenate([np.frombuffer(x["counts"], "<u4") for x in right]).astype(np.int64)
            order = np.argsort(hashes, kind="stable")
            hashes, owner, counts = hashes[order], owner[order], counts[order]
            sizes, of = np.array([x["n"] for x in right]), np.array([x["class"] for x in right])
            for x in left:
                x = x.as_py()
                own, times = np.frombuffer(x["hashes"], np.uint64), np.frombuffer(x["counts"], "<u4").astype(np.int64)
                low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
                lengths = high - low
                at = np.repeat(low - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
                shared = np.bincount(owner[at], np.minimum(counts[at], np.repeat(times, lengths)), len(right))
                alike = (shared >= SIMILARITY * (sizes + x["n"] - shared)) & (of != x["class"])
                links.update((x["class"], int(c)) for c in of[alike])
        u, v = zip(*sorted(links)) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


#: What finds a row's text again: its digest, and its id as two columns that are never null.
PLACE = ("copy", "unnamed", "known")


def _copy(text: Column) -> Column:
    """128 bits of the text's digest; a null text counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)), 1, 16)


def _place(copy: Column, doc_id: Column) -> list[Column]:
    values = (copy, doc_id.isNull(), F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")))
    return [c.alias(k) for c, k in zip(values, PLACE)]


def _classed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, copy) of every row, and of every distinct text (copy, doc_id: the smallest, class)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _copy(F.col("text")).alias("copy"), F.col("text").cast("string").alias("text"))
    signed = written(texts.mapInArrow(_signed, "doc_id long, copy binary, bands array<long>"), "signed")
    # Equal texts have equal bands, so any of them will do.  The number is the text's from here on.
    standing = signed.groupBy("copy").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    standing = written(standing.withColumn("id", F.monotonically_increasing_id()), "standing")
    # Of equally connected texts that of smallest doc_id is compared first: edits often have later ids.
    early = F.coalesce(F.bitwise_not("doc_id"), F.lit(-(2**63)))
    places = standing.select("id", early.alias("early"), F.explode("bands").alias("band"))
    shared = places.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = written(places.join(shared, "band").select("band", "id", "early", "size"), "members")
    weight = members.groupBy("id").agg(F.sum("size").alias("weight"))
    classes = weight.select("id", F.col("id").alias("class"))
    # Repeated rows are reduced before the shuffle, and copies of other ids find no partner.
    sought = standing.join(classes.select("id"), "id", "left_semi").select("id", *_place(F.col("copy"), F.col("doc_id")))
    bags = texts.select(*_place(F.col("copy"), F.col("doc_id")), "text").dropDuplicates(list(PLACE)).join(sought, list(PLACE)).select("id", "text")
    bags = written(bags.mapInArrow(_packed, "id long, n long, hashes binary, counts binary"), "bags")
    # First step: each group's most connected text against the others.
    pivots = members.join(weight, "id").groupBy("band").agg(F.max_by("id", F.struct("weight", "early", -F.col("id"))).alias("pivot"))
    paired = written(members.select("band", "id").join(pivots, "band").where("id != pivot"), "paired")
    pairs = paired.select(F.least("id", "pivot").alias("u"), F.greatest("id", "pivot").alias("v")).distinct()
    classes = _reclassed(classes, merged(_verified(written(pairs, "pairs"), bags)))
    # Second step: groups whose other members are still in several classes.
    waiting = written(paired.select("band", "id").join(classes, "id"), "waiting")
    sizes = waiting.groupBy("band", "class").count()
    largest = sizes.groupBy("band").agg(F.max_by("class", F.struct("count", -F.col("class"))).alias("large"), F.count("*").alias("k"))
    packs = _packs(waiting.join(largest.where("k > 1"), "band").select("band", "id", "class", (F.col("class") != F.col("large")).alias("minor")), bags)
    side = lambda k: packs.select("band", "minor", F.col("pack").alias(k))
    both = side("a").where("minor").drop("minor").join(side("b").drop("minor"), "band").select("a", "b")
    classes = _reclassed(classes, merged(both.mapInArrow(_alike_packs, "u long, v long")))
    return signed.select("doc_id", "copy"), standing.join(classes, "id", "left").select("copy", "doc_id", F.coalesce("class", "id").alias("class"))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row of ``docs`` (doc_id, text)."""
    rows, named = _classed(docs)
    names = written(named.groupBy("class").agg(F.min("doc_id").alias("class_id")), "names")
    named = named.select("copy", "class").join(names, "class").select("copy", "class_id")
    return rows.join(named, "copy", "left").select("doc_id", "class_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``: that of smallest id (nulls last), then text digest, then all columns."""
    _, named = _classed(docs)
    first = named.groupBy("class").agg(F.min(F.struct(*_place(F.col("copy"), F.col("doc_id"))[1:], "copy")).alias("place"))
    first = written(first.select("place.*"), "first")
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    rows = docs.select(*_place(_copy(F.col("text")), F.col("doc_id")), row).groupBy(*PLACE).agg(F.min("row").alias("row"))
    return rows.join(first, list(PLACE), "left_semi").select("row.*")


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


__all__ = ["near_classes", "one_of_each", "bag_min_hash", "band_keys", "shingle_counts", "overlap", "merged", "op5_bagminhash"]
