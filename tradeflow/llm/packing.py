"""Operator 2, harmonic packing: token sequences of at most 2,048 ids with little padding.

A document of length n up to the capacity belongs to reciprocal-capacity class k = capacity // n, that is
n lies in (capacity / (k + 1), capacity / k], and a bin of class k takes exactly k documents, whole.
What a full bin leaves free, its room, is filled from documents longer than a sequence: they must be cut
anyhow, so each first fills the rooms that wait, then whole sequences, and its remainder joins its class.
Only where more than ``MOST_ROOMS`` rooms wait is a document that would fit cut to fill them; README gives their share.
Every worker fills its own bins, so nothing is
shuffled; sequence ids carry the partition number.  What is left in open bins and rooms when a
worker ends is laid end to end and cut at the capacity, the last part at powers of two,
which need no padding.

Memory: the open bins, below one capacity of ids for each class (at most ~150 classes), and the bins with rooms.

Defined results: a null or empty text is one piece that holds the end id alone; repeated
rows and null ids are packed row by row; texts of any length are cut into several
sequences; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .tokens import default_tokenizer, library_ids

CAPACITY = 2048
END_ID = 1
#: Bins that may wait for a long document; beyond that, the next document fills them.
MOST_ROOMS = 64

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class HarmonicPacker:
    """The bins of one worker.  A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.capacity = capacity
        self.next_id = worker << 40
        self.open: dict[int, list[tuple]] = defaultdict(list)
        self.rooms: deque[tuple[list[tuple], int]] = deque()

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            yield doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, self.next_id, offset
            offset += len(ids) // 4
        self.next_id += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        n, start = len(ids) // 4, 0
        piece = lambda a, z: (doc_id, a, ids[4 * a : 4 * z], n)
        if n > self.capacity or len(self.rooms) >= MOST_ROOMS:
            while self.rooms and start < n:
                bin_, room = self.rooms.popleft()
                end = min(n, start + room)
                bin_.append(piece(start, end))
                if end - start == room:
                    yield from self._close(bin_)
                else:
                    self.rooms.appendleft((bin_, room - end + start))
                start = end
            while n - start >= self.capacity:
                yield from self._close([piece(start, start + self.capacity)])
                start += self.capacity
        if start < n:
            k = self.capacity // (n - start)
            bin_ = self.open[k]
            bin_.append(piece(start, n))
            if len(bin_) == k:
                room = self.capacity - sum(len(p[2]) // 4 for p in self.open.pop(k))
                if room:
                    self.rooms.append((bin_, room))
                else:
                    yield from self._close(bin_)

    def finish(self) -> Iterator[tuple]:
        """Bins with rooms and open bins end to end: full sequences, then one for each power of two of the rest."""
        left = [p for bin_, _ in self.rooms for p in bin_] + [p for k in sorted(self.open) for p in self.open[k]]
        self.rooms.clear()
        self.open.clear()
        total = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in range(total.bit_length(), -1, -1) if (total % self.capacity) >> b & 1]
        k = at = 0
        for size in sizes:
            taken, room = [], size
            while room:
                doc_id, start, ids, doc_tokens = left[k]
                n = min(room, len(ids) // 4 - at)
                taken.append((doc_id, start + at, ids[4 * at : 4 * (at + n)], doc_tokens))
                room, at = room - n, at + n
                if at == len(ids) // 4:
                    k, at = k + 1, 0
            yield from self._close(taken)


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences of at most ``capacity`` (a power of two) ids."""
    if capacity < 2 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    path = tokenizer_path or default_tokenizer()
    end = END_ID.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = library_ids(path)
        packer = HarmonicPacker(TaskContext.get().partitionId(), capacity)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[] for _ in _ARROW]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)

        for b in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                rows.extend(packer.add(doc_id, ids_of(text.as_py() or "") + end))
            yield batch(rows)
        yield batch(list(packer.finish()))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, SCHEMA)


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


__all__ = ["pack", "HarmonicPacker", "op2_harmonic_packing"]
