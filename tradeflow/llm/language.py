"""Operator 4, language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point, so all workers agree.
A trigram binds its letters, permuted by place: roll(a, 2) * roll(b, 1) * c.  A text
bundles its trigrams: the sum of their vectors, as often as they occur.  A language's
prototype bundles the unit vectors of texts in it, and a text is given the language
whose prototype has the largest cosine with its vector (ties: the smallest name).

Texts are lower-cased, and every run of other characters becomes one blank.  A letter is a
character of Unicode category L.

Prototypes come from a bounded sample of labelled rows (``SAMPLE_IDS`` ids of least
hash, and ``EACH_IDS`` of every language, however rare), so the model does not grow with the table; every text is predicted, whole, by a map
over the rows without a shuffle.

Defined results: ``und`` with score 0 for a null text, a text without a letter, and all texts
where nothing could be learned; rows with a null lang or id teach nothing; repeated rows
are answered row by row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, sampled, table

DIMENSIONS = 1024
#: At most so many labelled ids teach the prototypes, and so many more of each language.
SAMPLE_IDS, EACH_IDS = 8192, 256
UNKNOWN = "und"
#: Trigram vectors kept by a worker (int8), texts bundled at a time, and trigrams of one matrix product.
MAX_TRIGRAMS, BLOCK, SLICE = 1 << 15, 32, 1 << 12
_SCALE = 1 << 20


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams (three code points of 21 bits) and their counts; empty without a letter."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not text:
        return none
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _is_letter()[codes]
    if not letter.any():
        return none
    codes = np.concatenate([[32], np.where(letter, codes, 32), [32]]).astype(np.uint64)
    codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
    keys = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
    return np.unique(keys, return_counts=True)


@lru_cache(maxsize=4096)
def letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64(code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return (2 * bits - 1).astype(np.int8)


def trigram_vector(key: int) -> np.ndarray:
    a, b, c = (letter_vector(key >> shift & 0x1FFFFF) for shift in (42, 21, 0))
    return np.roll(a, 2) * np.roll(b, 1) * c


class Bundler:
    """Texts to vectors.  Trigram vectors are kept in a bounded matrix; a full one is emptied."""

    def __init__(self):
        self.rows: dict[int, int] = {}
        self.matrix = np.zeros((1024, DIMENSIONS), np.int8)

    def _row(self, key: int) -> int:
        if (row := self.rows.get(key)) is None:
            row = self.rows[key] = len(self.rows)
            if row == len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            self.matrix[row] = trigram_vector(key)
        return row

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        """One row for each text; all 0 for a text without a letter."""
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        for at in range(0, len(texts), BLOCK):
            found = [trigrams(t) for t in texts[at : at + BLOCK]]
            of = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
            keys, places = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            order = np.argsort(places, kind="stable")
            of, n, places = of[order], np.concatenate([n for _, n in found])[order], places[order]
            for part in range(0, len(keys), SLICE):  # the bound holds inside a block, whatever its texts
                some = keys[part : part + SLICE].tolist()
                if len(self.rows) + len(some) > MAX_TRIGRAMS:
                    self.__init__()
                a, z = np.searchsorted(places, (part, part + len(some)))
                counts = np.zeros((len(found), len(some)), np.float32)
                counts[of[a:z], places[a:z] - part] = n[a:z]
                rows = [self._row(k) for k in some]
                out[at : at + BLOCK] += counts @ self.matrix[rows].astype(np.float32)
        return out


@lru_cache(maxsize=1)
def bundler() -> Bundler:
    """One for each worker process."""
    return Bundler()


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def learn(docs: DataFrame, sample_ids: int = SAMPLE_IDS) -> dict[str, np.ndarray]:
    """Prototypes (unit vectors) from a sample (``sample_ids``, and ``EACH_IDS`` of each lang) of ``docs`` (doc_id, text, lang).

    Workers send one partial sum for each language and task, and Spark adds them up
    (as integers, so the order does not matter); the driver gets one vector for each language.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(1).to_pylist(), object)
            units = np.rint(_unit(bundler().vectors(b.column(0).to_pylist())) * _SCALE).astype(np.int64)
            for lang in set(langs):
                total[lang] = total.get(lang, 0) + units[langs == lang].sum(axis=0)
        for lang, vector in total.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * DIMENSIONS, "i": np.arange(DIMENSIONS, dtype=np.int32), "v": vector})

    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    parts = sampled(labelled, sample_ids, "lang", EACH_IDS).select("text", "lang").mapInArrow(work, "lang string, i int, v long")
    rows = parts.groupBy("lang", "i").agg(F.sum("v").alias("v")).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("p"))
    found = {r.lang: np.array([x.v for x in r.p], np.float64) for r in rows.orderBy("lang").collect()}
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in found.items() if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, lang_pred and score (cosine, at least 0) of every row."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[k] for k in names]).T if names else np.zeros((DIMENSIONS, 0), np.float32)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            vectors = _unit(bundler().vectors(texts))
            cosine = vectors @ matrix if names else np.zeros((len(texts), 1), np.float32)
            best = cosine.argmax(axis=1) if len(texts) else np.zeros(0, int)
            known = vectors.any(axis=1) & bool(names)
            langs = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            scores = np.where(known, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)], names=[*keep, "lang_pred", "score"]
            )

    inputs = docs.select(*keep, F.col("text").cast("string").alias("text_in"))
    schema = ", ".join(f"`{c}` {t}" for c, t in inputs.dtypes[:-1]) + ", lang_pred string, score double"
    return inputs.mapInArrow(work, schema)


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


__all__ = ["learn", "predict", "trigrams", "trigram_vector", "letter_vector", "Bundler", "held_out", "op4_language_id", "UNKNOWN"]
