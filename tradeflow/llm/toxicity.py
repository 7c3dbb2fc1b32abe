"""Operator 3, toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Learning.  A token (run of letters, lower-cased) is described by itself and its first 5, 6
and 7 letters, as languages inflect at the end.  For each of these the log-odds of being
in a toxic document against a clean one, with an informative Dirichlet prior: pseudo-counts
in proportion to its share of both classes, so rare ones stay near 0.  Those
at least ``MIN_Z`` standard errors above 0 are kept; a token scores its best one, and a token
without any costs ``DRIFT``, so that the expected score of clean text is negative.

Scanning.  One left-to-right pass finds every maximal-scoring segment of a text in linear
time.  Under clean text a text's best segment follows an extreme-value law,
P(S > x) = 1 - exp(-K n exp(-lambda x)): lambda solves E[exp(lambda s)] = 1 and K is
the maximum-likelihood estimate over clean documents.  A segment is significant
if it is worth more than ln(K n) / lambda.  What all significant segments are worth beyond that,
in nats, is turned into a probability by a one-variable logistic fit.

The fit sees a bounded sample of labelled ids (``SAMPLE_IDS`` of least hash) and
keeps at most ``MAX_WORDS`` words and beginnings.  All texts are scored whole, by a map over the rows without a shuffle.

Defined results: null and empty texts score like any text without a passage; labels with a
null id or mark teach nothing, an id that is labelled twice is toxic if one label says so;
copies of a text teach once; repeated rows are scored row by row; without usable labels
all scores are 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, table, written

SAMPLE_IDS, MAX_WORDS = 16384, 4096
#: The prior's weight as a share of all counts, and the least standard score of a scored word.
PRIOR, MIN_Z = 0.1, 4.0
DRIFT = 0.1
BEGINNINGS = (5, 6, 7)
#: Tokens whose score a task remembers.
MAX_REMEMBERED = 1 << 18
_WORD = regex.compile(r"\p{L}+")


def describe(token: str) -> list[str]:
    """The token, and its beginnings marked by ``*``."""
    return [token, *(token[:k] + "*" for k in BEGINNINGS if len(token) >= k)]


class TokenScores(dict):
    """Score of each token seen (None: the drift), filled on demand and bounded."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, token: str) -> float | None:
        score = max((w for x in describe(token) if (w := self.weights.get(x)) is not None), default=None)
        if len(self) < MAX_REMEMBERED:
            self[token] = score
        return score

    def hits(self, tokens: list[str]) -> list[tuple[int, float]]:
        return [(i, s) for i, s in enumerate(map(self.__getitem__, tokens)) if s is not None]


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  #: lambda
    scale: float = 1.0  #: K
    slope: float = 0.0
    bias: float = -math.inf

    def score(self, text: str | None, scores: TokenScores) -> tuple[float, int]:
        """Probability of toxic, and the number of significant passages."""
        worth = [x for *_, x in passages(text, self, scores)]
        z = self.slope * math.log1p(sum(worth)) + self.bias
        return (0.0 if z == -math.inf else 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))), len(worth)


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def maximal_segments(hits: Iterable[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of tokens that score as in ``hits``, or -drift."""
    found: list[tuple[float, float, int, int, int]] = []  # sums before and after, start, end, link
    total, after = 0.0, 0
    for at, score in hits:
        total -= drift * (at - after)
        low, start, after = total, at, at + 1
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:  # the link skips those known to begin higher
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                found.append((low, total, start, after, j))
                break
            low, start = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, high - low) for low, high, s, e, _ in found]


def passages(text: str | None, model: Model, scores: TokenScores | None = None) -> list[tuple[int, int, float]]:
    """The significant segments of a text: first word, word after the last, worth in nats."""
    tokens = words(text)
    hits = (scores or TokenScores(model.weights)).hits(tokens)
    if not hits:
        return []
    chance = math.log(model.scale * len(tokens))
    return [(a, b, model.rate * s - chance) for a, b, s in maximal_segments(hits) if model.rate * s > chance]


def positive_rate(scores: list[tuple[float, float]], drift: float = DRIFT) -> float:
    """lambda > 0 with sum(p * exp(lambda * s)) = 1 over the scored words and the rest at -drift."""
    rest = 1 - sum(p for p, _ in scores)

    def excess(x: float) -> float:
        return sum(p * math.exp(min(x * s, 700)) for p, s in scores) + rest * math.exp(-x * drift) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def logistic(points: list[tuple[float, int]], steps: int = 30) -> tuple[float, float]:
    """Slope and bias of a one-variable logistic regression, by damped Newton steps with a small ridge."""
    a = b = 0.0
    for _ in range(steps):
        ga, gb, haa, hab, hbb = -1e-3 * a, -1e-3 * b, 1e-3, 0.0, 1e-3
        for x, y in points:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            v = max(p * (1 - p), 1e-6)
            ga, gb = ga + (y - p) * x, gb + y - p
            haa, hab, hbb = haa + v * x * x, hab + v * x, hbb + v
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da) / 2, abs(db) / 2)
        a, b = a + da / size, b + db / size
    return a, b


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 5) == 0


def learn(docs: DataFrame, labels: DataFrame, sample_ids: int = SAMPLE_IDS) -> Model:
    """The model of a bounded sample of ``labels`` (doc_id, toxic) over ``docs`` (doc_id, text); labels but 0 and 1 are left out."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(sample_ids)
    texts = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    texts = written(texts, "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = words(text)
                seen[toxic].update({x for t in set(tokens) for x in describe(t)})
            rows = [(w, seen[0][w], seen[1][w]) for w in {**seen[0], **seen[1]}]
            yield pa.RecordBatch.from_pydict(
                {"word": [r[0] for r in rows], "clean": pa.array([r[1] for r in rows], pa.int64()), "toxic": pa.array([r[2] for r in rows], pa.int64())},
                schema=pa.schema([("word", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]),
            )

    counts = texts.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    counts = written(counts, "toxic-words").where("word != ''")
    total = counts.agg(F.sum("c").alias("c"), F.sum("t").alias("t")).first()
    if not total.c or not total.t:
        return Model()
    prior = PRIOR * (F.col("c") + F.col("t"))
    all_prior = PRIOR * (total.c + total.t)
    odds = [(F.col(k) + prior) / (F.lit(float(n)) + all_prior - F.col(k) - prior) for k, n in (("t", total.t), ("c", total.c))]
    delta = F.log(odds[0]) - F.log(odds[1])
    scored = counts.select("word", delta.alias("delta"), (delta / F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))).alias("z"))
    best = scored.where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(MAX_WORDS).collect()
    weights = {r.word: r.delta for r in best}
    clean = texts.where("toxic = 0").select("text")

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, seen = TokenScores(weights), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(map(scores.__getitem__, words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.float64()), pa.array(list(seen.values()), pa.int64())], names=["score", "n"])

    # One row for each distinct score: at most MAX_WORDS + 1.
    spread = clean.mapInArrow(histogram, "score double, n long").groupBy("score").agg(F.sum("n").alias("n")).collect()
    length = sum(r.n for r in spread) + 1
    rate = positive_rate([(r.n / length, r.score) for r in spread if r.score is not None])
    raw = Model(weights, rate)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TokenScores(weights)
        for b in batches:
            best_of, sizes = [], []
            for text in b.column(0).to_pylist():
                tokens = words(text)
                best_of.append(max((s for *_, s in maximal_segments(scores.hits(tokens))), default=0.0))
                sizes.append(len(tokens))
            yield pa.RecordBatch.from_pydict({"best": pa.array(best_of, pa.float64()), "n": pa.array(sizes, pa.int64())})

    seen = clean.mapInArrow(tops, "best double, n long").where("n > 0")
    fit = seen.agg(F.count("*").alias("n"), F.sum(F.col("n") * F.exp(-rate * F.col("best"))).alias("u")).first()
    raw = Model(weights, rate, (fit.n / fit.u) if fit.n else 1.0)

    def worths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TokenScores(weights)
        for b in batches:
            x = [math.log1p(sum(p[2] for p in passages(t, raw, scores))) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b.column(1)], names=["x", "toxic"])

    rows = texts.mapInArrow(worths, "x double, toxic int").collect()  # bounded: sample_ids
    slope, bias = logistic(sorted((r.x, r.toxic) for r in rows))
    return Model(weights, rate, raw.scale, slope, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and n_passages of every whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TokenScores(model.weights)
        for b in batches:
            found = [model.score(t, scores) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())],
                names=["doc_id", "score", "n_passages"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, "doc_id long, score double, n_passages long")


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages"
    )


__all__ = ["Model", "learn", "score", "passages", "maximal_segments", "positive_rate", "logistic", "words", "held_out", "op3_toxic_segments"]
