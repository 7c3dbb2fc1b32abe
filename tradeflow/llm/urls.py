"""Operator 9, URL filter: host and path rules, then logistic regression on character n-grams.

A url's host and path are cut out by one JVM pattern.  Rules are a short list that the
caller writes (like a filter file), so they become one expression: the longest rule that
fits decides.  Every other url is judged by a logistic regression on hashed character
n-grams of host and path, trained on a small labelled table of urls.  The pages
are only read and mapped: no shuffle, and ``html`` is never read.

Defined results: a null url, or one without ``://``, has an empty host and path and
is judged by the method (no n-gram speaks against it: allowed); repeated rows and null
ids are answered row by row; urls are read whole at any length; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (verdict, host, path); a rule fits its host and all subdomains if the url's path starts with its path.
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: The labelled table: (url, 1 for unwanted).
LABELLED: tuple[tuple[str, int], ...] = (
    ("http://casino-win.example.com/en/12", 1),
    ("https://www.casino-royal.example.net/fr/7.html", 1),
    ("https://best-casino.example.org/de/88/", 1),
    ("http://online-casino.example.com/bonus", 1),
    ("https://m.free-bets.example.com/en/27", 1),
    ("http://sports-bets.example.net/es/2", 1),
    ("http://bets-now.example.org/en/5/", 1),
    ("http://win-poker.example.com/en/31", 1),
    ("https://adult-x.example.net/en/196", 1),
    ("http://m.adult-video.example.com/de/3", 1),
    ("https://xxx-adult.example.org/fr/61.html", 1),
    ("http://x-cams.example.net/en/4", 1),
    ("https://spam-farm.example.org/es/750", 1),
    ("http://blog.spam-links.example.com/en/9", 1),
    ("http://link-farm.example.net/de/17/", 1),
    ("https://seo-spam.example.com/en/40", 1),
    ("http://cheap-pills.example.com/en/19", 1),
    ("https://www.pills-online.example.net/fr/2", 1),
    ("http://cheap-meds.example.org/es/33.html", 1),
    ("https://buy-cheap.example.com/en/71", 1),
    ("http://ads-track.example.net/en/8", 1),
    ("https://m.track-clicks.example.com/de/55", 1),
    ("http://click-ads.example.org/en/3/", 1),
    ("http://ads-server.example.com/fr/14", 1),
    ("http://example.com/en/1", 0),
    ("https://www.example.org/", 0),
    ("http://blog.garden.example.net/en/49", 0),
    ("https://m.theron.example.com/fr/357", 0),
    ("http://tionsh.example.net/en/118", 0),
    ("https://theran.example.org/de/945.html", 0),
    ("http://www.weather.example.com/es/12/", 0),
    ("https://library.example.org/de/3", 0),
    ("http://news-daily.example.net/en/61", 0),
    ("https://open-source.example.org/en/8", 0),
    ("http://city-council.example.com/fr/19/", 0),
    ("https://m.ththin.example.net/es/750", 0),
    ("http://blog.thother.example.org/en/742/", 0),
    ("https://ththe.example.com/de/252.html", 0),
    ("http://www.ererre.example.net/en/27", 0),
    ("https://anthing.example.com/fr/511", 0),
    ("http://inther.example.net/de/49", 0),
    ("https://blog.esand.example.com/en/214", 0),
    ("http://history.example.org/es/883", 0),
    ("https://research-notes.example.net/en/99", 0),
    ("http://recipes.example.com/en/33.html", 0),
    ("https://www.school.example.org/fr/10", 0),
    ("http://maps.example.net/de/7/", 0),
    ("https://travel-guide.example.com/es/2", 0),
    ("http://a.org", 0),  # short hosts, which say nothing
    ("https://b.com/x/y", 0),
    ("http://c.net/#top", 0),
    ("http://user.net/fr/", 0),
    ("https://d.com?page=2", 0),
)

SIZES, BUCKETS = (3, 4, 5), 1 << 15
_DIGITS = re.compile(r"[0-9]+")
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host (A-Z lower-cased), then the path up to ``?`` or ``#``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.regexp_extract(url, _URL, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name (host and path) and verdict of the longest rule that fits; null where none does."""
    names, verdicts = [F.lit(None).cast("string")], [F.lit(None).cast("string")]
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        names.insert(-1, F.when(fits, F.lit(rule_host + rule_path)))
        verdicts.insert(-1, F.when(fits, F.lit(verdict)))
    return F.coalesce(*names), F.coalesce(*verdicts)


def split_url(url: str) -> tuple[str, str]:
    """``host_and_path`` for the labelled table."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    return (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")


def features(host: str, path: str) -> dict[int, float]:
    """Hashed n-grams of host and path (runs of digits count as one 0), of unit length."""
    counts: Counter[int] = Counter()
    for mark, part in (("h^", host), ("p^", path)):
        part = _DIGITS.sub("0", part)
        if part:
            part = f"^{part}$"
            for n in SIZES:
                counts.update(zlib.crc32((mark + part[i : i + n]).encode()) % BUCKETS for i in range(len(part) - n + 1))
    norm = sum(v * v for v in counts.values()) ** 0.5
    return {k: v / norm for k, v in counts.items()}


def train(labelled: Sequence[tuple[str, int]] = LABELLED, epochs: int = 1000, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights of the n-gram buckets, and the bias last, by full gradient steps over the small table."""
    x = np.zeros((len(labelled), BUCKETS + 1))
    for row, (url, _) in zip(x, labelled):
        found = features(*split_url(url))
        row[list(found)] = list(found.values())
        row[-1] = 1
    y, w = np.array([label for _, label in labelled], float), np.zeros(BUCKETS + 1)
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-(x @ w)))
        w -= rate * (x.T @ (p - y) / len(y) + decay * w)
    return w


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, weights: np.ndarray | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the method's score (probability of unwanted) of every url."""
    w = train() if weights is None else weights
    host, path = host_and_path(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, verdicts = [], []
            for host, path, ruled in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(4).to_pylist()):
                z = w[-1] + sum(w[k] * v for k, v in features(host, path).items())
                scores.append(1 / (1 + np.exp(-z)))
                verdicts.append(ruled or ("block" if z >= 0 and (host or path) else "allow"))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(verdicts, pa.string()), pa.array(scores, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "score"],
            )

    ruled = cut.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    schema = f"page_id {dict(ruled.dtypes)['page_id']}, host string, path string, rule string, verdict string, score double"
    return ruled.mapInArrow(work, schema)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


__all__ = ["judge", "train", "features", "host_and_path", "longest_rule", "split_url", "op9_url_filter", "RULES", "LABELLED"]
