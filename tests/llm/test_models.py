"""Operators 3, 4, 6 and 9: held-out accuracy, brute force on the exact columns, defined results."""

import itertools
import random
import re
import zlib
from collections import Counter

from tradeflow.llm import language, quality, toxicity, urls
from tradeflow.llm.queries import QUERIES

from .conftest import EDGE

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def test_toxicity_held_out(spark):
    rows = {r.doc_id: r for r in QUERIES["op3_toxic_segments"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [(r.toxic, rows[r.doc_id].predicted) for r in labels if remainder(r.doc_id, 5) == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_segments_are_the_maximal_ones():
    def brute(scores):
        """Split off the best segment (of equals the shortest, then the leftmost), then do the same on either side."""
        best = max(((sum(scores[a:b]), a - b, -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a, b = -best[2], -best[2] - best[1]
        left = brute(scores[:a])
        return left + [(a, b)] + [(x + b, y + b) for x, y in brute(scores[b:])]

    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-1.0, -1.0, -1.0, 2.0, 3.5, 1.25]) for _ in range(rng.randrange(14))]
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(hits, drift=1.0)] == brute(scores)


def test_toxicity_edge(spark, edge, no_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (None, 1), (4, None), (3, 2), (8, -1)], "doc_id long, toxic int")
    model = toxicity.learn(edge, labels)
    assert toxicity.score(edge, model).count() == len(EDGE)
    empty = toxicity.learn(no_rows, labels)
    assert {r.score for r in toxicity.score(edge, empty).collect()} == {0.0}
    assert toxicity.score(no_rows, empty).count() == 0


def test_language_held_out(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op4_language_id"](spark, SF).collect()}
    truth = [(r.doc_id, r.lang) for r in docs.collect()]
    assert len(rows) == len(truth)
    held = [(lang, rows[d].lang_pred) for d, lang in truth if remainder(d, 3) == 1]
    assert all(rows[d].held_out == (remainder(d, 3) == 1) for d, _ in truth)
    assert sum(a == b for a, b in held) / len(held) > 0.98


def test_bundles_stay_within_their_bound():
    """A block of texts with far more distinct trigrams than are kept gives the sums of all their vectors."""
    rng = random.Random(3)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(3000)) for _ in range(20)] + ["the cat", None, "12"]
    bundler = language.Bundler()
    got = bundler.vectors(texts)
    assert len(bundler.rows) <= language.MAX_TRIGRAMS and len(bundler.matrix) <= 2 * language.MAX_TRIGRAMS
    for text, vector in zip(texts[-4:], got[-4:]):
        want = sum((int(n) * language.trigram_vector(int(k)).astype(int) for k, n in zip(*language.trigrams(text))), 0)
        assert (vector == want).all()


def test_rare_languages_are_learned(spark):
    rows = [(k, f"the cat sat on mat {k}", "en") for k in range(2000)] + [(5000 + k, "ça va très bien", f"rare{k}") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(language.learn(docs, 5)) == {"en", "rare0", "rare1", "rare2"}


def test_language_edge(edge, no_rows):
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(edge, language.learn(edge)).collect()]
    assert len(got) == len(EDGE)
    assert {d for d, lang, _ in got if lang == "und"} == {2, 3, 5, 8}
    assert all(lang == "und" and score == 0 for _, lang, score in (r[:3] for r in language.predict(edge, language.learn(no_rows)).collect()))
    assert language.predict(no_rows, {}).count() == 0


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_quality_counts(spark, docs, edge):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = QUERIES["op6_weak_supervision"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(texts[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)
    for r in quality.rate(edge).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(r.row.text)


def test_quality_against_labels(spark):
    rows = {r.doc_id: r for r in QUERIES["op6_weak_supervision"](spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if not rows[r.doc_id].base_failed]
    good = [rows[r.doc_id].kept for r in labels if r.quality == 1]
    bad = [rows[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.98
    assert sum(bad) / max(1, len(bad)) < 0.2


def test_quality_empty(no_rows):
    assert quality.rate(no_rows).count() == 0


def test_em_finds_the_accurate_rules():
    rng = random.Random(2)
    accuracy = (0.97, 0.85, 0.85, 0.6)
    patterns = Counter()
    for _ in range(4000):
        good = 1 if rng.random() < 0.7 else -1
        patterns[tuple(good if rng.random() < a else -good for a in accuracy)] += 1
    prior, tables = quality.estimate(sorted(patterns.items()), 4)
    worth = [t[1] - t[-1] for t in tables]
    assert worth[0] > max(worth[1:3]) and min(worth[1:3]) > worth[3] > 0


URLS = [None, "", "no scheme", "http://a.org/x?y", "https://WWW.Example.ORG/en/12#q", "http://example.org/es/1", "http://org", "http://xorg/",
        "x://b.com/fr/", "http://b.com/de/?q=1", "http://com/de/", "http://casino-win.example.net/en/1", "http://a://b/c", "http://garden.example.net/en/8",
        "http://É.ORG/ü", "http://user@h.com?x/y", "http://h.net#/a/b"]


def verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
    fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits, key=lambda x: len(x[0])) if fits else (None, None)))


def test_urls(spark):
    pages = [(i, u, "<p>", 0.5) for i, u in enumerate(itertools.chain(URLS, URLS[:3]))]
    rows = urls.judge(spark.createDataFrame(pages, "page_id long, url string, html string, score double")).collect()
    for r, (i, u, *_) in zip(sorted(rows, key=lambda r: r.page_id), pages):
        host, path, rule, v = verdict(u)
        assert (r.page_id, r.host, r.path, r.rule) == (i, host, path, rule)
        assert r.verdict == (v or ("block" if "casino" in host else "allow")), u
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op9_url_filter"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, rule, v = verdict(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        unwanted = any(x in host for x in ("casino", "bets", "adult", "spam", "pills", "ads-"))
        assert r.verdict == (v or ("block" if unwanted else "allow")), r
