"""Collocations against plain counting over lists, and the guarantee of the summaries."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.llm import collocations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain(rows, threshold, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", "".join(c.lower() if c.isascii() else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    f = {g: c for g, c in f.items() if c >= threshold}
    out = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) < 2 or any(x == lang and len(v) > len(w) and 100 * c >= 100 * a and any(v[i : i + len(w)] == w for i in range(len(v))) for (x, v), c in f.items()):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def made(seed, n, words):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for _ in range(rng.randrange(60)))
        if i % 3 == 0:
            text += " New York city hall is OPEN. new york\tcity  hall, É É É É é"
        out.append((i, text, rng.choice(["en", "en", "fr", None]), None, None))
    return [*out, (None, None, "en", None, None), (7, "", None, None, None), (8, " . , ", "xx", None, None), (9, "word " * 400, "rep", None, None)]


@pytest.mark.parametrize(("threshold", "flush", "top"), [(3, 1 << 21, 2000), (12, 50, 5), (40, 200, 2000)])
def test_by_brute_force(spark, monkeypatch, threshold, flush, top):
    monkeypatch.setattr(collocations, "FLUSH", flush)
    monkeypatch.setattr(collocations, "HELD", flush)
    rows = made(threshold, 120, ["a", "b", "ab", "the", "The", "of", "c", "d", "zz", "é", "x#y", *map(str, range(30))])
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for c in ("part", "n", "a", "PHRASE", "words", "k", "salt", "rank"):
        df = df.withColumn(c, F.lit("x"))
    got = sorted(tuple(r) for r in collocations.collocations(df, threshold, top=top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    want = plain([(r[2], r[1]) for r in rows], threshold, top)
    assert got == want and len(want) > 4


def test_shares_of_a_language_hold_its_first(spark, monkeypatch):
    """Salted ranks, and sums that pass 64 bits."""
    n = 10**12
    phrases = [("en", 0, "", 4 * n), *[("en", 1, w, n) for w in "abcdefgh"], *[("en", 2, f"{v} {w}", n - i % 7) for i, (v, w) in enumerate((v, w) for v in "abcdefgh" for w in "abcdefgh" if v != w)]]
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: spark.createDataFrame(phrases, collocations.COUNTS))
    got = [(r.score, r.a, r.phrase) for r in collocations.collocations(None, top=20).orderBy("rank").collect()]
    want = sorted((-(1000 * a * 4 * n // (n * n)), -a, p) for _, k, p, a in phrases if k == 2)[:20]
    assert got == [(-s, -a, p) for s, a, p in want]


def test_summaries_keep_what_is_frequent():
    """Whatever the order, the sizes of blocks and how often they are merged."""
    rng = np.random.default_rng(5)
    for threshold in (2, 7, 50):
        items = np.concatenate([rng.integers(0, 3000, 20_000), np.repeat(rng.integers(5000, 5040, 20), rng.integers(threshold, 3 * threshold, 20))])
        rng.shuffle(items)
        room = len(items) // threshold + 1
        codes = counts = np.zeros(0, np.int64)
        for block in np.array_split(items, 97):
            c, n = np.unique(block, return_counts=True)
            codes, counts = collocations.reduced(*collocations._added(np.concatenate([codes, c]), np.concatenate([counts, n])), room)
            assert len(codes) <= room
        value, n = np.unique(items, return_counts=True)
        assert set(value[n >= threshold]) <= set(codes)


def test_survivors_hold_all_frequent(spark, monkeypatch):
    """The tables of survivors, with small blocks: nothing frequent is missing and most of the rest is."""
    monkeypatch.setattr(collocations, "FLUSH", 300)
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.8)) % 5000}" for _ in range(30_000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(7)
    blocks = df.mapInArrow(collocations._blocks(range(1, 2), [], 16, 100), collocations.BLOCKS)
    got = collocations._survivors(blocks, 100)
    n = collections.Counter(words)
    frequent = sum(c >= 100 for c in n.values())
    assert frequent <= got.distinct().count() < 16 * 30 + len(words) // 100
    assert got.count() == got.distinct().count()
    assert collocations._frequent(df, range(1, 2), [], 16, 100).count() == frequent
    found = {r.phrase: r.n for r in collocations.frequent_phrases(df.select("text", "lang")).where("words = 1").collect()}
    assert found == {w: c for w, c in n.items() if c >= 100}


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
