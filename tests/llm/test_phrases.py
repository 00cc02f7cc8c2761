"""Collocations against a plain count, over shards of several sizes."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import phrases, support

SCHEMA = "text string, lang string, phrase string, n int, rank string, words array<string>"


def plain(rows, min_count, top):
    """The rows of the definition, by counting every phrase."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    found = []
    for (lang, words), a in f.items():
        if len(words) < 2 or a < min_count:
            continue
        if any(n >= min_count and 100 * n >= 80 * a for (other, w), n in longer(f, lang, words)):
            continue
        score, k = min((2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
        found.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], total[lang], score))
    out = []
    for lang in {r[0] for r in found}:
        own = sorted((r for r in found if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(lang, k + 1, *r[1:]) for k, r in enumerate(own)]
    return sorted(out)


def longer(f, lang, words):
    for (other, w), n in f.items():
        if other == lang and len(w) > len(words) and any(w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1)):
            yield (other, w), n


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["a", "B", "é", "the", "The", "漢字", "x y", "-", "it's"]
    out = [(None, "en"), ("", "en"), (" \t\n", None), ("a b.c d", ""), ("!?", "de"), ("a a a a a a a", "en")]
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ".", ", ", "\n", "\r\n"]) for _ in range(rng.randrange(40)))
        out.append((text, rng.choice(["en", "en", None, "und", "de"])))
    return out + out[-5:]


@pytest.mark.parametrize("shard_words", [5, 64])
def test_equals_the_plain_count(spark, rows, shard_words):
    support.ship(spark)
    docs = spark.createDataFrame([(*r, "clash", 1, "clash", []) for r in rows], SCHEMA).repartition(3)
    found = phrases.mine(docs, min_count=3, top=25, shard_words=shard_words)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 3, 25)


def test_full_filter_changes_nothing(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "text string, lang string")
    monkeypatch.setattr(phrases, "MAX_FILTER_BITS", 64)
    assert sorted(map(tuple, phrases.mine(docs, min_count=2, top=50).collect())) == plain(rows, 2, 50)


def test_one_long_text_in_parts(spark):
    support.ship(spark)
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) + rng.choice(["", "", "", "."]) for _ in range(700_000))
    docs = spark.createDataFrame([(text, "en"), ("x" * 3_000_000, "en")], "text string, lang string")
    found = phrases.mine(docs, min_count=3_000, top=100, shard_words=100_000)
    assert sorted(map(tuple, found.collect())) == plain([(text, "en"), ("x" * 3_000_000, "en")], 3_000, 100)


def test_empty_table_and_large_counts(spark):
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).count() == 0
    big = 9 * 10 ** 14
    counts = spark.createDataFrame([("en", "", 10 ** 16), ("en", "a", big), ("en", "b", big + 1), ("en", "a b", big - 7)],
                                   "lang string, phrase string, n long")
    assert phrases.collocations(counts).select("score").collect()[0][0] == 2_000_000 * (big - 7) // (2 * big + 1)


def test_intervals_hold_the_occurrences():
    rng = np.random.default_rng(1)
    symbols, fresh = rng.integers(1, 5, 400), rng.random(400) < 0.1
    index = phrases.ShardIndex(symbols, fresh)
    pieces = np.split(symbols, np.flatnonzero(fresh)[np.flatnonzero(fresh) > 0])
    grown = index.words()
    for m in range(2, 5):
        grown = index.extend(grown, left=m != 3)
        want = Counter(tuple(p[i:i + m].tolist()) for p in pieces for i in range(len(p) - m + 1))
        assert dict(zip(map(tuple, grown.symbols.tolist()), grown.count.tolist())) == want
