"""Spelling variants against a comparison of all words, and the parts of the index."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from catalograph.llm import support, variants

SCHEMA = "doc_id long, text string, word string, n int, form string, grams array<string>, key long"


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def plain(count):
    near = {w: [v for v in count if one_edit(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-count[v], v), default=None)
        if top and count[top] >= 10 * count[w]:
            form[w] = top
    out = set()
    for w in count:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, count[w], len(near[w]), count.get(form.get(w))))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    bases = ["international", "ABCDEFG", "straßenbahn", "aaaaaaa", "abababab", "ÀÉÎÕÜÿß", "abcdefgh", "z" * 90, "naïveté×÷"]
    out = [(None, None), (1, ""), (2, "short 12 §"), (3, "漢字漢字漢字漢字 привет")]
    for k in range(150):
        words = []
        for _ in range(30):
            w = rng.choice(bases) if rng.random() < 0.9 else "".join(rng.choice("ab") for _ in range(rng.randrange(7, 10)))
            while rng.random() < 0.3:
                i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:i] + ("" if kind == 0 else rng.choice("abçX")) + w[i + (kind != 1):]
            words.append(w)
        out.append((k if k % 9 else None, rng.choice([" ", ", ", "\n", "1"]).join(words)))
    return out + out[-3:]


def docs_of(spark, rows):
    support.ship(spark)
    return spark.createDataFrame([(*r, "clash", 0, "clash", [], 0) for r in rows], SCHEMA).repartition(3)


def test_counts_and_noise(spark, rows):
    found = variants.word_counts(docs_of(spark, rows)).collect()
    assert {r["word"]: r["n"] for r in found} == plain_words(rows) and len(found) == len(plain_words(rows))


@pytest.mark.parametrize("frequent, list_limit", [(3, 2), (50, 1_024), (1, 5)])
def test_equals_comparing_all_words(spark, rows, frequent, list_limit):
    count = plain_words(rows)
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    found = variants.variants(words, frequent=frequent, list_limit=list_limit).collect()
    assert len(found) == len(count) and {tuple(r) for r in found} == plain(count)


def test_forms_follow_to_the_last(spark):
    # each word is one edit from the next and ten times rarer
    chain = {"abcdefgh"[:8] + "x" * k: 10 ** k for k in range(12)}
    words = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert {tuple(r) for r in variants.variants(words).collect()} == plain(chain)


def test_a_hot_list_stays_linear(spark):
    # all words share their first 20 characters: their lists are split by what surrounds the edit
    rng = random.Random(8)
    words = {"internationalization" + "".join(rng.choice("abcdefghij") for _ in range(5)): 2 for _ in range(3_000)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = {(r["a"], r["b"]) for r in variants.near_pairs(frame).collect()}
    cut = {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    assert pairs == {(a, b) for own in cut.values() for a in own for b in own if a < b}


def test_long_runs_and_empty_table(spark):
    long = "q" * 200_000
    docs = docs_of(spark, [(1, long + " " + "wordwords. " * 200_000), (1, long + " wordwords " + long[:-1]), (2, long[:-1])])
    got = {tuple(r) for r in variants.group_spellings(docs).collect()}
    assert got == plain(plain_words([(1, long + " " + "wordwords. " * 200_000), (1, long + " wordwords " + long[:-1]), (2, long[:-1])]))
    assert variants.group_spellings(docs.limit(0)).count() == 0


def test_unedited_grams_outnumber_the_bound():
    rng = random.Random(6)
    for _ in range(3_000):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(7, 14)))
        frequent = {"".join(rng.choice("abc") for _ in range(q)): 9 for q in (2, 2, 2, 3, 3, 3, 4, 4, 4)}
        found, bound = variants.grams_of(word, frequent)
        i, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        other = word[:i] + ("" if kind == 0 else rng.choice("abc")) + word[i + (kind != 1):]
        kept = Counter(found) & Counter(variants.grams_of(other, frequent)[0])
        assert len(found) - sum(kept.values()) <= bound < len(found)


def test_checksums():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 4_000).astype(np.uint8)
    starts = np.sort(rng.integers(0, 3_800, 200))
    ends = starts + rng.integers(0, 120, 200)
    seeds = rng.integers(0, 1 << 32, 200).astype(np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(starts, ends, seeds)]
    assert variants.crc32_of(data, starts, ends, seeds, variants._crc_table()).tolist() == want
