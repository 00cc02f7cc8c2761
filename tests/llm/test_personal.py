"""Personal data: patterns against plain regular expressions, the random field against enumeration and held-out lines."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from catalograph.llm import personal, support

SCHEMA = "doc_id long, text string, spans string, kind int, n_email long, base string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and personal.luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


@pytest.fixture(scope="module")
def model(spark):
    support.ship(spark)
    return personal.fit(personal.labelled_lines(spark))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    pieces = ["a@b.c", "@", "d@e.f", "x_y%+", "é", "漢", "1.2.3.4", "255.256.1.1", "007.1.1.1", ".", "-", " ", "  ", "\n", "\r\n", "\t", "+", "+1 ",
              "(499) 555-6503", "4111 1111 1111 1111", "4111111111111111", "12", "0", "3.4", "@x.y.z-", "(", ")", "word ", "+49 30 1234567", "9" * 20]
    out = [(None, None), (1, ""), (2, "4111111111111111"), (2, "a@b.c@d.e"), (3, "1.2.3.4.5.6.7.8.9"), (4, "+1 2 +12 34567890123456 7")]
    out += [(10 + k, "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30)))) for k in range(700)]
    return out + out[-3:]


def test_patterns_equal_regular_expressions(spark, model, rows):
    docs = spark.createDataFrame([(*r, "clash", 1, 2, "clash") for r in rows], SCHEMA).repartition(3)
    found = personal.find(docs, model).collect()
    assert len(found) == len(rows)
    have = sorted((str(r["doc_id"]), [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]) for r in found)
    assert have == sorted((str(i), plain(t)) for i, t in rows)


def test_added_spans_touch_no_pattern(spark, model, rows):
    for r in personal.find(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        base = [s for s in r["spans"] if s["base"]]
        assert all(s["end"] <= b["start"] or s["start"] >= b["end"] for s in r["spans"] if not s["base"] for b in base)


def test_best_path_equals_enumeration():
    rng = np.random.default_rng(2)
    n = len(personal.LABELS)
    field = personal.Field(rng.normal(size=(personal.FEATURES, n)), rng.normal(size=n), rng.normal(size=(n, n)))
    runs = [rng.integers(0, personal.FEATURES, (k, 9)) for k in (1, 2, 3, 4, 4, 1)]
    for run, got in zip(runs, field.decode(runs)):
        emit = field.weights[run].sum(1)
        score = lambda p: field.start[p[0]] + sum(emit[t, y] for t, y in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:]))
        assert tuple(got) == max(itertools.product(range(n), repeat=len(run)), key=score)
    long = rng.integers(0, personal.FEATURES, (9_000, 9))
    assert len(field.decode([long, long[:3]])[0]) == 9_000


def test_held_out_lines(spark, model):
    lines = personal.labelled_lines(spark, rows=300, seed=99).collect()
    right = wrong = missed = 0
    docs = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(lines)], "doc_id long, text string")
    found = {r["doc_id"]: {(s["kind"], s["start"], s["end"]) for s in r["spans"]} for r in personal.find(docs, model).collect()}
    for k, r in enumerate(lines):
        want = {(s["kind"], s["start"], s["end"]) for s in r["spans"]}
        want = {s for s in want if personal._valid(s[0], r["text"][s[1]:s[2]]) or s in plain(r["text"])}
        right, wrong, missed = right + len(found[k] & want), wrong + len(found[k] - want), missed + len(want - found[k])
    print(right, wrong, missed)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_adds_little_to_documents_without_personal_data(spark, model, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = personal.find(docs, model).collect()
    without = [r for r in rows if not any(s["base"] for s in r["spans"])]
    added = [r for r in without if r["spans"]]
    print(len(rows), len(without), len(added))
    assert len(added) <= 0.01 * len(without)


def test_digests_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(7, "é a@b.cd +49 30 1234567 x"), (8, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in personal.digests(personal.find(docs, model)).collect()}
    assert got[7]["spans"] == "email:2:8,phone:9:23" and (got[7]["n_email"], got[7]["n_phone"], got[7]["n_ip"]) == (1, 1, 0)
    assert got[7]["base_sha256"] == hashlib.sha256(b"email:2:8,phone:9:23").hexdigest()
    assert got[8]["spans"] == "" and got[8]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert personal.digests(personal.find(docs.limit(0), model)).count() == 0
    nothing = personal.fit(spark.createDataFrame([], "text string, spans array<struct<kind:string,start:long,end:long>>"))
    assert [len(r["spans"]) for r in personal.find(docs, nothing).orderBy("doc_id").collect()] == [2, 0]


def test_long_text_in_parts(spark, model):
    text = ("wörd a@b.cd and 10.0.0.1,\n" * 60_000) + "1" * 2_000_000
    spans = personal.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()["spans"]
    assert [(s["kind"], s["start"], s["end"]) for s in spans if s["base"]] == plain(text[:26 * 60_000])
