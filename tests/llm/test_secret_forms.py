"""Secrets of any length, and short or digit-free ones behind a credential word."""

import base64
import hashlib
import re

from catalograph.llm import secrets

DOC = "doc_id long, text string, source string"
LONG = "".join(base64.b64encode(hashlib.sha256(str(i).encode()).digest()).decode().rstrip("=") for i in range(30))
FOUND = [(f"aws_session_token = \"{LONG}\"", LONG), (f"token={LONG[:300]} end", LONG[:300]),
         ("password: xK9mQ2vb7 here", "xK9mQ2vb7"), ("DB_PASSWORD=qZ7pW3xk", "qZ7pW3xk"), ("secret =kQ8xZ2vTp", "kQ8xZ2vTp"),
         ("\"api_key\": \"qWkZvRtXpLmQbNcYdFg\"", "qWkZvRtXpLmQbNcYdFg"), ("pwd = 'ZkWqXvRt'", "ZkWqXvRt"),
         ("token: AbCdEfGhQkWvZx==", "AbCdEfGhQkWvZx==")]
CALM = ["The key: the words", "password: required", "token = string", "secret: none", "auth: getUserValue", "key = value",
        "access: the table of the server", "monkey business, no keys: and more"]


def test_every_form_is_found_and_masked(spark):
    rows = [(i, t, "web") for i, (t, _) in enumerate(FOUND)] + [(100 + i, t, "web") for i, t in enumerate(CALM)]
    frame, findings = spark.createDataFrame(rows, DOC), secrets.labelled_findings(spark)
    found = secrets.scan(frame, findings).collect()
    for i, (text, value) in enumerate(FOUND):
        hit = [r for r in found if r.doc_id == i and r.candidate == value]
        assert [(r.is_secret, text[r.pos - 1:r.pos - 1 + r.length]) for r in hit] == [(True, value)], (text[:60], value[:60], found)
    masked = {r.doc_id: r.text for r in secrets.mask(frame, findings).collect()}
    for i, (text, value) in enumerate(FOUND):
        assert masked[i] == text.replace(value, "[SECRET]")
    assert all(masked[100 + i] == t for i, t in enumerate(CALM)), [masked[100 + i] for i in range(len(CALM))]


def test_a_short_secret_leaves_other_words_whole(spark):
    text = "xK9mQ2vb7tail pwd: xK9mQ2vb7 and xK9mQ2vb7s"
    frame = spark.createDataFrame([(1, text, "web")], DOC)
    assert secrets.mask(frame, secrets.labelled_findings(spark)).first().text == "xK9mQ2vb7tail pwd: [SECRET] and xK9mQ2vb7s"


def test_pattern_is_linear_in_a_run(spark):
    for run in ("a" * 3_000_000, "key" * 1_000_000, "A1" * 1_500_000):
        frame = spark.createDataFrame([(1, f"token: {run} .", "web"), (2, run, "web")], DOC)
        n = frame.selectExpr(f"sum(size(regexp_extract_all(text, '{re.sub('([\\\\\'])', r'\\\1', secrets.CANDIDATE)}', 0))) AS n").first().n
        assert n == (1 if "1" not in run else 2)
