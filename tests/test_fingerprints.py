"""Fingerprints cover every column of a table, down to microseconds and text."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalograph.operators import quality
from checks import rows
from checks.base import table

SCHEMA = "id long, price double, at timestamp_ntz, note string"
ROWS = [(1, 1234.5, datetime(2024, 2, 29, 23, 59, 59, 123456), 'a "q" \\ /é\n'), (2, None, None, None),
        (2, None, None, None), (3, 0.25, datetime(1999, 1, 1), "")]


def _brute(data):
    lanes = [0] * 8
    for id_, price, at, note in data:
        text = json.dumps({"id": id_, "price": price, "at": at and at.strftime("%Y-%m-%dT%H:%M:%S.%f"), "note": note},
                          separators=(",", ":"), ensure_ascii=False)
        digest = hashlib.sha256(text.encode()).hexdigest()
        lanes = [n + int(digest[8 * i:8 * i + 8], 16) for i, n in enumerate(lanes)]
    schema = "id:bigint:true,price:double:true,at:timestamp_ntz:true,note:string:true"
    return hashlib.sha256(f"{schema}|{len(data)}|{','.join(map(str, lanes))}".encode()).hexdigest()


def test_fingerprint_equals_brute_force(spark):
    key = lambda data: quality.table_fingerprint(spark.createDataFrame(data, SCHEMA)).first().input_key
    assert key(ROWS) == _brute(ROWS) == key(ROWS[::-1])
    later = [(1, 1234.5, datetime(2024, 2, 29, 23, 59, 59, 123457), ROWS[0][3]), *ROWS[1:]]
    assert key(later) == _brute(later) != key(ROWS)


@pytest.mark.parametrize("name, column, value", [
    ("orders", "o_totalprice", "o_totalprice + 0.01"), ("orders", "o_orderdate", "o_orderdate + INTERVAL 1 DAY"),
    ("documents", "text", "concat(text, ' ')"), ("nation", "n_name", "lower(n_name)")])
def test_registered_fingerprint_sees_every_column(spark, sf_dir, monkeypatch, name, column, value):
    keys = lambda: {r.source_table: r.input_key for r in rows.dq_table_fingerprint(spark, sf_dir).collect()}
    before = keys()
    monkeypatch.setattr(rows, "table", lambda s, d, n: table(s, d, n).withColumn(column, F.expr(value)) if n == name else table(s, d, n))
    after = keys()
    assert {n for n in before if before[n] != after[n]} == {name}
