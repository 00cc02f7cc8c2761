"""Registered queries read whole embeddings, all customers, all tables and all text columns."""

import pytest
from pyspark.sql import functions as F

from checks import integrity, rows
from checks.base import table
from checks.compare import TABLES


def _changed(monkeypatch, module, name, change):
    monkeypatch.setattr(module, "table", lambda s, d, n: change(table(s, d, n)) if n == name else table(s, d, n))


def test_a_bad_last_component_is_found(spark, sf_dir, monkeypatch):
    n = table(spark, sf_dir, "embeddings").select(F.size("embedding")).first()[0]
    _changed(monkeypatch, integrity, "embeddings", lambda df: df.withColumn("embedding", F.expr(
        f"transform(embedding, (x, i) -> CASE WHEN i = {n - 1} THEN 77f ELSE 0f END)")))
    found = integrity.array_subset(spark, sf_dir).where("bucket = 'b1540'")
    assert found.count() == table(spark, sf_dir, "embeddings").count()


def test_every_vocabulary_is_checked(spark, sf_dir):
    found = integrity.bundle_integrity(spark, sf_dir).where("finding = 'vocabulary id is not unique'").select("subject").collect()
    repeated = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 2")).count().where("count > 1").count()
    assert len(found) == repeated > 50


def test_inventory_has_every_table(spark, sf_dir):
    found = {(r.source_table, r.source_column) for r in rows.attribute_inventory(spark, sf_dir).collect()}
    assert found == {(t, c) for t in TABLES for c in table(spark, sf_dir, t).columns}


@pytest.mark.parametrize("query", [rows.prohibited_scan, rows.policy_violations])
def test_every_planted_text_is_found(spark, sf_dir, query):
    found = {(r.source_table, r.source_column) for r in query(spark, sf_dir).collect()}
    assert {f for f in found if f[0] in TABLES} == set(rows._PLANTED)


def test_any_text_column_can_be_found(spark, sf_dir, monkeypatch):
    _changed(monkeypatch, rows, "supplier", lambda df: df.withColumn("s_name", F.lit("FORBIDDEN_TEST_x")))
    assert rows.prohibited_scan(spark, sf_dir).where("source_table = 'supplier' AND source_column = 's_name'").count() == 1
