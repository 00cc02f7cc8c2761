"""Work of key roles: even files, hot keys from counts, names that cannot be identifiers left out."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import text
from catalograph.functions.skew import lookup_join
from catalograph.functions.text import break_camel, identifier_signature
from catalograph.operators import keys as K
from checks import base

ATTRIBUTES = "source_table string, source_column string, ordinal_position int, physical_type string, nullable boolean"


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_catalogue_rows_are_dealt_over_the_files(spark, tmp_path):
    """Nearly all rows come from the orders, which may be one file."""
    source = "/root/testdata/sf0.001"
    for name in ("orders", "customer", "part", "supplier", "nation"):
        base.table(spark, source, name).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = base.catalogue(spark, str(tmp_path))
    per_file = [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) < 0.75 * sum(per_file)
    assert rows.exceptAll(base.catalogue_plan(spark, str(tmp_path))).isEmpty() and rows.count() == base.catalogue_plan(spark, str(tmp_path)).count()


def test_counts_give_the_hot_keys_and_the_lookup_is_planned_once(spark):
    facts = spark.createDataFrame([("hot", i) for i in range(300)] + [("k", 1), ("none", 2), (None, 3)], "k string, v long")
    lookup = spark.createDataFrame([("hot", "A"), ("k", "B")], "k string, top string").distinct()
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(facts, lookup, ["k"], "n", hot_rows=100, salts=8, counts=counts)
    plain = facts.join(lookup, "k", "left")
    assert joined.columns == ["k", "v", "top"]
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert _plan(joined).count("top#") and _plan(joined).count("LogicalRDD") <= _plan(plain).count("LogicalRDD") + 2


def _attributes(spark):
    types = ["LongType()", "StringType()", "DateType()", "Odd", None]
    names = ["policy_id", "policyId", "POLNBR", "EXPAMT", "id", "claimed_amount", "email_address", "grid", "EXPEXPEXPEXP", None]
    rows = [(f"stg_t{t}", name, i, types[(t + i) % len(types)], i % 2 == 0) for t in range(6) for i, name in enumerate(names)]
    return spark.createDataFrame(rows + rows[:3] + [(None, "policy_id", 1, "LongType()", True)], ATTRIBUTES)


def test_names_that_cannot_be_identifiers_are_not_joined(spark):
    roles = K.key_roles(_attributes(spark))
    found = {(r.source_table, r.source_column): r.key_role for r in roles.collect()}
    assert roles.count() == _attributes(spark).count()
    assert found[("stg_t1", None)] == found[("stg_t1", "grid")] == found[("stg_t1", "POLNBR")] == K.NO_KEY
    assert found[(None, "policy_id")] == found[("stg_t1", "policy_id")] == K.FOREIGN and found[("stg_t1", "policyId")] == K.PRIMARY
    assert "contains" in _plan(roles).lower()


def test_signatures_are_as_without_the_first_look(spark):
    names = ["ID", "Id", "iD", "grid", "orderKey", "ORDER-KEY ", "key", "monkey", "a__id__", "keys", "Key", "x", "", None, "cafÉId", "aBcId"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace("n", "([a-z0-9])([A-Z])", "$1_$2"), "[^A-Za-z0-9]+", " ")))
    expected = F.nullif(F.regexp_extract(plain, "(?:^| )((?:[a-z0-9]+ )?(?:id|key))$", 1), F.lit(""))
    assert frame.where(~F.equal_null(identifier_signature(F.col("n")), expected)).isEmpty()
    assert frame.where(~F.equal_null(break_camel(F.col("n")), F.regexp_replace("n", "([a-z0-9])([A-Z])", "$1_$2"))).isEmpty()


def test_key_roles_cut_a_name_once(spark):
    names = [(n,) for n in ("ord1_id", "id", "key", "Key", "custId", "a_b_key", "idx", "_id_", "x-ID", "id_x", "", "é_id", "a  id\n", None)]
    frame = spark.createDataFrame(names, "n string").withColumn("t", text.identifier_text(F.col("n")))
    tail = "(?:^| )((?:[a-z0-9]+ )?(?:id|key))$"
    assert frame.where(~F.equal_null(text.signature_of(F.col("t")), F.nullif(F.regexp_extract("t", tail, 1), F.lit("")))).isEmpty()
    assert frame.where(~F.equal_null(text.lead_of(F.col("t")), F.regexp_replace("t", " ?[a-z0-9]+$", ""))).isEmpty()
    # signature and lead are taken off the cut name by plain string functions
    plan = K.key_roles(_attributes(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and " ?[a-z0-9]+$" not in plan
