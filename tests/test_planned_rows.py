"""Work that a plan leaves out: keys that are not hot, columns nobody reads, patterns on plain names."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import text
from catalograph.functions.skew import hot_keys, lookup_join
from catalograph.plans import build
from catalograph.sources.packs import concept_frame, load_pack
from checks import base, governance, observed

ATTRIBUTES = "source_table string, source_column string, ordinal_position int, physical_type string, nullable boolean"


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_exact_whatever_the_buckets(spark):
    rows = spark.createDataFrame([("a",)] * 7 + [("b",)] * 5 + [("c",)] * 6 + [(None,)] * 9, "k string")
    for buckets in (1, 2, 65_536):
        assert {r.k for r in hot_keys(rows, ["k"], 5, buckets).collect()} == {"a", "c", None}
    assert hot_keys(rows, ["k"], 9).isEmpty()


def test_hot_keys_join_as_plain_ones(spark):
    facts = spark.createDataFrame([("hot", i, f"t{i}") for i in range(300)] + [("k", 1, "x"), ("none", 2, "y"), (None, 3, "z")], "k string, v long, t string")
    lookup = spark.createDataFrame([("hot", "A"), ("k", "B")], "k string, top string")
    joined = lookup_join(facts, lookup, ["k"], "n", hot_rows=100, salts=8, hot=hot_keys(facts, ["k"], 100), salt_by=["t"])
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, facts.join(lookup, "k", "left").collect()), key=repr)
    # the rows of the hot key are told apart by one column: the others are read only if asked for
    assert "v#" not in _optimized(joined.select("k", "top")).split("Join", 1)[0]


def _observed(spark):
    names = ["policy_id", "policyId", "POLNBR", "EXPAMT", "id", "claimed_amount", "email_address", "grid", None]
    rows = [(f"stg_t{t}", name, i, "LongType()", i % 2 == 0) for t in range(4) for i, name in enumerate(names)]
    attributes = spark.createDataFrame(rows + rows[:3], ATTRIBUTES)
    return build.attribute_observations(attributes, concept_frame(spark, load_pack("concepts")), build.RunContext("r"), F.lit("t"))


def test_links_and_scores_are_planned_only_for_their_readers(spark):
    rows = _observed(spark)
    domains = rows.groupBy("domain", "approval_state").count()
    assert "of_state" not in _optimized(domains) and "first_target" not in _optimized(domains)
    assert "first_target" in _optimized(rows.select("relationship_evidence"))
    whole = base.written(rows, "observed-rows").groupBy("domain", "approval_state").count()
    assert sorted(map(tuple, domains.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_one_reader_does_not_store_the_observations(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(base, "_WRITTEN", {})
    planned = governance.distribution(spark, sf_dir).collect()
    assert base.if_written(spark, sf_dir, "observations") is None
    observed.observations(spark, sf_dir)
    assert base.if_written(spark, sf_dir, "observations") is not None
    assert sorted(planned, key=repr) == sorted(governance.distribution(spark, sf_dir).collect(), key=repr)


def test_plain_names_are_cut_as_all_others(spark):
    names = ["ord12_id", "a__b", "_a", "a_", "", "a", "a_b_c", "aB_c", "a\n", "a_b\n", "é_id", "a b", "A_B", "1_2", None]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    plain = F.lower(F.trim(F.regexp_replace(text.break_camel(F.col("n")), "[^A-Za-z0-9]+", " ")))
    assert frame.where(~F.equal_null(text.identifier_text(F.col("n")), plain)).isEmpty()
