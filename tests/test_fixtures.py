"""The fifteen edge cases: issue found, reviewer chosen, key stable."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from catalograph.operators import naming, privacy, quality, scoring
from catalograph.sources import scan
from catalograph.sources.packs import load_pack
from checks.base import concepts


def _route(spark, issue, privacy_class="INTERNAL"):
    rows = spark.createDataFrame([("t", issue, privacy_class)], "target string, issue string, privacy_class string")
    return quality.route_issues(rows, ["target"]).first().reviewer_role


def _named(spark, *names):
    frame = spark.createDataFrame([(n,) for n in names], "source_column string")
    rows = naming.classify_names(frame, concepts(spark), load_pack("naming"))
    return {r.source_column: r for r in privacy.classify_privacy(rows, load_pack("privacy")).collect()}


def test_f001_null_or_empty(spark):
    df = spark.createDataFrame([(None,), ("",)], "policy_status string")
    row = quality.null_or_empty(df, ["policy_status"]).first()
    assert (row.null_rows, row.empty_rows, row.has_issue) == (1, 1, True)
    assert _route(spark, "NULL_OR_EMPTY_VALUE") == "DOMAIN_STEWARD"


def test_f002_duplicate_identifier(spark):
    df = spark.createDataFrame([("P1",), ("P1",), ("P2",), (None,), (None,), ("",), ("",)], "policy_id string")
    assert [(r.value, r.n) for r in quality.duplicate_values(df, "policy_id").collect()] == [("P1", 2)]
    assert _route(spark, "DUPLICATE_IDENTIFIER") == "DATA_ARCHITECT"


def test_f003_missing_primary_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "coverage_id string, n int")
    inventory = scan.attribute_inventory(spark, {"coverage_source": df})
    assert [r.source_column for r in quality.missing_primary_key(df, inventory, "coverage_source").collect()] == ["coverage_id"]
    assert _route(spark, "MISSING_PRIMARY_KEY") == "DATA_ARCHITECT"


def test_f004_orphan(spark):
    child = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "policy_id string")
    parent = spark.createDataFrame([("A",), (None,)], "policy_id string")
    assert [r.value for r in quality.orphan_values(child, "policy_id", parent, "policy_id").collect()] == ["B"]
    assert _route(spark, "ORPHAN_FOREIGN_KEY") == "DATA_ARCHITECT"


def test_f005_type_mismatch(spark):
    inventory = spark.createDataFrame([("claim", "policy_id", "IntegerType()"), ("policy", "policy_id", "StringType()")],
                                      "source_table string, source_column string, physical_type string")
    candidates = spark.createDataFrame([("claim", "policy_id", "policy", "policy_id")],
                                       "from_table string, from_column string, to_table string, to_column string")
    assert quality.relationship_type_mismatches(candidates, inventory).count() == 1
    assert _route(spark, "RELATIONSHIP_TYPE_MISMATCH") == "DATA_ARCHITECT"


def test_f006_name_type_contradiction(spark):
    kind = _named(spark, "effective_date")["effective_date"].ontology_concept_type
    row = spark.range(1).select(scoring.type_strength(F.lit("StringType()"), F.lit(kind), load_pack("types")).alias("s")).first()
    assert row.s <= 0.55


def test_f007_to_f010_meaning_and_privacy(spark):
    named = _named(spark, "underwriting_code", "contact_channel", "email_address", "loss_narrative", "EXPAMT")
    assert named["underwriting_code"].ontology_concept_id is None
    assert named["contact_channel"].ontology_concept_id is None
    assert named["email_address"].privacy_class == "PERSONAL_DATA"
    assert named["loss_narrative"].privacy_class == "SENSITIVE"
    assert named["EXPAMT"].naming_contradicted
    assert _route(spark, "UNKNOWN_SEMANTIC_PATTERN") == "DOMAIN_STEWARD"
    assert _route(spark, "AMBIGUOUS_SEMANTIC_PATTERN") == "DOMAIN_STEWARD"
    assert _route(spark, "PERSONAL_DATA_INDICATOR", "PERSONAL_DATA") == "PRIVACY_STEWARD"
    assert _route(spark, "PROHIBITED_EVIDENCE") == "PRIVACY_STEWARD"


def test_f010_prohibited_value_leaves_no_trace(spark):
    secret = "FORBIDDEN_TEST_value"
    df = spark.createDataFrame([("ok", secret), ("ok", "x")], "a string, b string")
    hits = privacy.prohibited_values(df, "claim_source")
    events = privacy.policy_violations(hits, "si_job_1", "s", F.current_timestamp())
    rows = events.collect()
    assert [(r.source_table, r.source_column, r.routed_to) for r in rows] == [("claim_source", "b", "PRIVACY_STEWARD")]
    assert secret not in str(rows)


def test_f011_f012_boundaries(spark):
    df = spark.createDataFrame([("1900-01-01", "0.00"), ("9999-12-31", "9999999999.99"), ("x", "1e99")], "d string, a string")
    rows = {r.source_column: r for r in quality.boundary_parse(df, ["d"], ["a"]).collect()}
    assert (rows["d"].parsed_rows, rows["d"].in_range_rows) == (2, 2)
    assert (rows["a"].parsed_rows, rows["a"].in_range_rows) == (2, 2)


def test_f013_to_f015_input_keys(spark):
    rows = [(1, "a", Decimal("1.50"), dt.date(2020, 1, 1)), (2, None, None, None), (2, None, None, None)]
    schema = "id int, s string, d decimal(12,2), t date"
    key = lambda data, sch=schema: quality.table_fingerprint(spark.createDataFrame(data, sch)).first().input_key
    assert key(rows) == key(rows) == key(rows[::-1])
    assert key(rows) != key(rows[:2])
    assert key(rows) != key(rows, schema.replace("id int", "id bigint"))


@pytest.mark.parametrize("null_rate, text", [(0.0, "0.0"), (1.0, "1.0"), (0.07, "0.07"), (1e-6, "1e-06"), (1.2e-5, "1.2e-05"),
                                             (3e-5, "3e-05"), (1e-4, "0.0001"), (1 / 3, "0.333333")])
def test_rate_text_prints_like_a_plain_float(spark, null_rate, text):
    from catalograph.functions.text import rate_text
    assert text == str(round(null_rate, 6))
    assert spark.range(1).select(rate_text(F.lit(null_rate)).alias("t")).first().t == text


def test_round_exact_equals_correct_rounding(spark):
    from catalograph.functions.text import round_exact
    numbers = [i / 80000 for i in range(0, 80001, 7)] + [0.73125, 0.75315, 0.00005, 0.00015, 0.99995, 1.0]
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", round_exact(F.col("x")).alias("y")).collect()
    assert all(r.y == round(r.x, 4) for r in rows)
