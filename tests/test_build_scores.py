"""Each combination of strengths is scored once; the components are parsed once a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators import scoring
from catalograph.plans import build
from catalograph.sources.packs import concept_frame, load_pack
from catalograph.sources.sink import dictionary_projection

CONTEXT = build.RunContext(run_id="r1")
ATTRIBUTES = "source_table string, source_column string, ordinal_position int, physical_type string, nullable boolean"


def _attributes(spark):
    types = ["LongType()", "StringType()", "DateType()", "Odd", None]
    names = ["policy_id", "policyId", "POLNBR", "EXPAMT", "id", "claimed_amount", "email_address", "grid", "EXPEXPEXPEXP", None]
    rows = [(f"stg_t{t}", name, i, types[(t + i) % len(types)], i % 2 == 0) for t in range(6) for i, name in enumerate(names)]
    return spark.createDataFrame(rows + rows[:3] + [(None, "policy_id", 1, "LongType()", True)], ATTRIBUTES)


def test_scores_of_combinations_are_the_scores_of_rows(spark):
    observed = build.attribute_observations(_attributes(spark), concept_frame(spark, load_pack("concepts")), CONTEXT, F.lit("t"))
    assert observed.count() == _attributes(spark).count()
    assert observed.where("confidence_score IS NULL OR confidence_components IS NULL").isEmpty()
    struct = ", ".join(f"{n} struct<value: double, availability: string>" for n in scoring.WEIGHTS)
    parsed = observed.withColumn("c", F.from_json("confidence_components", struct))
    rows = parsed.select("source_column", "physical_type", "confidence_score", "evidence_coverage", *[F.col(f"c.{n}.value").alias(n) for n in scoring.WEIGHTS],
                         *[(F.col(f"c.{n}.availability") == "CONTRADICTED").alias(f"bad_{n}") for n in scoring.WEIGHTS])
    again = scoring.confidence(rows.withColumnsRenamed({"confidence_score": "s", "evidence_coverage": "e"}),
                               {n: F.col(f"bad_{n}") for n in scoring.WEIGHTS})
    assert again.where("NOT (s <=> confidence_score) OR NOT (e <=> evidence_coverage)").isEmpty()
    assert {r["naming_strength"] for r in rows.select("naming_strength").distinct().collect()} >= {None, 0.4}
    types = load_pack("types")
    direct = rows.select(F.col("type_strength"), scoring.type_strength(F.col("physical_type"), F.lit(None).cast("string"), types).alias("t"), "source_column")
    assert direct.where("source_column IS NULL AND type_strength <> t").isEmpty()


def test_components_are_parsed_once(spark):
    texts = ['{"naming_strength":{"value":0.4},"type_strength":{"value":null},"relationship_strength":{"value":1}}', "{}", None]
    projected = dictionary_projection(spark.createDataFrame([(t, []) for t in texts], "confidence_components string, evidence_references array<string>"))
    assert [tuple(r)[1:] for r in projected.collect()] == [(0.4, None, 1.0), (None, None, None), (None, None, None)]
    assert "get_json_object" not in projected._jdf.queryExecution().optimizedPlan().toString()
