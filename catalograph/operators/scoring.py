"""Type strength, confidence and review routing as row expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.text import round_exact

# Component weights in formula order, floor and threshold.
FORMULA_VERSION = "1.0.0"
WEIGHTS = {"naming_strength": 0.35, "type_strength": 0.20, "relationship_strength": 0.25,
           "cots_match_strength": 0.10, "standard_consistency": 0.10}
COVERAGE_FLOOR = 0.60
LOW_CONFIDENCE = 0.75
RESOLVE_AMBIGUITY = "Which of the listed concepts does the name mean, if any?"


def type_family(physical_type: Column, pack: dict, optional: bool = False) -> Column:
    """First family with a marker contained in the type string, else null."""
    families = pack["families"] + (pack.get("optional_families", []) if optional else [])
    chain = None
    for family, markers in families:
        hit = reduce(lambda a, b: a | b, [physical_type.contains(m) for m in markers])
        chain = F.when(hit, family) if chain is None else chain.when(hit, family)
    return chain


def type_strength(physical_type: Column, concept_type: Column, pack: dict, optional: bool = False,
                  family: Column | None = None) -> Column:
    """Agreement between a physical type and the concept type it should carry.

    ``family`` is the type's family where a column already holds it.
    """
    s = pack["strengths"]
    family = type_family(physical_type, pack, optional) if family is None else family
    kind = F.coalesce(F.nullif(concept_type, F.lit("")), F.lit("ATTRIBUTE"))
    expected = F.lit(False)
    for concept, families in pack["expected"].items():
        expected = expected | ((kind == concept) & family.isin(*families))
    return (F.when(family.isNull(), s["tolerated"]).when(expected, s["match"])
            .when(family == "STRING", s["tolerated"]).otherwise(s["mismatch"]))


def confidence(frame: DataFrame, contradicted: dict[str, Column] | None = None) -> DataFrame:
    """Add components, coverage, raw sum, score and reason from the strength columns.

    Missing and contradicted components leave the normalization but lower the
    coverage. Sums run in formula order so doubles add up the same everywhere.
    """
    contradicted = contradicted or {}
    states, raw, weight = {}, F.lit(0.0), F.lit(0.0)
    for name, w in WEIGHTS.items():
        bad = F.coalesce(contradicted.get(name, F.lit(False)), F.lit(False))
        states[name] = (F.when(bad, "CONTRADICTED").when(F.col(name).isNull(), "NOT_AVAILABLE")
                        .otherwise("AVAILABLE"))
        usable = states[name] == "AVAILABLE"
        raw = raw + F.when(usable, F.col(name) * w).otherwise(0.0)
        weight = weight + F.when(usable, w).otherwise(0.0)
    total = sum(WEIGHTS.values())
    out = frame.withColumns({
        "confidence_components": F.struct(*[
            F.struct(F.col(n).cast("double").alias("value"), states[n].alias("availability"),
                     F.lit(w).alias("weight")).alias(n) for n, w in WEIGHTS.items()]),
        "__raw": raw, "__weight": weight,
    }).withColumns({
        "__coverage": F.col("__weight") / total,
        "__score": F.when(F.col("__weight") > 0, F.col("__raw") / F.col("__weight")).otherwise(0.0),
    })
    parts = F.array(*[F.col(f"confidence_components.{n}.availability") for n in WEIGHTS])
    available = F.size(F.filter(parts, lambda a: a == "AVAILABLE")).cast("string")
    conflicts = F.size(F.filter(parts, lambda a: a == "CONTRADICTED"))
    reason = F.when(
        F.col("__coverage") < COVERAGE_FLOOR,
        F.concat(F.lit("Evidence coverage "), F.format_string("%.2f", F.col("__coverage")),
                 F.lit(f" is under {COVERAGE_FLOOR}; a person has to look")),
    ).otherwise(F.concat(
        F.lit("Made of "), available, F.lit(" known components"),
        F.when(conflicts > 0, F.concat(F.lit("; "), conflicts.cast("string"),
                                       F.lit(" in dispute"))).otherwise("")))
    return out.withColumns({
        "confidence_score": round_exact(F.col("__score")),
        "evidence_coverage": round_exact(F.col("__coverage")),
        "raw_weighted_sum": round_exact(F.col("__raw")),
        "confidence_reason": reason,
        "formula_version": F.lit(FORMULA_VERSION),
    }).drop("__raw", "__weight", "__coverage", "__score")


def assumption_texts(frame: DataFrame) -> DataFrame:
    """Add ``assumptions`` and ``open_question`` for unresolved or weak rows."""
    return frame.withColumns({
        "assumptions": F.when(F.col("ontology_concept_id").isNull(),
                              "The rules found no meaning; map it to a listed concept or ask a steward."),
        "open_question": F.when(F.col("naming_contradicted"),
                                RESOLVE_AMBIGUITY)
        .when(F.col("confidence_score") < LOW_CONFIDENCE, "Does this meaning hold?"),
    })


def review_route(floor: float = COVERAGE_FLOOR, threshold: float = LOW_CONFIDENCE) -> Column:
    """One struct of trigger, reason, role and priority; all null when no review is due."""
    def route(trigger: str, reason, role: str, priority: str) -> Column:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(trigger).alias("review_trigger"), reason.alias("review_reason"),
                        F.lit(role).alias("recommended_reviewer_role"), F.lit(priority).alias("review_priority"))

    key = F.concat(F.initcap(F.replace(F.col("key_role"), F.lit("_"), F.lit(" "))),
                   F.lit(" goes to the architect"))
    coverage = F.concat(F.lit("Evidence coverage "), F.format_string("%.2f", F.col("evidence_coverage")),
                        F.lit(f" is under {floor}"))
    return (
        F.when(F.col("privacy_class") != "INTERNAL",
               route("PRIVACY", "The name may concern private data", "PRIVACY_STEWARD", "HIGH"))
        .when(F.col("key_role").isin("PRIMARY_KEY_CANDIDATE", "FOREIGN_KEY_CANDIDATE"),
              route("KEY_CANDIDATE", key, "DATA_ARCHITECT", "HIGH"))
        .when(F.col("relationship_evidence").isNotNull(),
              route("RELATIONSHIP", "A link was inferred from names", "DATA_ARCHITECT", "MEDIUM"))
        .when(F.col("contradictions").isNotNull(),
              route("CONTRADICTION", "The evidence disagrees", "DOMAIN_STEWARD", "HIGH"))
        .when(F.col("ontology_concept_id").isNull(),
              route("UNMAPPED_CONCEPT", "No concept is mapped", "DOMAIN_STEWARD", "MEDIUM"))
        .when(F.col("evidence_coverage") < floor,
              route("LOW_EVIDENCE_COVERAGE", coverage, "DOMAIN_STEWARD", "MEDIUM"))
        .when(F.col("confidence_score") < threshold,
              route("LOW_CONFIDENCE", "The score is under the threshold", "DOMAIN_STEWARD", "MEDIUM"))
    )


def routed(frame: DataFrame, **limits: float) -> DataFrame:
    """Add the four review columns."""
    names = ("review_trigger", "review_reason", "recommended_reviewer_role", "review_priority")
    return (frame.withColumn("__route", review_route(**limits))
            .withColumns({n: F.col(f"__route.{n}") for n in names}).drop("__route"))
