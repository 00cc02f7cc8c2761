"""The dictionary build as one lazy plan, from attributes to governed relations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions.skew import HOT_ROWS, hot_keys, lookup_join
from catalograph.functions.small import local_frame
from catalograph.operators import keys as K
from catalograph.operators import naming, privacy, profile, scoring
from catalograph.sources.packs import load_pack

KEYS = ["source_table", "source_column"]
Store = Callable[[DataFrame, str], DataFrame]


@dataclass
class RunContext:
    """Run identity and settings of one build."""

    run_id: str
    source_system: str = "source"
    engagement_id: str = "engagement"
    schema_version: str = "1.0.0"
    artifact_version: str = "1.0.0"
    source_catalog: str = "main"
    source_schema: str = "bronze"
    rule_date: str | None = None
    packs: dict[str, dict] = field(default_factory=lambda: {
        n: load_pack(n) for n in ("naming", "privacy", "types")})

    def values(self) -> dict[str, str]:
        return {k: getattr(self, k) for k in ("schema_version", "run_id", "artifact_version",
                                              "engagement_id", "source_system")}


def _name_counts(attributes: DataFrame) -> DataFrame:
    return attributes.groupBy("source_column").agg(F.count(F.lit(1)).alias("name_rows"))


def _classified(names: DataFrame, concepts: DataFrame, context: RunContext, store: Store | None) -> DataFrame:
    packs = context.packs
    named = naming.classify_names(names.select("source_column"), concepts, packs["naming"], store=store)
    named = privacy.classify_privacy(named, packs["privacy"])

    def refs(pack: dict, rule_ids: Column) -> Column:
        return naming.provenance_references(pack, rule_ids, context.source_system,
                                            F.col("naming_convention"), context.rule_date)

    rules = F.concat("rule_ids", F.array(F.lit(packs["naming"]["match_rule_id"])))
    return named.withColumn("rule_references", F.array_sort(F.array_distinct(F.concat(
        refs(packs["naming"], rules), refs(packs["privacy"], F.array("privacy_rule_id")),
        refs(packs["types"], F.array(F.lit(packs["types"]["rule_id"])))))))


def classified_names(attributes: DataFrame, concepts: DataFrame, context: RunContext,
                     store: Store | None = None) -> DataFrame:
    """Naming and privacy of each distinct column name, with how many attributes bear it."""
    names = _name_counts(attributes)
    return _classified(names, concepts, context, store).join(names, "source_column")


STATES = ["naming_strength", "naming_contradicted", "type_strength", "relationship_strength", "conflict"]
STATE_TYPES = ["double", "boolean", "double", "double", "boolean"]


def _scores(spark: SparkSession, packs: dict[str, dict]) -> DataFrame:
    """Score, coverage, components and reason of every combination of strengths that the packs can give.

    A column without a name has no naming strength.
    """
    rules, types = packs["naming"], packs["types"]
    combinations = product(
        {*rules["strengths"].values(), rules["fallback_strength"], None}, (False, True), set(types["strengths"].values()),
        {K.EXACT_STRENGTH, K.SIGNATURE_STRENGTH, K.CONFLICT_STRENGTH, K.IDENTIFIER_STRENGTH, K.PLAIN_STRENGTH}, (False, True))
    states = local_frame(spark, [dict(zip(STATES, row)) for row in combinations],
                         ", ".join(f"{k} {t}" for k, t in zip(STATES, STATE_TYPES)))
    none = F.lit(None).cast("double")
    scored = scoring.confidence(states.withColumns({"cots_match_strength": none, "standard_consistency": none}), {
        "naming_strength": F.col("naming_contradicted"), "relationship_strength": F.col("conflict")})
    scored = scored.withColumn("confidence_components", F.to_json("confidence_components", {"ignoreNullFields": "false"}))
    return scored.groupBy(F.struct(*STATES).alias("of_state")).agg(*[F.first(c).alias(c) for c in (
        "confidence_score", "evidence_coverage", "confidence_reason", "formula_version", "confidence_components")])


def attribute_observations(attributes: DataFrame, concepts: DataFrame, context: RunContext,
                           created_at: Column, hot_rows: int = HOT_ROWS,
                           roles: DataFrame | None = None, store: Store | None = None) -> DataFrame:
    """One governed observation per attribute; rules run per distinct name, links per key group."""
    return completed(inferred_columns(attributes, concepts, context, hot_rows, roles, store), context, created_at)


def completed(inferred: DataFrame, context: RunContext, created_at: Column) -> DataFrame:
    """``inferred_columns`` with what is the same in all rows of a run or follows from the keys.

    Literals are known to the optimizer, so no plan stores or shuffles them.
    """
    origin = F.concat(F.lit(f"catalog_metadata:{context.source_catalog}.{context.source_schema}."),
                      F.concat_ws(".", *KEYS))
    text = F.lit(None).cast("string")
    return inferred.select(
        *[F.lit(v).alias(k) for k, v in context.values().items()], *KEYS, "ordinal_position", "physical_type",
        "nullable", "key_role", "relationship_evidence", "proposed_business_name", "ontology_concept_id", "domain",
        F.lit("INFERRED").alias("observed_or_inferred"),
        F.concat(F.array(origin), "rule_references").alias("evidence_references"),
        "confidence_score", "confidence_components", "evidence_coverage", "confidence_reason",
        "formula_version", "assumptions", "contradictions", "open_question",
        "privacy_class", "privacy_rationale", F.lit("PROPOSED").alias("approval_state"),
        text.alias("reviewer_role"), text.alias("review_rationale"), created_at.alias("created_at"))


def inferred_columns(attributes: DataFrame, concepts: DataFrame, context: RunContext, hot_rows: int = HOT_ROWS,
                     roles: DataFrame | None = None, store: Store | None = None) -> DataFrame:
    """What the rules say about each attribute: the columns of an observation that differ from row to row.

    ``store(frame, name)`` writes relations that several parts read (roles and
    name hypotheses) once; without it they are planned again in each part. A score
    follows from few strengths: each combination is scored once, and rows look theirs up.
    """
    if roles is None:
        roles = K.key_roles(attributes, hot_rows)
        roles = store(roles, "key_roles") if store is not None else roles
    named = _classified(attributes.select("source_column").distinct(), concepts, context, store)
    # only foreign columns have links: one join, on their rows
    foreign = F.equal_null("key_role", F.lit(K.FOREIGN))
    linked = (roles.where(foreign).join(K.relationship_links(roles, hot_rows), KEYS, "left")
              .withColumn("relationship_evidence", K.relationship_evidence())
              .unionByName(roles.where(~foreign), allowMissingColumns=True))
    joined = lookup_join(linked, named, ["source_column"], "name_rows", hot_rows=hot_rows,
                         hot=hot_keys(attributes, ["source_column"], hot_rows), salt_by=["source_table"])
    types = context.packs["types"]
    scored = joined.withColumns({
        "type_family": scoring.type_family(F.col("physical_type"), types),
        "conflict": F.coalesce("candidate_conflict", F.lit(False)),
        "relationship_strength": K.relationship_strength(F.col("signature"), F.col("candidate_strength")),
    }).withColumn("type_strength", scoring.type_strength(
        F.col("physical_type"), F.col("ontology_concept_type"), types, family=F.col("type_family")))
    state = {c: F.col(c) for c in STATES} | {"naming_contradicted": F.coalesce("naming_contradicted", F.lit(False))}
    # structs with null fields are equal when the fields are; one key, unique, so a plan without scores drops the join
    scored = scored.join(F.broadcast(_scores(attributes.sparkSession, context.packs)),
                         F.struct(*[v.cast(t).alias(c) for (c, v), t in zip(state.items(), STATE_TYPES)]) == F.col("of_state"), "left")
    scored = scoring.assumption_texts(scored)
    both = F.concat_ws("; ", "naming_contradictions", F.when(F.col("conflict"), K.CONFLICT_TEXT))
    return scored.select(
        *KEYS, "ordinal_position", "physical_type", "nullable", "key_role", "relationship_evidence",
        "proposed_business_name", "ontology_concept_id", "domain", "rule_references", "confidence_score",
        "confidence_components", "evidence_coverage",
        F.concat_ws("; ", "naming_reason", "confidence_reason").alias("confidence_reason"), "formula_version",
        "assumptions", F.nullif(both, F.lit("")).alias("contradictions"), "open_question", "privacy_class",
        "privacy_rationale")


def object_observations(observations: DataFrame, context: RunContext, created_at: Column) -> DataFrame:
    """One row per table; references stay in :func:`keys.object_evidence` rows."""
    text = F.lit(None).cast("string")
    return K.object_rollup(observations).select(
        *[F.lit(v).alias(k) for k, v in context.values().items()], "source_table", "object_type", "column_count",
        F.lit(None).cast("int").alias("row_count_estimate"), "proposed_domain", "proposed_domain_confidence",
        text.alias("cots_match_assessment"), text.alias("profile_summary"),
        F.lit("INFERRED").alias("observed_or_inferred"), "evidence_count",
        F.lit("The domain is the one that most columns were given.").alias("assumptions"),
        text.alias("contradictions"), text.alias("open_questions"), "privacy_class", "max_privacy_class",
        "privacy_rationale", F.lit("PROPOSED").alias("approval_state"), "reviewer_role",
        text.alias("review_rationale"), created_at.alias("created_at"))


def relationship_rows(candidates: DataFrame, context: RunContext, created_at: Column) -> DataFrame:
    """Candidates in the relation's column order; overlap stays null until it is governed."""
    text = F.lit(None).cast("string")
    return candidates.select(
        *[F.lit(v).alias(k) for k, v in context.values().items()], "from_table", "from_column", "to_table",
        "to_column", "relationship_type", "evidence_description", "naming_overlap", "type_compatible",
        F.lit(None).cast("double").alias("overlap_ratio"), "confidence_score", "confidence_reason",
        F.lit("INFERRED").alias("observed_or_inferred"),
        F.lit("Names and types only; no values were compared.").alias("assumptions"),
        "contradictions", F.lit("PROPOSED").alias("approval_state"),
        F.lit("DATA_ARCHITECT").alias("reviewer_role"), text.alias("review_rationale"), created_at.alias("created_at"))


def relationship_member_rows(members: DataFrame, context: RunContext, created_at: Column) -> DataFrame:
    """All links as the governed sides of their keys, for relations whose pairs are too many to write out."""
    return members.select(
        *[F.lit(v).alias(k) for k, v in context.values().items()], "match_key", "side", "source_table", "source_column",
        "physical_type", F.lit("FOREIGN_KEY").alias("relationship_type"),
        F.lit("INFERRED").alias("observed_or_inferred"), F.lit("PROPOSED").alias("approval_state"),
        F.lit("DATA_ARCHITECT").alias("reviewer_role"), F.lit(None).cast("string").alias("review_rationale"),
        created_at.alias("created_at"))


def gated_profiles(tables: dict[str, DataFrame], internal: dict[str, list[str]], context: RunContext,
                   created_at: Column, exact: bool = False) -> DataFrame:
    """Evidence of the permitted columns: one scan and one aggregate per table.

    ``internal`` lists the columns that passed the privacy gate; no other column
    is in the select list, so the scan never reads it.
    """
    parts = None
    for table, columns in internal.items():
        if not columns:
            continue
        stats = profile.column_statistics(tables[table], columns, exact, ranges=False)
        rows = profile.profile_rows(stats.withColumn("source_table", F.lit(table)))
        parts = rows if parts is None else parts.unionByName(rows)
    if parts is None:
        raise ValueError("no column passed the privacy gate")
    return profile.profile_evidence(parts, context.values(), created_at)


def internal_by_table(attributes: DataFrame, concepts: DataFrame, context: RunContext) -> dict[str, list[str]]:
    """Permitted columns per table, for tables whose schemas the caller holds.

    Reads back one name per column of those tables, which sizes a select list.
    """
    named = classified_names(attributes, concepts, context).select(
        "source_column", "privacy_class", "name_status")
    rows = privacy.internal_columns(attributes.join(named, "source_column")).select(*KEYS, "ordinal_position").collect()
    permitted: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["source_table"], r["ordinal_position"])):
        permitted.setdefault(row["source_table"], []).append(row["source_column"])
    return permitted
