"""Label evaluation, the release gate, run metrics, publication and reviewer metrics."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.text import identifier_signature
from catalograph.operators.documentation import PROMPT_VERSION
from catalograph.operators.keys import FOREIGN, PRIMARY
from catalograph.operators.review import latest_decisions
from catalograph.operators.scoring import RESOLVE_AMBIGUITY, routed

KEYS = ["source_table", "source_column"]
# Evaluated fields, and the wording of a draft publication.
EVALUATED = ("business_name", "ontology_concept", "domain", "privacy_class", "key_role",
             "relationship_target", "review_route")
DRAFT_STATUS = "DRAFT — CONTAINS UNAPPROVED PROPOSALS"
DICTIONARY_COLUMNS = (
    "source_column", "ordinal_position", "physical_type", "nullable", "key_role", "proposed_business_name",
    "proposed_column_description", "proposed_glossary_term", "proposed_glossary_definition",
    "documentation_generation_status", "documentation_review_state", "ontology_concept_id", "domain",
    "observed_or_inferred", "privacy_class", "confidence_score", "approval_state", "relationship_evidence",
    "assumptions", "open_question")


def predictions(observations: DataFrame, links: DataFrame) -> DataFrame:
    """The evaluated fields per attribute; of its targets the number (``relationship_count``), whatever it is.

    The route is taken as if score, coverage and contradictions raised nothing,
    so it shows privacy, key, relationship and mapping alone.
    """
    counts = links.select(*KEYS, F.col("link_count").alias("relationship_count"))
    plain = routed(observations.withColumns({
        "naming_contradicted": F.equal_null("open_question", F.lit(RESOLVE_AMBIGUITY)),
        "confidence_score": F.lit(1.0), "evidence_coverage": F.lit(1.0), "contradictions": F.lit(None).cast("string")}))
    return plain.join(counts, KEYS, "left").select(
        *KEYS, "naming_contradicted", F.col("proposed_business_name").alias("business_name"),
        F.col("ontology_concept_id").alias("ontology_concept"), "domain", "privacy_class", "key_role",
        F.coalesce("relationship_count", F.lit(0)).cast("long").alias("relationship_count"),
        F.coalesce("recommended_reviewer_role", F.lit("NONE")).alias("review_route"))


def _expected_links(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Per labelled column and expected text, how many of the text's targets are links of the column.

    A column and an expected target are linked as in ``keys.relationship_candidates``;
    only the expected targets are looked up, so no pairs are written out.
    """
    asked = labels.where("expected_relationship_target IS NOT NULL").select(*KEYS, "expected_relationship_target").distinct()
    targets = asked.select("*", F.explode(F.split("expected_relationship_target", r"\|")).alias("target")).distinct()
    named = predictions.select(*KEYS, "key_role", identifier_signature(F.col("source_column")).alias("signature"),
                               F.lower("source_column").alias("lower_name"))
    foreign = named.where(F.col("key_role") == FOREIGN).drop("key_role")
    primary = named.where(F.col("key_role") == PRIMARY).select(
        F.concat_ws(".", *KEYS).alias("target"), F.col("source_table").alias("to_table"),
        F.col("signature").alias("to_signature"), F.col("lower_name").alias("to_lower"))
    linked = targets.join(foreign, KEYS).join(primary, "target").where(
        (F.col("source_table") != F.col("to_table"))
        & ((F.col("signature") == F.col("to_signature")) | (F.col("lower_name") == F.col("to_lower"))))
    return linked.groupBy(*KEYS, "expected_relationship_target").agg(F.count(F.lit(1)).alias("matched"))


def compare_labels(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Per label one ``<field>_match`` flag per evaluated field; null equals null.

    Expected targets are separated by ``|``, in any order. They match if they are
    all links of the column and it has no other.
    """
    plain = [f for f in EVALUATED if f != "relationship_target"]
    p = predictions.select(*KEYS, "naming_contradicted", "relationship_count", *[F.col(f).alias(f"p_{f}") for f in plain])
    joined = labels.join(p, KEYS, "left").join(
        _expected_links(predictions, labels), [*KEYS, "expected_relationship_target"], "left")
    count, expected = F.coalesce("relationship_count", F.lit(0)), F.col("expected_relationship_target")
    whole = F.when(expected.isNull(), count == 0).otherwise(
        (F.coalesce("matched", F.lit(0)) == count) & (F.size(F.split(expected, r"\|")) == count))
    return joined.select(
        "record_id", *KEYS, F.col("naming_contradicted"),
        (F.col("p_business_name").isNotNull() & F.col("p_domain").isNotNull()).alias("classified"),
        F.col("p_ontology_concept").isNotNull().alias("ontology_resolved"),
        *[(whole if f == "relationship_target" else F.equal_null(f"p_{f}", f"expected_{f}")).alias(f"{f}_match")
          for f in EVALUATED])


def evaluation_summary(compared: DataFrame) -> DataFrame:
    """Counts and rates of all fields in one aggregate; rates are 0.0 without labels."""
    total = F.count(F.lit(1))

    def rate(flag: Column) -> Column:
        return F.coalesce(F.try_divide(F.count_if(flag), total), F.lit(0.0))

    return compared.agg(
        total.alias("labelled_records"), rate(F.col("classified")).alias("semantic_classification_coverage"),
        rate(F.col("ontology_resolved")).alias("ontology_resolution_coverage"),
        *[F.count_if(F.col(f"{f}_match")).alias(f"{f}_matches") for f in EVALUATED],
        *[rate(F.col(f"{f}_match")).alias(f"{f}_rate") for f in EVALUATED])


def evaluation_exceptions(compared: DataFrame) -> DataFrame:
    """Record ids that contradict in naming or miss any field, one row each."""
    missed = F.lit(False)
    for f in EVALUATED:
        missed = missed | ~F.col(f"{f}_match")
    return compared.select("record_id", F.explode(F.array_compact(F.array(
        F.when(F.col("naming_contradicted"), "NAMING_CONTRADICTED"),
        F.when(missed, "MISMATCHED")))).alias("exception"))


def _one_row(frame: DataFrame, **measures: Column) -> DataFrame:
    return frame.agg(*[F.coalesce(m, F.lit(0)).cast("long").alias(n) for n, m in measures.items()])


def duplicate_attributes(frame: DataFrame) -> DataFrame:
    """(table, column, artifact version) on more than one row of a run."""
    return frame.groupBy(*KEYS, "artifact_version").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def gate_checks(dictionary: DataFrame, attributes: DataFrame, objects: DataFrame, profiles: DataFrame,
                relationships: DataFrame, documentation: DataFrame, queue: DataFrame, tables: int,
                model_endpoint: str, prompt_version: str = PROMPT_VERSION) -> DataFrame:
    """(check_name, observed, expected, comparison, passed) of one run.

    One aggregate per relation, plus two duplicate counts and one join; the
    results are single rows joined without a shuffle of any relation.
    Key columns count only when INTERNAL: others are routed to the privacy
    steward first.
    """
    c = F.col

    def not_equal(name: str, value: str) -> Column:
        return F.count_if(~F.equal_null(c(name), F.lit(value)))

    total = F.count(F.lit(1))
    key = (c("key_role") != "NON_KEY")
    blocked = documentation.join(attributes.select(*KEYS, "privacy_class"), KEYS).where(
        (c("privacy_class") != "INTERNAL")
        & ((c("generation_status") != "UNRESOLVED") | c("proposed_column_description").isNotNull()
           | c("proposed_glossary_definition").isNotNull()))
    parts = [
        _one_row(dictionary, dictionary_rows=total),
        _one_row(attributes, attribute_rows=total, internal=F.count_if(c("privacy_class") == "INTERNAL"),
                 private=F.count_if(c("privacy_class") != "INTERNAL"),
                 keys=F.count_if(key & (c("privacy_class") == "INTERNAL")),
                 attribute_no_refs=F.count_if(F.coalesce(F.size("evidence_references"), F.lit(0)) <= 0),
                 no_score=F.count_if(c("confidence_score").isNull()),
                 no_coverage=F.count_if(c("evidence_coverage").isNull()),
                 no_formula=F.count_if(c("formula_version").isNull()),
                 attribute_decided=not_equal("approval_state", "PROPOSED")),
        _one_row(objects, object_rows=total),
        _one_row(profiles, profile_rows=total, profile_private=not_equal("privacy_class", "INTERNAL")),
        _one_row(relationships, relationship_decided=not_equal("approval_state", "PROPOSED"),
                 relationship_role=not_equal("reviewer_role", "DATA_ARCHITECT")),
        _one_row(documentation, documentation_rows=total, doc_decided=not_equal("approval_state", "PROPOSED"),
                 doc_role=not_equal("reviewer_role", "DOMAIN_STEWARD"),
                 doc_no_refs=F.count_if(F.coalesce(F.size("evidence_references"), F.lit(0)) <= 0),
                 doc_prompt=not_equal("prompt_version", prompt_version),
                 doc_endpoint=not_equal("model_endpoint", model_endpoint)),
        _one_row(queue, not_open=not_equal("queue_status", "OPEN"),
                 queued_private=F.count_if(c("recommended_reviewer_role") == "PRIVACY_STEWARD"),
                 queued_docs=F.count_if((c("review_trigger") == "SOURCE_DOCUMENTATION")
                                        & (c("recommended_reviewer_role") == "DOMAIN_STEWARD")),
                 queued_keys=F.count_if(key & (c("recommended_reviewer_role") == "DATA_ARCHITECT"))),
        _one_row(blocked, blocked_documented=total),
        _one_row(duplicate_attributes(attributes), attribute_duplicates=total),
        _one_row(duplicate_attributes(documentation), documentation_duplicates=total),
    ]
    row = parts[0]
    for part in parts[1:]:
        row = row.join(F.broadcast(part))
    zero = F.lit(0).cast("long")
    checks = [
        ("dictionary has rows", c("dictionary_rows"), F.lit(1).cast("long"), ">="),
        ("attributes match dictionary", c("attribute_rows"), c("dictionary_rows"), "="),
        ("documentation matches dictionary", c("documentation_rows"), c("dictionary_rows"), "="),
        ("one object per table", c("object_rows"), F.lit(tables).cast("long"), "="),
        ("two profiles per internal attribute", c("profile_rows"), c("internal") * 2, "="),
        ("relationships stay proposed", c("relationship_decided"), zero, "="),
        ("relationships go to the architect", c("relationship_role"), zero, "="),
        ("attributes keep references", c("attribute_no_refs"), zero, "="),
        ("profiles are internal only", c("profile_private"), zero, "="),
        ("documentation stays proposed", c("doc_decided"), zero, "="),
        ("documentation goes to the domain steward", c("doc_role"), zero, "="),
        ("documentation keeps references", c("doc_no_refs"), zero, "="),
        ("documentation names the prompt version", c("doc_prompt"), zero, "="),
        ("documentation names the endpoint", c("doc_endpoint"), zero, "="),
        ("private attributes stay undocumented", c("blocked_documented"), zero, "="),
        ("private attributes are queued", c("queued_private"), c("private"), ">="),
        ("documentation is queued", c("queued_docs"), c("documentation_rows"), "="),
        ("no duplicate attributes", c("attribute_duplicates"), zero, "="),
        ("no duplicate documentation", c("documentation_duplicates"), zero, "="),
        ("scores present", c("no_score"), zero, "="),
        ("coverage present", c("no_coverage"), zero, "="),
        ("formula version present", c("no_formula"), zero, "="),
        ("nothing approved automatically", c("attribute_decided"), zero, "="),
        ("queue holds open work", c("not_open"), zero, "="),
        ("internal keys are queued", c("queued_keys"), c("keys"), ">="),
    ]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), o.alias("observed"), e.alias("expected"),
                 F.lit(op).alias("comparison"),
                 ((o >= e) if op == ">=" else (o == e)).alias("passed")) for n, o, e, op in checks])))


def idempotency_key(spark, scope: list[str], versions: dict[str, str], settings: dict[str, str]) -> DataFrame:
    """sha256 over scope, pack versions and settings, keys sorted."""
    text = json.dumps({"source_scope": scope, "knowledge_pack_versions": versions, **settings}, sort_keys=True)
    return spark.range(1).select(F.sha2(F.lit(text), 256).alias("idempotency_key"))


def run_metrics(objects: DataFrame, attributes: DataFrame, links: DataFrame, documentation: DataFrame,
                queue: DataFrame, violations: DataFrame) -> DataFrame:
    """The seven counts of a run as one row."""
    total = F.count(F.lit(1))
    parts = [
        _one_row(objects, objects_observed=total),
        _one_row(attributes, attributes_observed=total,
                 privacy_classifications=F.count_if(F.col("privacy_class") != "INTERNAL")),
        _one_row(links, relationships_inferred=F.coalesce(F.sum("link_count"), F.lit(0))),
        _one_row(documentation, documentation_recommendations=total),
        _one_row(queue, review_items_created=total),
        _one_row(violations, policy_violations=total),
    ]
    row = parts[0]
    for part in parts[1:]:
        row = row.join(F.broadcast(part))
    return row.select("objects_observed", "attributes_observed", "relationships_inferred",
                      "documentation_recommendations", "privacy_classifications", "review_items_created",
                      "policy_violations")


def run_record(metrics: DataFrame, key: DataFrame, context: dict[str, str], scope: list[str],
               versions: dict[str, str], started_at: Column, completed_at: Column) -> DataFrame:
    """The run row: scope, versions and metrics as JSON, times, key."""
    names = metrics.columns
    return metrics.join(F.broadcast(key)).select(
        *[F.lit(context[k]).alias(k) for k in ("schema_version", "run_id", "artifact_version",
                                               "engagement_id", "source_system")],
        F.array(*[F.lit(t) for t in scope]).alias("source_scope"),
        F.lit(json.dumps(versions, sort_keys=True)).alias("knowledge_pack_versions"),
        F.lit(context["schema_version"]).alias("task_contract_version"), "idempotency_key",
        F.lit("SUCCEEDED").alias("run_status"), started_at.alias("started_at"), completed_at.alias("completed_at"),
        F.to_json(F.struct(*names)).alias("metrics"), F.lit(None).cast("string").alias("error_info"))


def distribution(attributes: DataFrame) -> DataFrame:
    """Rows per domain and approval state."""
    return attributes.groupBy("domain", "approval_state").agg(F.count(F.lit(1)).alias("n"))


def validation_summary(dictionary: DataFrame, low: float = 0.75) -> DataFrame:
    """Row, null-score, decided, low-confidence, private and relationship counts."""
    c = F.col
    return dictionary.agg(
        F.count(F.lit(1)).alias("dictionary_rows"), F.count_if(c("confidence_score").isNull()).alias("null_confidence_rows"),
        F.count_if(c("approval_state") != "PROPOSED").alias("auto_approved_rows"),
        F.count_if(c("confidence_score") < low).alias("low_confidence_rows"),
        F.count_if(c("privacy_class") != "INTERNAL").alias("personal_data_rows"),
        F.count_if(c("relationship_evidence").isNotNull()).alias("relationship_rows"))


def source_scope(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("source_system", "source_table").agg(F.count(F.lit(1)).alias("observed_attributes"))


def row_counts(dictionary: DataFrame, queue: DataFrame) -> DataFrame:
    return dictionary.agg(F.count(F.lit(1)).alias("dictionary_rows")).join(
        F.broadcast(queue.agg(F.count(F.lit(1)).alias("review_queue_rows"))))


def publish_dictionary(dictionary: DataFrame, documentation: DataFrame, decisions: DataFrame, approved_only: bool = True,
                       store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Dictionary rows with documentation, by review state of their newest decision.

    Approved mode keeps attributes whose queue item is APPROVED and only
    approved documentation; draft mode keeps all and says so in
    ``publication_status``. Order rows when writing, not here. The newest decisions are read
    twice below; ``store(frame, name)`` may write them once and return the written relation.
    """
    newest = latest_decisions(decisions).select("queue_item_id", "reviewer_decision")
    newest = newest if store is None else store(newest, "latest_decisions")
    attribute_item = F.concat_ws(":", "run_id", *KEYS)
    docs = documentation.select(
        *KEYS, F.concat_ws(":", "run_id", *KEYS, F.lit("source_documentation")).alias("queue_item_id"),
        "proposed_column_description", "proposed_glossary_term", "proposed_glossary_definition",
        F.col("generation_status").alias("documentation_generation_status"))
    docs = docs.join(newest.select("queue_item_id", F.col("reviewer_decision").alias("doc_decision")),
                     "queue_item_id", "left").drop("queue_item_id")
    docs = docs.withColumn("documentation_review_state",
                           F.when(F.col("doc_decision") == "APPROVED", "APPROVED").otherwise("PROPOSED"))
    if approved_only:
        docs = docs.where(F.col("documentation_review_state") == "APPROVED")
    rows = (dictionary.withColumn("queue_item_id", attribute_item)
            .join(newest.select("queue_item_id", F.col("reviewer_decision").alias("attribute_decision")),
                  "queue_item_id", "left")
            .withColumn("approval_state", F.coalesce("attribute_decision", "approval_state"))
            .join(docs, KEYS, "left"))
    if approved_only:
        rows = rows.where(F.col("approval_state") == "APPROVED")
    return rows.select("source_table", *DICTIONARY_COLUMNS,
                       F.lit("APPROVED" if approved_only else DRAFT_STATUS).alias("publication_status"))


def write_dictionary(published: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Files partitioned by table, rows in column order within each."""
    (published.repartition("source_table", F.floor(F.col("ordinal_position") / 10_000))
     .sortWithinPartitions("source_table", "ordinal_position")
     .write.mode("errorifexists").partitionBy("source_table").format(file_format)
     .options(header="true").save(path))


def publication_overview(published: DataFrame, source_system: str, run_id: str, artifact_version: str) -> DataFrame:
    """Tables and attributes published, with run and status."""
    per_table = published.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("n"), F.max("publication_status").alias("status"))
    return per_table.agg(
        F.lit("Source Data Dictionary").alias("deliverable"), F.lit(source_system).alias("source_system"),
        F.lit(run_id).alias("run_id"), F.lit(artifact_version).alias("artifact_version"),
        F.count(F.lit(1)).alias("tables"), F.coalesce(F.sum("n"), F.lit(0)).alias("attributes_published"),
        F.max("status").alias("publication_status"))


def reviewer_metrics(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per reviewer role: open and decided items, override rate, median turnaround hours, precision and recall of mappings.

    A proposed concept that was approved is a correct mapping. Precision is their share among
    finally decided proposals of a concept, recall their share among the attributes for
    which a decision left a mapping: the approved ones and those that the reviewer changed.
    """
    newest = latest_decisions(decisions)
    joined = queue.select("queue_item_id", "recommended_reviewer_role", "queued_at",
                          F.col("ontology_concept_id").isNotNull().alias("mapped")).join(newest, "queue_item_id", "left")
    hours = (F.col("decided_at").cast("timestamp").cast("double")
             - F.col("queued_at").cast("timestamp").cast("double")) / 3600
    decided = F.col("reviewer_decision").isNotNull()
    final = F.col("reviewer_decision").isin("APPROVED", "MODIFIED", "REJECTED")
    correct = F.count_if(F.col("mapped") & (F.col("reviewer_decision") == "APPROVED"))
    return joined.groupBy("recommended_reviewer_role").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(decided).alias("decided"), F.count_if(~decided).alias("open"),
        F.count_if(F.col("reviewer_decision").isin("MODIFIED", "REJECTED")).alias("overridden"),
        F.try_divide(F.count_if(F.col("reviewer_decision").isin("MODIFIED", "REJECTED")),
                     F.count_if(final)).alias("override_rate"),
        F.percentile_approx(hours, 0.5).alias("median_turnaround_hours"),
        F.try_divide(correct, F.count_if(F.col("mapped") & final)).alias("mapping_precision"),
        F.try_divide(correct, correct + F.count_if(F.col("reviewer_decision") == "MODIFIED")).alias("mapping_recall"))
