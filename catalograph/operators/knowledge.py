"""Table-integrity checks and knowledge-pack rules, as joins over any rows.

The generic operators return violation rows and work at row scale; the rules
for concepts, bundles, patterns and registrations are compositions of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.skew import spread
from catalograph.functions.small import rule_frame
from catalograph.operators.contracts import pattern_rules
from catalograph.operators.globs import as_like, matching_names

# Privacy levels, and authored relationship types with the
# governed type and the cardinality of source and target.
PRIVACY_LEVELS = {"NONE": "INTERNAL", "INDIRECT": "PERSONAL_DATA", "DIRECT": "PERSONAL_DATA",
                  "SENSITIVE": "SENSITIVE"}
RELATIONSHIP_TYPES = (
    ("belongs_to", "BELONGS_TO", "ONE", "ONE"),
    ("derives_from", "DERIVES_FROM", "ONE", "ONE_OR_MORE"),
    ("describes", "DESCRIBES", "ONE", "ONE"),
    ("groups", "GROUPS", "ONE", "ONE_OR_MORE"),
    ("has_many", "HAS", "ONE", "ZERO_OR_MORE"),
    ("identifies", "IDENTIFIES", "ONE", "ONE"),
    ("is_a", "IS_A", "ONE", "ONE"),
    ("measures", "MEASURES", "ONE", "ONE"),
    ("precedes", "PRECEDES", "ONE", "ZERO_OR_ONE"),
    ("reduces", "REDUCES", "ONE", "ONE"),
    ("references", "REFERENCES", "ONE", "ZERO_OR_ONE"),
)
OUTSIDE_SCOPE = "TARGET_OUTSIDE_GOVERNED_SCOPE"
EXCLUSION_REASON = "ONTOLOGY_CONCEPT_OUTSIDE_AUTHORIZED_SCOPE"


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values on more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def dangling_refs(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Distinct child references without a parent, with how many rows carry each.

    References are counted before the join, so a hot reference is one row.
    """
    refs = child.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return refs.join(known, columns, "left_anti")


def nested_edges(df: DataFrame, id_column: str, edges: str) -> DataFrame:
    """One row per element of an array of (type, target) structs."""
    return df.select(F.col(id_column).alias("source_id"), F.explode(edges).alias("e")).select(
        "source_id", F.col("e.type").alias("edge_type"), F.col("e.target").alias("target_id"))


def scope_split(edges: DataFrame, nodes: DataFrame, target: str = "target_id",
                node: str = "node_id") -> tuple[DataFrame, DataFrame]:
    """(kept, excluded) edges by whether the target is among the nodes."""
    inside = nodes.select(F.col(node).alias(target)).distinct()
    return (edges.join(inside, target, "left_semi"),
            edges.join(inside, target, "left_anti").withColumn("reason", F.lit(OUTSIDE_SCOPE)))


def array_subset(df: DataFrame, array: str, allowed: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """(keys, value) for array elements that are not among the allowed values."""
    elements = df.select(*keys, F.explode(array).alias(value))
    return elements.join(allowed.select(value).distinct(), value, "left_anti").distinct()


def same_identity(df: DataFrame, expected: dict[str, object], keys: list[str]) -> DataFrame:
    """(keys, field) where a column differs from its expected value."""
    broken = F.array_compact(F.array(*[
        F.when(~F.equal_null(F.col(c), F.lit(v)), F.lit(c)) for c, v in expected.items()]))
    return df.select(*keys, F.explode(broken).alias("field"))


def immutable_version(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field) registered before with another value under the same identity."""
    o = old.select(*keys, F.struct(*fields).alias("o"))
    n = new.select(*keys, F.struct(*fields).alias("n"))
    broken = F.array_compact(F.array(*[
        F.when(~F.equal_null(F.col(f"o.{f}"), F.col(f"n.{f}")), F.lit(f)) for f in fields]))
    return o.join(n, keys).select(*keys, F.explode(broken).alias("field"))


def _scope(pack: dict) -> Column:
    pack_id = pack["pack_id"]
    return F.struct(
        F.lit(pack_id).alias("product"), F.lit(f"{pack_id.removesuffix('_ontology')}_foundation").alias("module"),
        F.lit(pack["pack_version"]).alias("product_version"), F.col("domain"),
        F.lit("Multi-line").alias("line_of_business"))


def _provenance(pack: dict, fingerprint: str, reference: str, effective_from: str, created_at: Column) -> Column:
    return F.struct(
        F.lit(pack["pack_id"]).alias("pack_id"), F.lit(pack["pack_version"]).alias("pack_version"),
        F.lit(effective_from).alias("effective_from"), F.lit(None).cast("string").alias("effective_to"),
        F.lit(pack["status"]).alias("approval_state"), F.lit("DOMAIN_STEWARD").alias("owner_role"),
        F.array(F.lit(f"{reference}#sha256:{fingerprint}")).alias("evidence_references"),
        F.lit(fingerprint).alias("content_fingerprint"), created_at.alias("created_at"))


def privacy_level(column: Column) -> Column:
    levels = F.create_map(*[F.lit(v) for pair in PRIVACY_LEVELS.items() for v in pair])
    return F.try_element_at(levels, column)


def normalize_concepts(concepts: DataFrame, pack: dict, fingerprint: str, reference: str,
                       effective_from: str, created_at: Column) -> DataFrame:
    """Concept rows with scope, provenance, mapped privacy class and filled arrays."""
    empty = F.array().cast("array<string>")

    def optional(name: str, default: Column) -> Column:
        return (F.coalesce(F.col(name), default) if name in concepts.columns else default).alias(name)

    return concepts.select(
        F.lit("1.0.0").alias("schema_version"), "concept_id", F.col("name").alias("concept_name"), "definition",
        "concept_type", "lifecycle_state", privacy_level(F.col("privacy_sensitivity")).alias("privacy_class"),
        optional("synonyms", empty), optional("physical_name_variants", empty),
        F.coalesce("lob_applicability", F.array(F.lit("ALL"))).alias("lob_applicability"), "temporality",
        optional("typical_attributes", empty), optional("status_values", empty),
        optional("steward_notes", F.lit("")), _scope(pack).alias("scope"),
        _provenance(pack, fingerprint, reference, effective_from, created_at).alias("provenance"))


def normalize_edges(edges: DataFrame, type_column: str = "edge_type") -> DataFrame:
    """Authored edges to governed type, cardinalities and a stable id; unknown types stay null."""
    rules = rule_frame(edges.sparkSession, [dict(zip(
        (type_column, "relationship_type", "source_cardinality", "target_cardinality"), r))
        for r in RELATIONSHIP_TYPES],
        f"{type_column} string, relationship_type string, source_cardinality string, target_cardinality string")
    return edges.join(rules, type_column, "left").withColumn(
        "relationship_id", F.concat(F.lit("REL."), F.concat_ws(".", "source_id", "relationship_type", "target_id")))


def normalize_ontology(concepts: DataFrame, pack: dict, fingerprint: str, reference: str, effective_from: str,
                       created_at: Column, domains: list[str] | None = None) -> dict[str, DataFrame]:
    """Concept rows, relationship rows and excluded edges of the selected domains."""
    chosen = concepts if domains is None else concepts.where(F.col("domain").isin(*domains))
    edges = nested_edges(chosen, "concept_id", "relationships")
    kept, excluded = scope_split(edges, chosen.select(F.col("concept_id").alias("node_id")))
    source = chosen.select(F.col("concept_id").alias("source_id"), "lifecycle_state", "domain")
    relationships = normalize_edges(kept).join(source, "source_id").select(
        F.lit("1.0.0").alias("schema_version"), "relationship_id", F.col("source_id").alias("source_concept_id"),
        F.col("target_id").alias("target_concept_id"), "relationship_type",
        F.col("edge_type").alias("source_relationship_type"), "source_cardinality", "target_cardinality",
        F.concat(F.lit("Authored edge '"), "edge_type", F.lit("' from "), "source_id",
                 F.lit(" to "), "target_id", F.lit(".")).alias("definition"),
        "lifecycle_state", _scope(pack).alias("scope"),
        _provenance(pack, fingerprint, reference, effective_from, created_at).alias("provenance"))
    return {
        "concepts": normalize_concepts(chosen, pack, fingerprint, reference, effective_from, created_at),
        "relationships": relationships, "excluded": excluded,
    }


def _finding(df: DataFrame, subject: str | Column, text: str) -> DataFrame:
    subject = F.col(subject) if isinstance(subject, str) else subject
    return df.select(subject.cast("string").alias("subject"), F.lit(text).alias("finding"))


def _fails(condition: Column) -> Column:
    """True where the condition does not hold, a null condition included."""
    return ~F.coalesce(condition, F.lit(False))


def ontology_integrity(concepts: DataFrame, declared_domains: list[str],
                       concept_types: list[str] | None = None) -> DataFrame:
    """Duplicate ids, missing targets, undeclared domains, unknown types and privacy levels."""
    edges = nested_edges(concepts, "concept_id", "relationships")
    known = [r[0] for r in RELATIONSHIP_TYPES]
    parts = [
        _finding(unique_key(concepts, ["concept_id"]), "concept_id", "concept id is not unique"),
        _finding(dangling_refs(edges, ["target_id"], concepts, ["concept_id"]), "target_id",
                 "relationship target is missing"),
        _finding(edges.where(F.col("source_id").isNull()), "target_id", "relationship has no source concept"),
        _finding(unique_key(edges, ["source_id", "edge_type", "target_id"]),
                 F.concat_ws(".", "source_id", "edge_type", "target_id"), "relationship id is not unique"),
        _finding(concepts.where(_fails(F.col("domain").isin(*declared_domains))), "concept_id", "domain is not declared"),
        _finding(edges.where(_fails(F.col("edge_type").isin(*known))), "edge_type", "unsupported relationship type"),
        _finding(concepts.where(privacy_level(F.col("privacy_sensitivity")).isNull()), "concept_id",
                 "unsupported privacy sensitivity"),
    ]
    if concept_types is not None:
        parts.append(_finding(concepts.where(_fails(F.col("concept_type").isin(*concept_types))), "concept_id",
                              "undeclared concept type"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bundle_integrity(modules: DataFrame, concepts: DataFrame, vocabularies: DataFrame, shapes: DataFrame,
                     root: dict[str, str], concept_types: list[str]) -> DataFrame:
    """Federated bundle rules over module rows unioned with their source name.

    modules(module, pack_id, pack_version, status, domain); concepts(module,
    concept_id, domain, concept_type); vocabularies(module, vocabulary_id);
    shapes(module, shape_id, root_concept_id, required_concept_ids, optional_concept_ids).
    """
    identity = same_identity(modules, {k: root[k] for k in ("pack_id", "pack_version", "status")}, ["module"])
    home = modules.select("module", F.col("domain").alias("declared"))
    members = F.concat(F.array("root_concept_id"), F.coalesce("required_concept_ids", F.array().cast("array<string>")),
                       F.coalesce("optional_concept_ids", F.array().cast("array<string>")))
    used = shapes.select("shape_id", F.explode(members).alias("concept_id"))
    counted = modules.join(concepts.select("module").distinct(), "module", "left_anti").join(
        vocabularies.select("module").distinct(), "module", "left_anti").join(
        shapes.select("module").distinct(), "module", "left_anti")
    return _union([
        _finding(identity, F.concat_ws(":", "module", "field"), "identity differs from the bundle root"),
        _finding(counted, "module", "module is empty"),
        _finding(concepts.join(home, "module", "left").where(_fails(F.col("domain") == F.col("declared"))), "concept_id",
                 "concept outside the declared domain"),
        _finding(unique_key(concepts, ["concept_id"]), "concept_id", "concept id is not unique"),
        _finding(concepts.where(_fails(F.col("concept_type").isin(*concept_types))), "concept_id", "undeclared concept type"),
        _finding(unique_key(vocabularies, ["vocabulary_id"]), "vocabulary_id", "vocabulary id is not unique"),
        _finding(unique_key(shapes, ["shape_id"]), "shape_id", "shape id is not unique"),
        _finding(dangling_refs(used, ["concept_id"], concepts, ["concept_id"]), "concept_id",
                 "shape uses a missing concept"),
    ])


def pattern_pack_integrity(records: DataFrame, patterns: DataFrame, exclusions: DataFrame, concepts: DataFrame,
                           allowed_references: DataFrame, header: dict[str, str]) -> DataFrame:
    """Rules of one authored pattern pack.

    records(record_id, scope_text, pack_id, pack_version, content_fingerprint,
    evidence_references) holds document, version and pattern records;
    ``header`` gives pack_id, pack_version, scope_text, authoring_source and document_id.
    """
    expected = {"scope_text": header["scope_text"], "pack_id": header["pack_id"],
                "pack_version": header["pack_version"],
                "content_fingerprint": header["authoring_source"].rsplit("#sha256:", 1)[-1]}
    refs = F.col("evidence_references")
    marker = F.col("pattern_type") == "EXTENSION_MARKER"
    shape = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), n) for n, ok in pattern_rules().items()]))
    return _union([
        _finding(same_identity(records, expected, ["record_id"]), F.concat_ws(":", "record_id", "field"),
                 "record differs from the pack"),
        _finding(array_subset(records, "evidence_references", allowed_references, "evidence_reference", ["record_id"]),
                 "record_id", "unauthorized evidence reference"),
        _finding(records.where(_fails(F.array_contains(refs, header["document_id"]))), "record_id",
                 "pack document is not cited"),
        _finding(records.where(_fails(F.array_contains(refs, header["authoring_source"]))), "record_id",
                 "authoring source is not cited"),
        _finding(unique_key(patterns, ["pattern_id"]), "pattern_id", "pattern id is not unique"),
        patterns.select(F.col("pattern_id").alias("subject"), F.explode(shape).alias("finding")),
        _finding(patterns.where(marker & _fails(F.col("lifecycle_state") == "Source extension")), "pattern_id",
                 "extension marker lifecycle"),
        _finding(dangling_refs(patterns.where(_fails(marker)), ["ontology_concept_id"], concepts, ["concept_id"]),
                 "ontology_concept_id", "concept is not available"),
        _finding(exclusions.where(~F.equal_null("reason", F.lit(EXCLUSION_REASON))), "source_object",
                 "unsupported exclusion reason"),
    ])


def pattern_pack_counts(patterns: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Documents, versions, patterns, extension markers and exclusions of a pack, one row."""
    p = patterns.agg(F.count(F.lit(1)).alias("patterns"),
                     F.count_if(F.col("pattern_type") == "EXTENSION_MARKER").alias("extension_markers"))
    e = exclusions.agg(F.count(F.lit(1)).alias("excluded_mappings"))
    return p.join(F.broadcast(e)).select(F.lit(1).alias("documents"), F.lit(1).alias("pack_versions"), "*")


def referential_gaps(rows: DataFrame, array: str, id_column: str, targets: DataFrame, target: str) -> DataFrame:
    """Distinct array elements without a target (indicator concepts, business lines, mappings)."""
    refs = rows.select(F.col(id_column).alias("source_id"), F.explode(array).alias("target_id"))
    return dangling_refs(refs, ["target_id"], targets, [target])


def match_patterns(attributes: DataFrame, patterns: DataFrame | None = None) -> DataFrame:
    """Structure evidence per attribute; without patterns it is not available for any."""
    return attributes.withColumns({
        "cots_match_strength": F.lit(None).cast("double"),
        "cots_availability": F.lit("NOT_AVAILABLE"),
    }) if patterns is None else _scored(attributes, patterns)


def opened_tables(attributes: DataFrame, patterns: DataFrame) -> DataFrame:
    """name, pattern: which lower-case object globs fit which lower-case table names."""
    return matching_names(spread(attributes.select(F.lower("source_table").alias("name")), "name").distinct(),
                          patterns.select(F.lower("source_object_pattern").alias("pattern")).distinct())


def fitting(attributes: DataFrame, patterns: DataFrame, opened: DataFrame | None = None) -> DataFrame:
    """Each attribute with each pattern whose object and attribute globs both fit, without regard to case.

    Object globs meet the distinct table names through ``globs.matching_names``;
    an attribute glob is tried only in the tables that its object glob fits.
    ``opened`` are the ``opened_tables`` where the caller has them.
    """
    rules = patterns.withColumns({"object_glob": F.lower("source_object_pattern"), "attribute_like": as_like(F.col("source_attribute_pattern"))})
    opened = opened_tables(attributes, patterns) if opened is None else opened
    # a glob may fit every table, so rules go to the tables and not both to the glob
    ruled = opened.join(F.broadcast(rules), opened["pattern"] == rules["object_glob"]).drop("pattern")
    return (attributes.join(ruled, F.lower("source_table") == F.col("name")).where(F.expr("lower(source_column) LIKE attribute_like"))
            .drop("name", "object_glob", "attribute_like"))


def _scored(attributes: DataFrame, patterns: DataFrame) -> DataFrame:
    """Best pattern per attribute, by object and attribute names with globs."""
    rules = patterns.where("pattern_type = 'ATTRIBUTE'").select("source_object_pattern", "source_attribute_pattern", "expected_confidence")
    best = (fitting(attributes.select("source_table", "source_column"), rules).groupBy("source_table", "source_column")
            .agg(F.max("expected_confidence").alias("cots_match_strength")))
    return attributes.join(best, ["source_table", "source_column"], "left").withColumn(
        "cots_availability", F.when(F.col("cots_match_strength").isNull(), "NOT_AVAILABLE").otherwise("AVAILABLE"))


def assess_structure(attributes: DataFrame, patterns: DataFrame,
                     store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """How far each table shows the structure that a pack expects of it.

    ``patterns``: pattern_id, pack_id, pattern_type (ATTRIBUTE or EXTENSION_MARKER), source_object_pattern,
    source_attribute_pattern, expected_confidence, required. A table is compared with every pack
    that has an object pattern for it. All required attributes there: MATCHED; some of them, or
    an extension marker: LIKELY_CUSTOM_EXTENSION; else UNRESOLVED. ``pattern_id`` is the hit of
    highest confidence, smallest id first; nothing is approved by it. Which globs fit which
    tables is read twice; ``store(frame, name)`` may write it once.
    """
    tables = attributes.select("source_table").distinct()
    opened = opened_tables(attributes, patterns)
    opened = store(opened, "opened-tables") if store is not None else opened
    rules = patterns.withColumn("object_glob", F.lower("source_object_pattern"))
    expected = opened.join(F.broadcast(rules), opened["pattern"] == rules["object_glob"]).groupBy("name", "pack_id").agg(
        F.count_distinct(F.when(F.col("required") & (F.col("pattern_type") == "ATTRIBUTE"), F.col("pattern_id"))).alias("required_attributes"))
    marker = F.col("pattern_type") == "EXTENSION_MARKER"
    # dealt by table into a fixed number of tasks: short names would be merged into few of them
    folded = F.lower("source_table")
    dealt = spread(attributes.select("source_table", "source_column"), folded)
    hits = fitting(dealt, patterns, opened).groupBy(folded.alias("name"), "source_table", "pack_id").agg(
        F.count_distinct(F.when(F.col("required") & ~marker, F.col("pattern_id"))).alias("found_attributes"),
        F.count_distinct(F.when(marker, F.col("source_column"))).alias("extension_columns"),
        F.min(F.when(~marker, F.struct((-F.col("expected_confidence")).alias("c"), F.col("pattern_id").alias("p")))).alias("best")).drop("name")
    found = F.coalesce("found_attributes", F.lit(0))
    rows = (spread(tables.withColumn("name", F.lower("source_table")).join(expected, "name").drop("name"), "source_table", "pack_id")
            .join(hits, ["source_table", "pack_id"], "left"))
    return rows.select(
        "source_table", "pack_id", F.col("best.p").alias("pattern_id"), "required_attributes", found.alias("found_attributes"),
        F.coalesce("extension_columns", F.lit(0)).alias("extension_columns"),
        F.when(F.col("required_attributes") > 0, found / F.col("required_attributes")).alias("attribute_coverage"),
        F.when((F.col("required_attributes") > 0) & (found == F.col("required_attributes")), "MATCHED")
        .when((found > 0) | (F.coalesce("extension_columns", F.lit(0)) > 0), "LIKELY_CUSTOM_EXTENSION")
        .otherwise("UNRESOLVED").alias("match_outcome"), F.lit("PROPOSED").alias("approval_state"))
