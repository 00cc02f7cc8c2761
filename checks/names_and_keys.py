"""Naming, privacy, typing, scoring, key and relationship queries on the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import text as X
from catalograph.functions.skew import lookup_join, spread
from catalograph.operators import keys as K
from catalograph.operators import documentation, naming, privacy, profile, scoring
from catalograph.plans import build
from catalograph.sources.packs import load_pack, pack_registry
from checks.base import (CATALOGUE_SQL, CONVENTION_SQL, HYPOTHESES_SQL, NAMED_SQL, PARTS_SQL, PRIVACY_SQL, RUN,
                         catalogue, concepts, registry, table, values, written)
from checks.observed import (COUNTED_SQL, FAMILY_SQL, PAIRS_SQL, REFERENCES_SQL, ROLES_SQL, STRENGTH_SQL, links, obs_query, observations, observed,
                             observations_plan, members, members_sql, roles)

QUERIES, ORACLES, query = registry()
_NAMES = "names AS (SELECT DISTINCT source_column FROM attrs)"


def _name_counts(attributes):
    return attributes.groupBy("source_column").agg(F.count(F.lit(1)).alias("n"))


def _words(spark, sf_dir):
    """Distinct words of all documents, as column names to be read."""
    return (table(spark, sf_dir, "documents")
            .select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z0-9_]+)"))).alias("source_column")).distinct()
            .transform(spread, "source_column"))


_WORDS = "names AS (SELECT DISTINCT unnest(regexp_extract_all(text, '([A-Za-z0-9_]+)')) AS source_column FROM documents)"


@query(f"WITH {_WORDS} SELECT source_column, {CONVENTION_SQL.format(c='source_column')} AS naming_convention, "
       f"array_to_string({PARTS_SQL.format(c='source_column')}, '|') AS parts FROM names")
def name_conventions(spark, sf_dir):
    """N1, N2 over every distinct word of the documents."""
    c = F.col("source_column")
    return _words(spark, sf_dir).select(
        c, X.naming_convention(c).alias("naming_convention"), F.array_join(X.name_parts(c), "|").alias("parts"))


@query(f"WITH RECURSIVE {_WORDS}, {HYPOTHESES_SQL} SELECT source_column, string_agg(segs[i].t, '|' ORDER BY i) AS tokens "
       "FROM spot GROUP BY source_column")
def name_segments(spark, sf_dir):
    """N3 over every distinct word of the documents."""
    cut = naming.name_segments(_words(spark, sf_dir).where("replace(source_column, '_', '') <> ''"), load_pack("naming"))
    return cut.select("source_column", F.array_join("segments.token", "|").alias("tokens"))


@query(f"WITH RECURSIVE {_WORDS}, {HYPOTHESES_SQL} SELECT source_column, string_agg(segs[i].t, '|' ORDER BY i) AS tokens "
       "FROM spot GROUP BY source_column")
def name_tokens(spark, sf_dir):
    """N3 by a join with the token table, for token tables of any size."""
    tokens = spark.createDataFrame([(r["token"],) for r in load_pack("naming")["token_rules"]], "token string")
    return naming.name_tokens(_words(spark, sf_dir), tokens).select("source_column", F.array_join("tokens", "|").alias("tokens"))


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, {_NAMES}, {HYPOTHESES_SQL} "
       "SELECT source_column, expanded, rules, CASE WHEN over THEN 'TOKEN_HYPOTHESIS_LIMIT' ELSE 'OK' END AS name_status, "
       "row_number() OVER (PARTITION BY source_column ORDER BY path)::INTEGER - 1 AS position FROM hyp")
def name_hypotheses(spark, sf_dir):
    """Every expansion of every catalogue name, in rule order."""
    names = spread(catalogue(spark, sf_dir).select("source_column").distinct(), "source_column")
    found = naming.name_hypotheses(names, load_pack("naming"))
    return (found.select("source_column", "name_status", F.posexplode("hypotheses").alias("position", "h"))
            .select("source_column", "h.expanded", "h.rules", "name_status", "position"))


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, {_NAMES}, {HYPOTHESES_SQL}, {NAMED_SQL} SELECT * FROM named")
def name_match(spark, sf_dir):
    """The concept, name and contradiction of every catalogue name."""
    names = catalogue(spark, sf_dir).select("source_column").distinct()
    named = naming.classify_names(names, concepts(spark), load_pack("naming"), store=written)
    return (named.withColumns({"rule_ids": F.array_join("rule_ids", ","),
                               "semantic_candidates": F.array_join("semantic_candidates", ",")})
            .drop("hypotheses", "naming_contradicted"))


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, {_NAMES}, {HYPOTHESES_SQL}, {PRIVACY_SQL} "
       "SELECT source_table, source_column, privacy_class, privacy_rationale, privacy_rule_id "
       "FROM attrs JOIN private USING (source_column)")
def privacy_classify(spark, sf_dir):
    """V1-V3: privacy class of every attribute."""
    attributes = catalogue(spark, sf_dir)
    counts = _name_counts(attributes)
    names = naming.name_hypotheses(spread(counts, "source_column"), load_pack("naming"))
    classes = privacy.classify_privacy(names, load_pack("privacy"))
    return lookup_join(attributes.select("source_table", "source_column"), classes.select(
        "source_column", "privacy_class", "privacy_rationale", "privacy_rule_id", "n"), ["source_column"], "n", how="inner")


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, names AS (SELECT DISTINCT 'EXP_EXP_EXP_EXP_' || source_column AS source_column FROM attrs), "
       f"{HYPOTHESES_SQL}, {NAMED_SQL}, {PRIVACY_SQL} SELECT source_column, name_status, ontology_concept_id, privacy_class, "
       "privacy_rule_id, false AS prompt_eligible FROM named JOIN private USING (source_column)")
def name_limit(spark, sf_dir):
    """A name with too many readings is not guessed, and no prompt may see it."""
    names = catalogue(spark, sf_dir).select(F.concat(F.lit("EXP_EXP_EXP_EXP_"), "source_column").alias("source_column")).distinct()
    named = naming.classify_names(names, concepts(spark), load_pack("naming"), store=written)
    return privacy.classify_privacy(named, load_pack("privacy")).select(
        "source_column", "name_status", "ontology_concept_id", "privacy_class", "privacy_rule_id",
        documentation.prompt_eligible(F.col("privacy_class")).alias("prompt_eligible"))


_PACKS = [
    ("naming", "base_naming", "1.0.0", ["*"], ["*"], 0, "2024-01-01"),
    ("naming", "camel_naming", "1.2.0", ["*"], ["camelCase"], 0, "2024-01-10"),
    ("naming", "click_naming", "2.0.0", ["click", "view"], ["*"], 0, "2024-01-12"),
    ("naming", "view_naming", "2.1.0", ["VIEW"], ["*"], 0, "2024-01-12"),
    ("naming", "new_naming", "3.0.0", ["*"], ["*"], 5, "2024-01-20"),
    ("privacy", "late_privacy", "1.0.0", ["*"], ["*"], 0, "2024-01-15"),
]


@query("WITH " + values("pack", "capability,pack_id,pack_version,systems,conventions,priority,effective", [
    (c, i, v, ",".join(s).lower(), ",".join(k).lower(), p, d) for c, i, v, s, k, p, d in _PACKS]) + """,
req AS (SELECT DISTINCT capability, event_type AS source_system, convention AS naming_convention, ts::DATE AS as_of
  FROM events, (VALUES ('naming'),('privacy')) c(capability), (VALUES ('snake_case'),('camelCase')) n(convention)
  WHERE (user_id % 2 = 0) = (convention = 'camelCase')),
fit AS (SELECT r.*, pack_id, pack_version, list_contains(string_split(systems, ','), lower(source_system)) AS s,
  list_contains(string_split(conventions, ','), lower(naming_convention)) AS k, priority, effective::DATE AS d
  FROM req r JOIN pack USING (capability) WHERE effective::DATE <= as_of
  AND (list_contains(string_split(systems, ','), lower(source_system)) OR systems = '*')
  AND (list_contains(string_split(conventions, ','), lower(naming_convention)) OR conventions = '*')),
ranked AS (SELECT *, rank() OVER (PARTITION BY capability, source_system, naming_convention, as_of
  ORDER BY s DESC, k DESC, priority DESC, d DESC) AS rk FROM fit),
top AS (SELECT capability, source_system, naming_convention, as_of, count(*) AS n, min(pack_id) AS p, min(pack_version) AS v,
  string_agg(pack_id, ',' ORDER BY pack_id) AS tied FROM ranked WHERE rk = 1 GROUP BY ALL)
SELECT r.capability, r.source_system, r.naming_convention, CAST(r.as_of AS VARCHAR) AS as_of,
  CASE WHEN n IS NULL THEN 'NO_PACK' WHEN n = 1 THEN 'RESOLVED' ELSE 'AMBIGUOUS' END AS status,
  CASE WHEN n = 1 THEN p END AS pack_id, CASE WHEN n = 1 THEN v END AS pack_version, CASE WHEN n > 1 THEN tied END AS tied_packs
FROM req r LEFT JOIN top USING (capability, source_system, naming_convention, as_of)""")
def pack_resolve_asof(spark, sf_dir):
    """The rule pack of every event type, convention and day of the events."""
    registry = pack_registry(spark, [
        {"capability": c, "pack_id": i, "pack_version": v, "source_systems": s, "naming_conventions": k,
         "priority": p, "effective_date": d} for c, i, v, s, k, p, d in _PACKS])
    requests = table(spark, sf_dir, "events").select(
        F.explode(F.array(F.lit("naming"), F.lit("privacy"))).alias("capability"),
        F.col("event_type").alias("source_system"),
        F.when(F.col("user_id") % 2 == 0, "camelCase").otherwise("snake_case").alias("naming_convention"),
        F.to_date("ts").alias("as_of"))
    return naming.resolve_packs(requests, registry).withColumn("as_of", F.col("as_of").cast("string"))


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, {_NAMES}, {HYPOTHESES_SQL}, {NAMED_SQL}, {PRIVACY_SQL} "
       f"SELECT n.source_column, array_to_string({REFERENCES_SQL}, ';') AS rule_references "
       "FROM named n JOIN private USING (source_column)")
def provenance_references(spark, sf_dir):
    """Evidence references of every distinct name."""
    named = build.classified_names(catalogue(spark, sf_dir), concepts(spark), RUN, written)
    return named.select("source_column", F.array_join("rule_references", ";").alias("rule_references"))


@query(f"WITH RECURSIVE {CATALOGUE_SQL}, {_NAMES}, {HYPOTHESES_SQL}, {NAMED_SQL} "
       f"SELECT source_table, source_column, physical_type, {FAMILY_SQL} AS type_family, {STRENGTH_SQL} AS type_strength "
       "FROM attrs JOIN named USING (source_column)")
def type_strength(spark, sf_dir):
    """Type family and its agreement with the concept type."""
    attributes = catalogue(spark, sf_dir)
    counts = _name_counts(attributes)
    named = naming.classify_names(counts.select("source_column"), concepts(spark), load_pack("naming"), store=written)
    joined = lookup_join(attributes, named.select("source_column", "ontology_concept_type").join(counts, "source_column"),
                         ["source_column"], "n", how="inner")
    pack, kind = load_pack("types"), F.col("physical_type")
    return joined.select("source_table", "source_column", "physical_type",
                         scoring.type_family(kind, pack).alias("type_family"),
                         scoring.type_strength(kind, F.col("ontology_concept_type"), pack).alias("type_strength"))


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL} SELECT source_table, source_column, signature, entity, "
       "array_to_string(toks, '|') AS tokens FROM sigd")
def name_signatures(spark, sf_dir):
    """K1, K2: tokens, table entity and identifier signature."""
    c, t = F.col("source_column"), F.col("source_table")
    return catalogue(spark, sf_dir).select(
        t, c, X.identifier_signature(c).alias("signature"), X.entity_text(t).alias("entity"),
        F.array_join(X.identifier_tokens(c), "|").alias("tokens"))


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL} SELECT source_table, source_column, signature, key_role FROM roles")
def key_roles(spark, sf_dir):
    """K3: key role of every attribute in its table."""
    return K.key_roles(catalogue(spark, sf_dir)).select("source_table", "source_column", "signature", "key_role")


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL} SELECT source_table, source_column, CASE WHEN signature IS NULL THEN 'NON_KEY' "
       "WHEN entity <> '' AND split_part(signature, ' ', 1) = split_part(entity, ' ', -1) THEN 'PRIMARY_KEY_CANDIDATE' "
       "ELSE 'FOREIGN_KEY_CANDIDATE' END AS key_role FROM sigd")
def single_key_roles(spark, sf_dir):
    """K4: key role from one column alone."""
    t, c = F.col("source_table"), F.col("source_column")
    return catalogue(spark, sf_dir).select(t, c, K.single_key_role(t, c).alias("key_role"))


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL}, {members_sql()} SELECT * FROM members")
def relationship_candidates(spark, sf_dir):
    """K5: the links of all foreign columns, as both sides of each match key."""
    return members(spark, sf_dir)


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL}, {PAIRS_SQL} SELECT source_table, source_column, link_count::BIGINT AS link_count, first_target, "
       "candidate_strength, candidate_conflict FROM links JOIN strengths USING (source_table, source_column)")
def relationship_links(spark, sf_dir):
    """K5, K7: links of every foreign attribute, whatever the size of its key."""
    return K.relationship_links(roles(spark, sf_dir)).where("link_count > 0")


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL}, {PAIRS_SQL} SELECT * FROM evidence")
def relationship_evidence(spark, sf_dir):
    """K6: evidence text per foreign attribute."""
    found = links(spark, sf_dir).select("source_table", "source_column", K.relationship_evidence().alias("relationship_evidence"))
    return found.where("relationship_evidence IS NOT NULL")


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL}, {COUNTED_SQL} SELECT r.source_table, r.source_column, "
       "coalesce(candidate_strength, CASE WHEN signature IS NOT NULL THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END) AS relationship_strength, "
       "CASE WHEN candidate_conflict THEN 'The types of the two columns do not fit together.' END AS relationship_contradictions "
       "FROM roles r LEFT JOIN strengths USING (source_table, source_column)")
def relationship_strengths(spark, sf_dir):
    """K7, K8: relationship strength and contradiction of every attribute, from counts alone."""
    r = roles(spark, sf_dir)
    joined = r.join(links(spark, sf_dir), ["source_table", "source_column"], "left")
    return joined.select(
        "source_table", "source_column",
        K.relationship_strength(F.col("signature"), F.col("candidate_strength")).alias("relationship_strength"),
        F.when(F.col("candidate_conflict"), K.CONFLICT_TEXT).alias("relationship_contradictions"))


_OBS_COLUMNS = ("schema_version, run_id, artifact_version, engagement_id, source_system, source_table, source_column, "
                "ordinal_position, physical_type, nullable, key_role, relationship_evidence, proposed_business_name, "
                "ontology_concept_id, domain, observed_or_inferred, confidence_score, evidence_coverage, confidence_reason, "
                "formula_version, assumptions, contradictions, open_question, privacy_class, privacy_rationale, "
                "approval_state, reviewer_role, review_rationale, array_to_string(evidence_references, ';') AS evidence_references")


@query(obs_query(f"SELECT {_OBS_COLUMNS} FROM obs"))
def attribute_observations(spark, sf_dir):
    """The whole build: K, N, V, T and C on every attribute."""
    return (observations_plan(spark, sf_dir).withColumn("evidence_references", F.array_join("evidence_references", ";"))
            .drop("created_at", "confidence_components"))


@query(obs_query("SELECT source_table, source_column, naming_strength, type_strength, relationship_strength FROM obs"))
def dictionary_projection(spark, sf_dir):
    """Strengths pulled out of the components JSON of the written observations."""
    from catalograph.sources.sink import PROJECTED_STRENGTHS, dictionary_projection as project
    return project(observations(spark, sf_dir)).select("source_table", "source_column", *PROJECTED_STRENGTHS)


ROUTE_SQL = """CASE WHEN privacy_class <> 'INTERNAL' THEN {'t':'PRIVACY','r':'The name may concern private data','o':'PRIVACY_STEWARD','p':'HIGH'}
 WHEN key_role = 'PRIMARY_KEY_CANDIDATE' THEN {'t':'KEY_CANDIDATE','r':'Primary Key Candidate goes to the architect','o':'DATA_ARCHITECT','p':'HIGH'}
 WHEN key_role = 'FOREIGN_KEY_CANDIDATE' THEN {'t':'KEY_CANDIDATE','r':'Foreign Key Candidate goes to the architect','o':'DATA_ARCHITECT','p':'HIGH'}
 WHEN relationship_evidence IS NOT NULL THEN {'t':'RELATIONSHIP','r':'A link was inferred from names','o':'DATA_ARCHITECT','p':'MEDIUM'}
 WHEN contradictions IS NOT NULL THEN {'t':'CONTRADICTION','r':'The evidence disagrees','o':'DOMAIN_STEWARD','p':'HIGH'}
 WHEN ontology_concept_id IS NULL THEN {'t':'UNMAPPED_CONCEPT','r':'No concept is mapped','o':'DOMAIN_STEWARD','p':'MEDIUM'}
 WHEN evidence_coverage < 0.6 THEN {'t':'LOW_EVIDENCE_COVERAGE','r':'Evidence coverage ' || printf('%.2f', evidence_coverage) || ' is under 0.6','o':'DOMAIN_STEWARD','p':'MEDIUM'}
 WHEN confidence_score < 0.75 THEN {'t':'LOW_CONFIDENCE','r':'The score is under the threshold','o':'DOMAIN_STEWARD','p':'MEDIUM'} END"""


@query(obs_query(f"SELECT source_table, source_column, w.t AS review_trigger, w.r AS review_reason, w.o AS recommended_reviewer_role, "
                 f"w.p AS review_priority FROM (SELECT *, {ROUTE_SQL} AS w FROM obs)"))
def review_routes(spark, sf_dir):
    """Trigger, reason, role and priority of every attribute."""
    return scoring.routed(observed(spark, sf_dir)).select(
        "source_table", "source_column", "review_trigger", "review_reason", "recommended_reviewer_role", "review_priority")


_RANK = "CASE privacy_class WHEN 'INTERNAL' THEN 0 WHEN 'PERSONAL_DATA' THEN 1 WHEN 'SENSITIVE' THEN 2 ELSE 3 END"


@query(obs_query(f"""SELECT t.*, d.domain AS proposed_domain FROM (
 SELECT source_table, 'TABLE' AS object_type, count(*) AS column_count,
  round(CAST(avg(confidence_score) AS DECIMAL(20,12)), 4)::DOUBLE AS proposed_domain_confidence,
  CASE WHEN max({_RANK}) > 0 THEN 'PERSONAL_DATA' ELSE 'INTERNAL' END AS privacy_class,
  max_by(privacy_class, {_RANK}) AS max_privacy_class,
  CASE WHEN max({_RANK}) > 0 THEN 'One or more column names point to personal data.'
   ELSE 'No column name points to personal data.' END AS privacy_rationale,
  CASE WHEN max({_RANK}) > 0 THEN 'PRIVACY_STEWARD' END AS reviewer_role,
  sum(len(evidence_references))::BIGINT AS evidence_count FROM obs GROUP BY source_table) t
 JOIN (SELECT source_table, domain, row_number() OVER (PARTITION BY source_table ORDER BY count(*) DESC, domain) AS rn
  FROM obs GROUP BY source_table, domain) d ON d.source_table = t.source_table AND rn = 1"""))
def object_rollup(spark, sf_dir):
    """O1, V8: one row per table."""
    return K.object_rollup(observed(spark, sf_dir))


@query(obs_query("SELECT source_table, ordinal_position, unnest(range(0, len(evidence_references)))::INTEGER AS position, "
                 "unnest(evidence_references) AS evidence_reference FROM obs"))
def object_evidence(spark, sf_dir):
    """O1: evidence references of every table, one row each."""
    return K.object_evidence(observed(spark, sf_dir))


@query(obs_query("SELECT source_table, source_column, ontology_concept_id, type_strength FROM obs "
                 "WHERE ontology_concept_id IS NOT NULL AND type_strength <= 0.55"))
def name_type_contradictions(spark, sf_dir):
    """Q9: mapped attributes whose type does not fit."""
    from catalograph.operators.quality import name_type_contradictions as find
    from catalograph.sources.sink import dictionary_projection as project
    return find(project(observed(spark, sf_dir))).select(
        "source_table", "source_column", "ontology_concept_id", "type_strength")


@query("""SELECT 'orders.o_custkey' AS link, count(*) AS child_values, count(p.k) AS matched_values,
 round(count(p.k) / count(*), 6) AS overlap_ratio FROM (SELECT DISTINCT o_custkey AS k FROM orders) c
 LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_nationkey <> 3) p ON c.k = p.k
UNION ALL SELECT 'lineitem.l_partkey', count(*), count(p.k), round(count(p.k) / count(*), 6)
 FROM (SELECT DISTINCT l_partkey AS k FROM lineitem) c LEFT JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size <= 25) p ON c.k = p.k
UNION ALL SELECT 'documents.doc_id', count(*), count(p.k), round(count(p.k) / count(*), 6)
 FROM (SELECT DISTINCT doc_id AS k FROM documents) c LEFT JOIN (SELECT DISTINCT doc_id AS k FROM labels) p ON c.k = p.k""")
def value_overlap(spark, sf_dir):
    """K9: overlap of child values with parent values."""
    t = lambda n: table(spark, sf_dir, n)
    links = (("orders.o_custkey", t("orders"), "o_custkey", t("customer").where("c_nationkey <> 3"), "c_custkey"),
             ("lineitem.l_partkey", t("lineitem"), "l_partkey", t("part").where("p_size <= 25"), "p_partkey"),
             ("documents.doc_id", t("documents"), "doc_id", t("labels"), "doc_id"))
    out = None
    for name, child, cc, parent, pc in links:
        row = K.value_overlap(child, cc, parent, pc).select(
            F.lit(name).alias("link"), "child_values", "matched_values", F.round("overlap_ratio", 6).alias("overlap_ratio"))
        out = row if out is None else out.unionByName(row)
    return out
