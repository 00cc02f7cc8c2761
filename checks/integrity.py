"""Table-integrity, knowledge and label-evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators import knowledge as G
from catalograph.operators import report as E
from catalograph.sources import scan
from checks.base import CATALOGUE_SQL, catalogue, table, values, registry
from checks.observed import created, links, obs_query, observations

QUERIES, ORACLES, query = registry()


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_keys(spark, sf_dir):
    """Key values on more than one row."""
    return G.unique_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40) GROUP BY 1")
def dangling_references(spark, sf_dir):
    """References without a parent, with how many rows carry each."""
    return G.dangling_refs(table(spark, sf_dir, "lineitem"), ["l_partkey"], table(spark, sf_dir, "part").where("p_size <= 40"), ["p_partkey"])


# Parts are concepts, line items their authored relationships to other parts.
_TYPES = [r[0] for r in G.RELATIONSHIP_TYPES] + ["resembles"]
_TYPE_LIST = "[" + ",".join(f"'{t}'" for t in _TYPES) + "]"
_EDGES = f"""edge AS (SELECT 'C.' || l_suppkey AS source_id, ({_TYPE_LIST})[1 + (l_orderkey + l_linenumber) % {len(_TYPES)}] AS edge_type,
 'C.' || l_partkey AS target_id FROM lineitem)"""
_RULES = values("rule", "edge_type,relationship_type,source_cardinality,target_cardinality", [tuple(r) for r in G.RELATIONSHIP_TYPES])


def _edge_array():
    types = "array(" + ",".join(f"'{t}'" for t in _TYPES) + ")"
    return F.expr(f"array(named_struct('type', element_at({types}, cast(1 + (l_orderkey + l_linenumber) % {len(_TYPES)} AS int)), "
                  "'target', concat('C.', l_partkey)))")


def _edges(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("C."), F.col("l_suppkey")).alias("concept_id"), _edge_array().alias("relationships"))
    return G.nested_edges(rows, "concept_id", "relationships")


@query(f"WITH {_EDGES}, {_RULES} SELECT e.source_id, e.edge_type, e.target_id, relationship_type, source_cardinality, target_cardinality, "
       "'REL.' || concat_ws('.', e.source_id, relationship_type, e.target_id) AS relationship_id FROM edge e LEFT JOIN rule USING (edge_type)")
def edge_normalize(spark, sf_dir):
    """Nested relationships to rows with governed types."""
    return G.normalize_edges(_edges(spark, sf_dir))


@query(f"WITH {_EDGES} SELECT target_id, source_id, edge_type, 'TARGET_OUTSIDE_GOVERNED_SCOPE' AS reason FROM edge "
       "WHERE target_id NOT IN (SELECT 'C.' || p_partkey FROM part WHERE p_type IN ('PROMO', 'LARGE', 'SMALL'))")
def scope_excluded_edges(spark, sf_dir):
    """Edges whose target lies outside the selected domains."""
    nodes = table(spark, sf_dir, "part").where("p_type IN ('PROMO', 'LARGE', 'SMALL')").select(
        F.concat(F.lit("C."), F.col("p_partkey")).alias("node_id"))
    return G.scope_split(_edges(spark, sf_dir), nodes)[1]


@query(f"WITH {_EDGES} SELECT * FROM edge WHERE target_id IN (SELECT 'C.' || p_partkey FROM part WHERE p_type IN ('PROMO', 'LARGE', 'SMALL'))")
def scope_kept_edges(spark, sf_dir):
    """Edges inside the selected domains."""
    nodes = table(spark, sf_dir, "part").where("p_type IN ('PROMO', 'LARGE', 'SMALL')").select(
        F.concat(F.lit("C."), F.col("p_partkey")).alias("node_id"))
    return G.scope_split(_edges(spark, sf_dir), nodes)[0]


_PRIV = ["NONE", "INDIRECT", "DIRECT", "SENSITIVE", "SECRET"]


def _concepts(spark, sf_dir):
    """Parts as authored concepts, with the line items' parts as relationship targets."""
    edges = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("p_partkey")).agg(
        F.array_sort(F.collect_set(F.struct(
            F.expr(f"element_at(array({','.join(repr(t) for t in _TYPES)}), cast(1 + l_orderkey % {len(_TYPES)} AS int))").alias("type"),
            F.concat(F.lit("C."), F.col("l_partkey") + F.when(F.col("l_partkey") % 97 == 0, 10_000_000).otherwise(0)).alias("target")))).alias("relationships"))
    return table(spark, sf_dir, "part").join(edges, "p_partkey", "left").select(
        F.concat(F.lit("C."), F.col("p_partkey") - F.when(F.col("p_partkey") % 200 == 1, 1).otherwise(0)).alias("concept_id"),
        F.col("p_name").alias("name"), F.col("p_brand").alias("definition"), F.col("p_type").alias("domain"),
        F.when(F.col("p_size") % 2 == 0, "MEASURE").when(F.col("p_size") % 5 == 0, "SHAPE").otherwise("CODE").alias("concept_type"),
        F.lit("Standard").alias("lifecycle_state"), F.lit("CURRENT").alias("temporality"),
        F.expr(f"element_at(array({','.join(repr(p) for p in _PRIV)}), cast(1 + p_size % 5 AS int))").alias("privacy_sensitivity"),
        F.array("p_name").alias("synonyms"), F.when(F.col("p_size") % 3 == 0, F.array("p_brand", "p_type")).alias("lob_applicability"),
        F.coalesce("relationships", F.array().cast("array<struct<type:string,target:string>>")).alias("relationships"))


_CONCEPTS = f"""cedge AS (SELECT DISTINCT l_suppkey AS k, ({_TYPE_LIST})[1 + l_orderkey % {len(_TYPES)}] AS t,
  'C.' || (l_partkey + CASE WHEN l_partkey % 97 = 0 THEN 10000000 ELSE 0 END) AS target FROM lineitem),
con AS (SELECT 'C.' || (p_partkey - CASE WHEN p_partkey % 200 = 1 THEN 1 ELSE 0 END) AS concept_id, p_partkey, p_name, p_brand, p_type AS domain,
  CASE WHEN p_size % 2 = 0 THEN 'MEASURE' WHEN p_size % 5 = 0 THEN 'SHAPE' ELSE 'CODE' END AS concept_type,
  (['NONE','INDIRECT','DIRECT','SENSITIVE','SECRET'])[1 + p_size % 5] AS sens, p_size FROM part)"""


@query(f"WITH {_CONCEPTS} SELECT concept_id, p_name AS concept_name, CASE sens WHEN 'NONE' THEN 'INTERNAL' WHEN 'INDIRECT' THEN 'PERSONAL_DATA' "
       "WHEN 'DIRECT' THEN 'PERSONAL_DATA' WHEN 'SENSITIVE' THEN 'SENSITIVE' END AS privacy_class, "
       "CASE WHEN p_size % 3 = 0 THEN p_brand || ',' || domain ELSE 'ALL' END AS lob_applicability, 'parts_foundation' AS module, domain, "
       "'parts.json#sha256:ab' AS evidence FROM con")
def concept_normalize(spark, sf_dir):
    """G1: concepts with scope, provenance, mapped privacy and filled arrays."""
    pack = {"pack_id": "parts_ontology", "pack_version": "1.0.0", "status": "PROPOSED"}
    rows = G.normalize_concepts(_concepts(spark, sf_dir), pack, "ab", "parts.json", "2026-01-01", created())
    return rows.select("concept_id", "concept_name", "privacy_class", F.array_join("lob_applicability", ",").alias("lob_applicability"),
                       "scope.module", "scope.domain", F.array_join("provenance.evidence_references", ",").alias("evidence"))


@query(f"""WITH {_CONCEPTS} SELECT concept_id AS subject, 'concept id is not unique' AS finding FROM con GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT target, 'relationship target is missing' FROM cedge JOIN con ON p_partkey = k WHERE target NOT IN (SELECT concept_id FROM con) GROUP BY 1
UNION ALL SELECT concept_id || '.' || t || '.' || target, 'relationship id is not unique' FROM cedge JOIN con ON p_partkey = k GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT concept_id, 'domain is not declared' FROM con WHERE domain NOT IN ('PROMO','LARGE','SMALL','MEDIUM','ECONOMY')
UNION ALL SELECT t, 'unsupported relationship type' FROM cedge JOIN con ON p_partkey = k WHERE t = 'resembles'
UNION ALL SELECT concept_id, 'unsupported privacy sensitivity' FROM con WHERE sens = 'SECRET'
UNION ALL SELECT concept_id, 'undeclared concept type' FROM con WHERE concept_type = 'SHAPE'""")
def ontology_integrity(spark, sf_dir):
    """Every integrity finding of an ontology."""
    return G.ontology_integrity(_concepts(spark, sf_dir), ["PROMO", "LARGE", "SMALL", "MEDIUM", "ECONOMY"], ["MEASURE", "CODE"])


@query("""WITH m AS (SELECT s_suppkey, 'm' || s_suppkey AS module, CASE WHEN s_suppkey % 13 = 0 THEN '2.0.0' ELSE '1.0.0' END AS v, s_nationkey % 5 AS d FROM supplier),
c AS (SELECT 'm' || l_suppkey AS module, 'C' || (l_partkey % 400) || '.' || l_linenumber || '.' || l_orderkey % 30 AS concept_id,
  CASE WHEN l_orderkey % 41 = 0 THEN -1 ELSE s_nationkey % 5 END AS d, CASE WHEN l_orderkey % 53 = 0 THEN 'SHAPE' ELSE 'CODE' END AS t
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_suppkey % 17 <> 0),
v AS (SELECT 'm' || c_nationkey AS module, 'V' || (c_custkey // 2) AS vocabulary_id FROM customer),
s AS (SELECT 'm' || (o_custkey % 10) AS module, 'S' || (o_orderkey - CASE WHEN o_orderkey % 500 = 1 THEN 1 ELSE 0 END) AS shape_id, o_orderkey, o_custkey FROM orders),
used AS (SELECT DISTINCT 'C' || (o_custkey % 410) || '.1.' || o_orderkey % 30 AS concept_id FROM s UNION SELECT DISTINCT 'C' || (o_custkey % 400) || '.2.1' FROM s)
SELECT module || ':pack_version' AS subject, 'identity differs from the bundle root' AS finding FROM m WHERE v <> '1.0.0'
UNION ALL SELECT module, 'module is empty' FROM m WHERE module NOT IN (SELECT module FROM c) AND module NOT IN (SELECT module FROM v) AND module NOT IN (SELECT module FROM s)
UNION ALL SELECT concept_id, 'concept outside the declared domain' FROM c WHERE d = -1
UNION ALL SELECT concept_id, 'concept id is not unique' FROM c GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT concept_id, 'undeclared concept type' FROM c WHERE t = 'SHAPE'
UNION ALL SELECT vocabulary_id, 'vocabulary id is not unique' FROM v GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT shape_id, 'shape id is not unique' FROM s GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT concept_id, 'shape uses a missing concept' FROM used WHERE concept_id NOT IN (SELECT concept_id FROM c)""")
def bundle_integrity(spark, sf_dir):
    """Rules of a federated bundle, suppliers as modules."""
    t = lambda n: table(spark, sf_dir, n)
    modules = t("supplier").selectExpr("concat('m', s_suppkey) AS module", "'core' AS pack_id", "CASE WHEN s_suppkey % 13 = 0 THEN '2.0.0' ELSE '1.0.0' END AS pack_version",
                                       "'PROPOSED' AS status", "cast(s_nationkey % 5 AS string) AS domain")
    concepts = t("lineitem").where("l_suppkey % 17 <> 0").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
        "concat('m', l_suppkey) AS module", "concat('C', l_partkey % 400, '.', l_linenumber, '.', l_orderkey % 30) AS concept_id",
        "CASE WHEN l_orderkey % 41 = 0 THEN '-1' ELSE cast(s_nationkey % 5 AS string) END AS domain",
        "CASE WHEN l_orderkey % 53 = 0 THEN 'SHAPE' ELSE 'CODE' END AS concept_type")
    vocabularies = t("customer").selectExpr("concat('m', c_nationkey) AS module", "concat('V', c_custkey div 2) AS vocabulary_id")
    shapes = t("orders").selectExpr(
        "concat('m', o_custkey % 10) AS module", "concat('S', o_orderkey - CASE WHEN o_orderkey % 500 = 1 THEN 1 ELSE 0 END) AS shape_id",
        "concat('C', o_custkey % 410, '.1.', o_orderkey % 30) AS root_concept_id", "array(concat('C', o_custkey % 400, '.2.1')) AS required_concept_ids",
        "cast(NULL AS array<string>) AS optional_concept_ids")
    return G.bundle_integrity(modules, concepts, vocabularies, shapes,
                              {"pack_id": "core", "pack_version": "1.0.0", "status": "PROPOSED"}, ["CODE"])


_HEADER = {"pack_id": "core", "pack_version": "1.0.0", "scope_text": "all", "authoring_source": "pack.json#sha256:ff", "document_id": "DOC.1"}
_PATTERNS = """r AS (SELECT o_orderkey, 'R' || o_orderkey AS record_id, CASE WHEN o_orderkey % 61 = 0 THEN '1.1.0' ELSE '1.0.0' END AS v,
  list_filter(['DOC.1', CASE WHEN o_orderkey % 47 <> 0 THEN 'pack.json#sha256:ff' END, CASE WHEN o_orderkey % 29 = 0 THEN 'X.' || o_custkey END], lambda x: x IS NOT NULL) AS refs FROM orders),
p AS (SELECT 'P' || (l_orderkey * 10 + l_linenumber - CASE WHEN l_partkey % 300 = 5 THEN 1 ELSE 0 END) AS pattern_id,
  (['OBJECT','ATTRIBUTE','RELATIONSHIP','EXTENSION_MARKER'])[1 + l_partkey % 4] AS k, CASE WHEN l_suppkey % 9 <> 0 THEN 'C.' || l_partkey END AS c,
  CASE WHEN l_linenumber % 2 = 1 THEN 'a' END AS a, CASE WHEN l_orderkey % 6 = 0 THEN 'Standard' ELSE 'Source extension' END AS life FROM lineitem)"""


@query(f"""WITH {_PATTERNS}
SELECT record_id || ':pack_version' AS subject, 'record differs from the pack' AS finding FROM r WHERE v <> '1.0.0'
UNION ALL SELECT record_id, 'unauthorized evidence reference' FROM r WHERE o_orderkey % 29 = 0
UNION ALL SELECT record_id, 'authoring source is not cited' FROM r WHERE o_orderkey % 47 = 0
UNION ALL SELECT pattern_id, 'pattern id is not unique' FROM p GROUP BY 1 HAVING count(*) > 1
UNION ALL SELECT pattern_id, unnest(list_filter([CASE WHEN k = 'EXTENSION_MARKER' AND c IS NOT NULL THEN 'extension marker has no concept' END,
  CASE WHEN k <> 'EXTENSION_MARKER' AND c IS NULL THEN 'pattern needs a concept' END, CASE WHEN k = 'ATTRIBUTE' AND a IS NULL THEN 'attribute pattern needs an attribute' END,
  CASE WHEN k = 'OBJECT' AND a IS NOT NULL THEN 'object pattern has no attribute' END], lambda x: x IS NOT NULL)) FROM p
UNION ALL SELECT pattern_id, 'extension marker lifecycle' FROM p WHERE k = 'EXTENSION_MARKER' AND life <> 'Source extension'
UNION ALL SELECT DISTINCT c, 'concept is not available' FROM p WHERE k <> 'EXTENSION_MARKER' AND c IS NOT NULL AND c NOT IN (SELECT 'C.' || p_partkey FROM part WHERE p_size < 45)
UNION ALL SELECT 'c' || c_custkey, 'unsupported exclusion reason' FROM customer WHERE c_custkey % 77 = 3""")
def pattern_pack_integrity(spark, sf_dir):
    """Rules of an authored pattern pack."""
    t = lambda n: table(spark, sf_dir, n)
    records = t("orders").selectExpr(
        "concat('R', o_orderkey) AS record_id", "'all' AS scope_text", "'core' AS pack_id",
        "CASE WHEN o_orderkey % 61 = 0 THEN '1.1.0' ELSE '1.0.0' END AS pack_version", "'ff' AS content_fingerprint",
        "array_compact(array('DOC.1', CASE WHEN o_orderkey % 47 <> 0 THEN 'pack.json#sha256:ff' END, CASE WHEN o_orderkey % 29 = 0 THEN concat('X.', o_custkey) END)) AS evidence_references")
    concepts = t("part").where("p_size < 45").selectExpr("concat('C.', p_partkey) AS concept_id")
    allowed = t("region").selectExpr("inline(array(named_struct('evidence_reference', 'DOC.1'), named_struct('evidence_reference', 'pack.json#sha256:ff')))")
    return G.pattern_pack_integrity(records, _patterns(spark, sf_dir), _exclusions(spark, sf_dir), concepts, allowed, _HEADER)


def _patterns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('P', l_orderkey * 10 + l_linenumber - CASE WHEN l_partkey % 300 = 5 THEN 1 ELSE 0 END) AS pattern_id",
        "element_at(array('OBJECT','ATTRIBUTE','RELATIONSHIP','EXTENSION_MARKER'), cast(1 + l_partkey % 4 AS int)) AS pattern_type",
        "CASE WHEN l_suppkey % 9 <> 0 THEN concat('C.', l_partkey) END AS ontology_concept_id",
        "CASE WHEN l_linenumber % 2 = 1 THEN 'a' END AS source_attribute_pattern",
        "CASE WHEN l_orderkey % 6 = 0 THEN 'Standard' ELSE 'Source extension' END AS lifecycle_state")


def _exclusions(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('c', c_custkey) AS source_object", f"CASE WHEN c_custkey % 77 = 3 THEN 'other' ELSE '{G.EXCLUSION_REASON}' END AS reason")


@query(f"WITH {_PATTERNS} SELECT 1 AS documents, 1 AS pack_versions, (SELECT count(*) FROM p) AS patterns, "
       "(SELECT count(*) FROM p WHERE k = 'EXTENSION_MARKER') AS extension_markers, (SELECT count(*) FROM customer) AS excluded_mappings")
def pattern_pack_counts(spark, sf_dir):
    """Record counts of the pack."""
    return G.pattern_pack_counts(_patterns(spark, sf_dir), _exclusions(spark, sf_dir))


@query("""SELECT p_partkey, unnest(list_filter([CASE WHEN p_size % 10 = 0 THEN 'path' END, CASE WHEN p_size % 7 = 0 THEN 'content_sha256' END], lambda f: f IS NOT NULL)) AS field FROM part""")
def immutable_versions(spark, sf_dir):
    """Registrations whose content changed under the same identity."""
    old = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_name AS path", "p_brand AS content_sha256")
    new = table(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_size % 10 = 0 THEN concat(p_name, '2') ELSE p_name END AS path",
                                                  "CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS content_sha256")
    return G.immutable_version(old, new, ["p_partkey"], ["path", "content_sha256"])


@query("""WITH e AS (SELECT vec_id, unnest(list_transform(embedding, lambda x: 'b' || floor(x * 20)::INT)) AS bucket FROM embeddings)
SELECT DISTINCT bucket, vec_id FROM e WHERE bucket NOT IN (SELECT 'b' || (n_nationkey - 12) FROM nation WHERE n_regionkey <> 2)""")
def array_subset(spark, sf_dir):
    """Array elements that are not among the allowed values."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(
        "embedding", lambda x: F.concat(F.lit("b"), F.floor(x * F.lit(20).cast("float")).cast("int").cast("string"))).alias("buckets"))
    allowed = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.concat(F.lit("b"), (F.col("n_nationkey") - 12).cast("string")).alias("bucket"))
    return G.array_subset(rows, "buckets", allowed, "bucket", ["vec_id"])


@query("""WITH e AS (SELECT o_orderkey, unnest(['C.' || o_custkey, 'C.' || (o_custkey * 3)]) AS target_id FROM orders)
SELECT target_id, count(*) AS n FROM e WHERE target_id NOT IN (SELECT 'C.' || c_custkey FROM customer) GROUP BY 1""")
def referential_gaps(spark, sf_dir):
    """List elements (indicator concepts, business lines) without a target."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("array(concat('C.', o_custkey), concat('C.', o_custkey * 3))").alias("ids"))
    targets = table(spark, sf_dir, "customer").select(F.concat(F.lit("C."), F.col("c_custkey")).alias("cid"))
    return G.referential_gaps(rows, "ids", "o_orderkey", targets, "cid")


_PATTERNS = [("stg_ord*", "cust*_id", 0.9), ("stg_ord*", "c*", 0.6), ("src_cust*", "mkt_segment_cd", 0.8), ("part?", "id", 0.7),
             ("ref_nation1", "DISPLAY_NAME", 0.5), ("staging_supp1*", "supp_*", 0.4)]


@query(f"""WITH {CATALOGUE_SQL}, {values('pat', 'o,a,s', _PATTERNS)},
fit AS (SELECT source_table, source_column, max(s)::DOUBLE AS s FROM attrs JOIN pat
 ON lower(source_table) GLOB lower(o) AND lower(source_column) GLOB lower(a) GROUP BY ALL)
SELECT source_table, source_column, s AS cots_match_strength, CASE WHEN s IS NULL THEN 'NOT_AVAILABLE' ELSE 'AVAILABLE' END AS cots_availability
FROM attrs LEFT JOIN fit USING (source_table, source_column)""")
def structure_match(spark, sf_dir):
    """The best authored pattern of every attribute, globs in table and column names."""
    patterns = spark.createDataFrame([("ATTRIBUTE", *p) for p in _PATTERNS], "pattern_type string, source_object_pattern string, "
                                     "source_attribute_pattern string, expected_confidence double")
    return G.match_patterns(catalogue(spark, sf_dir), patterns).select(
        "source_table", "source_column", "cots_match_strength", "cots_availability")


_SPELLED = {"LongType()": "bigint", "StringType()": "STRING", "IntegerType()": "int", "DoubleType()": "Double", "DateType()": "date",
            "TimestampType()": "TIMESTAMP", "BooleanType()": "boolean", "DecimalType(12,2)": "decimal(12, 2)",
            "TimestampNTZType()": "timestamp_ntz"}


@query(f"WITH {CATALOGUE_SQL} SELECT source_table, source_column, ordinal_position, physical_type, nullable FROM attrs")
def catalog_inventory(spark, sf_dir):
    """A4: a catalog's own spellings of types, read back as the names that type rules know."""
    spelled = F.create_map(*[F.lit(v) for pair in _SPELLED.items() for v in pair])
    rows = catalogue(spark, sf_dir).select(
        F.col("source_table").alias("table_name"), F.col("source_column").alias("column_name"), "ordinal_position",
        F.element_at(spelled, F.col("physical_type")).alias("data_type"), F.when(F.col("nullable"), "YES").otherwise("NO").alias("is_nullable"))
    return scan.inventory_from_catalog(rows)


# ---------------------------------------------------------------- label evaluation
def _predictions(spark, sf_dir):
    return E.predictions(observations(spark, sf_dir), links(spark, sf_dir))


def _labels(spark, sf_dir):
    """Expected values for every attribute: the position says what must be found.

    The ids link to every part but only two are expected, so they must not match.
    """
    p = F.col("ordinal_position")
    none = F.lit(None).cast("string")
    rows = catalogue(spark, sf_dir)
    cust = F.regexp_extract(F.lower("source_column"), r"cust(\d+)", 1)
    return rows.select(
        F.concat_ws(".", "source_table", p.cast("string")).alias("record_id"), "source_table", "source_column",
        F.when(p == 5, F.col("source_column")).otherwise("Policy Number").alias("expected_business_name"),
        F.when(p == 3, "Policy.PolicyNumber").otherwise(none).alias("expected_ontology_concept"),
        F.when(p == 3, "Policy").otherwise("Shared").alias("expected_domain"), F.lit("INTERNAL").alias("expected_privacy_class"),
        F.when(p == 1, "PRIMARY_KEY_CANDIDATE").when(p == 2, "FOREIGN_KEY_CANDIDATE").otherwise("NON_KEY").alias("expected_key_role"),
        F.when(F.col("source_column") == "id", "part1.id|part2.id").when(F.col("source_column").startswith("nation"), F.concat(
            F.lit("ref_"), F.regexp_extract("source_column", r"(nation\d+)", 1), F.lit("."), F.col("source_column")))
        .when(p == 2, F.concat(F.lit("src_cust"), cust, F.lit(".cust"), cust, F.lit("_id"))).alias("expected_relationship_target"),
        F.when(p <= 2, "DATA_ARCHITECT").when(p == 3, "NONE").otherwise("DOMAIN_STEWARD").alias("expected_review_route"))


_EVAL = f"""pred AS (SELECT *, starts_with(coalesce(open_question, ''), 'Which of') AS naming_contradicted, CASE WHEN privacy_class <> 'INTERNAL' THEN 'PRIVACY_STEWARD'
  WHEN key_role <> 'NON_KEY' OR relationship_evidence IS NOT NULL THEN 'DATA_ARCHITECT' WHEN ontology_concept_id IS NULL THEN 'DOMAIN_STEWARD' ELSE 'NONE' END AS route,
  coalesce(link_count, 0) AS target_count FROM obs LEFT JOIN links USING (source_table, source_column)),
lab AS (SELECT *, regexp_extract(lower(source_column), 'cust(\\d+)', 1) AS ck, CASE WHEN source_column = 'id' THEN ['part1.id', 'part2.id']
  WHEN starts_with(source_column, 'nation') THEN ['ref_' || regexp_extract(source_column, '(nation\\d+)', 1) || '.' || source_column]
  WHEN ordinal_position = 2 THEN ['src_cust' || ck || '.cust' || ck || '_id'] ELSE [] END AS targets FROM attrs),
hit AS (SELECT l.source_table, l.source_column, count(*) AS hits FROM lab l JOIN scoredpairs s ON s.from_table = l.source_table
  AND s.from_column = l.source_column WHERE list_contains(l.targets, s.to_table || '.' || s.to_column) GROUP BY ALL),
cmp AS (SELECT l.source_table || '.' || l.ordinal_position AS record_id, source_table, source_column, naming_contradicted, true AS classified,
 ontology_concept_id IS NOT NULL AS ontology_resolved,
 proposed_business_name IS NOT DISTINCT FROM CASE WHEN l.ordinal_position = 5 THEN source_column ELSE 'Policy Number' END AS business_name_match,
 ontology_concept_id IS NOT DISTINCT FROM CASE WHEN l.ordinal_position = 3 THEN 'Policy.PolicyNumber' END AS ontology_concept_match,
 domain = CASE WHEN l.ordinal_position = 3 THEN 'Policy' ELSE 'Shared' END AS domain_match, privacy_class = 'INTERNAL' AS privacy_class_match,
 key_role = CASE l.ordinal_position WHEN 1 THEN 'PRIMARY_KEY_CANDIDATE' WHEN 2 THEN 'FOREIGN_KEY_CANDIDATE' ELSE 'NON_KEY' END AS key_role_match,
 coalesce(hits, 0) = target_count AND len(targets) = target_count AS relationship_target_match,
 route = CASE WHEN l.ordinal_position <= 2 THEN 'DATA_ARCHITECT' WHEN l.ordinal_position = 3 THEN 'NONE' ELSE 'DOMAIN_STEWARD' END AS review_route_match
 FROM lab l JOIN pred USING (source_table, source_column) LEFT JOIN hit USING (source_table, source_column))"""


@query(obs_query("SELECT * FROM cmp", _EVAL))
def eval_vs_labels(spark, sf_dir):
    """Field-by-field comparison of predictions and labels."""
    return E.compare_labels(_predictions(spark, sf_dir), _labels(spark, sf_dir))


@query(obs_query("SELECT count(*) AS labelled_records, 1::DOUBLE AS semantic_classification_coverage, round(count_if(ontology_resolved) / count(*), 6) AS ontology_resolution_coverage, "
                 + ", ".join(f"count_if({f}_match)::BIGINT AS {f}_matches, round(count_if({f}_match) / count(*), 6) AS {f}_rate" for f in E.EVALUATED) + " FROM cmp", _EVAL))
def eval_summary(spark, sf_dir):
    """Counts and rates of all fields."""
    out = E.evaluation_summary(eval_vs_labels(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith(("_rate", "_coverage"))})


@query(obs_query("SELECT record_id, 'NAMING_CONTRADICTED' AS exception FROM cmp WHERE naming_contradicted UNION ALL SELECT record_id, 'MISMATCHED' FROM cmp WHERE NOT ("
                 + " AND ".join(f"{f}_match" for f in E.EVALUATED) + ")", _EVAL))
def eval_exceptions(spark, sf_dir):
    """Contradicted and mismatched records."""
    return E.evaluation_exceptions(eval_vs_labels(spark, sf_dir))
