"""Documentation, review queue, decision, contract and publication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators import contracts as X
from catalograph.operators import documentation as D
from catalograph.operators import keys as K
from catalograph.operators import report as E
from catalograph.operators import review as W
from catalograph.plans import build
from checks.base import RUN, if_written, once, sql_text, table, registry, written
from checks.names_and_keys import ROUTE_SQL
from checks.observed import KEYS_SQL, created, links, members, members_sql, obs_query, observations, observed

QUERIES, ORACLES, query = registry()
KEYS = ["source_table", "source_column"]
ENDPOINT = "text-model"
PROMPT = "Describe the column."


# ---------------------------------------------------------------- documentation
def _profiles(spark, sf_dir):
    """Two evidence rows per INTERNAL attribute, values from the attribute itself."""
    rows = observations(spark, sf_dir).where("privacy_class = 'INTERNAL'").select(
        *KEYS, "run_id", "privacy_class", F.lit("AGGREGATE_PROFILE").alias("evidence_class"), F.lit(True).alias("is_minimized"),
        F.inline(F.array(
            F.struct(F.lit("NULL_RATE").alias("profile_type"), F.format_string("%.6f", F.col("ordinal_position") / 8).alias("profile_value")),
            F.struct(F.lit("DISTINCT_COUNT").alias("profile_type"), F.length("source_column").cast("string").alias("profile_value")))))
    return rows


_PROFILES = """prof AS (SELECT source_table, source_column, run_id, 'DISTINCT_COUNT' AS profile_type, length(source_column)::VARCHAR AS profile_value
  FROM obs WHERE privacy_class = 'INTERNAL'
 UNION ALL SELECT source_table, source_column, run_id, 'NULL_RATE', printf('%.6f', ordinal_position / 8) FROM obs WHERE privacy_class = 'INTERNAL')"""


def contexts(spark, sf_dir):
    """Planned anew for each reader: the texts are several times the observations they are made of."""
    return D.prompt_contexts(observations(spark, sf_dir), _profiles(spark, sf_dir))


_CONTEXTS = _PROFILES + """,
grouped AS (SELECT source_table, source_column, list({'evidence_reference': 'profile_evidence:' || run_id || ':' || source_table || '.' || source_column
  || ':' || lower(profile_type), 'profile_type': profile_type, 'profile_value': profile_value} ORDER BY profile_type) AS profiles FROM prof GROUP BY ALL),
ctx AS (SELECT o.*, privacy_class = 'INTERNAL' AS prompt_eligible, CASE WHEN privacy_class = 'INTERNAL' THEN to_json({
  'deterministic_inferences': {'assumptions': assumptions, 'contradictions': contradictions, 'domain': domain, 'key_role': key_role,
   'ontology_concept_id': ontology_concept_id, 'open_question': open_question, 'proposed_business_name': proposed_business_name,
   'relationship_evidence': relationship_evidence},
  'evidence_references': list_sort(evidence_references), 'minimized_aggregate_profiles': coalesce(profiles, []),
  'observed_physical_metadata': {'nullable': nullable, 'ordinal_position': ordinal_position, 'physical_type': physical_type,
   'source_column': source_column, 'source_system': source_system, 'source_table': source_table}})::VARCHAR
 ELSE to_json({'evidence_references': list_sort(evidence_references),
  'policy_reason': 'This column may not be shown to a language model.', 'privacy_class': privacy_class, 'prompt_eligible': false})::VARCHAR
 END AS context FROM obs o LEFT JOIN grouped USING (source_table, source_column)),
ctxf AS (SELECT *, sha256(context) AS context_fingerprint FROM ctx)"""


@query(obs_query("SELECT source_table, source_column, prompt_eligible, context, context_fingerprint FROM ctxf", _CONTEXTS))
def doc_contexts(spark, sf_dir):
    """Context and fingerprint of every attribute."""
    return contexts(spark, sf_dir).select(*KEYS, "prompt_eligible", "context", "context_fingerprint")


@query(obs_query(f"SELECT source_table, source_column, sha256('{PROMPT}' || chr(10) || chr(10) || 'BEGIN UNTRUSTED SOURCE CONTEXT' || chr(10) || "
                 "context || chr(10) || 'END UNTRUSTED SOURCE CONTEXT') AS prompt_hash FROM ctxf WHERE prompt_eligible", _CONTEXTS))
def doc_prompts(spark, sf_dir):
    """Prompt text of every eligible attribute (its hash)."""
    return D.prompts(contexts(spark, sf_dir), PROMPT).select(*KEYS, F.sha2("prompt", 256).alias("prompt_hash"))


# Raw model responses in every shape, one per conversation turn / event, as text both engines build alike.
_ERRORS = ("Rate limit reached", "Error 503 upstream", "JSON schema mismatch", "deadline exceeded", "Forbidden by policy",
           "Max tokens exceeded", "something odd", "endpoint not supported for batch inference", "Bad Request")
_FULL = ("concat('{\"generation_status\":\"', s, '\",\"column_description\":', d, ',\"glossary_term\":', g, ',\"glossary_definition\":', d, "
         "',\"glossary_concept_id\":null,\"resolution_reason\":\"', why, '\",\"assumptions\":[\"a', event_id % 3, '\"],\"contradictions\":[]}')")
_RAW_SHAPES = f"""CASE event_id % 8 WHEN 0 THEN NULL
 WHEN 1 THEN concat('{{"errorMessage":"', CASE event_id % 9 {' '.join(f"WHEN {i} THEN {sql_text(e)}" for i, e in enumerate(_ERRORS))} END, ' #', event_id % 40, '","response":null}}')
 WHEN 2 THEN '{{"errorMessage":null,"response":null}}' WHEN 3 THEN '{{"result":null}}' WHEN 4 THEN '{{"content":"text"}}'
 WHEN 5 THEN concat('{{"errorMessage":null,"response":', {_FULL}, '}}') WHEN 6 THEN concat('{{"result":', {_FULL}, '}}') ELSE {_FULL} END"""
_PART_COLUMNS = (
    "event_id", "event_type", "user_id", "CASE WHEN event_id % 11 < 6 THEN 'PROPOSED' ELSE 'UNRESOLVED' END AS s",
    """CASE WHEN event_id % 11 IN (0, 1, 2, 3, 8) THEN '"Text of the column"' WHEN event_id % 11 = 4 THEN '"  "' ELSE 'null' END AS d""",
    """CASE WHEN event_id % 11 IN (0, 1, 2, 3, 9) THEN concat('"Term ', user_id, '"') ELSE 'null' END AS g""",
    "CASE WHEN event_id % 13 = 5 THEN '   ' ELSE 'clear evidence' END AS why")
_PARTS = f"SELECT {', '.join(_PART_COLUMNS)} FROM events"


def _responses(spark, sf_dir):
    """Raw responses as the relation a model job would have left behind."""
    def made():
        parts = table(spark, sf_dir, "events").selectExpr(*_PART_COLUMNS)
        return parts.selectExpr("concat(event_type, '_', user_id % 50) AS source_table",
                                "concat('c', event_id) AS source_column", f"{_RAW_SHAPES} AS raw_response")
    return once(spark, sf_dir, "responses", made)


_NORMAL = f"""WITH raw AS (SELECT event_type || '_' || (user_id % 50) AS source_table, 'c' || event_id AS source_column, event_id % 8 AS shape,
  event_id, {_RAW_SHAPES} AS r, s, d, g, why FROM ({_PARTS})),
err AS (SELECT *, CASE WHEN shape = 1 THEN r::JSON->>'errorMessage' END AS e FROM raw),
coded AS (SELECT *, CASE WHEN e IS NULL THEN NULL
  {' '.join('WHEN ' + ' OR '.join(f"contains(lower(e), {sql_text(m)})" for m in ms) + f" THEN '{c}'" for c, ms in D.ERROR_CODES)}
  ELSE '{D.DEFAULT_ERROR}' END AS code FROM err),
norm AS (SELECT *, CASE shape WHEN 0 THEN 'NULL_MODEL_RESULT' WHEN 1 THEN code WHEN 2 THEN 'NULL_RESPONSE_PAYLOAD' WHEN 3 THEN 'NULL_RESULT_PAYLOAD'
   WHEN 4 THEN 'UNEXPECTED_RESPONSE_SHAPE' ELSE 'OK' END AS response_status,
  CASE shape WHEN 0 THEN 'NULL_MODEL_RESULT' WHEN 1 THEN code || ':' || sha256(e)[1:12] WHEN 2 THEN 'NULL_RESPONSE_PAYLOAD'
   WHEN 3 THEN 'NULL_RESULT_PAYLOAD' WHEN 4 THEN 'UNEXPECTED_RESPONSE_SHAPE' END AS diagnostic,
  CASE WHEN shape > 4 THEN s END AS generation_status, CASE WHEN shape > 4 AND d <> 'null' THEN trim(d, '"') END AS column_description,
  CASE WHEN shape > 4 AND g <> 'null' THEN trim(g, '"') END AS glossary_term, CASE WHEN shape > 4 THEN why END AS resolution_reason FROM coded)"""


@query(_NORMAL + " SELECT source_table, source_column, response_status, diagnostic, generation_status, column_description, glossary_term, "
       "resolution_reason FROM norm")
def doc_responses(spark, sf_dir):
    """Status, diagnostic and fields of every raw response."""
    return D.normalize_responses(_responses(spark, sf_dir)).select(
        *KEYS, "response_status", "diagnostic", "generation_status", "column_description", "glossary_term", "resolution_reason")


@query(_NORMAL + """, f AS (SELECT diagnostic, source_table || '.' || source_column AS name,
  row_number() OVER (PARTITION BY diagnostic ORDER BY source_table || '.' || source_column) AS p FROM norm WHERE response_status <> 'OK')
SELECT diagnostic, count(*) AS failures, string_agg(CASE WHEN p <= 5 THEN name END, ', ' ORDER BY name) AS samples,
 greatest(count(*) - 5, 0) AS omitted FROM f GROUP BY diagnostic""")
def doc_failures(spark, sf_dir):
    """Failures per diagnostic with a bounded sample."""
    return D.failure_summary(D.normalize_responses(_responses(spark, sf_dir)))


_CONSISTENT = _NORMAL + f""", flag AS (SELECT *, trim(why) = '' AS x1, s = 'PROPOSED' AND (trim(coalesce(column_description, '')) = '' OR trim(coalesce(glossary_term, '')) = '') AS x2,
  s = 'UNRESOLVED' AND (column_description IS NOT NULL OR glossary_term IS NOT NULL) AS x3 FROM norm WHERE response_status = 'OK'),
done AS (SELECT source_table, source_column, CASE WHEN x1 OR x2 OR x3 THEN 'UNRESOLVED' ELSE s END AS generation_status,
 CASE WHEN NOT (x1 OR x2 OR x3) THEN column_description END AS column_description, CASE WHEN NOT (x1 OR x2 OR x3) THEN glossary_term END AS glossary_term,
 CASE WHEN (x1 OR x2 OR x3) AND x1 THEN '{D.INCONSISTENT}' ELSE why END AS resolution_reason,
 concat_ws('|', CASE WHEN x1 THEN '{D.NO_REASON}' END, CASE WHEN x2 THEN '{D.INCOMPLETE}' END, CASE WHEN x3 THEN '{D.UNWANTED}' END) AS contradictions FROM flag)"""


@query(_CONSISTENT + " SELECT * FROM done")
def doc_consistency(spark, sf_dir):
    """Contradictory outputs downgraded."""
    ok = D.normalize_responses(_responses(spark, sf_dir)).where("response_status = 'OK'")
    return D.consistent(ok).select(*KEYS, "generation_status", "column_description", "glossary_term", "resolution_reason",
                                   F.array_join("contradictions", "|").alias("contradictions"))


def _outputs(spark, sf_dir):
    """A model output for every INTERNAL attribute, varying with its name and position."""
    n = F.length("source_column") + F.col("ordinal_position")
    proposed = n % 3 != 0
    term = F.when(proposed, F.concat(F.lit("Term "), F.col("proposed_business_name")))
    return observations(spark, sf_dir).where("privacy_class = 'INTERNAL'").select(
        *KEYS, F.when(proposed, "PROPOSED").otherwise("UNRESOLVED").alias("generation_status"),
        F.when(proposed & (n % 7 != 0), F.concat(F.lit("Column "), F.col("source_column"))).alias("column_description"),
        term.alias("glossary_term"), term.alias("glossary_definition"), F.lit(None).cast("string").alias("glossary_concept_id"),
        F.when(n % 5 == 0, " ").otherwise("from context").alias("resolution_reason"),
        F.array().cast("array<string>").alias("assumptions"), F.array().cast("array<string>").alias("contradictions"))


def documentation(spark, sf_dir):
    """Planned anew for each reader: two hashes a row are most of its bytes, and most readers need neither."""
    return D.recommendations(contexts(spark, sf_dir), _outputs(spark, sf_dir), ENDPOINT, created())


_RECOMMEND = _CONTEXTS + f""",
outp AS (SELECT *, length(source_column) + ordinal_position AS n FROM ctxf),
judged AS (SELECT *, n % 3 <> 0 AS prop, n % 5 = 0 OR (n % 3 <> 0 AND n % 7 = 0) AS bad FROM outp),
docs AS (SELECT schema_version, 'si_doc_' || sha256(run_id || '|' || source_table || '|' || source_column || '|' || context_fingerprint || '|1.0.1|{ENDPOINT}')[1:32] AS recommendation_id,
 run_id, artifact_version, engagement_id, source_system, source_table, source_column, context_fingerprint, list_sort(evidence_references) AS evidence_references,
 CASE WHEN prompt_eligible AND prop AND NOT bad THEN 'PROPOSED' ELSE 'UNRESOLVED' END AS generation_status,
 CASE WHEN prompt_eligible AND prop AND NOT bad THEN 'Column ' || source_column END AS proposed_column_description,
 CASE WHEN prompt_eligible AND prop AND NOT bad THEN 'Term ' || proposed_business_name END AS proposed_glossary_term,
 CASE WHEN prompt_eligible AND prop AND NOT bad THEN 'Term ' || proposed_business_name END AS proposed_glossary_definition,
 NULL::VARCHAR AS proposed_glossary_concept_id,
 CASE WHEN NOT prompt_eligible THEN '{D.BLOCKED_REASON}' WHEN n % 5 = 0 THEN '{D.INCONSISTENT}' ELSE 'from context' END AS resolution_reason,
 CASE WHEN NOT prompt_eligible THEN '' ELSE concat_ws('|', CASE WHEN n % 5 = 0 THEN '{D.NO_REASON}' END,
  CASE WHEN prop AND n % 7 = 0 THEN '{D.INCOMPLETE}' END) END AS contradictions, '' AS assumptions,
 '1.0.1' AS prompt_version, '{ENDPOINT}' AS model_endpoint, 'PROPOSED' AS approval_state, 'DOMAIN_STEWARD' AS reviewer_role, privacy_class
 FROM judged)"""


@query(obs_query("SELECT * EXCLUDE (privacy_class, evidence_references), array_to_string(evidence_references, ';') AS evidence_references FROM docs", _RECOMMEND))
def doc_recommendations(spark, sf_dir):
    """One recommendation per attribute, private ones unresolved."""
    return documentation(spark, sf_dir).drop("created_at").withColumns({
        "evidence_references": F.array_join("evidence_references", ";"), "assumptions": F.array_join("assumptions", "|"),
        "contradictions": F.array_join("contradictions", "|")})


# ---------------------------------------------------------------- review queue
_QUEUE_COLUMNS = ", ".join(c for c in W.QUEUE_COLUMNS if c != "queued_at")
_ATTRIBUTE_QUEUE = f"""aq AS (SELECT schema_version, run_id || ':' || source_table || ':' || source_column AS queue_item_id, run_id, artifact_version,
 engagement_id, source_table, source_column, proposed_business_name, domain, ontology_concept_id, key_role, confidence_score, evidence_coverage,
 privacy_class, w.t AS review_trigger, w.r AS review_reason, w.p AS review_priority, w.o AS recommended_reviewer_role, 'OPEN' AS queue_status,
 assumptions, open_question FROM (SELECT *, {ROUTE_SQL} AS w FROM obs) WHERE w IS NOT NULL)"""
_QUEUE = _RECOMMEND + "," + _ATTRIBUTE_QUEUE + f""",
dq AS (SELECT d.schema_version, d.run_id || ':' || d.source_table || ':' || d.source_column || ':source_documentation' AS queue_item_id, d.run_id,
 d.artifact_version, d.engagement_id, d.source_table, d.source_column, coalesce(nullif(proposed_glossary_term, ''), o.proposed_business_name) AS proposed_business_name,
 o.domain, proposed_glossary_concept_id AS ontology_concept_id, o.key_role, o.confidence_score, o.evidence_coverage, o.privacy_class,
 'SOURCE_DOCUMENTATION' AS review_trigger, '{W.DOCUMENTATION_REASON}' AS review_reason,
 CASE WHEN generation_status = 'UNRESOLVED' THEN 'HIGH' ELSE 'MEDIUM' END AS review_priority, 'DOMAIN_STEWARD' AS recommended_reviewer_role,
 'OPEN' AS queue_status, to_json({{'column_description': proposed_column_description, 'context_fingerprint': context_fingerprint,
  'generation_status': generation_status, 'glossary_concept_id': proposed_glossary_concept_id, 'glossary_definition': proposed_glossary_definition,
  'glossary_term': proposed_glossary_term}})::VARCHAR AS assumptions, resolution_reason AS open_question
 FROM docs d JOIN obs o USING (source_table, source_column)),
queue AS (SELECT * FROM aq UNION ALL SELECT * FROM dq)"""


@query(obs_query(f"SELECT {_QUEUE_COLUMNS} FROM aq", _ATTRIBUTE_QUEUE))
def attribute_queue(spark, sf_dir):
    """Queue rows of routed attributes."""
    return W.attribute_queue(observed(spark, sf_dir), created()).drop("queued_at")


@query(obs_query(f"SELECT {_QUEUE_COLUMNS} FROM dq", _QUEUE))
def documentation_queue(spark, sf_dir):
    """Queue rows of documentation recommendations."""
    return W.documentation_queue(documentation(spark, sf_dir), observations(spark, sf_dir), created()).drop("queued_at")


@query(obs_query("SELECT source_table, source_column, 1::BIGINT AS attributes, 0::BIGINT AS recommendations FROM obs WHERE ordinal_position = 5 AND starts_with(source_column, 'FLD7')"))
def queue_completeness(spark, sf_dir):
    """Attributes whose recommendation is absent."""
    docs = documentation(spark, sf_dir).where("NOT source_column LIKE 'FLD7%'")
    return W.unmatched_recommendations(observations(spark, sf_dir), docs)


def _queue_plan(spark, sf_dir):
    return W.review_queue(observations(spark, sf_dir), documentation(spark, sf_dir), created())


def queue(spark, sf_dir):
    return once(spark, sf_dir, "queue", lambda: _queue_plan(spark, sf_dir))


def queued(spark, sf_dir):
    """The queue for a query that reads it once: as written, if the session has it, else its plan."""
    rows = if_written(spark, sf_dir, "queue")
    return _queue_plan(spark, sf_dir) if rows is None else rows


@query(obs_query(f"SELECT {_QUEUE_COLUMNS} FROM queue", _QUEUE))
def review_queue(spark, sf_dir):
    """The whole queue."""
    return queued(spark, sf_dir).drop("queued_at")


def _events(spark, sf_dir):
    """A decision event for most queue items, some of them invalid, some items twice."""
    n = F.col("n")
    base = queue(spark, sf_dir).select(
        "queue_item_id", "recommended_reviewer_role", (F.length("queue_item_id") + F.length("review_reason")).alias("n"))
    first = base.where(n % 9 != 0).select(
        "queue_item_id", F.when(n % 10 == 1, "SPONSOR").otherwise(F.col("recommended_reviewer_role")).alias("reviewer_role"),
        F.when(n % 4 == 0, "APPROVED").when(n % 4 == 1, "MODIFIED").when(n % 4 == 2, "REJECTED")
        .when(n % 8 == 3, "DEFERRED").otherwise("MAYBE").alias("reviewer_decision"),
        F.when(n % 13 == 0, " ").otherwise(" looks right ").alias("reviewer_rationale"),
        F.when(n % 3 == 0, "rebuild mapping").alias("invalidation_impact"),
        F.lit("2026-07-14 10:00:00").cast("timestamp_ntz").alias("decided_at"))
    again = first.where("reviewer_decision = 'DEFERRED'").withColumns({
        "reviewer_decision": F.lit("APPROVED"), "decided_at": F.lit("2026-07-15 10:00:00").cast("timestamp_ntz")})
    stray = base.where(n % 50 == 0).select(
        F.concat("queue_item_id", F.lit(":unknown")).alias("queue_item_id"), F.col("recommended_reviewer_role").alias("reviewer_role"),
        F.lit("APPROVED").alias("reviewer_decision"), F.lit("x").alias("reviewer_rationale"),
        F.lit(None).cast("string").alias("invalidation_impact"), F.lit("2026-07-14 10:00:00").cast("timestamp_ntz").alias("decided_at"))
    return first.unionByName(again).unionByName(stray)


_EVENTS = _QUEUE + """,
qn AS (SELECT *, length(queue_item_id) + length(review_reason) AS n FROM queue),
ev1 AS (SELECT queue_item_id, CASE WHEN n % 10 = 1 THEN 'SPONSOR' ELSE recommended_reviewer_role END AS reviewer_role,
 CASE WHEN n % 4 = 0 THEN 'APPROVED' WHEN n % 4 = 1 THEN 'MODIFIED' WHEN n % 4 = 2 THEN 'REJECTED' WHEN n % 8 = 3 THEN 'DEFERRED' ELSE 'MAYBE' END AS reviewer_decision,
 CASE WHEN n % 13 = 0 THEN ' ' ELSE ' looks right ' END AS reviewer_rationale, CASE WHEN n % 3 = 0 THEN 'rebuild mapping' END AS invalidation_impact,
 TIMESTAMP '2026-07-14 10:00:00' AS decided_at FROM qn WHERE n % 9 <> 0),
ev AS (SELECT * FROM ev1 UNION ALL SELECT queue_item_id, reviewer_role, 'APPROVED', reviewer_rationale, invalidation_impact, TIMESTAMP '2026-07-15 10:00:00'
  FROM ev1 WHERE reviewer_decision = 'DEFERRED'
 UNION ALL SELECT queue_item_id || ':unknown', recommended_reviewer_role, 'APPROVED', 'x', NULL, TIMESTAMP '2026-07-14 10:00:00' FROM qn WHERE n % 50 = 0),
checked AS (SELECT e.*, q.* EXCLUDE (queue_item_id, n), concat_ws(',', CASE WHEN q.queue_item_id IS NULL THEN 'QUEUE_ROW_NOT_UNIQUE' END,
  CASE WHEN q.queue_item_id IS NULL THEN 'ITEM_NOT_OPEN' END,
  CASE WHEN reviewer_role IS DISTINCT FROM recommended_reviewer_role THEN 'ROLE_MISMATCH' END,
  CASE WHEN reviewer_decision = 'MAYBE' THEN 'UNSUPPORTED_DECISION' END, CASE WHEN trim(reviewer_rationale) = '' THEN 'RATIONALE_MISSING' END,
  CASE WHEN reviewer_decision = 'MODIFIED' AND invalidation_impact IS NULL THEN 'IMPACT_MISSING' END) AS errors
 FROM ev e LEFT JOIN qn q USING (queue_item_id)),
printed AS (SELECT *, sha256(to_json({'assumptions': assumptions, 'domain': domain, 'key_role': key_role, 'ontology_concept_id': ontology_concept_id,
  'open_question': open_question, 'privacy_class': privacy_class, 'proposed_business_name': proposed_business_name, 'source_column': source_column,
  'source_table': source_table})::VARCHAR) AS recommendation_fingerprint FROM checked WHERE errors = ''),
dec AS (SELECT 'decision:' || queue_item_id || ':' || sha256(recommendation_fingerprint || '|' || reviewer_decision || '|' ||
   strftime(decided_at, '%Y-%m-%dT%H:%M:%S.%f'))[1:12] AS decision_id, queue_item_id, schema_version, run_id, artifact_version, source_table, source_column,
  CASE review_trigger WHEN 'PRIVACY' THEN 'PRIVACY' WHEN 'KEY_CANDIDATE' THEN 'KEY_ROLE' WHEN 'RELATIONSHIP' THEN 'RELATIONSHIP'
   WHEN 'UNMAPPED_CONCEPT' THEN 'ONTOLOGY' WHEN 'SOURCE_DOCUMENTATION' THEN 'SOURCE_DOCUMENTATION' ELSE 'SEMANTIC_MAPPING' END AS recommendation_type,
  review_reason, recommended_reviewer_role, reviewer_role, reviewer_decision, trim(reviewer_rationale) AS reviewer_rationale,
  artifact_version AS prior_recommendation_version, recommendation_fingerprint, invalidation_impact, 'CLOSED' AS queue_status, decided_at FROM printed)"""


@query(obs_query("SELECT queue_item_id, reviewer_decision, decided_at::VARCHAR AS decided_at, errors FROM checked", _EVENTS))
def decisions_checked(spark, sf_dir):
    """Every rule each decision event breaks."""
    return W.check_decisions(_events(spark, sf_dir), queue(spark, sf_dir)).select(
        "queue_item_id", "reviewer_decision", F.col("decided_at").cast("string").alias("decided_at"), F.array_join("errors", ",").alias("errors"))


def decisions(spark, sf_dir):
    """Planned anew for each reader, from the queue as written."""
    return W.decision_records(W.check_decisions(_events(spark, sf_dir), queue(spark, sf_dir)))


@query(obs_query("SELECT * EXCLUDE (decided_at), decided_at::VARCHAR AS decided_at FROM dec", _EVENTS))
def decision_records(spark, sf_dir):
    """Records of the valid decisions."""
    return decisions(spark, sf_dir).drop("queued_at").withColumn("decided_at", F.col("decided_at").cast("string"))


@query(obs_query("SELECT queue_item_id, review_trigger FROM queue WHERE sha256(to_json({'assumptions': assumptions, 'domain': domain, 'key_role': key_role, "
                 "'ontology_concept_id': ontology_concept_id, 'open_question': open_question, 'privacy_class': privacy_class, "
                 "'proposed_business_name': proposed_business_name, 'source_column': source_column, 'source_table': source_table})::VARCHAR) "
                 "NOT IN (SELECT recommendation_fingerprint FROM dec WHERE reviewer_decision = 'REJECTED')", _EVENTS))
def suppress_rejected(spark, sf_dir):
    """Queue rows that were not rejected unchanged before."""
    return W.suppress_rejected(queue(spark, sf_dir), decisions(spark, sf_dir)).select("queue_item_id", "review_trigger")


# ---------------------------------------------------------------- gate and publication
def _objects(spark, sf_dir):
    return once(spark, sf_dir, "objects", lambda: build.object_observations(observed(spark, sf_dir), RUN, created()))


def _relationships(spark, sf_dir):
    return once(spark, sf_dir, "relationships", lambda: build.relationship_member_rows(
        members(spark, sf_dir), RUN, created()))


def _tables_in(spark, sf_dir):
    """Number of catalogue tables, one number: a run knows its configured scope."""
    return sum(table(spark, sf_dir, n).count() for n in ("orders", "customer", "part", "supplier", "nation"))


_GATE_ROWS = """tables AS (SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM part)
  + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS n),
a AS (SELECT count(*) AS rows, count_if(privacy_class = 'INTERNAL')::BIGINT AS internal, count_if(privacy_class <> 'INTERNAL')::BIGINT AS private,
 count_if(privacy_class = 'INTERNAL' AND key_role <> 'NON_KEY')::BIGINT AS keys FROM obs)"""
_ZERO = ("relationships stay proposed", "relationships go to the architect", "attributes keep references", "profiles are internal only",
         "documentation stays proposed", "documentation goes to the domain steward", "documentation keeps references",
         "documentation names the prompt version", "documentation names the endpoint", "private attributes stay undocumented",
         "no duplicate attributes", "no duplicate documentation", "scores present", "coverage present", "formula version present",
         "nothing approved automatically", "queue holds open work")


@query(obs_query(" UNION ALL ".join(
    [f"SELECT '{z}' AS check_name, 0::BIGINT AS observed, 0::BIGINT AS expected, '=' AS comparison, true AS passed" for z in _ZERO]
    + ["SELECT 'dictionary has rows', rows, 1, '>=', rows >= 1 FROM a", "SELECT 'attributes match dictionary', rows, rows, '=', true FROM a",
       "SELECT 'documentation matches dictionary', (SELECT count(*) FROM docs), rows, '=', (SELECT count(*) FROM docs) = rows FROM a",
       "SELECT 'one object per table', (SELECT count(DISTINCT source_table) FROM obs), n, '=', (SELECT count(DISTINCT source_table) FROM obs) = n FROM tables",
       "SELECT 'two profiles per internal attribute', (SELECT count(*) FROM prof), internal * 2, '=', (SELECT count(*) FROM prof) = internal * 2 FROM a",
       "SELECT 'private attributes are queued', (SELECT count(*) FROM queue WHERE recommended_reviewer_role = 'PRIVACY_STEWARD'), private, '>=', true FROM a",
       "SELECT 'documentation is queued', (SELECT count(*) FROM dq), (SELECT count(*) FROM docs), '=', true",
       "SELECT 'internal keys are queued', (SELECT count(*) FROM queue WHERE key_role <> 'NON_KEY' AND recommended_reviewer_role = 'DATA_ARCHITECT'), keys, '>=', true FROM a",
       ]), _QUEUE + "," + _GATE_ROWS))
def gate_checks(spark, sf_dir):
    """The release gate."""
    o = observations(spark, sf_dir)
    return E.gate_checks(o, o, _objects(spark, sf_dir), _profiles(spark, sf_dir), _relationships(spark, sf_dir),
                         documentation(spark, sf_dir), queued(spark, sf_dir), _tables_in(spark, sf_dir), ENDPOINT)


def _ends(digit, of=""):
    return f"right({of}source_table, 1) = '{digit}'"


# What a run is made to violate, by the last character of the table's name: (check, observed, expected, comparison).
_FAILURES = [
    ("dictionary has rows", "0", "1", ">="), ("attributes match dictionary", "(SELECT count(*) FROM att)", "0", "="),
    ("documentation matches dictionary", "(SELECT count(*) FROM doc)", "0", "="),
    ("one object per table", f"(SELECT count(DISTINCT source_table) FROM obs WHERE NOT {_ends(8)})", "(SELECT n FROM tables)", "="),
    ("two profiles per internal attribute", f"(SELECT count(*) FROM prof WHERE NOT {_ends(9)})",
     "(SELECT 2 * count_if(privacy_class = 'INTERNAL') FROM att)", "="),
    ("relationships stay proposed", f"(SELECT count(*) FROM members WHERE {_ends(2)})", "0", "="),
    ("relationships go to the architect", f"(SELECT count(*) FROM members WHERE {_ends(3)})", "0", "="),
    ("attributes keep references", f"(SELECT count(*) FROM obs WHERE {_ends(1)})", "0", "="),
    ("profiles are internal only", f"(SELECT count(*) FROM prof WHERE {_ends(1)})", "0", "="),
    ("documentation stays proposed", f"(SELECT count(*) FROM docs WHERE {_ends(1)})", "0", "="),
    ("documentation goes to the domain steward", f"(SELECT count(*) FROM docs WHERE {_ends(2)})", "0", "="),
    ("documentation keeps references", f"(SELECT count(*) FROM docs WHERE {_ends(3)})", "0", "="),
    ("documentation names the prompt version", f"(SELECT count(*) FROM docs WHERE {_ends(4)})", "0", "="),
    ("documentation names the endpoint", f"(SELECT count(*) FROM docs WHERE {_ends(5)})", "0", "="),
    ("private attributes stay undocumented",
     f"(SELECT count(*) FROM docs d JOIN obs o USING (source_table, source_column) WHERE o.privacy_class <> 'INTERNAL' AND {_ends(7)})", "0", "="),
    ("private attributes are queued", f"(SELECT count(*) FROM queue WHERE recommended_reviewer_role = 'PRIVACY_STEWARD' AND NOT {_ends(2)})",
     "(SELECT count_if(privacy_class <> 'INTERNAL') FROM att)", ">="),
    ("documentation is queued", f"(SELECT count(*) FROM dq WHERE NOT {_ends(2)})", "(SELECT count(*) FROM doc)", "="),
    ("no duplicate attributes", f"(SELECT count(*) FROM obs WHERE {_ends(6)})", "0", "="),
    ("no duplicate documentation", f"(SELECT count(*) FROM docs WHERE {_ends(6)})", "0", "="),
    ("scores present", f"(SELECT count(*) FROM obs WHERE {_ends(2)})", "0", "="),
    ("coverage present", f"(SELECT count(*) FROM obs WHERE {_ends(3)})", "0", "="),
    ("formula version present", f"(SELECT count(*) FROM obs WHERE {_ends(4)})", "0", "="),
    ("nothing approved automatically", f"(SELECT count(*) FROM obs WHERE {_ends(5)})", "0", "="),
    ("queue holds open work", f"(SELECT count(*) FROM queue WHERE {_ends(1)})", "0", "="),
    ("internal keys are queued", f"(SELECT count(*) FROM queue WHERE key_role <> 'NON_KEY' AND recommended_reviewer_role = 'DATA_ARCHITECT' AND NOT {_ends(2)})",
     "(SELECT count_if(privacy_class = 'INTERNAL' AND key_role <> 'NON_KEY') FROM att)", ">="),
]
_FAILING = members_sql()[len(KEYS_SQL):] + f""",
tables AS (SELECT count(DISTINCT source_table) AS n FROM obs),
att AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE {_ends(6)}), doc AS (SELECT * FROM docs UNION ALL SELECT * FROM docs WHERE {_ends(6)})"""


@query(obs_query("SELECT check_name, observed, expected, comparison, CASE comparison WHEN '=' THEN observed = expected ELSE observed >= expected END AS passed FROM ("
                 + " UNION ALL ".join(f"SELECT '{n}' AS check_name, {o}::BIGINT AS observed, {e}::BIGINT AS expected, '{c}' AS comparison"
                                      for n, o, e, c in _FAILURES) + ")", _QUEUE + _FAILING))
def gate_failures(spark, sf_dir):
    """The release gate on a run that violates every check in some tables."""
    last = F.right("source_table", F.lit(1))

    def spoiled(frame, rules):
        return frame.withColumns({c: F.when(last == d, v).otherwise(F.col(c)) for c, d, v in rules})

    def doubled(frame):
        return frame.unionByName(frame.where(last == "6"))

    nothing = lambda kind: F.lit(None).cast(kind)
    no_refs = F.array().cast("array<string>")
    o = observations(spark, sf_dir)
    attributes = doubled(spoiled(o, [("evidence_references", "1", no_refs), ("confidence_score", "2", nothing("double")),
                                     ("evidence_coverage", "3", nothing("double")), ("formula_version", "4", nothing("string")),
                                     ("approval_state", "5", F.lit("APPROVED"))]))
    documents = doubled(spoiled(documentation(spark, sf_dir), [
        ("approval_state", "1", F.lit("APPROVED")), ("reviewer_role", "2", F.lit("DATA_ARCHITECT")), ("evidence_references", "3", no_refs),
        ("prompt_version", "4", nothing("string")), ("model_endpoint", "5", F.lit("another")), ("generation_status", "7", F.lit("PROPOSED"))]))
    profiles = spoiled(_profiles(spark, sf_dir), [("privacy_class", "1", F.lit("PERSONAL_DATA"))]).where(last != "9")
    links = spoiled(_relationships(spark, sf_dir), [("approval_state", "2", F.lit("APPROVED")), ("reviewer_role", "3", nothing("string"))])
    items = spoiled(queued(spark, sf_dir), [("queue_status", "1", F.lit("CLOSED")), ("recommended_reviewer_role", "2", F.lit("NOBODY"))])
    tables = o.select("source_table").distinct().count()
    return E.gate_checks(o.limit(0), attributes, _objects(spark, sf_dir).where(last != "8"), profiles, links, documents, items, tables, ENDPOINT)


@query("SELECT 't' || (l_partkey % 50) AS source_table, 'c' || l_suppkey AS source_column, '1.0.' || l_linenumber AS artifact_version, count(*) AS n "
       "FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_attributes(spark, sf_dir):
    """E5: attribute rows that a retry wrote twice."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('t', l_partkey % 50) AS source_table", "concat('c', l_suppkey) AS source_column", "concat('1.0.', l_linenumber) AS artifact_version")
    return E.duplicate_attributes(rows)


@query(obs_query("""SELECT (SELECT count(DISTINCT source_table) FROM obs) AS objects_observed, (SELECT count(*) FROM obs) AS attributes_observed,
 (SELECT count(*) FROM scoredpairs) AS relationships_inferred, (SELECT count(*) FROM docs) AS documentation_recommendations,
 (SELECT count(*) FROM obs WHERE privacy_class <> 'INTERNAL') AS privacy_classifications, (SELECT count(*) FROM queue) AS review_items_created,
 (SELECT count(*) FROM obs WHERE lower(source_column) = 'loss_narrative') AS policy_violations""", _QUEUE))
def run_metrics(spark, sf_dir):
    """The seven counts of the run."""
    from catalograph.operators.privacy import prohibited_columns
    o = observations(spark, sf_dir)
    return E.run_metrics(_objects(spark, sf_dir), o, links(spark, sf_dir), documentation(spark, sf_dir),
                         queued(spark, sf_dir), prohibited_columns(o))


@query(obs_query("SELECT domain, approval_state, count(*) AS n FROM obs GROUP BY ALL"))
def distribution(spark, sf_dir):
    """Rows per domain and approval state."""
    return E.distribution(observed(spark, sf_dir))


@query(obs_query("""SELECT count(*) AS dictionary_rows, count_if(confidence_score IS NULL)::BIGINT AS null_confidence_rows, 0::BIGINT AS auto_approved_rows,
 count_if(confidence_score < 0.75)::BIGINT AS low_confidence_rows, count_if(privacy_class <> 'INTERNAL')::BIGINT AS personal_data_rows,
 count_if(relationship_evidence IS NOT NULL)::BIGINT AS relationship_rows FROM obs"""))
def validation_summary(spark, sf_dir):
    """Conditional counts of the dictionary."""
    return E.validation_summary(observed(spark, sf_dir))


@query(obs_query("SELECT source_system, source_table, count(*) AS observed_attributes FROM obs GROUP BY ALL"))
def source_scope(spark, sf_dir):
    """Attributes per table."""
    return E.source_scope(observed(spark, sf_dir))


@query(obs_query("SELECT (SELECT count(*) FROM obs) AS dictionary_rows, (SELECT count(*) FROM queue) AS review_queue_rows", _QUEUE))
def row_counts(spark, sf_dir):
    """Dictionary and queue sizes."""
    return E.row_counts(observations(spark, sf_dir), queued(spark, sf_dir))


_LATEST = _EVENTS + """,
newest AS (SELECT queue_item_id, reviewer_decision, decided_at, row_number() OVER (PARTITION BY queue_item_id ORDER BY decided_at DESC, decision_id DESC) AS rn FROM dec),
last_dec AS (SELECT * FROM newest WHERE rn = 1),
pd AS (SELECT d.source_table, d.source_column, d.proposed_column_description, d.proposed_glossary_term, d.proposed_glossary_definition,
  d.generation_status AS documentation_generation_status, CASE WHEN l.reviewer_decision = 'APPROVED' THEN 'APPROVED' ELSE 'PROPOSED' END AS documentation_review_state
  FROM docs d LEFT JOIN last_dec l ON l.queue_item_id = d.run_id || ':' || d.source_table || ':' || d.source_column || ':source_documentation'),
pa AS (SELECT o.* EXCLUDE (approval_state), coalesce(l.reviewer_decision, o.approval_state) AS approval_state FROM obs o
  LEFT JOIN last_dec l ON l.queue_item_id = o.run_id || ':' || o.source_table || ':' || o.source_column)"""
_COLUMNS = "source_table, " + ", ".join(E.DICTIONARY_COLUMNS)


@query(obs_query(f"SELECT {_COLUMNS}, 'APPROVED' AS publication_status FROM pa LEFT JOIN (SELECT * FROM pd WHERE documentation_review_state = 'APPROVED') "
                 "USING (source_table, source_column) WHERE approval_state = 'APPROVED'", _LATEST))
def publish_approved(spark, sf_dir):
    """The approved dictionary."""
    return E.publish_dictionary(observations(spark, sf_dir), documentation(spark, sf_dir), decisions(spark, sf_dir), store=written)


@query(obs_query(f"SELECT {_COLUMNS}, '{E.DRAFT_STATUS}' AS publication_status FROM pa LEFT JOIN pd USING (source_table, source_column)", _LATEST))
def publish_draft(spark, sf_dir):
    """The draft dictionary with every proposal."""
    return E.publish_dictionary(observations(spark, sf_dir), documentation(spark, sf_dir), decisions(spark, sf_dir), approved_only=False,
                                store=written)


@query(obs_query(f"SELECT 'Source Data Dictionary' AS deliverable, 'sales' AS source_system, '{RUN.run_id}' AS run_id, '1.0.0' AS artifact_version, "
                 "count(DISTINCT source_table) AS tables, count(*) AS attributes_published, 'APPROVED' AS publication_status FROM pa WHERE approval_state = 'APPROVED'", _LATEST))
def publication_overview(spark, sf_dir):
    """What was published."""
    return E.publication_overview(publish_approved(spark, sf_dir), "sales", RUN.run_id, "1.0.0")


@query(obs_query("""SELECT recommended_reviewer_role, count(*) AS items, count(reviewer_decision) AS decided, count(*) - count(reviewer_decision) AS open,
 count_if(reviewer_decision IN ('MODIFIED', 'REJECTED'))::BIGINT AS overridden,
 round(count_if(reviewer_decision IN ('MODIFIED', 'REJECTED')) / nullif(count_if(reviewer_decision IN ('APPROVED', 'MODIFIED', 'REJECTED')), 0), 6) AS override_rate,
 round(quantile_disc(epoch(decided_at - TIMESTAMP '2026-07-13 06:12:57') / 3600, 0.5), 6) AS median_turnaround_hours,
 round(count_if(q.ontology_concept_id IS NOT NULL AND reviewer_decision = 'APPROVED') / nullif(count_if(q.ontology_concept_id IS NOT NULL
  AND reviewer_decision IN ('APPROVED', 'MODIFIED', 'REJECTED')), 0), 6) AS mapping_precision,
 round(count_if(q.ontology_concept_id IS NOT NULL AND reviewer_decision = 'APPROVED') / nullif(count_if(q.ontology_concept_id IS NOT NULL
  AND reviewer_decision = 'APPROVED') + count_if(reviewer_decision = 'MODIFIED'), 0), 6) AS mapping_recall
 FROM queue q LEFT JOIN last_dec USING (queue_item_id) GROUP BY recommended_reviewer_role""", _LATEST))
def reviewer_metrics(spark, sf_dir):
    """Decided and overridden items, turnaround, and precision and recall of mappings per role."""
    return E.reviewer_metrics(queue(spark, sf_dir), decisions(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in (
        "override_rate", "median_turnaround_hours", "mapping_precision", "mapping_recall")})


# ---------------------------------------------------------------- contracts
@query("""SELECT l_orderkey, l_linenumber, 'line_item' AS contract, unnest(list_filter([
 CASE WHEN l_returnflag = 'R' THEN 'l_returnflag: enum' END, CASE WHEN l_linestatus <> 'O' THEN 'l_linestatus: const' END,
 CASE WHEN l_quantity < 2 THEN 'l_quantity: minimum' END, CASE WHEN l_quantity > 49 THEN 'l_quantity: maximum' END,
 CASE WHEN l_linenumber > 6 THEN 'ship_note: required' END, CASE WHEN l_linenumber <= 6 AND l_partkey % 10 <> 3 THEN 'ship_note: pattern' END,
 CASE WHEN l_suppkey % 4 < 1 THEN 'tags: minItems' END, CASE WHEN l_suppkey % 4 = 3 THEN 'tags: items enum' END,
 CASE WHEN l_tax > l_discount THEN 'tax within discount' END], lambda c: c IS NOT NULL)) AS constraint FROM lineitem""")
def contract_violations(spark, sf_dir):
    """Every broken constraint of every line item."""
    contract = X.Contract("line_item", {
        "l_returnflag": X.Field(enum=("A", "N")), "l_linestatus": X.Field(const="O"),
        "l_quantity": X.Field("double", minimum=2, maximum=49), "ship_note": X.Field(pattern=r"^part-\d*3$"),
        "tags": X.Field("array<string>", min_items=2, item_enum=("t0", "t1", "t2"))},
        {"tax within discount": F.col("l_tax") <= F.col("l_discount")}, closed=False)
    rows = table(spark, sf_dir, "lineitem").withColumns({
        "ship_note": F.expr("CASE WHEN l_linenumber <= 6 THEN concat('part-', l_partkey) END"),
        "tags": F.expr("slice(array('t0', 't1', 't2', 't3'), 1, cast(l_suppkey % 4 + 1 AS int))")})
    return X.violations(rows, contract, ["l_orderkey", "l_linenumber"])


@query("SELECT NULL::VARCHAR AS source_table, 'object_observation' AS contract, c || ': column is absent' AS constraint_text "
       "FROM (VALUES ('proposed_domain'), ('evidence_count')) v(c) UNION ALL SELECT 'src_cust' || c_custkey, 'object_observation', 'privacy_class: enum' "
       "FROM customer")
def object_contract(spark, sf_dir):
    """Absent columns and broken values of object rows; whole rows keep their contract."""
    rows = _objects(spark, sf_dir)
    broken = rows.where("source_table LIKE 'src_cust%'").drop("proposed_domain", "evidence_count").withColumn("privacy_class", F.lit("OPEN"))
    good = X.violations(rows, X.OBJECT_OBSERVATION, ["source_table"])
    return (X.violations(broken, X.OBJECT_OBSERVATION, ["source_table"]).union(good)
            .withColumnRenamed("constraint", "constraint_text"))


@query(obs_query("SELECT source_table, source_column, 'attribute_observation' AS contract, 'never' AS constraint FROM obs WHERE false"))
def observation_contract(spark, sf_dir):
    """The written observations keep their contract, so no row comes back."""
    return X.violations(observations(spark, sf_dir), X.ATTRIBUTE_OBSERVATION, KEYS)


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, ['OBJECT','ATTRIBUTE','RELATIONSHIP','EXTENSION_MARKER'][1 + l_partkey % 4] AS k,
 l_suppkey % 3 = 0 AS no_concept, l_linenumber % 2 = 0 AS no_attribute,
 ['MATCHED','UNRESOLVED','LIKELY_CUSTOM_EXTENSION'][1 + l_partkey % 3] AS m, ['Unresolved','Source extension','Standard'][1 + l_suppkey % 3] AS life FROM lineitem)
SELECT l_orderkey, l_linenumber, 'structure' AS contract, unnest(list_filter([
 CASE WHEN k = 'EXTENSION_MARKER' AND NOT no_concept THEN 'extension marker has no concept' END,
 CASE WHEN k <> 'EXTENSION_MARKER' AND no_concept THEN 'pattern needs a concept' END,
 CASE WHEN k = 'ATTRIBUTE' AND no_attribute THEN 'attribute pattern needs an attribute' END,
 CASE WHEN k = 'OBJECT' AND NOT no_attribute THEN 'object pattern has no attribute' END,
 CASE WHEN m = 'UNRESOLVED' AND NOT no_concept THEN 'unresolved invents nothing' END,
 CASE WHEN m = 'UNRESOLVED' AND life <> 'Unresolved' THEN 'unresolved lifecycle' END,
 CASE WHEN m = 'MATCHED' AND no_concept THEN 'matched needs pattern and concept' END,
 CASE WHEN m = 'LIKELY_CUSTOM_EXTENSION' AND life <> 'Source extension' THEN 'extension lifecycle' END], lambda c: c IS NOT NULL)) AS constraint FROM p""")
def pattern_and_match_rules(spark, sf_dir):
    """Shape rules of patterns and match assessments."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "element_at(array('OBJECT','ATTRIBUTE','RELATIONSHIP','EXTENSION_MARKER'), cast(1 + l_partkey % 4 AS int)) AS pattern_type",
        "CASE WHEN l_suppkey % 3 <> 0 THEN concat('C', l_suppkey) END AS ontology_concept_id",
        "CASE WHEN l_linenumber % 2 <> 0 THEN 'a*' END AS source_attribute_pattern", "CASE WHEN l_suppkey % 3 <> 0 THEN 'P1' END AS pattern_id",
        "element_at(array('MATCHED','UNRESOLVED','LIKELY_CUSTOM_EXTENSION'), cast(1 + l_partkey % 3 AS int)) AS match_outcome",
        "element_at(array('Unresolved','Source extension','Standard'), cast(1 + l_suppkey % 3 AS int)) AS proposed_lifecycle_state")
    contract = X.Contract("structure", {}, {**X.pattern_rules(), **X.match_assessment_rules()})
    return X.violations(rows, contract, ["l_orderkey", "l_linenumber"])


@query("""WITH c AS (SELECT o_orderkey AS context_id, o_custkey % 3 = 0 AS auth, CASE WHEN o_custkey % 5 < 3 THEN 'APPROVED' ELSE 'PROPOSED' END AS need,
  o_orderdate::DATE AS dt, o_orderstatus AS scope FROM orders),
i AS (SELECT c.*, l_linenumber, row_number() OVER (PARTITION BY context_id ORDER BY l_linenumber, l_partkey, l_suppkey)::INTEGER - 1 AS item_position, l_returnflag, l_linestatus, l_partkey, l_suppkey, l_shipdate::DATE AS ship
  FROM c JOIN lineitem ON l_orderkey = context_id)
SELECT context_id, -1 AS item_position, 'authoritative context needs approved knowledge' AS constraint FROM c
 WHERE auth AND need <> 'APPROVED' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = context_id)
UNION ALL SELECT context_id, item_position, unnest(list_filter([CASE WHEN l_linestatus <> scope THEN 'scope differs' END,
 CASE WHEN l_partkey % 4 = 0 THEN 'pack differs' END, CASE WHEN l_suppkey % 4 = 0 THEN 'version differs' END,
 CASE WHEN (CASE l_returnflag WHEN 'A' THEN 'APPROVED' ELSE 'PROPOSED' END) <> need THEN 'approval state differs' END,
 CASE WHEN NOT (ship <= dt) THEN 'not yet effective' END, CASE WHEN l_linenumber % 2 = 0 AND ship + 30 < dt THEN 'expired' END], lambda c: c IS NOT NULL)) FROM i""")
def context_rules(spark, sf_dir):
    """Rules of knowledge contexts and their items."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_shipdate"))), lambda i: F.struct(
            i["l_linestatus"].alias("scope"), F.when(i["l_partkey"] % 4 == 0, "other").otherwise("core").alias("pack_id"),
            F.when(i["l_suppkey"] % 4 == 0, "2.0.0").otherwise("1.0.0").alias("pack_version"),
            F.when(i["l_returnflag"] == "A", "APPROVED").otherwise("PROPOSED").alias("approval_state"),
            F.to_date(i["l_shipdate"]).cast("string").alias("effective_from"),
            F.when(i["l_linenumber"] % 2 == 0, F.date_add(F.to_date(i["l_shipdate"]), 30).cast("string")).alias("effective_to"))).alias("knowledge_items"))
    rows = table(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("context_id"), F.when(F.col("o_custkey") % 3 == 0, "AUTHORITATIVE").otherwise("DRAFT").alias("usage_mode"),
        F.when(F.col("o_custkey") % 5 < 3, "APPROVED").otherwise("PROPOSED").alias("required_approval_state"),
        F.to_date("o_orderdate").cast("string").alias("effective_at"), F.col("o_orderstatus").alias("scope"),
        F.lit("core").alias("pack_id"), F.lit("1.0.0").alias("pack_version"), "knowledge_items")
    return X.context_item_violations(rows)


@query(obs_query("""SELECT source_table, source_column, unnest(list_filter([CASE WHEN gone THEN 'property was removed' END,
 CASE WHEN NOT gone AND ordinal_position = 4 AND physical_type <> 'StringType()' THEN 'type changed from ' || physical_type || ' to StringType()' END,
 CASE WHEN NOT gone AND key_role = 'FOREIGN_KEY_CANDIDATE' THEN 'constant changed' END,
 CASE WHEN NOT gone AND domain <> 'Shared' THEN 'enum values were removed' END,
 CASE WHEN NOT gone AND nullable AND ordinal_position = 3 THEN 'optional property became required' END,
 CASE WHEN NOT gone AND ordinal_position = 1 THEN 'additional properties are no longer accepted' END], lambda f: f IS NOT NULL)) AS finding
 FROM (SELECT *, ordinal_position = 5 AND source_column LIKE 'FLD%3' AS gone FROM obs)"""))
def schema_changes(spark, sf_dir):
    """Breaking changes between two inventories of the catalogue."""
    o = observations(spark, sf_dir)
    old = o.select(*KEYS, F.col("physical_type").alias("field_type"), F.col("key_role").alias("const_value"),
                   F.array("domain", F.lit("Shared")).alias("enum_values"), (~F.col("nullable")).alias("required"), F.lit(False).alias("closed"))
    at = F.col("ordinal_position")
    new = o.where(~((at == 5) & F.col("source_column").like("FLD%3"))).select(
        *KEYS, F.when(at == 4, "StringType()").otherwise(F.col("physical_type")).alias("field_type"),
        F.when(F.col("key_role") == "FOREIGN_KEY_CANDIDATE", "x").otherwise(F.col("key_role")).alias("const_value"),
        F.array(F.lit("Shared"), F.lit("Extra")).alias("enum_values"), (~F.col("nullable") | (at == 3)).alias("required"), (at == 1).alias("closed"))
    return X.breaking_changes(old, new, KEYS)
