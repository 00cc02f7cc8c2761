"""The governed relations of the derived catalogue, and their SQL.

Relations that many queries read are written once per session and folder to the
shared checkpoint directory, as the build itself would write them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.operators import keys as K
from catalograph.operators.scoring import WEIGHTS
from catalograph.plans import build
from catalograph.sources.packs import load_pack
from checks.base import (BROKEN, CATALOGUE_SQL, CREATED, HYPOTHESES_SQL, NAMED_SQL, PRIVACY_SQL, RUN, catalogue,
                         concepts, if_written, once, rounded, written)

def created():
    return F.lit(CREATED).cast("timestamp_ntz")


def observations_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.completed(_inferred(spark, sf_dir), RUN, created())


def _inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.inferred_columns(catalogue(spark, sf_dir), concepts(spark), RUN, roles=roles(spark, sf_dir), store=written)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations; what differs from row to row is written, the rest is planned on it."""
    return build.completed(once(spark, sf_dir, "observations", lambda: _inferred(spark, sf_dir)), RUN, created())


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations for a query that reads them once: as written, if the session has them, else their plan.

    What the query does not read is then neither computed nor stored.
    """
    rows = if_written(spark, sf_dir, "observations")
    return observations_plan(spark, sf_dir) if rows is None else build.completed(rows, RUN, created())


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What counts per name key say about every foreign column, written once."""
    return once(spark, sf_dir, "links", lambda: K.relationship_links(roles(spark, sf_dir)))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links of all columns as the two sides of each key, written once."""
    return once(spark, sf_dir, "members", lambda: K.relationship_members(roles(spark, sf_dir)))


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes with key roles, written once: every link query reads it several times."""
    return once(spark, sf_dir, "roles", lambda: K.key_roles(catalogue(spark, sf_dir)))


_TYPES = load_pack("types")


def _like(markers) -> str:
    return "(" + " OR ".join(f"contains(physical_type, '{m}')" for m in markers) + ")"


FAMILY_SQL = "CASE " + " ".join(f"WHEN {_like(m)} THEN '{f}'" for f, m in _TYPES["families"]) + " END"
_EXPECTED = " OR ".join(
    f"(coalesce(ontology_concept_type, 'ATTRIBUTE') = '{k}' AND ({FAMILY_SQL}) IN ("
    + ",".join(f"'{f}'" for f in fams) + "))" for k, fams in _TYPES["expected"].items())
STRENGTH_SQL = (f"CASE WHEN ({FAMILY_SQL}) IS NULL THEN 0.55::DOUBLE WHEN {_EXPECTED} THEN 0.85::DOUBLE "
                f"WHEN ({FAMILY_SQL}) = 'STRING' THEN 0.55::DOUBLE ELSE 0.3::DOUBLE END")

_TOKENS = ("list_transform(list_filter(regexp_split_to_array(" + BROKEN +
           ", '[^A-Za-z0-9]+'), lambda p: p <> ''), lambda p: lower(p))")
# attrs -> roles, mk, allpairs, scoredpairs, links, evidence, strengths
ROLES_SQL = f"""
tokd AS (SELECT *, {_TOKENS.format(c='source_column')} AS toks,
  regexp_replace(array_to_string({_TOKENS.format(c='source_table')}, ' '),
    '^(?:(?:bronze|raw|source|src|stage|staging|stg)(?: |$))+', '') AS entity FROM attrs),
sigd AS (SELECT *, CASE WHEN len(toks) > 0 AND toks[-1] IN ('id','key') THEN
    CASE WHEN len(toks) >= 2 THEN toks[len(toks)-1] || ' ' || toks[-1] ELSE toks[-1] END END AS signature,
  CASE WHEN len(toks) > 1 THEN array_to_string(toks[1:len(toks)-1], ' ') ELSE '' END AS lead FROM tokd),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source_table, signature IS NULL ORDER BY
    NOT (lead = entity OR (entity <> '' AND split_part(signature, ' ', 1) = split_part(entity, ' ', -1))),
    nullable, ordinal_position, source_column) AS rn FROM sigd),
roles AS (SELECT source_table, source_column, ordinal_position, physical_type, nullable, signature,
  CASE WHEN signature IS NULL THEN 'NON_KEY' WHEN rn = 1 THEN 'PRIMARY_KEY_CANDIDATE'
       ELSE 'FOREIGN_KEY_CANDIDATE' END AS key_role FROM ranked)"""
KEYS_SQL = """
mk AS MATERIALIZED (SELECT *, lower(source_column) AS low, unnest(['S:' || signature, 'N:' || lower(source_column)]) AS match_key
  FROM roles WHERE key_role <> 'NON_KEY')"""
PAIRS_SQL = KEYS_SQL + """,
allpairs AS (SELECT f.match_key, f.source_table AS from_table, f.source_column AS from_column,
  p.source_table AS to_table, p.source_column AS to_column, f.low = p.low AS exact,
  f.signature = p.signature AS same_sig, f.physical_type = p.physical_type AS type_compatible
  FROM mk f JOIN mk p USING (match_key)
  WHERE f.key_role = 'FOREIGN_KEY_CANDIDATE' AND p.key_role = 'PRIMARY_KEY_CANDIDATE'
  AND f.source_table <> p.source_table AND (starts_with(match_key, 'S:') OR f.signature <> p.signature)),
scoredpairs AS MATERIALIZED (SELECT *, CASE WHEN exact AND type_compatible THEN 0.9::DOUBLE
  WHEN same_sig AND type_compatible THEN 0.85::DOUBLE ELSE 0.55::DOUBLE END AS confidence_score FROM allpairs),
links AS (SELECT from_table AS source_table, from_column AS source_column, count(*) AS link_count,
  min(to_table || '.' || to_column) AS first_target FROM scoredpairs GROUP BY ALL),
evidence AS (SELECT source_table, source_column, 'Inferred relationship: ' || source_table || '.' || source_column || ' -> ' || first_target
  || CASE WHEN link_count > 1 THEN ' and ' || (link_count - 1) || ' more' ELSE '' END AS relationship_evidence FROM links),
strengths AS (SELECT from_table AS source_table, from_column AS source_column, max(confidence_score) AS candidate_strength,
  bool_or(NOT type_compatible) AS candidate_conflict FROM scoredpairs GROUP BY ALL)"""

# mk -> strengths from the primaries of each key counted by type and name: no pair is written out
COUNTED_SQL = KEYS_SQL + """,
targets AS (SELECT match_key, physical_type, signature, low, min(source_table) AS first, max(source_table) AS last FROM mk
  WHERE key_role = 'PRIMARY_KEY_CANDIDATE' GROUP BY ALL),
strengths AS (SELECT f.source_table, f.source_column, max(CASE WHEN f.physical_type <> t.physical_type THEN 0.55::DOUBLE
  WHEN f.low = t.low THEN 0.9::DOUBLE WHEN f.signature = t.signature THEN 0.85::DOUBLE ELSE 0.55::DOUBLE END) AS candidate_strength,
  bool_or(f.physical_type <> t.physical_type) AS candidate_conflict FROM mk f JOIN targets t USING (match_key)
  WHERE f.key_role = 'FOREIGN_KEY_CANDIDATE' AND (t.first <> f.source_table OR t.last <> f.source_table)
  AND (starts_with(match_key, 'S:') OR f.signature <> t.signature) GROUP BY ALL)"""

# mk -> members: both sides of every key that links them; with another condition only of some links
def members_sql(also: str = "true") -> str:
    return KEYS_SQL + f""",
sides AS (SELECT match_key, key_role, physical_type, signature, min(source_table) AS low, max(source_table) AS high FROM mk GROUP BY ALL),
members AS (SELECT match_key, CASE key_role WHEN 'FOREIGN_KEY_CANDIDATE' THEN 'FROM' ELSE 'TO' END AS side,
  source_table, source_column, physical_type, signature FROM mk m WHERE EXISTS (SELECT 1 FROM sides s
  WHERE s.match_key = m.match_key AND s.key_role <> m.key_role AND (starts_with(m.match_key, 'S:') OR s.signature <> m.signature)
  AND (s.low <> m.source_table OR s.high <> m.source_table) AND {also}))"""


_TOTAL = repr(sum(WEIGHTS.values()))
_W = {k: f"{v!r}::DOUBLE" for k, v in WEIGHTS.items()}
_RAW = (f"(0::DOUBLE + CASE WHEN nc THEN 0::DOUBLE ELSE naming_strength * {_W['naming_strength']} END"
        f" + type_strength * {_W['type_strength']}"
        f" + CASE WHEN conflict THEN 0::DOUBLE ELSE relationship_strength * {_W['relationship_strength']} END)")
_AVAIL = (f"(0::DOUBLE + CASE WHEN nc THEN 0::DOUBLE ELSE {_W['naming_strength']} END + {_W['type_strength']}"
          f" + CASE WHEN conflict THEN 0::DOUBLE ELSE {_W['relationship_strength']} END)")
_P = RUN.packs


def _refs(pack: dict, rule: str) -> str:
    stem = f"{pack['pack_id']}:{pack['pack_version']}"
    return f"'rule:{stem}:' || {rule}"


def _selection(pack: dict) -> str:
    stem = f"{pack['pack_id']}:{pack['pack_version']}"
    return f"'pack_selection:{stem}:source={RUN.source_system}:convention=' || naming_convention || ':as_of=AUTO'"


REFERENCES_SQL = f"""list_sort(list_distinct(list_concat(
  list_transform(list_filter(string_split(n.rule_ids, ','), lambda r: r <> ''), lambda r: {_refs(_P['naming'], 'r')}),
  [{_refs(_P['naming'], "'" + _P['naming']['match_rule_id'] + "'")}, {_selection(_P['naming'])},
   {_refs(_P['privacy'], 'privacy_rule_id')}, {_selection(_P['privacy'])},
   {_refs(_P['types'], "'" + _P['types']['rule_id'] + "'")}, {_selection(_P['types'])}])))"""

# everything up to obs(...), the attribute observations with references as a list
OBS_SQL = f"""{CATALOGUE_SQL}, names AS (SELECT DISTINCT source_column FROM attrs), {HYPOTHESES_SQL}, {NAMED_SQL},
{PRIVACY_SQL}, {ROLES_SQL}, {PAIRS_SQL},
pre_score AS (SELECT r.*, n.* EXCLUDE (source_column, rule_ids), relationship_evidence, privacy_class, privacy_rationale,
  {REFERENCES_SQL} AS rule_refs,
  naming_contradictions IS NOT NULL AS nc, coalesce(candidate_conflict, false) AS conflict,
  {STRENGTH_SQL} AS type_strength,
  coalesce(candidate_strength, CASE WHEN signature IS NOT NULL THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END) AS relationship_strength
  FROM roles r JOIN named n USING (source_column) JOIN private USING (source_column)
  LEFT JOIN evidence USING (source_table, source_column) LEFT JOIN strengths USING (source_table, source_column)),
pre_round AS (SELECT *, {_RAW} / {_AVAIL} AS x_score, {_AVAIL} / {_TOTAL}::DOUBLE AS x_cov FROM pre_score),
obs AS (SELECT '1.0.0' AS schema_version, '{RUN.run_id}' AS run_id, '1.0.0' AS artifact_version,
  '{RUN.engagement_id}' AS engagement_id, '{RUN.source_system}' AS source_system, source_table, source_column,
  ordinal_position, physical_type, nullable, key_role, relationship_evidence, proposed_business_name,
  ontology_concept_id, domain, 'INFERRED' AS observed_or_inferred,
  list_concat(['catalog_metadata:main.bronze.' || source_table || '.' || source_column], rule_refs) AS evidence_references,
  {rounded('x_score')} AS confidence_score, {rounded('x_cov')} AS evidence_coverage,
  naming_reason || '; ' || CASE WHEN x_cov < 0.6::DOUBLE
    THEN 'Evidence coverage ' || printf('%.2f', x_cov) || ' is under 0.6; a person has to look'
    ELSE 'Made of ' || (3 - nc::INT - conflict::INT) || ' known components' ||
      CASE WHEN nc OR conflict THEN '; ' || (nc::INT + conflict::INT) || ' in dispute' ELSE '' END
    END AS confidence_reason,
  '1.0.0' AS formula_version,
  CASE WHEN ontology_concept_id IS NULL THEN 'The rules found no meaning; map it to a listed concept or ask a steward.' END AS assumptions,
  nullif(concat_ws('; ', naming_contradictions, CASE WHEN conflict THEN 'The types of the two columns do not fit together.' END), '') AS contradictions,
  CASE WHEN nc THEN 'Which of the listed concepts does the name mean, if any?'
    WHEN {rounded('x_score')} < 0.75::DOUBLE THEN 'Does this meaning hold?' END AS open_question,
  privacy_class, privacy_rationale, 'PROPOSED' AS approval_state, NULL::VARCHAR AS reviewer_role,
  NULL::VARCHAR AS review_rationale, TIMESTAMP '{CREATED}' AS created_at,
  naming_strength, type_strength, relationship_strength, nc, conflict
  FROM pre_round)"""


def obs_query(select: str, more: str = "") -> str:
    return f"WITH RECURSIVE {OBS_SQL}{',' + more if more else ''} {select}"
