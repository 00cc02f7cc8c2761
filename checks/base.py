"""A column catalogue derived from the given tables, in Spark and in SQL.

Orders, customers, parts, suppliers and nations each become a "table" with a
handful of columns, so the catalogue has several attribute rows per data row
and grows with the data. Names cover key links, abbreviations, ambiguous and
private columns, and unknown codes.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions import shared
from catalograph.functions.skew import spread
from catalograph.operators.privacy import LIMIT_CLASS, LIMIT_RATIONALE, LIMIT_RULE
from catalograph.plans.build import RunContext
from catalograph.sources.packs import concept_frame, load_pack, token_pattern

CREATED = "2026-07-13 06:12:57"
RUN = RunContext(run_id="si_20260713T061257Z", source_system="sales", engagement_id="demo")

# Names the derived columns take by row key: (name, type, nullable).
VOCABULARY = (
    ("POLNBR", "StringType()", False), ("CLMSTS", "StringType()", True), ("EFFDT", "DateType()", False),
    ("EXPAMT", "DecimalType(12,2)", True), ("FLD007", "StringType()", True),
    ("policyEffectiveDate", "DateType()", False), ("gross_earned", "DoubleType()", True),
    ("PLCY_NO", "LongType()", False), ("contact_channel", "StringType()", True),
    ("email_address", "StringType()", True), ("loss_narrative", "StringType()", True),
    ("date_of_birth", "DateType()", True), ("claimed_amount", "DecimalType(12,2)", True),
    ("risk_address", "StringType()", True), ("written_premium_amt", "DoubleType()", True),
    ("source_updated_ts", "TimestampType()", False), ("is_active_flag", "BooleanType()", True),
    ("bank_acct_nbr", "StringType()", True), ("loss-date", "TimestampNTZType()", True),
    ("VIN", "StringType()", True), ("cov lmt amt", "BooleanType()", True),
    ("EXPEXPEXPEXP", "StringType()", True), ("prem_total", "DoubleType()", True),
    ("total_reserve_outstanding_x", "IntegerType()", True),
)
N = len(VOCABULARY)


def registry():
    """(queries, their SQL, the decorator that registers a function with its SQL)."""
    queries, oracles = {}, {}

    def query(sql: str | None):
        def keep(function):
            queries[function.__name__] = function
            if sql:
                oracles[function.__name__] = sql
            return function
        return keep

    return queries, oracles, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def concepts(spark: SparkSession) -> DataFrame:
    return concept_frame(spark, load_pack("concepts"))


def _attribute(name, ordinal, kind, nullable):
    lit = lambda v: F.lit(v) if not hasattr(v, "alias") else v
    return F.struct(lit(name).alias("source_column"), F.lit(ordinal).alias("ordinal_position"),
                    lit(kind).alias("physical_type"), lit(nullable).alias("nullable"))


_WORDS = "array(" + ", ".join(
    f"named_struct('source_column', '{n}', 'physical_type', '{t}', 'nullable', {str(b).lower()})"
    for n, t, b in VOCABULARY) + ")"


def _from_vocabulary(index: str, ordinal: int):
    word = f"element_at({_WORDS}, cast({index} as int) + 1)"
    return F.expr(f"named_struct('source_column', {word}.source_column, 'ordinal_position', {ordinal}, "
                  f"'physical_type', {word}.physical_type, 'nullable', {word}.nullable)")


def _entity(prefix, key):
    return F.concat(F.lit(prefix), key.cast("string"))


def written(frame: DataFrame, name: str) -> DataFrame:
    """``shared.written``; a test session inside one process gets a folder of its own if it names none."""
    spark = frame.sparkSession
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catalograph-checks-"))
    return shared.written(frame, name)


_WRITTEN: dict[tuple, DataFrame] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A relation written on first use of this session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = written(make(), name)
    return _WRITTEN[key]


def if_written(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """A relation that this session has written before, else None."""
    return _WRITTEN.get((spark.sparkContext.applicationId, sf_dir, name))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived catalogue, written once: the source relation of the queries on it.

    Its names take few bytes and much work, so its files are dealt by table: written as the inputs
    are split, nearly all rows would lie in the few files that come from the orders.
    """
    return once(spark, sf_dir, "catalogue", lambda: spread(catalogue_plan(spark, sf_dir), "source_table"))


def catalogue_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute rows: source_table, source_column, ordinal_position, physical_type, nullable."""
    c = F.col
    ok, ck = c("o_orderkey"), c("o_custkey")
    cust = _entity("cust", ck)
    orders = table(spark, sf_dir, "orders").select(_entity("stg_ord", ok).alias("source_table"), F.inline(F.array(
        _attribute(F.concat(_entity("ord", ok), F.lit("_id")), 1, "LongType()", False),
        _attribute(F.when(c("o_orderstatus") == "O", F.concat(cust, F.lit("_id")))
                   .when(c("o_orderstatus") == "F", F.concat(F.lit("bill_to_"), cust, F.lit("_id")))
                   .otherwise(F.concat(_entity("Cust", ck), F.lit("Id"))), 2,
                   F.when(c("o_orderpriority") == "1-URGENT", "StringType()").otherwise("LongType()"), True),
        _from_vocabulary(f"o_orderkey % {N}", 3),
        _from_vocabulary(f"(o_orderkey % {N} + 1 + o_custkey % {N - 1}) % {N}", 4),
        _attribute(_entity("FLD", ck % 1000), 5, "StringType()", True))))
    key = c("c_custkey")
    customers = table(spark, sf_dir, "customer").select(_entity("src_cust", key).alias("source_table"), F.inline(F.array(
        _attribute(F.concat(_entity("cust", key), F.lit("_id")), 1, "LongType()", False),
        _attribute(F.concat(_entity("nation", c("c_nationkey")), F.lit("_key")), 2, "IntegerType()", True),
        _from_vocabulary(f"c_custkey % {N}", 3),
        _attribute(F.when(key % 10 == 0, "id").otherwise("mkt_segment_cd"), 4, "StringType()", True))))
    part = c("p_partkey")
    parts = table(spark, sf_dir, "part").select(_entity("part", part).alias("source_table"), F.inline(F.array(
        _attribute("id", 1, F.when(c("p_size") > 25, "LongType()").otherwise("StringType()"), False),
        _attribute(F.replace(c("p_name"), F.lit(" "), F.lit("_")), 2, "DoubleType()", True),
        _attribute(F.concat(F.replace(c("p_brand"), F.lit("#"), F.lit("_")), F.lit("Amt")), 3, "StringType()", True),
        _from_vocabulary(f"p_partkey % {N}", 4))))
    supplier = c("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        _entity("staging_supp", supplier).alias("source_table"), F.inline(F.array(
            _attribute(F.concat(_entity("supp", supplier), F.lit("_key")), 1, "LongType()", False),
            _attribute(F.concat(_entity("nation", c("s_nationkey")), F.lit("_key")), 2, "StringType()", True))))
    nation = c("n_nationkey")
    nations = table(spark, sf_dir, "nation").select(_entity("ref_nation", nation).alias("source_table"), F.inline(F.array(
        _attribute(F.concat(_entity("nation", nation), F.lit("_key")), 1, "IntegerType()", False),
        _attribute("display_name", 2, "StringType()", False))))
    out = orders
    for frame in (customers, parts, suppliers, nations):
        out = out.unionByName(frame)
    return out


def sql_text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + value.replace("'", "''") + "'"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ",\n".join("(" + ",".join(sql_text(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


_VOCAB_SQL = values("vocab", "k,n,t,b", [(i, *w) for i, w in enumerate(VOCABULARY)])

# attrs(source_table, source_column, ordinal_position, physical_type, nullable)
CATALOGUE_SQL = _VOCAB_SQL + f""",
attrs AS (
 SELECT 'stg_ord'||o_orderkey AS source_table, 'ord'||o_orderkey||'_id' AS source_column, 1 AS ordinal_position,
        'LongType()' AS physical_type, false AS nullable FROM orders
 UNION ALL SELECT 'stg_ord'||o_orderkey,
        CASE o_orderstatus WHEN 'O' THEN 'cust'||o_custkey||'_id' WHEN 'F' THEN 'bill_to_cust'||o_custkey||'_id'
        ELSE 'Cust'||o_custkey||'Id' END, 2,
        CASE WHEN o_orderpriority='1-URGENT' THEN 'StringType()' ELSE 'LongType()' END, true FROM orders
 UNION ALL SELECT 'stg_ord'||o_orderkey, n, 3, t, b FROM orders JOIN vocab ON k = o_orderkey % {N}
 UNION ALL SELECT 'stg_ord'||o_orderkey, n, 4, t, b FROM orders
        JOIN vocab ON k = (o_orderkey % {N} + 1 + o_custkey % {N - 1}) % {N}
 UNION ALL SELECT 'stg_ord'||o_orderkey, 'FLD'||(o_custkey % 1000), 5, 'StringType()', true FROM orders
 UNION ALL SELECT 'src_cust'||c_custkey, 'cust'||c_custkey||'_id', 1, 'LongType()', false FROM customer
 UNION ALL SELECT 'src_cust'||c_custkey, 'nation'||c_nationkey||'_key', 2, 'IntegerType()', true FROM customer
 UNION ALL SELECT 'src_cust'||c_custkey, n, 3, t, b FROM customer JOIN vocab ON k = c_custkey % {N}
 UNION ALL SELECT 'src_cust'||c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'id' ELSE 'mkt_segment_cd' END, 4,
        'StringType()', true FROM customer
 UNION ALL SELECT 'part'||p_partkey, 'id', 1, CASE WHEN p_size > 25 THEN 'LongType()' ELSE 'StringType()' END,
        false FROM part
 UNION ALL SELECT 'part'||p_partkey, replace(p_name,' ','_'), 2, 'DoubleType()', true FROM part
 UNION ALL SELECT 'part'||p_partkey, replace(p_brand,'#','_')||'Amt', 3, 'StringType()', true FROM part
 UNION ALL SELECT 'part'||p_partkey, n, 4, t, b FROM part JOIN vocab ON k = p_partkey % {N}
 UNION ALL SELECT 'staging_supp'||s_suppkey, 'supp'||s_suppkey||'_key', 1, 'LongType()', false FROM supplier
 UNION ALL SELECT 'staging_supp'||s_suppkey, 'nation'||s_nationkey||'_key', 2, 'StringType()', true FROM supplier
 UNION ALL SELECT 'ref_nation'||n_nationkey, 'nation'||n_nationkey||'_key', 1, 'IntegerType()', false FROM nation
 UNION ALL SELECT 'ref_nation'||n_nationkey, 'display_name', 2, 'StringType()', false FROM nation
)"""

BROKEN = r"regexp_replace({c}, '([a-z0-9])([A-Z])', '\1_\2', 'g')"
CONVENTION_SQL = (
    "CASE WHEN regexp_matches({c}, '[_\\-\\s]') THEN 'snake_case' "
    "WHEN regexp_matches({c}, '[a-z0-9][A-Z]') THEN 'camelCase' "
    "WHEN {c} = upper({c}) AND {c} <> lower({c}) AND regexp_matches({c}, '^[\\p{{L}}\\p{{N}}]+$') "
    "THEN 'AS400_ABBREVIATED' ELSE 'snake_case' END")
PARTS_SQL = (r"list_filter(regexp_split_to_array(" + BROKEN + r", '[_\-\s]+'), lambda p: p <> '')")
TITLE_SQL = (r"array_to_string(list_transform(regexp_extract_all({c}, '(\p{{L}}+|[^\p{{L}}]+)'), "
             r"lambda r: upper(r[1:1]) || lower(r[2:])), '')")

NAMING = load_pack("naming")
TOKENS_SQL = values("tok", "ord,rule_id,token,expansion", [
    (i, r["rule_id"], r["token"], r["expansion"]) for i, r in enumerate(NAMING["token_rules"])])
_PATTERN = token_pattern(NAMING)

# names(source_column) -> seg, opt, hyp_all, hyp(source_column, expanded, rules, path, over)
HYPOTHESES_SQL = TOKENS_SQL + f""",
seg AS (
 SELECT source_column, flatten(list_transform({PARTS_SQL.format(c='source_column')}, lambda p:
   CASE WHEN array_to_string(regexp_extract_all(upper(p), '{_PATTERN}'), '') = upper(p)
        THEN list_transform(regexp_extract_all(upper(p), '{_PATTERN}'), lambda t: {{'t': t, 'p': p}})
        ELSE [{{'t': upper(p), 'p': p}}] END)) AS segs FROM names),
spot AS (SELECT source_column, segs, unnest(range(1, len(segs) + 1)) AS i FROM seg),
opt AS (
 SELECT source_column, i, segs[i].t AS token, coalesce(expansion, lower(segs[i].p)) AS expansion, rule_id,
        row_number() OVER (PARTITION BY source_column, i ORDER BY ord) AS k,
        count(*) OVER (PARTITION BY source_column, i) AS n
 FROM spot LEFT JOIN tok ON tok.token = segs[i].t),
total AS (SELECT source_column, product(n) AS hyps FROM opt WHERE k = 1 GROUP BY source_column),
hyp_all AS (
 SELECT source_column, len(segs) AS last, 0 AS i, '' AS expanded, '' AS rules, '' AS path,
        coalesce(hyps, 1) > 32 AS over
 FROM seg LEFT JOIN total USING (source_column)
 UNION ALL
 SELECT h.source_column, last, h.i + 1, CASE WHEN expanded = '' THEN expansion ELSE expanded || ' ' || expansion END,
        CASE WHEN rule_id IS NULL THEN rules WHEN rules = '' THEN rule_id ELSE rules || ',' || rule_id END,
        path || lpad(k::VARCHAR, 2, '0'), over
 FROM hyp_all h JOIN opt o ON o.source_column = h.source_column AND o.i = h.i + 1
 WHERE NOT over),
hyp AS (SELECT * FROM hyp_all WHERE i = last AND NOT over
 UNION ALL SELECT source_column, last, last, lower(source_column), '', '', over FROM hyp_all WHERE i = 0 AND over)"""

_CONCEPTS = load_pack("concepts")["concepts"]
CONCEPTS_SQL = ",\n".join([
    values("concept", "concept_id,name,concept_type,domain",
           [(c["concept_id"], c["name"], c["concept_type"], c["domain"]) for c in _CONCEPTS]),
    values("concept_name", "concept_id,name", sorted({
        (c["concept_id"], n.lower()) for c in _CONCEPTS for n in [c["name"], *c["synonyms"]]})),
    values("variant", "concept_id,variant", sorted({
        (c["concept_id"], v.lower()) for c in _CONCEPTS for v in c["physical_name_variants"]})),
]) + """,
concept_word AS (SELECT DISTINCT concept_id, unnest(string_split(name, ' ')) AS word FROM concept_name)"""

_VIA = f"via {NAMING['pack_id']} v{NAMING['pack_version']}"

# hyp -> named(source_column, ... ) as the Spark operator returns it, lists as text
NAMED_SQL = CONCEPTS_SQL + f""",
word AS (SELECT DISTINCT expanded, unnest(list_filter(string_split(expanded, ' '), lambda w: w <> '')) AS word
         FROM (SELECT DISTINCT expanded FROM hyp)),
words AS (SELECT expanded, count(*) AS words FROM word GROUP BY expanded),
shared AS (SELECT w.expanded, concept_id, count(*) AS shared FROM word w JOIN concept_word USING (word) GROUP BY ALL),
matched AS (
 SELECT s.expanded, s.concept_id, CASE WHEN EXISTS (SELECT 1 FROM concept_name n WHERE n.concept_id = s.concept_id
          AND n.name = s.expanded) THEN 'expanded_exact'
        WHEN shared = words THEN 'expanded_partial' WHEN shared / words > 0.5 THEN 'token_overlap' END AS kind
 FROM shared s JOIN words USING (expanded)),
found AS (
 SELECT DISTINCT source_column, concept_id, kind,
        CASE kind WHEN 'expanded_exact' THEN 0.9::DOUBLE WHEN 'expanded_partial' THEN 0.7::DOUBLE ELSE 0.55::DOUBLE END AS strength
 FROM hyp JOIN matched USING (expanded) WHERE kind IS NOT NULL),
best AS (SELECT source_column, max(strength) AS top, string_agg(DISTINCT concept_id, ', ' ORDER BY concept_id) AS candidates
         FROM found GROUP BY source_column),
tops AS (SELECT f.source_column, string_agg(DISTINCT concept_id, ', ' ORDER BY concept_id) AS tops,
                count(DISTINCT concept_id) AS n_tops, min(concept_id) AS top_id, min(kind) AS top_kind
         FROM found f JOIN best b ON b.source_column = f.source_column AND strength = top GROUP BY f.source_column),
var AS (SELECT source_column, count(*) AS variants, min(concept_id) AS variant_id,
               string_agg(concept_id, ', ' ORDER BY concept_id) AS variant_list
        FROM names JOIN variant ON variant = lower(source_column) GROUP BY source_column),
amb AS (SELECT source_column, string_agg(DISTINCT token, ', ' ORDER BY token) AS ambiguous
        FROM opt WHERE n > 1 GROUP BY source_column),
texts AS (SELECT source_column, min_by(expanded, path) AS first_text, bool_or(over) AS over,
                 string_agg(DISTINCT expanded, ', ' ORDER BY expanded) AS alternatives,
                 list_sort(list_distinct(list_filter(flatten(list(string_split(rules, ','))), lambda r: r <> ''))) AS rule_ids
          FROM hyp GROUP BY source_column),
pre AS (
 SELECT t.*, variants, variant_id, variant_list, ambiguous, candidates, tops, n_tops, top_id, top_kind, top,
        {CONVENTION_SQL.format(c='t.source_column')} AS naming_convention,
        {TITLE_SQL.format(c='first_text')} AS proposed,
        CASE WHEN over THEN 'limit' WHEN variants = 1 THEN 'variant_exact' WHEN variants > 1 THEN 'variant_conflict'
             WHEN ambiguous IS NOT NULL THEN 'ambiguous_token' WHEN n_tops = 1 THEN top_kind
             WHEN n_tops > 1 THEN 'tie' ELSE 'fallback' END AS naming_outcome
 FROM texts t LEFT JOIN var USING (source_column) LEFT JOIN amb USING (source_column)
 LEFT JOIN best USING (source_column) LEFT JOIN tops USING (source_column)),
named AS (
 SELECT p.source_column, naming_convention, CASE WHEN over THEN 'TOKEN_HYPOTHESIS_LIMIT' ELSE 'OK' END AS name_status,
  array_to_string(rule_ids, ',') AS rule_ids, naming_outcome,
  CASE WHEN naming_outcome = 'token_overlap' THEN proposed WHEN c.concept_id IS NOT NULL THEN c.name
       WHEN naming_outcome IN ('variant_conflict','ambiguous_token','limit') THEN p.source_column
       WHEN naming_outcome = 'fallback' AND naming_convention = 'AS400_ABBREVIATED' AND len(rule_ids) = 0
       THEN p.source_column ELSE coalesce(nullif(proposed, ''), p.source_column) END AS proposed_business_name,
  c.concept_id AS ontology_concept_id, c.concept_type AS ontology_concept_type, coalesce(c.domain, 'Shared') AS domain,
  CASE WHEN naming_outcome = 'variant_exact' THEN 0.95::DOUBLE WHEN c.concept_id IS NOT NULL THEN top ELSE 0.4::DOUBLE END AS naming_strength,
  CASE WHEN c.concept_id IS NOT NULL THEN 'Matched by rules (' || naming_outcome || ') {_VIA}'
       WHEN naming_outcome = 'limit' THEN 'The name has too many governed readings to choose from; a steward decides.'
       WHEN naming_outcome = 'variant_conflict' THEN 'More than one concept lists this physical name.'
       WHEN naming_outcome = 'ambiguous_token' THEN 'A token can be read in several ways; choose a listed concept or ask a steward.'
       WHEN naming_outcome = 'tie' THEN 'Several concepts match equally well; a steward chooses.'
       ELSE 'No rule matched; the spelled-out name is all there is for the steward.' END AS naming_reason,
  CASE naming_outcome WHEN 'limit' THEN 'TOKEN_HYPOTHESIS_LIMIT: more than 32 governed readings.'
       WHEN 'variant_conflict' THEN 'The physical name ''' || p.source_column || ''' belongs to several concepts: ' || variant_list || '.'
       WHEN 'ambiguous_token' THEN 'Tokens with several readings: ' || ambiguous || '; readings: ' || alternatives
            || '; concepts to choose from: ' || coalesce(candidates, 'none') || '.'
       WHEN 'tie' THEN 'Concepts that match equally well: ' || tops || '.' END AS naming_contradictions,
  CASE WHEN c.concept_id IS NOT NULL THEN c.concept_id WHEN naming_outcome = 'variant_conflict' THEN replace(variant_list, ', ', ',')
       WHEN naming_outcome = 'ambiguous_token' THEN coalesce(replace(candidates, ', ', ','), '')
       WHEN naming_outcome = 'tie' THEN replace(tops, ', ', ',') ELSE '' END AS semantic_candidates
 FROM pre p LEFT JOIN concept c ON c.concept_id = CASE WHEN naming_outcome = 'variant_exact' THEN variant_id
   WHEN naming_outcome IN ('expanded_exact','expanded_partial','token_overlap') THEN top_id END)"""

_PRIVACY = load_pack("privacy")
_RULES = [*_PRIVACY["exceptions"], *_PRIVACY["rules"]]
_CASE = " ".join(
    f"WHEN regexp_matches({'expanded' if r['match_on'] == 'expanded' else 'lower(source_column)'}, {sql_text(r['pattern'])}) THEN {i}"
    for i, r in enumerate(_RULES))
# hyp -> private(source_column, privacy_class, privacy_rationale, privacy_rule_id)
PRIVACY_SQL = values("privacy_rule", "k,rule_id,privacy_class,rationale,rank", [
    (i, r["rule_id"], r["privacy_class"], r["rationale"],
     {"INTERNAL": 0, "PERSONAL_DATA": 1, "SENSITIVE": 2}[r["privacy_class"]])
    for i, r in enumerate([*_RULES, _PRIVACY["default"]])]) + f""",
verdict AS (SELECT source_column, path, over, CASE {_CASE} ELSE {len(_RULES)} END AS k FROM hyp),
private AS (
 SELECT source_column, CASE WHEN over THEN {sql_text(LIMIT_CLASS)} ELSE privacy_class END AS privacy_class,
  CASE WHEN over THEN {sql_text(LIMIT_RATIONALE)} ELSE rationale END AS privacy_rationale,
  CASE WHEN over THEN {sql_text(LIMIT_RULE)} ELSE rule_id END AS privacy_rule_id
 FROM (SELECT v.*, r.*, row_number() OVER (PARTITION BY source_column ORDER BY rank DESC, path) AS pick
       FROM verdict v JOIN privacy_rule r ON r.k = v.k) WHERE pick = 1)"""


def rounded(expression: str, digits: int = 4) -> str:
    """SQL for a double rounded by its exact binary value, ties to even."""
    x, s = f"({expression})", f"{float(10 ** digits)!r}::DOUBLE"
    high = f"({x} * 134217729::DOUBLE - ({x} * 134217729::DOUBLE - {x}))"
    product = f"({x} * {s})"
    error = f"(({high} * {s} - {product}) + ({x} - {high}) * {s})"
    part = f"({product} - floor({product}))"
    up = (f"({part} > 0.5 OR ({part} = 0.5 AND {error} > 0) OR ({part} = 0.5 AND {error} = 0 "
          f"AND floor({product})::BIGINT % 2 = 1))")
    return f"((floor({product}) + CASE WHEN {up} THEN 1::DOUBLE ELSE 0::DOUBLE END) / {s})"
