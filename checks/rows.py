"""Queries that read source rows: scope, profiles, quality, prohibited evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.operators import keys, privacy, profile, quality
from catalograph.plans import build
from catalograph.sources import scan, sink
from checks.base import CATALOGUE_SQL, RUN, catalogue, concepts, sql_text, table, registry
from checks.observed import ROLES_SQL, created, members_sql, roles

QUERIES, ORACLES, query = registry()


def _union(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


# ---------------------------------------------------------------- inventory
_SCHEMAS = {
    "region": ["r_regionkey:IntegerType()", "r_name:StringType()"],
    "nation": ["n_nationkey:IntegerType()", "n_name:StringType()", "n_regionkey:IntegerType()"],
    "customer": ["c_custkey:LongType()", "c_name:StringType()", "c_nationkey:IntegerType()", "c_acctbal:DoubleType()",
                 "c_mktsegment:StringType()"],
    "supplier": ["s_suppkey:LongType()", "s_name:StringType()", "s_nationkey:IntegerType()", "s_acctbal:DoubleType()"],
    "part": ["p_partkey:LongType()", "p_name:StringType()", "p_brand:StringType()", "p_type:StringType()",
             "p_size:IntegerType()", "p_retailprice:DoubleType()"],
    "orders": ["o_orderkey:LongType()", "o_custkey:LongType()", "o_orderstatus:StringType()",
               "o_totalprice:DoubleType()", "o_orderdate:TimestampNTZType()", "o_orderpriority:StringType()"],
    "lineitem": ["l_orderkey:LongType()", "l_partkey:LongType()", "l_suppkey:LongType()", "l_linenumber:IntegerType()",
                 "l_quantity:DoubleType()", "l_extendedprice:DoubleType()", "l_discount:DoubleType()",
                 "l_tax:DoubleType()", "l_returnflag:StringType()", "l_linestatus:StringType()",
                 "l_shipdate:TimestampNTZType()"],
    "events": ["event_id:LongType()", "ts:TimestampNTZType()", "user_id:LongType()", "event_type:StringType()",
               "value:DoubleType()", "props:StringType()"],
    "documents": ["doc_id:LongType()", "text:StringType()", "lang:StringType()", "source:StringType()",
                  "n_chars:LongType()"],
    "embeddings": ["vec_id:LongType()", "embedding:ArrayType(FloatType(), True)", "label:IntegerType()"],
    "pages": ["page_id:LongType()", "url:StringType()", "html:StringType()"],
    "benchmark": ["item_id:LongType()", "text:StringType()"],
    "labels": ["doc_id:LongType()", "quality:IntegerType()", "toxic:IntegerType()"],
    "conversations": ["conv_id:LongType()", "turn:LongType()", "role:StringType()", "text:StringType()"],
}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c.split(':')[0]}' AS source_column, {i} AS ordinal_position, "
    f"'{c.split(':')[1]}' AS physical_type, true AS nullable, count(*) AS row_count, "
    f"count(*) - count({c.split(':')[0]}) AS null_count FROM {t}"
    for t, cols in _SCHEMAS.items() for i, c in enumerate(cols, 1)))
def attribute_inventory(spark, sf_dir):
    """A1, A4 with B1's counts: every column, and how many of its rows are null."""
    tables = {n: table(spark, sf_dir, n) for n in _SCHEMAS}
    counts = _union([
        profile.column_statistics(df, df.columns, ranges=False).select(
            F.lit(n).alias("source_table"), "source_column", "row_count", "null_count") for n, df in tables.items()])
    return scan.attribute_inventory(spark, tables).join(counts, ["source_table", "source_column"])


@query(f"WITH {CATALOGUE_SQL} SELECT DISTINCT 'src_cust' || l_partkey AS source_table FROM lineitem "
       "WHERE 'src_cust' || l_partkey NOT IN (SELECT source_table FROM attrs)")
def scope_missing_tables(spark, sf_dir):
    """A2: tables the line items ask for that the catalogue lacks."""
    scope = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("src_cust"), F.col("l_partkey").cast("string")).alias("source_table"))
    return scan.missing_tables(scope, catalogue(spark, sf_dir).select("source_table").distinct())


@query(f"WITH {CATALOGUE_SQL} SELECT DISTINCT source_table FROM attrs WHERE source_table NOT IN "
       "(SELECT source_table FROM attrs WHERE physical_type = 'DoubleType()')")
def scope_tables_without_columns(spark, sf_dir):
    """A3: catalogue tables with no column among the double columns."""
    rows = catalogue(spark, sf_dir)
    return scan.tables_without_columns(rows, rows.where("physical_type = 'DoubleType()'"))


_RUNS = "SELECT strftime(l_shipdate, 'si_%Y%m01T000000Z') AS run_id, l_orderkey, l_linenumber, l_linestatus FROM lineitem"


@query(f"WITH r AS ({_RUNS}) SELECT run_id, count(*) AS new_rows FROM r WHERE run_id NOT IN "
       "(SELECT run_id FROM r WHERE l_orderkey % 1000 = 5 AND l_linenumber = 1) GROUP BY run_id")
def append_unwritten(spark, sf_dir):
    """Rows of runs that the written relation does not have yet."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "'si_'yyyyMM'01T000000Z'").alias("run_id"), "l_orderkey", "l_linenumber")
    written = rows.where("l_orderkey % 1000 = 5 AND l_linenumber = 1")
    return sink.unwritten(rows, written, ["run_id"]).groupBy("run_id").agg(F.count(F.lit(1)).alias("new_rows"))


@query("""WITH r AS (SELECT o_orderkey, o_orderpriority AS engagement_id, 'si_job_' || month(o_orderdate) AS run_id, o_orderdate AS created_at FROM orders)
SELECT o_orderkey, run_id FROM r WHERE engagement_id = '1-URGENT' AND run_id = (SELECT run_id FROM r WHERE engagement_id = '1-URGENT'
 ORDER BY created_at DESC, run_id DESC LIMIT 1)""")
def latest_run_rows(spark, sf_dir):
    """A10: rows of the newest run when the asked run has none."""
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("engagement_id"),
        F.concat(F.lit("si_job_"), F.month("o_orderdate").cast("string")).alias("run_id"), F.col("o_orderdate").alias("created_at"))
    return sink.select_run(rows, "1-URGENT", "si_job_99").select("o_orderkey", "run_id")


@query("""WITH i(name, incoming_type) AS (SELECT column_name, count(*)::VARCHAR FROM (
  SELECT 'c' || (l_partkey % 300) AS column_name FROM lineitem) GROUP BY 1),
e(name, existing_type) AS (SELECT column_name, count(*)::VARCHAR FROM (
  SELECT 'c' || (l_partkey % 300) AS column_name FROM lineitem WHERE l_partkey % 300 <> 7 AND (l_partkey % 300 <> 9 OR l_linenumber > 1)
  UNION ALL SELECT 'gone' || l_linenumber FROM lineitem) GROUP BY 1)
SELECT name, incoming_type, existing_type, CASE WHEN incoming_type IS NULL THEN 'MISSING' WHEN existing_type IS NULL THEN 'DROPPED'
 WHEN incoming_type <> existing_type THEN 'TYPE_MISMATCH' ELSE 'OK' END AS status FROM i FULL JOIN e USING (name)""")
def schema_alignment(spark, sf_dir):
    """Status of every column of two column inventories."""
    lines = table(spark, sf_dir, "lineitem")
    name = F.concat(F.lit("c"), (F.col("l_partkey") % 300).cast("string"))

    def inventory(rows):
        return rows.groupBy("name").agg(F.count(F.lit(1)).cast("string").alias("type"))

    kept = lines.where("l_partkey % 300 <> 7 AND (l_partkey % 300 <> 9 OR l_linenumber > 1)").select(name.alias("name"))
    gone = lines.select(F.concat(F.lit("gone"), F.col("l_linenumber").cast("string")).alias("name"))
    return sink.schema_differences(inventory(lines.select(name.alias("name"))), inventory(kept.unionByName(gone)))


# ---------------------------------------------------------------- profiles
# Columns made null by rule, so rates are not all zero: SQL text used by both engines.
_NULLED = {"l_returnflag": "nullif(l_returnflag, 'R')", "l_linenumber": "CASE WHEN l_linenumber > 6 THEN NULL ELSE l_linenumber END",
           "o_orderpriority": "nullif(o_orderpriority, '5-LOW')", "event_type": "nullif(event_type, 'click')", "source": "nullif(source, 'src3')",
           "r_name": "nullif(r_name, r_name)"}
# Every column with an order: all but the embeddings' arrays.
_ORDERED = {t: [c.split(":")[0] for c in cols if "Array" not in c] for t, cols in _SCHEMAS.items()}
_PROFILED = {t: {c: _NULLED.get(c, c) for c in cols} for t, cols in _ORDERED.items()}
# -0.0 is 0.0, in whichever way an engine writes the least value
_ZERO = {c.split(":")[0]: " + 0.0" if c.endswith("DoubleType()") else "" for cols in _SCHEMAS.values() for c in cols}


def _profiled(spark, sf_dir, name):
    return table(spark, sf_dir, name).selectExpr(*[f"{e} AS {c}" for c, e in _PROFILED[name].items()])


def _profiled_sql(name):
    return f"(SELECT {', '.join(f'{e} AS {c}' for c, e in _PROFILED[name].items())} FROM {name})"


def rate_sql(rate):
    fixed = f"regexp_replace(printf('%.6f', {rate}), '(\\.\\d+?)0+$', '\\1')"
    micros = f"round({rate} * 1000000)::BIGINT"
    tiny = (f"CASE WHEN {micros} < 10 THEN {micros} || 'e-06' WHEN {micros} % 10 = 0 THEN ({micros} // 10) || 'e-05' "
            f"ELSE ({micros} // 10) || '.' || ({micros} % 10) || 'e-05' END")
    return f"CASE WHEN {micros} > 0 AND {micros} < 100 THEN {tiny} ELSE {fixed} END"


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, count(*) AS row_count, count(*) - count({c}) AS null_count, "
    f"count(DISTINCT {c}) AS distinct_count, min({c}{_ZERO[c]})::VARCHAR AS min_value, max({c}{_ZERO[c]})::VARCHAR AS max_value FROM {_profiled_sql(t)}"
    for t, cols in _PROFILED.items() for c in cols))
def profile_statistics(spark, sf_dir):
    """B1, B2 (exact), B4: one aggregate per table."""
    return _union([profile.column_statistics(_profiled(spark, sf_dir, t), list(cols), exact=True)
                   .withColumn("source_table", F.lit(t)) for t, cols in _PROFILED.items()])


_EVIDENCE = " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, 'NULL_RATE' AS profile_type, "
    f"{rate_sql(f'((count(*) - count({c})) / count(*))')} AS profile_value FROM {_profiled_sql(t)} "
    f"UNION ALL SELECT '{t}', '{c}', 'DISTINCT_COUNT', count(DISTINCT {c})::VARCHAR FROM {_profiled_sql(t)} "
    f"UNION ALL SELECT '{t}', '{c}', 'MIN_MAX', min({c}{_ZERO[c]})::VARCHAR || '..' || max({c}{_ZERO[c]})::VARCHAR FROM {_profiled_sql(t)}"
    for t, cols in _PROFILED.items() for c in cols)


@query(f"SELECT * FROM ({_EVIDENCE}) WHERE profile_value IS NOT NULL")
def profile_evidence_rows(spark, sf_dir):
    """Evidence rows of every profiled column."""
    return _union([
        profile.profile_rows(profile.column_statistics(_profiled(spark, sf_dir, t), list(cols), exact=True)
                             .withColumn("source_table", F.lit(t)), with_range=True) for t, cols in _PROFILED.items()])


_CONTROLLED = _ORDERED


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, count(*) AS distinct_count, string_agg({c}::VARCHAR, ',' ORDER BY {c}::VARCHAR) AS profile_value, "
    f"'CONTROLLED_VALUES' AS profile_type FROM (SELECT {c}, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}) "
    f"HAVING count(*) <= 20 AND min(n) >= 5" for t, cols in _CONTROLLED.items() for c in cols))
def profile_controlled_values(spark, sf_dir):
    """Value lists under the k-anonymity rule."""
    return _union([profile.controlled_values(table(spark, sf_dir, t), cols).withColumn("source_table", F.lit(t))
                   for t, cols in _CONTROLLED.items()])


_METRICS = """SELECT o_custkey AS source_table, 'o_orderpriority' AS source_column, count(*) AS row_count,
 count(*) - count(nullif(o_orderpriority, '5-LOW')) AS null_count, count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS d,
 min(nullif(o_orderpriority, '5-LOW')) AS lo, max(nullif(o_orderpriority, '5-LOW')) AS hi,
 CASE WHEN o_custkey % 3 = 0 THEN 'PERSONAL_DATA' ELSE 'INTERNAL' END AS privacy_class FROM orders GROUP BY o_custkey"""
_RULE = "'LAKEHOUSE_MONITORING: numbers of rows and values alone'"


@query(f"""WITH m AS ({_METRICS}),
v AS (SELECT o_custkey AS source_table, string_agg(p, ',' ORDER BY p) AS vals, min(n) AS rare FROM (
 SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL) GROUP BY ALL),
e AS (SELECT source_table, source_column, privacy_class, 'NULL_RATE' AS profile_type, printf('%.4f', null_count / row_count) AS profile_value,
  'AGGREGATE_PROFILE' AS evidence_class, {_RULE} AS minimization_rule FROM m
 UNION ALL SELECT source_table, source_column, privacy_class, 'DISTINCT_COUNT', d::VARCHAR, 'AGGREGATE_PROFILE', {_RULE} FROM m
 UNION ALL SELECT source_table, source_column, privacy_class, 'MIN_MAX', lo || '..' || hi, 'AGGREGATE_PROFILE',
  'LAKEHOUSE_MONITORING: least and greatest value, of INTERNAL columns alone' FROM m WHERE privacy_class = 'INTERNAL' AND lo IS NOT NULL
 UNION ALL SELECT m.source_table, source_column, privacy_class, 'CONTROLLED_VALUES', vals, 'CONTROLLED_VALUE_SUMMARY',
  'LAKEHOUSE_MONITORING: at most 20 values, each on 2 rows or more' FROM m JOIN v USING (source_table)
  WHERE privacy_class = 'INTERNAL' AND d <= 20 AND rare >= 2)
SELECT *, true AS is_minimized FROM e""")
def profile_metric_adapter(spark, sf_dir):
    """Monitor metric rows of every customer's orders, gated by privacy class."""
    orders = table(spark, sf_dir, "orders").withColumn("p", F.expr("nullif(o_orderpriority, '5-LOW')"))
    per_value = orders.groupBy("o_custkey", "p").agg(F.count(F.lit(1)).alias("n"))
    metrics = per_value.groupBy(F.col("o_custkey").alias("source_table")).agg(
        F.sum("n").alias("rows_seen"), F.coalesce(F.sum(F.when(F.col("p").isNull(), F.col("n"))), F.lit(0)).alias("num_nulls"),
        F.count("p").alias("distinct_count"), F.min("p").alias("min"), F.max("p").alias("max"),
        F.collect_list(F.when(F.col("p").isNotNull(), F.struct(F.col("p").alias("item"), F.col("n").alias("count")))).alias("frequent_items"),
    ).withColumns({"column_name": F.lit("o_orderpriority"),
                   "privacy_class": F.when(F.col("source_table") % 3 == 0, "PERSONAL_DATA").otherwise("INTERNAL")})
    return profile.adapt_metrics(metrics, None, ["source_table"], {"row_count": "rows_seen"}, min_count=2)


_SHAPE = "regexp_replace(regexp_replace(regexp_replace({c}, '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g')"


_TEXTS = {t: [c.split(":")[0] for c in cols if c.endswith(":StringType()")] for t, cols in _SCHEMAS.items()}
_TEXTS = {t: cols for t, cols in _TEXTS.items() if cols}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, count(*) AS distinct_count, string_agg(s, ',' ORDER BY s) AS profile_value, "
    f"'PATTERN_SUMMARY' AS profile_type FROM (SELECT {_SHAPE.format(c=c)} AS s, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 1) "
    f"HAVING count(*) <= 20 AND min(n) >= 5" for t, cols in _TEXTS.items() for c in cols))
def profile_pattern_summary(spark, sf_dir):
    """Value shapes of every text column under the k-anonymity rule."""
    return _union([profile.pattern_summary(table(spark, sf_dir, t), cols).withColumn("source_table", F.lit(t)) for t, cols in _TEXTS.items()])


# The privacy gate on the real tables: which columns may be read at all.
_GATED = {"customer": ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"],
          "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"]}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, p.k AS profile_type, CASE p.k WHEN 'NULL_RATE' THEN "
    f"(SELECT {rate_sql(f'((count(*) - count({c})) / count(*))')} FROM {t}) ELSE (SELECT count(DISTINCT {c})::VARCHAR FROM {t}) END AS profile_value, "
    f"'INTERNAL' AS privacy_class, 'PROPOSED' AS approval_state FROM (VALUES ('NULL_RATE'),('DISTINCT_COUNT')) p(k)"
    for t, cols in _GATED.items() for c in cols))
def profile_gate(spark, sf_dir):
    """V7: evidence of permitted columns only; names of people are never read."""
    tables = {"customer": table(spark, sf_dir, "customer").withColumnRenamed("c_name", "customer_full_name"),
              "supplier": table(spark, sf_dir, "supplier").withColumnRenamed("s_name", "contact_email")}
    attributes = scan.attribute_inventory(spark, tables)
    permitted = build.internal_by_table(attributes, concepts(spark), RUN)
    rows = build.gated_profiles(tables, permitted, RUN, created(), exact=True)
    return rows.select("source_table", "source_column", "profile_type", "profile_value", "privacy_class", "approval_state")


# ---------------------------------------------------------------- quality
_EMPTIED = {"o_orderstatus": "replace(o_orderstatus, 'P', '')", "role": "replace(role, 'user', '')", "c_mktsegment": "nullif(replace(c_mktsegment, 'BUILDING', ''), 'MACHINERY')"}
_HOLED = {t: {c: _EMPTIED.get(c, e) for c, e in cols.items()} for t, cols in _PROFILED.items()}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS source_table, '{c}' AS source_column, count_if({e} IS NULL)::BIGINT AS null_rows, coalesce(count_if(({e})::VARCHAR = ''), 0)::BIGINT AS empty_rows, "
    f"count_if({e} IS NULL OR ({e})::VARCHAR = '') > 0 AS has_issue FROM {t}" for t, cols in _HOLED.items() for c, e in cols.items()))
def dq_null_or_empty(spark, sf_dir):
    """Q1: nulls and empty strings of every column."""
    rows = {t: table(spark, sf_dir, t).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()]) for t, cols in _HOLED.items()}
    return _union([quality.null_or_empty(df, df.columns).withColumn("source_table", F.lit(t)) for t, df in rows.items()])


@query("SELECT l_orderkey AS value, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 "
       "UNION ALL SELECT conv_id, count(*) FROM conversations GROUP BY 1 HAVING count(*) > 1")
def dq_duplicates(spark, sf_dir):
    """Q2: identifier values on more than one row."""
    return quality.duplicate_values(table(spark, sf_dir, "lineitem"), "l_orderkey").unionByName(
        quality.duplicate_values(table(spark, sf_dir, "conversations"), "conv_id"))


@query("SELECT 'orders' AS source_table, 'o_comment_key' AS source_column, count(nullif(o_orderstatus, o_orderstatus)) AS filled_rows FROM orders "
       "HAVING count(nullif(o_orderstatus, o_orderstatus)) = 0")
def dq_missing_primary_key(spark, sf_dir):
    """Q3: nullable columns without any value."""
    rows = table(spark, sf_dir, "orders").withColumn("o_comment_key", F.expr("nullif(o_orderstatus, o_orderstatus)"))
    return quality.missing_primary_key(rows, scan.attribute_inventory(spark, {"orders": rows}), "orders")


@query("SELECT 'documents.doc_id' AS link, doc_id::VARCHAR AS value FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) "
       "UNION ALL SELECT DISTINCT 'orders.o_custkey', o_custkey::VARCHAR FROM orders WHERE o_custkey NOT IN "
       "(SELECT c_custkey FROM customer WHERE c_nationkey <> 3)")
def dq_orphans(spark, sf_dir):
    """Q4: child values without a parent row."""
    a = quality.orphan_values(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")
    b = quality.orphan_values(table(spark, sf_dir, "orders"), "o_custkey",
                              table(spark, sf_dir, "customer").where("c_nationkey <> 3"), "c_custkey")
    return a.withColumn("link", F.lit("documents.doc_id")).unionByName(b.withColumn("link", F.lit("orders.o_custkey")))


@query(f"WITH {CATALOGUE_SQL}, {ROLES_SQL}, {members_sql('s.physical_type <> m.physical_type')} SELECT * FROM members")
def dq_type_conflict(spark, sf_dir):
    """Q5: links whose two columns have different types, as both sides of each match key."""
    return keys.relationship_members(roles(spark, sf_dir), conflicting=True)


_ISSUES = ("NULL_OR_EMPTY_VALUE", "DUPLICATE_IDENTIFIER", "ORPHAN_FOREIGN_KEY", "UNKNOWN_SEMANTIC_PATTERN",
           "PROHIBITED_EVIDENCE", "AMBIGUOUS_SEMANTIC_PATTERN", "RELATIONSHIP_TYPE_MISMATCH", "MISSING_PRIMARY_KEY")
_ISSUE_LIST = "[" + ",".join(f"'{i}'" for i in _ISSUES) + "]"


@query(f"""WITH i AS (SELECT l_orderkey, ({_ISSUE_LIST})[1 + (l_partkey + l_suppkey) % 8] AS issue, l_partkey % 11 = 0 AS private FROM lineitem),
g AS (SELECT l_orderkey, bool_or(private OR issue = 'PROHIBITED_EVIDENCE') AS p,
 min(CASE WHEN issue IN ('DUPLICATE_IDENTIFIER','ORPHAN_FOREIGN_KEY','RELATIONSHIP_TYPE_MISMATCH','MISSING_PRIMARY_KEY') THEN issue END) AS a,
 bool_or(issue = 'NULL_OR_EMPTY_VALUE') AS e, min(issue) AS f FROM i GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN p THEN 'PRIVACY_STEWARD' WHEN a IS NOT NULL THEN 'DATA_ARCHITECT' ELSE 'DOMAIN_STEWARD' END AS reviewer_role,
 CASE WHEN p THEN 'privacy or prohibited evidence, for the privacy steward to see' WHEN a IS NOT NULL THEN lower(replace(a, '_', ' '))
 WHEN e THEN 'incomplete values, for a steward to fill or explain' ELSE lower(replace(f, '_', ' ')) END AS review_reason FROM g""")
def dq_issue_routing(spark, sf_dir):
    """Q6: one reviewer and reason per order from its issues."""
    issues = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.expr(f"element_at(array({','.join(sql_text(i) for i in _ISSUES)}), cast(1 + (l_partkey + l_suppkey) % 8 AS int))").alias("issue"),
        F.when(F.col("l_partkey") % 11 == 0, "PERSONAL_DATA").otherwise("INTERNAL").alias("privacy_class"))
    return quality.route_issues(issues, ["l_orderkey"])


def _fingerprint_sql(name, columns):
    # timestamps as the operator writes them; doubles print alike from 0.001 up to 10 million
    body = ", ".join(f"'{c}': " + (f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')" if t == "timestamp_ntz" else c) for c, t in columns)
    schema = ",".join(f"{c}:{t}:true" for c, t in columns)
    lanes = " || ',' || ".join(f"coalesce(sum(('0x' || h[{1 + 8 * i}:{8 + 8 * i}])::UBIGINT::HUGEINT)::VARCHAR, '0')" for i in range(8))
    return (f"SELECT '{name}' AS source_table, count(*) AS row_count, sha256('{schema}' || '|' || count(*) || '|' || {lanes}) AS input_key "
            f"FROM (SELECT sha256(to_json({{{body}}})::VARCHAR) AS h FROM {name})")


# The embeddings are left to the tests: the engines write 32-bit floats differently.
_SPARK_TYPES = {"LongType()": "bigint", "IntegerType()": "int", "DoubleType()": "double", "StringType()": "string", "TimestampNTZType()": "timestamp_ntz"}
_PRINTED = {t: [(c.split(":")[0], _SPARK_TYPES[c.split(":")[1]]) for c in cols] for t, cols in _SCHEMAS.items() if t != "embeddings"}


@query(" UNION ALL ".join(_fingerprint_sql(n, c) for n, c in _PRINTED.items()))
def dq_table_fingerprint(spark, sf_dir):
    """Q7: order-insensitive content key of every column of whole tables."""
    return _union([quality.table_fingerprint(table(spark, sf_dir, n)).withColumn("source_table", F.lit(n)) for n in _PRINTED])


@query("""WITH r AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'not-a-date' WHEN o_orderkey % 7 = 0 THEN '1850-02-03'
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d,
 CASE WHEN o_orderkey % 6 = 0 THEN 'x' || o_custkey WHEN o_orderkey % 10 = 1 THEN '-' || o_custkey WHEN o_orderkey % 10 = 3 THEN '99999999999.00'
  ELSE o_custkey || '.25' END AS a FROM orders)
SELECT 'd' AS source_column, 'date' AS target_type, count(d) AS value_rows, count(try_cast(d AS DATE)) AS parsed_rows,
 count_if(try_cast(d AS DATE) BETWEEN DATE '1900-01-01' AND DATE '9999-12-31')::BIGINT AS in_range_rows FROM r
UNION ALL SELECT 'a', 'decimal(12,2)', count(a), count(try_cast(a AS DECIMAL(12,2))),
 count_if(try_cast(a AS DECIMAL(12,2)) BETWEEN 0.00 AND 9999999999.99)::BIGINT FROM r""")
def dq_boundary_parse(spark, sf_dir):
    """Q8: text values that parse as date or amount, and lie in range."""
    rows = table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 5 = 0 THEN 'not-a-date' WHEN o_orderkey % 7 = 0 THEN '1850-02-03' "
        "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS d",
        "CASE WHEN o_orderkey % 6 = 0 THEN concat('x', o_custkey) WHEN o_orderkey % 10 = 1 THEN concat('-', o_custkey) "
        "WHEN o_orderkey % 10 = 3 THEN '99999999999.00' ELSE concat(o_custkey, '.25') END AS a")
    return quality.boundary_parse(rows, ["d"], ["a"])


# ---------------------------------------------------------------- prohibited evidence
# Which rows of which text columns get the sentinel put before their text: SQL text used by both engines.
# The others, and page addresses with the sentinel behind them, must not be found.
_PLANTED = {
    ("nation", "n_name"): "n_nationkey = 7", ("customer", "c_name"): "c_custkey % 97 = 3", ("part", "p_type"): "p_partkey % 97 = 3",
    ("orders", "o_orderstatus"): "o_orderkey % 97 = 3", ("lineitem", "l_linestatus"): "l_orderkey % 97 = 3 AND l_linenumber = 1",
    ("events", "props"): "event_id % 97 = 3", ("documents", "text"): "doc_id % 41 = 3", ("pages", "html"): "page_id % 11 = 3",
    ("benchmark", "text"): "item_id % 3 = 1", ("conversations", "text"): "conv_id % 7 = 3",
}
def _planted(name, column):
    if (name, column) == ("pages", "url"):
        return f"concat({column}, '{privacy.SENTINEL_PREFIX}')"
    rule = _PLANTED.get((name, column))
    return f"CASE WHEN {rule} THEN concat('{privacy.SENTINEL_PREFIX}', {column}) ELSE {column} END" if rule else column


_HITS = f"""WITH {CATALOGUE_SQL},
hits AS (SELECT source_table, source_column FROM attrs WHERE lower(source_column) IN
  ('loss_narrative','claim_narrative','credentials','connection_string')
 """ + "\n ".join(
    f"UNION SELECT '{t}', '{c}' FROM {t} HAVING bool_or(starts_with({_planted(t, c)}, '{privacy.SENTINEL_PREFIX}'))"
    for t, cols in _TEXTS.items() for c in cols) + ")"


def _hits(spark, sf_dir):
    named = privacy.prohibited_columns(catalogue(spark, sf_dir)).select("source_table", "source_column")
    return _union([named, *[
        privacy.prohibited_values(table(spark, sf_dir, t).selectExpr(*[f"{_planted(t, c)} AS {c}" for c in cols]), t)
        for t, cols in _TEXTS.items()]])


@query(_HITS + " SELECT * FROM hits")
def prohibited_scan(spark, sf_dir):
    """V4, V5: prohibited column names, and text columns with a value that starts with the sentinel."""
    return _hits(spark, sf_dir)


@query(_HITS + f""" SELECT '1.0.0' AS schema_version, '{RUN.run_id}' AS run_id, '1.0.0' AS artifact_version, 'sales' AS source_system,
 source_table, source_column, 'PROHIBITED_NARRATIVE' AS evidence_class_attempted, 'PROHIBITED_EVIDENCE' AS violation_type,
 'REJECTED_BEFORE_PROFILE' AS action_taken, 'Turned away unread; nothing of it was kept.' AS sanitized_description,
 'PRIVACY_STEWARD' AS routed_to FROM hits""")
def policy_violations(spark, sf_dir):
    """V6: sanitized events of all hits."""
    return privacy.policy_violations(_hits(spark, sf_dir), RUN.run_id, "sales", created()).drop("created_at")
