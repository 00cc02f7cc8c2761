"""Plans and skew: pruned scans, no Python, no nested loops, exact results under forced skew."""

import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from catalograph.functions.skew import lookup_join
from catalograph.operators import keys as K
from catalograph.operators import profile
from catalograph.sources.synthetic import synthetic_tables, wide_catalog
from checks.base import catalogue
from checks.observed import roles


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["name_match", "privacy_classify", "key_roles", "relationship_candidates",
                                  "profile_statistics", "review_queue", "publish_draft", "doc_responses", "schema_changes",
                                  "structure_match", "structure_assessment", "value_inclusions", "version_changes"])
def test_plans_run_in_the_jvm_without_pair_joins(spark, sf_dir, name):
    plan = _plan(queries()[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_gate_reads_only_permitted_columns(spark, sf_dir):
    plan = queries()["profile_gate"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if "Project [" in line or "Relation" in line]
    assert scans
    physical = _plan(queries()["profile_gate"](spark, sf_dir))
    for line in physical.splitlines():
        if "ReadSchema" in line:
            schema = line.split("ReadSchema:")[1]
            assert "c_name" not in schema and "s_name" not in schema


def test_statistics_scan_once_per_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = _plan(profile.column_statistics(df, ["l_orderkey", "l_tax", "l_returnflag"]))
    assert plan.count("FileScan parquet") == 1
    assert "l_comment" not in plan and "l_shipdate" not in plan


def test_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_shipdate >= timestamp_ntz'1998-01-01'")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual" in _plan(profile.column_statistics(df, ["l_tax"]))


def test_lookup_join_keeps_every_row_of_a_hot_key(spark):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                     F.col("id").alias("v")).unionByName(spark.createDataFrame([("none", -1)], "k string, v long"))
    lookup = facts.where("k <> 'none'").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top"))
    plain = facts.join(lookup.drop("n"), "k", "left")
    salted = lookup_join(facts, lookup, ["k"], "n", hot_rows=100, salts=8)
    assert sorted(map(tuple, salted.select("k", "v", "top").collect()), key=repr) == \
        sorted(map(tuple, plain.select("k", "v", "top").collect()), key=repr)


def _brute_force(rows):
    """Every foreign x primary pair, by the rules, one by one."""
    foreign = [r for r in rows if r.key_role == K.FOREIGN]
    primary = [r for r in rows if r.key_role == K.PRIMARY]
    pairs = {}
    for f in foreign:
        for p in primary:
            exact, same = f.source_column.lower() == p.source_column.lower(), f.signature == p.signature
            if f.source_table == p.source_table or not (exact or same):
                continue
            typed = f.physical_type == p.physical_type
            pairs[(f.source_table, f.source_column, p.source_table, p.source_column)] = (
                0.9 if exact and typed else 0.85 if same and typed else 0.55)
    return pairs


def _skewed_attributes(spark):
    rng, rows = random.Random(3), []
    for t in range(60):
        names = ["id" if t % 3 == 0 else f"E{t % 7}_id", rng.choice(["abCd_id", "abcd_id", "ABCD_ID", "cust_key"]),
                 f"e{rng.randrange(7)}Id", "note", "ID" if t % 5 == 0 else "amount"]
        for i, n in enumerate(dict.fromkeys(names), 1):
            rows.append((f"t{t}", n, i, rng.choice(["LongType()", "StringType()"]), i > 1))
    return spark.createDataFrame(rows, "source_table string, source_column string, ordinal_position int, "
                                       "physical_type string, nullable boolean")


@pytest.mark.parametrize("limits", [{}, {"foreign_per_salt": 5}])
def test_pairs_equal_brute_force(spark, limits):
    rows = K.key_roles(_skewed_attributes(spark))
    expected = _brute_force(rows.collect())
    candidates = K.relationship_candidates(rows, **limits)
    found = {(r.from_table, r.from_column, r.to_table, r.to_column): r.confidence_score for r in candidates.collect()}
    assert len(found) == candidates.count() and found == expected
    asked = rows.where("source_table IN ('t1', 't3')")
    part = {(r.from_table, r.from_column, r.to_table, r.to_column) for r in K.relationship_candidates(rows, asked, **limits).collect()}
    assert part == {k for k in expected if k[0] in ("t1", "t3")}


def test_links_from_counts_equal_brute_force(spark):
    rows = K.key_roles(_skewed_attributes(spark))
    best, targets = {}, {}
    for (ft, fc, tt, tc), score in _brute_force(rows.collect()).items():
        best[(ft, fc)] = max(score, best.get((ft, fc), 0))
        targets.setdefault((ft, fc), []).append(f"{tt}.{tc}")
    got = {(r.source_table, r.source_column): r for r in K.relationship_links(rows, hot_rows=3).collect()}
    assert {k: r.candidate_strength for k, r in got.items()} == best
    assert {k: (r.link_count, r.first_target) for k, r in got.items()} == {k: (len(t), min(t)) for k, t in targets.items()}


def test_a_key_of_any_size_keeps_its_links(spark):
    rows = K.key_roles(spark.range(1500).selectExpr(
        "concat('p', id) source_table", "'id' source_column", "1 ordinal_position", "'LongType()' physical_type", "false nullable")
        .union(spark.sql("SELECT 'f', 'f_id', 1, 'LongType()', false UNION ALL SELECT 'f', 'id', 2, 'LongType()', true")))
    assert K.relationship_candidates(rows).count() == 1500
    assert [(r.link_count, r.first_target) for r in K.relationship_links(rows).collect()] == [(1500, "p0.id")]


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, partitions):
    def run():
        r = K.key_roles(catalogue(spark, sf_dir), hot_rows=50)
        s = K.relationship_links(roles(spark, sf_dir), hot_rows=50)
        return (r.agg(F.sum(F.xxhash64("source_table", "source_column", "key_role").cast("decimal(38,0)"))).first()[0],
                s.agg(F.sum(F.xxhash64("source_table", "source_column", "candidate_strength", "candidate_conflict")
                            .cast("decimal(38,0)"))).first()[0])

    base, old = run(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert run() == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_synthetic_tables_have_the_declared_rates(spark):
    tables = synthetic_tables(spark, 20_000)
    holder, policy, claim = (tables[n] for n in ("policyholder", "policy", "claim"))
    assert holder.count() == policy.count() == claim.count() == 20_000
    orphans = policy.where("insured_party_id = 'PTY-999999'").count() / 20_000
    nulls = holder.where("party_type IS NULL").count() / 20_000
    assert 0.015 < orphans < 0.025 and 0.06 < nulls < 0.08
    assert policy.count() - policy.select("policy_id").distinct().count() == 100
    assert policy.repartition(3).orderBy("policy_number").first() == policy.orderBy("policy_number").first()


def test_wide_catalog_feeds_the_key_operators(spark):
    rows = wide_catalog(spark, 2_000)
    assert rows.count() == 40_000
    assert K.key_roles(rows).where("key_role = 'PRIMARY_KEY_CANDIDATE'").count() == 2_000
