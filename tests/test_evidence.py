"""Value links, mergeable profiles, frequent values, hash trees and globs against plain versions."""

import fnmatch
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalograph.functions.shared import written
from catalograph.operators import globs, hashtree, heavy, inclusion, profile_state
from catalograph.operators import knowledge as G


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_links_by_value_equal_sets(spark):
    rng = random.Random(2)
    rows = {t: [(rng.choice([None, *range(6)]), rng.choice([None, "a", "b", "x" * 90, "x" * 91]), rng.random() < .5, [1]) for _ in range(n)]
            for t, n in (("one", 30), ("two", 4), ("none", 0))}
    tables = {t: spark.createDataFrame(r, "`i d` int, text string, flag boolean, list array<int>") for t, r in rows.items()}
    tables["wide"] = spark.createDataFrame([tuple(range(70))], ", ".join(f"c{i} long" for i in range(70)))
    held = {(t, c): {r[k] for r in own if r[k] is not None} for t, own in rows.items() for k, c in enumerate(("i d", "text", "flag"))}
    held |= {("wide", f"c{i}"): {i} for i in range(70)}
    want = {(*a, *b): (len(x), len(y), len(x & y)) for a, x in held.items() for b, y in held.items()
            if a != b and {v for v in x & y if type(v) is type(next(iter(x)))}}
    want = {k: v for k, v in want.items() if (k[1] == "flag") == (k[3] == "flag")}
    found = inclusion.value_links(tables).collect()
    assert {(r[0], r[1], r[2], r[3]): (r.child_values, r.parent_values, r.matched_values) for r in found} == want and len(found) == len(want)


def test_links_by_value_find_the_keys_of_the_tables(spark, sf_dir):
    names = ("lineitem", "orders", "documents", "labels", "customer")
    found = inclusion.value_links({n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}).where("is_inclusion")
    links = {(r.child_column, r.parent_column) for r in found.collect()}
    assert {("l_orderkey", "o_orderkey"), ("o_custkey", "c_custkey"), ("doc_id", "doc_id")} <= links
    candidates = spark.createDataFrame([("lineitem", "l_orderkey", "orders", "o_orderkey"), ("labels", "toxic", "orders", "gone")],
                                       "from_table string, from_column string, to_table string, to_column string")
    assert {r.from_column: r.overlap_ratio for r in inclusion.with_overlap(candidates, found).collect()} == {"l_orderkey": 1.0, "toxic": 0.0}


def test_only_the_new_partition_is_read(spark, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_tax", "l_returnflag", F.year("l_shipdate").alias("year"))
    lines.write.partitionBy("year").parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    years = [str(r.year) for r in stored.select("year").distinct().collect()]
    columns = ["l_orderkey", "l_tax", "l_returnflag"]
    first = written(profile_state.updated(profile_state.partition_states(stored.limit(0), columns, F.col("year")),
                                          stored, columns, "year", years[:-1]), "states")
    fresh = profile_state.updated(first, stored, columns, "year", years)
    scan = next(line for line in _plan(fresh).splitlines() if "PartitionFilters" in line)
    assert years[-1] in scan.split("PartitionFilters")[1] and not any(y in scan.split("PartitionFilters")[1].split("]")[0] for y in years[:-1])
    got = {r.source_column: r for r in profile_state.statistics(profile_state.merged(first.unionByName(fresh))).collect()}
    whole = {r.source_column: r for r in profile_state.statistics(profile_state.merged(
        profile_state.partition_states(stored, columns, F.lit("all")))).collect()}
    for c in columns:
        assert got[c][1:3] == whole[c][1:3] and got[c][4:6] == whole[c][4:6]
        assert abs(got[c].distinct_count - stored.select(c).distinct().count()) <= 0.05 * got[c].distinct_count
    below = stored.where(F.col("l_orderkey") < got["l_orderkey"].median).count() / stored.count()
    assert abs(below - 0.5) < 0.05
    assert profile_state.new_partitions(first.unionByName(fresh), years) == []


@pytest.mark.parametrize("tracked", [16, 64, 2_048])
def test_frequent_values_are_exact(spark, tracked):
    rng = random.Random(5)
    rows = [(int(rng.paretovariate(0.7)), rng.randrange(4_000), rng.choice("aab"), None) for _ in range(8_000)]
    frame = spark.createDataFrame(rows, "skewed long, flat long, few string, empty string").repartition(5)
    found = heavy.heavy_hitters(frame, ["skewed", "flat", "few", "empty"], 10, tracked)
    got = {(r.source_column, r.position): (r.value, r.n) for r in found.collect()}
    want = {}
    for k, c in enumerate(("skewed", "flat", "few")):
        ranked = sorted(((str(v), n) for v, n in Counter(r[k] for r in rows).items()), key=lambda x: (-x[1], x[0]))
        want |= {(c, i + 1): x for i, x in enumerate(ranked[:10])}
    assert got == want


def test_summaries_merge(spark):
    frame = spark.range(5_000).select((F.col("id") % 9).alias("v"))
    both = heavy.summaries(frame.where("v < 5"), ["v"], 64).unionByName(heavy.summaries(frame.where("v >= 4"), ["v"], 64))
    merged = heavy.merged_summaries(both, 64).selectExpr("explode(approx_top_k_estimate(summary, 1)) AS top").select("top.*").first()
    assert merged.item == "4" and merged["count"] == 2 * frame.where("v = 4").count()


def test_trees_lead_to_the_changed_buckets(spark, tmp_path):
    before = spark.range(4_000).select("id", (F.col("id") % 7).cast("string").alias("v"), F.lit(1.5).alias("w"))
    before = before.union(before.where("id < 10"))
    after = before.where("id <> 77").withColumn("v", F.when(F.col("id") == 5, None).otherwise(F.col("v"))).union(
        spark.sql("SELECT 9000L, 'new', 0.5D")).union(before.where("id = 6"))
    names = {}
    for name, frame in (("a", before), ("b", after)):
        hashtree.bucketed(frame, ["id"], 8).write.partitionBy(hashtree.BUCKET).parquet(str(tmp_path / name))
        names[name] = spark.read.parquet(str(tmp_path / name))
    a, b = names["a"], names["b"]
    trees = [written(hashtree.tree(x, ["id", "v", "w"], 8), "tree") for x in (a, b)]
    assert trees[0].count() == 1 + 16 + 256 and hashtree.changed_buckets(trees[0], trees[0], 8) == []
    buckets = hashtree.changed_buckets(*trees, 8)
    ids = spark.createDataFrame([(i,) for i in (77, 5, 6, 9000)], "id long")
    assert buckets == sorted({r[0] for r in ids.select(hashtree.key_bucket(["id"], 8)).collect()})
    found = hashtree.changed_rows(a, b, ["id"], ["id", "v", "w"], buckets)
    assert {(r.id, r.status) for r in found.collect()} == {(77, "LOST"), (5, "CHANGED"), (6, "CHANGED"), (9000, "ADDED")}
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in _plan(found).splitlines() if "PartitionFilters: [" in line]
    assert filters and all(hashtree.BUCKET in f for f in filters)
    assert hashtree.changed_rows(a, b, ["id"], ["id", "v", "w"], []).isEmpty()


def test_globs_equal_trying_all(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("ab_%\\c") for _ in range(n))
    names = {text(rng.randrange(0, 9)) for _ in range(300)}
    patterns = {"".join(rng.choice(["*", "?", "a", "b", "_", "%", "c"]) for _ in range(rng.randrange(0, 6))) for _ in range(200)} | {"*", "", "??", "A*"}
    found = globs.matching_names(spark.createDataFrame([(n,) for n in names], "name string"),
                                 spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    rows = [(r.name, r.pattern) for r in found.collect()]
    want = {(n, p) for n in names for p in patterns if fnmatch.fnmatchcase(n, p.lower().replace("[", "[[]")) and p}
    assert {r for r in rows if r[1]} == want and len(rows) == len(set(rows))
    plan = _plan(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_many_patterns_take_the_salted_path(spark):
    rng = random.Random(4)
    text = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    names = spark.createDataFrame([(n,) for n in {"stg" + text("abc", rng.randrange(0, 6)) for _ in range(200)}], "name string")
    patterns = spark.createDataFrame([(p,) for p in {"stg*", "*", "???"} | {text("abst*?", 3) for _ in range(60)}], "pattern string")
    few = globs.matching_names(names, patterns)
    many = globs.matching_names(names, patterns, few_patterns=1, names_per_salt=7)
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() > 200


def test_no_task_takes_all_names_of_a_run(spark):
    names = spark.range(2_000).select(F.concat(F.lit("stg_"), "id").alias("name"))
    found = globs.matching_names(names, spark.createDataFrame([("stg*",), ("*",)], "pattern string"))
    # patterns go to the names: a join by run or salt would send all names of a run to one task
    joins = [line for line in _plan(found).splitlines() if "Join" in line and ("[run#" in line or "[salt#" in line)]
    assert joins and not [line for line in joins if "SortMergeJoin" in line and "LeftOuter" not in line]
    assert found.count() == 4_000


def test_ten_thousand_patterns(spark):
    names = spark.range(3_000).select(F.concat(F.lit("tab_"), F.hex(F.xxhash64("id"))).alias("source_table"), F.lit("col").alias("source_column"))
    patterns = spark.range(10_000).select(F.lit("ATTRIBUTE").alias("pattern_type"), F.concat(
        F.lit("tab_*"), F.substring(F.hex(F.xxhash64("id")), 3, 9), F.lit("*")).alias("source_object_pattern"),
        F.lit("c?l").alias("source_attribute_pattern"), F.lit(0.5).alias("expected_confidence"))
    found = G.match_patterns(names, patterns)
    assert found.where("cots_availability = 'AVAILABLE'").count() == 3_000
