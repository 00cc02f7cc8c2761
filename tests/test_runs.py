"""As-of joins, attribute history, dictionary segmentation and pack choice against plain versions."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from catalograph.operators import asof, history, naming

DAY = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("span", [None, "1", "moment"])
def test_asof_equals_searching(spark, span):
    rng = random.Random(4)
    key = lambda: rng.choice(["hot", "hot", "b", "c", None])
    when = lambda: DAY + dt.timedelta(days=rng.randrange(400))
    left = [(k, key(), rng.choice([when(), when(), None])) for k in range(300)] + [(7, "hot", DAY)] * 2
    right = {(key(), when()): rng.choice([None, 1, 2, 3]) for _ in range(120)}
    found = asof.asof_join(spark.createDataFrame(left, "moment_id int, held string, row timestamp_ntz"),
                           spark.createDataFrame([(k, t, v, v) for (k, t), v in right.items()], "held string, since timestamp_ntz, value int, span int"),
                           ["held"], "row", "since", ["value", "since"], span and F.expr(span))
    def plain(k, t):
        best = max((s for key_, s in right if key_ == k and t and s <= t), default=None)
        return (right[k, best], best) if best else (None, None)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(((i, k, t, *plain(k, t)) for i, k, t in left), key=repr)


def test_history_of_repeated_and_unordered_runs(spark):
    rng = random.Random(6)
    runs = [(f"r{k}", DAY + dt.timedelta(hours=k // 2)) for k in range(40)]
    seen = [(r, t, rng.choice(["A", "A", "A", "B", None]), rng.random() < .5) for r, _ in runs for t in ("x", "y") if rng.random() < .8]
    rows = seen + rng.sample(seen, 20)
    rng.shuffle(rows)
    shuffled = runs + [(r, at + dt.timedelta(days=9)) for r, at in runs[:5]]
    rng.shuffle(shuffled)
    got = history.attribute_history(spark.createDataFrame(rows, "run_id string, t string, s string, flag boolean"),
                                    spark.createDataFrame(shuffled, "run_id string, created_at timestamp_ntz"), ["t"], ["s"])
    number = {r: k + 1 for k, (r, _) in enumerate(sorted(runs, key=lambda x: (x[1], x[0])))}
    want = []
    for t in ("x", "y"):
        states = {number[r]: s for r, u, s, _ in seen if u == t}
        k = 1
        while k <= 40:
            if k in states:
                end = k
                while end + 1 in states and states[end + 1] == states[k]:
                    end += 1
                want.append((t, states[k], k, end, end - k + 1))
                k = end
            k += 1
    assert sorted(map(repr, ((r.t, r.s, r.first_number, r.last_number, r.run_count) for r in got.collect()))) == sorted(map(repr, want))
    for k in (1, 17, 40):
        at = {(r.t, r.s) for r in history.state_as_of(got, k, ["t", "s"]).collect()}
        assert at == {(t, s) for r, t, s, _ in seen if number[r] == k}


def test_breaking_changes_between_any_two_runs(spark):
    schema = "run_id string, c string, field_type string, const_value string, enum_values array<string>, required boolean, closed boolean"
    rows = [("r1", "a", "int", None, ["x", "y"], False, False), ("r2", "a", "int", None, ["x"], False, False),
            ("r3", "a", "string", None, ["x"], True, False), ("r1", "b", "int", None, None, False, False)]
    found = history.attribute_history(spark.createDataFrame(rows, schema), spark.createDataFrame(
        [("r3", DAY + dt.timedelta(2)), ("r1", DAY), ("r2", DAY + dt.timedelta(1))], "run_id string, created_at timestamp_ntz"),
        ["c"], ["field_type", "const_value", "enum_values", "required", "closed"])
    changes = lambda a, b: {(r.c, r.finding) for r in history.changes_between(found, a, b, ["c"]).collect()}
    assert changes(1, 2) == {("a", "enum values were removed"), ("b", "property was removed")}
    assert changes(2, 3) == {("a", "type changed from int to string"), ("a", "optional property became required")}
    assert changes(3, 3) == set()


def test_segments_equal_the_greedy_pattern(spark):
    rng = random.Random(8)
    tokens = {"".join(rng.choice("ABC") for _ in range(rng.randrange(1, 5))) for _ in range(25)} | {"P+", "É"}
    parts = {"".join(rng.choice("ABCD") for _ in range(rng.randrange(1, 12))) for _ in range(300)} | {"P+É", "ÉP", "A" * 40}
    pattern = re.compile("|".join(map(re.escape, sorted(tokens, key=lambda t: (-len(t), t)))))
    want = {}
    for p in parts:
        cut = pattern.findall(p)
        want[p] = cut if "".join(cut) == p else [p]
    found = naming.dictionary_segments(spark.createDataFrame([(p.lower(),) for p in parts], "part string"),
                                       spark.createDataFrame([(t,) for t in tokens], "token string"))
    assert {r.part: r.tokens for r in found.collect()} == want
    assert {r.part: r.tokens for r in naming.dictionary_segments(found, spark.createDataFrame([], "token string")).collect()} == {p: [p] for p in parts}


def test_a_hundred_thousand_tokens(spark):
    tokens = spark.range(100_000).select(F.concat(F.lit("T"), F.col("id").cast("string"), F.lit("X")).alias("token"))
    names = spark.range(2_000).select(F.concat(F.lit("t"), F.col("id"), F.lit("xt"), F.col("id") + 5, F.lit("x")).alias("source_column"))
    found = naming.name_tokens(names, tokens)
    assert found.where("size(tokens) = 2").count() == 2_000


def test_packs_equal_trying_all(spark):
    rng = random.Random(3)
    packs = [(rng.choice("np"), f"pack{k % 23}", f"{k}", rng.sample(["*", "A", "b"], rng.randrange(1, 3)), rng.sample(["*", "snake", "Camel"], rng.randrange(1, 3)),
              rng.randrange(3), f"2024-0{rng.randrange(1, 5)}-01") for k in range(60)]
    asked = [(c, s, n, d) for c in ("n", "p", "z") for s in ("a", "B", "*", "q") for n in ("SNAKE", None, "other")
             for d in (None, "2023-01-01", "2024-02-15", "2024-04-01")]
    found = naming.resolve_packs(spark.createDataFrame(asked, "capability string, source_system string, naming_convention string, as_of string"),
                                 spark.createDataFrame(packs, "capability string, pack_id string, pack_version string, source_systems array<string>, "
                                                              "naming_conventions array<string>, priority int, effective_date string"))
    want = set()
    for c, s, n, d in asked:
        fit = []
        for pc, i, v, ss, ns, p, e in packs:
            ss, ns = [x.lower() for x in ss], [x.lower() for x in ns]
            if pc == c and (s.lower() in ss or "*" in ss) and (n is None or n.lower() in ns or "*" in ns) and (d is None or e <= d):
                fit.append(((s.lower() in ss and s != "*", n is not None and n.lower() in ns, p, e), i, v))
        top = [f for f in fit if f[0] == max(f[0] for f in fit)]
        want.add((c, s, n, d, "NO_PACK" if not top else "RESOLVED" if len(top) == 1 else "AMBIGUOUS", top[0][1] if len(top) == 1 else None,
                  top[0][2] if len(top) == 1 else None, ",".join(sorted(f[1] for f in top)) if len(top) > 1 else None))
    got = {(*r[:3], r.as_of and str(r.as_of), *r[4:]) for r in found.collect()}
    assert got == want
