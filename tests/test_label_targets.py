"""Labels with several targets match only if they name all of them."""

import pytest
from pyspark.sql import functions as F

from catalograph.operators import keys as K
from catalograph.operators import report as E
from catalograph.plans import build
from checks.base import concepts, written

TARGETS = [("all", "f", "a.id|b.id|c.id", True), ("unordered", "f", "c.id|a.id|b.id", True), ("part", "f", "a.id|b.id", False),
           ("first", "f", "a.id and 2 more", False), ("wrong", "f", "a.id|b.id|d.id", False), ("twice", "f", "a.id|b.id|b.id", False),
           ("more", "f", "a.id|b.id|c.id|d.id", False), ("none", "f", None, False), ("own", "g", None, True)]


def test_all_targets_are_compared(spark):
    rows = [("a", "id", 1, False), ("b", "id", 1, False), ("c", "id", 1, False), ("d", "name", 1, False),
            ("f", "f_id", 1, False), ("f", "id", 2, True), ("g", "g_id", 1, False)]
    attributes = spark.createDataFrame([(t, c, p, "LongType()", n) for t, c, p, n in rows],
                                       "source_table string, source_column string, ordinal_position int, physical_type string, nullable boolean")
    roles = written(K.key_roles(attributes), "target-roles")
    observed = build.attribute_observations(attributes, concepts(spark), build.RunContext(run_id="r"), F.current_timestamp(),
                                            roles=roles, store=written)
    labels = spark.createDataFrame([(i, t, "id" if t == "f" else "g_id", e) for i, t, e, _ in TARGETS],
                                   "record_id string, source_table string, source_column string, expected_relationship_target string")
    labels = labels.withColumns({f"expected_{f}": F.lit("x") for f in E.EVALUATED if f != "relationship_target"})
    found = E.compare_labels(E.predictions(observed, K.relationship_links(roles)), labels).collect()
    assert {r.record_id: r.relationship_target_match for r in found} == {i: m for i, _, _, m in TARGETS}
