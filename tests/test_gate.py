"""The release gate on runs that pass and on one that violates every check."""

from __spark_entry__ import queries


def test_every_check_can_fail(spark, sf_dir):
    rows = queries()["gate_failures"](spark, sf_dir).collect()
    assert len(rows) == 25 and not [r.check_name for r in rows if r.passed]


def test_a_sound_run_passes(spark, sf_dir):
    assert all(r.passed for r in queries()["gate_checks"](spark, sf_dir).collect())
