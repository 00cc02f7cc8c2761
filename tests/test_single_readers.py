"""Relations that are planned for their readers instead of stored, and what the stored ones hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import shared
from catalograph.operators import report as E
from catalograph.operators import review as W
from checks import base, governance, names_and_keys, observed


def _stored():
    return {name for _, _, name in base._WRITTEN}


def test_documentation_decisions_and_a_queue_read_once_are_not_stored(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(base, "_WRITTEN", {})
    planned = governance.review_queue(spark, sf_dir).collect()
    governance.doc_recommendations(spark, sf_dir).count()
    assert not _stored() & {"documentation", "queue"}
    governance.decision_records(spark, sf_dir).count()
    assert "queue" in _stored() and not _stored() & {"documentation", "decisions"}
    assert sorted(planned, key=repr) == sorted(governance.review_queue(spark, sf_dir).collect(), key=repr)


def test_gate_and_counts_do_not_make_contexts(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(base, "_WRITTEN", {k: v for k, v in base._WRITTEN.items() if k[2] != "queue"})
    assert "sha2(" in governance.review_queue(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
    for query in (governance.gate_checks, governance.row_counts, governance.run_metrics, governance.queue_completeness):
        assert "sha2(" not in query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "queue" not in _stored()


def test_stored_observations_leave_out_what_all_rows_share(spark, sf_dir):
    whole = observed.observations(spark, sf_dir)
    stored = base.if_written(spark, sf_dir, "observations")
    assert not {"run_id", "created_at", "approval_state", "evidence_references"} & set(stored.columns)
    assert "rule_references" in stored.columns and whole.columns == observed.observations_plan(spark, sf_dir).columns
    first = whole.where("array_contains(evidence_references, concat('catalog_metadata:main.bronze.', source_table, '.', source_column))")
    assert first.count() == whole.count() == stored.count()


def _queue(spark):
    strings = [c for c in W.QUEUE_COLUMNS if c not in ("confidence_score", "evidence_coverage", "queued_at")]
    rows = spark.createDataFrame([("a", "OPEN", None), ("b", "OPEN", "x"), ("b", "OPEN", "y"), (None, "OPEN", "z"), (None, "OPEN", "z")],
                                 "queue_item_id string, queue_status string, assumptions string")
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(c).alias(c) for c in strings],
                       F.lit(0.5).alias("confidence_score"), F.lit(0.5).alias("evidence_coverage"),
                       F.lit("2026-01-01").cast("timestamp_ntz").alias("queued_at")).select(*W.QUEUE_COLUMNS)


def _events(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("z",)], "queue_item_id string")
    return rows.select("queue_item_id", F.lit("recommended_reviewer_role").alias("reviewer_role"), F.lit("APPROVED").alias("reviewer_decision"),
                       F.lit("fine").alias("reviewer_rationale"), F.lit(None).cast("string").alias("invalidation_impact"),
                       F.lit("2026-01-02").cast("timestamp_ntz").alias("decided_at"))


def test_decisions_meet_the_queue_once_with_its_fingerprint(spark):
    queue = _queue(spark)
    checked = W.check_decisions(_events(spark), queue)
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    fingerprint = queue.where("queue_item_id = 'a'").select(W.recommendation_fingerprint()).first()[0]
    found = sorted([(r.queue_item_id, r.queue_rows, r.recommendation_fingerprint, r.schema_version) for r in checked.collect()], key=repr)
    assert found == sorted([("a", 1, fingerprint, "schema_version")] * 2 + [("b", 2, None, None), (None, None, None, None), ("z", None, None, None)], key=repr)
    assert [r.recommendation_fingerprint for r in W.decision_records(checked).collect()] == [fingerprint] * 2
    # a record is made of the fingerprint: the text that it covers stays behind
    joined = W.decision_records(checked)._jdf.queryExecution().optimizedPlan().toString()
    assert "assumptions" not in joined[:joined.index("Join ")]


def test_newest_decisions_are_written_once_for_both_readers(spark, sf_dir):
    kept = []

    def store(frame, name):
        kept.append((name, frame.columns))
        return shared.written(frame, name)

    parts = governance.observations(spark, sf_dir), governance.documentation(spark, sf_dir), governance.decisions(spark, sf_dir)
    stored = E.publish_dictionary(*parts, store=store)
    assert kept == [("latest_decisions", ["queue_item_id", "reviewer_decision"])]
    assert sorted(stored.collect(), key=repr) == sorted(E.publish_dictionary(*parts).collect(), key=repr)


def test_routes_references_and_the_attribute_queue_do_not_store_the_observations(spark, sf_dir, monkeypatch):
    queries = governance.attribute_queue, names_and_keys.review_routes, names_and_keys.object_evidence
    whole = [query(spark, sf_dir).count() for query in queries]
    monkeypatch.setattr(base, "_WRITTEN", {k: v for k, v in base._WRITTEN.items() if k[2] != "observations"})
    assert [query(spark, sf_dir).count() for query in queries] == whole
    assert "observations" not in _stored()
