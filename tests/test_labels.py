"""The labelled columns: every field matches, and the ambiguous one is contradicted."""

import pytest
from pyspark.sql import functions as F

from catalograph.operators import keys as K
from catalograph.operators import report as E
from catalograph.plans import build
from checks.base import concepts, written

# Id, table, column, name, concept, domain, privacy, key role, target, route.
LABELS = [
    ("L001", "bronze_policy", "policy_id", "Policy Identifier", "Policy.Identifier", "Policy", "INTERNAL", "PRIMARY_KEY_CANDIDATE", None, "DATA_ARCHITECT"),
    ("L002", "bronze_policy", "policy_number", "Policy Number", "Policy.PolicyNumber", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L003", "bronze_policy", "policy_status", "Policy Status", "Policy.Status", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L004", "bronze_policy", "effective_date", "Policy Effective Date", "Policy.EffectiveDate", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L005", "bronze_policy", "expiration_date", "Policy Expiration Date", "Policy.ExpirationDate", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L006", "bronze_policy", "product_code", "Insurance Product Code", "Product.Code", "Shared", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L007", "bronze_policy", "insured_party_id", "Insured Party Identifier", "Party.Identifier", "Shared", "INTERNAL", "FOREIGN_KEY_CANDIDATE",
     "bronze_policyholder.party_id", "DATA_ARCHITECT"),
    ("L008", "bronze_policy", "source_updated_ts", "Source Updated Timestamp", "Technical.SourceUpdatedTimestamp", "Shared", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L009", "bronze_policyholder", "party_id", "Party Identifier", "Party.Identifier", "Shared", "INTERNAL", "PRIMARY_KEY_CANDIDATE", None, "DATA_ARCHITECT"),
    ("L010", "bronze_policyholder", "party_type", "Party Type", "Party.Type", "Shared", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L011", "bronze_policyholder", "display_name", "Display Name", None, "Shared", "PERSONAL_DATA", "NON_KEY", None, "PRIVACY_STEWARD"),
    ("L012", "bronze_policyholder", "contact_channel", "Contact Channel", None, "Shared", "INTERNAL", "NON_KEY", None, "DOMAIN_STEWARD"),
    ("L013", "bronze_policyholder", "source_updated_ts", "Source Updated Timestamp", "Technical.SourceUpdatedTimestamp", "Shared", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L014", "bronze_claim", "claim_id", "Claim Identifier", "Claim.Identifier", "Claims", "INTERNAL", "PRIMARY_KEY_CANDIDATE", None, "DATA_ARCHITECT"),
    ("L015", "bronze_claim", "policy_id", "Policy Identifier", "Policy.Identifier", "Policy", "INTERNAL", "FOREIGN_KEY_CANDIDATE",
     "bronze_policy.policy_id", "DATA_ARCHITECT"),
    ("L016", "bronze_claim", "loss_date", "Loss Date", "Claim.LossDate", "Claims", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L017", "bronze_claim", "claim_status", "Claim Status", "Claim.Status", "Claims", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L018", "bronze_claim", "claimed_amount", "Claimed Amount", "Claim.ClaimedAmount", "Claims", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L019", "bronze_claim", "source_updated_ts", "Source Updated Timestamp", "Technical.SourceUpdatedTimestamp", "Shared", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L020", "POLMAST", "POLNBR", "Policy Number", "Policy.PolicyNumber", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L021", "CLMMAST", "CLMSTS", "Claim Status", "Claim.Status", "Claims", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L022", "POLMAST", "EFFDT", "Policy Effective Date", "Policy.EffectiveDate", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L023", "policySource", "policyEffectiveDate", "Policy Effective Date", "Policy.EffectiveDate", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L024", "POLICY_SOURCE", "PLCY_NO", "Policy Number", "Policy.PolicyNumber", "Policy", "INTERNAL", "NON_KEY", None, "NONE"),
    ("L025", "CLMMAST", "EXPAMT", "EXPAMT", None, "Shared", "INTERNAL", "NON_KEY", None, "DOMAIN_STEWARD"),
    ("L026", "GENERIC_SOURCE", "FLD007", "FLD007", None, "Shared", "INTERNAL", "NON_KEY", None, "DOMAIN_STEWARD"),
]


def _frames(spark):
    labels = spark.createDataFrame(LABELS, "record_id string, source_table string, source_column string, "
                                           + ", ".join(f"expected_{f} string" for f in E.EVALUATED))
    attributes = spark.createDataFrame(
        [(r[1], r[2], i, "UNKNOWN", False) for i, r in enumerate(LABELS, 1)],
        "source_table string, source_column string, ordinal_position int, physical_type string, nullable boolean")
    context = build.RunContext(run_id="si_job_1")
    roles = written(K.key_roles(attributes), "roles")
    observed = build.attribute_observations(attributes, concepts(spark), context, F.current_timestamp(), roles=roles,
                                            store=written)
    return E.compare_labels(E.predictions(observed, K.relationship_links(roles)), labels)


@pytest.fixture(scope="module")
def compared(spark):
    return written(_frames(spark), "compared")


def test_labels_match_on_every_field(compared):
    summary = E.evaluation_summary(compared).first()
    exceptions = {(r.record_id, r.exception) for r in E.evaluation_exceptions(compared).collect()}
    assert exceptions == {("L025", "NAMING_CONTRADICTED")}
    assert summary.labelled_records == 26
    assert summary.semantic_classification_coverage == 1.0
    assert round(summary.ontology_resolution_coverage, 10) == 0.8461538462
    assert all(summary[f"{f}_rate"] == 1.0 for f in E.EVALUATED)


def test_no_labels_give_zero_rates(compared):
    summary = E.evaluation_summary(compared.limit(0)).first()
    assert summary.labelled_records == 0 and summary.domain_rate == 0.0
