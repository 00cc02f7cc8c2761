"""Privacy classes by ordered rules, the prohibited-evidence scan, the profile gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.small import sql_literal
from catalograph.operators.profile import quoted

# Order of restriction, prohibited column names, value sentinel.
RESTRICTION = {"INTERNAL": 0, "PERSONAL_DATA": 1, "SENSITIVE": 2, "RESTRICTED": 3}
# A name with too many readings is held at the strictest class of the observation contract.
LIMIT_CLASS = "SENSITIVE"
LIMIT_RULE = "NAME_LIMIT"
LIMIT_RATIONALE = "The name could not be read completely, so the strictest class holds until a steward decides."
PROHIBITED_COLUMNS = ("loss_narrative", "claim_narrative", "credentials", "connection_string")
SENTINEL_PREFIX = "FORBIDDEN_TEST_"


def classify_privacy(hypothesised: DataFrame, pack: dict, column: str = "source_column") -> DataFrame:
    """Add class, rationale and rule id to rows that carry name ``hypotheses``.

    Exceptions, then rules, in order; the first match of a hypothesis counts,
    and of all hypotheses the most restrictive (first on ties). The rules
    become one CASE per hypothesis, so no join or shuffle is involved. A name
    whose ``name_status`` is not OK gets the strictest class.
    """
    rules = [*pack.get("exceptions", []), *pack["rules"], pack["default"]]
    subject = {"expanded": "h.expanded", "raw": f"lower(`{column}`)"}
    cases = " ".join(f"WHEN {subject[r['match_on']]} RLIKE {sql_literal(r['pattern'])} THEN {i}"
                     for i, r in enumerate(rules[:-1]))

    def literals(values: list) -> str:
        return "array(" + ", ".join(sql_literal(v) for v in values) + ")"

    ranks = literals([RESTRICTION.get(r["privacy_class"], 3) for r in rules])
    first = f"CASE {cases} ELSE {len(rules) - 1} END" if cases else "0"
    ranked = (f"transform(transform(hypotheses, (h, i) -> named_struct('o', -i, 'r', {first})), "
              f"v -> named_struct('rank', element_at({ranks}, v.r + 1), 'o', v.o, 'r', v.r))")
    unread = F.coalesce(F.col("name_status") != "OK", F.lit(False)) if "name_status" in hypothesised.columns else F.lit(False)

    def chosen(field: str, held: str) -> Column:
        return F.when(unread, held).otherwise(F.expr(f"element_at({literals([r[field] for r in rules])}, __rule)"))

    return hypothesised.withColumn("__rule", F.expr(f"array_max({ranked}).r + 1")).withColumns({
        "privacy_class": chosen("privacy_class", LIMIT_CLASS),
        "privacy_rationale": chosen("rationale", LIMIT_RATIONALE),
        "privacy_rule_id": chosen("rule_id", LIMIT_RULE),
    }).drop("__rule")


def prohibited_columns(attributes: DataFrame) -> DataFrame:
    """Attributes whose name alone is prohibited, in any case."""
    return attributes.where(F.lower("source_column").isin(*PROHIBITED_COLUMNS))


def prohibited_values(df: DataFrame, table: str, prefix: str = SENTINEL_PREFIX) -> DataFrame:
    """Text columns in which any value starts with the sentinel: one scan, no values kept."""
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return df.limit(0).select(F.lit(table).alias("source_table"), F.lit("").alias("source_column"))
    wide = df.agg(*[F.bool_or(quoted(c).startswith(prefix)).alias(f"p{i}") for i, c in enumerate(texts)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("source_table"), F.lit(c).alias("source_column"),
                 F.col(f"p{i}").alias("hit")) for i, c in enumerate(texts)]))).where("hit").drop("hit")


def policy_violations(hits: DataFrame, run_id: str, source_system: str, created_at: Column) -> DataFrame:
    """Sanitized events for prohibited columns; structure only, never a value."""
    # Event content that downstream readers match on.
    event = {
        "evidence_class_attempted": "PROHIBITED_NARRATIVE",
        "violation_type": "PROHIBITED_EVIDENCE",
        "action_taken": "REJECTED_BEFORE_PROFILE",
        "sanitized_description": "Turned away unread; nothing of it was kept.",
        "routed_to": "PRIVACY_STEWARD",
    }
    return hits.select("source_table", "source_column").distinct().select(
        F.lit("1.0.0").alias("schema_version"), F.lit(run_id).alias("run_id"),
        F.lit("1.0.0").alias("artifact_version"), F.lit(source_system).alias("source_system"),
        "source_table", "source_column",
        *[F.lit(v).alias(k) for k, v in event.items()], created_at.alias("created_at"))


def internal_columns(classified: DataFrame) -> DataFrame:
    """Attributes that may be profiled: INTERNAL, not prohibited, name understood."""
    return classified.where(
        (F.col("privacy_class") == "INTERNAL") & ~F.lower("source_column").isin(*PROHIBITED_COLUMNS)
        & (F.col("name_status") == "OK"))
