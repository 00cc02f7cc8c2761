"""Key roles, relationship candidates and per-table roll-ups.

A table's primary candidate is a minimum over its identifiers, so wide tables
need no window. Links come from name keys. What the dictionary says about a
foreign column (strength, conflict, number of links, first target) follows from
counts per key, so it is linear in the columns whatever the size of a key.
Pairs are only written out for the foreign columns that a caller asks for, and
then completely; ``relationship_members`` holds the links of all columns as the
two sides of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.skew import HOT_ROWS, hot_keys, lookup_join
from catalograph.functions.text import entity_text, identifier_signature, identifier_text, lead_of, may_identify, signature_of
from catalograph.operators.profile import quoted

PRIMARY, FOREIGN, NO_KEY = "PRIMARY_KEY_CANDIDATE", "FOREIGN_KEY_CANDIDATE", "NON_KEY"
# Strengths by evidence, and candidate texts.
EXACT_STRENGTH, SIGNATURE_STRENGTH, CONFLICT_STRENGTH = 0.9, 0.85, 0.55
IDENTIFIER_STRENGTH, PLAIN_STRENGTH = 0.5, 0.4
CONFLICT_TEXT = "The types of the two columns do not fit together."
# Foreign rows of one match key that one join task handles.
FOREIGN_PER_SALT = 1_000_000


def single_key_role(table: Column, column: Column) -> Column:
    """Role of one column without knowledge of its table's other columns."""
    signature = identifier_signature(column)
    entity = entity_text(table)
    aligned = (entity != "") & (F.substring_index(signature, " ", 1) == F.substring_index(entity, " ", -1))
    return F.when(signature.isNull(), NO_KEY).when(aligned, PRIMARY).otherwise(FOREIGN)


def key_roles(attributes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``key_role`` (and the signature) to every attribute.

    Per table one primary candidate among the identifiers: aligned with the
    table name first, then non-null, ordinal, name; the others are foreign. Only
    names that may be identifiers are cut, grouped and joined.
    """
    column = F.col("source_column")
    signature, entity = F.col("signature"), F.col("entity")
    cut = attributes.where(may_identify(column)).withColumn("text", identifier_text(column))
    marked = cut.withColumn("signature", signature_of(F.col("text")))
    aligned = (F.col("lead") == entity) | (
        (entity != "") & (F.substring_index(signature, " ", 1) == F.substring_index(entity, " ", -1)))
    order = F.struct((~aligned).alias("a"), F.col("nullable").alias("n"),
                     F.col("ordinal_position").alias("o"), column.alias("c"))
    primary = (marked.withColumns({"lead": lead_of(F.col("text")), "entity": F.when(
        signature.isNotNull(), entity_text(F.col("source_table")))})
               .groupBy("source_table").agg(F.min(F.when(signature.isNotNull(), order))["c"].alias("primary_column")))
    role = (F.when(signature.isNull(), NO_KEY)
            .when(column == F.col("primary_column"), PRIMARY).otherwise(FOREIGN))
    roles = (lookup_join(marked.drop("text"), primary, ["source_table"], "columns", hot_rows=hot_rows,
                         hot=hot_keys(attributes, ["source_table"], hot_rows))
             .withColumn("key_role", role).drop("primary_column"))
    others = attributes.where(~may_identify(column)).withColumns({
        "signature": F.lit(None).cast("string"), "key_role": F.lit(NO_KEY)})
    return roles.unionByName(others)


def _match_keys(frame: DataFrame) -> DataFrame:
    """One row per name key of an identifier: its signature and its lower-case name."""
    lower = F.lower("source_column")
    return frame.select(
        "source_table", "source_column", "physical_type", "signature", "key_role", lower.alias("lower_name"),
        F.explode(F.array(F.concat(F.lit("S:"), F.col("signature")), F.concat(F.lit("N:"), lower)))
        .alias("match_key"))


def relationship_candidates(roles: DataFrame, columns: DataFrame | None = None,
                            foreign_per_salt: int = FOREIGN_PER_SALT) -> DataFrame:
    """Every foreign x primary pair of equal name or signature in different tables.

    ``columns`` (source_table, source_column) limits the foreign side; what it
    names is expanded completely. A pair joins once: through its signature, or
    through the equal name when the signatures differ. The primary side of a key
    with many foreign rows is replicated over salts so those rows spread over tasks.
    """
    asked = roles.where(F.col("key_role") == FOREIGN)
    if columns is not None:
        asked = asked.join(columns.select("source_table", "source_column").distinct(), ["source_table", "source_column"], "left_semi")
    foreign, primary = _match_keys(asked), _match_keys(roles.where(F.col("key_role") == PRIMARY))
    salts = F.ceil(F.col("sources") / foreign_per_salt).cast("int")
    # at most rows / foreign_per_salt keys need salts, so that list is broadcast
    salted = F.broadcast(foreign.groupBy("match_key").agg(F.count(F.lit(1)).alias("sources"))
                         .where(salts > 1).select("match_key", salts.alias("salts")))

    def spread(frame: DataFrame, salt: Column) -> DataFrame:
        return frame.join(salted, "match_key", "left").withColumn("salt", salt).drop("salts")

    one = F.coalesce("salts", F.lit(1))
    f = spread(foreign, F.pmod(F.xxhash64("source_table", "source_column"), one).cast("int")).select(
        "match_key", "salt", F.col("source_table").alias("from_table"), F.col("source_column").alias("from_column"),
        F.col("physical_type").alias("from_type"), F.col("signature").alias("from_signature"),
        F.col("lower_name").alias("from_lower"))
    p = spread(primary, F.explode(F.sequence(F.lit(0), one - 1))).select(
        "match_key", "salt", F.col("source_table").alias("to_table"), F.col("source_column").alias("to_column"),
        F.col("physical_type").alias("to_type"), F.col("signature").alias("to_signature"),
        F.col("lower_name").alias("to_lower"))
    pairs = f.join(p, ["match_key", "salt"]).where(
        (F.col("from_table") != F.col("to_table"))
        & (F.col("match_key").startswith("S:") | (F.col("from_signature") != F.col("to_signature"))))
    return _describe(pairs)


def _describe(pairs: DataFrame) -> DataFrame:
    exact = F.col("from_lower") == F.col("to_lower")
    compatible = F.col("from_type") == F.col("to_type")
    return pairs.select(
        "from_table", "from_column", "to_table", "to_column",
        F.lit("FOREIGN_KEY").alias("relationship_type"),
        F.when(exact, "Both columns bear the same name.")
        .otherwise("The ends of both names agree.").alias("evidence_description"),
        F.lit(True).alias("naming_overlap"),
        F.when(exact, 1.0).otherwise(0.9).alias("naming_strength"),
        compatible.alias("type_compatible"),
        F.when(exact & compatible, EXACT_STRENGTH)
        .when((F.col("from_signature") == F.col("to_signature")) & compatible, SIGNATURE_STRENGTH)
        .otherwise(CONFLICT_STRENGTH).alias("confidence_score"),
        F.when(compatible, "Names and types agree.")
        .otherwise("Names agree, types do not.").alias("confidence_reason"),
        F.when(~compatible, CONFLICT_TEXT).alias("contradictions"))


def relationship_members(roles: DataFrame, conflicting: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All links of all columns, complete but not multiplied: every column on every name key that links it.

    A foreign column (side FROM) and a primary candidate (side TO) form a link
    where they share a match key and their tables differ; keys ``N:`` (equal
    names) link only columns whose signatures differ, since the key ``S:`` has the
    others. Every row takes part in at least one link, or with ``conflicting`` in
    one between different types. Linear in the columns whatever the size of a key.
    """
    keyed = _match_keys(roles.where(F.col("key_role").isin(PRIMARY, FOREIGN))).withColumn(
        "side", F.when(F.col("key_role") == FOREIGN, "FROM").otherwise("TO"))
    # the lowest and highest table tell whether a group has any other table
    groups = keyed.groupBy("match_key", "side", "physical_type", "signature").agg(
        F.min("source_table").alias("low"), F.max("source_table").alias("high"))
    # one entry for each side, signature and type of a key: few, whatever the number of columns
    per_key = groups.groupBy("match_key").agg(
        F.collect_list(F.struct("side", "physical_type", "signature", "low", "high")).alias("groups"))
    joined = lookup_join(keyed, per_key, ["match_key"], "rows", how="inner", hot_rows=hot_rows,
                         hot=hot_keys(keyed, ["match_key"], hot_rows))

    def met(g: Column) -> Column:
        linked = ((g["side"] != F.col("side"))
                  & (F.col("match_key").startswith("S:") | (g["signature"] != F.col("signature")))
                  & ((g["low"] != F.col("source_table")) | (g["high"] != F.col("source_table"))))
        return linked & (g["physical_type"] != F.col("physical_type")) if conflicting else linked

    return joined.where(F.exists("groups", met)).select(
        "match_key", "side", "source_table", "source_column", "physical_type", "signature")


def relationship_links(roles: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per foreign column: best strength, conflict, number of links and first target, without pairs.

    Primary candidates are counted per name key, signature and type, with the
    two smallest of each. A foreign column adds these counts up; its own table
    has one primary, whose own match is left out.
    """
    primary = roles.where(F.col("key_role") == PRIMARY)
    group = ["match_key", "signature", "physical_type"]
    members = _match_keys(primary).select(*group, F.struct(
        F.concat_ws(".", "source_table", "source_column").alias("target"), "source_table").alias("m"))
    first = members.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first"))
    second = (members.join(first, group).where("m <> first").groupBy(*group).agg(F.min("m").alias("second")))
    # one entry for each signature and type of a key: few, whatever the number of targets
    targets = first.join(second, group, "left").groupBy("match_key").agg(F.collect_list(F.struct(
        "signature", "physical_type", "n", "first", "second")).alias("groups"))
    own = primary.groupBy("source_table").agg(
        F.first("signature").alias("own_signature"), F.first(F.lower("source_column")).alias("own_lower"),
        F.first("physical_type").alias("own_type"))
    foreign = roles.where(F.col("key_role") == FOREIGN)
    with_own = lookup_join(foreign, own, ["source_table"], "rows", hot_rows=hot_rows,
                           hot=hot_keys(foreign, ["source_table"], hot_rows))
    lower = F.lower("source_column")
    exploded = with_own.select(
        "source_table", "source_column", "physical_type", "signature", "own_type", "own_signature",
        F.explode(F.array(
            F.struct(F.lit("S").alias("k"), F.concat(F.lit("S:"), F.col("signature")).alias("match_key"),
                     (F.col("signature") == F.col("own_signature")).alias("own")),
            F.struct(F.lit("N").alias("k"), F.concat(F.lit("N:"), lower).alias("match_key"),
                     (lower == F.col("own_lower")).alias("own")))).alias("m"),
    ).select("source_table", "source_column", "physical_type", "signature", "own_type", "own_signature", "m.*")
    met = lookup_join(exploded, targets, ["match_key"], "rows", how="inner", hot_rows=hot_rows,
                      hot=hot_keys(_match_keys(foreign), ["match_key"], hot_rows))

    def others(g: Column) -> Column:
        is_own = F.col("own") & (g["signature"] == F.col("own_signature")) & (g["physical_type"] == F.col("own_type"))
        target = F.when(is_own & (g["first"]["source_table"] == F.col("source_table")), g["second"]["target"])
        return F.struct(
            (g["n"] - F.when(is_own, 1).otherwise(0)).alias("n"), (g["physical_type"] == F.col("physical_type")).alias("typed"),
            # an equal name adds links only where the signatures differ
            ((F.col("k") == "S") | (g["signature"] != F.col("signature"))).alias("counts"),
            F.coalesce(target, g["first"]["target"]).alias("target"))

    live = F.filter(F.transform("groups", others), lambda g: g["n"] > 0)
    zero = F.lit(0).cast("long")
    counted = met.withColumn("live", live).where(F.size("live") > 0).withColumns({
        "any_targets": F.aggregate("live", zero, lambda a, g: a + g["n"]),
        "typed_targets": F.aggregate(F.filter("live", lambda g: g["typed"]), zero, lambda a, g: a + g["n"]),
        "links": F.aggregate(F.filter("live", lambda g: g["counts"]), zero, lambda a, g: a + g["n"]),
        "target": F.array_min(F.transform(F.filter("live", lambda g: g["counts"]), lambda g: g["target"]))})
    score = (F.when((F.col("k") == "N") & (F.col("typed_targets") > 0), EXACT_STRENGTH)
             .when(F.col("typed_targets") > 0, SIGNATURE_STRENGTH).otherwise(CONFLICT_STRENGTH))
    return counted.groupBy("source_table", "source_column").agg(
        F.max(score).alias("candidate_strength"),
        F.max(F.col("any_targets") > F.col("typed_targets")).alias("candidate_conflict"),
        F.sum("links").alias("link_count"), F.min("target").alias("first_target"))


def relationship_evidence() -> Column:
    """The links of a foreign column as one text, from its count and first target."""
    more = F.when(F.col("link_count") > 1, F.concat(F.lit(" and "), (F.col("link_count") - 1).cast("string"), F.lit(" more")))
    return F.when(F.col("link_count") > 0, F.concat(
        F.lit("Inferred relationship: "), F.concat_ws(".", "source_table", "source_column"), F.lit(" -> "),
        F.col("first_target"), F.coalesce(more, F.lit(""))))


def relationship_strength(signature: Column, candidate_strength: Column) -> Column:
    """Best candidate, else whether the name is an identifier at all."""
    return F.coalesce(candidate_strength,
                      F.when(signature.isNotNull(), IDENTIFIER_STRENGTH).otherwise(PLAIN_STRENGTH))


def value_overlap(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Share of distinct child values that the parent has; both sides distinct first."""
    c = child.select(quoted(child_column).alias("value")).dropna().distinct()
    p = parent.select(quoted(parent_column).alias("value")).dropna().distinct().withColumn("hit", F.lit(1))
    return c.join(p, "value", "left").agg(
        F.count(F.lit(1)).alias("child_values"), F.count("hit").alias("matched_values"),
        (F.count("hit") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("overlap_ratio"))


def object_rollup(attributes: DataFrame) -> DataFrame:
    """Per table: column count, most frequent domain, mean score, strictest privacy."""
    rank = (F.when(F.col("privacy_class") == "INTERNAL", 0).when(F.col("privacy_class") == "PERSONAL_DATA", 1)
            .when(F.col("privacy_class") == "SENSITIVE", 2).otherwise(3))
    per_domain = attributes.groupBy("source_table", "domain").agg(
        F.count(F.lit(1)).alias("n"), F.sum("confidence_score").alias("score"),
        F.max(F.struct(rank.alias("r"), F.col("privacy_class").alias("c"))).alias("strictest"),
        F.sum(F.coalesce(F.size("evidence_references"), F.lit(0))).alias("references"))
    rolled = per_domain.groupBy("source_table").agg(
        F.sum("n").alias("column_count"),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("domain").alias("d")))["d"].alias("proposed_domain"),
        (F.sum("score") / F.sum("n")).alias("mean_score"),
        F.max("strictest").alias("strictest"), F.sum("references").alias("evidence_count"))
    personal = F.col("strictest.r") > 0
    return rolled.select(
        "source_table", F.lit("TABLE").alias("object_type"), "column_count", "proposed_domain",
        F.round(F.col("mean_score").cast("decimal(20,12)"), 4).cast("double").alias("proposed_domain_confidence"),
        F.when(personal, "PERSONAL_DATA").otherwise("INTERNAL").alias("privacy_class"),
        F.col("strictest.c").alias("max_privacy_class"),
        F.when(personal, "One or more column names point to personal data.")
        .otherwise("No column name points to personal data.").alias("privacy_rationale"),
        F.when(personal, "PRIVACY_STEWARD").alias("reviewer_role"), "evidence_count")


def object_evidence(attributes: DataFrame) -> DataFrame:
    """Evidence references per table, one row each in column order.

    Rows instead of one array per table, so a very wide table is not gathered
    into one row.
    """
    return attributes.select("source_table", "ordinal_position",
                             F.posexplode("evidence_references").alias("position", "evidence_reference"))
