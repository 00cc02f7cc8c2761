"""Row-scale quality checks; each returns the violating values or counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.operators.profile import quoted

# Issues that a data architect resolves.
ARCHITECT_ISSUES = ("DUPLICATE_IDENTIFIER", "MISSING_PRIMARY_KEY", "ORPHAN_FOREIGN_KEY",
                    "RELATIONSHIP_TYPE_MISMATCH")
DATE_RANGE = ("1900-01-01", "9999-12-31")
AMOUNT_RANGE = ("0.00", "9999999999.99")


def _per_column(df: DataFrame, columns: list[str], measures: dict) -> DataFrame:
    """One aggregate for all columns and measures, unpivoted to a row per column."""
    wide = df.agg(*[make(quoted(c)).alias(f"{m}{i}")
                    for i, c in enumerate(columns) for m, make in measures.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("source_column"), *[F.col(f"{m}{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)])))


def null_or_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null and empty-string counts per column, and whether either occurs."""
    counts = _per_column(df, columns, {
        "null_rows": lambda c: F.count_if(c.isNull()),
        "empty_rows": lambda c: F.count_if(c.cast("string") == ""),
    })
    return counts.withColumn("has_issue", (F.col("null_rows") + F.col("empty_rows")) > 0)


def _usable(df: DataFrame, column: str) -> DataFrame:
    c = quoted(column)
    return df.where(c.isNotNull() & (c.cast("string") != "")).select(c.alias("value"))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Identifier values on more than one row; null and empty are not identifiers."""
    return (_usable(df, column).groupBy("value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def missing_primary_key(df: DataFrame, inventory: DataFrame, table: str) -> DataFrame:
    """Nullable columns of the table that hold no value at all."""
    filled = _per_column(df, df.columns, {"filled_rows": lambda c: F.count(c)})
    columns = inventory.where((F.col("source_table") == table) & F.col("nullable"))
    return columns.join(filled.where(F.col("filled_rows") == 0), "source_column").select(
        "source_table", "source_column", "filled_rows")


def orphan_values(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values that no parent row has, as text.

    The child is reduced to distinct values before the join, so a value on many
    rows is one row of the shuffle.
    """
    values = child.select(quoted(child_column).alias("value")).dropna().distinct()
    parents = parent.select(quoted(parent_column).alias("value"))
    return values.join(parents, "value", "left_anti").select(F.col("value").cast("string").alias("value"))


def relationship_type_mismatches(candidates: DataFrame, inventory: DataFrame) -> DataFrame:
    """Candidates whose two columns have different physical types."""
    types = inventory.select("source_table", "source_column", "physical_type")
    child = types.toDF("from_table", "from_column", "from_type")
    parent = types.toDF("to_table", "to_column", "to_type")
    return (candidates.select("from_table", "from_column", "to_table", "to_column")
            .join(child, ["from_table", "from_column"]).join(parent, ["to_table", "to_column"])
            .where(F.col("from_type") != F.col("to_type")))


def route_issues(issues: DataFrame, keys: list[str]) -> DataFrame:
    """One reviewer and reason per target from its issue rows.

    Privacy or prohibited evidence first, then the alphabetically first
    architect issue, then incomplete values, then any other issue. Only minima
    and flags are aggregated, so the size of an issue group does not matter.
    """
    issue, architect = F.col("issue"), F.col("issue").isin(*ARCHITECT_ISSUES)
    picked = issues.groupBy(*keys).agg(
        F.max((F.col("privacy_class") != "INTERNAL")
              | F.coalesce(issue == "PROHIBITED_EVIDENCE", F.lit(False))).alias("private"),
        F.min(F.when(architect, issue)).alias("architect_issue"),
        F.max(F.coalesce(issue == "NULL_OR_EMPTY_VALUE", F.lit(False))).alias("incomplete"),
        F.min(issue).alias("first_issue"))

    def words(name: str) -> Column:
        return F.lower(F.replace(F.col(name), F.lit("_"), F.lit(" ")))

    role = (F.when(F.col("private"), "PRIVACY_STEWARD")
            .when(F.col("architect_issue").isNotNull(), "DATA_ARCHITECT")
            .when(F.col("first_issue").isNotNull(), "DOMAIN_STEWARD"))
    reason = (F.when(F.col("private"), "privacy or prohibited evidence, for the privacy steward to see")
              .when(F.col("architect_issue").isNotNull(), words("architect_issue"))
              .when(F.col("incomplete"), "incomplete values, for a steward to fill or explain")
              .otherwise(words("first_issue")))
    return picked.select(*keys, role.alias("reviewer_role"), reason.alias("review_reason"))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-insensitive content key of a table: schema, row count and row hashes.

    Row digests are summed in eight 32-bit lanes, so copies count and rows need
    no sort or group; the sums are exact decimals. The same rows in any order
    give the same key, a changed value or type gives another. Timestamps are
    written with their microseconds, those with a zone in UTC.
    """
    columns = columns or df.columns
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}:{str(f.nullable).lower()}"
                      for f in df.schema.fields if f.name in columns)
    row = F.sha2(F.to_json(F.struct(*[quoted(c) for c in columns]), {
        "ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}), 256)
    lanes = [F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")) for i in range(8)]
    sums = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.concat_ws(",", *[F.coalesce(s.cast("string"), F.lit("0")) for s in lanes]).alias("lanes"))
    return sums.select("row_count", F.sha2(
        F.concat_ws("|", F.lit(schema), F.col("row_count").cast("string"), "lanes"), 256).alias("input_key"))


def boundary_parse(df: DataFrame, dates: list[str], amounts: list[str]) -> DataFrame:
    """Per text column: how many values parse, and how many lie in the allowed range."""
    def inside(c: Column, kind: str, bounds: tuple[str, str]) -> Column:
        value = c.try_cast(kind)
        return value.between(F.lit(bounds[0]).cast(kind), F.lit(bounds[1]).cast(kind))

    def measured(columns: list[str], kind: str, bounds: tuple[str, str]) -> DataFrame:
        return _per_column(df, columns, {
            "value_rows": lambda c: F.count(c),
            "parsed_rows": lambda c: F.count(c.try_cast(kind)),
            "in_range_rows": lambda c: F.count_if(inside(c, kind, bounds)),
        }).withColumn("target_type", F.lit(kind))

    return measured(dates, "date", DATE_RANGE).unionByName(measured(amounts, "decimal(12,2)", AMOUNT_RANGE))


def name_type_contradictions(scored: DataFrame, max_strength: float = 0.55) -> DataFrame:
    """Mapped attributes whose physical type does not support the mapped meaning."""
    return scored.where(F.col("ontology_concept_id").isNotNull() & (F.col("type_strength") <= max_strength))
