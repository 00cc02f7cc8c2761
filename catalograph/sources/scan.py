"""Source scope checks and the attribute inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions.small import local_frame

INVENTORY_SCHEMA = (
    "source_table string, source_column string, ordinal_position int, "
    "physical_type string, nullable boolean"
)


def quoted_name(table: str, catalog: str | None = None, schema: str | None = None) -> str:
    """Back-quoted one-, two- or three-part table name."""
    return ".".join("`%s`" % part.replace("`", "``") for part in (catalog, schema, table) if part)


def source_table(spark: SparkSession, table: str, catalog: str | None = None,
                 schema: str | None = None) -> DataFrame:
    """Read-only scan of one configured table."""
    return spark.table(quoted_name(table, catalog, schema))


def parquet_tables(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def existing_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """Permanent tables of a schema; temporary views are not sources."""
    clause = f" IN {schema}" if schema else ""
    return (spark.sql(f"SHOW TABLES{clause}").where(~F.col("isTemporary"))
            .select(F.col("tableName").alias("source_table")))


def missing_tables(scope: DataFrame, existing: DataFrame) -> DataFrame:
    """Configured tables that do not exist."""
    return scope.select("source_table").distinct().join(existing, "source_table", "left_anti")


def tables_without_columns(scope: DataFrame, inventory: DataFrame) -> DataFrame:
    """Configured tables with no attribute row."""
    return (scope.select("source_table").distinct()
            .join(inventory.select("source_table"), "source_table", "left_anti"))


def require_none(violations: DataFrame, message: str) -> None:
    """Fail when a violation relation has any row; shows at most 20 of them."""
    sample = violations.limit(20).collect()
    if sample:
        raise ValueError(f"{message}: {[row.asDict() for row in sample]}")


def attribute_inventory(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column, ordinals from 1, from DataFrame schemas alone (no job)."""
    rows = [
        {"source_table": name, "source_column": field.name, "ordinal_position": position,
         "physical_type": str(field.dataType), "nullable": field.nullable}
        for name, frame in tables.items()
        for position, field in enumerate(frame.schema.fields, start=1)
    ]
    return local_frame(spark, rows, INVENTORY_SCHEMA)


# Catalog spellings of types, and the names the type rules know. Others pass unchanged.
CATALOG_TYPES = {
    "string": "StringType()", "varchar": "StringType()", "char": "StringType()", "text": "StringType()",
    "tinyint": "ShortType()", "smallint": "ShortType()", "int": "IntegerType()", "integer": "IntegerType()",
    "bigint": "LongType()", "long": "LongType()", "float": "FloatType()", "real": "FloatType()",
    "double": "DoubleType()", "decimal": "DecimalType", "numeric": "DecimalType", "date": "DateType()",
    "timestamp": "TimestampType()", "timestamp_ntz": "TimestampNTZType()", "boolean": "BooleanType()",
}


def physical_type_of(data_type: Column) -> Column:
    """``bigint``, ``STRING`` or ``decimal(10,2)`` as the type names of the rules; precision is kept."""
    base = F.lower(F.trim(F.regexp_extract(data_type, r"^\s*([A-Za-z_]+)", 1)))
    names = F.create_map(*[F.lit(v) for pair in CATALOG_TYPES.items() for v in pair])
    known = F.try_element_at(names, base)
    size = F.coalesce(F.nullif(F.replace(F.regexp_extract(data_type, r"(\([0-9, ]+\))", 1), F.lit(" "), F.lit("")), F.lit("")),
                      F.lit("(10,0)"))
    return F.when(known == "DecimalType", F.concat(known, size)).otherwise(F.coalesce(known, data_type))


def inventory_from_catalog(columns: DataFrame, table: str = "table_name", column: str = "column_name",
                           ordinal: str = "ordinal_position", data_type: str = "data_type",
                           nullable: str = "is_nullable") -> DataFrame:
    """The same relation from a catalog's column-metadata table, for whole catalogs."""
    flag = F.col(nullable)
    return columns.select(
        F.col(table).alias("source_table"), F.col(column).alias("source_column"),
        F.col(ordinal).cast("int").alias("ordinal_position"),
        physical_type_of(F.col(data_type)).alias("physical_type"),
        F.upper(flag.cast("string")).isin("YES", "TRUE").alias("nullable"),
    )
