"""Links that values prove: which columns hold the values of which others.

Rows of all tables become (value, columns that hold it). The columns of a value
are one bit set, built by ``bit_or`` before and after a single shuffle on the
value, so a hot value is one row of each task. Values with the same bit set are
then counted together, and the counts of column pairs follow from these few
sets: no two tables are joined row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.operators.profile import plain_zero, quoted, value_text

_BITS = 63


def value_family(kind: T.DataType) -> str | None:
    """Columns are compared inside a family; nested and binary types have none."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(kind, T.DecimalType):
        return f"decimal({kind.scale})"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, (T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return kind.typeName()
    return None


def comparable_columns(tables: dict[str, DataFrame], alone: bool = False) -> list[tuple[str, str, str]]:
    """(table, column, family) of the columns that have another one to compare with; ``alone`` takes all of a family."""
    found = [(name, f.name, value_family(f.dataType)) for name, df in sorted(tables.items()) for f in df.schema.fields]
    found = [c for c in found if c[2]]
    families = [f for _, _, f in found]
    return [c for c in found if alone or families.count(c[2]) > 1]


def _cell(column: Column, family: str) -> Column:
    """A value in the one type of its family; text of over 64 characters by its SHA-256."""
    if family == "text":
        return value_text(column.cast("string"), T.StringType())
    if family == "float":
        return plain_zero(column.cast("double"), T.DoubleType())
    return column.cast({"integer": "bigint"}.get(family, family.replace("decimal(", "decimal(38,")))


def column_sets(tables: dict[str, DataFrame], columns: list[tuple[str, str, str]]) -> DataFrame:
    """set (array of longs, one bit a column of ``columns``) and values: how many distinct values exactly these hold.

    Each family is grouped in its own type: numbers and times are neither written as text nor compared as such.
    """
    words = range(-(-len(columns) // _BITS))
    held = None
    for family in dict.fromkeys(f for _, _, f in columns):
        cells = None
        for name, df in tables.items():
            own = [(i, c) for i, (t, c, f) in enumerate(columns) if t == name and f == family]
            if not own:
                continue
            rows = df.select(F.inline(F.array(*[F.struct(
                _cell(quoted(c), family).alias("value"),
                *[F.lit(1 << i % _BITS if i // _BITS == w else 0).cast("long").alias(f"w{w}") for w in words])
                for i, c in own]))).where("value IS NOT NULL")
            cells = rows if cells is None else cells.unionByName(rows)
        sets = cells.groupBy("value").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in words]).drop("value")
        held = sets if held is None else held.unionByName(sets)
    return (held.groupBy(*[f"w{w}" for w in words]).agg(F.count(F.lit(1)).alias("values"))
            .select(F.array(*[f"w{w}" for w in words]).alias("set"), "values"))


def _members(sets: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """sets with the numbers of their columns as ``members``."""
    has = [F.when(F.get("set", F.lit(i // _BITS)).bitwiseAND(F.lit(1 << i % _BITS)) != 0, F.lit(i)) for i in range(len(columns))]
    return sets.select("values", F.array_compact(F.array(*has)).alias("members"))


def distinct_counts(sets: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """source_table, source_column, distinct_count of every column that has a value, exact."""
    names = F.array(*[F.struct(F.lit(t).alias("source_table"), F.lit(c).alias("source_column")) for t, c, _ in columns])
    return (_members(sets, columns).select("values", F.explode("members").alias("i")).groupBy("i")
            .agg(F.sum("values").alias("distinct_count")).select(F.get(names, F.col("i")).alias("n"), "distinct_count")
            .select("n.*", "distinct_count"))


def inclusions(sets: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """Every ordered pair of columns that share a value, with the share of the child's values that the parent holds."""
    pairs = (_members(sets, columns).select("values", F.explode("members").alias("child"), "members")
             .select("values", "child", F.explode("members").alias("parent"))
             .groupBy("child", "parent").agg(F.sum("values").alias("matched_values")))
    own = pairs.where("child = parent").select("child", F.col("matched_values").alias("own"))
    names = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c, _ in columns])
    child, parent = F.get(names, F.col("child")), F.get(names, F.col("parent"))
    counted = (pairs.where("child <> parent")
               .join(own.withColumnRenamed("own", "child_values"), "child")
               .join(own.select(F.col("child").alias("parent"), F.col("own").alias("parent_values")), "parent"))
    return counted.select(
        child["t"].alias("child_table"), child["c"].alias("child_column"), parent["t"].alias("parent_table"),
        parent["c"].alias("parent_column"), "child_values", "parent_values", "matched_values",
        (F.col("matched_values") / F.col("child_values")).alias("overlap_ratio"),
        (F.col("matched_values") == F.col("child_values")).alias("is_inclusion"))


def value_links(tables: dict[str, DataFrame]) -> DataFrame:
    """``inclusions`` of all comparable columns of ``tables``."""
    columns = comparable_columns(tables)
    return inclusions(column_sets(tables, columns), columns)


def with_overlap(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """Link candidates by name with the share of values that proves them; 0 where the two columns share none."""
    overlap = found.select(F.col("child_table").alias("from_table"), F.col("child_column").alias("from_column"),
                           F.col("parent_table").alias("to_table"), F.col("parent_column").alias("to_column"), "overlap_ratio")
    return (candidates.drop("overlap_ratio").join(overlap, ["from_table", "from_column", "to_table", "to_column"], "left")
            .withColumn("overlap_ratio", F.coalesce("overlap_ratio", F.lit(0.0))))
