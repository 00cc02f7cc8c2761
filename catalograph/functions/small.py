"""Rule rows as DataFrames of known size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Driver-held rows as a local relation, so the optimizer knows their size."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(StructType.fromDDL(schema))))


def rule_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Rule rows as a DataFrame; the optimizer knows their size and picks the join."""
    return local_frame(spark, rows, schema)


def sql_literal(value: object) -> str:
    """A Python value as a SQL literal, for expressions built from rule rows."""
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
