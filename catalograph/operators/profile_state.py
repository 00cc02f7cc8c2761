"""Profiles that grow with their table: mergeable states by partition.

A state holds counts, ends and sketches of one column in one partition of a
table. States of partitions merge to the state of the table, so a run scans
only partitions that have no state yet; the stored ones are appended, never
changed. Sketches have a fixed size whatever they summarise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.operators.profile import plain_zero, quoted

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)
# Base-two logarithm of the distinct sketch's slots: about 1.6 % error.
SLOTS = 12
ENDS = ("long", "double", "text")


def profiled_columns(df: DataFrame) -> list[str]:
    """Columns with an order: all but nested and binary ones."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]


def _kind(kind: T.DataType) -> str:
    return "long" if isinstance(kind, _INTEGERS) else "double" if isinstance(kind, _FLOATS) else "text"


def partition_states(df: DataFrame, columns: list[str], partition: Column) -> DataFrame:
    """One row per partition and column: counts, least and greatest value, sketches of distinct values and quantiles.

    Dates and times are held as text, which sorts as they do. All columns of a table share one partially aggregated pass.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(columns):
        c, kind = quoted(name), _kind(kinds[name])
        typed = c.cast("long") if kind == "long" else plain_zero(c.cast("double"), T.DoubleType()) if kind == "double" else c.cast("string")
        sketch = typed.cast("string") if kind == "double" else typed
        parts += [F.count(c).alias(f"c{i}"), F.hll_sketch_agg(sketch, SLOTS).alias(f"d{i}"),
                  F.min(typed).alias(f"lo{i}"), F.max(typed).alias(f"hi{i}")]
        if kind != "text":
            parts.append((F.kll_sketch_agg_bigint(typed) if kind == "long" else F.kll_sketch_agg_double(typed)).alias(f"q{i}"))
        end = lambda side, k: (F.col(f"{side}{i}") if k == kind else F.lit(None)).cast(  # noqa: E731, B023
            {"long": "long", "double": "double", "text": "string"}[k])
        rows.append(F.struct(
            F.lit(name).alias("source_column"), F.lit(kind).alias("kind"), F.col("n").alias("row_count"),
            (F.col("n") - F.col(f"c{i}")).alias("null_count"), F.col(f"d{i}").alias("distinct_sketch"),
            *[end("lo", k).alias(f"min_{k}") for k in ENDS], *[end("hi", k).alias(f"max_{k}") for k in ENDS],
            (F.col(f"q{i}") if kind == "long" else F.lit(None).cast("binary")).alias("quantiles_long"),
            (F.col(f"q{i}") if kind == "double" else F.lit(None).cast("binary")).alias("quantiles_double")))
    return df.groupBy(partition.cast("string").alias("partition")).agg(*parts).select("partition", F.inline(F.array(*rows)))


def merged(states: DataFrame, *keys: str) -> DataFrame:
    """The states of each key's partitions as one; only sketches are shuffled, each combined in the tasks first."""
    return states.groupBy(*keys, "source_column", "kind").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        *[F.min(f"min_{k}").alias(f"min_{k}") for k in ENDS], *[F.max(f"max_{k}").alias(f"max_{k}") for k in ENDS],
        F.kll_merge_agg_bigint("quantiles_long").alias("quantiles_long"),
        F.kll_merge_agg_double("quantiles_double").alias("quantiles_double"))


def statistics(state: DataFrame, *keys: str) -> DataFrame:
    """Column statistics of merged states, as ``profile.column_statistics`` gives them, with medians."""
    ends = lambda side: F.coalesce(*[F.col(f"{side}_{k}").cast("string") for k in ENDS])
    filled = F.col("row_count") > F.col("null_count")
    # an empty sketch has no quantile: it is asked only where there are values of its kind
    median = (F.when(filled & (F.col("kind") == "long"), F.kll_sketch_get_quantile_bigint("quantiles_long", F.lit(0.5)).cast("double"))
              .when(filled & (F.col("kind") == "double"), F.kll_sketch_get_quantile_double("quantiles_double", F.lit(0.5))))
    return state.select(*keys, "source_column", "row_count", "null_count",
                        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
                        ends("min").alias("min_value"), ends("max").alias("max_value"), median.alias("median"))


def new_partitions(stored: DataFrame, present: list[str]) -> list[str]:
    """The partitions of a table that have no state yet; one name per partition reaches the driver."""
    done = {r["partition"] for r in stored.select("partition").distinct().collect()}
    return sorted(set(present) - done)


def updated(stored: DataFrame, df: DataFrame, columns: list[str], partition: str, present: list[str]) -> DataFrame:
    """States of the partitions that ``stored`` lacks, to be appended to it.

    The filter on the partition column prunes all others from the scan.
    """
    fresh = new_partitions(stored, present)
    return partition_states(df.where(quoted(partition).cast("string").isin(fresh)), columns, quoted(partition))
