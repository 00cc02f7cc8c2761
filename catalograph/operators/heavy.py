"""Most frequent values of many columns: a bounded summary proposes, an exact count decides.

The first pass keeps a counter summary of fixed size for each column; it merges
over tasks. The second counts the proposed values exactly, so a task sends at
most columns times summary size rows. A value outside the summary has at most
twice the summary's error as its count; where the last value of the list is
above that, or the summary held every value, the list is complete. Columns for
which neither holds, such as keys whose values are all equally frequent, are
counted in full.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalograph.operators.profile import LONG_VALUE, frequent_items, long_values

TRACKED = 2_048
# Fixed values of the counter summary: its load, and its error as a share of rows times map size.
LOAD = 0.75
ERROR = 3.5


def map_size(tracked: int) -> int:
    return 1 << math.ceil(math.log2(tracked / LOAD))


def _key_sql(text: str) -> str:
    """The value as summaries hold it: long ones by their SHA-256, so that a summary's size is bounded in bytes too."""
    return f"if(length({text}) > {LONG_VALUE}, sha2(cast({text} AS binary), 256), {text})"


def summaries(df: DataFrame, columns: list[str], tracked: int = TRACKED) -> DataFrame:
    """source_column, filled rows, estimated distinct values and the counter summary of each column, in one pass."""
    parts = []
    for i, name in enumerate(columns):
        text = _key_sql("cast(`%s` AS string)" % name.replace("`", "``"))
        parts += [F.expr(f"count({text})").alias(f"n{i}"), F.expr(f"approx_count_distinct({text})").alias(f"d{i}"),
                  F.expr(f"approx_top_k_accumulate({text}, {tracked}) FILTER (WHERE {text} IS NOT NULL)").alias(f"s{i}")]
    rows = [F.struct(F.lit(c).alias("source_column"), F.col(f"n{i}").alias("filled"), F.col(f"d{i}").alias("distinct_estimate"),
                     F.col(f"s{i}").alias("summary")) for i, c in enumerate(columns)]
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def merged_summaries(states: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Summaries of several parts of a table as one for each column."""
    return states.groupBy("source_column").agg(
        F.sum("filled").alias("filled"), F.sum("distinct_estimate").alias("distinct_estimate"),
        F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))


def heavy_hitters(df: DataFrame, columns: list[str], k: int, tracked: int = TRACKED) -> DataFrame:
    """source_column, value, n, position: the ``k`` most frequent values of each column, ties by value, exact."""
    states = summaries(df, columns, tracked)
    # one row a column with at most `tracked` values reaches the driver and every task
    held = states.select("source_column", "filled", "distinct_estimate",
                         F.expr(f"transform(approx_top_k_estimate(summary, {tracked}), x -> x.item)").alias("items")).collect()
    proposed = [(r["source_column"], v) for r in held for v in r["items"]]
    spark = df.sparkSession
    candidates = spark.createDataFrame(proposed, "source_column string, key string")
    counted = (long_values(df, columns).withColumn("key", F.expr(_key_sql("value"))).join(F.broadcast(candidates), ["source_column", "key"])
               .groupBy("source_column", "key").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value")))
    ranked = counted.selectExpr("source_column", "value", "n",
                                "row_number() OVER (PARTITION BY source_column ORDER BY n DESC, value) AS position").where(F.col("position") <= k)
    size = map_size(tracked)
    last = {r["source_column"]: r["n"] for r in ranked.where(F.col("position") == k).select("source_column", "n").collect()}
    open_ = []
    for r in held:
        # five standard errors of the distinct estimate stay below what the summary holds without loss
        lossless = r["distinct_estimate"] * 1.25 <= LOAD * size
        if not lossless and last.get(r["source_column"], 0) <= 2 * ERROR * r["filled"] / size:
            open_.append(r["source_column"])
    if not open_:
        return ranked
    return ranked.where(~F.col("source_column").isin(open_)).unionByName(frequent_items(df, open_, k))
