"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above HOT_ROWS rows is spread over SALTS tasks. There can be at most
# total_rows / HOT_ROWS such keys, which bounds the broadcast list of hot keys:
# 10^12 fact rows give at most 10^5 keys.
HOT_ROWS = 10_000_000
SALTS = 64
# Buckets of keys that are counted before any key is.
BUCKETS = 65_536


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> DataFrame:
    """The keys that more than ``hot_rows`` rows bear, exactly.

    Rows are counted per bucket of keys first, a few numbers a task. Only the rows of
    buckets above the limit are counted by key, so keys that are nearly unique
    are not shuffled to learn that none is hot.
    """
    own, bucket, many = rows.select(*keys), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"), F.col("__rows") > hot_rows
    full = own.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows")).where(many).select("__bucket")
    some = own.withColumn("__bucket", bucket).join(F.broadcast(full), "__bucket", "left_semi")
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(many).select(*keys)


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], rows_col: str,
                how: str = "left", hot_rows: int = HOT_ROWS, salts: int = SALTS,
                counts: DataFrame | None = None, hot: DataFrame | None = None,
                salt_by: list[str] | None = None) -> DataFrame:
    """Join many ``facts`` to a ``lookup`` that is unique per key.

    ``rows_col`` is the number of fact rows per key, which the aggregate that
    built the lookup already knows. Keys above ``hot_rows`` are replicated over
    salts on the lookup side and scattered on the fact side; all other keys
    join unsalted. The salt is a hash of the row, so a task that runs again
    after a lost executor sends its rows to the same place; ``salt_by`` names the
    columns that tell the rows of a key apart, by default all, which are then read.
    ``hot`` gives the hot keys themselves (``hot_keys``); then nobody has to count
    the rows of every key. ``rows_col`` is dropped from the result.
    """
    spread = [F.col(c) for c in salt_by or facts.columns if c not in keys] or [F.col(k) for k in keys]
    known = counts is not None or hot is not None
    if hot is None:
        hot = (lookup if counts is None else counts).where(F.col(rows_col) > hot_rows)
    hot = hot.select(*keys, F.lit(True).alias("__hot"))
    scattered = (
        facts.join(F.broadcast(hot), keys, "left")
        .withColumn("__salt", F.when(F.col("__hot"),
                                     F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(0))
        .drop("__hot")
    )
    many = F.col(rows_col) > hot_rows
    if known:
        lookup, many = lookup.drop(rows_col).join(F.broadcast(hot), keys, "left"), F.col("__hot")
    copies = F.when(many, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    replicated = lookup.withColumn("__salt", F.explode(copies)).drop(rows_col, "__hot")
    return scattered.join(replicated, [*keys, "__salt"], how).drop("__salt")


def spread(frame: DataFrame, *columns: str | Column) -> DataFrame:
    """Repartition before row-heavy expressions.

    Adaptive execution merges shuffle partitions by bytes; distinct names are
    few bytes but much work per row, so their partition count is fixed here.
    """
    return frame.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
