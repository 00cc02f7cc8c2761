"""As-of joins: each row with the last row of the other side up to its time.

Both sides go into one relation that is sorted by time inside a key and a span
of time; the last row carried into a span comes from one row per span. A key with a
third of all rows is so dealt over its spans, and no list of offers is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, since: str, take: list[str],
              span: Column | None = None) -> DataFrame:
    """``left`` with the columns ``take`` of the right row of equal keys and the greatest ``since`` up to ``at``.

    ``right`` has one row at most for a key and time. Without an earlier row the
    columns are null. Null keys are equal to each other; rows whose ``at`` is
    null get nothing. ``span`` maps the column ``moment`` to a coarser, growing
    one (default: its month); it changes the work's division, not the result.
    """
    span = F.date_trunc("month", F.col("moment")) if span is None else span
    rows = left.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(at).alias("moment"),
                       F.struct(*left.columns).alias("row"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("held"))
    steps = right.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(since).alias("moment"),
                         F.lit(None).cast(rows.schema["row"].dataType).alias("row"), F.struct(*take).alias("held"))
    both = rows.unionByName(steps).withColumn("span", span)
    key = [f"k{i}" for i in range(len(keys))]
    # what is known at the end of each span, carried forward: one row a key and span
    ends = both.groupBy(*key, "span").agg(F.max_by("held", F.when(F.col("held").isNotNull(), F.col("moment"))).alias("end"))
    before = Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"c_{k}") for k in key], F.col("span").alias("c_span"),
                          F.last("end", ignorenulls=True).over(before).alias("carried"))
    # at one moment the right side's row stands first, so it counts for the rows of that moment
    inside = Window.partitionBy(*key, "span").orderBy("moment", F.col("held").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("last", F.last("held", ignorenulls=True).over(inside)).where("row IS NOT NULL")
    same = [F.col(k).eqNullSafe(F.col(f"c_{k}")) for k in key] + [F.col("span").eqNullSafe(F.col("c_span"))]
    known = F.when(F.col("moment").isNotNull(), F.coalesce("last", "carried"))
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return (placed.join(carried, condition, "left").select("row", known.alias("known"))
            .select("row.*", *[F.col("known")[c].alias(c) for c in take]))
