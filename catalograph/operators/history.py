"""The states of attributes over all runs, as intervals.

A run lists the attributes it saw. An attribute keeps a state from the run that
first shows it to the last run before it changes or is gone; runs may arrive out
of order and more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalograph.operators.contracts import breaking_changes


def attribute_history(observed: DataFrame, runs: DataFrame, keys: list[str], state: list[str]) -> DataFrame:
    """keys, state columns, first_run, last_run, run_count: each stretch of runs in which an attribute stayed as it is.

    ``observed``: run_id, keys and state columns; repeated rows of a run count
    once (of several states in one run the smallest). ``runs``: run_id and
    created_at; runs are ordered by time, then id. A run that lacks the
    attribute ends its stretch. Windows hold one attribute's runs.
    """
    order = Window.orderBy("created_at", "run_id")
    # one row a run: the only order over all of them
    numbered = runs.groupBy("run_id").agg(F.min("created_at").alias("created_at")).withColumn("number", F.row_number().over(order))
    rows = (observed.groupBy("run_id", *keys).agg(F.min(F.struct(*state)).alias("state"))
            .join(numbered.select("run_id", "number"), "run_id"))
    along = Window.partitionBy(*keys).orderBy("number")
    gone = F.col("number") - F.lag("number").over(along) > 1
    changed = ~F.col("state").eqNullSafe(F.lag("state").over(along))
    starts = rows.withColumn("start", F.coalesce(gone | changed, F.lit(True)).cast("int"))
    stretch = starts.withColumn("stretch", F.sum("start").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return (stretch.groupBy(*keys, "stretch").agg(
        F.min("state").alias("state"), F.min_by("run_id", "number").alias("first_run"), F.max_by("run_id", "number").alias("last_run"),
        F.min("number").alias("first_number"), F.max("number").alias("last_number"), F.count(F.lit(1)).alias("run_count"))
        .select(*keys, "state.*", "first_run", "last_run", "first_number", "last_number", "run_count"))


def state_as_of(history: DataFrame, number: int, columns: list[str]) -> DataFrame:
    """The attributes as the run with this number (in time order, from 1) showed them."""
    return history.where((F.col("first_number") <= number) & (F.col("last_number") >= number)).select(*columns)


def changes_between(history: DataFrame, old: int, new: int, keys: list[str]) -> DataFrame:
    """Breaking changes from one run to another; the state holds the columns that ``breaking_changes`` compares."""
    columns = [*keys, "field_type", "const_value", "enum_values", "required", "closed"]
    return breaking_changes(state_as_of(history, old, columns), state_as_of(history, new, columns), keys)
