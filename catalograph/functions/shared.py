"""Intermediate relations written once to the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends, and not when the driver collects its garbage.

    For queries that run once, as the writing of a relation: disk then holds the shuffles of one of them.
    """
    before = spark.conf.getAll.get(SHUFFLES_DROPPED)
    spark.conf.set(SHUFFLES_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_DROPPED) if before is None else spark.conf.set(SHUFFLES_DROPPED, before)


def written(frame: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a relation that several plans read, and read it back with column pruning.

    Survives lost executors, and later plans start from the files instead of
    repeating the work. Hashes and names fill most of these relations, so they
    are compressed with zstd, which halves what snappy leaves of hex digits.
    """
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(frame.sparkSession):
        frame.write.partitionBy(*(partition_by or [])).parquet(path, compression="zstd")
    return frame.sparkSession.read.parquet(path)
