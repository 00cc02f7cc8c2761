"""Shuffle files of stored relations."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from catalograph.functions import shared
from catalograph.llm import support


def test_writing_a_relation_leaves_no_shuffle_files(spark):
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = spark.conf.get(shared.SHUFFLES_DROPPED)
    keys = lambda: {k for k in range(2_000) if shuffles.contains(k)}
    for write in (shared.written, support.written):
        known = keys()
        rows = write(spark.range(1_000).withColumn("h", F.sha2(F.col("id").cast("string"), 256)).repartition(4, "h"), "dealt")
        for _ in range(50):
            left = keys() - known
            if not left:
                break
            time.sleep(0.1)
        assert not left and rows.count() == 1_000
        assert spark.conf.get(shared.SHUFFLES_DROPPED) == before
