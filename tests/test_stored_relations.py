"""What the documentation steps store."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalograph.functions import shared
from checks import base, governance


def test_contexts_are_not_stored(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert governance.contexts(spark, sf_dir).columns[-1] == "context_fingerprint"
    governance.documentation(spark, sf_dir).count()
    assert not [name for _, _, name in base._WRITTEN if name == "contexts"]


def test_written_relations_are_zstd(spark):
    back = shared.written(spark.range(10).withColumn("h", F.sha2(F.col("id").cast("string"), 256)), "hashes")
    assert back.count() == 10
    assert back.inputFiles() and all(".zstd." in f for f in back.inputFiles())
