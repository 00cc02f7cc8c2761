"""Token ids as ORC files in document order.

Each file is one range of document ids in ascending order: integer run-length
encoding, row indexes and Bloom filters on ``doc_id``, so stripes are read in
parallel and a lookup by id skips files, stripes and row groups.

Null texts are empty documents (the end id alone); a null doc_id sorts first;
rows with equal doc_id follow each other by a hash of the text, equal rows in
any order; an empty table gives an empty result. Other columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalograph.llm.bpe import BATCH_BYTES, int_lists
from catalograph.llm.pieces import batches, piece_encoder
from catalograph.llm.support import text_column

SCHEMA = "doc_id long, part int, first_id long, n_tokens long, ids array<int>"
STRIPE_BYTES = 32 << 20
INDEX_ROWS = 1_000


def write_tokens(documents: DataFrame, target: str, vocabulary: str, end_id: int = 0, text: str = "text") -> None:
    """Encode whole texts, append ``end_id`` to each, and write one ORC file for each range of ids.

    The texts are dealt by range before they are encoded, so the work is done
    once and each task holds one range. ``part`` is the range's number and
    ``first_id`` counts the ids before a document in its range.
    """

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = piece_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in source:
            begin = 0
            for texts in batches(batch.column(1), BATCH_BYTES):
                ids, bounds = encoder.encode(texts)
                ids = np.insert(ids, bounds[1:], np.int32(end_id))
                bounds = bounds + np.arange(len(bounds))
                yield pa.record_batch([
                    batch.column(0).slice(begin, len(texts)),
                    pa.array(np.full(len(texts), part, np.int32)), pa.array(before + bounds[:-1]),
                    pa.array(np.diff(bounds)), int_lists(ids, bounds)],
                    names=["doc_id", "part", "first_id", "n_tokens", "ids"])
                before, begin = before + int(bounds[-1]), begin + len(texts)

    tie = "__text_hash"
    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents, text).alias("text"))
        .withColumn(tie, F.xxhash64("text"))
        .repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie).select("doc_id", "text"))
    (ordered.mapInArrow(rows, SCHEMA).write
     .option("orc.create.index", "true").option("orc.row.index.stride", INDEX_ROWS)
     .option("orc.stripe.size", STRIPE_BYTES).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").option("compression", "zstd").orc(target))


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """The written rows; filters on ``doc_id`` reach the files' indexes and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(target)


def ids_crc32(ids: Column) -> Column:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(lists: pa.Array) -> pa.Array:
        bounds = lists.offsets.to_numpy()
        flat = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        return pa.array([zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.int64())

    return crc(ids)


def token_index(stored: DataFrame) -> DataFrame:
    """doc_id, start among all ids, count and checksum of every stored document.

    The totals by file are one row a file; only they are ordered in one task.
    """
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = (stored.groupBy("part").agg(F.sum("n_tokens").alias("total"))
             .select("part", F.coalesce(before, F.lit(0)).alias("before")))
    return (stored.select("part", "doc_id", "first_id", F.size("ids").cast("long").alias("n_tokens"),
                          ids_crc32(F.col("ids")).alias("ids_crc32"))
            .join(parts, "part")
            .select("doc_id", (F.col("before") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32"))
