"""Quality rules: countable text rules, then a likelihood ratio of hashed n-grams.

A document's words and word pairs are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted, one over trusted documents and one
over the whole raw corpus; a document's score is the mean, over its n-grams, of
log(trusted / raw). Documents below a fixed threshold go; a score is not drawn
against chance, so equal texts always share their fate.

Null or empty texts have no words, fail the base rules and score 0. Repeated
rows are counted and judged as often as they stand there. An empty table gives
no rows; without trusted documents every score is 0. Extra columns are ignored
by ``judge`` and kept by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm import textblocks as tb
from catalograph.llm.support import slices, text_column, unused

BUCKETS = 1 << 16
# At most so many labelled ids define the trusted set (a fitted model may use a bounded
# sample); both counts and all judgements cover every document.
MAX_TRUSTED = 20_000
THRESHOLD = -0.3
# The base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

_VERDICT = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
            "base_failed:boolean,score:double,kept:boolean>")


def bucket_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and every pair of neighbouring words, in lower case."""
    starts, ends, bounds = tb.word_spans(data, offsets)
    hashes = tb.span_hashes(data, starts, ends, lower=True)
    pairs, first = tb.windows(hashes, bounds, 2)
    rows = tb.row_of(bounds)
    both = np.concatenate([hashes, pairs]) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return both.astype(np.int64), np.concatenate([rows, rows[first]])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The countable rules of each text of a slice."""
    starts, ends, bounds = tb.word_spans(data, offsets)
    hashes = tb.span_hashes(data, starts, ends)
    n_words = np.diff(bounds)
    inside = ~tb._space()[data]
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in SYMBOLS]] = True

    # lines with a word, less the distinct ones among them
    begin, end, row = tb.line_spans(data, offsets)
    filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, row = begin[filled], end[filled], row[filled]
    keys, first = np.unique(tb.in_row(tb.span_hashes(data, begin, end), row), return_index=True)
    n = len(offsets) - 1
    dup_lines = np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)

    # words under any window of a text that stands there twice
    window, at = tb.windows(hashes, bounds, WINDOW)
    rows = tb.row_of(bounds)
    _, back, count = np.unique(tb.in_row(window, rows[at]), return_inverse=True, return_counts=True)
    again = at[count[back] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = tb.per_row(np.cumsum(cover[:-1]) > 0, bounds)
    return {"n_words": n_words, "word_chars": tb.per_row(inside & ((data & 0xC0) != 0x80), offsets),
            "n_symbols": tb.per_row(symbol[data], offsets), "n_dup_lines": dup_lines, "n_repeat_words": repeated,
            "base_failed": (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)}


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """At most ``limit`` ids of documents labelled good, chosen by hash, once each."""
    return (labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))


def log_ratios(documents: DataFrame, labels: DataFrame, limit: int = MAX_TRUSTED) -> np.ndarray:
    """log(trusted share / raw share) of each bucket.

    The raw share is smoothed by one count a bucket, the trusted one by as many
    counts dealt out as the raw corpus has them, so few trusted documents say little.

    Each task adds its documents up in two arrays of ``BUCKETS`` counts; their
    sums by bucket are all that reaches the driver. The ids are at most
    ``limit`` (8 bytes each), hence the broadcast.
    """

    def counts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in source:
            done, good = 0, batch.column(1).to_numpy(zero_copy_only=False)
            for data, offsets in slices(batch.column(0)):
                bucket, row = bucket_features(data, offsets)
                total[1] += np.bincount(bucket, minlength=BUCKETS)
                total[0] += np.bincount(bucket[good[done + row]], minlength=BUCKETS)
                done += len(offsets) - 1
        used = np.flatnonzero(total[1])
        yield pa.record_batch([pa.array(used), pa.array(total[0][used]), pa.array(total[1][used])],
                              names=["bucket", "trusted", "raw"])

    ids = trusted_ids(labels, limit).select(F.col("doc_id").alias("__trusted"))
    marked = (documents.select(text_column(documents).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
              .join(F.broadcast(ids), F.col("doc_id") == F.col("__trusted"), "left")
              .select("text", F.col("__trusted").isNotNull().alias("good")))
    found = (marked.mapInArrow(counts, "bucket long, trusted long, raw long")
             .groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw")).toPandas())
    trusted, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    trusted[found.bucket], raw[found.bucket] = found.trusted, found.raw
    if not trusted.any():
        return np.zeros(BUCKETS)
    share = (raw + 1) / (raw.sum() + BUCKETS)
    return np.log((trusted + BUCKETS * share) / (trusted.sum() + BUCKETS)) - np.log(share)


def verdict(text: Column, ratios: np.ndarray, threshold: float = THRESHOLD) -> Column:
    """``struct`` of the base counts, the score and whether the document is kept."""

    def judge_all(texts: pa.Array) -> pa.Array:
        parts = []
        for data, offsets in slices(texts):
            found = base_counts(data, offsets)
            bucket, row = bucket_features(data, offsets)
            n = len(offsets) - 1
            size = np.bincount(row, minlength=n)
            score = np.bincount(row, ratios[bucket], minlength=n) / np.maximum(size, 1)
            found |= {"score": score, "kept": ~found["base_failed"] & (score >= threshold)}
            parts.append(pa.StructArray.from_arrays(
                [pa.array(v if v.dtype == bool or v.dtype == float else v.astype(np.int64)) for v in found.values()],
                list(found)))
        names = [f.split(":")[0] for f in _VERDICT[7:-1].split(",")]
        if not parts:
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            return pa.array([], pa.struct(list(zip(names, kinds))))
        return pa.concat_arrays(parts)

    return F.arrow_udf(judge_all, _VERDICT)(text)


def judge(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id with the base counts, the score and the verdict of every document."""
    ratios = log_ratios(documents, labels)
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents).alias("text"))
            .select("doc_id", verdict(F.col("text"), ratios, threshold).alias("v")).select("doc_id", "v.*"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that pass, with their columns."""
    name = unused(documents, "__verdict")
    return (documents.withColumn(name, verdict(text_column(documents), log_ratios(documents, labels), threshold))
            .where(F.col(name)["kept"]).drop(name))
