"""Language identification by Bloom filters that return a bit for every language.

The filters of all languages lie bit-sliced in one table: a slot holds a mask
with one bit for each language, and the AND of an n-gram's slots is the set of
languages that have it. A document's hits are counted for each language,
corrected for that language's rate of false hits, and the largest share wins.

A null text, or one without a letter, is ``und`` with score 0. Where no n-gram
hits, the language with most training n-grams is given, with score 0. Ties go
to the first language by name. Null languages train nothing; without any
training row all is ``und``. Repeated rows count as often as they stand there;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm import textblocks as tb
from catalograph.llm.support import slices, text_column, written

GRAM = 4
HASHES = 3
# An n-gram enters the filter of every language of whose n-grams it is this share at least,
# so a filter holds at most 1 / MIN_RATE of them.
MIN_RATE = 1e-5
SLOTS_PER_GRAM = 12
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    """Lower-case letters stay, bytes above ASCII stay, all else is a break (0)."""
    table = np.zeros(256, np.uint32)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, row): every run of four bytes with a letter inside, breaks counting as one byte.

    A text begins and ends with a break. UTF-8 keeps the order of characters, so
    runs of bytes tell scripts and accents apart without decoding.
    """
    n = len(offsets) - 1
    padded = np.zeros(len(data) + 2 * n, np.uint32)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + 2 * rows + 1] = _letters()[data]
    bounds = offsets + 2 * np.arange(n + 1)
    # runs of breaks shrink to one
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
    keep[bounds[:-1]] = True
    owner = np.repeat(np.arange(n), np.diff(bounds))[keep]
    line = padded[keep]
    if len(line) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    count = len(line) - GRAM + 1
    gram = np.zeros(count, np.uint32)
    for k in range(GRAM):
        gram = (gram << np.uint32(8)) | line[k:k + count]
    whole = owner[:count] == owner[GRAM - 1:]
    return gram[whole], owner[:count][whole]


@dataclass
class LanguageFilters:
    languages: list[str]
    masks: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray
    fallback: int

    def slots(self, grams: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.masks))
        mixed = tb.mix(grams.astype(np.uint64) + np.uint64(1))
        step = tb.mix(mixed) | np.uint64(1)
        return [((mixed + np.uint64(k) * step) % size).astype(np.int64) for k in range(HASHES)]

    def holders(self, grams: np.ndarray) -> np.ndarray:
        """Mask of the languages that have each n-gram."""
        found = None
        for slot in self.slots(grams):
            own = self.masks[slot]
            found = own if found is None else found & own
        return found

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, score) of each text."""
        grams, row = grams_of(data, offsets)
        n, held = len(offsets) - 1, self.holders(grams)
        size = np.bincount(row, minlength=n)
        share = np.zeros((n, len(self.languages)))
        for k in range(len(self.languages)):
            hit = (held[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            raw = np.bincount(row, hit.astype(float), minlength=n) / np.maximum(size, 1)
            share[:, k] = (raw - self.false_rate[k]) / (1 - self.false_rate[k])
        share = np.clip(share, 0, 1)
        best = share.argmax(1)
        score = share[np.arange(n), best]
        return np.where(score > 0, best, self.fallback), score


def train(documents: DataFrame) -> LanguageFilters | None:
    """Filters from the text and non-null lang of every row of ``documents``.

    Each task emits its distinct n-grams with counts; rates and the choice of
    n-grams are aggregates. What reaches the driver is bounded by ``MIN_RATE``.
    """

    def counts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            langs = batch.column(1).dictionary_encode()
            names, code, done = langs.dictionary, langs.indices.to_numpy(), 0
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for data, offsets in slices(batch.column(0)):
                grams, row = grams_of(data, offsets)
                key = grams.astype(np.int64) | (code[done + row].astype(np.int64) << 32)
                held.append(np.unique(key, return_counts=True))
                done += len(offsets) - 1
            if held:
                keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
                total = np.bincount(back, np.concatenate([c for _, c in held])).astype(np.int64)
                yield pa.record_batch([names.take(pa.array(keys >> 32)), pa.array(keys & 0xFFFFFFFF), pa.array(total)],
                                      names=["lang", "gram", "n"])

    rows = (documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select(text_column(documents).alias("text"), F.col("lang").cast("string").alias("lang")))
    grams = written(rows.mapInArrow(counts, "lang string, gram long, n long")
                    .groupBy("gram", "lang").agg(F.sum("n").alias("n")), "language-grams")
    by_gram = grams.groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("held"))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    if not totals:
        return None
    languages = [r["lang"] for r in totals]
    size = F.create_map(*[F.lit(v) for r in totals for v in (r["lang"], float(r["n"]))])
    # a list holds one entry a language, so it is bounded by their number
    rated = by_gram.select("gram", F.transform("held", lambda h: F.struct(
        h["lang"].alias("lang"), (h["n"] / F.element_at(size, h["lang"])).alias("rate"))).alias("held"))
    chosen = rated.select("gram", F.filter("held", lambda h: h["rate"] >= MIN_RATE).alias("held")).where(F.size("held") > 0)
    found = chosen.select("gram", F.transform("held", lambda h: h["lang"]).alias("langs")).toPandas()
    return build_filters(languages, [r["n"] for r in totals], found.gram.to_numpy(np.int64), found.langs.tolist())


def build_filters(languages: list[str], sizes: list[int], grams: np.ndarray, langs: list) -> LanguageFilters:
    slots = 1 << int(max(SLOTS_PER_GRAM * max(len(grams), 1), 1024) - 1).bit_length()
    number = {name: k for k, name in enumerate(languages)}
    width = (len(languages) + 63) // 64
    own = np.zeros((len(grams), width), np.uint64)
    for i, names in enumerate(langs):
        for name in names:
            own[i, number[name] // 64] |= np.uint64(1 << number[name] % 64)
    filters = LanguageFilters(languages, np.zeros((slots, width), np.uint64), np.zeros(len(languages)),
                              int(np.argmax(sizes)))
    for slot in filters.slots(grams):
        np.bitwise_or.at(filters.masks, slot, own)
    for k in range(len(languages)):
        full = ((filters.masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()
        filters.false_rate[k] = full ** HASHES
    return filters


def predicted(text: Column, filters: LanguageFilters | None) -> Column:
    """``struct<lang_pred, score>`` of each whole text."""
    if filters is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))

    def predict_all(texts: pa.Array) -> pa.Array:
        names, parts = pa.array(filters.languages, pa.string()), []
        for data, offsets in slices(texts):
            best, score = filters.predict(data, offsets)
            parts.append(pa.StructArray.from_arrays([names.take(pa.array(best)), pa.array(score)],
                                                    ["lang_pred", "score"]))
        return pa.concat_arrays(parts) if parts else pa.array(
            [], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))

    return F.arrow_udf(predict_all, "struct<lang_pred:string,score:double>")(text)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(documents: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``documents``; filters come from ``training``."""
    text = F.col("text").cast("string")
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .withColumn("p", predicted(F.coalesce("text", F.lit("")), train(training)))
            .withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
            .select("doc_id", F.when(F.col("__letter"), F.col("p.lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                    F.when(F.col("__letter"), F.col("p.score")).otherwise(0.0).alias("score")))
