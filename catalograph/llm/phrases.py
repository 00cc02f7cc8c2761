"""Phrase collocations from an FM-index over word ids in each shard.

A shard is a run of at most ``SHARD_WORDS`` words of some task's texts. Its words
are numbered, pieces are kept apart by a separator, and the sequence and its
reverse are sorted to the depth of the longest phrase. The two Burrows-Wheeler
transforms with their last-to-first maps carry every phrase as a pair of
intervals: all its left extensions are read from the one interval, all right
extensions from the other, and both intervals of an extension follow at once.
Counts are summed over the shards.

Two passes keep the sums small. The first counts words and pairs; the second
grows only phrases whose pairs are frequent, tested by a Bloom filter of bounded
size: a false hit costs work, never a wrong count.

A null text has no words, a null language is ``und``. Repeated rows count as
often as they stand there. A piece longer than a shard is cut with an overlap
whose phrases are counted back, so counts do not depend on the cut. An empty
table gives no rows; columns besides text and language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm import textblocks as tb
from catalograph.llm.support import chunks, text_column, written

DEPTH = 4
MIN_COUNT = 30
TOP = 2_000
INSIDE_PERCENT = 80
SHARD_WORDS = 1 << 18
# Bits of the filter of frequent pairs: 16 for each, and at most 16 MB.
BITS_PER_PAIR = 16
MAX_FILTER_BITS = 1 << 27
HASHES = 4
SALTS = 16
_OUT_ROWS = 50_000
# Bytes between words of a piece, and bytes between pieces.
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"

_ROWS = "lang string, phrase string, n long"


def _kinds() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(BLANKS)] = 1
    table[list(BREAKS)] = 2
    return table


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def words_of(data: np.ndarray, offsets: np.ndarray, lower: np.ndarray, kinds: np.ndarray
             ) -> tuple[pa.Array, np.ndarray, np.ndarray, bool, bool]:
    """(words, part of each, whether a piece begins there, break before the first word, break behind the last).

    The flag of the first word is left False: what stands before it may be in an earlier part.
    """
    kind = kinds[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends_before = np.cumsum(inside, dtype=np.int32)
    broken = np.cumsum(kind == 2, dtype=np.int32)
    n = len(starts)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool), bool(len(broken) and broken[-1]), False
    bounds = np.append(ends_before[starts] - 1, ends_before[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(n, pa.py_buffer(bounds), pa.py_buffer(lower[data[inside]]))
    part = np.searchsorted(offsets, starts, "right") - 1
    fresh = np.zeros(n, bool)
    fresh[1:] = (broken[starts[1:]] != broken[starts[:-1]]) | (part[1:] != part[:-1])
    return words, part, fresh, bool(broken[starts[0]]), bool(broken[-1] != broken[starts[-1]])


class ShardIndex:
    """Both transforms of one shard's words, sorted to ``DEPTH`` words."""

    def __init__(self, symbols: np.ndarray, fresh: np.ndarray):
        """``symbols``: word ids from 1; ``fresh``: where a piece begins. 0 stands between pieces."""
        begins = np.cumsum(fresh | (np.arange(len(fresh)) == 0))
        text = np.zeros(len(symbols) + int(begins[-1]) + 1 if len(symbols) else 1, np.int64)
        if len(symbols):
            text[np.arange(len(symbols)) + begins] = symbols
        self.size = int(text.max()) + 1
        self.before, self.back = self._transform(text)
        self.after, self.ahead = self._transform(text[::-1])
        self.counts = np.bincount(text, minlength=self.size)
        self.starts = np.cumsum(self.counts) - self.counts

    @staticmethod
    def _transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol before each sorted suffix, place of the suffix that begins with it)."""
        n, rank, width = len(text), text, 1
        while width < DEPTH:
            shifted = np.zeros(n, np.int64)
            shifted[:max(n - width, 0)] = rank[width:]
            key = rank * (int(rank.max()) + 1) + shifted
            width *= 2
            if width < DEPTH:
                _, rank = np.unique(key, return_inverse=True)
        order = np.argsort(key, kind="stable")
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        return text[order - 1].astype(np.int32), place[order - 1]

    def words(self) -> Phrases:
        used = np.flatnonzero(self.counts[1:]) + 1
        return Phrases(used[:, None], self.starts[used], self.starts[used], self.counts[used])

    def extend(self, phrases: Phrases, left: bool) -> Phrases:
        """All extensions of the phrases by one word on one side, with both their intervals."""
        symbol, step = (self.before, self.back) if left else (self.after, self.ahead)
        own, other = (phrases.forward, phrases.reverse) if left else (phrases.reverse, phrases.forward)
        ends = np.cumsum(phrases.count)
        if not len(ends):
            return phrases.grown(np.zeros(0, np.int64), np.zeros(0, np.int64), left, own, other, phrases.count)
        owner = np.repeat(np.arange(len(ends)), phrases.count)
        places = np.arange(ends[-1]) + np.repeat(own - (ends - phrases.count), phrases.count)
        order = np.argsort(owner * self.size + symbol[places], kind="stable")
        owner, places = owner[order], places[order]
        added = symbol[places].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (added[1:] != added[:-1])]))
        count = np.diff(np.append(first, len(owner)))
        owner, added = owner[first], added[first]
        # in the other transform an extension lies behind those by smaller symbols
        shifted = other[owner] + first - (ends - phrases.count)[owner]
        found = phrases.grown(owner, added, left, np.minimum.reduceat(step[places], first), shifted, count)
        return found.where(added > 0)


class Phrases:
    """Phrases of one length: symbols, intervals in both transforms, and counts."""

    def __init__(self, symbols: np.ndarray, forward: np.ndarray, reverse: np.ndarray, count: np.ndarray):
        self.symbols, self.forward, self.reverse, self.count = symbols, forward, reverse, count

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.symbols[keep], self.forward[keep], self.reverse[keep], self.count[keep])

    def grown(self, owner, added, left, own, other, count) -> Phrases:
        parts = (added[:, None], self.symbols[owner]) if left else (self.symbols[owner], added[:, None])
        return Phrases(np.hstack(parts), own if left else other, other if left else own, count)


class Shard:
    """An index with the names of its symbols: a symbol is a word of one language."""

    def __init__(self, words: pa.ChunkedArray, langs: np.ndarray, fresh: np.ndarray, names: pa.Array):
        coded = words.combine_chunks().dictionary_encode()
        ids = coded.indices.to_numpy().astype(np.int64)
        pairs, symbols = np.unique(langs * np.int64(len(coded.dictionary)) + ids, return_inverse=True)
        self.word = coded.dictionary.take(pa.array(pairs % len(coded.dictionary)))
        self.lang = names.take(pa.array(pairs // len(coded.dictionary)))
        self.index = ShardIndex(symbols + 1, fresh)

    def texts(self, phrases: Phrases) -> tuple[pa.Array, pa.Array]:
        """Language and words of each phrase, joined by spaces."""
        columns = [self.word.take(pa.array(phrases.symbols[:, k] - 1)) for k in range(phrases.symbols.shape[1])]
        return (self.lang.take(pa.array(phrases.symbols[:, 0] - 1)),
                columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, " "))


def shards(source: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Shard, int]]:
    """(shard, 1) of a task's rows (text, lang), and (overlap, -1) of what two shards share; ``size`` is over ``DEPTH``."""
    kinds, lower = _kinds(), _lower()
    words, langs, fresh, held, known = [], [], [], 0, {}
    open_ = False

    def shard(words, langs, fresh):
        return Shard(pa.chunked_array(words, pa.string()), np.concatenate(langs), np.concatenate(fresh),
                     pa.array(list(known), pa.string()))

    for batch in source:
        named = batch.column(1).dictionary_encode()
        codes = np.array([known.setdefault(x, len(known)) for x in named.dictionary.to_pylist()], np.int64)
        codes = codes[named.indices.to_numpy()]
        for data, offsets, rows, goes_on in chunks(batch.column(0), kinds > 0):
            found, part, starts, before, behind = words_of(data, offsets, lower, kinds)
            open_ = open_ and goes_on and not before
            if not len(found):
                continue
            starts[0] = not open_
            open_ = not behind
            done = 0
            while done < len(found):
                take = min(len(found) - done, size - held)
                words.append(found.slice(done, take))
                langs.append(codes[rows[part[done:done + take]]])
                fresh.append(starts[done:done + take])
                held, done = held + take, done + take
                if held == size:
                    yield shard(words, langs, fresh), 1
                    # phrases over the cut begin in these words, which both shards then hold
                    tail = DEPTH - 1
                    words = [pa.concat_arrays(words).slice(size - tail)]
                    langs, fresh = [np.concatenate(langs)[-tail:]], [np.concatenate(fresh)[-tail:]]
                    yield shard(words, langs, fresh), -1
                    held = tail
    if held:
        yield shard(words, langs, fresh), 1


def _rows(lang: pa.Array, phrase: pa.Array, count: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(count), _OUT_ROWS):
        yield pa.record_batch([lang.slice(at, _OUT_ROWS), phrase.slice(at, _OUT_ROWS),
                               pa.array(count[at:at + _OUT_ROWS], pa.int64())], names=["lang", "phrase", "n"])


def _short(size: int):
    """Words and pairs of each shard; the empty phrase counts all words of a language."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, sign in shards(source, size):
            single = shard.index.words()
            lang, word = shard.texts(single)
            total = pa.table([lang, pa.array(single.count)], names=["lang", "n"]).group_by("lang").aggregate([("n", "sum")])
            names = total["lang"].combine_chunks()
            yield from _rows(names, pa.array([""] * len(names)), sign * total["n_sum"].to_numpy())
            yield from _rows(lang, word, sign * single.count)
            pairs = shard.index.extend(single, left=True)
            yield from _rows(*shard.texts(pairs), sign * pairs.count)

    return run


def _hash_bits(lang: pa.Array, phrase: pa.Array, bits: int) -> np.ndarray:
    """``HASHES`` bit numbers for each phrase of a language."""
    joined = pc.binary_join_element_wise(lang, phrase, "\t").cast(pa.large_string())
    _, where, data = joined.buffers()
    offsets = np.frombuffer(where, np.int64)[joined.offset:joined.offset + len(joined) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    key = tb.span_hashes(data[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0], offsets[1:] - offsets[0])
    return np.stack([tb.mix(key + np.uint64(k)) % np.uint64(bits) for k in range(HASHES)], 1).astype(np.int64)


def pair_filter(pairs: DataFrame, count: int) -> np.ndarray:
    """Bloom filter of the pairs (lang, phrase) as 64-bit words; ``count`` is about their number."""
    bits = 64
    while bits < min(BITS_PER_PAIR * count, MAX_FILTER_BITS):
        bits *= 2

    def set_bits(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows:
                bit = _hash_bits(batch.column(0), batch.column(1), bits).ravel()
                mask = np.left_shift(np.uint64(1), (bit & 63).astype(np.uint64)).astype(np.int64)
                yield pa.record_batch([pa.array(bit >> 6), pa.array(mask)], names=["at", "mask"])

    found = (pairs.select("lang", "phrase").mapInArrow(set_bits, "at long, mask long")
             .groupBy("at").agg(F.bit_or("mask").alias("mask")).toPandas())
    held = np.zeros(bits // 64, np.uint64)
    held[found["at"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).astype(np.uint64)
    return held


def _may_hold(held: np.ndarray, lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    if not len(phrase):
        return np.zeros(0, bool)
    bit = _hash_bits(lang, phrase, 64 * len(held))
    return ((held[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).all(1)


def _long(size: int, held: np.ndarray):
    """Phrases of three and four words whose pairs are all in the filter."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, sign in shards(source, size):
            index = shard.index
            pairs = index.extend(index.words(), left=True)
            grown = pairs = pairs.where(_may_hold(held, *shard.texts(pairs)))
            codes = np.sort(pairs.symbols[:, 0] * index.size + pairs.symbols[:, 1])
            if not len(codes):
                continue
            for words in range(3, DEPTH + 1):
                # right and left in turn: each reads the transform of that side
                left = words % 2 == 0
                grown = index.extend(grown, left)
                ends = grown.symbols[:, :2] if left else grown.symbols[:, -2:]
                code = ends[:, 0] * index.size + ends[:, 1]
                grown = grown.where(codes[np.minimum(np.searchsorted(codes, code), len(codes) - 1)] == code)
                yield from _rows(*shard.texts(grown), sign * grown.count)

    return run


def phrase_counts(documents: DataFrame, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang",
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, phrase, n: every phrase of up to ``DEPTH`` words seen at least ``min_count`` times, and '' for all words."""
    rows = documents.select(text_column(documents, text).alias("text"),
                            F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    summed = lambda frame: frame.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    short = written(summed(rows.mapInArrow(_short(shard_words), _ROWS)).where((F.col("n") >= min_count) | (F.col("phrase") == "")),
                    "short-phrases")
    pairs = short.where(F.col("phrase").contains(" "))
    held = pair_filter(pairs, pairs.count())
    longer = written(summed(rows.mapInArrow(_long(shard_words, held), _ROWS)).where(F.col("n") >= min_count), "long-phrases")
    return short.unionByName(longer)


def _subphrases(words: Column) -> Column:
    """The shorter phrases of two words or more inside a phrase, with repeats."""
    return F.flatten(F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1), lambda at: F.array_join(F.slice(words, at, size), " "))))


def collocations(counts: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases by their weakest cut.

    Ranks are taken in two steps, inside salts of the phrase first, so the last
    step sorts at most ``SALTS * top`` rows of a language.
    """
    phrases = (counts.where(F.col("phrase").contains(" ") & (F.col("n") >= min_count))
               .select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words")))
    inside = (phrases.where(F.size("words") > 2)
              .select("lang", F.explode(F.array_distinct(_subphrases(F.col("words")))).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    open_ = (phrases.join(inside, ["lang", "phrase"], "left")
             .where(F.col("longer").isNull() | (100 * F.col("longer") < INSIDE_PERCENT * F.col("a"))).drop("longer"))
    cut = lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice("words", k + 1, F.size("words") - k), " ").alias("rest"))
    cuts = open_.select("lang", "phrase", "a", F.inline(F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut)))
    part = lambda name, count: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
              # exact: the product may pass 64 bits
              .withColumn("score", F.expr("(cast(2000000 as decimal(19,0)) * cast(a as decimal(19,0))) div "
                                          "(cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*best)
    ranked = (scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
              .where(F.col("rank") <= top))
    total = counts.where(F.col("phrase") == "").select("lang", "n")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(documents: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, text: str = "text", lang: str = "lang",
         shard_words: int = SHARD_WORDS) -> DataFrame:
    """The collocations of each language of ``documents``."""
    return collocations(phrase_counts(documents, min_count, text, lang, shard_words), min_count, top)
