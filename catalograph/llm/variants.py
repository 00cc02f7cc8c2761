"""Spelling variants: a variable-length gram index over the distinct words.

Grams have two to five characters. The dictionary holds the frequent ones: at
each place of a word the gram grows while what it has so far is frequent, so
common beginnings get longer, rarer grams. One edit can only touch grams that
cover it; the largest number of them over all places is the word's bound. Two
words one edit apart therefore share all but as many of their grams, and so
share one among the ``bound + 1`` rarest of each. Words meet under these grams
by length, longer lists are split by what surrounds the edit, and every
candidate is verified by its edit distance.

A null text has no words; a null id reads as an empty one. Repeated rows count
as often as they stand there. Runs of letters of any length are words; an empty
table gives no rows; columns besides text and id are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.support import chunks, text_column, written

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10
# One occurrence in so many loses a character, by the checksum of id and run.
NOISE = 31
SHORTEST, LONGEST = 2, 5
# A gram is frequent above this many places, or above one in DICTIONARY of all places:
# at most 3 * DICTIONARY grams are frequent, which bounds the list that tasks get.
FREQUENT = 50
DICTIONARY = 20_000
# A list of more words is split by the text around the edit, in at most so many parts.
LIST = 1_024
PARTS = 64
# Longer words are verified by their common beginning and end.
SHORT = 255
# A chain of forms grows by FORM_FACTOR each step, so five doublings pass any 64-bit count.
DOUBLINGS = 5
_WORDS = 1 << 20
_CRC_POLYNOMIAL = 0xEDB88320
_VECTOR_BYTES = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_CRC_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def crc32_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte span, going on from the CRC-32 of what stands before it (``seeds``)."""
    state = ~seeds.astype(np.uint32)
    length = ends - starts
    order = np.argsort(length, kind="stable")
    for k in range(int(min(length.max(initial=0), _VECTOR_BYTES))):
        live = order[np.searchsorted(length[order], k, "right"):]
        state[live] = table[(state[live] ^ data[starts[live] + k]) & 0xFF] ^ (state[live] >> 8)
    state = ~state
    for i in order[np.searchsorted(length[order], _VECTOR_BYTES, "right"):]:
        state[i] = zlib.crc32(data[starts[i]:ends[i]], int(seeds[i]))
    return state


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes are of letters A-Z, a-z or U+00C0 to U+00FF (lead byte C3)."""
    low = data | 0x20
    lead = data == 0xC3
    found = ((low >= 97) & (low <= 122) & (data < 0x80)) | lead
    found[1:] |= lead[:-1]
    return found


def _cuts() -> np.ndarray:
    """Bytes behind which no run of letters goes on: ASCII without the letters."""
    table = np.zeros(256, bool)
    table[:128] = True
    table[65:91] = table[97:123] = False
    return table


def words_in(data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray, table: np.ndarray, min_length: int) -> pa.Array:
    """The words of a run of texts after the noise; ``seeds``: the checksum of each text's id and colon."""
    letter = letter_bytes(data)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    begins = (data & 0xC0) != 0x80
    upto = np.zeros(len(data) + 1, np.int32)
    np.cumsum(begins, out=upto[1:])
    size = upto[ends] - upto[starts]
    long_ = size >= min_length
    starts, ends, size = starts[long_], ends[long_], size[long_]
    lower = np.where((data >= 65) & (data <= 90), data | 0x20, data)
    row = np.searchsorted(offsets, starts, "right") - 1
    check = crc32_of(lower, starts, ends, seeds[row], table)
    noisy = check % NOISE == 0
    taken = np.zeros(len(data) + 1, np.int8)
    taken[starts] += 1
    taken[ends] -= 1
    keep = np.cumsum(taken[:-1], dtype=np.int8) > 0
    lost = np.flatnonzero(begins)[upto[starts[noisy]] + check[noisy] % size[noisy]]
    keep[lost] = False
    keep[lost[data[lost] == 0xC3] + 1] = False
    kept = np.zeros(len(data) + 1, np.int32)
    np.cumsum(keep, out=kept[1:])
    bounds = np.append(kept[starts], kept[-1]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(lower[keep]))
    return words.filter(pa.array(size - noisy >= min_length))


def word_counts(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """word, n: the distinct words of all texts, lower-cased in A-Z, with the noise applied."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cuts, held, waiting = _crc_table(), _cuts(), [], 0

        def counted() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.string()))
            return pa.record_batch([found.field("values"), found.field("counts")], names=["word", "n"])

        for batch in source:
            ids = batch.column(1).to_pylist()
            for data, offsets, rows, _ in chunks(batch.column(0), cuts):
                seeds = np.array([zlib.crc32(f"{ids[r]}:".encode()) for r in rows], np.uint32)
                held.append(words_in(data, offsets, seeds, table, min_length))
                waiting += len(held[-1])
                if waiting >= _WORDS:
                    yield counted()
                    held, waiting = [], 0
        if waiting:
            yield counted()

    return (documents.select(text_column(documents, text).alias("text"),
                             F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"))
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def frequent_grams(words: DataFrame, frequent: int = FREQUENT) -> dict[str, int]:
    """Frequent grams below the longest size with their number of places, at most 3 * DICTIONARY."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                   names=["gram", "places"])

        for batch in source:
            for word in batch.column(0).to_pylist():
                for q in range(SHORTEST, LONGEST):
                    held.update(word[at:at + q] for at in range(len(word) - q + 1))
                if len(held) > _WORDS:
                    yield counted()
                    held.clear()
        yield counted()

    total = words.agg(F.sum(F.length("word") - SHORTEST + 1)).first()[0] or 0
    limit = max(frequent, -(-total // DICTIONARY))
    found = (words.select("word").mapInArrow(run, "gram string, places long").groupBy("gram")
             .agg(F.sum("places").alias("places")).where(F.col("places") > limit).collect())
    return {r["gram"]: r["places"] for r in found}


def grams_of(word: str, frequent: dict[str, int]) -> tuple[list[str], int]:
    """(the gram at each place, how many of them one edit can touch at most)."""
    n, found, open_ends = len(word), [], 0
    cover = [0] * (n + 1)
    for at in range(n - SHORTEST + 1):
        end = at + SHORTEST
        while end - at < LONGEST and end < n and word[at:end] in frequent:
            end += 1
        # a gram that only the word's end has stopped also changes when a character is added there
        open_ends += end == n and end - at < LONGEST and word[at:end] in frequent
        found.append(word[at:end])
        cover[at] += 1
        cover[end] -= 1
    touched = most = 0
    for change in cover:
        touched += change
        most = max(most, touched)
    return found, max(most, open_ends)


def rarest(word: str, frequent: dict[str, int]) -> list[str]:
    """The ``bound + 1`` rarest grams; repeats of a gram in a word are numbered."""
    found, bound = grams_of(word, frequent)
    seen: dict[str, int] = {}

    def numbered():
        for gram in found:
            seen[gram] = seen.get(gram, 0) + 1
            yield frequent.get(gram, 0), gram, seen[gram]

    return [f"{gram}{k}" for _, gram, k in heapq.nsmallest(bound + 1, numbered())]


def _around(word: Column, length: Column) -> Column:
    """Numbers for a word as one side of a pair whose shorter word has ``length`` characters: one for each
    part that the edit may lie in, of what stands before and behind that part."""
    parts = F.least(length, F.lit(PARTS))
    begin = lambda k: F.floor(k * length / parts).cast("int")
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.xxhash64(
        length, k, F.substring(word, F.lit(1), begin(k)), F.right(word, length - begin(k + 1))))


def near_pairs(words: DataFrame, frequent: int = FREQUENT, list_limit: int = LIST, min_length: int = MIN_LENGTH) -> DataFrame:
    """a, b, n_a, n_b: each pair of words exactly one inserted, deleted or replaced code point apart, once."""
    if min_length - SHORTEST + 1 <= LONGEST:
        raise ValueError("an edit may touch every gram of words this short")
    known = frequent_grams(words, frequent)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                yield pa.record_batch([*part.columns, pa.array([rarest(w, known) for w in part.column(0).to_pylist()],
                                                               pa.list_(pa.string()))], names=["word", "n", "grams"])

    # the shorter word of a pair stands on side 0; a word is both one of equal length and the longer one
    sides = F.explode(F.array(F.struct(F.length("word").alias("length"), F.lit(0).alias("side")),
                              F.struct((F.length("word") - 1).alias("length"), F.lit(1).alias("side"))))
    rows = written(
        words.select("word", "n").mapInArrow(run, "word string, n long, grams array<string>")
        .select("word", "n", F.explode("grams").alias("gram"))
        .select("word", "n", "gram", sides.alias("s")).where(F.col("s.length") >= min_length)
        .select("word", "n", "s.side", F.xxhash64("gram", "s.length").alias("key")), "grams")
    long_lists = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > list_limit).select("key")
    a = rows.where("side = 0").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = rows.select("key", "side", F.col("word").alias("b"), F.col("n").alias("n_b"))

    def split(side: DataFrame, word: str, length: Column) -> DataFrame:
        """Each word of a long list, once whatever the number of its lists, by what surrounds the edit."""
        names = [c for c in side.columns if c != "key"]
        return (side.join(long_lists, "key", "left_semi").select(*names).distinct()
                .select(*names, F.explode(_around(F.col(word), length)).alias("key")))

    def met(low: int, high: int, one_edit: Column) -> DataFrame:
        """The pairs whose first word has ``low`` to ``high`` characters; the second has at most one more."""
        first, second = a.where(F.length("a").between(low, high)), b.where(F.length("b").between(low, high + 1))
        pairs = first.join(long_lists, "key", "left_anti").join(second, "key").select("a", "b", "n_a", "n_b", "side").union(
            split(first, "a", F.length("a")).join(split(second, "b", F.length("b") - F.col("side")), "key")
            .select("a", "b", "n_a", "n_b", "side"))
        return pairs.where((F.col("side") == 1) | (F.col("a") < F.col("b"))).where(one_edit).select("a", "b", "n_a", "n_b")

    found = met(0, SHORT, F.levenshtein("a", "b", 1) == 1)
    # the built-in distance takes a time that grows with the square of the length
    if not rows.where(F.length("word") > SHORT).isEmpty():
        found = found.union(met(SHORT + 1, (1 << 31) - 2, one_apart(F.col("a"), F.col("b"))))
    return found.distinct()


def one_apart(a: Column, b: Column) -> Column:
    """Whether two different words, the first no longer than the second, are one edit apart; linear in their length."""

    def compare(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left.to_pylist(), right.to_pylist()):
            low, high = 0, len(x)
            while low < high:  # the longest common beginning
                middle = (low + high + 1) // 2
                low, high = (middle, high) if x[low:middle] == y[low:middle] else (low, middle - 1)
            out.append(len(y) - len(x) <= 1 and x[low + (len(x) == len(y)):] == y[low + 1:])
        return pa.array(out, pa.bool_())

    return F.arrow_udf(compare, "boolean")(a, b)


def variants(words: DataFrame, factor: int = FORM_FACTOR, frequent: int = FREQUENT, list_limit: int = LIST,
             min_length: int = MIN_LENGTH) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n; words distinct)."""
    words = written(words.select("word", "n"), "words")
    pairs = written(near_pairs(words, frequent, list_limit, min_length), "near")
    both = pairs.select("a", F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(pairs.select("b", "a", "n_a"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("top"))
    is_form = -F.col("top.m") >= factor * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("top.near")).alias("form"),
        F.when(is_form, -F.col("top.m")).alias("form_n")), "forms")
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        roots = written(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root").isEmpty():
            break
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The variants of the words of ``documents``."""
    return variants(word_counts(documents, text=text, doc_id=doc_id))
