"""MinHash-style near-duplicates with SetSketch registers.

A document's set of word shingles is held in registers: each is the truncated,
exponentially spaced minimum of one hash over the set. Registers merge by
maximum, agree about as often as two sets overlap, and bands of them bring
similar sets into one bucket. What shares a bucket is estimated jointly from
the registers by likelihood and confirmed on the full sets.

Sets that are equal are one class with one representative. A bucket never emits
all its pairs: members are first held against the bucket's smallest one; then a
spanning forest of the strongest estimates joins the components that are left,
in blocks of bounded size; at last the likely pairs whose components still
differ are confirmed inside their blocks, so no link that joins is lost and only
links leave a task.

Null or empty texts, or texts without a word, have an empty set and link with
nothing. A text with fewer words than a shingle is one shingle. Repeated rows
are copies of each other; null ids stand for themselves. An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm import textblocks as tb
from catalograph.llm.components import components, forest
from catalograph.llm.support import slices, text_column, unused, written

SHINGLE = 5
PERCENT = 75
REGISTERS = 128
ROWS = 4  # 32 bands of 4: a pair at 0.75 shares none with probability 5e-6
BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 2
# Five standard deviations of the estimate below the threshold; what is under it is not confirmed.
MARGIN = 0.2
BLOCK = 512


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of each text, by row."""
    starts, ends, bounds = tb.word_spans(data, offsets)
    hashes = tb.span_hashes(data, starts, ends, lower=True)
    found, first = tb.windows(hashes, bounds, SHINGLE)
    rows = tb.row_of(bounds)
    keys, owner = [found], [rows[first]]
    sizes = np.diff(bounds)
    for size in range(1, SHINGLE):
        short = np.flatnonzero(sizes == size)
        if len(short):
            whole, at = tb.windows(hashes, bounds, size, seed=100 + size)
            own = sizes[rows[at]] == size
            keys.append(whole[own])
            owner.append(rows[at][own])
    keys, owner = np.concatenate(keys), np.concatenate(owner)
    if len(keys) > 1:
        order = np.argsort(owner, kind="stable")
        keys, owner = keys[order], owner[order]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        keys[a:b].sort()
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[fresh], owner[fresh]


def registers(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SetSketch registers of non-empty sets: one row of ``REGISTERS`` 16-bit values each.

    A uniform minimum over the set stands for the smallest of its exponential
    variables; the register is its logarithm, rounded.
    """
    odd = tb.numbers(21, REGISTERS) | np.uint64(1)
    plus = tb.numbers(22, REGISTERS)
    low = np.empty((len(bounds) - 1, REGISTERS), np.uint64)
    for j in range(REGISTERS):
        low[:, j] = np.minimum.reduceat((keys * odd[j] + plus[j]) >> np.uint64(32), bounds[:-1])
    x = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def bands(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of each row."""
    n = REGISTERS // ROWS
    value = sketch.astype(np.uint64).reshape(len(sketch), n, ROWS)
    packed = value[:, :, 0]
    for k in range(1, ROWS):
        packed = (packed << np.uint64(16)) | value[:, :, k]
    return tb.mix(packed ^ tb.numbers(23, n)[None, :]).astype(np.int64)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def joint_likelihood(j: np.ndarray, above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Log-likelihood of a similarity, from the counts of larger and smaller registers and the sets' sizes."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    more, less = _p(np.maximum(u - v * j, 1e-12)), _p(np.maximum(v - u * j, 1e-12))
    return (above * np.log(np.maximum(more, 1e-12)) + below * np.log(np.maximum(less, 1e-12))
            + (REGISTERS - above - below) * np.log(np.maximum(1 - more - less, 1e-12)))


def joint_jaccard(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity. The likelihood is concave: its maximum is found by narrowing the interval."""
    low, high = np.zeros(len(n_a)), np.minimum(n_a / n_b, n_b / n_a)
    for _ in range(20):
        third = (high - low) / 3
        left, right = low + third, high - third
        rising = joint_likelihood(left, above, below, n_a, n_b) < joint_likelihood(right, above, below, n_a, n_b)
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    return (low + high) / 2


def likely(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the estimate reaches the threshold less the margin: the concave likelihood still rises there."""
    at = PERCENT / 100 - MARGIN
    return (joint_likelihood(at + 1e-3, above, below, n_a, n_b) >= joint_likelihood(at - 1e-3, above, below, n_a, n_b))


def sketch_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n, set key (two 64-bit sums over the set), registers (binary) and buckets."""

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            done = 0
            for data, offsets in slices(batch.column(1)):
                n = len(offsets) - 1
                keys, owner = shingles(data, offsets)
                size = np.bincount(owner, minlength=n)
                filled = np.flatnonzero(size)
                bounds = np.concatenate([[0], np.cumsum(size[filled])])
                parts = np.zeros((2, n), np.uint64)
                sketch, buckets = [None] * n, [[]] * n
                if len(filled):
                    for k in (0, 1):
                        parts[k, filled] = set_keys(keys, bounds, k)
                    held = registers(keys, bounds)
                    own = bands(held)
                    for i, row in enumerate(filled):
                        sketch[row], buckets[row] = held[i].tobytes(), own[i]
                yield pa.record_batch([
                    batch.column(0).slice(done, n), pa.array(size.astype(np.int64)), pa.array(parts[0].astype(np.int64)),
                    pa.array(parts[1].astype(np.int64)), pa.array(sketch, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "key1", "key2", "sketch", "buckets"])
                done += n

    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents).alias("text"))
            .mapInArrow(rows, "doc_id long, n long, key1 long, key2 long, sketch binary, buckets array<long>"))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def are_likely(sketch_a: Column, sketch_b: Column, n_a: Column, n_b: Column) -> Column:
    def values(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        x, y = _sketches(a), _sketches(b)
        return pa.array(likely((x > y).sum(1), (x < y).sum(1), c.to_numpy(), d.to_numpy()))

    return F.arrow_udf(values, "boolean")(sketch_a, sketch_b, n_a, n_b)


def _sizes_fit(n_a: Column, n_b: Column) -> Column:
    return 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and estimate allow a link."""
    side = lambda k: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col("sketch").alias(f"s_{k}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(_sizes_fit(F.col("n_a"), F.col("n_b")))
            .withColumn("likely", are_likely(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b")))
            .where("likely").select("a", "b"))


def set_keys(keys: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit sum over each non-empty set; two of them (k = 0, 1) tell sets apart."""
    return np.add.reduceat(tb.mix(keys + np.uint64(k << 40)), bounds[:-1])


def shingle_sets(text: Column) -> Column:
    """``struct<set, key1>``: the full set of a text's shingles and its first key (0 for an empty set)."""

    def sets(texts: pa.Array) -> pa.Array:
        parts, sums = [], []
        for data, offsets in slices(texts):
            keys, owner = shingles(data, offsets)
            size = np.bincount(owner, minlength=len(offsets) - 1)
            own = np.zeros(len(size), np.uint64)
            if len(keys):
                own[size > 0] = set_keys(keys, np.concatenate([[0], np.cumsum(size[size > 0])]), 0)
            parts.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                                                  pa.array(keys.astype(np.int64))))
            sums.append(pa.array(own.astype(np.int64)))
        return pa.StructArray.from_arrays([
            pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64())),
            pa.concat_arrays(sums) if sums else pa.array([], pa.int64())], ["set", "key1"])

    return F.arrow_udf(sets, "struct<set:array<long>,key1:long>")(text)


def class_sets(reps: DataFrame, documents: DataFrame, ids: DataFrame) -> DataFrame:
    """rep and full set of the asked classes; only texts that stand for one are read into sets.

    ``ids``: rep, doc_id and first key of each class.
    """
    wanted = reps.select("rep").distinct().join(ids, "rep")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_column(documents).alias("text"))
    # no filter on the set stands before the write: it would move the sets in front of the join
    sets = written(texts.join(wanted, "doc_id").select("rep", "key1", shingle_sets(F.col("text")).alias("own")), "sets")
    # an id can have several texts: the one with the class's set stands for it, once
    return sets.where("key1 = own.key1").select("rep", F.col("own.set").alias("set")).dropDuplicates(["rep"])


def confirmed(pairs: DataFrame, documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    pairs = written(pairs, "candidates")
    sets = class_sets(pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))), documents, ids)
    side = lambda k: sets.select(F.col("rep").alias(k), F.col("set").alias(f"set_{k}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(100 * both >= PERCENT * (F.size("set_a") + F.size("set_b") - both)).select("a", "b").distinct())


def _likely_in(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, equal registers) of the likely pairs of different components among a run's one or two blocks."""
    root, n = rows.column("root").to_numpy(), rows.column("n").to_numpy()
    side, sketch = rows.column("side").to_numpy(), _sketches(rows.column("sketch"))
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same, found = not len(y), ([], [], [])
    for i in x:
        other = x[x > i] if same else y
        other = other[(root[other] != root[i]) & (100 * np.minimum(n[other], n[i]) >= PERCENT * np.maximum(n[other], n[i]))]
        if len(other):
            a, b = sketch[i][None, :], sketch[other]
            above, below = (a > b).sum(1), (a < b).sum(1)
            fit = likely(above, below, np.full(len(other), n[i]), n[other])
            for column, value in zip(found, (np.full(fit.sum(), i), other[fit], (REGISTERS - above - below)[fit])):
                column.append(value)
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in found)


def _strongest(i: np.ndarray, j: np.ndarray, equal: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Which pairs form a spanning forest of the components, most equal registers first."""
    _, label = np.unique(root, return_inverse=True)
    chosen = np.zeros(len(i), bool)
    while True:
        a, b = label[i], label[j]
        open_ = np.flatnonzero(a != b)
        if not len(open_):
            return chosen
        order = open_[np.argsort(-equal[open_], kind="stable")]
        # the first pair of each component in this order is its strongest
        ends = np.stack([a[order], b[order]], 1).ravel()
        _, first = np.unique(ends, return_index=True)
        best = first // 2
        picked = order[np.unique(best)]
        chosen[picked] = True
        away, to = forest(a[picked], b[picked])
        step = np.arange(label.max() + 1)
        step[away] = to
        label = step[label]


def _confirmed_in(rows: pa.RecordBatch, i: np.ndarray, j: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Which likely pairs are links and join what is apart; the sets are compared here, most equal registers first."""
    _, label = np.unique(rows.column("root").to_numpy(), return_inverse=True)
    parent, sets, chosen = np.arange(label.max() + 1), rows.column("set"), np.zeros(len(i), bool)
    held: dict[int, np.ndarray] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def own(k: int) -> np.ndarray:
        if k not in held:
            held[k] = sets[k].values.to_numpy()
        return held[k]

    for at in np.argsort(-equal, kind="stable"):
        a, b = int(i[at]), int(j[at])
        x, y = root(label[a]), root(label[b])
        if x != y:
            both = len(np.intersect1d(own(a), own(b), assume_unique=True))
            if 100 * both >= PERCENT * (len(own(a)) + len(own(b)) - both):
                parent[max(x, y)], chosen[at] = min(x, y), True
    return chosen


def _block_pairs(spanning: bool):
    """Inside each run of equal ``key``: a spanning forest of likely pairs, or the links that join what is apart.

    Rows come sorted by key; a run holds two blocks at most. Links are confirmed
    on the sets that the rows carry, so likely pairs that are none never leave the task.
    """

    def pairs_of(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        i, j, equal = _likely_in(rows)
        rep = rows.column("rep").to_numpy()
        if len(i):
            keep = _strongest(i, j, equal, rows.column("root").to_numpy()) if spanning else _confirmed_in(rows, i, j, equal)
            i, j = i[keep], j[keep]
        return np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in source:
            table = pa.Table.from_batches([*([held] if held is not None else []), batch]).combine_chunks()
            if not len(table):
                continue
            whole = table.to_batches()[0]
            key = whole.column("key").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield pa.record_batch([pa.array(v) for v in pairs_of(whole.slice(a, b - a))], names=["a", "b"])
            held = whole.slice(cuts[-1])
        if held is not None:
            yield pa.record_batch([pa.array(v) for v in pairs_of(held)], names=["a", "b"])

    return run


def _rest_pairs(rows: DataFrame, roots: DataFrame, classes: DataFrame, spanning: bool, documents: DataFrame,
                ids: DataFrame) -> DataFrame:
    """Pairs of one bucket that could join (``spanning``) or do join components that differ so far."""
    named = rows.join(roots.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep"))
    mixed = (named.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("r1"), F.max("root").alias("r2"))
             .where("r1 < r2").select("bucket", "size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (named.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("rep", "root", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
                      (F.col("own") > F.col("other")).cast("int").alias("side")))
    parts = classes.select("rep", "n", "sketch")
    if not spanning:
        placed = written(placed, "placed")
        parts = parts.join(class_sets(placed, documents, ids), "rep")
    # few bytes but much work a row: a fixed number of tasks, else adaptive execution merges them
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.join(parts, "rep").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(_block_pairs(spanning), "a long, b long").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``documents``."""
    sketched = written(sketch_documents(documents), "sketches")
    filled = sketched.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy("key1", "key2", "n").agg(F.min(F.struct("doc_id", "sketch", "buckets")).alias("m"))
                      .select(F.col("m.doc_id").alias("rep"), "key1", "key2", "n", F.col("m.sketch").alias("sketch"),
                              F.col("m.buckets").alias("buckets"))
                      # one id can own several different texts: classes are numbered apart from ids
                      .withColumn("first", F.col("rep")).withColumn("rep", F.monotonically_increasing_id()), "classes")
    ids = classes.select("rep", F.col("first").alias("doc_id"), "key1", "key2")
    exploded = classes.select("rep", F.explode("buckets").alias("bucket"))
    low = exploded.groupBy("bucket").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = written(exploded.join(low.select("bucket", "low"), "bucket"), "buckets")
    stars = rows.where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    # first one partner each, then the strongest pairs that could join what is apart, then all that are left
    nearest = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    roots = components(confirmed(likely_pairs(nearest, classes), documents, ids))
    members = rows.select("rep", "bucket")
    for spanning in (True, False):
        more = _rest_pairs(members, roots, classes, spanning, documents, ids)
        more = written(confirmed(more, documents, ids) if spanning else more, "links")
        if not more.isEmpty():
            roots = components(roots.union(more))
    of_class = (classes.join(roots.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
                .withColumn("root", F.coalesce("root", "rep")))
    # a component is named after the smallest document in it
    names = of_class.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = of_class.join(names, "root").select("key1", "key2", "n", "component_id")
    return (sketched.select("doc_id", "n", "key1", "key2").join(of_class, ["key1", "key2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` that stand for their group: the smallest id of each component.

    Ids decide: a row goes if a text under its id belongs to a group with a
    smaller id. Rows that repeat a kept id stay, as do null ids.
    """
    judged = near_duplicates(documents)
    name = unused(documents, "__dropped")
    dropped = judged.where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return documents.join(dropped, F.col("doc_id").cast("long") == F.col(name), "left_anti")
