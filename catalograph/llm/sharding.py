"""Shards cut from a Hilbert curve through several metadata dimensions.

Every dimension is quantised to a few bits, the cell's place on the curve orders
the rows, and the ordered rows are cut into shards of equal length, so a shard
spans a narrow range in every dimension and filters on any of them skip shards.

Only built-in functions run. The text itself is never shuffled: rows travel
with their key, size and checksum. The curve is computed on distinct cells,
of which there are at most 2**(bits * dimensions).

Nulls: a null number takes the lowest cell, a null category the cell 0; a null
doc_id sorts first. Rows in one cell are ordered by a hash of the text, then
doc_id, so copies stay together; fully equal rows are interchangeable. An empty
table gives no rows. Extra columns are ignored by ``hilbert_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.support import let, unused, written

N_SHARDS = 16
BITS = 4
SALTS = 256


def quantile_cell(value: Column, cuts: list[float]) -> Column:
    """Number of cuts at or below the value; null counts as 0."""
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= value)),
                      F.lit(0)) if cuts else F.lit(0)


def category_cell(value: Column, bits: int = BITS) -> Column:
    """Cells 1 to 2**bits - 1 by hash; null is cell 0."""
    return F.when(value.isNull(), 0).otherwise(
        1 + F.pmod(F.xxhash64(value), F.lit((1 << bits) - 1))).cast("int")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of a cell on the Hilbert curve of ``len(cells)`` dimensions of ``bits`` bits.

    The axes are turned into the curve's transposed form bit by bit, from the
    highest: where a dimension's bit is set the first one's lower bits are
    flipped, else those of both are exchanged. A Gray code and the interleaved
    bits give the index.
    """
    n = len(cells)
    axes = F.array(*[c.cast("int") for c in cells])

    def put(a: Column, i: int, value: Column) -> Column:
        return F.transform(a, lambda x, k: F.when(k == i, value).otherwise(x))

    def turn(a: Column, step: Column) -> Column:
        bit, i = step["bit"], step["axis"]
        low = bit - 1
        own = F.element_at(a, i + 1)
        swap = F.element_at(a, 1).bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(bit) != 0
        return F.transform(a, lambda x, k: F.when(flip & (k == 0), x.bitwiseXOR(low)).when(flip, x)
                           .when(k == 0, x.bitwiseXOR(swap).bitwiseXOR(F.when(i == 0, swap).otherwise(0)))
                           .when(k == i, x.bitwiseXOR(swap)).otherwise(x))

    steps = F.array(*[F.struct(F.lit(1 << b).alias("bit"), F.lit(i).alias("axis"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])
    places = F.array(*[F.struct(F.lit(i).alias("axis"), F.lit(b).alias("bit"))
                       for b in range(bits - 1, -1, -1) for i in range(n)])
    lows = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def gray(turned: Column) -> Column:
        return F.transform(turned, lambda _, k: F.aggregate(
            F.slice(turned, F.lit(1), k + 1), F.lit(0), lambda s, x: s.bitwiseXOR(x)))

    def mended(coded: Column) -> Column:
        last = F.element_at(coded, n)
        fix = F.aggregate(lows, F.lit(0), lambda t, b: F.when(
            last.bitwiseAND(b) != 0, t.bitwiseXOR(b - 1)).otherwise(t)) if bits > 1 else F.lit(0)
        return let(fix, lambda f: F.transform(coded, lambda x: x.bitwiseXOR(f)))

    def interleaved(axis: Column) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda s, p: F.shiftleft(s, 1).bitwiseOR(
            F.call_function("shiftright", F.element_at(axis, p["axis"] + 1), p["bit"]).bitwiseAND(1).cast("long")))

    turned = F.aggregate(steps, axes, turn) if bits > 1 else axes
    return let(let(let(turned, gray), mended), interleaved)


def shard_of(rank: Column, total: Column, n_shards: int) -> tuple[Column, Column]:
    """(shard, slot) of a 0-based rank when ``total`` rows are cut into equal runs.

    The first ``total mod n_shards`` shards hold one row more than the others.
    """
    each = F.floor(total / n_shards)
    more = total - each * n_shards
    long_part = more * (each + 1)
    shard = F.when(rank < long_part, F.floor(rank / (each + 1))).otherwise(
        more + F.floor((rank - long_part) / F.greatest(each, F.lit(1))))
    start = shard * each + F.least(shard, more)
    return shard.cast("int"), (rank - start).cast("long")


def hilbert_shards(documents: DataFrame, n_shards: int = N_SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law ``rows``, shard, slot, grown_shard, curve position.

    The dimensions are the text's size by quantiles, lang and source. A row's
    rank is the number of rows in earlier (cell, salt) buckets, from one count
    per bucket, plus its place inside its bucket. The salt comes from a hash of
    id and text, so a cell with a third of all rows, be they copies of one text or
    null, is spread over its salts; only rows alike in both stay together.
    """
    text = F.col("text").cast("string")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("doc_id", text).alias("key"),
        category_cell(F.col("lang").cast("string"), bits).alias("lang_cell"),
        category_cell(F.col("source").cast("string"), bits).alias("source_cell"))
    rows = written(rows, "shard-rows")
    cuts = rows.select(F.percentile_approx(
        "size", [i / (1 << bits) for i in range(1, 1 << bits)], 10_000)).first()[0] or []
    # the salt is the top of the key's order, so salts follow each other in that order
    salted = (rows.withColumn("size_cell", quantile_cell(F.col("size"), cuts))
              .withColumn("salt", F.floor((F.col("key") / 2.0 ** 64 + 0.5) * SALTS).cast("int")))
    cell = ["size_cell", "lang_cell", "source_cell"]
    counts = salted.groupBy(*cell, "salt").agg(F.count(F.lit(1)).alias("n"))
    # cells along the curve, then salts inside each cell: neither order is longer than its grid
    curve = Window.orderBy("place")
    cells = (counts.groupBy(*cell).agg(F.sum("n").alias("rows")).withColumn("place", hilbert_index([F.col(c) for c in cell], bits))
             .select(*cell, "place", (F.sum("rows").over(curve) - F.col("rows")).alias("cells_before"),
                     F.sum("rows").over(Window.partitionBy()).alias("total")))
    inside = F.sum("n").over(Window.partitionBy(*cell).orderBy("salt")) - F.col("n")
    starts = counts.withColumn("inside", inside).join(cells, cell).select(
        *cell, "salt", "place", (F.col("cells_before") + F.col("inside")).alias("before"), "total")
    within = F.row_number().over(Window.partitionBy(*cell, "salt").orderBy("key", "doc_id")) - 1
    ranked = salted.withColumn("within", within).join(starts, [*cell, "salt"])
    shard, slot = shard_of(F.col("before") + F.col("within"), F.col("total"), n_shards)
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("place").alias("curve"))


def write_shards(documents: DataFrame, target: str, n_shards: int = N_SHARDS, bits: int = BITS) -> None:
    """Write whole documents by shard, each in curve order, so file statistics prune every dimension."""
    own_crc, own_shard, own_slot = (unused(documents, name) for name in ("__crc", "__shard", "__slot"))
    placed = hilbert_shards(documents, n_shards, bits).select(
        F.col("doc_id").alias("placed_id"), F.col("text_crc32").alias("placed_crc"), "shard", "slot")
    crc = F.coalesce(F.crc32(F.col("text").cast("string").cast("binary")), F.lit(0))
    unique = placed.groupBy("placed_id", "placed_crc").agg(F.min(F.struct("shard", "slot")).alias("placed_at"))
    at = documents.withColumn(own_crc, crc).alias("d").join(
        unique.alias("p"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("p.placed_id")) & (F.col(f"d.{own_crc}") == F.col("p.placed_crc")))
    (at.select("d.*", F.col("p.placed_at.shard").alias(own_shard), F.col("p.placed_at.slot").alias(own_slot)).drop(own_crc)
     .repartitionByRange(own_shard, own_slot).sortWithinPartitions(own_shard, own_slot).drop(own_slot)
     .write.partitionBy(own_shard).parquet(target))
