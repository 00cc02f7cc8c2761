"""Versions of a table compared through a tree of bucket hashes.

Rows fall into buckets by a hash of their key; a bucket's hash is the sum of its
rows' digests, so it needs no order and adds up from task to task. A node of the
tree is the sum of the buckets below it. Two trees are walked from the root down
and only nodes that differ are opened, so versions that differ in few buckets are
compared by reading these buckets alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions.shared import written
from catalograph.operators.profile import quoted

BITS = 12
STEP = 4
BUCKET = "key_bucket"
_JSON = {"ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
         "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_bucket(keys: list[str], bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(1 << bits)).cast("int")


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[quoted(c) for c in columns]), _JSON), 256)


def bucketed(df: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with its bucket; write it partitioned by ``BUCKET >> STEP`` or the bucket itself to have it pruned."""
    return df.withColumn(BUCKET, key_bucket(keys, bits))


def tree(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """level, node, rows, digest of all nodes: at most ``2 ** (bits + 1)`` rows, whatever the table's size.

    ``df`` has its bucket. Row digests are summed in four 64-bit lanes before the shuffle.
    """
    lanes = [F.sum(F.conv(F.substring("h", 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")).alias(f"l{i}") for i in range(4)]
    leaves = df.select(BUCKET, _digest(columns).alias("h")).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows"), *lanes)
    levels = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(BUCKET, bits - level).alias("node"))
                       for level in range(0, bits + 1, STEP)])
    nodes = leaves.select("rows", *[f"l{i}" for i in range(4)], F.inline(levels)).groupBy("level", "node").agg(
        F.sum("rows").alias("rows"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(4)])
    return nodes.select("level", "node", "rows", F.concat_ws(",", *[F.col(f"l{i}").cast("string") for i in range(4)]).alias("digest"))


def changed_buckets(before: DataFrame, after: DataFrame, bits: int = BITS) -> list[int]:
    """The buckets in which two trees differ, opened level by level from the root."""
    opened = [0]
    for level in range(0, bits + 1, STEP):
        here = (F.col("level") == level) & F.col("node").isin(opened)
        b, a = before.where(here).alias("b"), after.where(here).alias("a")
        differ = (b.join(a, F.col("a.node") == F.col("b.node"), "full")
                  .where(~(F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))))
                  .select(F.coalesce("a.node", "b.node").alias("node")).collect())
        found = sorted(r["node"] for r in differ)
        if not found or level == bits:
            return found
        opened = [n << STEP | i for n in found for i in range(1 << STEP)]
    return []


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str], buckets: list[int]) -> DataFrame:
    """The keys whose rows differ, with status ADDED, LOST or CHANGED, from the given buckets alone.

    Rows of one key are compared as a bag: how often each digest stands there.
    """
    def bag(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col(BUCKET).isin(buckets)).select(*[quoted(k) for k in keys], _digest(columns).alias("h"))
                .groupBy(*[quoted(k) for k in keys], "h").agg(F.count(F.lit(1)).alias(name)))

    same = [F.col(f"b.`{k}`").eqNullSafe(F.col(f"a.`{k}`")) for k in keys]
    both = bag(before, "old").alias("b").join(bag(after, "new").alias("a"), [*same, F.col("a.h") == F.col("b.h")], "full")
    rows = both.select(*[F.coalesce(F.col(f"a.`{k}`"), F.col(f"b.`{k}`")).alias(k) for k in keys],
                       F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"))
    summed = rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.sum("old").alias("old"), F.sum("new").alias("new"), F.max(F.col("old") != F.col("new")).alias("differs"))
    return summed.where("differs").select(*[quoted(k) for k in keys], F.when(F.col("old") == 0, "ADDED").when(F.col("new") == 0, "LOST")
                                          .otherwise("CHANGED").alias("status"))


def version_changes(before: DataFrame, after: DataFrame, keys: list[str], bits: int = BITS, store=written) -> DataFrame:
    """Changed, added and lost keys of two versions with the same columns; both have their bucket.

    ``store`` keeps the two trees, so the walk reads no row of the tables.
    """
    columns = [c for c in before.columns if c != BUCKET]
    buckets = changed_buckets(store(tree(before, columns, bits), "tree-before"), store(tree(after, columns, bits), "tree-after"), bits)
    return changed_rows(before, after, keys, columns, buckets)
