"""Globs against many names through an index of literal pieces.

Every pattern is filed under one run of at most ``GRAM`` literal characters: the
one that the fewest names hold. A name looks up the runs it holds, and only the
patterns found there are tried. Patterns without a literal depend on the length
of a name alone; they are dealt over salts, as every name may fit them.

Up to ``FEW_PATTERNS`` patterns go to the names by broadcast: only the runs that
patterns hold leave a name, and no name is shuffled. With more of them, a run that
very many names hold is spread over salts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
SALTS = 64
# Each pattern has one filed run, and as many runs to choose from as characters.
FEW_PATTERNS = 10_000
# Names of one run that one join task handles.
NAMES_PER_SALT = 1_000_000


def as_like(glob: Column) -> Column:
    """A glob (``*``, ``?``) in lower case as a LIKE pattern; its own ``%``, ``_`` and backslashes are literal."""
    literal = F.regexp_replace(F.lower(glob), r"([%_\\])", r"\\$1")
    return F.translate(literal, "*?", "%_")


def _grams(text: Column, size: Column) -> Column:
    """The runs of ``size`` characters of a text; none if it is shorter."""
    last = F.length(text) - size + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda at: F.substring(text, at, size))).otherwise(
        F.array().cast("array<string>"))


def matching_names(names: DataFrame, patterns: DataFrame, few_patterns: int = FEW_PATTERNS,
                   names_per_salt: int = NAMES_PER_SALT) -> DataFrame:
    """name, pattern: which of the distinct lower-case ``names`` fit which of the distinct ``patterns``."""
    lower = patterns.select("pattern", F.lower("pattern").alias("glob"), as_like(F.col("pattern")).alias("fits"))
    pieces = F.filter(F.split("glob", "[*?]+"), lambda p: p != "")
    longest = F.array_max(F.transform(pieces, F.length))
    # a run is as long as the longest piece allows, up to GRAM
    filed = lower.withColumn("size", F.least(F.coalesce(longest, F.lit(0)), F.lit(GRAM))).withColumn("pieces", pieces)
    runs = filed.select("pattern", "fits", "size", F.explode(F.array_distinct(F.flatten(F.transform(
        "pieces", lambda p: _grams(p, F.col("size")))))).alias("run")).where("size > 0")
    few = patterns.limit(few_patterns + 1).count() <= few_patterns
    hint = F.broadcast if few else lambda frame: frame
    held = names.select("name", F.explode(F.array_distinct(F.flatten(F.array(
        *[_grams(F.col("name"), F.lit(k)) for k in range(1, GRAM + 1)])))).alias("run"))
    if few:
        held = held.join(hint(runs.select("run").distinct()), "run", "left_semi")
    counted = held.groupBy("run").agg(F.count(F.lit(1)).alias("names"))
    # a run that no name holds settles its pattern: nothing fits it
    rarest = (runs.join(counted, "run", "left").groupBy("pattern", "fits")
              .agg(F.min(F.struct(F.coalesce("names", F.lit(0)).alias("names"), "run")).alias("best"))
              .where("best.names > 0").select("pattern", "fits", "best.*"))
    if few:
        by_run = held.join(hint(rarest), "run")
    else:
        # at most rows / names_per_salt runs need salts, so that list is broadcast
        salts = F.ceil(F.col("names") / names_per_salt).cast("int")
        hot = F.broadcast(counted.where(salts > 1).select("run", salts.alias("salts")))
        dealt = held.join(hot, "run", "left").select(
            "name", "run", F.pmod(F.xxhash64("name"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
        copies = rarest.select("pattern", "fits", "run", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
        by_run = dealt.join(copies, ["run", "salt"])
    by_run = by_run.where(F.expr("name LIKE fits")).select("name", "pattern")
    free = (filed.where("size = 0").select("pattern", "fits", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    by_length = (names.select("name", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int").alias("salt"))
                 .join(hint(free), "salt").where(F.expr("name LIKE fits")).select("name", "pattern"))
    return by_run.union(by_length)
